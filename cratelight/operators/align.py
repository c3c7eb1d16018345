"""Frames that share a song id, put side by side."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_ROWS = 200_000  # rows of one key that a task joins at most on its longer side
MOST_HOT = 2_000
NULL_PARTS = 1_000


def align_outer(frames: list[DataFrame], key: str = "sid") -> DataFrame:
    """Outer alignment of frames with one row per ``key`` each and otherwise different columns.

    A union and one grouping need a single shuffle, where a chain of full outer joins needs one per frame.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    values = [c for c in stacked.columns if c != key]
    return stacked.groupBy(key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])


def align_inner(frames: list[DataFrame], key: str = "sid") -> DataFrame:
    """Inner alignment; the joins keep the partitioning on ``key``."""
    return reduce(lambda a, b: a.join(b, key), frames)


def load_scores(
    tables: list[tuple[DataFrame, dict[str, str]]], pool: Callable[[Column], Column] | None = None, key: str = "sid"
) -> DataFrame:
    """Select columns from several score tables, apply ``pool`` to every cell and align outer on the song id.

    ``tables`` pairs a frame with {column: new name}; ``pool`` may be any Column function, a pandas UDF included.
    """
    frames = [
        df.select(key, *[(pool(F.col(c)) if pool else F.col(c)).alias(name) for c, name in columns.items()])
        for df, columns in tables
    ]
    return frames[0] if len(frames) == 1 else align_outer(frames, key)


def only_known(df: DataFrame, ids: DataFrame, key: str = "sid") -> DataFrame:
    """Rows whose id occurs in ``ids``; repeated ids are dropped before they are shuffled."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def only_new(df: DataFrame, ids: DataFrame, key: str = "sid") -> DataFrame:
    """Rows whose id does not occur in ``ids``."""
    return df.join(ids.select(key).distinct(), key, "left_anti")


def only_new_groups(grouped: DataFrame, ids: DataFrame, count: str, key: str = "sid") -> DataFrame:
    """``only_new`` for a frame grouped by ``key``, whose row count ``count`` is dropped.

    The condition on the count always holds; it keeps the anti join above the grouping. Pushed below it, the join would
    shuffle every row of a frequent key to one task.
    """
    known = ids.select(F.col(key).alias("_known")).distinct()
    return grouped.join(known, (F.col(key) == F.col("_known")) & (F.col(count) > 0), "left_anti").drop(count)


def _hot_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(_hot, _parts, _split_left, _both) of the keys that hold more than ``HOT_ROWS`` rows of one side, the ``MOST_HOT`` most
    frequent at most. Fewer keys than that can hold a thousandth of a side, so every key that matters is among them; any
    further key is joined unsplit.
    """
    sides = [df.select(F.col(key).alias("_hot"), F.lit(n).alias("_left"), F.lit(1 - n).alias("_right")) for df, n in ((left, 1), (right, 0))]
    counts = sides[0].unionByName(sides[1]).where("_hot IS NOT NULL").groupBy("_hot").agg(F.sum("_left").alias("_left"), F.sum("_right").alias("_right"))
    longer = F.greatest("_left", "_right")
    rows = counts.where(longer > HOT_ROWS).orderBy(longer.desc()).limit(MOST_HOT).collect()
    found = [(r["_hot"], -(-max(r["_left"], r["_right"]) // HOT_ROWS), r["_left"] >= r["_right"], min(r["_left"], r["_right"]) > 0) for r in rows]
    more = T._parse_datatype_string("_parts bigint, _split_left boolean, _both boolean")
    return left.sparkSession.createDataFrame(found, T.StructType([counts.schema["_hot"], *more.fields]))


def _dealt(df: DataFrame, key: str, hot: DataFrame, left: bool) -> DataFrame:
    """``df`` with ``_part``: rows of a hot key are dealt over its parts on its longer side and copied to each on the other;
    rows without key are dealt over ``NULL_PARTS``."""
    row, split = F.monotonically_increasing_id(), F.col("_split_left") if left else ~F.col("_split_left")
    parts = (
        F.when(F.col(key).isNull(), F.array(F.col("_row") % NULL_PARTS))
        .when(F.col("_hot").isNull(), F.array(F.lit(0).cast("long")))
        .when(split, F.array(F.col("_row") % F.col("_parts")))
        .otherwise(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))
    )
    marked = df.withColumn("_row", row).join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_part", F.explode(parts))
    flag = "_in_left" if left else "_in_right"
    return marked.withColumn(flag, F.coalesce("_both", F.lit(False))).drop("_row", "_hot", "_parts", "_split_left", "_both")


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join with ``in_left`` and ``in_right`` telling where each row was found. Null keys match nothing.

    A full outer join cannot split a key that very many rows hold, NULL included. So the rows' keys are counted first (that
    column alone), and the join is on (key, part): a hot key is dealt over parts on one side and copied to them on the other.
    A copy without partner in its part is no result: hot keys of both sides have only matches.
    """
    hot = _hot_keys(left, right, key)
    joined = _dealt(left, key, hot, True).join(_dealt(right, key, hot, False), [key, "_part"], "full")
    found = joined.where("(_in_left IS NOT NULL AND _in_right IS NOT NULL) OR NOT coalesce(_in_left, _in_right)")
    flags = {"in_left": F.col("_in_left").isNotNull(), "in_right": F.col("_in_right").isNotNull()}
    return found.withColumns(flags).drop("_part", "_in_left", "_in_right")
