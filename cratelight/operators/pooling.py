"""Segment scores to song scores, and ordered segment sequences.

Pooling is a plain ``groupBy``: Spark combines map-side, so one song with a third of all segments costs one
partial row per task. Ordered operators cut the sequences of large songs into slices, number rows inside (song,
slice) and add per-slice offsets, so a long sequence is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratelight.functions.arrays import segment_start
from cratelight.functions.labels import sql_text
from cratelight.session import written

FEW_CLASSES = 32
HOT_ROWS = 1_000_000  # rows of one song that one task may sort
ROWS_PER_SLICE = 500_000  # rows of a range of large songs, on average


def pool_scores(df: DataFrame, keys: list[str], score: str = "score") -> DataFrame:
    """Mean, population standard deviation and count of the segment scores per ``keys``."""
    return df.groupBy(*keys).agg(
        F.avg(score).alias("mean_score"),
        F.stddev_pop(score).alias("std_score"),
        F.count(score).alias("n_segments"),
    )


def pool_wide(df: DataFrame, key: str, label: str, score: str, classes: dict[str, str]) -> DataFrame:
    """One row per song, one mean-score column per class; ``classes`` maps label value to column name.

    Few classes are averaged conditionally in one pass, so unused ones are pruned; many go through a pivot, which
    averages (song, class) rows first and keeps the generated code small.
    """
    if len(classes) > FEW_CLASSES:
        return df.groupBy(key).pivot(label, list(classes)).agg(F.avg(score)).withColumnsRenamed(classes)
    means = [f"avg(`{score}`) FILTER (WHERE `{label}` = {sql_text(value)}) AS `{name}`" for value, name in classes.items()]
    return df.groupBy(key).agg(*map(F.expr, means))


def top_segments_mean(df: DataFrame, keys: list[str], score: str, n: int) -> DataFrame:
    """Mean of the ``n`` largest segment scores per ``keys``; the rank limit is applied before the shuffle."""
    ranked = df.where(F.col(score).isNotNull()).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score)))
    )
    return ranked.where(F.col("_rank") <= n).groupBy(*keys).agg(F.avg(score).alias("top_mean"))


def pool_activation_head(table: DataFrame, key: str = "sid") -> DataFrame:
    """Mean and population std per song of an activation table's first class not named ``no...``."""
    from cratelight.functions.arrays import mean_of, std_of

    column = next(name for name in table.columns if name != key and not name.startswith("no"))
    return table.select(
        key, F.lit(column).alias("class"), mean_of(F.col(column)).alias("mean_score"), std_of(F.col(column)).alias("std_score")
    )


def vector_means(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Element-wise mean of an array column per ``keys``, as ``mean_vector array<double>``."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    return (
        df.select(*keys, array_to_vector(vector).alias("_vector"))
        .groupBy(*keys)
        .agg(Summarizer.mean(F.col("_vector")).alias("_mean"))
        .select(*keys, vector_to_array("_mean").alias("mean_vector"))
    )


def running_sum(
    df: DataFrame, keys: list[str], slice_by: Column, order: list, value: Column, name: str
) -> DataFrame:
    """Inclusive running sum of ``value`` per ``keys`` along ``order``, without one task per key.

    ``slice_by`` must not decrease along ``order``; neither it nor the keys may be NULL. Rows are summed inside (keys,
    slice); slice totals are combined map-side into one small row each and turned into offsets. The join has the
    partitioning of the window, so rows are shuffled once.
    """
    sliced = df.withColumns({"_slice": slice_by, "_value": value})
    group = [*keys, "_slice"]
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*group)
        .agg(F.sum("_value").alias("_total"))
        .select(*group, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    )
    local = sliced.withColumn("_local", F.sum("_value").over(inside))
    summed = local.join(offsets, group).withColumn(name, F.col("_local") + F.col("_offset"))
    return summed.select(*df.columns, name)


def _null_safe(left: list[str], right: list[str]) -> list[Column]:
    return [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)]


def positions(df: DataFrame, keys: list[str], order: list[str], name: str = "pos") -> DataFrame:
    """0-based position of each row inside its ``keys``, along ``order`` (a total order).

    Rows of keys with more than ``HOT_ROWS`` rows are ranged by keys and the whole order, so neither a long sequence nor one
    with very many rows at one instant is a single task. The ranges are written; a row's place in its range, moved by the rows
    of its key in the ranges before, is its position. The other keys are numbered by a window.
    """
    numbered = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    marks = [f"_k{i}" for i in range(len(keys))]
    hot = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > HOT_ROWS).toDF(*marks, "_n")
    total = hot.agg(F.sum("_n")).first()[0]
    if total is None:
        return df.withColumn(name, numbered.cast("long"))
    hot = written(hot, "hot-keys")
    same = _null_safe(keys, marks)
    ranged = df.join(hot, same, "left_semi").repartitionByRange(-(-total // ROWS_PER_SLICE), *keys, *order).sortWithinPartitions(*keys, *order)
    sliced = written(ranged.withColumns({"_slice": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), "ranges")

    runs = sliced.groupBy(*keys, "_slice").agg(F.count("*").alias("_c"), F.min("_row").alias("_first")).toDF(*marks, "_s", "_c", "_first")
    before = Window.partitionBy(*marks).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    # written, so that Spark knows its size when it plans the join
    shifts = written(runs.select(*marks, "_s", (F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_first")).alias("_shift")), "shifts")
    placed = sliced.join(shifts, _null_safe([*keys, "_slice"], [*marks, "_s"])).select(*df.columns, (F.col("_row") + F.col("_shift")).alias(name))
    return placed.unionByName(df.join(hot, same, "left_anti").withColumn(name, numbered.cast("long")))


def timeline(df: DataFrame, pos: str = "pos") -> DataFrame:
    """Adds the start second of every segment."""
    return df.withColumn("start_second", segment_start(F.col(pos)))


def timeline_from_arrays(df: DataFrame, key: str, scores: str) -> DataFrame:
    """One row per element of a score array: position, start second and score."""
    return timeline(df.select(key, F.posexplode(scores).alias("pos", "score")))


def patches(df: DataFrame, keys: list[str], pos: str, value: str, size: int, pad=0.0) -> DataFrame:
    """Fixed-length, non-overlapping patches of an ordered sequence.

    Full patches are kept and a shorter tail is dropped, unless it is all there is: then it is padded to ``size``.
    A patch gathers at most ``size`` rows.
    """
    cut = df.withColumn("patch", F.floor(F.col(pos) / size).cast("long"))
    gathered = cut.groupBy(*keys, "patch").agg(
        F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(value).alias("v")))).alias("_frames")
    )
    filler = F.array_repeat(F.lit(pad), F.lit(size) - F.size("_frames"))
    return gathered.where((F.size("_frames") == size) | (F.col("patch") == 0)).select(
        *keys,
        "patch",
        F.size("_frames").alias("n_frames"),
        F.concat(F.transform("_frames", lambda frame: frame["v"]), filler).alias("frames"),
    )
