"""Top-n lists and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_songs(
    scores: DataFrame, tags: DataFrame, column: str, n: int = 10, ascending: bool = False, how: str = "left",
    fields: tuple[str, ...] = ("title", "artist"), decimals: int | None = 4,
) -> DataFrame:
    """The ``n`` songs with the highest (or lowest) ``column``, with tags; ties go to the smaller sid.

    The limit is taken before the join, so only ``n`` rows meet the tag table. ``how="inner"`` drops untagged songs.
    """
    order = F.asc(column) if ascending else F.desc(column)
    best = scores.select("sid", column).where(F.col(column).isNotNull()).orderBy(order, "sid").limit(n)
    joined = best.join(tags.select("sid", *fields), "sid", how)
    value = F.bround(column, decimals).alias(column) if decimals is not None else F.col(column)
    return joined.orderBy(order, "sid").select("sid", *fields, value)


def top_per_group(df: DataFrame, group: str, score: str, n: int, tie: str) -> DataFrame:
    """The ``n`` highest rows of every group with their ``rank``; the limit is applied before the shuffle too."""
    ranking = Window.partitionBy(group).orderBy(F.desc_nulls_last(score), tie)
    return df.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= n)


def seeded_sample(
    scores: DataFrame, tags: DataFrame, column: str, window: tuple[float, float], n: int = 10, seed: int = 1,
    carry: tuple[str, ...] = (), decimals: int = 4,
) -> DataFrame:
    """``n`` songs with ``left <= column < right``, chosen by a hash of seed and sid: the same on any cluster."""
    left, right = window
    inside = scores.where((F.col(column) >= left) & (F.col(column) < right))
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("sid").cast("string")))
    chosen = inside.select("sid", column, *carry, draw.alias("_draw")).orderBy("_draw", "sid").limit(n)
    joined = chosen.join(tags.select("sid", "title", "artist"), "sid")
    return joined.select(
        "sid", "title", "artist", *[F.bround(c, decimals).alias(c) for c in (column, *carry)]
    ).orderBy(F.desc(column), "sid")


def random_sample(df: DataFrame, n: int, seed: int | None = None, key: str = "sid") -> DataFrame:
    """``n`` random rows; with a ``seed`` by a hash of seed and ``key``, the same in any partitioning."""
    if seed is None:
        return df.orderBy(F.rand()).limit(n)
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)
