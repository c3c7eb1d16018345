"""Statistics over song scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def long_scores(df: DataFrame, key: str, label: str = "label", score: str = "score") -> DataFrame:
    """Wide score row to (key, label, score) rows."""
    return df.unpivot([key], [c for c in df.columns if c != key], label, score)


def largest_class_means(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` classes with the largest mean score over all songs."""
    means = df.agg(*[F.avg(c).alias(c) for c in df.columns if c != key])
    return means.unpivot([], means.columns, "label", "mean_score").orderBy(F.desc_nulls_last("mean_score"), "label").limit(n)


def classes_over(df: DataFrame, key: str, threshold: float, n: int) -> DataFrame:
    """The ``n`` classes with the most songs scoring at least ``threshold``."""
    counts = df.agg(*[F.count_if(F.col(c) >= threshold).alias(c) for c in df.columns if c != key])
    return counts.unpivot([], counts.columns, "label", "n_songs").orderBy(F.desc("n_songs"), "label").limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each non-null value occurs, most frequent first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), column)
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per column, and rows with a null in any of them, in one row."""
    any_null = F.lit(False)
    for column in columns:
        any_null = any_null | F.col(column).isNull()
    return df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns], F.count_if(any_null).alias("any_nulls")
    )


def fraction(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """The share of rows that satisfy each named predicate; an unknown result counts as not satisfied."""
    return df.agg(
        *[F.avg(F.coalesce(p, F.lit(False)).cast("double")).alias(name) for name, p in predicates.items()]
    )


def column_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """Minimum and maximum of each column, in one row."""
    return df.agg(
        *[f(c).alias(f"{c}_{suffix}") for c in columns for f, suffix in ((F.min, "min"), (F.max, "max"))]
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal-width bins between minimum and maximum; the last bin is closed on the right."""
    values = df.select(F.col(column).cast("double").alias("x")).where("x IS NOT NULL AND NOT isnan(x)")
    bounds = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("b")).scalar()
    lo, hi = F.col("_b.lo"), F.col("_b.hi")
    slot = F.least(F.floor((F.col("x") - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins), F.lit(bins - 1))
    placed = values.withColumn("_b", bounds).select(F.coalesce(slot, F.lit(0)).cast("int").alias("bin"))
    counts = placed.groupBy("bin").agg(F.count("*").alias("c"))
    every_bin = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), bounds.alias("_b"))
    width = (hi - lo) / bins
    return every_bin.join(counts, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("left_edge"),
        F.coalesce("c", F.lit(0)).cast("long").alias("n"),
    )


def dominant_class(df: DataFrame, key: str, classes: list[str], name: str = "dominant") -> DataFrame:
    """The class with the largest score per song; the first listed class wins ties, NULL scores lose."""
    ranked = [
        F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("score"), F.lit(-i).alias("order"), F.lit(c).alias("label")))
        for i, c in enumerate(classes)
    ]
    best = F.array_max(F.array(*ranked))
    return df.select(key, best["label"].alias(name), best["score"].alias(f"{name}_score"))


def top_classes(df: DataFrame, key: str, n: int) -> DataFrame:
    """(key, rank, label, score): the ``n`` highest classes of every song, ties by label; each row sorts its own scores."""
    scores = F.array(*[F.struct((-F.col(c)).alias("low"), F.lit(c).alias("label")) for c in df.columns if c != key])
    present = F.filter(scores, lambda s: s["low"].isNotNull())
    best = F.slice(F.array_sort(present), 1, n)
    return df.select(key, F.posexplode(best).alias("pos", "s")).select(
        key, (F.col("pos") + 1).alias("rank"), F.col("s.label").alias("label"), (-F.col("s.low")).alias("score")
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in order."""
    return df.select(column).distinct().orderBy(column)
