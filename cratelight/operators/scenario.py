"""Percentile-threshold scenarios and the stacked song filter."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratelight.operators.quantiles import quantile_row


@dataclass(frozen=True)
class Rule:
    """``column`` compared with one of its own percentiles; ``op`` is ``<=`` or ``>=`` (or ``<``, ``>``, ``==``)."""

    column: str
    percentile: float
    op: str


# The thresholds of each scenario.
SCENARIOS = {
    "winebar": [
        Rule("danceable", 0.2, "<="),
        Rule("aggressive", 0.3, "<="),
        Rule("party", 0.3, "<="),
        Rule("approachable", 0.7, ">="),
        Rule("engaging", 0.7, ">="),
        Rule("acoustic", 0.5, ">="),
    ],
    "winebar_relaxed": [
        Rule("danceable", 0.2, "<="),
        Rule("aggressive", 0.3, "<="),
        Rule("party", 0.5, "<="),
        Rule("approachable", 0.7, ">="),
        Rule("engaging", 0.7, ">="),
    ],
    "club": [
        Rule("danceable", 0.75, ">="),
        Rule("party", 0.75, ">="),
        Rule("engaging", 0.75, ">="),
        Rule("aggressive", 0.5, ">="),
    ],
    "opening_act": [
        Rule("danceable", 0.5, ">="),
        Rule("danceable", 0.9, "<="),
        Rule("party", 0.5, ">="),
        Rule("party", 0.9, "<="),
        Rule("aggressive", 0.5, "<="),
        Rule("engaging", 0.5, ">="),
        Rule("sad", 0.5, "<="),
    ],
    "day_party": [
        Rule("danceable", 0.5, ">="),
        Rule("happy", 0.75, ">="),
        Rule("approachable", 0.75, ">="),
        Rule("engaging", 0.75, ">="),
        Rule("aggressive", 0.5, "<="),
        Rule("sad", 0.5, "<="),
    ],
}
COMPARE = {
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "==": lambda a, b: a == b,
}


def passing(scores: DataFrame, rules: list[Rule], decimals: int | None = 3) -> DataFrame:
    """Songs whose scores satisfy every rule; thresholds are rounded half to even before comparing."""
    wanted: dict[str, list[float]] = {}
    for rule in rules:
        if rule.percentile not in wanted.setdefault(rule.column, []):
            wanted[rule.column].append(rule.percentile)
    row, fields = quantile_row(scores, wanted)
    cuts = row.select(F.struct(*row.columns)).scalar()

    def holds(rule: Rule):
        cut = F.col("_cuts").getField(fields[rule.column, float(rule.percentile)])
        return COMPARE[rule.op](F.col(rule.column), F.bround(cut, decimals) if decimals is not None else cut)

    # one column holds the thresholds, so their plan is optimised once and not once per rule
    return scores.withColumn("_cuts", cuts).where(reduce(and_, map(holds, rules))).drop("_cuts")


def scenario(scores: DataFrame, tags: DataFrame, rules: list[Rule]) -> DataFrame:
    """Title, artist and all scores of the songs that satisfy a scenario."""
    return tags.select("sid", "title", "artist").join(passing(scores, rules), "sid")


def genre_edition(
    songs: DataFrame, genres: DataFrame, column: str, percentile: float = 0.75
) -> DataFrame:
    """The songs of a scenario that also reach a percentile of one genre score (threshold not rounded)."""
    top = passing(genres.select("sid", column), [Rule(column, percentile, ">=")], decimals=None)
    return songs.join(top, "sid")


def filter_songs(
    tags: DataFrame,
    mood: DataFrame | None = None,
    genres: DataFrame | None = None,
    mood_ranges: dict[str, tuple[float, float]] | None = None,
    genre_ranges: dict[str, tuple[float, float]] | None = None,
    bpm: tuple[float, float] | None = None,
    keys: list[str] | None = None,
) -> DataFrame:
    """Tags plus the filtered score columns of songs inside every closed range, bpm range and key list.

    Each filter sits on its own table below the joins, where the scan can use it.
    """
    if bpm is not None:
        tags = tags.where(F.col("bpm").between(*bpm))
    if keys:
        tags = tags.where(F.col("initialkey").isin(keys))
    for table, ranges in ((mood, mood_ranges), (genres, genre_ranges)):
        if not ranges:
            continue
        inside = [F.col(c).try_cast("double").between(low, high) for c, (low, high) in ranges.items()]
        tags = tags.join(table.select("sid", *ranges).where(reduce(and_, inside)), "sid")
    return tags
