"""Tag values: collapsing list tags and reading metadata out of file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

TRACK_NUMBER = r"^[0-9]+(?:[.-] ?| - | )(?=\S)"


def collapse_tag(values: Column, data_type: DataType | None = None) -> Column:
    """One value for a list tag: the only one, the larger of two distinct ones, else NULL; scalars pass through."""
    if data_type is not None and not isinstance(data_type, ArrayType):
        return values
    ordered = F.array_sort(F.array_distinct(values))
    return F.when(F.size(ordered).isin(1, 2), F.element_at(ordered, -1))


def path_metadata(stem: Column) -> Column:
    """artist, title, remixer and album of a file stem, as a struct with NULL where absent.

    ``artist - album - NN title (remixer)_PN``: the marker goes, ``_ `` after a word separates like `` - ``, other
    underscores are spaces, the last bracket is the remixer and leaves the title, leading track numbers go, the
    rest splits on `` - ``.
    """
    marked = F.regexp_replace(F.regexp_replace(stem, "_PN$", ""), r"(?<=\S)_ ", " - ")
    text = F.trim(F.regexp_replace(F.translate(marked, "_", " "), r"\s+", " "))
    bracket = r"\(([^()]*)\)\s*$"
    remixer = F.trim(F.regexp_extract(text, bracket, 1))
    body = F.trim(F.regexp_replace(text, bracket, ""))
    body = F.regexp_replace(body, TRACK_NUMBER, "")
    parts = F.transform(F.split(body, " - "), lambda part: F.trim(part))
    count = F.size(parts)

    def some(value: Column) -> Column:
        return F.nullif(value, F.lit(""))

    title = F.regexp_replace(F.element_at(parts, -1), TRACK_NUMBER, "")
    return F.struct(
        some(F.when(count >= 2, F.element_at(parts, 1))).alias("artist"),
        some(title).alias("title"),
        some(remixer).alias("remixer"),
        some(F.when(count >= 3, F.element_at(parts, 2))).alias("album"),
    )
