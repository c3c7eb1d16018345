"""Filling missing tags from the library export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratelight.functions.paths import export_path, nfkc
from cratelight.operators.align import reconcile

# Tag column -> export column that replaces its nulls.
REPAIRS = {"bpm": "AverageBpm", "title": "Name", "artist": "Artist", "initialkey": "Tonality"}


def _keyed(tags: DataFrame, export: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the normalised path; export columns named like a tag (in any case) become ``export_<name>``."""
    taken = {c.lower() for c in tags.columns}
    export = export.withColumnsRenamed({c: f"export_{c}" for c in export.columns if c.lower() in taken})
    return tags.withColumn("path_key", nfkc("file_path")), export.withColumn("path_key", export_path(F.col("Location")))


def match_export(tags: DataFrame, export: DataFrame) -> DataFrame:
    """Tags (with file_path) joined to the export (with Location) on the normalised path."""
    left, right = _keyed(tags, export)
    return left.join(right, "path_key")


def reconcile_export(tags: DataFrame, export: DataFrame) -> DataFrame:
    """The same join with the songs and tracks that found no partner, flagged ``in_left`` and ``in_right``."""
    return reconcile(*_keyed(tags, export), "path_key")


def repair_tags(tags: DataFrame, export: DataFrame, repairs: dict[str, str] = REPAIRS) -> DataFrame:
    """A new version of the tag table with nulls filled from the export; present values are never changed.

    The export is first reduced to one row per path (of several tracks at one path, the last TrackID), so the join
    cannot multiply songs.
    """
    keyed = export.select(export_path(F.col("Location")).alias("path_key"), "TrackID", *set(repairs.values()))
    single = keyed.groupBy("path_key").agg(
        F.max_by(F.struct(*repairs.values()), F.struct(F.length("TrackID"), "TrackID")).alias("_new")
    )
    joined = tags.withColumn("path_key", nfkc("file_path")).join(single, "path_key", "left")
    fixed = {
        column: F.coalesce(F.col(column), F.col(f"_new.{source}").try_cast(dict(tags.dtypes)[column]))
        for column, source in repairs.items()
    }
    return joined.withColumns(fixed).select(*tags.columns)
