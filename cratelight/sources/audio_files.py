"""New audio files: listing, content ids, and which of a list of paths exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelight.operators.align import only_known

# The audio file extensions.
AUDIO_GLOB = "*.{wav,mp3,aiff}"


def list_files(spark: SparkSession, folder: str, pattern: str = AUDIO_GLOB) -> DataFrame:
    """(file_path, length) of the matching files below ``folder``; the bytes are not read. Empty files are skipped."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return files.select(plain_path(F.col("path")).alias("file_path"), "length")


def hashed_files(spark: SparkSession, folder: str, pattern: str = AUDIO_GLOB) -> DataFrame:
    """(sid, file_path) with the MD5 of the file bytes as id, one row per distinct content (smallest path)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    hashed = files.select(F.md5("content").alias("sid"), plain_path(F.col("path")).alias("file_path"))
    return one_per_content(hashed).drop("copies")


def plain_path(path):
    """``file:/a/b`` -> ``/a/b``."""
    return F.regexp_replace(path, "^file:/*", "/")


def one_per_content(files: DataFrame) -> DataFrame:
    """(sid, file_path, copies): one row per content with its smallest path; copies are combined map-side."""
    return files.groupBy("sid").agg(F.min("file_path").alias("file_path"), F.count("*").alias("copies"))


def existing_only(paths: DataFrame, listing: DataFrame) -> DataFrame:
    """Paths that the listing contains."""
    return only_known(paths, listing, "file_path")
