"""Tables: scans, projected scans, listing and appends."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, folder: str, name: str, *columns: str | Column, schema: str | None = None) -> DataFrame:
    """A Parquet table of a folder, restricted to ``columns`` when given; a ``schema`` saves the job that reads footers."""
    reader = spark.read.schema(schema) if schema else spark.read
    table = reader.parquet(f"{folder}/{name}.parquet")
    return table.select(*columns) if columns else table


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Names of the catalog's tables."""
    return spark.createDataFrame([(t.name,) for t in spark.catalog.listTables(database)], "name string").orderBy("name")


def append(df: DataFrame, path: str) -> int:
    """Appends to a Parquet table, creating it when absent; returns the rows written."""
    rows = Observation()
    df.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return rows.get["rows"]


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or no rows when nothing has been written yet; any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def insert_files(files: DataFrame, path: str) -> int:
    """Appends (sid, file_path) rows and returns how many."""
    return append(files.select("sid", "file_path"), path)


def insert_families(families: dict[str, DataFrame], root: str) -> dict[str, int]:
    """Appends one table per feature family below ``root``; returns the rows of each."""
    return {name: append(df, f"{root}/{name}") for name, df in families.items()}


def insert_lists(lists: DataFrame, root: str, key: str = "sid") -> dict[str, int]:
    """Appends one table per list column, ``<column>_tbl``, the list kept as an array; returns the rows of each."""
    return {c: append(lists.select(key, c), f"{root}/{c}_tbl") for c in lists.columns if c != key}
