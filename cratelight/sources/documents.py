"""Feature documents: nested JSON, from files or from a string column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cratelight.operators.schema import flatten_struct

CORRUPT = "_corrupt"


def read_json(spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = True) -> DataFrame:
    """JSON documents; with a schema, malformed ones arrive with their text in ``_corrupt``."""
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        reader = reader.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good documents, texts of the malformed ones)."""
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def feature_rows(documents: DataFrame, id_column: str = "metadata_audio_properties_md5_encoded") -> DataFrame:
    """Flat feature rows keyed by ``sid``."""
    return flatten_struct(documents).withColumnRenamed(id_column, "sid")


def parse_column(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A JSON string column replaced by its flattened fields, ``<column>_<path>``."""
    return flatten_struct(df.withColumn(column, F.from_json(column, schema)))
