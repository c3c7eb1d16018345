"""Incremental ingest: new files and feature documents become new rows, each content once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelight.functions.tags import collapse_tag
from cratelight.operators.align import only_new_groups
from cratelight.operators.schema import conform, last_part_names, split_by_prefix, split_lists
from cratelight.sources.audio_files import AUDIO_GLOB, one_per_content, plain_path
from cratelight.sources.documents import CORRUPT, feature_rows
from cratelight.session import bounded_local
from cratelight.sources.tables import read_or_empty


def new_content(batch: DataFrame, known: DataFrame) -> DataFrame:
    """(sid, file_path) rows of a batch that are not known yet, one per content."""
    return only_new_groups(one_per_content(batch), known, "copies")


BATCH_COLUMNS = "stream string, batch long"


def drain(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, str, int], None]) -> None:
    """Processes everything that has arrived, batch by batch, and stops.

    ``write`` gets each batch with the id of its stream and its number. The id lives in the checkpoint: a renewed checkpoint
    starts again at batch 0, but under another id, so it never replaces what the old one wrote.
    """

    def each(batch: DataFrame, number: int) -> None:
        write(batch, batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), number)

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(each)
        .start()
    )
    query.awaitTermination()


def batch_folder(table: str, stream: str, number: int) -> str:
    return f"{table}/stream={stream}/batch={number}"


def known_before(spark: SparkSession, table: str, schema: str, stream: str, number: int) -> DataFrame:
    """What every other batch of every stream has written to the table."""
    rows = read_or_empty(spark, table, f"{schema}, {BATCH_COLUMNS}")
    return rows.where((F.col("stream") != stream) | (F.col("batch") != number))


PARTS = 64
MOST_IDS = 100_000


def part_of(sid: Column) -> Column:
    """The part of a table that holds a content id."""
    return F.pmod(F.xxhash64(sid), F.lit(PARTS)).cast("int")


def store_batch(rows: DataFrame, folder: str) -> None:
    """Writes the keys of a batch, one file for each part they hit, replacing what an earlier try of the batch wrote."""
    placed = rows.withColumn("part", part_of(F.col("sid"))).repartition("part")
    placed.write.mode("overwrite").partitionBy("part").parquet(folder)


def history_hits(history: DataFrame, ids: DataFrame, parts: list[int]) -> DataFrame:
    """The ids of a small batch that the history holds: only their parts are read, and the ids go to the rows."""
    return history.where(F.col("part").isin(parts)).join(F.broadcast(ids), "sid", "left_semi").select("sid")


def known_of(ids: DataFrame, table: str, stream: str, number: int) -> DataFrame:
    """Those ids of a batch that another batch has written to ``table``.

    Up to ``MOST_IDS`` ids are sent to the history, which is neither shuffled nor read beyond the parts they hit, and the hits, no more
    than the ids, come back. A batch of more ids gets the whole history, for a join by Spark's own choice.
    """
    spark = ids.sparkSession
    history = known_before(spark, table, "sid string, part int", stream, number)
    asked = bounded_local(ids.select("sid", part_of(F.col("sid")).alias("part")).where("sid IS NOT NULL"), MOST_IDS)
    if asked is None:
        return history.select("sid")
    parts = sorted(row["part"] for row in asked.select("part").distinct().collect())  # PARTS at most
    hits = bounded_local(history_hits(history, asked.select("sid"), parts), MOST_IDS)
    return history.select("sid") if hits is None else hits


def ingest_stream(spark: SparkSession, stream: DataFrame, table: str, checkpoint: str) -> None:
    """Appends the new content of a (sid, file_path) stream to the Parquet table ``table``.

    Every batch goes to its own ``stream=<id>/batch=<n>`` folder with overwrite, so a batch that is repeated after a failure
    replaces itself and nothing else; what all other batches wrote is the known content, kept in parts by a hash of the id. Any number
    of streams, one after the other, may fill one table.
    """

    def write(batch: DataFrame, name: str, number: int) -> None:
        single = one_per_content(batch).persist()
        try:
            known = known_of(single, table, name, number)
            store_batch(only_new_groups(single, known, "copies"), batch_folder(table, name, number))
        finally:
            single.unpersist()

    drain(stream, checkpoint, write)


def audio_stream(spark: SparkSession, folder: str, pattern: str = AUDIO_GLOB, files_per_batch: int | None = None) -> DataFrame:
    """The audio files arriving in a folder as a (sid, file_path) stream."""
    reader = spark.readStream.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    return files.select(F.md5("content").alias("sid"), plain_path(F.col("path")).alias("file_path"))


def feature_tables(rows: DataFrame, meta_prefix: str = "meta") -> dict[str, DataFrame]:
    """The tables of a batch of flat feature rows, by name.

    ``tags`` from the metadata columns (list tags collapsed, known tag columns only), one table per feature family from
    the scalar columns, and one ``<column>_tbl`` per list column.
    """
    meta = [field for field in rows.schema if field.name.startswith(meta_prefix)]
    single = rows.select("sid", *[collapse_tag(F.col(f.name), f.dataType).alias(f.name) for f in meta])
    scalars, lists = split_lists(rows.drop(*[f.name for f in meta]))
    tables = {"tags": conform(last_part_names(single))[0], **split_by_prefix(scalars)}
    return tables | {f"{c}_tbl": lists.select("sid", c) for c in lists.columns if c != "sid"}


REJECTS_SCHEMA = "reason string, document string"


def split_rejects(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good documents, (reason, document) of the others): malformed ones, if the batch tells them, and those without an id."""
    corrupt = F.col(CORRUPT) if CORRUPT in batch.columns else F.lit(None).cast("string")
    whole = F.coalesce(corrupt, F.to_json(F.struct(*[c for c in batch.columns if c != CORRUPT])))
    marked = batch.withColumn("_malformed", corrupt.isNotNull()).withColumn("_text", whole).drop(CORRUPT)
    reason = F.when(F.col("_malformed"), "malformed").when(F.col("sid").isNull(), "no id")
    flat = feature_rows(marked).withColumn("_reason", reason)
    rejects = flat.where("_reason IS NOT NULL").select(F.col("_reason").alias("reason"), F.col("_text").alias("document"))
    return flat.where("_reason IS NULL").drop("_text", "_malformed", "_reason"), rejects


def ingest_documents(spark: SparkSession, stream: DataFrame, root: str, checkpoint: str) -> None:
    """Appends the tables of new feature documents below ``root``; documents with a known ``sid`` are left out.

    Malformed documents (if the stream has a ``_corrupt`` column) and those without an id go to ``rejects`` with the reason and
    their text. Of documents that share an id in a batch the smallest by its JSON text is taken, whole. As in
    ``ingest_stream``, a batch owns its folders. ``tags`` is written last and tells what is known, so a batch that failed
    half way is written again as a whole.
    """

    def write(batch: DataFrame, name: str, number: int) -> None:
        batch = batch.persist()
        try:
            flat, rejects = split_rejects(batch)
            rejects.write.mode("overwrite").parquet(batch_folder(f"{root}/rejects", name, number))
            fields = F.struct(*[c for c in flat.columns if c != "sid"])
            single = flat.groupBy("sid").agg(F.min_by(fields, F.to_json(fields)).alias("_row"), F.count("*").alias("_copies"))
            known = known_of(single, f"{root}/tags", name, number)
            rows = only_new_groups(single.select("sid", "_row.*", "_copies"), known, "_copies").persist()
            try:
                tables = feature_tables(rows)
                for table in [n for n in tables if n != "tags"]:
                    tables[table].write.mode("overwrite").parquet(batch_folder(f"{root}/{table}", name, number))
                store_batch(tables["tags"], batch_folder(f"{root}/tags", name, number))
            finally:
                rows.unpersist()
        finally:
            batch.unpersist()

    drain(stream, checkpoint, write)
