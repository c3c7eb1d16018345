"""Sharding by jump consistent hashing: a key and the number of shards alone decide the shard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelight.llm.common import running_total, slices_for, table

MASK = (1 << 32) - 1
# Multiplier of the generator that the published jump hash steps through, as two 32-bit halves.
FACTOR = 2862933555777941757
FACTOR_HIGH, FACTOR_LOW = FACTOR >> 32, FACTOR & MASK


def _step(high: Column, low: Column) -> tuple[Column, Column]:
    """key * FACTOR + 1 modulo 2**64, on 32-bit halves: no product reaches 2**63, so nothing overflows."""
    p0 = low.bitwiseAND(0xFFFF) * F.lit(FACTOR_LOW)
    p1 = F.shiftright(low, 16) * F.lit(FACTOR_LOW)
    sum_low = p0 + F.shiftleft(p1.bitwiseAND(0xFFFF), 16) + 1
    h0 = high.bitwiseAND(0xFFFF) * F.lit(FACTOR_LOW)
    h1 = (F.shiftright(high, 16) * F.lit(FACTOR_LOW)).bitwiseAND(0xFFFF)
    new_high = F.shiftright(sum_low, 32) + F.shiftright(p1, 16) + (low * F.lit(FACTOR_HIGH)).bitwiseAND(MASK) + h0.bitwiseAND(MASK) + F.shiftleft(h1, 16)
    return new_high.bitwiseAND(MASK), sum_low.bitwiseAND(MASK)


def jump_hash(key: Column, shards: int) -> Column:
    """The shard of a 64-bit ``key`` among ``shards``; one shard more moves keys only into the new shard.

    A fold over at most ``shards`` jumps: while the next jump stays below ``shards`` it becomes the shard. Null keys count as 0.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("next"),
        F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(MASK).alias("low"),
    )

    def jump(state: Column, _: Column) -> Column:
        high, low = _step(state["high"], state["low"])
        far = F.floor((state["next"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double")))
        moved = F.struct(state["next"].alias("shard"), far.cast("long").alias("next"), high.alias("high"), low.alias("low"))
        return F.when(state["next"] < shards, moved).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump, lambda s: s["shard"]).cast("int")


def shard(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", rows_per_slice: int = 50_000) -> DataFrame:
    """Shard and slot of every document: (key, size, text_crc32, shard, slot, grown_shard).

    ``size`` is the text's UTF-8 bytes plus 1, ``slot`` its place in the shard (gapless from 0, in the order of the key's
    md5), ``grown_shard`` the shard if there were one more. A null text is as empty, a null key goes where key 0 goes. Rows
    that repeat a key share its shard and get slots of their own. An empty table gives an empty result; columns other than
    key and text are not read. Only sizes and checksums are shuffled, and a shard is numbered in slices of about
    ``rows_per_slice`` rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    small = docs.select(
        F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        jump_hash(F.col(key), shards).alias("shard"), jump_hash(F.col(key), shards + 1).alias("grown_shard"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("_digest"),
    )
    slices = slices_for(docs.count(), rows_per_slice)
    numbered = running_total(small, "shard", "_digest", [key, "size", "text_crc32"], F.lit(1).cast("long"), "slot", slices)
    return numbered.select(key, "size", "text_crc32", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = 8, key: str = "doc_id", files_per_shard: int = 8) -> None:
    """Writes whole documents, one folder ``shard=<n>`` per shard; a shard's rows are spread over several files."""
    salt = F.pmod(F.xxhash64(key), F.lit(files_per_shard))
    placed = docs.withColumn("shard", jump_hash(F.col(key), shards))
    placed.repartition(shards * files_per_shard, "shard", salt).write.partitionBy("shard").parquet(path)


def op8_jump_hash(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 7 under the law ``key``."""
    placed = shard(table(spark, folder, "documents").select("doc_id", "text"), 8)
    return placed.withColumn("law", F.lit("key")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
