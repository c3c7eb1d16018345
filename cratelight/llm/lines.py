"""Line-level deduplication: hashes of lines, sorted in ranges, become per-document bitmaps of the lines to keep."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cratelight.llm.common import stored, table

BLANKS = " \t\n\x0b\x0c\r"
BITS = 64
ROW = ["_row1", "_row2"]


def lines_of(text: Column) -> Column:
    """The lines of a text, split at the newline alone; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without ASCII blanks at its ends and with A-Z lower-cased: lines with one key count as equal."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _hashes(*columns: Column, names: list[str]) -> list[Column]:
    """Two independent 64-bit hashes: together they stand for the value."""
    return [F.xxhash64(F.lit(seed), *columns).alias(name) for seed, name in enumerate(names)]


def line_hashes(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """(h1, h2, doc_id, _row1, _row2, pos): each line whose key has ``min_chars`` code points or more. No text is carried."""
    rows = docs.select("doc_id", *_hashes("doc_id", "text", names=ROW), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keyed = rows.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    return keyed.select(*_hashes("key", names=["h1", "h2"]), "doc_id", *ROW, "pos")


def repeated_keys(lines: DataFrame, min_docs: int = 5) -> DataFrame:
    """(h1, h2, keeper) of the keys that ``min_docs`` documents hold; ``keeper`` is the largest id among them.

    Hashes are dealt in ranges of (hash, document) and sorted by position within, so the stream meets each document's first
    occurrence first. A very common line spans as many ranges as its documents need; every range hands on one row per key.
    """
    ranged = lines.select("h1", "h2", "doc_id", "pos").repartitionByRange("h1", "h2", "doc_id")
    place = F.row_number().over(Window.partitionBy("h1", "h2", "doc_id").orderBy("pos"))
    first = ranged.withColumn("place", place).where("place = 1")
    found = first.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
    return found.where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper")


def drop_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(_row1, _row2, bitmap) of the documents that lose lines; ``bitmap`` lists (word, bits) of those 64-line words that hold a
    line to drop, every other line is kept."""
    lines = stored(line_hashes(docs, min_chars), "line_hashes")
    repeated = stored(repeated_keys(lines, min_docs), "repeated_keys")
    lost = lines.join(repeated, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    word, bit = F.shiftright("pos", 6), F.col("pos").bitwiseAND(BITS - 1)
    words = lost.groupBy(*ROW, word.alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, pos & {BITS - 1})")).alias("bits"))
    return words.groupBy(*ROW).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("bitmap"))


def _dense(bitmap: Column) -> Column:
    """All words up to the last one listed, those between as 0."""
    empty = F.array().cast("array<bigint>")
    zero = F.lit(0).cast("bigint")

    def add(found: Column, entry: Column) -> Column:
        return F.concat(found, F.array_repeat(zero, entry["word"] - F.size(found)), F.array(entry["bits"]))

    return F.aggregate(F.coalesce(bitmap, F.array().cast("array<struct<word:int,bits:bigint>>")), empty, add)


def keep_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text, rest) of every row of ``docs``: its text without the lines that its bitmap drops.

    A key of at least ``min_chars`` code points that ``min_docs`` documents hold stays only in the document of the largest
    id, there as often as it occurs. Rows that repeat an id are one document as far as counting goes, and each has its own
    result. A null id is an id of its own, smaller than all others; null and empty texts are one empty line; an empty table
    gives an empty result. ``rest`` boxes all other columns, whatever their names.
    """
    bitmaps = drop_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.lit(None).cast("string")
    rows = docs.select("doc_id", "text", rest.alias("rest")).select("*", *_hashes("doc_id", "text", names=ROW))
    marked = rows.join(bitmaps, ROW, "left").withColumn("lines", lines_of(F.col("text"))).withColumn("words", _dense(F.col("bitmap")))

    def kept(line: Column, i: Column) -> Column:
        bits = F.coalesce(F.get("words", F.shiftright(i, 6)), F.lit(0).cast("bigint"))
        return F.call_function("shiftrightunsigned", bits, i.bitwiseAND(BITS - 1)).bitwiseAND(F.lit(1).cast("bigint")) == 0

    dropped = F.aggregate("words", F.lit(0).cast("bigint"), lambda total, word: total + F.bit_count(word))
    return marked.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), dropped.alias("n_dropped"),
        F.when(F.col("bitmap").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.filter("lines", kept), "\n")).alias("text"), "rest",
    )


def op12_line_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """What line deduplication leaves of every document."""
    kept = keep_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


OP12_SQL = f"""
WITH lines AS (
  SELECT doc_id, row, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, k.row, k.line, k.pos, r.key IS NOT NULL AND k.doc_id <> r.keeper AS lost FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id, row
"""
