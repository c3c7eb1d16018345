"""Quality rules: base rules on words and lines, then a log-likelihood ratio of hashed n-grams, trusted target against raw corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratelight.llm.common import U64, WORDS, WORDS_AND_MARKS, mix, pieces_of, table, text_bytes, tokens, windows

BUCKET_BITS = 14
TRUSTED_ROWS = 20_000  # bound of the labelled sample that the target is fitted on
SMOOTHING = 1.0  # of the raw corpus's counts
PULL = 1000.0  # tokens of the raw corpus that the target's multinomial starts from
THRESHOLD = -0.12  # of the mean log ratio of a document's n-grams; 0 means as likely under either
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 10, 20, 5
LINES = np.where(np.arange(256) == ord("\n"), 0, 1).astype(np.uint8)
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_text(positions: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the sorted ``positions`` fall into each text."""
    return np.diff(np.searchsorted(positions, bounds))


def _in_text(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hashes made different between texts."""
    return hashes ^ np.repeat(mix(np.arange(1, len(counts) + 1, dtype=U64)), counts)


def base_figures(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The five figures of each text. Equal words, windows and lines are told by 64-bit hashes within a text."""
    words = tokens(data, bounds, WORDS)
    n_words = words.counts()
    chars = np.flatnonzero((WORDS[data] != 0) & ((data & 0xC0) != 0x80))
    lines = tokens(data, bounds, LINES)
    filled = np.diff(np.searchsorted(words.starts, np.append(lines.starts, len(data)))) > 0
    line_text = np.repeat(np.arange(len(bounds) - 1), lines.counts())[filled]
    keys = _in_text(lines.hashes, lines.counts())[filled]
    _, first = np.unique(keys, return_index=True)
    total = np.bincount(line_text, minlength=len(bounds) - 1)
    distinct = np.bincount(line_text[first], minlength=len(bounds) - 1)
    runs, run_bounds = windows(words, WINDOW)
    runs = _in_text(runs, np.diff(run_bounds))
    ordered = np.sort(runs)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    covered = np.zeros(len(words.hashes), bool)
    if len(twice):
        at = np.minimum(np.searchsorted(twice, runs), len(twice) - 1)
        hit = np.flatnonzero(twice[at] == runs)
        begin = hit + np.repeat(words.bounds[:-1] - run_bounds[:-1], np.diff(run_bounds))[hit]
        for k in range(WINDOW):
            covered[begin + k] = True
    return {
        "n_words": n_words, "word_chars": _per_text(chars, bounds), "n_symbols": _per_text(np.flatnonzero(SYMBOLS[data]), bounds),
        "n_dup_lines": total - distinct, "n_repeat_words": _per_text(np.flatnonzero(covered), words.bounds),
    }


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of single tokens and of pairs of neighbours, each with where a text's begin. Marks are tokens of their own."""
    found = tokens(data, bounds, WORDS_AND_MARKS)
    pairs, pair_bounds = windows(found, 2)
    shift = U64(64 - BUCKET_BITS)
    return (found.hashes >> shift).astype(np.int64), found.bounds, (pairs >> shift).astype(np.int64), pair_bounds


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _count(batches):
    raw, trusted = np.zeros(1 << BUCKET_BITS, np.int64), np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in batches:
        for part in pieces_of(batch):
            one, one_bounds, two, two_bounds = features(*text_bytes(part.column("text")))
            flag = part.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            for buckets, bounds in ((one, one_bounds), (two, two_bounds)):
                raw += np.bincount(buckets, minlength=len(raw))
                trusted += np.bincount(buckets[np.repeat(flag, np.diff(bounds))], minlength=len(raw))
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(raw[seen]), pa.array(trusted[seen])], ["bucket", "raw", "trusted"])


def fit(docs: DataFrame, labels: DataFrame, trusted_rows: int = TRUSTED_ROWS) -> np.ndarray:
    """Log ratio of every bucket. The raw corpus is all of ``docs``; the target is their rows with quality 1, at most
    ``trusted_rows`` of them, chosen by a hash of the id. Counts are summed per task before they meet."""
    chosen = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_rows)
    marked = docs.select("doc_id", "text").join(F.broadcast(chosen.withColumn("trusted", F.lit(True))), "doc_id", "left")
    marked = marked.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    counted = marked.mapInArrow(_count, "bucket int, raw long, trusted long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))
    rows = counted.toPandas()  # at most one row per bucket
    raw, trusted = np.full(1 << BUCKET_BITS, SMOOTHING), np.zeros(1 << BUCKET_BITS)
    raw[rows.bucket] += rows.raw
    trusted[rows.bucket] += rows.trusted
    return log_ratio(raw, trusted)


def log_ratio(raw: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """The target's multinomial is drawn towards the raw one, so without evidence a ratio is 0."""
    if not trusted.any():
        return np.zeros(len(raw))
    base = raw / raw.sum()
    return np.log((trusted + PULL * base) / (trusted.sum() + PULL)) - np.log(base)


def judge(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD, trusted_rows: int = TRUSTED_ROWS) -> DataFrame:
    """The columns ``keep`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed and kept.

    ``score`` is the mean log ratio of the document's tokens and token pairs between the trusted target and the raw corpus; a
    document is kept if the base rules pass and the score reaches ``threshold``. A null or blank text has no words and so
    fails the base rules, with score 0. Without trusted rows every ratio is 0 and the base rules decide. Repeated rows and
    ids are judged alike; names of the
    figures must not be among ``keep``; columns other than these, doc_id, text and quality are not read.
    """
    spark = docs.sparkSession
    ratios = spark.sparkContext.broadcast(fit(docs, labels, trusted_rows))
    docs = docs.select(*dict.fromkeys(["text", *keep]))
    schema = T.StructType([*[docs.schema[c] for c in keep], *[T.StructField(c, T.LongType()) for c in FIGURES], T.StructField("score", T.DoubleType())])

    def score(batches):
        for batch in batches:
            for part in pieces_of(batch):
                data, bounds = text_bytes(part.column("text"))
                figures = base_figures(data, bounds)
                one, one_bounds, two, two_bounds = features(data, bounds)
                total = _sums(ratios.value[one], one_bounds) + _sums(ratios.value[two], two_bounds)
                mean = total / np.maximum(np.diff(one_bounds) + np.diff(two_bounds), 1)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *[pa.array(figures[c].astype(np.int64)) for c in FIGURES], pa.array(mean)], schema.names)

    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return docs.mapInArrow(score, schema).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def op10_ngram_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's base figures, score and verdict; the target is what ``labels`` marks as good."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return judge(table(spark, folder, "documents"), labels)
