"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratelight.llm.common import pieces_of, table, text_bytes

BUCKET_BITS = 16
LENGTHS = (1, 2, 3)
ROWS_PER_LANGUAGE = 3000  # bound of the labelled sample, for each language
SMOOTHING = 0.5
UNKNOWN = "und"
HELD_OUT_MOD, HELD_OUT_REST = 4, 2
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Each code point itself if it is a letter, else a space."""
    if not _LETTERS:
        points = np.arange(0x110000, dtype=np.uint32)
        keep = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)
        _LETTERS.append(np.where(keep, points, 32).astype(np.uint32))
    return _LETTERS[0]


def grams(texts) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each length the buckets of the texts' n-grams and where each text's begin; and which texts have a letter.

    Texts are lower-cased, anything but letters counts as a space, and n-grams of spaces alone are left out. Every text
    stands between two spaces.
    """
    data, bounds = text_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    ends = np.searchsorted(heads, bounds)
    points = _letters()[np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)]
    n = len(bounds) - 1
    line = np.full(len(points) + n + 1, 32, np.uint32)  # a space before each text and one at the end
    counts = np.diff(ends)
    line[np.arange(len(points)) + np.repeat(np.arange(n), counts) + 1] = points
    begins = ends + np.arange(n + 1)  # of each text's leading space
    lettered = np.diff(np.searchsorted(np.flatnonzero(line != 32), begins)) > 0
    out = []
    for length in LENGTHS:
        size = max(len(line) - length + 1, 0)
        code, blank = np.full(size, length * 0x85EBCA6B & 0xFFFFFFFF, np.uint32), np.ones(size, bool)
        for k in range(length):
            part = line[k : k + size]
            code = (code ^ part) * np.uint32(0x9E3779B1)
            code ^= code >> np.uint32(15)
            blank &= part == 32
        for k in range(1, length - 1):  # an n-gram may end in the next text's leading space, not beyond
            over = begins[1:] - k
            blank[over[(over >= 0) & (over < size)]] = True
        inside = np.flatnonzero(~blank)
        out.append(((code[inside] >> np.uint32(32 - BUCKET_BITS)).astype(np.int64), np.searchsorted(inside, begins)))
    return out, lettered


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # log probability, bucket x language
    prior: np.ndarray

    def posterior(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the likeliest language, its probability, whether the text has a letter) of each text."""
        found, lettered = grams(texts)
        total = np.tile(self.prior, (len(texts), 1))
        step = max(1, (1 << 20) // max(1, len(self.languages)))
        for buckets, bounds in found:
            for i in range(0, len(buckets), step):
                j = min(i + step, len(buckets))
                lo, hi = int(np.searchsorted(bounds, i, "right")) - 1, int(np.searchsorted(bounds, j))
                at = np.maximum(bounds[lo:hi], i)
                some = np.minimum(bounds[lo + 1 : hi + 1], j) > at
                total[np.arange(lo, hi)[some]] += np.add.reduceat(self.scores[buckets[i:j]], at[some] - i, axis=0, dtype=np.float64)
        best = total.argmax(1)
        top = total[np.arange(len(best)), best]
        return best, 1 / np.exp(total - top[:, None]).sum(1), lettered


def _count(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in pieces_of(batch):
            found, _ = grams(part.column("text"))
            languages = np.array(part.column("lang").to_pylist(), object)
            for language in set(languages):
                row = sums.setdefault(language, np.zeros(1 << BUCKET_BITS, np.int64))
                for buckets, bounds in found:
                    row += np.bincount(buckets[np.repeat(languages == language, np.diff(bounds))], minlength=len(row))
    for language, row in sums.items():
        seen = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays([pa.array([language] * len(seen)), pa.array(seen.astype(np.int32)), pa.array(row[seen])], ["lang", "bucket", "n"])


def fit(examples: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model | None:
    """Fits on (doc_id, text, lang): at most ``rows_per_language`` rows of each language, chosen by a hash of the id; the
    prior is each language's share of all rows. None without a labelled text."""
    known = examples.where("lang IS NOT NULL AND text IS NOT NULL")
    shares = known.groupBy("lang").count().toPandas().sort_values("lang")  # one row per language
    if shares.empty:
        return None
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = known.select("lang", "doc_id").withColumn("rank", rank).where(F.col("rank") <= rows_per_language).select("lang", "doc_id").distinct()
    sample = known.join(F.broadcast(chosen), ["lang", "doc_id"], "left_semi").select("text", "lang")
    counts = sample.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = list(shares["lang"])
    table_ = np.full((1 << BUCKET_BITS, len(languages)), SMOOTHING)
    table_[counts.bucket, counts.lang.map({x: i for i, x in enumerate(languages)})] += counts.n
    scores = np.log(table_) - np.log(table_.sum(0))
    return Model(languages, scores.astype(np.float32), np.log((shares["count"] / shares["count"].sum()).to_numpy()))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score): the likeliest language of every whole text and its posterior probability.

    ``und`` with score 0 for a null text, a text without letters, or without a model. Repeated rows are predicted alike.
    """
    docs = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def score(batches):
        model = shared.value
        for batch in batches:
            for part in pieces_of(batch, 2 << 20):
                if model is None:
                    names, score = [UNKNOWN] * len(part), np.zeros(len(part))
                else:
                    best, chance, lettered = model.posterior(part.column("text"))
                    names = [model.languages[i] if ok else UNKNOWN for i, ok in zip(best, lettered, strict=True)]
                    score = np.where(lettered, chance, 0.0)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], schema.names)

    return docs.mapInArrow(score, schema)


def held_out(mod: int = HELD_OUT_MOD, rest: int = HELD_OUT_REST):
    """Whether crc32 of the id as text leaves ``rest``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % mod == rest


def op3_naive_bayes(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's language, learned from the rows that are not held out."""
    docs = table(spark, folder, "documents")
    model = fit(docs.select("doc_id", "text", "lang").where(~held_out()))
    return predict(docs, model).withColumn("held_out", held_out()).select("doc_id", "held_out", "lang_pred", "score")
