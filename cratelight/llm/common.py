"""Helpers shared by the corpus operators: stored tables, distributed numbering, components, token hashes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cratelight.session import scratch_path

U64 = np.uint64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder in the shared scratch folder and read back: lost executors cost no replay."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Deletes the files of tables made by ``stored`` that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices_for(rows: int, rows_per_slice: int) -> int:
    return max(1, -(-rows // rows_per_slice))


def slice_of(digest: Column, slices: int) -> Column:
    """Which of ``slices`` equal ranges of hex digests holds ``digest``; grows with it, so slices keep its order."""
    return F.shiftright(F.conv(F.substring(digest, 1, 7), 16, 10).cast("long") * F.lit(slices), 28)


def running_total(df: DataFrame, group: str, digest: str, tie: list[str], size: Column, out: str, slices: int) -> DataFrame:
    """Adds ``out``: the sum of ``size`` over the rows of ``group`` that come earlier by ``digest`` and ``tie``.

    A group is cut into ``slices`` ranges of the digest. Each range is summed by itself and then moved by the sums of the
    ranges before it, so no task sorts a whole group. ``group`` must not be null.
    """
    cut = df.withColumn("_slice", slice_of(F.col(digest), slices)).withColumn("_size", size)
    sums = cut.groupBy(group, "_slice").agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(group, "_slice", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inner = Window.partitionBy(group, "_slice").orderBy(digest, *tie).rowsBetween(Window.unboundedPreceding, -1)
    own = cut.withColumn("_own", F.coalesce(F.sum("_size").over(inner), F.lit(0)))
    return own.join(offsets, [group, "_slice"]).withColumn(out, F.col("_own") + F.col("_offset")).drop("_slice", "_size", "_own", "_offset")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, root) of every end of ``edges`` (a, b): ends in one connected component share their root, which is one of them.

    Every vertex moves to the smallest of itself and its neighbours in the order of a hash, the moved edges are what is left,
    and so on until none is; in a random order the number of vertices falls by a constant factor a round. Aggregations
    combine before their shuffle and joins are between stored tables, where a vertex with very many edges can be split.
    """
    def pick(column: str) -> Column:
        return F.struct(F.xxhash64(column).alias("h"), F.col(column).alias("v"))

    left = stored(edges.select("a", "b").where("a <> b").distinct(), name)
    moves, spent = [], []
    while left.limit(1).count():
        both = left.union(left.select("b", "a"))
        nearest = both.groupBy("a").agg(F.min(pick("b")).alias("best"))
        move = stored(nearest.select(F.col("a").alias("id"), F.least("best", pick("a"))["v"].alias("root")), name)
        ends = left.join(move.toDF("a", "ra"), "a").join(move.toDF("b", "rb"), "b")
        spent.append(left)
        left = stored(ends.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), name)
        moves.append(move)
    if not moves:
        return left.select(F.col("a").alias("id"), F.col("b").alias("root"))
    roots = moves[0]
    for move in moves[1:]:
        step = move.toDF("root", "next")
        roots = roots.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root"))
    if len(moves) > 1:
        roots = stored(roots, name)
        spent += moves
    discard(*spent)
    return roots


# ---- token hashes -------------------------------------------------------------------------------------------------------

BASE = 0x9E3779B97F4A7C15 | 1  # odd, so that it has an inverse modulo 2**64
PIECE = 1 << 20
_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i up to PIECE."""
    if not _POWERS:
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            steps = np.full(PIECE + 1, base, U64)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _classes(kinds: bytes, marks: bool) -> np.ndarray:
    out = np.ones(256, np.uint8)
    out[list(kinds)] = 0
    if marks:
        keep = b"0123456789_" + bytes(range(65, 91)) + bytes(range(97, 123))
        out[[c for c in range(128) if c not in keep and out[c]]] = 2
    return out


BLANKS = b" \t\n\x0b\x0c\r"
WORDS = _classes(BLANKS, False)  # runs of anything but ASCII blanks
WORDS_AND_MARKS = _classes(BLANKS, True)  # runs of letters and digits (all non-ASCII bytes count as such), and runs of marks


@dataclass
class Tokens:
    """Tokens of a batch of texts in order: 64-bit hashes, first bytes, and where each text's tokens begin."""

    hashes: np.ndarray
    starts: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def text_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string array (null: empty) and the offset of each text in them."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and bounds[-1] else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def tokens(data: np.ndarray, bounds: np.ndarray, classes: np.ndarray = WORDS) -> Tokens:
    """Splits texts into runs of one class and hashes each run: a polynomial of its bytes modulo 2**64, then ``mix``."""
    kind = classes[data]
    first = np.empty(len(data), bool)
    if len(data):
        first[0] = True
        np.not_equal(kind[1:], kind[:-1], out=first[1:])
        inner = bounds[1:-1]
        first[inner[inner < len(data)]] = True
        first &= kind != 0
    starts = np.flatnonzero(first)
    del first
    power, inverse = _powers()
    hashes = np.empty(len(starts), U64)
    ends = np.append(starts[1:], len(data))
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        if hi - lo <= PIECE:
            part = data[lo:hi].astype(U64)
            part += U64(1)
            part[kind[lo:hi] == 0] = 0
            part *= power[: hi - lo]
            at = starts[i:j] - lo
            hashes[i:j] = np.add.reduceat(part, at) * inverse[at]
        else:  # one token longer than a piece
            total, shift = 0, 1
            for k in range(lo, hi, PIECE):
                part = data[k : min(k + PIECE, hi)].astype(U64) + U64(1)
                part[kind[k : min(k + PIECE, hi)] == 0] = 0
                total += shift * int(np.add.reduce(part * power[: len(part)]))
                shift = shift * int(power[PIECE]) % (1 << 64)
            hashes[i] = U64(total % (1 << 64))
        i = j
    return Tokens(mix(hashes), starts, np.searchsorted(starts, bounds))


def windows(found: Tokens, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each run of ``width`` tokens within a text, and where each text's runs begin. Shorter texts have none."""
    n = len(found.hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(len(found.bounds), np.int64)
    runs = np.zeros(n, U64)
    for k in range(width):
        runs = (runs + found.hashes[k : k + n]) * U64(BASE)
    counts = np.maximum(found.counts() - width + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    if bounds[-1] < n:
        keep = np.repeat(found.bounds[:-1] - bounds[:-1], counts) + np.arange(bounds[-1])
        runs = runs[keep]
    return mix(runs), bounds


def pieces_of(batch, limit: int = 8 << 20, column: str = "text"):
    """Row ranges of a record batch whose texts hold about ``limit`` bytes at most, or one row."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(lengths)])
    i = 0
    while i < len(lengths):
        j = max(i + 1, int(np.searchsorted(sums, sums[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def release() -> None:
    """Gives freed memory of this worker back to the system: workers are reused, and would keep the peak of an earlier stage."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
