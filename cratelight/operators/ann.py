"""Approximate nearest songs: inverted lists of a coarse quantiser, residuals as product-quantised codes, exact re-ranking.

The quantiser is fitted on a bounded sample; every vector is indexed. A search reads only the codes of the lists nearest to a
reference, ranks them by table look-ups in blocks of bounded rows, each reduced to its best inside the task, and reads the
vectors of the best of all alone, whose exact distances decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cratelight.functions.vectors import METRICS
from cratelight.operators.similarity import DECIMALS, _matrix, keep_nearest

SAMPLE = 20_000  # vectors that the quantiser is fitted on at most
MOST_LISTS = 4096
CODES = 256
PARTS = 8  # sub-vectors of a code
ROWS_PER_BLOCK = 50_000
FOLDERS = 16
GOAL = 0.985  # share of the sample's true neighbours that the visited lists must hold
ROUNDS = 8


def _unit(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of every row, in bounded steps."""
    squares, out = np.einsum("ij,ij->i", centres, centres), np.empty(len(rows), np.int64)
    for at in range(0, len(rows), 4096):
        out[at : at + 4096] = (squares - 2 * rows[at : at + 4096] @ centres.T).argmin(axis=1)
    return out


def _means(rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centres by Lloyd's rounds from random rows; a centre that loses all rows stays where it was."""
    centres = rows[rng.permutation(len(rows))[:k]].copy()
    for _ in range(ROUNDS):
        own = _nearest(rows, centres)
        order = np.argsort(own, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(own[order]) != 0))
        sums = np.add.reduceat(rows[order], first, axis=0)
        centres[own[order[first]]] = sums / np.diff(np.append(first, len(rows)))[:, None]
    return centres


@dataclass
class Quantiser:
    """Coarse centres, one book of residual codes for each part of a vector, how many lists a search visits, and how many of
    their members it compares exactly."""

    centres: np.ndarray
    books: np.ndarray
    probes: int
    rerank: int

    @property
    def width(self) -> int:
        return self.centres.shape[1]

    def parts(self, residuals: np.ndarray) -> np.ndarray:
        """Residuals cut into parts (part, row, value), padded with zeros to equal parts."""
        padded = np.zeros((len(residuals), self.books.shape[0] * self.books.shape[2]))
        padded[:, : residuals.shape[1]] = residuals
        return padded.reshape(len(residuals), self.books.shape[0], -1).transpose(1, 0, 2)

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The list and the codes of each vector of length 1."""
        cell = _nearest(unit, self.centres)
        codes = [_nearest(part, book) for part, book in zip(self.parts(unit - self.centres[cell]), self.books, strict=True)]
        return cell, np.stack(codes, axis=1).astype(np.uint8)

    def decode(self, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The vectors that lists and codes stand for."""
        parts = np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], axis=1)
        return self.centres[cell] + parts[:, : self.width]

    def visited(self, unit: np.ndarray) -> np.ndarray:
        """The ``probes`` nearest lists of each vector, nearest first."""
        far = np.einsum("ij,ij->i", self.centres, self.centres) - 2 * unit @ self.centres.T
        return np.argsort(far, axis=1, kind="stable")[:, : self.probes]

    def save(self, spark: SparkSession, path: str) -> None:
        row = (self.centres.tolist(), self.books.tolist(), self.probes, self.rerank)
        schema = "centres array<array<double>>, books array<array<array<double>>>, probes int, rerank int"
        spark.createDataFrame([row], schema).coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Quantiser:
        row = spark.read.parquet(path).first()
        return cls(np.array(row.centres), np.array(row.books), row.probes, row.rerank)


def fit(vectors: DataFrame, n: int = 5, sample: int = SAMPLE, goal: float = GOAL, seed: int = 7) -> Quantiser | None:
    """A quantiser for (sid, embedding), with about the root of the number of vectors as lists.

    It is fitted on at most ``sample`` vectors drawn by a hash of the sid. ``probes`` is the smallest number of lists that
    holds ``goal`` of the sample's own ``n`` nearest, ``rerank`` the smallest number of best codes that does. None where no
    vector has an element.
    """
    known = vectors.where(F.size("embedding") > 0).select("sid", "embedding")
    rows = known.count()
    if not rows:
        return None
    if rows > sample:
        known = known.where(F.pmod(F.xxhash64("sid"), F.lit(1 << 30)) < int(0.9 * sample / rows * (1 << 30)))
    found = known.limit(sample).toArrow().sort_by("sid")
    unit, rng = _unit(_matrix(found["embedding"])), np.random.default_rng(seed)
    lists = int(max(1, min(MOST_LISTS, rows**0.5, len(unit) / 8)))
    centres = _means(unit, lists, rng)
    step = -(-unit.shape[1] // PARTS)
    cutter = Quantiser(centres, np.zeros((PARTS, 1, step)), lists, n)
    residual = cutter.parts(unit - centres[_nearest(unit, centres)])
    books = np.stack([_means(part, min(CODES, len(unit)), rng) for part in residual])
    whole = Quantiser(centres, books, lists, n)
    asked = rng.permutation(len(unit))[:500]
    near = unit[asked] @ unit.T
    near[np.arange(len(asked)), asked] = -np.inf
    neighbours = np.argsort(-near, axis=1, kind="stable")[:, : min(n, len(unit) - 1)]
    place = np.argsort(whole.visited(unit[asked]), axis=1)  # of each list in the order of visits
    needed = np.take_along_axis(place, _nearest(unit, centres)[neighbours], axis=1)
    if needed.size:
        whole.probes = int(np.quantile(needed, goal, method="higher")) + 1
        coded = whole.decode(*whole.encode(unit))
        far = np.einsum("ij,ij->i", coded, coded) - 2 * unit[asked] @ coded.T
        far[np.arange(len(asked)), asked] = np.inf
        place = np.argsort(np.argsort(far, axis=1, kind="stable"), axis=1)
        whole.rerank = max(n, int(np.quantile(np.take_along_axis(place, neighbours, axis=1), goal, method="higher")) + 1)
    return whole


def build(vectors: DataFrame, path: str, quantiser: Quantiser) -> None:
    """Writes the index once: the quantiser, and the lists (sid, embedding, cell, codes), sorted by list in a few folders."""
    spark = vectors.sparkSession
    quantiser.save(spark, f"{path}/quantiser")
    rows = vectors.where(F.size("embedding") > 0).select("sid", "embedding")
    shared, schema = spark.sparkContext.broadcast(quantiser), f"sid {dict(rows.dtypes)['sid']}, embedding {dict(rows.dtypes)['embedding']}, cell int, codes binary"

    def encode(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                cell, codes = shared.value.encode(_unit(_matrix(part["embedding"])))
                yield pa.RecordBatch.from_arrays([part["sid"], part["embedding"], pa.array(cell, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary())], ["sid", "embedding", "cell", "codes"])

    folders = min(FOLDERS, len(quantiser.centres))
    listed = rows.mapInArrow(encode, schema).withColumn("folder", F.col("cell") % folders)
    # a crowded list is spread over tasks by its songs
    spread = listed.repartition("folder", F.pmod(F.xxhash64("sid"), F.lit(max(1, quantiser.probes // folders)))).sortWithinPartitions("folder", "cell")
    spread.write.partitionBy("folder").option("maxRecordsPerFile", 1_000_000).parquet(f"{path}/lists")


def asked_lists(refs: DataFrame, quantiser: Quantiser) -> DataFrame:
    """(seed, embedding, cell): each reference once for each list it visits."""
    rows = refs.where(F.size("embedding") > 0).select(F.col("sid").alias("seed"), "embedding")
    shared = refs.sparkSession.sparkContext.broadcast(quantiser)

    def visit(batches):
        for batch in batches:
            cells = shared.value.visited(_unit(_matrix(batch["embedding"]))) if batch.num_rows else np.zeros((0, 1), np.int64)
            at = pa.array(np.repeat(np.arange(batch.num_rows), cells.shape[1]))
            yield pa.RecordBatch.from_arrays([batch["seed"].take(at), batch["embedding"].take(at), pa.array(cells.ravel(), pa.int32())], ["seed", "embedding", "cell"])

    return rows.mapInArrow(visit, f"seed {dict(rows.dtypes)['seed']}, embedding {dict(rows.dtypes)['embedding']}, cell int")


def _meet(shared, keep: int):
    def run(refs: pa.Table, songs: pa.Table) -> pa.Table:
        kinds = [refs.schema.field("seed").type, songs.schema.field("sid").type, pa.float64()]
        if not refs.num_rows or not songs.num_rows:
            return pa.table([pa.array([], k) for k in kinds], ["seed", "sid", "far"])
        quantiser = shared.value
        ids = songs["sid"].to_numpy()
        codes = np.frombuffer(b"".join(songs["codes"].to_pylist()), np.uint8).reshape(len(ids), -1)
        seeds = refs["seed"].to_numpy()
        rows, cols, scores = [], [], []
        parts = np.arange(len(quantiser.books))
        for i, own in enumerate(quantiser.parts(_unit(_matrix(refs["embedding"])) - quantiser.centres[songs["cell"][0].as_py()]).transpose(1, 0, 2)):
            tables = ((quantiser.books - own[:, None, :]) ** 2).sum(axis=2)
            far = tables[parts, codes].sum(axis=1)
            far[ids == seeds[i]] = np.inf
            best = np.argpartition(far, keep - 1)[:keep] if len(far) > keep else np.arange(len(far))
            best = best[np.isfinite(far[best])]
            rows.append(np.full(len(best), i))
            cols.append(best)
            scores.append(far[best])
        rows, cols = np.concatenate(rows), np.concatenate(cols)
        return pa.table([refs["seed"].take(pa.array(rows)), pa.array(ids[cols], kinds[1]), pa.array(np.concatenate(scores))], ["seed", "sid", "far"])

    return run


def candidates(refs: DataFrame, path: str) -> DataFrame:
    """(seed, sid): of each reference the best songs by codes among the lists it visits. Only lists and codes are read."""
    spark = refs.sparkSession
    quantiser = Quantiser.load(spark, f"{path}/quantiser")
    asked, lists = asked_lists(refs, quantiser), spark.read.parquet(f"{path}/lists").select("sid", "cell", "codes")
    blocks = lists.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_BLOCK).cast("int").alias("blocks"))  # MOST_LISTS rows at most
    left = asked.join(F.broadcast(blocks), "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    sizes = blocks.select(F.col("cell").alias("cell"), F.col("blocks").alias("blocks"))
    right = lists.join(F.broadcast(sizes), "cell").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")).drop("blocks")
    shared = spark.sparkContext.broadcast(quantiser)
    schema = f"seed {dict(asked.dtypes)['seed']}, sid {dict(lists.dtypes)['sid']}, far double"
    met = left.groupBy("cell", "block").cogroup(right.groupBy("cell", "block")).applyInArrow(_meet(shared, quantiser.rerank), schema)
    place = F.row_number().over(Window.partitionBy("seed").orderBy("far", "sid"))
    return met.withColumn("place", place).where(F.col("place") <= quantiser.rerank).select("seed", "sid")


def search(refs: DataFrame, path: str, n: int = 5) -> DataFrame:
    """(seed, sid, distance, rank): about the ``n`` nearest songs of each reference (sid, embedding) by cosine distance, itself
    left out. Ties go to the smaller sid; references without elements find nothing."""
    found = candidates(refs, path)
    vectors = refs.sparkSession.read.parquet(f"{path}/lists").select("sid", F.col("embedding").alias("_v2"))
    asked = refs.select(F.col("sid").alias("seed"), F.col("embedding").alias("_v1"))
    score = F.round(METRICS["cosine"](F.col("_v1"), F.col("_v2")), DECIMALS)
    scored = found.join(vectors, "sid").join(asked, "seed").select("seed", "sid", score.alias("distance"))
    return keep_nearest(scored, n).select("seed", "sid", "distance", F.col("rank").cast("int").alias("rank"))


def share_read(vectors: DataFrame, path: str) -> float:
    """The share of the indexed vectors that is read for one reference."""
    songs = vectors.where(F.size("embedding") > 0).count()
    return Quantiser.load(vectors.sparkSession, f"{path}/quantiser").rerank / max(1, songs)
