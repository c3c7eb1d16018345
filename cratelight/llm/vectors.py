"""Near-duplicate vectors: an inverted multi-index over the halves of the vectors, exact verification, components."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratelight.llm.common import components, discard, stored, table
from cratelight.llm.dedup import forest

LEAST = 0.93
RECALL = 0.999  # of pairs at LEAST exactly; closer pairs are found more surely
SAMPLE = 8192  # bound of the vectors that the codebooks and the margin are fitted on
IN_CELL, MOST_CENTRES = 256, 256
BLOCK = 2048
ROWS_PER_BIN = 8192


@dataclass
class Index:
    """For each width of vectors: two codebooks, and how far beyond its nearest cell a vector looks."""

    books: dict[int, tuple[np.ndarray, np.ndarray, float]]

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(own cell, visited cells flat, where each vector's begin) of unit vectors of one width.

        A cell is a pair of centres, and its distance the sum of two squared distances. The centres of each half are sorted by
        distance; the traversal takes the first half's in that order and with each as many of the second's as stay
        within the bound, and stops at the first that has none: the cells visited are the nearest ones, own cell included.
        """
        left, right, margin = self.books.get(unit.shape[1], (np.zeros((1, unit.shape[1] // 2)), np.zeros((1, unit.shape[1] - unit.shape[1] // 2)), 0.0))
        half = unit.shape[1] // 2
        one, two = squared(unit[:, :half], left), squared(unit[:, half:], right)
        order1, order2 = one.argsort(1, kind="stable"), two.argsort(1, kind="stable")
        one, two = np.take_along_axis(one, order1, 1), np.take_along_axis(two, order2, 1)
        bound = one[:, 0] + two[:, 0] + margin
        who, cell = [], []
        for a in range(one.shape[1]):
            fits = one[:, a, None] + two <= bound[:, None]
            fits[:, 0] |= a == 0
            rows, b = np.nonzero(fits)
            if not len(rows):
                break
            who.append(rows)
            cell.append(order1[rows, a] * two.shape[1] + order2[rows, b])
        who, cell = np.concatenate(who), np.concatenate(cell)
        by_row = np.argsort(who, kind="stable")
        return order1[:, 0] * two.shape[1] + order2[:, 0], cell[by_row], np.searchsorted(who[by_row], np.arange(len(unit) + 1))


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * (x @ centres.T)


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(10):
        near = squared(x, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        count = np.bincount(near, minlength=len(centres))
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def fit(sample: list[np.ndarray], rows: int, groups: int, least: float = LEAST, recall: float = RECALL, seed: int = 3) -> Index:
    """Codebooks of a bounded sample of unit vectors, for ``rows`` vectors in ``groups`` groups: about IN_CELL in a cell.

    The margin is measured on pairs at cosine ``least`` exactly, each vector of the sample with one in a random
    direction from it: the quantile ``recall`` of how much farther the other's cell is than the nearest.
    """
    rng, books = np.random.default_rng(seed), {}
    for width in {len(v) for v in sample}:
        x = np.array([v for v in sample if len(v) == width])
        k = int(min(max(1, math.ceil(math.sqrt(rows / max(groups, 1) / IN_CELL))), MOST_CENTRES, len(x)))
        half = width // 2
        left, right = (_codebook(part, k, rng) if part.shape[1] else np.zeros((1, 0)) for part in (x[:, :half], x[:, half:]))
        other = rng.standard_normal(x.shape)
        other -= (other * x).sum(1)[:, None] * x
        norm = np.linalg.norm(other, axis=1)[:, None]
        other = np.where(norm > 1e-9, other / np.maximum(norm, 1e-9), 0)
        y = least * x + math.sqrt(1 - least * least) * other
        one, two = squared(x[:, :half], left), squared(x[:, half:], right)
        i, j = squared(y[:, :half], left).argmin(1), squared(y[:, half:], right).argmin(1)
        at = np.arange(len(x))
        beyond = one[at, i] + two[at, j] - one.min(1) - two.min(1)
        books[width] = (left, right, float(np.quantile(beyond, recall, method="higher")))
    return Index(books)


def units(rows) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None for null, empty or zero vectors and those with null or non-finite components."""
    out = []
    for row in rows:
        if row is None:
            out.append(None)
            continue
        v = np.array([np.nan if x is None else x for x in row], np.float64)
        top = np.abs(v).max() if len(v) and np.isfinite(v).all() else 0.0
        if not top:
            out.append(None)
            continue
        v = v / top
        out.append(v / math.sqrt(float(v @ v)))
    return out


def _index(index, schema: T.StructType):
    def run(batches):
        for batch in batches:
            for i in range(0, len(batch), 1024):
                part = batch.slice(i, 1024)
                unit, label = units(part.column("embedding").to_pylist()), part.column("label").to_pylist()
                own, visits, content, packed = [None] * len(part), [None] * len(part), [None] * len(part), [None] * len(part)
                for width in {len(v) for v in unit if v is not None}:
                    rows = [r for r, v in enumerate(unit) if v is not None and len(v) == width and label[r] is not None]
                    if not rows:
                        continue
                    mine, flat, begin = index.value.cells(np.array([unit[r] for r in rows]))
                    for k, r in enumerate(rows):
                        own[r], visits[r], packed[r] = int(mine[k]), flat[begin[k] : begin[k + 1]].tolist(), unit[r].tobytes()
                        content[r] = hashlib.blake2b(packed[r] + str(label[r]).encode(), digest_size=16).digest()
                columns = [part.column("vec_id"), part.column("label"), pa.array(content, pa.binary()), pa.array(own, pa.int32()), pa.array(visits, pa.list_(pa.int32())), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return run


def _link(least: float):
    """For each (label, width, cell, member block, query block) of a bin: the links of every vector as counted here (a, n), and
    edges that join what the links join (a, b). A link that both of its vectors find is counted once for each."""

    def one(ids, times, own, visits, unit, query):
        members, queries = np.flatnonzero(~query), np.flatnonzero(query)
        hit = (unit[queries] @ unit[members].T) >= least
        hit &= ids[queries][:, None] != ids[members]
        q, m = np.nonzero(hit)
        q, m = queries[q], members[m]
        if not len(q):
            return [], []
        span = int(max(own.max(), max(v.max() for v in visits))) + 1
        codes = np.concatenate([k * span + visits[k] for k in np.unique(m)])
        alone = ~np.isin(m * span + own[q], codes)  # the member does not visit the query's cell
        n = np.bincount(q, times[m], len(ids)) + np.bincount(m[alone], times[q[alone]], len(ids))
        names, place = np.unique(np.concatenate([ids[q], ids[m]]), return_inverse=True)
        linked = np.zeros((len(names), len(names)), bool)
        linked[place[: len(q)], place[len(q) :]] = True
        linked |= linked.T
        counted = np.flatnonzero(n)
        return [(ids[k], None, int(n[k])) for k in counted], [(names[a], names[b], None) for a, b in forest(linked)]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in group.groupby(["group", "cell", "m_block", "q_block"], sort=True):
            unit = np.frombuffer(b"".join(part.unit), np.float64).reshape(len(part), -1)
            query = part["query"].to_numpy()
            if query.all() or not query.any():
                continue
            visits = [np.asarray(v, np.int64) for v in part.visits]
            counts, edges = one(part.node.to_numpy(), part.n.to_numpy(), part.own.to_numpy().astype(np.int64), visits, unit, query)
            out += counts + edges
        return pd.DataFrame(out, columns=["a", "b", "n"]).astype("Int64")

    return run


def near_vectors(vectors: DataFrame, least: float = LEAST, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector of (vec_id, embedding, label).

    Vectors of one label, not null, are linked at cosine >= ``least``, in double precision. Equal vectors are one node that
    stands for all of them. Every node lies in the cell of its nearest centres and visits the cells near it; a cell's members
    meet its visitors in blocks of about ``block``, and a block pair returns counts and a spanning forest, no pairs.
    Codebooks and margin come from at most SAMPLE vectors, chosen by a hash; every vector is indexed.

    Null, empty and zero vectors, those with null or non-finite components and those without a label have no links and are
    their own component, as have vectors of another width. A null id takes no part: no links, component null, kept. Rows that
    repeat an id and a vector count as so many vectors.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    usable = vectors.where("embedding IS NOT NULL AND label IS NOT NULL")
    rows, labels = usable.agg(F.count("*"), F.count_distinct("label")).first()
    drawn = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").collect()  # a stated bound
    index = fit([v for v in units(r.embedding for r in drawn) if v is not None], rows, labels, least, recall)
    schema = T.StructType([
        vectors.schema["vec_id"], vectors.schema["label"], T.StructField("content", T.BinaryType()), T.StructField("own", T.IntegerType()),
        T.StructField("visits", T.ArrayType(T.IntegerType())), T.StructField("unit", T.BinaryType())])
    indexed = stored(vectors.mapInArrow(_index(spark.sparkContext.broadcast(index), schema), schema), "indexed")
    known = indexed.where("content IS NOT NULL AND vec_id IS NOT NULL")
    first = F.first(F.struct("own", "visits", "unit")).alias("first")
    nodes = known.groupBy("label", "content").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"), first)
    group = F.xxhash64("label", F.length("first.unit"))
    nodes = stored(nodes.select(group.alias("group"), "content", "node", "n", "first.own", "first.visits", "first.unit"), "nodes")
    visited = nodes.select("group", F.explode("visits").alias("cell")).groupBy("group", "cell").agg(F.count("*").alias("queries"))
    filled = nodes.groupBy("group", F.col("own").alias("cell")).agg(F.count("*").alias("members"))
    cells = stored(filled.join(visited, ["group", "cell"]).select(
        "group", "cell", F.ceil(F.col("members") / block).alias("m_blocks"), F.ceil(F.col("queries") / block).alias("q_blocks"),
        (F.col("members") * F.ceil(F.col("queries") / block) + F.col("queries") * F.ceil(F.col("members") / block)).alias("rows")), "cells")
    columns = ["group", "node", "n", "own", "visits", "unit"]
    queries = nodes.select(*columns, F.explode("visits").alias("cell"), F.lit(True).alias("query"))
    both = nodes.select(*columns, F.col("own").alias("cell"), F.lit(False).alias("query")).union(queries).join(cells, ["group", "cell"])
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    mine = lambda n: F.array(F.pmod(F.xxhash64("node"), F.col(n)))
    dealt = both.withColumn("m_block", F.explode(F.when(F.col("query"), every("m_blocks")).otherwise(mine("m_blocks"))))
    dealt = dealt.withColumn("q_block", F.explode(F.when(F.col("query"), mine("q_blocks")).otherwise(every("q_blocks"))))
    size = cells.agg(F.sum("rows")).first()[0] or 0
    bins = max(1, -(-size // ROWS_PER_BIN))
    binned = dealt.drop("m_blocks", "q_blocks", "rows").groupBy(F.pmod(F.xxhash64("group", "cell", "m_block", "q_block"), F.lit(bins)).alias("bin"))
    found = stored(binned.applyInPandas(_link(least), "a long, b long, n long"), "found")
    counts = found.where("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    joined = components(found.where("n IS NULL"), "components")
    named = joined.join(stored(joined.groupBy("root").agg(F.min("id").alias("component")), "names"), "root").select(F.col("id").alias("node"), "component")
    told = nodes.select("content", "node", "n").join(counts, "node", "left").join(named, "node", "left")
    told = told.select("content", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("links"), F.coalesce("component", "node").alias("component"))
    told = stored(told.where("links > 0"), "told")
    result = indexed.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("content")).alias("content")).join(told, "content", "left")
    discard(nodes, cells, found)
    return result.select(
        "vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"))


def op1_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector's links and component."""
    return near_vectors(table(spark, folder, "embeddings"))
