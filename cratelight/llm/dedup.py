"""Near-duplicate documents: BagMinHash signatures of shingle multisets, banding, and exact verification of the overlap."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratelight.llm.common import BASE, U64, components, discard, mix, pieces_of, stored, table, text_bytes, tokens, windows

SHINGLE = 5
#: Two documents are linked if the overlap of their multisets is at least LEAST[0] / LEAST[1] of their union.
LEAST = (4, 5)
BANDS, ROWS = 40, 6  # a pair at 0.8 shares no band with probability 5e-6
#: Estimated similarity from which a text joins a leader's canopy, and from which it needs no canopy of its own. Distances obey
#: the triangle inequality, so two texts at 0.8 are in one canopy if NEAR <= CLOSE - 0.2; the rest is room for the estimate's error.
NEAR, CLOSE = 0.38, 0.7
BLOCK = 1024
BIN = 4096  # rows that are handled together, if their groups are small
COLUMNS = 2048
GOLDEN = U64(BASE)


def shingles(data: np.ndarray, bounds: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words of each text, and where a text's begin. A shorter text with words is one run."""
    found = tokens(data, bounds)
    runs, starts = windows(found, width)
    counts = found.counts()
    short = [k for k in range(1, width) if (counts == k).any()]
    if not short:
        return runs, starts
    text = [np.repeat(np.arange(len(counts)), np.diff(starts))]
    hashes = [runs]
    for k in short:
        some, begin = windows(found, k)
        own = np.flatnonzero(counts == k)
        text.append(own)
        hashes.append(mix(some[begin[:-1][own]] + U64(k)))
    order = np.argsort(np.concatenate(text), kind="stable")
    text = np.concatenate(text)[order]
    return np.concatenate(hashes)[order], np.searchsorted(text, np.arange(len(counts) + 1))


def multisets(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) of the distinct shingles of each text, by text."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    keys = hashes ^ mix(text.astype(U64) + U64(1))
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    weight = np.diff(np.append(first, len(keys)))
    at = order[first]
    by_text = np.argsort(text[at], kind="stable")
    return text[at][by_text], hashes[at][by_text], weight[by_text]


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, size: int) -> np.ndarray:
    """BagMinHash: (texts, size) numbers; those of two texts agree in each place with the probability of their weighted Jaccard.

    A weight w stands for the interval [0, w), cut at powers of two. Each piece [2**(k-1), 2**k) of each shingle holds a Poisson
    process of points, seeded by shingle and piece, whose rate is the piece's length; in the piece that w cuts, a point counts
    if its place in the piece lies below w. Each point belongs to one place of the signature, which keeps its earliest
    point. Points are drawn up to a horizon by which all places are filled with high probability; texts with a gap are drawn
    again up to twice that horizon, so nothing is approximate.
    """
    out = np.full((texts, size), np.inf)
    if not len(text):
        return out
    top = np.ceil(np.log2(weight)).astype(np.int64)  # pieces above the first
    owner = np.repeat(np.arange(len(weight)), top + 1)
    piece = np.arange(len(owner)) - np.repeat(np.cumsum(top + 1) - top - 1, top + 1)
    low = np.where(piece == 0, 0, 1 << np.maximum(piece - 1, 0))
    length = np.maximum(low, 1)
    seed = mix(shingle[owner] + piece.astype(U64) * GOLDEN)
    whose, limit, cut = text[owner], weight[owner], weight[owner] < low + length
    total = np.bincount(text, weights=weight, minlength=texts)
    horizon = (np.log(size) + 2.0) / np.maximum(total, 1)
    gaps = total > 0
    while gaps.any():
        live = np.flatnonzero(gaps[whose]) if not gaps.all() else np.arange(len(whose))
        time, count = np.zeros(len(live)), 0
        while len(live):
            draw = mix(seed[live] + U64((count + 1) * BASE % (1 << 64)))
            time = time - np.log(((draw >> U64(11)) + U64(1)).astype(np.float64) * 2.0**-53) / (size * length[live])
            go = time < horizon[whose[live]]
            live, time, draw = live[go], time[go], draw[go]
            spot = mix(draw ^ GOLDEN)
            place = ((spot >> U64(32)) * U64(size) >> U64(32)).astype(np.int64)
            inside = ~cut[live]
            if not inside.all():
                at = low[live] + ((spot & U64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * length[live])
                inside |= at < limit[live]
                np.minimum.at(out.reshape(-1), whose[live][inside] * size + place[inside], time[inside])
            else:
                np.minimum.at(out.reshape(-1), whose[live] * size + place, time)
            count += 1
        gaps = gaps & np.isinf(out).any(1)
        horizon = horizon * 2
    return out


def bands(signature: np.ndarray, count: int, rows: int) -> np.ndarray:
    """A 64-bit key of each band of each text."""
    cells = signature.view(U64).reshape(len(signature), count, rows)
    key = np.zeros(cells.shape[:2], U64) + np.arange(1, count + 1, dtype=U64) * U64(0xD1B54A32D192ED03)
    for k in range(rows):
        key = mix(key ^ cells[:, :, k])
    return key


def _sketch(count: int, rows: int, schema: T.StructType):
    def sketch(batches):
        for batch in batches:
            for part in pieces_of(batch, 4 << 20):
                hashes, bounds = shingles(*text_bytes(part.column("text")))
                text, shingle, weight = multisets(hashes, bounds)
                signature = signatures(text, shingle, weight, len(part), count * rows)
                keys = bands(signature, count, rows)
                bytes_ = (mix(signature.view(U64)) >> U64(56)).astype(np.uint8).tobytes()
                marks = pa.array([bytes_[i : i + count * rows] for i in range(0, len(bytes_), count * rows)], pa.binary())
                some = np.diff(bounds) > 0
                sums = np.zeros((2, len(part)), U64)
                for k, salt in enumerate((1, 2)):
                    np.add.at(sums[k], text, mix(shingle ^ U64(salt)) * weight.astype(U64))
                names = np.ascontiguousarray(sums.T).tobytes()
                content = pa.array([names[16 * i : 16 * i + 16] if ok else None for i, ok in enumerate(some)], pa.binary())
                flat = pa.array(keys[some].view(np.int64).reshape(-1))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * count)]).astype(np.int32)), flat)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), content, lists, marks], schema.names)

    return sketch


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what the symmetric matrix ``linked`` joins, one fewer than the members of each component."""
    edges, seen = [], ~linked.any(1)
    for start in range(len(linked)):
        if seen[start]:
            continue
        seen[start], stack = True, [start]
        while stack:
            u = stack.pop()
            new = np.flatnonzero(linked[u] & ~seen)
            seen[new] = True
            edges += [(u, int(v)) for v in new]
            stack.extend(int(v) for v in new)
    return edges


def stars(edges: np.ndarray) -> pd.DataFrame:
    """Edges (a, b) that join what ``edges`` (rows of two ids) join: from the smallest id of each component to each other."""
    names, ends = np.unique(edges, return_inverse=True)
    ends = ends.reshape(-1, 2)
    label = np.arange(len(names))
    while True:
        before = label.copy()
        np.minimum.at(label, ends[:, 0], label[ends[:, 1]])
        np.minimum.at(label, ends[:, 1], label[ends[:, 0]])
        label = label[label]
        if (label == before).all():
            break
    others = np.flatnonzero(label != np.arange(len(names)))
    return pd.DataFrame({"a": names[label[others]], "b": names[others]}, dtype="int64")


def _canopies(group: pd.DataFrame) -> pd.DataFrame:
    """Edges that join the texts of each canopy of each band key of the group. The first text that is close to no leader yet
    becomes one, and every text near it joins it, whether it has a leader or not."""
    group = group.sort_values(["key", "one", "two", "node"], kind="stable")
    node = group.node.to_numpy()
    marks = np.frombuffer(b"".join(group.marks), np.uint8).reshape(len(group), -1)
    keys = group[["key", "one", "two"]].to_numpy()
    first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
    size = np.diff(np.append(first, len(group)))
    pair = first[size == 2]
    near = (marks[pair] == marks[pair + 1]).mean(1) >= NEAR
    edges = [np.stack([node[pair[near]], node[pair[near] + 1]], 1)]
    for at, n in zip(first[size > 2], size[size > 2], strict=True):
        own, free = marks[at : at + n], np.ones(n, bool)
        while free.any():
            leader = int(free.argmax())
            alike = (own == own[leader]).mean(1)
            joined = np.flatnonzero(alike >= NEAR)
            free &= alike < CLOSE
            free[leader] = False
            edges.append(np.stack([np.full(len(joined), node[at + leader]), node[at + joined]], 1))
    return stars(np.concatenate(edges))


def overlaps(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, split: int = 0) -> np.ndarray:
    """The sum of the smaller weights of every two texts; with ``split``, of each text before it with each from it on. A weight w
    counts as w elements of weight 1, so it is a product of 0-1 matrices, taken over a few thousand columns at a time."""
    owner = np.repeat(np.arange(len(weight)), weight)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(weight) - weight, weight)
    _, column, holders = np.unique(mix(shingle[owner] + level.astype(U64) * GOLDEN), return_inverse=True, return_counts=True)
    shared = holders[column] > 1
    rank = np.cumsum(holders > 1) - 1
    row, column = text[owner][shared], rank[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((split or texts, texts - split), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, width, COLUMNS):
        i, j = np.searchsorted(column, [lo, lo + COLUMNS])
        part = np.zeros((texts, min(COLUMNS, width - lo)), np.float32)
        part[row[i:j], column[i:j] - lo] = 1
        both += part[: split or texts] @ part[split:].T
    return both


def _verify(least: tuple[int, int]):
    def one_block_pair(ids: np.ndarray, blocks: np.ndarray, texts) -> list[tuple[int, int]]:
        split = int((blocks == blocks.min()).sum()) % len(ids)  # 0: all in one block
        text, shingle, weight = multisets(*shingles(*text_bytes(pa.array(texts, pa.string()))))
        both = overlaps(text, shingle, weight, len(ids), split).astype(np.float64)
        total = np.bincount(text, weights=weight, minlength=len(ids))
        union = total[: split or len(ids), None] + total[split:] - both
        part = (least[1] * both >= least[0] * union) & (both > 0)
        linked = np.zeros((len(ids), len(ids)), bool)
        linked[: split or len(ids), split:] = part
        linked |= linked.T
        np.fill_diagonal(linked, False)
        return [(ids[a], ids[b]) for a, b in forest(linked)]

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["root", "one", "two", "block", "doc_id"], kind="stable")
        keys = group[["root", "one", "two"]].to_numpy()
        first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
        ids, blocks, texts, edges = group.doc_id.to_numpy(), group.block.to_numpy(), list(group.text), []
        for i, j in zip(first, np.append(first[1:], len(group)), strict=True):
            edges += one_block_pair(ids[i:j], blocks[i:j], texts[i:j])
        return stars(np.array(edges, np.int64).reshape(-1, 2))

    return verify


def _in_blocks(rows: DataFrame, group: str, blocks: str, by: str) -> DataFrame:
    """Each row once for every pair of blocks (one, two) of its group that its own block is in; ``block`` is that."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    placed = rows.withColumn("block", F.pmod(F.xxhash64(by), blocks)).withColumn("other", other)
    return placed.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other")).drop("other", blocks)


def _binned(rows: DataFrame, keys: list[str], size: int, per_bin: int = BIN):
    """``rows`` grouped so that small groups share a call: by a hash of the keys into bins of about ``per_bin`` rows."""
    return rows.groupBy(F.pmod(F.xxhash64(*keys), F.lit(max(1, -(-size // per_bin)))).alias("bin"))


def classes(docs: DataFrame, count: int = BANDS, rows: int = ROWS, least: tuple[int, int] = LEAST, block: int = BLOCK) -> DataFrame:
    """(doc_id, class_id, kept): documents linked by weighted Jaccard of 0.8 or more over multisets of five-word shingles, and
    by chains of links, share a class, named after its smallest id; ``kept`` marks the row of that id.

    Equal multisets are one node, so copies cost nothing further. The nodes of a band key are sorted into canopies by their
    signatures' agreement, and canopies that share a node form a cluster. Within a cluster every two nodes are compared exactly,
    in blocks of about ``block`` texts, and a block pair returns a spanning forest of its links, never the pairs. A large key or
    cluster of n texts costs n / ``block`` copies of each. A link is missed only if its pair shares no band and no chain of
    canopies either: 5e-6 at similarity 0.8, less above.

    A text of one to four words is one shingle. Null texts and texts without words are linked with nothing. A null id takes
    no part: class null, kept. Rows that repeat an id count as one document. Columns other than doc_id and text are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("content", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("marks", T.BinaryType())])
    sketched = stored(docs.mapInArrow(_sketch(count, rows, schema), schema), "sketches")
    known = sketched.where("content IS NOT NULL AND doc_id IS NOT NULL")
    first = F.first(F.struct("bands", "marks"))
    nodes = known.groupBy("content").agg(F.min("doc_id").alias("node"), F.count("*").alias("n"), first.alias("sketch"))
    nodes = stored(nodes.select("content", "node", "n", "sketch.bands", "sketch.marks"), "nodes")
    dealt = nodes.select("node", F.explode("bands").alias("key"))
    keys = stored(dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / block).alias("blocks")), "keys")
    alike = stored(_in_blocks(dealt.join(keys, "key"), "key", "blocks", "node").select("node", "key", "one", "two"), "alike")
    marked = alike.join(nodes.select("node", "marks"), "node")
    near = _binned(marked, ["key", "one", "two"], alike.count()).applyInPandas(_canopies, "a long, b long")
    clusters = components(near, "clusters")
    sizes = stored(clusters.groupBy("root").agg(F.ceil(F.count("*") / block).alias("blocks")).where("blocks > 1"), "sizes")
    members = clusters.join(sizes, "root", "left").select(F.col("id").alias("doc_id"), "root", F.coalesce("blocks", F.lit(1).cast("long")).alias("blocks"))
    members = stored(members, "members")
    paired = _in_blocks(docs.join(members, "doc_id"), "root", "blocks", "doc_id")
    links = _binned(paired, ["root", "one", "two"], members.count(), 256).applyInPandas(_verify(least), "a long, b long")
    joined = components(links, "classes")
    named = stored(joined.join(stored(joined.groupBy("root").agg(F.min("id").alias("class_id")), "names"), "root").select(F.col("id").alias("node"), "class_id"), "named")
    copies = stored(nodes.where("n > 1").select("content", "node"), "copies")
    own = sketched.select("doc_id", "content").join(copies, "content", "left").select("doc_id", F.coalesce("node", "doc_id").alias("node"))
    result = own.join(named, "node", "left").select("doc_id", F.coalesce("class_id", "node").alias("class_id"))
    discard(nodes, keys, alike)
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns; of rows that repeat an id and text, one."""
    found = stored(classes(docs), "classes")
    keep = found.where("kept AND doc_id IS NOT NULL").select("doc_id")
    gone = stored(found.where("NOT kept").select("doc_id").distinct().join(keep, "doc_id", "left_anti"), "gone")
    again = stored(found.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    kept = docs.where("doc_id IS NOT NULL").join(gone, "doc_id", "left_anti")
    single = kept.join(again, "doc_id", "left_anti")
    several = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return single.union(several).union(docs.where("doc_id IS NULL"))


def op4_bag_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's class of near-duplicates."""
    return classes(table(spark, folder, "documents"))
