"""A prefix trie of conversations: z-fast tries built in batches inside tasks, expanded to one row per prefix and merged.

A prefix is named by a chained 128-bit digest of its turns, so its text is never carried.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratelight.llm.common import stored, table

NAME = 16  # bytes of a digest
ROOT = bytes(NAME)
NODES_PER_TRIE = 100_000
IDS_PER_CHUNK_BITS = 12
PATHS = "conv_id long, heads binary, chars array<int>"
PARTIAL = "node binary, parent binary, depth int, conv_id long, n_convs long, chars int"


def sequences(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns (digest of role and text, code points of the text) in the order of turn.

    A null turn comes first, turns of one number come in the order of their digests, null role and text are empty, repeated
    rows are turns of their own, and rows without conv_id belong to no conversation. Texts end here: what is grouped is about
    40 bytes a turn.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct("turn", said.alias("digest"), F.char_length(text).alias("chars"))
    known = rows.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    ordered = F.sort_array(F.collect_list("t"))
    return known.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["digest"], t["chars"])).alias("turns"))


def _chain(batches):
    """Names of all prefixes of each conversation, the root's first, one after the other in one binary."""
    for batch in batches:
        heads, chars = [], []
        for turns in batch.column("turns").to_pylist():
            name, names = ROOT, [ROOT]
            for t in turns:
                name = hashlib.blake2b(name + t["digest"], digest_size=NAME).digest()
                names.append(name)
            heads.append(b"".join(names))
            chars.append([t["chars"] for t in turns])
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(heads, pa.binary()), pa.array(chars, pa.list_(pa.int32()))], ["conv_id", "heads", "chars"])


def paths_of(convs: DataFrame) -> DataFrame:
    return convs.mapInArrow(_chain, PATHS)


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that the largest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


@dataclass
class Node:
    """A compacted node: the path from depth ``start`` (exclusive) to ``extent`` of one conversation through it."""

    heads: bytes
    chars: list[int]
    start: int
    extent: int
    ends: int = 0
    smallest: int | None = None
    children: dict[bytes, Node] = field(default_factory=dict)

    def name(self, depth: int) -> bytes:
        return self.heads[NAME * depth : NAME * depth + NAME]

    def handle(self) -> bytes:
        return self.name(two_fattest(self.start, self.extent))


class ZFastTrie:
    """Compacted trie whose nodes are found by the prefix at the two-fattest depth of their edge.

    A conversation's exit is found by a binary search over depths that always tries the two-fattest one, so it takes as many
    look-ups as the logarithm of its length, whatever the trie holds.
    """

    def __init__(self) -> None:
        self.root = Node(ROOT, [], -1, 0)
        self.handles: dict[bytes, Node] = {}
        self.size = 1

    def locate(self, heads: bytes, length: int, node: Node | None = None) -> Node:
        """The deepest node whose whole path begins the conversation, searched below ``node``."""
        node = node or self.root
        low, high = node.extent, length
        while low < high:
            depth = two_fattest(low, high)
            found = self.handles.get(heads[NAME * depth : NAME * depth + NAME])
            if found is None:
                high = depth - 1
            elif found.extent <= length and found.name(found.extent) == heads[NAME * found.extent : NAME * found.extent + NAME]:
                node, low = found, found.extent
            else:  # leaves the trie on the edge of this node, so no deeper one matches
                high = depth - 1
        return node

    def insert(self, heads: bytes, chars: list[int], conv_id: int, below: Node | None = None) -> None:
        length = len(chars)
        node = self.locate(heads, length, below)
        if node.extent < length:
            step = heads[NAME * (node.extent + 1) : NAME * (node.extent + 2)]
            edge = node.children.get(step)
            if edge is not None:
                node = self._split(node, edge, step, heads, length)
            if node.extent < length:
                leaf = Node(heads, chars, node.extent, length)
                node.children[heads[NAME * (node.extent + 1) : NAME * (node.extent + 2)]] = leaf
                self.handles[leaf.handle()] = leaf
                self.size += 1
                node = leaf
        node.ends += 1
        node.smallest = conv_id if node.smallest is None else min(node.smallest, conv_id)

    def _split(self, node: Node, edge: Node, step: bytes, heads: bytes, length: int) -> Node:
        """A new node where the conversation leaves ``edge``; prefixes agree up to there and nowhere below."""
        low, high = node.extent + 1, min(edge.extent, length)
        while low < high:
            depth = (low + high + 1) // 2
            if edge.name(depth) == heads[NAME * depth : NAME * depth + NAME]:
                low = depth
            else:
                high = depth - 1
        del self.handles[edge.handle()]
        middle = Node(edge.heads, edge.chars, node.extent, low)
        node.children[step] = middle
        edge.start = low
        middle.children[edge.name(low + 1)] = edge
        self.handles[middle.handle()] = middle
        self.handles[edge.handle()] = edge
        self.size += 1
        return middle

    def insert_batch(self, batch: list[tuple[bytes, list[int], int]]) -> None:
        """Finds all exits in the trie as it stands, then inserts exit by exit; each search goes on from its exit."""
        exits: dict[int, tuple[Node, list]] = {}
        for row in batch:
            node = self.locate(row[0], len(row[1]))
            exits.setdefault(id(node), (node, []))[1].append(row)
        for node, rows in exits.values():
            for heads, chars, conv_id in rows:
                self.insert(heads, chars, conv_id, node)

    def expanded(self):
        """(node, parent, depth, conv_id, n_convs, chars) of every prefix: the nodes and all depths along their edges."""
        order, todo = [], [self.root]
        while todo:
            node = todo.pop()
            order.append(node)
            todo.extend(node.children.values())
        total: dict[int, tuple[int, int]] = {}
        for node in reversed(order):
            below = [total[id(child)] for child in node.children.values()]
            ids = [b[1] for b in below] + ([node.smallest] if node.ends else [])
            total[id(node)] = (node.ends + sum(b[0] for b in below), min(ids))
        for node in order:
            n, smallest = total[id(node)]
            if node is self.root:
                yield ROOT, None, 0, smallest, n, 0
            for depth in range(node.start + 1, node.extent + 1) if node is not self.root else ():
                yield node.name(depth), node.name(depth - 1), depth, smallest, n, node.chars[depth - 1]


def _tries(nodes_per_trie: int):
    schema = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("chars", pa.int32())])

    def emitted(trie: ZFastTrie):
        rows = []
        for row in trie.expanded():
            rows.append(row)
            if len(rows) == 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    def run(batches):
        trie = ZFastTrie()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                trie.insert_batch(list(zip(part.column("heads").to_pylist(), part.column("chars").to_pylist(), part.column("conv_id").to_pylist(), strict=True)))
                if trie.size >= nodes_per_trie:
                    yield from emitted(trie)
                    trie = ZFastTrie()
        if trie.root.ends or trie.root.children:
            yield from emitted(trie)

    return run


def _hash_runs(batches):
    """SHA-256 of the joined chunks of each node; rows come sorted, and only the running digest is kept."""
    node, digest = None, None
    for batch in batches:
        done = []
        for own, text in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if own != node:
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = own, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["node", "ends_sha256"])


def end_hashes(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256): the ids of the conversations that end at a node, ascending, comma-joined and hashed.

    Ids are first joined in chunks of neighbouring ids, so what one task reads in sequence for a very common conversation is
    a few long strings; the hash itself is sequential by definition and keeps only its state.
    """
    last = F.expr(f"substring(heads, length(heads) - {NAME - 1}, {NAME})")
    ids = F.sort_array(F.collect_list("conv_id"))
    chunks = paths.groupBy(last.alias("node"), F.shiftright("conv_id", IDS_PER_CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.transform(ids, lambda i: i.cast("string")), ",").alias("ids"))
    return chunks.repartition("node").sortWithinPartitions("node", "chunk").select("node", "ids").mapInArrow(_hash_runs, "node binary, ends_sha256 string")


def merged_nodes(paths: DataFrame, nodes_per_trie: int = NODES_PER_TRIE) -> DataFrame:
    """(node, parent, depth, conv_id, n_convs, chars) of every distinct prefix of all ``paths``."""
    partial = paths.mapInArrow(_tries(nodes_per_trie), PARTIAL)
    return partial.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.min("chars").alias("chars"))


def prefix_tree(convs: DataFrame, nodes_per_trie: int = NODES_PER_TRIE) -> DataFrame:
    """One row per distinct prefix of the conversations (conv_id, turns): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Each task inserts its conversations into z-fast tries of about ``nodes_per_trie`` nodes and hands on their expanded
    nodes, which are summed by name. The nodes of one smallest member are a chain; sums over subtrees are running sums up
    the chain plus the totals of the chains hanging below, sent once to each prefix above them. So nothing is repeated level
    by level. No conversation gives no node; conversations without turns are members of the root alone.
    """
    paths = stored(paths_of(convs), "paths")
    nodes = stored(merged_nodes(paths, nodes_per_trie), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    chains = stored(counted.select(
        "*", F.min("depth").over(Window.partitionBy("conv_id")).alias("top"),
        F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).over(below).alias("own_leaves"),
        F.sum((F.col("n_convs") - 1) * F.col("chars")).over(below).alias("own_saved"),
    ), "chains")
    tops = chains.where("depth = top AND depth > 0").select("conv_id", "depth", "own_leaves", "own_saved")
    above = tops.join(paths.select("conv_id", "heads"), "conv_id").select(F.explode(F.sequence(F.lit(0), F.col("depth") - 1)).alias("i"), "heads", "own_leaves", "own_saved")
    hung = above.groupBy(F.expr(f"substring(heads, {NAME} * i + 1, {NAME})").alias("node")).agg(F.sum("own_leaves").alias("leaves"), F.sum("own_saved").alias("saved"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = chains.join(hung, "node", "left").join(end_hashes(paths), "node", "left").join(parents, "parent", "left")

    def long(name: str, other: str):
        return (F.col(name) + F.coalesce(other, F.lit(0).cast("long"))).cast("long")

    return whole.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", long("own_leaves", "leaves").alias("n_leaves"),
        long("own_saved", "saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def rebuilt(convs: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Conversations that begin like the first of their block: the first h turns of conversation c - c % block (all if fewer,
    none if absent), then the own turns after the first h, with h = crc32(c as text) % most."""
    first = convs.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("shared"))
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    own = convs.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % block).alias("base"), h.alias("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    shared = F.coalesce(F.slice("shared", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return own.join(first, "base", "left").select("conv_id", F.concat(shared, rest).alias("turns"))


def op11_zfast_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The prefix tree of all rebuilt conversations."""
    return prefix_tree(rebuilt(stored(sequences(table(spark, folder, "conversations")), "sequences")))


OP11_SQL = """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest, chars) AS pos, digest, chars
  FROM (SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
          md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
        FROM conversations WHERE conv_id IS NOT NULL)),
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, 3988292384 * (acc & 1)) END), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
joined AS (
  SELECT i.conv_id, 0 AS part, t.pos, t.digest, t.chars FROM ids i JOIN turns t ON t.conv_id = i.base AND t.pos <= i.h
  UNION ALL
  SELECT i.conv_id, 1, t.pos, t.digest, t.chars FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.pos > i.h),
placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, digest, chars FROM joined),
prefixes AS (
  SELECT conv_id, depth, chars, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth) AS prefix FROM placed
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
lengths AS (SELECT conv_id, max(depth) AS n FROM prefixes GROUP BY conv_id),
nodes AS (
  SELECT p.depth, p.prefix, min(p.conv_id) AS conv_id, count(*) AS n_convs, min(p.chars) AS chars,
    sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (l.n = p.depth), '')) AS ends_sha256
  FROM prefixes p JOIN lengths l USING (conv_id) GROUP BY p.depth, p.prefix),
linked AS (
  SELECT n.*, up.conv_id AS parent_conv_id, up.prefix AS parent
  FROM nodes n LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.prefix = left(n.prefix, 32 * (n.depth - 1)::INT)),
children AS (SELECT depth - 1 AS depth, parent AS prefix, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL),
sums AS (
  SELECT a.depth, a.prefix, count(*) FILTER (c.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars)::BIGINT AS saved_tokens
  FROM nodes n JOIN prefixes a ON a.conv_id = n.conv_id AND a.depth <= n.depth
  LEFT JOIN children c ON c.depth = n.depth AND c.prefix = n.prefix GROUP BY a.depth, a.prefix)
SELECT l.conv_id, l.depth, l.parent_conv_id, l.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, l.ends_sha256
FROM linked l JOIN sums s USING (depth, prefix) LEFT JOIN children c USING (depth, prefix)
"""
