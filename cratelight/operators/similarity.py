"""Exact nearest songs: one pass for a few references, block by block for many.

No pair of songs is ever shuffled. Few references travel to the rows: each task keeps its own best n and only those
are merged. Many references go to cells around pivots (``pivots``). Songs of given cells meet in blocks of bounded bytes; each block pair
is one matrix product that is reduced to the best n before it leaves the task, so a hot group only means more block pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratelight.functions.vectors import METRICS, cosine_of
from cratelight.session import bounded_rows, written

DECIMALS = 6  # distances are compared at the precision of the stored vectors, so copies tie
FEW_REFERENCES = 1024
BLOCK_ROWS = 4096
BLOCK_BYTES = 16 << 20
CHUNK_ROWS = 2048
DIRECT_VALUES = 1 << 22
MANY_CELLS = 200_000
FEW_PAIRS = 1 << 16
MANY_IDS = 1 << 20
CELL_PAIRS = 1 << 21
PAIR_ROWS = 1 << 14


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    widths = values.value_lengths().to_numpy(zero_copy_only=False)
    if len(widths) and (widths != widths[0]).any():
        raise ValueError("vectors of one comparison must have one width")
    elements = values.flatten()
    if elements.null_count:
        raise ValueError("vectors must not hold NULL elements")
    flat = elements.to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1)


def _prepared(column: pa.ChunkedArray | pa.Array, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and their squared lengths; for cosine the vectors are scaled to length 1 (a zero vector stays zero)."""
    matrix = _matrix(column) if not isinstance(column, np.ndarray) else column
    squares = np.einsum("ij,ij->i", matrix, matrix)
    if metric == "cosine":
        lengths = np.sqrt(squares)[:, None]
        matrix = np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)
    return matrix, squares


def _products(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], metric: str) -> np.ndarray:
    """What orders all pairs of two prepared sides, from one matrix product: 1 - cosine, or the squared distance.

    The squared distance loses digits where the vectors are long and close; it only serves to choose candidates.
    """
    dist = left[0] @ right[0].T
    if metric == "cosine":
        return np.subtract(1.0, dist, out=dist)
    dist *= -2.0
    dist += left[1][:, None]
    dist += right[1][None, :]
    return dist


def _slack(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], metric: str) -> np.ndarray:
    """For each left vector, how far ``_products`` can be off."""
    unit = 4 * np.finfo(np.float64).eps * max(left[0].shape[1], 8)
    if metric == "cosine":
        return np.full(len(left[0]), unit)
    return unit * (left[1] + right[1].max(initial=0.0))


def _direct(left: np.ndarray, right: np.ndarray, rows: np.ndarray, cols: np.ndarray, metric: str) -> np.ndarray:
    """The distances of chosen pairs, from the components."""
    out = np.empty(len(rows))
    step = max(1, DIRECT_VALUES // max(1, left.shape[1]))
    for at in range(0, len(rows), step):
        a, b = left[rows[at : at + step]], right[cols[at : at + step]]
        out[at : at + step] = 1.0 - np.einsum("ij,ij->i", a, b) if metric == "cosine" else np.sqrt(np.einsum("ij,ij->i", a - b, a - b))
    return out


def _best(rows: np.ndarray, ids: np.ndarray, dist: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n closest candidates of every row number, ties by id."""
    order = np.lexsort((ids, dist, rows))
    rows, ids, dist = rows[order], ids[order], dist[order]
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))
    keep = rank < n
    return rows[keep], ids[keep], dist[keep]


def _closest(dist: np.ndarray, n: int, slack: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of every finite value that can be among the n smallest of its row once rounded."""
    if n >= dist.shape[1]:
        return np.nonzero(np.isfinite(dist))
    limit = dist.min(axis=1) if n == 1 else np.partition(dist, n - 1, axis=1)[:, n - 1]
    rounding = 2 * 10.0**-DECIMALS
    if metric == "cosine":
        reach = limit + rounding + 2 * slack
    else:
        reach = (np.sqrt(np.maximum(limit + slack, 0.0)) + rounding) ** 2 + slack
    return np.nonzero(dist <= np.minimum(reach, np.finfo(np.float64).max)[:, None])


class _Running:
    """The best n per reference over the chunks seen so far."""

    def __init__(self, n: int, metric: str):
        self.n, self.metric, self.rows, self.ids, self.dist = n, metric, None, None, None

    def add(self, dist: np.ndarray, ids: np.ndarray, left: tuple, right: tuple, first_row: int = 0) -> None:
        """``dist`` are the products of both sides, infinite where a pair is not allowed."""
        rows, cols = _closest(dist, self.n, _slack(left, right, self.metric), self.metric)
        exact = _direct(left[0], right[0], rows, cols, self.metric)
        parts = rows + first_row, ids[cols], np.maximum(np.round(exact, DECIMALS), 0.0) + 0.0
        if self.rows is not None:
            parts = [np.concatenate(pair) for pair in zip((self.rows, self.ids, self.dist), parts)]
        if len(parts[0]):
            self.rows, self.ids, self.dist = _best(*parts, self.n)

    def table(self, seeds: pa.Array, id_type: pa.DataType) -> pa.Table:
        found = self.rows is not None
        return pa.table({
            "seed": seeds.take(pa.array(self.rows)) if found else seeds.slice(0, 0),
            "sid": pa.array(self.ids if found else [], id_type),
            "distance": pa.array(self.dist if found else [], pa.float64()),
        })


def _id_type(df: DataFrame, column: str = "sid") -> str:
    return dict(df.dtypes)[column]


def _few(vectors: DataFrame, refs: list, n: int, metric: str, schema: str) -> DataFrame:
    ref_ids = [row["sid"] for row in refs]
    ref_matrix = np.array([row["embedding"] for row in refs], dtype=np.float64)
    shared = vectors.sparkSession.sparkContext.broadcast((ref_ids, ref_matrix))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = shared.value
        prepared = _prepared(matrix, metric)
        best, id_type = _Running(n, metric), None
        row_of = {name: i for i, name in enumerate(names)}
        for batch in batches:
            id_type = batch.schema.field("sid").type
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                ids = part["sid"].to_numpy(zero_copy_only=False)
                songs = _prepared(part["embedding"], metric)
                dist = _products(prepared, songs, metric)
                own = [(row_of[i], col) for col, i in enumerate(ids.tolist()) if i in row_of]
                if own:
                    dist[tuple(np.array(own).T)] = np.inf
                best.add(dist, ids, prepared, songs)
        if id_type is not None:
            yield from best.table(pa.array(names, id_type), id_type).to_batches()

    return vectors.select("sid", "embedding").mapInArrow(scan, schema)


def _block_count() -> Column:
    """Blocks for a group of vectors."""
    size = F.sum(F.size("embedding").cast("long") * 4)
    return F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, size / BLOCK_BYTES)).cast("int")


def fits_in_one(df: DataFrame) -> bool:
    """Whether all vectors of a frame fit in one block."""
    return (df.agg(_block_count()).first()[0] or 0) <= 1


class Blocks:
    """How many blocks one side needs in each cell, so that a block holds about ``BLOCK_ROWS`` songs, and for wide
    vectors fewer, to stay near ``BLOCK_BYTES``.

    ``fits`` says that the whole side fits in one block, which saves counting per cell.
    """

    def __init__(self, df: DataFrame, cell: list[str], fits: bool = False):
        self.cell, self.counts = cell, None
        if fits:
            return
        counts = df.groupBy(*cell).agg(_block_count().alias("n"))
        rows = bounded_rows(counts, MANY_CELLS)
        if rows is None:
            self.counts = counts
        elif any(row["n"] > 1 for row in rows):
            self.counts = F.broadcast(df.sparkSession.createDataFrame(rows, counts.schema))

    def add(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the number of blocks of its cell; rows of cells this side does not have may be left out."""
        if self.counts is None:
            return df.withColumn(name, F.lit(1))
        return df.join(self.counts.withColumnRenamed("n", name), self.cell)


def meeting(n: int, metric: str, bpm_window: float | None = None):
    """The comparison of a block of seeds with a block of songs, for ``applyInArrow``."""
    tempo = bpm_window is not None

    def meet(seed_rows: pa.Table, song_rows: pa.Table) -> pa.Table:
        best = _Running(n, metric)
        seed_ids, song_type = seed_rows["seed"].combine_chunks(), song_rows.schema.field("sid").type
        if seed_rows.num_rows and song_rows.num_rows:
            song_rows = song_rows.sort_by("sid")
            ids, (candidates, squares) = song_rows["sid"].to_numpy(), _prepared(song_rows["embedding"], metric)
            song_bpm = song_rows["bpm"].to_numpy() if tempo else None
            for at in range(0, seed_rows.num_rows, CHUNK_ROWS):
                part = seed_rows.slice(at, CHUNK_ROWS)
                matrix = _prepared(part["embedding"], metric)
                bpm = part["bpm"].to_numpy() if tempo else None
                excluded = part["excluded"].combine_chunks()
                skip = excluded.flatten().to_numpy(zero_copy_only=False)
                skip_row = np.repeat(np.arange(part.num_rows), excluded.value_lengths().to_numpy(zero_copy_only=False))
                for start in range(0, len(ids), CHUNK_ROWS * 4):
                    chunk = ids[start : start + CHUNK_ROWS * 4]
                    stop = start + len(chunk)
                    chosen = candidates[start:stop], squares[start:stop]
                    dist = _products(matrix, chosen, metric)
                    if tempo:
                        near, low, high = song_bpm[start:stop], bpm - bpm_window, bpm + bpm_window
                        if near.min() < low.max() or near.max() > high.min():
                            dist[(near[None, :] < low[:, None]) | (near[None, :] > high[:, None])] = np.inf
                    slot = np.minimum(np.searchsorted(chunk, skip), len(chunk) - 1)
                    hit = chunk[slot] == skip
                    dist[skip_row[hit], slot[hit]] = np.inf
                    best.add(dist, chunk, matrix, chosen, at)
        return best.table(seed_ids, song_type)

    return meet


def block_nearest(
    seeds: DataFrame, songs: DataFrame, n: int, metric: str, cell: list[str], bpm_window: float | None = None,
    seed_blocks: Blocks | None = None, song_blocks: Blocks | None = None,
) -> DataFrame:
    """(seed, sid, distance): the ``n`` nearest songs of every seed among songs of the same cell.

    seeds: seed, excluded array of sids, embedding, the cell columns (a seed may stand in several cells) and bpm if
    ``bpm_window`` is given. songs: sid, embedding, the cell columns (one cell each) and bpm.
    """
    seed_blocks, song_blocks = seed_blocks or Blocks(seeds, cell), song_blocks or Blocks(songs, cell)
    tempo = ["bpm"] if bpm_window is not None else []
    id_type = _id_type(songs)

    def both(df: DataFrame) -> DataFrame:
        return song_blocks.add(seed_blocks.add(df, "_n_sb"), "_n_cb")

    left = both(seeds).select(
        *cell,
        F.pmod(F.xxhash64("seed"), F.col("_n_sb")).cast("int").alias("_sb"),
        F.explode(F.sequence(F.lit(0), F.col("_n_cb") - 1)).alias("_cb"),
        "seed", "embedding", "excluded", *tempo,
    )
    # fresh column ids, since seeds and songs may come from one frame
    right = both(songs).select(
        *[F.col(c).alias(c) for c in cell],
        F.explode(F.sequence(F.lit(0), F.col("_n_sb") - 1)).alias("_sb"),
        F.pmod(F.xxhash64("sid"), F.col("_n_cb")).cast("int").alias("_cb"),
        *[F.col(c).alias(c) for c in ("sid", "embedding", *tempo)],
    )
    group = [*cell, "_sb", "_cb"]
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(
        meeting(n, metric, bpm_window), f"seed {_id_type(seeds, 'seed')}, sid {id_type}, distance double"
    )


def keep_nearest(found: DataFrame, n: int) -> DataFrame:
    """Merges the per-task results: the ``n`` nearest per seed with their ``rank``."""
    if n == 1:
        best = found.groupBy("seed").agg(F.min(F.struct("distance", "sid")).alias("b"))
        return best.select("seed", "b.sid", "b.distance", F.lit(1).alias("rank"))
    order = Window.partitionBy("seed").orderBy("distance", "sid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def nearest(vectors: DataFrame, refs: DataFrame, n: int = 5, metric: str = "cosine") -> DataFrame:
    """(seed, sid, distance, rank): the ``n`` nearest songs of each reference in ``refs`` (sid, embedding).

    A reference is never its own neighbour. Up to ``FEW_REFERENCES`` references are sent to the rows; more go
    through cells (``pivots``). Either way a matrix product chooses candidates, with room for its error, and their distances are
    then computed directly, so both agree and copies tie at any length. Vectors must have one width and no NULL element.
    """
    vectors = vectors.select("sid", "embedding").where(F.size("embedding") > 0)
    refs = refs.select("sid", "embedding").where(F.size("embedding") > 0)
    few = bounded_rows(refs, FEW_REFERENCES)
    if few is None:
        from cratelight.operators.pivots import nearest_of_many  # builds on this module

        return nearest_of_many(vectors, refs, n, metric)
    schema = f"seed {_id_type(refs)}, sid {_id_type(vectors)}, distance double"
    found = _few(vectors, few, n, metric, schema) if few else vectors.sparkSession.createDataFrame([], schema)
    return keep_nearest(found, n)


def with_tags(neighbours: DataFrame, tags: DataFrame, fields: tuple[str, ...] = ("title", "artist", "bpm", "initialkey")) -> DataFrame:
    """Adds the tags of every neighbour; neighbours without tags are left out."""
    return neighbours.join(tags.select("sid", *fields), "sid").select("seed", "rank", "sid", *fields, "distance")


def _rounded(distance: Column) -> Column:
    return F.round(distance, DECIMALS)


def _joined(pairs: DataFrame, vectors: DataFrame, metric: str) -> DataFrame:
    """``pairs`` with ``score`` by two joins: every pair carries a vector through a shuffle."""
    for i in (1, 2):
        pairs = pairs.join(vectors.select(F.col("sid").alias(f"sid{i}"), F.col("embedding").alias(f"_v{i}")), f"sid{i}")
    return pairs.withColumn("score", _rounded(METRICS[metric](F.col("_v1"), F.col("_v2")))).drop("_v1", "_v2")


class _Side:
    """The vectors of one side of a cell, ordered by id; those that are null or hold a null have no width."""

    def __init__(self, ids: list[pa.Array], vectors: list[pa.Array]):
        ids, column = pa.chunked_array(ids), pa.chunked_array(vectors).combine_chunks()
        widths = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(np.float64), nan=-1).astype(np.int64)
        starts = np.cumsum(np.maximum(widths, 0)) - np.maximum(widths, 0)
        elements = column.flatten()
        holes = np.flatnonzero(elements.is_null().to_numpy(zero_copy_only=False))
        filled = np.flatnonzero(widths > 0)
        widths[filled[np.searchsorted(starts[filled], holes, "right") - 1]] = -1
        names = ids.to_numpy()
        order = np.argsort(names, kind="stable")
        self.ids, self.widths, self.starts = names[order], widths[order], starts[order]
        self.flat = elements.to_numpy(zero_copy_only=False).astype(np.float64)
        self.lengths = np.zeros(len(self.ids))
        with np.errstate(all="ignore"):
            for width in np.unique(self.widths[self.widths > 0]).tolist():
                same = np.flatnonzero(self.widths == width)
                for at in np.split(same, range(PAIR_ROWS, len(same), PAIR_ROWS)):
                    self.lengths[at] = np.sqrt(_summed((x * x for x in self.rows(at, width)), len(at)))

    def places(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and number of the rows of each wanted id."""
        low = np.searchsorted(self.ids, wanted, "left")
        return low, np.searchsorted(self.ids, wanted, "right") - low

    def rows(self, at: np.ndarray, width: int) -> np.ndarray:
        """Components by row: one array for each component."""
        return self.flat[self.starts[at][:, None] + np.arange(width)].T.copy()


def _summed(products: Iterator[np.ndarray], n: int) -> np.ndarray:
    """Component after component, as the column functions add."""
    total = np.zeros(n)
    for part in products:
        total += part
    return total


def _sums(sides: list[_Side], one: np.ndarray, two: np.ndarray, metric: str) -> list[pa.Array]:
    """(scalar product or distance, product of the lengths) of rows that meet, null where a vector has no width; sums over two
    vectors are null for unequal widths too."""
    first = np.zeros(len(one))
    widths, known = sides[0].widths[one], (sides[0].widths[one] >= 0) & (sides[1].widths[two] >= 0)
    alike = known & (widths == sides[1].widths[two])
    with np.errstate(all="ignore"):
        for width in np.unique(widths[alike]).tolist():
            at = np.flatnonzero(alike & (widths == width))
            left, right = sides[0].rows(one[at], width), sides[1].rows(two[at], width)
            if metric == "cosine":
                first[at] = _summed((a * b for a, b in zip(left, right, strict=True)), len(at))
            else:
                first[at] = np.sqrt(_summed(((a - b) * (a - b) for a, b in zip(left, right, strict=True)), len(at)))
        second = sides[0].lengths[one] * sides[1].lengths[two]
    return [pa.array(x, pa.float64(), mask=~m, from_pandas=False) for x, m in ((first, alike), (second, known))]


def _scored_cells(metric: str):
    """Scores sorted rows: in each cell the vectors of side 0, those of side 1, then (2) the pairs, which only pass through."""

    def scored(sides: list[_Side], pairs: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start in range(0, pairs.num_rows, PAIR_ROWS):
            part = pairs.slice(start, PAIR_ROWS)
            found = [side.places(part[f"sid{i}"].to_numpy(zero_copy_only=False)) for i, side in enumerate(sides, 1)]
            (low1, n1), (low2, n2) = found
            pair = np.repeat(np.arange(part.num_rows), n1 * n2)
            turn = np.arange(len(pair)) - np.repeat(np.cumsum(n1 * n2) - n1 * n2, n1 * n2)
            for at in range(0, len(pair), PAIR_ROWS):  # ids that repeat meet with each other
                p, t = pair[at : at + PAIR_ROWS], turn[at : at + PAIR_ROWS]
                ids = [part[c].take(pa.array(p)) for c in ("sid1", "sid2")]
                sums = _sums(sides, low1[p] + t // n2[p], low2[p] + t % n2[p], metric)
                yield pa.RecordBatch.from_arrays([*ids, *sums], ["sid1", "sid2", "_first", "_second"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, sides = None, None, None
        for batch in batches:
            slots = batch["slot"].to_numpy()
            bounds = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1], True]) if len(slots) else []
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                part, (own, kind) = batch.slice(low, high - low), divmod(int(slots[low]), 3)
                if own != cell:
                    cell, held, sides = own, ([], []), None
                if kind < 2:
                    held[kind].append((part[f"sid{kind + 1}"], part["embedding"]))
                elif held[0] and held[1]:
                    sides = sides or [_Side(*zip(*side, strict=True)) for side in held]
                    yield from scored(sides, part)

    return run


def _met(pairs: DataFrame, vectors: DataFrame, metric: str, blocks: int) -> DataFrame:
    """``pairs`` (sid1, sid2) with ``score``: both sides' vectors are copied to the cells of a grid of ``blocks`` by ``blocks`` and every pair
    goes to its cell as two ids. A task holds the vectors of one cell, whatever the number of pairs."""
    kind = _id_type(vectors)

    def block(sid: Column) -> Column:
        return F.pmod(F.xxhash64(sid), F.lit(blocks)).cast("int")

    def slot(one: Column, two: Column, side: int) -> Column:
        return ((one * blocks + two).cast("long") * 3 + side).alias("slot")  # one number, which Spark sorts by its digits

    every, none = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), F.lit(None).cast(kind)
    vectors = vectors.select("sid", "embedding").where("sid IS NOT NULL")
    copies = vectors.select(block(F.col("sid")).alias("own"), every.alias("other"), "sid", "embedding")
    rows = [
        copies.select(slot(F.col("own"), F.col("other"), 0), F.col("sid").alias("sid1"), none.alias("sid2"), "embedding"),
        copies.select(slot(F.col("other"), F.col("own"), 1), none.alias("sid1"), F.col("sid").alias("sid2"), "embedding"),
        pairs.where("sid1 IS NOT NULL AND sid2 IS NOT NULL").select(
            slot(block(F.col("sid1")), block(F.col("sid2")), 2), "sid1", "sid2",
            F.array().cast(vectors.schema["embedding"].dataType).alias("embedding")),  # not null: a run of null arrays is slow to pass to Python
    ]
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell = F.floor(F.col("slot") / 3)
    placed = rows[0].union(rows[1]).union(rows[2]).repartition(min(parts, blocks * blocks), cell).sortWithinPartitions("slot")
    sums = placed.mapInArrow(_scored_cells(metric), f"sid1 {kind}, sid2 {kind}, _first double, _second double")
    distance = cosine_of(F.col("_first"), F.col("_second")) if metric == "cosine" else F.col("_first")
    return sums.select("sid1", "sid2", _rounded(distance).alias("score"))


def _grid(pairs: DataFrame, vectors: DataFrame) -> int:
    """Blocks a side for ``_met``, or 0 where the joins shuffle less: for few pairs, or fewer than copies of vectors."""
    if {_id_type(pairs, "sid1"), _id_type(pairs, "sid2")} != {_id_type(vectors)} or _id_type(vectors) not in ("int", "bigint", "string"):
        return 0
    n_pairs = pairs.count()
    if n_pairs <= FEW_PAIRS:
        return 0
    size = vectors.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.greatest(F.size("embedding"), F.lit(0)).cast("long") * 4), F.lit(0)).alias("bytes")).first()
    blocks = max(math.ceil(math.sqrt(n_pairs / CELL_PAIRS)), math.ceil(size["bytes"] / BLOCK_BYTES), 1)
    return blocks if 2 * blocks * size["n"] < n_pairs else 0


def _answerable(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``pairs`` (sid1, sid2) without those of songs that have no vector, left out before pairs are grouped or written.

    Up to ``MANY_IDS`` ids, counted here, are sent to the pairs; of more only the first and the last are.
    """
    ids = vectors.select("sid").where("sid IS NOT NULL")
    ends = ids.agg(F.count("*").alias("n"), F.min("sid").alias("low"), F.max("sid").alias("high")).first()
    for sid in ("sid1", "sid2"):
        if ends["n"] <= MANY_IDS:
            pairs = pairs.join(F.broadcast(ids.withColumnRenamed("sid", sid)), sid, "left_semi")
        elif _id_type(pairs, sid) == _id_type(vectors):
            pairs = pairs.where(F.col(sid).between(ends["low"], ends["high"]))
    return pairs.select("sid1", "sid2")


def pair_distances(pairs: DataFrame, vectors: DataFrame, metric: str = "cosine") -> DataFrame:
    """Adds the distance of both songs to a table of pairs (sid1, sid2); pairs without both vectors are left out.

    Pairs that have both (``_answerable``) are written once and counted. Where they outnumber the vectors they meet them in the cells of a grid (``_met``), so no
    pair carries a vector through a shuffle, and their scores are written, as ordering reads them twice; else they are joined.
    """
    if set(pairs.columns) != {"sid1", "sid2"}:
        return _joined(pairs, vectors, metric)
    pairs = written(_answerable(pairs.select("sid1", "sid2"), vectors), "pairs")
    blocks = _grid(pairs, vectors)
    return written(_met(pairs, vectors, metric, blocks), "scores") if blocks else _joined(pairs, vectors, metric)


def compare_songs(pairs: DataFrame, vectors: DataFrame, tags: DataFrame, metric: str = "cosine", ordered: bool = True) -> DataFrame:
    """Title and artist of both songs of each pair with their distance, closest first unless ``ordered`` is false.

    Distances come first (``pair_distances``), so tags join only pairs that have both vectors. Ordering sorts all pairs; a job that
    only stores them needs none.
    """
    scored = pair_distances(pairs.select("sid1", "sid2"), vectors, metric)
    for i in (1, 2):
        sid = F.col("sid").alias(f"sid{i}")
        scored = scored.join(tags.select(sid, F.col("title").alias(f"title{i}"), F.col("artist").alias(f"artist{i}")), f"sid{i}", "left")
    scored = scored.select("sid1", "title1", "artist1", "sid2", "title2", "artist2", "score")
    return scored.orderBy("score", "sid1", "sid2") if ordered else scored


def pairs_of(spark, ids: list) -> DataFrame:
    """The unordered pairs of a list of songs named by the caller."""
    return spark.createDataFrame([(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]], ["sid1", "sid2"])


def unit_vector(vector: Column) -> Column:
    """The vector scaled to length 1."""
    from cratelight.functions.vectors import norm

    return F.transform(vector, lambda x: x.cast("double") / norm(vector))
