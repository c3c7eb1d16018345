"""Exact nearest songs of many references by metric partitioning.

Every song belongs to the cell of its nearest pivot. A reference first meets its own cell, which bounds the distance of its n-th
neighbour. By the triangle inequality it then has to visit only those cells whose ball, and whose side of the plane between both
pivots, comes closer than that; all other block pairs are skipped, and no song is copied to a cell that did not ask for it. For
cosine the vectors are scaled to length 1, where the chord orders as the cosine does; a zero vector gets an axis of its own, which can
only understate its distances.

A cell of more than one block is cut into parts by a hash of the id, and the references that visit a cell into slices, so copies of one
vector, or a cell that everybody visits, mean more blocks and not larger ones. Pivots are bounded in number and bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratelight.operators.similarity import (
    BLOCK_ROWS, CHUNK_ROWS, DECIMALS, _block_count, _id_type, _matrix, _prepared, _products, _Running, _slack, keep_nearest,
)
from cratelight.session import written

CELL_ROWS = 2048
MOST_PIVOTS = 16_384
PIVOT_BYTES = 32 << 20
PRODUCT_VALUES = 1 << 22  # entries of one matrix of distances to pivots
OUT_BYTES = 8 << 20
ROUNDING = 2 * 10.0**-DECIMALS


def _space(matrix: np.ndarray, metric: str) -> np.ndarray:
    """The vectors in a space whose distance never exceeds that of the metric (for cosine: never exceeds the chord)."""
    if metric != "cosine":
        return matrix
    unit, squares = _prepared(matrix, metric)
    return np.hstack([unit, (squares == 0).astype(np.float64)[:, None]])


def _reach(bound: np.ndarray, metric: str) -> np.ndarray:
    """How far in ``_space`` a song may be and still come within ``bound`` once distances are rounded."""
    wide = bound + ROUNDING
    return (np.sqrt(2 * wide) if metric == "cosine" else wide) * (1 + 1e-9)


def _squares(points: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of points to pivots, and for each point how far they can be off."""
    sides = _prepared(points, "euclidean"), _prepared(pivots, "euclidean")
    return _products(*sides, "euclidean"), _slack(*sides, "euclidean")


def fit_pivots(vectors: DataFrame, metric: str, cell_rows: int = CELL_ROWS) -> np.ndarray:
    """Distinct vectors drawn by a hash of their id, about one for ``cell_rows`` songs; crowded regions get more of them.

    At most ``MOST_PIVOTS``, and at most ``PIVOT_BYTES``; beyond that cells grow and are cut into parts.
    """
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("width"), F.min(F.size("embedding")).alias("least")).first()
    if not size["n"]:
        return np.zeros((0, 0))
    if size["least"] != size["width"]:
        raise ValueError("vectors of one comparison must have one width")
    most = max(1, min(MOST_PIVOTS, PIVOT_BYTES // (8 * (size["width"] + 1))))
    wanted = min(most, -(-size["n"] // cell_rows))
    draw, unit = F.pmod(F.xxhash64("sid"), F.lit(1 << 40)), (1 << 40) / size["n"]
    # four times the expected share, so that the sort sees a bounded number of rows
    near = vectors.where(draw < F.lit(int(min(1 << 40, unit * (4 * wanted + 64)))))
    rows = near.select("sid", "embedding", draw.alias("_draw")).orderBy("_draw", "sid").limit(wanted).collect()
    matrix = _space(np.array([row["embedding"] for row in rows], dtype=np.float64).reshape(len(rows), -1), metric)
    return np.unique(matrix, axis=0)


def finite(vectors: DataFrame) -> DataFrame:
    """(sid, embedding) of the vectors that can be compared: not NULL, not empty, no non-finite component."""
    fine = F.forall("embedding", lambda x: x.isNull() | (~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))  # NULL elements are refused later
    return vectors.select("sid", "embedding").where((F.size("embedding") > 0) & fine)


def assigned(vectors: DataFrame, pivots, metric: str) -> DataFrame:
    """(sid, embedding, cell, far, off): the cell of each vector, an upper bound of its distance to the pivot, and the error of squares."""
    kind = dict(vectors.dtypes)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, PRODUCT_VALUES // len(pivots.value))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                squares, off = _squares(_space(_matrix(part["embedding"]), metric), pivots.value)
                cell = squares.argmin(axis=1)
                far = np.sqrt(np.maximum(squares[np.arange(len(cell)), cell], 0) + off)
                columns = [part["sid"], part["embedding"], pa.array(cell.astype(np.int32)), pa.array(far), pa.array(off)]
                yield pa.RecordBatch.from_arrays(columns, ["sid", "embedding", "cell", "far", "off"])

    return vectors.mapInArrow(assign, f"sid {kind['sid']}, embedding {kind['embedding']}, cell int, far double, off double")


class Layout:
    """What is known of every cell: rows, parts, the radius of its ball, and the largest error of a squared distance."""

    def __init__(self, songs: DataFrame, n_pivots: int):
        facts = songs.groupBy("cell").agg(F.count("*").alias("n"), _block_count().alias("parts"), F.max("far").alias("radius"), F.max("off").alias("off"))
        self.rows, self.parts = np.zeros(n_pivots, np.int64), np.zeros(n_pivots, np.int64)
        self.radius, self.off = np.full(n_pivots, -np.inf), 0.0
        for cell in facts.collect():  # one row per pivot
            self.rows[cell["cell"]], self.parts[cell["cell"]], self.radius[cell["cell"]] = cell["n"], cell["parts"], cell["radius"]
            self.off = max(self.off, cell["off"])


def _needed(space: np.ndarray, cell: np.ndarray, bound: np.ndarray, pivots: np.ndarray, layout: Layout, n: int, metric: str) -> np.ndarray:
    """Which cells each reference has to visit, as a matrix of booleans."""
    squares, off = _squares(space, pivots)
    lower = np.sqrt(np.maximum(squares - off[:, None], 0.0))
    reach = _reach(bound, metric)
    for row in np.flatnonzero(np.isinf(bound)):  # fewer than n found at home: n songs and itself lie in the balls nearest by their far side
        if metric == "cosine" and space[row, -1]:
            continue
        ends = np.where(layout.rows > 0, np.sqrt(np.maximum(squares[row], 0.0) + off[row]) + layout.radius, np.inf)
        order = np.argsort(ends)
        at = np.searchsorted(np.cumsum(layout.rows[order]), n + 1)
        if at < len(order):
            reach[row] = ends[order[at]] * (1 + 1e-9) + 2 * np.sqrt(ROUNDING)
    need = (layout.rows > 0)[None, :] & (lower - layout.radius[None, :] <= reach[:, None])
    between, between_off = _squares(pivots[cell], pivots)
    gap = squares - squares[np.arange(len(cell)), cell][:, None] - 2 * off[:, None] - layout.off
    width = 2 * np.sqrt(np.maximum(between, 0.0) + between_off[:, None])
    return need & (gap <= reach[:, None] * width)


def _routes(first: DataFrame, pivots, layout, n: int, metric: str, counting: bool) -> DataFrame:
    """The visits of all references: one row each with the vector, or (``counting``) how many a cell gets."""
    kind = dict(first.dtypes)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, known = pivots.value, layout.value
        asked = np.zeros(len(centres), np.int64)
        for batch in batches:
            step = max(1, PRODUCT_VALUES // len(centres))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                space, home = _space(_matrix(part["embedding"]), metric), part["cell"].to_numpy()
                need = _needed(space, home, part["bound"].to_numpy(), centres, known, n, metric)
                need[np.arange(len(home)), home] &= known.parts[home] > 1  # its only part has been met
                if counting:
                    asked += need.sum(axis=0)
                    continue
                rows, cells = np.nonzero(need)
                out = max(1, OUT_BYTES // (8 * space.shape[1]))
                for begin in range(0, len(rows), out):
                    chosen = part.take(pa.array(rows[begin : begin + out]))
                    columns = [chosen["seed"], chosen["embedding"], chosen["bound"], chosen["cell"], pa.array(cells[begin : begin + out].astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, ["seed", "embedding", "bound", "home", "cell"])
        if counting:
            hit = np.flatnonzero(asked)
            yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(asked[hit])], ["cell", "n"])

    schema = "cell int, n long" if counting else f"seed {kind['seed']}, embedding {kind['embedding']}, bound double, home int, cell int"
    return first.select("seed", "embedding", "cell", "bound").mapInArrow(route, schema)


def _per_cell(df: DataFrame, counts: dict[str, np.ndarray]) -> DataFrame:
    """``df`` with numbers of its cell (a row per pivot, so the table is small by its construction); cells without any are left out."""
    cells = np.flatnonzero(np.all([values > 0 for values in counts.values()], axis=0))
    rows = [(int(c), *[int(values[c]) for values in counts.values()]) for c in cells]
    table = df.sparkSession.createDataFrame(rows, "cell int, " + ", ".join(f"{name} int" for name in counts))
    return df.join(F.broadcast(table), "cell")


def _part(column: str, count: str) -> Column:
    return F.pmod(F.xxhash64(column), F.col(count)).cast("int")


def _found(seeds: pa.Table, songs: pa.Table, n: int, metric: str) -> _Running:
    """The best ``n`` songs of a block for every reference, within its ``bound`` where there is one."""
    best = _Running(n, metric)
    if not (seeds.num_rows and songs.num_rows):
        return best
    songs = songs.sort_by("sid")
    ids, right = songs["sid"].to_numpy(), _prepared(songs["embedding"], metric)
    for at in range(0, seeds.num_rows, CHUNK_ROWS):
        part = seeds.slice(at, CHUNK_ROWS)
        left, own = _prepared(part["embedding"], metric), part["seed"].to_numpy()
        allowed = None
        if "bound" in part.column_names:
            wide = part["bound"].to_numpy() + ROUNDING
            allowed = (wide if metric == "cosine" else wide**2) + _slack(left, right, metric)
        for start in range(0, len(ids), CHUNK_ROWS * 4):
            names = ids[start : start + CHUNK_ROWS * 4]
            side = right[0][start : start + len(names)], right[1][start : start + len(names)]
            dist = _products(left, side, metric)
            if allowed is not None:
                dist[dist > allowed[:, None]] = np.inf
            low, high = np.searchsorted(names, own, "left"), np.searchsorted(names, own, "right")
            for row in np.flatnonzero(high > low):
                dist[row, low[row] : high[row]] = np.inf
            best.add(dist, names, left, side, at)
    return best


def _at_home(seeds: DataFrame, songs: DataFrame, layout: Layout, n: int, metric: str) -> DataFrame:
    """(seed, embedding, cell, bound, sids, distances): what every reference finds in one part of its own cell."""
    asked = np.zeros(len(layout.parts), np.int64)
    for row in seeds.groupBy("cell").count().collect():  # one row per pivot
        asked[row["cell"]] = row["count"]
    parts = np.maximum(layout.parts, 1)
    slices = -(-asked // (parts * BLOCK_ROWS * 2))
    left = _per_cell(seeds.select(F.col("sid").alias("seed"), "embedding", "cell"), {"_parts": parts, "_slices": slices})
    left = left.select("seed", "embedding", "cell", _part("seed", "_parts").alias("_part"), F.pmod(F.xxhash64("seed", F.lit(1)), "_slices").cast("int").alias("_slice"))
    right = _per_cell(songs.select("sid", "embedding", "cell"), {"_parts": parts, "_slices": slices})
    right = right.select("sid", F.col("embedding").alias("embedding"), F.col("cell").alias("cell"), _part("sid", "_parts").alias("_part"),
                         F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("_slice"))
    kind, id_type = dict(left.dtypes), _id_type(songs)

    def meet(seed_rows: pa.Table, song_rows: pa.Table) -> pa.Table:
        best, total = _found(seed_rows, song_rows, n, metric), seed_rows.num_rows
        empty = best.rows is None
        rows = np.zeros(0, np.int64) if empty else best.rows
        counts = np.bincount(rows, minlength=total)
        ends = np.cumsum(counts)
        dist = np.zeros(0) if empty else best.dist
        bound = np.full(total, np.inf)
        full = counts >= n
        bound[full] = dist[ends[full] - 1]
        offsets = pa.array(np.r_[0, ends].astype(np.int32))
        sids = pa.array([] if empty else best.ids, song_rows.schema.field("sid").type)
        return pa.table({
            "seed": seed_rows["seed"], "embedding": seed_rows["embedding"], "cell": seed_rows["cell"], "bound": pa.array(bound),
            "sids": pa.ListArray.from_arrays(offsets, sids), "distances": pa.ListArray.from_arrays(offsets, pa.array(dist)),
        })

    group = ["cell", "_part", "_slice"]
    schema = f"seed {kind['seed']}, embedding {kind['embedding']}, cell int, bound double, sids array<{id_type}>, distances array<double>"
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(meet, schema)


def _abroad(first: DataFrame, songs: DataFrame, pivots, layout: Layout, shared, asked: np.ndarray, n: int, metric: str) -> DataFrame:
    """(seed, sid, distance): what the references find in the other cells and parts that they have to visit."""
    counts = {"_parts": layout.parts, "_slices": -(-asked // (BLOCK_ROWS * 2))}
    visits = _per_cell(_routes(first, pivots, shared, n, metric, False), counts)
    left = visits.select(
        "seed", "embedding", "bound", "cell", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"),
        F.pmod(F.xxhash64("seed", F.lit(1)), "_slices").cast("int").alias("_slice"), (F.col("home") == F.col("cell")).alias("_home"), _part("seed", "_parts").alias("_own"),
    ).where("NOT _home OR _part <> _own").drop("_home", "_own")
    right = _per_cell(songs.select("sid", "embedding", "cell"), counts)
    right = right.select("sid", F.col("embedding").alias("embedding"), F.col("cell").alias("cell"), _part("sid", "_parts").alias("_part"),
                         F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("_slice"))

    def meet(seed_rows: pa.Table, song_rows: pa.Table) -> pa.Table:
        return _found(seed_rows, song_rows, n, metric).table(seed_rows["seed"].combine_chunks(), song_rows.schema.field("sid").type)

    group = ["cell", "_part", "_slice"]
    schema = f"seed {_id_type(first, 'seed')}, sid {_id_type(songs)}, distance double"
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(meet, schema)


class PivotSearch:
    """The steps of one search; ``result`` is (seed, sid, distance, rank) and ``visits`` the visits beyond home per cell."""

    def __init__(self, vectors: DataFrame, refs: DataFrame, n: int, metric: str, cell_rows: int = CELL_ROWS):
        spark, same = vectors.sparkSession, refs is vectors
        vectors = finite(vectors)
        refs = vectors if same else finite(refs)
        centres = fit_pivots(vectors, metric, cell_rows)
        self.visits = np.zeros(len(centres), np.int64)
        schema = f"seed {_id_type(refs)}, sid {_id_type(vectors)}, distance double"
        if not len(centres):
            self.layout, self.result = None, keep_nearest(spark.createDataFrame([], schema), n)
            return
        pivots = spark.sparkContext.broadcast(centres)
        songs = written(assigned(vectors, pivots, metric), "cells")
        self.layout = Layout(songs, len(centres))
        shared = spark.sparkContext.broadcast(self.layout)
        first = written(_at_home(songs if same else assigned(refs, pivots, metric), songs, self.layout, n, metric), "home")
        if self.layout.parts.sum() > 1:
            for row in _routes(first, pivots, shared, n, metric, True).groupBy("cell").agg(F.sum("n").alias("n")).collect():  # one row per pivot
                self.visits[row["cell"]] = row["n"]
        pairs = F.explode(F.arrays_zip("sids", "distances")).alias("_pair")
        found = first.select("seed", pairs).select("seed", F.col("_pair.sids").alias("sid"), F.col("_pair.distances").alias("distance"))
        if self.visits.any():
            found = found.unionByName(_abroad(first, songs, pivots, self.layout, shared, self.visits, n, metric))
        self.result = keep_nearest(found, n)


def nearest_of_many(vectors: DataFrame, refs: DataFrame, n: int = 5, metric: str = "cosine", cell_rows: int = CELL_ROWS) -> DataFrame:
    """(seed, sid, distance, rank): the ``n`` nearest songs of each of any number of references (sid, embedding), exactly.

    Vectors that are NULL, empty or hold a non-finite component find nothing and are not found; different widths and NULL components are
    errors. Repeated rows are kept as rows. A reference is never its own neighbour; ties go to the smaller sid; no vectors or no references give no rows.
    """
    return PivotSearch(vectors, refs, n, metric, cell_rows).result
