"""Nearest songs by pivots against plain loops: clustered vectors, copies, zero vectors, small blocks."""

import numpy as np
import pytest

from cratelight.operators import pivots, similarity


def brute(songs, refs, n, metric):
    """(seed, sid, distance, rank) by comparing everything."""
    out = set()
    for seed, a in refs:
        found = []
        for sid, b in songs:
            if sid == seed:
                continue
            if metric == "euclidean":
                dist = float(np.sqrt(((a - b) ** 2).sum()))
            else:
                lengths = np.sqrt((a**2).sum()), np.sqrt((b**2).sum())
                dist = 1.0 if 0 in lengths else max(1.0 - float((a / lengths[0]) @ (b / lengths[1])), 0.0)
            found.append((round(dist, 6) + 0.0, sid))
        out |= {(seed, sid, dist, i + 1) for i, (dist, sid) in enumerate(sorted(found)[:n])}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], "sid long, embedding array<double>")


def found(df):
    return {(r.seed, r.sid, r.distance, r.rank) for r in df.collect()}


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(12, 8)) * 20
    matrix = np.round(centres[rng.integers(0, 12, 700)] + rng.normal(size=(700, 8)), 3)
    matrix[:230] = matrix[0]  # a third are copies of one vector
    matrix[230:240] = 0
    return list(enumerate(matrix))


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_equals_all_pairs(spark, clustered, metric, monkeypatch):
    for module in (similarity, pivots):
        monkeypatch.setattr(module, "BLOCK_ROWS", 64)  # the copies fill several parts, their visitors several slices
    vectors = frame(spark, clustered)
    search = pivots.PivotSearch(vectors, vectors, 3, metric, cell_rows=40)
    assert search.layout.parts.max() > 1
    assert found(search.result) == brute(clustered, clustered, 3, metric)
    others = [(10_000 + i, v + 0.5) for i, v in clustered[::9]] + [(20_000, np.zeros(8)), (20_001, np.full(8, 1e4))]
    assert found(pivots.nearest_of_many(vectors, frame(spark, others), 4, metric, 40)) == brute(clustered, others, 4, metric)


def test_more_neighbours_than_a_cell_has(spark, clustered):
    few = clustered[225:300]
    vectors = frame(spark, few)
    for metric in ("euclidean", "cosine"):
        assert found(pivots.nearest_of_many(vectors, vectors, 30, metric, 5)) == brute(few, few, 30, metric)
        assert found(pivots.nearest_of_many(vectors, vectors, 500, metric, 5)) == brute(few, few, 500, metric)


def test_most_block_pairs_are_skipped(spark):
    """On clustered vectors a reference visits few cells, and no more of them as the table grows."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 8)) * 50
    share = []
    for size in (1500, 6000):
        rows = list(enumerate(centres[rng.integers(0, 60, size)] + rng.normal(size=(size, 8))))
        vectors = frame(spark, rows)
        search = pivots.PivotSearch(vectors, vectors, 2, "euclidean", cell_rows=size // 60)
        assert len(search.visits) == 60
        share.append(search.visits.sum() / size)
    assert share[0] < 6 and share[1] < 1.2 * share[0] + 0.5  # of 59 other cells


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [float("nan"), 1.0]), (3, None), (4, []), (5, [float("inf"), 0.0]), (6, [0.0, 1.0])]
    vectors = frame(spark, rows)
    assert found(pivots.nearest_of_many(vectors, vectors, 3, "cosine", 1)) == {(1, 6, 1.0, 1), (6, 1, 1.0, 1)}
    empty = frame(spark, rows).where("sid > 100")
    assert found(pivots.nearest_of_many(empty, vectors)) == found(pivots.nearest_of_many(vectors, empty)) == set()
    extra = vectors.selectExpr("sid", "embedding", "1 AS cell", "2 AS bound", "3 AS _part", "4 AS far", "'x' AS label")
    assert found(pivots.nearest_of_many(extra, extra, 1, "cosine", 1)) == {(1, 6, 1.0, 1), (6, 1, 1.0, 1)}


def test_names_may_be_text(spark, clustered):
    some = clustered[200:330]
    vectors = frame(spark, some).selectExpr("concat('s', sid) AS sid", "embedding")
    got = {(r.seed, r.distance, r.rank) for r in pivots.nearest_of_many(vectors, vectors, 1, "euclidean", 20).collect()}
    assert got == {(f"s{seed}", dist, rank) for seed, _, dist, rank in brute(some, some, 1, "euclidean")}
