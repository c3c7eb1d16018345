"""Operators against brute force on small frames."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cratelight.operators import align, pivots, pooling, quantiles, ranking, repair, scenario, schema, scoring, setlist, similarity, stats
from cratelight.operators.scenario import Rule
from cratelight.session import bounded_local


def values(df, *columns):
    return sorted(tuple(row[c] for c in columns) for row in df.collect())


@pytest.mark.parametrize("cells", [3, 65_536])
def test_exact_quantiles(spark, cells):
    """With many passes of few cells, and with few passes of many."""
    rng = random.Random(3)
    rows = [(rng.gauss(0, 1), float(rng.randrange(4)), None if i % 3 else rng.random()) for i in range(5000)]
    rows += [(float("nan"), None, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    probs = [0.0, 0.2, 0.333, 0.5, 0.75, 0.9, 1.0]
    got = {(r["name"], r["q"]): r["value"] for r in quantiles.exact_quantiles(df, {c: probs for c in "abc"}, cells).collect()}
    for i, c in enumerate("abc"):
        present = [r[i] for r in rows if r[i] is not None and not math.isnan(r[i])]
        for q in probs:
            assert got[c, q] == pytest.approx(np.quantile(present, q), abs=1e-12), (c, q)


def test_exact_quantiles_of_uneven_and_infinite_values(spark):
    n = 20_000
    uneven = [float(i) ** 5 for i in range(n)]
    ends = [float("-inf")] * 400 + [float(i) for i in range(n - 800)] + [float("inf")] * 400
    df = spark.createDataFrame(list(zip(uneven, ends)), "u double, e double").repartition(4)
    got = {(r["name"], r["q"]): r["value"] for r in quantiles.exact_quantiles(df, {"u": [0.0, 0.3, 1.0], "e": [0.001, 0.5, 0.999]}).collect()}
    for q in (0.0, 0.3, 1.0):
        assert got["u", q] == pytest.approx(np.quantile(uneven, q), rel=1e-12)
    assert (got["e", 0.001], got["e", 0.5], got["e", 0.999]) == (float("-inf"), (n - 801) / 2, float("inf"))


def test_exact_quantiles_of_every_magnitude(spark):
    """Values from the smallest to the largest doubles of both signs, zeros, and a value that fills a third of the column."""
    rng = random.Random(8)
    rows = [math.ldexp(rng.uniform(0.5, 1), rng.randrange(-1073, 1024)) * rng.choice([-1, 1]) for _ in range(1500)]
    rows += [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308] + [0.1] * 800
    rows += [0.1 + i * 2.0**-56 for i in range(50)]
    df = spark.createDataFrame([(x,) for x in rows], "x double").repartition(5)
    probs = [i / (len(rows) - 1) for i in range(0, len(rows), 97)] + [1.0]
    got = {r.q: r.value for r in quantiles.exact_quantiles(df, {"x": probs}).collect()}
    order = sorted(rows)
    for q in probs:
        at = q * (len(rows) - 1)
        low, high = order[math.floor(at)], order[math.ceil(at)]
        assert got[q] == (low if low == high else low + (high - low) * (at - math.floor(at)))
    assert quantiles.exact_quantiles(df.limit(0), {"x": [0.5]}).count() == 0


def test_quantiles_neither_sort_nor_sketch(spark):
    """The counting plan: no value reaches a sort or a window, only cells do."""
    df = spark.range(100).select((F.col("id") * 1.5).alias("x"), (F.col("id") % 3).cast("string").alias("name"))
    plan = quantiles._placed(quantiles._counted(df, "name", quantiles._magnitude(F.col("x"))), "name")._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "HashAggregate(" in plan and "Sort [name" in plan
    assert all("x#" not in line for line in plan.splitlines() if "Sort [" in line or "Window [" in line)


def test_describe_has_sample_std(spark):
    row = quantiles.describe(spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "x double"), "x").first()
    assert (row["count"], row["mean"], row["std"], row["min"], row["p25"], row["p50"], row["p75"], row["max"]) == (4, 2.5, 1.291, 1.0, 1.75, 2.5, 3.25, 4.0)


@pytest.mark.parametrize("slice_rows", [500_000, 200])
@pytest.mark.parametrize("hot_rows", [1_000_000, 100, 5, 1])
def test_positions_with_a_hot_key(spark, monkeypatch, hot_rows, slice_rows):
    monkeypatch.setattr(pooling, "ROWS_PER_SLICE", slice_rows)
    monkeypatch.setattr(pooling, "HOT_ROWS", hot_rows)
    rows = [("hot", i // 3, i) for i in range(3000)] + [("cold", i, i) for i in range(7)] + [("one", None, 1), (None, 3, 1), (None, 2, 2)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "sid string, t bigint, id bigint")
    got = sorted((r.sid or "", r.pos, r.id) for r in pooling.positions(df, ["sid"], ["t", "id"]).collect())
    assert got == [("", 0, 2), ("", 1, 1)] + [("cold", i, i) for i in range(7)] + [("hot", i, i) for i in range(3000)] + [("one", 0, 1)]


def test_positions_of_one_instant(spark, monkeypatch):
    monkeypatch.setattr(pooling, "HOT_ROWS", 2)
    df = spark.createDataFrame([("a", 5, i) for i in range(9)], "sid string, t bigint, id bigint")
    assert values(pooling.positions(df, ["sid"], ["t", "id"]), "pos", "id") == [(i, i) for i in range(9)]


def test_positions_split_one_instant(spark, monkeypatch):
    """A song whose rows all share one instant is cut into ranges of bounded size; other songs are numbered beside it."""
    monkeypatch.setattr(pooling, "HOT_ROWS", 100)
    monkeypatch.setattr(pooling, "ROWS_PER_SLICE", 300)
    written, ranges = pooling.written, []

    def spy(df, name):
        table = written(df, name)
        if name == "ranges":
            ranges.extend(r["count"] for r in table.groupBy("_slice").count().collect())
        return table

    monkeypatch.setattr(pooling, "written", spy)
    df = spark.range(3010).selectExpr("IF(id < 3000, 'a', 'b') AS sid", "5 AS t", "3010 - id AS id").repartition(4)
    got = pooling.positions(df, ["sid"], ["t", "id"])
    assert got.where("sid = 'a' AND pos <> id - 11 OR sid = 'b' AND pos <> id - 1").count() == 0 and got.count() == 3010
    assert len(ranges) == 10 and max(ranges) < 900 and sum(ranges) == 3000


def test_patches(spark):
    rows = [("long", p, float(p)) for p in range(11)] + [("exact", p, 1.0) for p in range(4)] + [("short", p, 2.0) for p in range(3)]
    cut = pooling.patches(spark.createDataFrame(rows, "sid string, pos bigint, x double"), ["sid"], "pos", "x", 4)
    assert sorted((r.sid, r.patch, r.n_frames, r.frames) for r in cut.collect()) == [
        ("exact", 0, 4, [1.0] * 4), ("long", 0, 4, [0.0, 1.0, 2.0, 3.0]), ("long", 1, 4, [4.0, 5.0, 6.0, 7.0]), ("short", 0, 3, [2.0, 2.0, 2.0, 0.0]),
    ]


def test_pooling_std_is_of_the_population(spark):
    row = pooling.pool_scores(spark.createDataFrame([("a", 1.0), ("a", 3.0)], "sid string, score double"), ["sid"]).first()
    assert (row.mean_score, row.std_score, row.n_segments) == (2.0, 1.0, 2)


def test_activation_head_skips_negative_class(spark):
    table = spark.createDataFrame([("a", [0.0, 0.0], [1.0, 3.0])], "sid string, not_happy array<float>, happy array<float>")
    row = pooling.pool_activation_head(table).first()
    assert (row["class"], row.mean_score, row.std_score) == ("happy", 2.0, 1.0)


def test_align_outer_and_load_scores(spark):
    a = spark.createDataFrame([("x", [1.0, 3.0]), ("y", [2.0])], "sid string, danceable array<double>")
    b = spark.createDataFrame([("y", [4.0]), ("z", [6.0, 8.0])], "sid string, happy array<double>")
    from cratelight.functions.arrays import mean_of

    got = align.load_scores([(a, {"danceable": "dance"}), (b, {"happy": "happy"})], pool=mean_of)
    assert sorted(map(tuple, got.collect())) == [("x", 2.0, None), ("y", 2.0, 4.0), ("z", None, 7.0)]
    assert got.columns == ["sid", "dance", "happy"]


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 1, 9, 10)], "x double")
    assert [r.n for r in stats.histogram(df, "x", 5).orderBy("bin").collect()] == [3, 0, 0, 0, 2]
    assert sum(r.n for r in stats.histogram(df.where("x = 1"), "x", 5).collect()) == 2


def test_dominant_class_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 0.5, 0.5, None), (2, None, None, None), (3, 0.1, 0.2, 0.9)], "sid int, b double, a double, c double")
    assert [(r.sid, r.dominant) for r in stats.dominant_class(df, "sid", ["b", "a", "c"]).orderBy("sid").collect()] == [(1, "b"), (2, None), (3, "c")]


def test_top_songs_keeps_untagged(spark):
    scores = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, None), (4, 0.9)], "sid int, x double")
    tags = spark.createDataFrame([(1, "t", "a"), (2, "u", "b")], "sid int, title string, artist string")
    assert [r.sid for r in ranking.top_songs(scores, tags, "x", 2).collect()] == [2, 4]
    assert [r.sid for r in ranking.top_songs(scores, tags, "x", 2, how="inner").collect()] == [2]
    assert [r.sid for r in ranking.top_songs(scores, tags, "x", 1, ascending=True).collect()] == [1]


def test_seeded_sample_does_not_depend_on_partitions(spark):
    scores = spark.range(500).select(F.col("id").alias("sid"), (F.col("id") / 500).alias("x"))
    tags = spark.range(500).select(F.col("id").alias("sid"), F.lit("t").alias("title"), F.lit("a").alias("artist"))
    picks = [values(ranking.seeded_sample(scores.repartition(n), tags, "x", (0.2, 0.8), 10, 7), "sid") for n in (1, 7)]
    assert picks[0] == picks[1] and len(picks[0]) == 10 and all(100 <= s < 400 for (s,) in picks[0])
    assert picks[0] != values(ranking.seeded_sample(scores, tags, "x", (0.2, 0.8), 10, 8), "sid")


def test_scenario_rounds_the_threshold(spark):
    scores = spark.createDataFrame([(i, i / 3000) for i in range(4)], "sid int, x double")
    # the median is 0.0005, rounded half to even 0.0
    assert values(scenario.passing(scores, [Rule("x", 0.5, "<=")]), "sid") == [(0,)]
    assert values(scenario.passing(scores, [Rule("x", 0.5, "<=")], decimals=None), "sid") == [(0,), (1,)]


def test_filter_songs(spark):
    tags = spark.createDataFrame([(1, 100.0, "1A"), (2, 120.0, "2A"), (3, None, "1A")], "sid int, bpm double, initialkey string")
    mood = spark.createDataFrame([(1, "0.5"), (2, "x"), (3, "0.6")], "sid int, happy string")
    assert values(scenario.filter_songs(tags, mood, mood_ranges={"happy": (0.5, 1.0)}), "sid") == [(1,), (3,)]
    assert values(scenario.filter_songs(tags, bpm=(90, 130), keys=["1A"]), "sid") == [(1,)]
    assert scenario.filter_songs(tags).count() == 3


def _library(spark, n, text_ids=False, seed=5):
    rng = np.random.default_rng(seed)
    ids = [f"s{i:03d}" if text_ids else i for i in range(n)]
    keys = [f"{rng.integers(1, 13)}{'AB'[rng.integers(2)]}" for _ in range(n)]
    bpm = [float(b) for b in rng.integers(100, 130, n)]
    matrix = rng.normal(size=(n, 8)).astype(np.float32)
    matrix[1] = matrix[0]  # an exact copy
    matrix[n - 1] = 0
    kind = "string" if text_ids else "bigint"
    tags = spark.createDataFrame([(i, f"t{i}", f"a{i}", b, k) for i, b, k in zip(ids, bpm, keys)], f"sid {kind}, title string, artist string, bpm double, initialkey string")
    vectors = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in zip(ids, matrix)], f"sid {kind}, embedding array<float>")
    return ids, bpm, keys, matrix.astype(np.float64), tags, vectors


def _distance(a, b, metric):
    if metric == "euclidean":
        return round(float(np.linalg.norm(a - b)), 6)
    lengths = np.linalg.norm(a) * np.linalg.norm(b)
    return round(min(2.0, max(0.0, 1 - float(a @ b) / lengths)), 6) if lengths else 1.0


def _near(got, expected):
    assert [row[:-1] for row in got] == [row[:-1] for row in expected]
    assert [row[-1] for row in got] == pytest.approx([row[-1] for row in expected], abs=2e-6)


@pytest.mark.parametrize("text_ids", [False, True])
@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_nearest_both_ways(spark, monkeypatch, metric, text_ids):
    ids, _, _, matrix, _, vectors = _library(spark, 60, text_ids)
    expected = []
    for i, a in zip(ids, matrix):
        order = sorted((_distance(a, b, metric), j) for j, b in zip(ids, matrix) if j != i)[:4]
        expected += [(i, rank, j, d) for rank, (d, j) in enumerate(order, 1)]
    few = similarity.nearest(vectors, vectors, 4, metric)
    _near(values(few, "seed", "rank", "sid", "distance"), sorted(expected))
    monkeypatch.setattr(similarity, "FEW_REFERENCES", 10)
    monkeypatch.setattr(similarity, "BLOCK_BYTES", 500)  # several blocks on either side
    monkeypatch.setattr(similarity, "CHUNK_ROWS", 3)
    many = similarity.nearest(vectors, vectors, 4, metric)
    _near(values(many, "seed", "rank", "sid", "distance"), sorted(expected))


def test_nearest_of_nothing(spark):
    *_, vectors = _library(spark, 10)
    assert similarity.nearest(vectors, vectors.where("sid < 0"), 3).count() == 0


def _steps(a, b):
    gap = abs(int(a[:-1]) - int(b[:-1]))
    return (1 if gap == 11 else gap) + (a[-1] != b[-1])


def _walk(start, n, ids, bpm, keys, matrix, window):
    path = [start]
    while len(path) <= n:
        i = ids.index(path[-1])
        pool = [
            (_distance(matrix[i], matrix[j], "cosine"), s) for j, s in enumerate(ids)
            if s not in path and abs(bpm[i] - bpm[j]) <= window and _steps(keys[i], keys[j]) < 2
        ]
        if not pool:
            break
        path.append(min(pool)[1])
    return path


@pytest.mark.parametrize("block_bytes", [300, 32 << 20])
@pytest.mark.parametrize("text_ids", [False, True])
def test_setlists_equal_the_greedy_walk(spark, monkeypatch, block_bytes, text_ids):
    monkeypatch.setattr(similarity, "BLOCK_BYTES", block_bytes)
    ids, bpm, keys, matrix, tags, vectors = _library(spark, 50, text_ids)
    seeds = spark.createDataFrame([(ids[k],) for k in (0, 7, 20, 33)], tags.select("sid").schema)
    got = setlist.setlists(tags, vectors, seeds, n_songs=4, bpm_window=5)
    expected = [(s, o, x) for s in (ids[0], ids[7], ids[20], ids[33]) for o, x in enumerate(_walk(s, 4, ids, bpm, keys, matrix, 5), 1)]
    assert values(got, "seed", "order", "sid") == sorted(expected)


def test_next_song_and_excludes(spark):
    ids, bpm, keys, matrix, tags, vectors = _library(spark, 60)
    got = dict(values(setlist.next_song(tags, vectors), "seed", "sid"))
    for i in ids:
        walk = _walk(i, 1, ids, bpm, keys, matrix, 5)
        assert got.get(i) == (walk[1] if len(walk) > 1 else None)
    start = next(i for i in ids if i in got)
    seeds = spark.createDataFrame([(start, [got[start]])], "sid bigint, excludes array<bigint>")
    second = setlist.next_song(tags, vectors, seeds).collect()
    assert all(row.sid != got[start] for row in second)


def test_candidate_pool(spark):
    ids, bpm, keys, _, tags, _ = _library(spark, 80)
    got = dict(values(setlist.candidate_pool(tags), "sid", "n_candidates"))
    for i in range(80):
        assert got[ids[i]] == sum(
            1 for j in range(80) if i != j and bpm[i] - 5 <= bpm[j] <= bpm[i] + 5 and _steps(keys[i], keys[j]) < 2
        )


def test_songs_without_tempo_or_key_are_never_played(spark):
    *_, tags, vectors = _library(spark, 30)
    holed = tags.withColumn("bpm", F.when(F.col("sid") % 2 == 0, F.col("bpm"))).withColumn("initialkey", F.when(F.col("sid") % 3 == 0, F.col("initialkey")))
    assert all(row.sid % 6 == 0 and row.seed % 6 == 0 for row in setlist.next_song(holed, vectors).collect())


def test_compare_songs_and_pairs(spark):
    ids, _, _, matrix, tags, vectors = _library(spark, 12)
    got = similarity.compare_songs(similarity.pairs_of(spark, [3, 5, 9]), vectors, tags, "euclidean").collect()
    assert sorted((r.sid1, r.sid2) for r in got) == [(3, 5), (3, 9), (5, 9)]
    assert [r.score for r in got] == sorted(r.score for r in got)
    assert all(r.title1 == f"t{r.sid1}" and r.score == pytest.approx(_distance(matrix[r.sid1], matrix[r.sid2], "euclidean"), abs=2e-6) for r in got)


def test_index_recall_of_the_registered_query(folder, spark):
    """On the largest given table: nine of ten neighbours, from under 15 % of the vectors; lists and codes are pruned columns."""
    from pathlib import Path

    from cratelight.operators import ann
    from cratelight.plans import songs as plan

    big = Path(folder).parent / "sf0.1"
    vectors, path, refs = plan._asked(spark, str(big if big.exists() else folder))
    found = {(r.seed, r.sid) for r in ann.search(refs, path, 5).collect()}
    exact = {(r.seed, r.sid) for r in similarity.nearest(vectors, refs, 5, "cosine").collect()}
    assert len(found & exact) >= 0.9 * len(exact) and len(found) == len(exact)
    assert ann.share_read(vectors, path) < 0.15
    scan = [x for x in ann.candidates(refs, path)._jdf.queryExecution().executedPlan().toString().splitlines() if "lists" in x and "ReadSchema" in x]
    assert scan and all("embedding" not in x.split("ReadSchema")[1] for x in scan)


def test_index_of_clusters_copies_and_strange_vectors(spark, tmp_path, monkeypatch):
    """Clustered vectors: few lists suffice. Copies tie by sid, a crowded list is met in blocks, empty vectors are left out."""
    from cratelight.operators import ann

    monkeypatch.setattr(ann, "ROWS_PER_BLOCK", 100)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 20))
    matrix = np.concatenate([c + 0.1 * rng.normal(size=(60, 20)) for c in centres] + [np.repeat(centres[:1], 400, axis=0)])
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)] + [(9999, []), (10000, None), (10001, [0.0] * 20)]
    vectors, path = spark.createDataFrame(rows, "sid bigint, embedding array<float>"), str(tmp_path / "index")
    quantiser = ann.fit(vectors)
    ann.build(vectors, path, quantiser)
    assert quantiser.probes < len(quantiser.centres)
    loaded = ann.Quantiser.load(spark, f"{path}/quantiser")
    assert np.array_equal(loaded.centres, quantiser.centres) and loaded.probes == quantiser.probes and loaded.rerank == quantiser.rerank
    refs = vectors.where("sid % 10 = 0 AND sid < 720 OR sid = 700")
    got, exact = ({(r.seed, r.sid): r.distance for r in df.collect()} for df in (ann.search(refs, path, 5), similarity.nearest(vectors.where("sid < 9999"), refs, 5, "cosine")))
    assert len(set(got) & set(exact)) >= 0.9 * len(exact) and all(got[k] == exact[k] for k in set(got) & set(exact))
    assert spark.read.parquet(f"{path}/lists").count() == 721 + 400
    assert ann.fit(vectors.where("sid = 9999")) is None


@pytest.mark.parametrize("length", [1, 50, 1000])
def test_copies_tie_at_any_length(spark, length, monkeypatch):
    rng = np.random.default_rng(1)
    matrix = rng.normal(size=(30, 64))
    matrix *= length / np.linalg.norm(matrix, axis=1)[:, None]
    rows = [(i + 100 * c, [float(x) for x in row]) for c in (0, 1) for i, row in enumerate(matrix)]
    vectors = spark.createDataFrame(rows, "sid bigint, embedding array<double>")
    few = {(r.seed, r.sid, r.distance) for r in similarity.nearest(vectors, vectors, 1, "euclidean").collect()}
    many = {(r.seed, r.sid, r.distance) for r in pivots.nearest_of_many(vectors, vectors, 1, "euclidean").collect()}
    assert few == many == {(s, (s + 100) % 200, 0.0) for s, _ in rows}


def test_uneven_vectors_are_refused(spark):
    for rows in ([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0, 4.0])], [(1, [1.0, None]), (2, [1.0, 2.0])]):
        vectors = spark.createDataFrame(rows, "sid bigint, embedding array<double>").coalesce(1)
        with pytest.raises(Exception, match="vectors"):
            pivots.nearest_of_many(vectors, vectors, 1).collect()


def test_band_edges_and_window_0(spark):
    tags = spark.createDataFrame([(1, 128.7, "8A"), (2, 128.39999999999998, "8A"), (3, 140.0, "8A"), (4, 140.0, "8A")], "sid bigint, bpm double, initialkey string")
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(1, 5)], "sid bigint, embedding array<double>")
    for window in (0.3, 0, 5):
        played = {r.seed for r in setlist.next_song(tags, vectors, bpm_window=window).collect()}
        assert played == {r.sid for r in setlist.candidate_pool(tags, window).collect() if r.n_candidates > 0}
        assert played >= {3, 4} and (window == 0 or played == {1, 2, 3, 4})


def test_segments_are_scored_in_place(spark):
    from cratelight.operators.scoring import score_segments

    rows = [(i, [[float(i), float(k)] for k in range(i % 4)]) for i in range(40)] + [(50, None), (51, [[1.0]])]
    df = spark.createDataFrame(rows, "sid bigint, segments array<array<double>>").coalesce(1)
    got = {r.sid: r for r in score_segments(df, lambda: lambda x: np.stack([x.sum(1), x[:, 0] - x[:, 1]], 1), ["s", "d"], batch_rows=16).collect()}
    for i in range(40):
        assert got[i].s == [float(i + k) for k in range(i % 4)] and got[i].d == [float(i - k) for k in range(i % 4)] and got[i].error is None
    assert got[50].s is None and got[50].error is None and got[51].s is None and got[51].error


def test_bounded_local(spark):
    assert bounded_local(spark.range(5), 5).count() == 5
    assert bounded_local(spark.range(6), 5) is None


def test_flatten_and_split(spark):
    df = spark.createDataFrame([(("m1", ((["a"], 120.0),)), ((1.0, [1, 2]), 3.0))],
                               "metadata struct<md5:string,tags:struct<t:struct<title:array<string>,bpm:double>>>, f struct<tonal:struct<x:double,l:array<int>>,rhyt:double>")
    flat = schema.flatten_struct(df)
    assert flat.columns == ["metadata_md5", "metadata_tags_t_title", "metadata_tags_t_bpm", "f_tonal_x", "f_tonal_l", "f_rhyt"]
    keyed = flat.withColumnRenamed("metadata_md5", "sid")
    scalars, lists = schema.split_lists(keyed)
    assert lists.columns == ["sid", "metadata_tags_t_title", "f_tonal_l"] and "f_rhyt" in scalars.columns
    families = schema.split_by_prefix(keyed, {"tonal": "f_tonal", "meta": "meta", "none": "zzz"})
    assert {k: v.columns for k, v in families.items()} == {"tonal": ["sid", "f_tonal_x", "f_tonal_l"], "meta": ["sid", "metadata_tags_t_title", "metadata_tags_t_bpm"]}
    assert schema.last_part_names(families["meta"]).columns == ["sid", "title", "bpm"]


def test_names_and_conform(spark):
    df = spark.createDataFrame([(1, 2, 3)], "sid int, tags_name int, b_bpm int")
    named = schema.last_part_names(df)
    assert named.columns == ["sid", "file_name", "bpm"]
    shaped, missing = schema.conform(named)
    assert shaped.columns == ["sid", "file_name", "bpm"] and "title" in missing and len(missing) == 10
    with pytest.raises(ValueError):
        schema.conform(named, ["title"])
    with pytest.raises(ValueError):
        schema.last_part_names(df.withColumn("c_bpm", F.lit(1)))
    assert schema.clean_names(spark.createDataFrame([(1, 2)], "`@Key` int, `a.b` int")).columns == ["Key", "a_b"]


def test_lists_and_families(spark):
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, [4])], "sid int, mfcc array<int>")
    assert sorted(map(tuple, schema.list_to_columns(df, "mfcc").collect())) == [(1, 1, 2, 3), (2, 4, None, None)]
    columns = ["rock___punk", "rock_n___roll", "rock___metal"]
    assert schema.family_map(columns) == {"rock": ["punk", "metal"], "rock_n": ["roll"]}
    wide = spark.createDataFrame([(1, 2, 3, 4)], "sid int, rock___punk int, rock_n___roll int, rock___metal int")
    assert schema.drop_families(wide, ["rock"]).columns == ["sid", "rock_n___roll"]


def test_repair(spark):
    tags = spark.createDataFrame([("a", "/LaCie/é 1.wav", None, None, "x", "1A"), ("b", "/LaCie/2.wav", 99.0, None, None, None), ("c", "/x", None, None, None, None)],
                                 "sid string, file_path string, bpm double, title string, artist string, initialkey string")
    export = spark.createDataFrame(
        [("9", "old", "o", "", "2A", "file://localhost/LaCie/%C3%A9%201.wav"), ("10", "new", "n", "120.5", "3A", "file://localhost/LaCie/e%CC%81%201.wav"),
         ("11", "two", "w", "1", "4A", "file://localhost/LaCie/2.wav")],
        "TrackID string, Name string, Artist string, AverageBpm string, Tonality string, Location string")
    got = sorted(map(tuple, repair.repair_tags(tags, export).collect()))
    assert got == [("a", "/LaCie/é 1.wav", 120.5, "new", "x", "1A"), ("b", "/LaCie/2.wav", 99.0, "two", "w", "4A"), ("c", "/x", None, None, None, None)]


def test_score_keeps_bad_rows_apart(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, [3.0, 4.0])], "sid int, embedding array<float>")

    def load_model():
        def predict(batch):
            if batch.shape[1] != 2:
                raise ValueError("two values please")
            return np.stack([batch.sum(axis=1), batch[:, 0]], axis=1)

        return predict

    good, bad = scoring.split_errors(scoring.score(df, load_model, ["total", "first"], new_ids=df.where("sid > 0")))
    assert values(good, "sid", "total", "first") == [(1, 3.0, 1.0), (3, 7.0, 3.0)]
    assert [(r.sid, "two values" in r.error) for r in bad.collect()] == [(2, True)]


def test_minmax_of_a_constant(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0), (2, 4.0, 5.0)], "sid int, a double, b double")
    assert values(scoring.minmax_scale(df, ["a", "b"]), "a_scaled", "b_scaled") == [(0.0, 0.0), (1.0, 0.0)]


def test_projection(spark):
    from cratelight.operators import projection

    rng = np.random.default_rng(2)
    data = rng.normal(size=(200, 5)) * [5, 3, 1, 0.5, 0.1] + 7
    vectors = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "sid bigint, embedding array<double>")
    fitted = projection.fit_projection(vectors)
    got = np.array([[r.component1, r.component2] for r in fitted.apply(vectors).orderBy("sid").collect()])
    centred = data - data.mean(axis=0)
    axes = np.linalg.svd(centred, full_matrices=False)[2][:2]
    axes *= np.sign(axes[np.arange(2), np.abs(axes).argmax(axis=1)])[:, None]
    assert got == pytest.approx(centred @ axes.T, abs=1e-6)
    assert got.var(axis=0)[0] > got.var(axis=0)[1]


def test_clusters(spark):
    from cratelight.operators import projection

    rows = [(i, [float(10 * (i % 2)) + i / 100, 1.0]) for i in range(20)]
    placed, quality = projection.clusters(spark.createDataFrame(rows, "sid bigint, embedding array<double>"), 2)
    assert quality > 0.9 and sorted(r["count"] for r in placed.groupBy("cluster").count().collect()) == [10, 10]


def test_zero_scores_align(spark):
    left = spark.createDataFrame([(1,), (2,)], "sid int")
    right = spark.createDataFrame([(2,), (3,)], "sid int")
    got = align.reconcile(left, right, "sid")
    assert sorted((r.sid, r.in_left, r.in_right) for r in got.collect()) == [(1, True, False), (2, True, True), (3, False, True)]
    assert values(align.only_new(left, right), "sid") == [(1,)] and values(align.only_known(left, right), "sid") == [(2,)]


@pytest.mark.parametrize("hot_rows", [2, 200_000])
def test_reconcile_splits_hot_keys(spark, monkeypatch, hot_rows):
    """Hot keys on either side, on both, on one alone, and null keys: the rows of a plain full outer join."""
    monkeypatch.setattr(align, "HOT_ROWS", hot_rows)
    rng = np.random.default_rng(5)
    keys = [["a"] * 9 + ["b"] * 2 + ["c"] * 8 + ["only left"] * 7 + [None] * 6 + [f"k{i}" for i in rng.integers(0, 12, 15)],
            ["a"] * 3 + ["b"] * 9 + ["c"] + ["only right"] * 7 + [None] * 5 + [f"k{i}" for i in rng.integers(6, 18, 15)]]
    left, right = [spark.createDataFrame([(k, i) for i, k in enumerate(side)], f"key string, {name} int").repartition(3) for side, name in zip(keys, "lr")]
    got = Counter((r.key, r.l, r.r, r.in_left, r.in_right) for r in align.reconcile(left, right, "key").collect())
    expected = Counter()
    for i, k in enumerate(keys[0]):
        partners = [j for j, other in enumerate(keys[1]) if k is not None and other == k]
        expected.update([(k, i, j, True, True) for j in partners] or [(k, i, None, True, False)])
    expected.update((k, None, j, False, True) for j, k in enumerate(keys[1]) if k is None or k not in keys[0])
    assert got == expected
    assert align._hot_keys(left, right, "key").count() == (0 if hot_rows > 2 else len({k for side in keys for k in side if k is not None and max(s.count(k) for s in keys) > 2}))


def test_reconcile_reads_each_side_once(spark, tmp_path):
    """One join, and no task gets all rows without key."""
    spark.range(3000).selectExpr("CAST(NULL AS bigint) AS key", "id AS l").write.parquet(str(tmp_path / "l"))
    spark.range(100).selectExpr("id AS key", "id AS r").write.parquet(str(tmp_path / "r"))
    joined = align.reconcile(spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r")), "key")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FullOuter") == 1 and plan.count("parquet") == 2
    assert joined.count() == 3100 and joined.where("in_left").count() == 3000


def test_saved_projection_and_scaler(spark, tmp_path):
    """What is loaded again places and scales songs as what was saved, also songs it was not fitted on."""
    from cratelight.operators import projection

    rng = np.random.default_rng(3)
    vectors = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(rng.normal(size=(100, 6)) * [6, 4, 2, 1, 1, 1] - 3)], "sid bigint, embedding array<double>")
    fitted = projection.fit_projection(vectors.where("sid % 2 = 0"), 3)
    for _ in range(2):  # a second save replaces the first
        fitted.save(str(tmp_path / "projection"))
    loaded = projection.Projection.load(spark, str(tmp_path / "projection"))
    assert loaded.apply(vectors).columns == ["sid", "component1", "component2", "component3"]
    assert sorted(loaded.apply(vectors).collect()) == sorted(fitted.apply(vectors).collect())
    assert loaded.explained == pytest.approx(fitted.explained)
    scores = spark.createDataFrame([(1, 2.0, 5.0), (2, 4.0, 5.0), (3, 6.0, None), (4, None, 7.0)], "sid int, happy double, calm double")
    scoring.value_range(scores.where("sid < 3"), ["happy", "calm"]).write.parquet(str(tmp_path / "scaler"))
    scaled = scoring.minmax_scale(scores, ["happy", "calm"], spark.read.parquet(str(tmp_path / "scaler")))
    assert values(scaled.where("sid <> 4"), "sid", "happy_scaled") == [(1, 0.0), (2, 1.0), (3, 2.0)]
    assert {r.sid: r.calm_scaled for r in scaled.collect()} == {1: 0.0, 2: 0.0, 3: None, 4: 2.0}


def test_family_lists(spark):
    classes = spark.createDataFrame([("rock___punk",), ("rock___metal",), ("rock___punk",), ("rock_n___roll",), ("noise",), (None,)], "class string")
    assert values(schema.family_lists(classes), "family", "subgenres", "n_subgenres") == [
        ("noise", [], 0), ("rock", ["metal", "punk"], 2), ("rock_n", ["roll"], 1)]


def test_compared_songs_unordered(spark):
    ids, _, _, matrix, tags, vectors = _library(spark, 12)
    pairs = similarity.pairs_of(spark, ids)
    named = tags.select("sid", F.concat(F.lit("t"), "sid").alias("title"), F.lit("x").alias("artist")).where(F.col("sid") != ids[3])
    ordered = similarity.compare_songs(pairs, vectors, named).collect()
    free = similarity.compare_songs(pairs, vectors, named, ordered=False)
    assert sorted(map(str, free.collect())) == sorted(map(str, ordered)) and len(ordered) == 66
    assert [r.score for r in ordered] == sorted(r.score for r in ordered)
    assert all((r.title1 is None) == (r.sid1 == ids[3]) for r in ordered)
    assert "Sort" not in free._jdf.queryExecution().optimizedPlan().toString()


def test_steps_do_not_shuffle_the_songs(spark, folder):
    """Of large stocks: in the plan of a step, the only Exchanges are of walks and of results."""
    from cratelight.plans import views

    songs = setlist.playable(views.tags(spark, folder), views.vectors(spark, folder))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with setlist.Stock(songs, 5, 2, "cosine") as stock:
            walks = stock.by_sid.table.select(F.col("sid").alias("seed"), "sid", F.array("sid").alias("excluded")).checkpoint()
            assert walks.columns == ["seed", "sid", "excluded"]  # what a step carries
            plan = stock.step(stock.located(walks), True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = [(len(line) - len(line.lstrip(" :+-")), line) for line in plan.splitlines()]
    for number, (depth, line) in enumerate(lines):
        if "FileScan" not in line:
            continue
        assert "Bucketed: true" in line
        for above, text in reversed(lines[:number]):
            if above < depth:
                depth = above
                if "SortMergeJoin" in text or "FlatMapCoGroups" in text:
                    break
                assert "Exchange" not in text


def _odd_pairs(spark):
    """Vectors that repeat, are null, hold nulls, are zero, empty, not finite or of other widths, and every pair of their ids."""
    nan, inf = float("nan"), float("inf")
    some = [(i, [0.1 * i, 0.7, -0.3 * i]) for i in range(30)] + [(30, [0.3, 0.2, 0.9]), (30, [0.1, 0.5, 0.5]), (31, None), (32, [1.0, None, 2.0]), (33, [0.0] * 3)]
    some += [(34, []), (35, [nan, 1.0, 1.0]), (36, [inf, 1.0, 1.0]), (37, [1.0, 2.0]), (38, [2.0, 1.0]), (None, [1.0, 1.0, 1.0]), (39, []), (31, [1.0, 1.0, 0.0])]
    vectors = spark.createDataFrame(some, "sid long, embedding array<float>")
    ids = [*range(42), None]
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids] + [(3, 5), (3, 5), (30, 30)], "sid1 long, sid2 long")
    return pairs, vectors


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_pairs_meet_vectors_in_a_grid_as_in_joins(spark, metric):
    pairs, vectors = _odd_pairs(spark)
    plain = similarity._joined(pairs, vectors, metric).collect()
    for blocks in (1, 3):
        met = similarity._met(pairs, vectors, metric, blocks).collect()
        assert sorted(str((r.sid1, r.sid2, r.score)) for r in met) == sorted(str((r.sid1, r.sid2, r.score)) for r in plain)


def test_no_pair_carries_a_vector_through_a_shuffle(spark, monkeypatch):
    """Vectors go to the cells of a grid, pairs as ids: nothing that holds an embedding is joined or ordered."""
    _, _, _, _, tags, vectors = _library(spark, 12)
    pairs = similarity.pairs_of(spark, list(range(1, 60)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = similarity._met(pairs, vectors, "cosine", 2)._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "Join" not in plan
        plain = similarity.compare_songs(pairs, vectors, tags).collect()
        monkeypatch.setattr(similarity, "FEW_PAIRS", 10)
        compared = similarity.compare_songs(pairs, vectors, tags)
        assert "embedding" not in compared._jdf.queryExecution().optimizedPlan().toString()
        assert compared.collect() == plain and plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("many", [1 << 20, 0])
def test_pairs_without_vectors_are_not_shuffled(spark, monkeypatch, many):
    """They go below the grouping of the pairs: by the ids of the vectors, or by the range of very many ids. Scores stay those of joins."""
    pairs, vectors = _odd_pairs(spark)
    far = spark.range(1000, 1500).select(F.col("id").alias("sid1"), (F.col("id") % 40).alias("sid2"))
    pairs = pairs.union(far).union(far.select("sid2", "sid1")).distinct()
    plain = similarity._joined(pairs, vectors, "cosine").collect()
    stored, keep = {}, similarity.written
    monkeypatch.setattr(similarity, "written", lambda df, name: stored.setdefault(name, df) and keep(df, name))
    monkeypatch.setattr(similarity, "MANY_IDS", many)
    got = similarity.pair_distances(pairs, vectors, "cosine").collect()
    assert sorted(str((r.sid1, r.sid2, r.score)) for r in got) == sorted(str((r.sid1, r.sid2, r.score)) for r in plain)
    assert stored["pairs"].count() == 40 * 40
    plan = stored["pairs"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Join LeftSemi" if many else "Filter")


def test_walks_of_all_songs_compare_once(spark, monkeypatch):
    """Walks from every song are those that compare at each step, and ask the blocks once; songs with two rows still compare at each step."""
    _, _, _, _, tags, vectors = _library(spark, 60)
    calls = []
    best = setlist.Stock.best
    monkeypatch.setattr(setlist.Stock, "best", lambda self, *rest: calls.append(rest[1]) or best(self, *rest))
    shared = values(setlist.setlists(tags, vectors, n_songs=6, bpm_window=5), "seed", "order", "sid")
    assert calls == [6] and max(order for _, order, _ in shared) == 7
    with monkeypatch.context() as patch:
        patch.setattr(setlist, "_once", lambda songs: False)
        assert values(setlist.setlists(tags, vectors, n_songs=6, bpm_window=5), "seed", "order", "sid") == shared
    assert calls == [6] + [1] * 6
    few = tags.select("sid").orderBy("sid").limit(2)
    some = {s for s, _, _ in values(setlist.setlists(tags, vectors, few, n_songs=3), "seed", "order", "sid")}
    assert calls == [6] + [1] * 9 and len(some) <= 2
    setlist.setlists(tags, vectors.unionByName(vectors.limit(3)), n_songs=2).collect()
    assert calls == [6] + [1] * 11
