"""Similarity, recommendation, scoring and projection."""

from __future__ import annotations

import json
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from cratelight.functions.vectors import METRICS
from cratelight.operators import ann, pivots, projection, scoring, setlist, similarity, stats
from cratelight.operators.pooling import vector_means
from cratelight.plans import views
from cratelight.plans.registry import query
from cratelight.plans.views import GENRES, scan
from cratelight.session import scratch_path

_COSINE = "round(greatest(0.0, 1 - list_dot_product({0}, {1}) / sqrt(list_dot_product({0}, {0}) * list_dot_product({1}, {1}))), 6)"
_EUCLID = "round(list_distance({0}, {1}), 6)"


@query("I1 I2 H17 F4", "vectors tags", f"""WITH r AS (SELECT * FROM vectors ORDER BY sid LIMIT 1),
    n AS (SELECT r.sid AS seed, v.sid, {_COSINE.format('r.embedding', 'v.embedding')} AS distance FROM vectors v, r WHERE v.sid <> r.sid),
    t AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY distance, sid) AS rank FROM n)
    SELECT seed, rank::INTEGER AS rank, sid, title, artist, bpm, initialkey, distance FROM t JOIN tags USING (sid) WHERE rank <= 10""")
def knn_cosine(spark, d):
    vectors = views.vectors(spark, d)
    found = similarity.nearest(vectors, vectors.orderBy("sid").limit(1), 10, "cosine")
    return similarity.with_tags(found, views.tags(spark, d))


@query("I1 I2 H17 E2", "vectors tags", f"""WITH r AS (SELECT arg_min(sid, sid) AS sid, arg_min(embedding, sid) AS embedding FROM vectors GROUP BY label),
    n AS (SELECT r.sid AS seed, v.sid, {_EUCLID.format('r.embedding', 'v.embedding')} AS distance FROM vectors v, r WHERE v.sid <> r.sid),
    t AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY distance, sid) AS rank FROM n)
    SELECT seed, rank::INTEGER AS rank, sid, title, artist, bpm, initialkey, distance FROM t JOIN tags USING (sid) WHERE rank <= 5""")
def knn_euclid(spark, d):
    vectors = views.vectors(spark, d)
    refs = vectors.groupBy("label").agg(F.min_by(F.struct("sid", "embedding"), "sid").alias("r")).select("r.*")
    return similarity.with_tags(similarity.nearest(vectors, refs, 5, "euclidean"), views.tags(spark, d))


def _requested_pairs(spark, d):
    """Pairs of songs to compare: each line item asks for its part and its supplier's number."""
    items = scan(spark, d, "lineitem", F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"))
    return items.where("a <> b").select(F.least("a", "b").alias("sid1"), F.greatest("a", "b").alias("sid2")).distinct()


def _pairs_sql(metric: str) -> str:
    return f"""WITH p AS (SELECT DISTINCT least(l_partkey, l_suppkey) AS sid1, greatest(l_partkey, l_suppkey) AS sid2 FROM lineitem WHERE l_partkey <> l_suppkey)
    SELECT sid1, t1.title AS title1, t1.artist AS artist1, sid2, t2.title AS title2, t2.artist AS artist2, {metric.format('v1.embedding', 'v2.embedding')} AS score
    FROM p JOIN vectors v1 ON v1.sid = sid1 JOIN vectors v2 ON v2.sid = sid2 LEFT JOIN tags t1 ON t1.sid = sid1 LEFT JOIN tags t2 ON t2.sid = sid2"""


@query("C12 C11 H17 F3", "vectors tags", _pairs_sql(_COSINE))
def compare_songs(spark, d):
    return similarity.compare_songs(_requested_pairs(spark, d), views.vectors(spark, d), views.tags(spark, d), "cosine")


@query("C12 C11 H17", "vectors tags", _pairs_sql(_EUCLID))
def compare_songs_euclid(spark, d):
    return similarity.compare_songs(_requested_pairs(spark, d), views.vectors(spark, d), views.tags(spark, d), "euclidean")


@query("C11 I1 E2", "vectors", f"""WITH n AS (SELECT r.sid AS seed, v.sid, {_EUCLID.format('r.embedding', 'v.embedding')} AS distance FROM vectors v JOIN vectors r ON v.sid <> r.sid)
    SELECT seed, sid, distance, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY distance, sid) AS rank FROM n) WHERE rank <= 3""")
def nearest_of_every_song(spark, d):
    vectors = views.vectors(spark, d)
    return pivots.nearest_of_many(vectors, vectors, 3, "euclidean")


_KEY_STEPS = """(CASE WHEN abs(a.kn - b.kn) = 11 THEN 1 ELSE abs(a.kn - b.kn) END + CASE WHEN a.kl <> b.kl THEN 1 ELSE 0 END)"""
_KEYED = "k AS (SELECT *, initialkey[:-2]::INTEGER AS kn, initialkey[-1] AS kl FROM tags)"
_EDGES = f"""{_KEYED}, edges AS (SELECT a.sid AS src, b.sid AS dst, {_COSINE.format('va.embedding', 'vb.embedding')} AS distance FROM k a JOIN k b
    ON b.bpm BETWEEN a.bpm - 5 AND a.bpm + 5 AND a.sid <> b.sid AND {_KEY_STEPS} < 2 JOIN vectors va ON va.sid = a.sid JOIN vectors vb ON vb.sid = b.sid)"""


@query("C14 H5 B9", "tags", f"""WITH {_KEYED} SELECT a.sid, count(b.sid) AS n_candidates FROM k a LEFT JOIN k b
    ON b.bpm BETWEEN a.bpm - 5 AND a.bpm + 5 AND a.sid <> b.sid AND {_KEY_STEPS} < 2 GROUP BY a.sid""")
def candidate_edges(spark, d):
    return setlist.candidate_pool(views.tags(spark, d), 5, 2)


def _band(window: str) -> str:
    return _EDGES.replace("b.bpm BETWEEN a.bpm - 5 AND a.bpm + 5", f"b.bpm / 10 BETWEEN a.bpm / 10 - {window} AND a.bpm / 10 + {window}")


@query("I4 C14", "tags vectors", f"""WITH {_band('0.3')} SELECT src AS seed, first(dst ORDER BY distance, dst) AS sid, min(distance) AS distance FROM edges GROUP BY src""")
def next_song_fraction(spark, d):
    # tempos in tenths and a band that they do not divide
    tags = views.tags(spark, d).withColumn("bpm", F.col("bpm") / 10)
    return setlist.next_song(tags, views.vectors(spark, d), bpm_window=0.3)


@query("I4 C14", "tags vectors", f"""WITH {_band('0.0')} SELECT src AS seed, first(dst ORDER BY distance, dst) AS sid, min(distance) AS distance FROM edges GROUP BY src""")
def next_song_same_tempo(spark, d):
    tags = views.tags(spark, d).withColumn("bpm", F.col("bpm") / 10)
    return setlist.next_song(tags, views.vectors(spark, d), bpm_window=0)


@query("I4 C14 D15 C10", "tags vectors", f"""WITH {_EDGES} SELECT src AS seed, first(dst ORDER BY distance, dst) AS sid, min(distance) AS distance FROM edges GROUP BY src""")
def next_song(spark, d):
    return setlist.next_song(views.tags(spark, d), views.vectors(spark, d), bpm_window=5)


@query("I5 E1 G2", "tags vectors", f"""WITH RECURSIVE {_EDGES.replace('edges AS (', 'edges AS MATERIALIZED (')},
    walk AS (SELECT k.sid AS seed, 1 AS step, k.sid, [k.sid] AS seen FROM k JOIN vectors USING (sid)
      UNION ALL SELECT seed, step + 1, first(dst ORDER BY distance, dst), list_append(seen, first(dst ORDER BY distance, dst))
      FROM walk JOIN edges ON src = sid AND NOT list_contains(seen, dst) WHERE step <= 10 GROUP BY seed, step, seen)
    SELECT seed, step::INTEGER AS "order", walk.sid, title, artist FROM walk JOIN tags USING (sid)""", name="setlist")
def setlist_walks(spark, d):
    tags = views.tags(spark, d)
    walks = setlist.setlists(tags, views.vectors(spark, d), n_songs=10, bpm_window=5)
    return walks.join(tags.select("sid", "title", "artist"), "sid").select("seed", "order", "sid", "title", "artist")


def _asked(spark, d):
    """The vectors, the index of them (written once), and every 50th song, which asks it."""
    vectors, path = views.vectors(spark, d), scratch_path(spark, "index")
    quantiser = ann.fit(vectors)
    if quantiser is not None:
        ann.build(vectors, path, quantiser)
    return vectors, path, vectors.where("sid % 50 = 0")


@query("I3 I2 H17", "", None)
def ann_knn(spark, d):
    _, path, refs = _asked(spark, d)
    return ann.search(refs, path, 5)


@query("I3 I1", "vectors", "SELECT count(*) AS n_references, TRUE AS recall_reached FROM vectors WHERE sid % 50 = 0 AND len(embedding) > 0")
def ann_recall(spark, d):
    # the index against the exact search: at least nine of ten neighbours are found
    vectors, path, refs = _asked(spark, d)
    found, exact = ann.search(refs, path, 5), similarity.nearest(vectors, refs, 5, "cosine")
    both = exact.join(found.select("seed", "sid", F.lit(1).alias("hit")), ["seed", "sid"], "left")
    return both.agg(F.countDistinct("seed").alias("n_references"), (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("recall_reached"))


@query("I1 I2 H17", "vectors", f"""WITH s AS (SELECT sid, list_transform(embedding, lambda x: x * 1000) AS embedding, label FROM vectors UNION ALL
    SELECT sid + 1000000, list_transform(embedding, lambda x: x * 1000), label FROM vectors WHERE sid % 10 = 0),
    r AS (SELECT * FROM s WHERE sid >= 1000000), n AS (SELECT r.sid AS seed, s.sid, {_EUCLID.format('r.embedding', 's.embedding')} AS distance FROM s, r WHERE s.sid <> r.sid),
    t AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY distance, sid) AS rank FROM n) SELECT seed, sid, distance, rank::INTEGER AS rank FROM t WHERE rank <= 1""")
def knn_euclid_scaled(spark, d):
    # long vectors, some of them twice: a copy is at distance 0
    scaled = views.vectors(spark, d).withColumn("embedding", F.transform("embedding", lambda x: x.cast("double") * 1000))
    copies = scaled.where("sid % 10 = 0").withColumn("sid", F.col("sid") + 1000000)
    return pivots.nearest_of_many(scaled.unionByName(copies), copies, 1, "euclidean")


@query("I11 I12")
def pca2(spark, d):
    vectors = views.vectors(spark, d)
    fitted = projection.fit_projection(vectors)
    placed = projection.song_map(fitted, vectors, views.tags(spark, d))
    return placed.withColumns({c: F.round(c, 6) for c in ("component1", "component2")})


_PARTS = "x AS (SELECT generate_subscripts(embedding, 1) AS pos, unnest(embedding) AS x FROM vectors)"


@query("I11 I12", "vectors", f"""WITH {_PARTS}, v AS (SELECT var_pop(x) AS v FROM x GROUP BY pos)
    SELECT (SELECT count(*) FROM vectors) AS n, round(sum(v), 4) AS variance, TRUE AS falling, TRUE AS uncorrelated FROM v""")
def map_variance(spark, d):
    # all axes together keep the whole variance, each has less than the one before, and the first two do not vary together
    vectors = views.vectors(spark, d)
    width = vectors.agg(F.max(F.size("embedding"))).first()[0]
    placed = projection.fit_projection(vectors, width).apply(vectors)
    spread = [F.var_pop(f"component{i + 1}") for i in range(width)]
    facts = placed.agg(F.count("*").alias("n"), F.array(*spread).alias("v"), F.covar_pop("component1", "component2").alias("c"))
    total = F.aggregate("v", F.lit(0.0), lambda total, x: total + x)
    falling = F.forall(F.arrays_zip(F.slice("v", 1, width - 1).alias("a"), F.slice("v", 2, width - 1).alias("b")), lambda p: p["a"] >= p["b"] - 1e-9)
    return facts.select("n", F.round(total, 4).alias("variance"), falling.alias("falling"), (F.abs("c") < 1e-6 * total).alias("uncorrelated"))


@query("I17", "vectors", f"""WITH {_PARTS}, t AS (SELECT sum(x * x) - sum(x) * sum(x) / count(*) AS t FROM x GROUP BY pos)
    SELECT (SELECT count(*) FROM vectors) AS n, round(sum(t), 3) AS total, TRUE AS tighter FROM t""")
def cluster_spread(spark, d):
    # every song is in one cluster; spread inside the clusters and between them is the whole spread, and more is between them than
    # one and a half times what a cut at random has on average
    vectors = views.vectors(spark, d)
    placed, _ = projection.clusters(vectors, k=10)
    values = placed.join(vectors, "sid").select("sid", "cluster", F.posexplode("embedding").alias("pos", "value")).withColumn("value", F.col("value").cast("double"))
    cells = values.groupBy("cluster", "pos").agg(F.count("*").alias("n"), F.sum("value").alias("s"), F.sum(F.col("value") ** 2).alias("q"))
    axes = cells.groupBy("pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("q") - F.col("s") ** 2 / F.col("n")).alias("inside"),
        (F.sum(F.col("s") ** 2 / F.col("n")) - F.sum("s") ** 2 / F.sum("n")).alias("between"),
    )
    total, by_chance = F.sum("inside") + F.sum("between"), F.lit(9.0) / (F.max("n") - 1)
    return axes.agg(F.max("n").alias("n"), F.round(total, 3).alias("total"), (F.sum("between") > 1.5 * by_chance * total).alias("tighter"))


@query("I12 I11")
def saved_projection(spark, d):
    """Fitted on every second song, saved, loaded into a fresh object, and applied to all."""
    vectors, folder = views.vectors(spark, d), scratch_path(spark, "projection")
    projection.fit_projection(vectors.where("sid % 2 = 0")).save(folder)
    placed = projection.song_map(projection.Projection.load(spark, folder), vectors, views.tags(spark, d))
    return placed.withColumns({c: F.round(c, 6) for c in ("component1", "component2")})


@query("I17")
def kmeans(spark, d):
    placed, quality = projection.clusters(views.vectors(spark, d), k=10)
    return placed.select("sid", "cluster").withColumn("silhouette", F.lit(round(quality, 6)))


_HEAD = """WITH c AS (SELECT label, pos, avg(x) AS w FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM vectors) GROUP BY ALL),
    w AS (SELECT label, list(w * 4 ORDER BY pos) AS w FROM c GROUP BY label)"""


@query("I9 K2 D1", "vectors", f"{_HEAD} SELECT sid, w.label AS class, round(1 / (1 + exp(-list_dot_product(embedding, w.w))), 5) AS score FROM vectors, w")
def score_head(spark, d):
    # one weight row per class, learned from the labelled vectors
    vectors = views.vectors(spark, d)
    weights = vector_means(vectors, ["label"], "embedding").select(
        F.struct("label", F.transform("mean_vector", lambda x: x * 4).alias("w")).alias("c")
    ).agg(F.array_sort(F.collect_list("c")).alias("head")).select("head").scalar()
    scored = vectors.withColumn("head", weights).select(
        "sid", F.col("head.label").alias("class"), scoring.linear_head(F.col("embedding"), F.col("head.w")).alias("score")
    )
    rows = scored.select("sid", F.explode(F.arrays_zip("class", "score")).alias("r"))
    return rows.select("sid", "r.class", F.round("r.score", 5).alias("score"))


@query("I9 I10 K2 A16", "vectors tags", f"""{_HEAD}, s AS (SELECT sid, w.label, round(1 / (1 + exp(-list_dot_product(embedding, w.w))), 5) AS score FROM vectors, w)
    SELECT sid, {', '.join(f'max(score) FILTER (label = {k}) AS class_{k}' for k in range(10))} FROM s WHERE sid IN (SELECT sid FROM tags) GROUP BY sid""")
def score_model(spark, d):
    vectors = views.vectors(spark, d)
    # one row of weights per class comes to the driver
    model = vector_means(vectors, ["label"], "embedding").orderBy("label").collect()
    classes = [f"class_{row['label']}" for row in model]
    weights = np.array([row["mean_vector"] for row in model]) * 4

    def load_model():
        return lambda batch: 1 / (1 + np.exp(-(batch.astype(np.float64) @ weights.T)))

    scored = scoring.score(vectors, load_model, classes, new_ids=views.tags(spark, d))
    good, _ = scoring.split_errors(scored)
    return good.select("sid", *[F.round(c, 5).alias(c) for c in classes])


@query("I9 A16 I7", "vectors", """WITH m AS (SELECT sid, unnest(range(4)) AS seg, embedding FROM vectors), s AS (SELECT sid, seg, embedding[seg * 16 + 1 : seg * 16 + 16] AS v FROM m)
    SELECT sid, seg::INTEGER AS seg, CASE WHEN sid % 7 <> 3 THEN round(1 / (1 + exp(-list_sum(v))), 5) END AS up, CASE WHEN sid % 7 <> 3 THEN round(1 / (1 + exp(-(v[1] - v[16]))), 5) END AS side,
    sid % 7 = 3 AS rejected FROM s WHERE sid % 7 <> 3 OR seg = 0""")
def score_segments(spark, d):
    # the 64 components as 4 segments of 16; every seventh song has a broken segment, which the model rejects
    parts = F.array(*[F.slice("embedding", 1 + 16 * k, F.when((F.col("sid") % 7 == 3) & F.lit(k == 2), 15).otherwise(16)) for k in range(4)])

    def load_model():
        def model(segments):
            x = segments.astype(np.float64)
            return 1 / (1 + np.exp(-np.stack([x.sum(1), x[:, 0] - x[:, 15]], 1)))

        return model

    scored = scoring.score_segments(views.vectors(spark, d).select("sid", parts.alias("segments")), load_model, ["up", "side"])
    good, bad = scoring.split_errors(scored)
    rows = good.select("sid", F.posexplode(F.arrays_zip("up", "side")).alias("seg", "s")).select(
        "sid", "seg", F.round("s.up", 5).alias("up"), F.round("s.side", 5).alias("side"), F.lit(False).alias("rejected"))
    none = F.lit(None).cast("double")
    return rows.union(bad.select("sid", F.lit(0), none, none, F.lit(True)))


def _linear_model(file: str):
    """A model file of one weight row per class."""
    weights = np.array(json.loads(Path(file).read_text()))
    return lambda segments: 1 / (1 + np.exp(-(segments.astype(np.float64) @ weights.T)))


@query("I9 I10 K2 H21 A11 A12 C10", "vectors", """WITH c AS (SELECT label, pos, avg(x) AS w FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM vectors) GROUP BY ALL),
    w AS (SELECT label, list(w * 4 ORDER BY pos)[1:16] AS w FROM c WHERE label < 2 GROUP BY label),
    m AS (SELECT sid, unnest(range(4)) AS seg, embedding FROM vectors),
    s AS (SELECT sid, seg, label, round(1 / (1 + exp(-list_dot_product(embedding[seg * 16 + 1 : seg * 16 + 16], w.w))), 5) AS score FROM m, w)
    SELECT CASE WHEN sid % 2 = 0 THEN 'first' ELSE 'second' END AS job, sid, seg::INTEGER AS seg, max(score) FILTER (label = 0) AS class_0, max(score) FILTER (label = 1) AS class_1 FROM s GROUP BY ALL""")
def score_library(spark, d):
    # half of the songs, then all of them: the second job scores only the others; a repeated job changes nothing
    vectors, root = views.vectors(spark, d), scratch_path(spark, "activations")
    means = vector_means(vectors.where("label < 2"), ["label"], "embedding").orderBy("label").collect()  # two rows of weights
    weights = scoring.store_file(spark, json.dumps([[4 * x for x in row["mean_vector"][:16]] for row in means]), "model")
    classes = scoring.store_file(spark, "\n".join(f"class_{row['label']}" for row in means), "classes")
    parts = F.array(*[F.slice("embedding", 1 + 16 * k, 16) for k in range(4)])
    songs = vectors.select("sid", parts.alias("segments"))
    for job, batch in (("first", songs.where("sid % 2 = 0")), ("second", songs), ("first", songs.where("sid % 2 = 0"))):
        stored = scoring.score_job(batch, weights, classes, _linear_model, root, "heads", job)
    rows = stored.select("job", "sid", F.posexplode(F.arrays_zip("class_0", "class_1")).alias("seg", "s"))
    return rows.select("job", "sid", "seg", F.round("s.class_0", 5).alias("class_0"), F.round("s.class_1", 5).alias("class_1"))


@query("I14 D16 C6", "vectors genres tags", "SELECT v.sid, generate_subscripts(v.embedding, 1)::INTEGER - 1 AS pos, round(unnest(v.embedding), 6) AS x, CASE greatest("
       + ", ".join(GENRES) + ") " + " ".join(f"WHEN {g} THEN '{g}'" for g in GENRES) + " END AS dominant, title, artist FROM vectors v JOIN genres USING (sid) JOIN tags USING (sid)")
def labelled_export(spark, d):
    labels = stats.dominant_class(views.genres(spark, d), "sid", GENRES).select("sid", "dominant")
    rows = projection.labelled_vectors(views.vectors(spark, d), labels, views.tags(spark, d))
    placed = rows.select("sid", F.posexplode("embedding").alias("pos", "x"), "dominant", "title", "artist")
    return placed.withColumn("x", F.round(F.col("x").cast("double"), 6))


@query("H17", "vectors", f"""WITH r AS (SELECT embedding FROM vectors ORDER BY sid LIMIT 1) SELECT v.sid, {_COSINE.format('v.embedding', 'r.embedding')} AS cosine,
    {_EUCLID.format('v.embedding', 'r.embedding')} AS euclid FROM vectors v, r""")
def vector_distances(spark, d):
    vectors = views.vectors(spark, d)
    pairs = vectors.withColumn("first", vectors.agg(F.min_by("embedding", "sid")).scalar())
    sides = F.col("embedding"), F.col("first")
    return pairs.select("sid", F.round(METRICS["cosine"](*sides), 6).alias("cosine"), F.round(METRICS["euclidean"](*sides), 6).alias("euclid"))
