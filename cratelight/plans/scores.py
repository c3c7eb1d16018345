"""Pooling, statistics and scenarios over the derived music tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratelight.functions import arrays
from cratelight.operators import align, pooling, quantiles, ranking, scenario, schema, scoring, stats
from cratelight.operators.scenario import SCENARIOS, Rule
from cratelight.plans import views
from cratelight.plans.registry import query
from cratelight.plans.views import GENRES, MOODS
from cratelight.session import scratch_path


def _threshold(rule: Rule) -> str:
    return f"{rule.column} {rule.op} (SELECT round_even(quantile_cont({rule.column}, {rule.percentile}), 3) FROM mood)"


def _scenario_sql(name: str, columns: str = "t.title, t.artist, m.*") -> str:
    rules = " AND ".join(map(_threshold, SCENARIOS[name]))
    return f"SELECT {columns} FROM tags t JOIN mood m USING (sid) WHERE {rules}"


def _edition_sql(genre: str) -> str:
    return f"""WITH cut AS (SELECT quantile_cont({genre}, 0.75) AS c FROM genres)
        SELECT s.*, g.{genre} FROM ({_scenario_sql('club')}) s JOIN genres g USING (sid), cut WHERE g.{genre} >= cut.c"""


def _scenario(name: str):
    return lambda spark, d: scenario.scenario(views.stored_mood(spark, d), views.tags(spark, d), SCENARIOS[name])


@query("B12 D7 I6 C6 H12", "tags mood", _scenario_sql("winebar"))
def scenario_winebar(spark, d):
    return _scenario("winebar")(spark, d)


@query("B12 I6", "tags mood", _scenario_sql("winebar_relaxed"))
def scenario_winebar_relaxed(spark, d):
    return _scenario("winebar_relaxed")(spark, d)


@query("B12 I6", "tags mood", _scenario_sql("club"))
def scenario_club(spark, d):
    return _scenario("club")(spark, d)


@query("B12 I6", "tags mood", _scenario_sql("opening_act"))
def scenario_opening(spark, d):
    return _scenario("opening_act")(spark, d)


@query("B12 I6", "tags mood", _scenario_sql("day_party"))
def scenario_day(spark, d):
    return _scenario("day_party")(spark, d)


@query("C8 D7 I6", "tags mood genres", _edition_sql("electronic___disco"))
def scenario_club_disco(spark, d):
    return scenario.genre_edition(_scenario("club")(spark, d), views.genres(spark, d), "electronic___disco")


@query("C8 D7 I6", "tags mood genres", _edition_sql("electronic___house"))
def scenario_club_house(spark, d):
    return scenario.genre_edition(_scenario("club")(spark, d), views.genres(spark, d), "electronic___house")


@query("D7", "mood", " UNION ALL ".join(
    f"SELECT '{m}' AS name, {q}::DOUBLE AS q, round(quantile_cont({m}, {q}), 12) AS value FROM mood" for m in MOODS for q in (0.0, 0.2, 0.5, 0.75, 1.0)
))
def mood_quantiles(spark, d):
    found = quantiles.exact_quantiles(views.stored_mood(spark, d), {m: [0.0, 0.2, 0.5, 0.75, 1.0] for m in MOODS})
    return found.select("name", "q", F.round("value", 12).alias("value"))


@query("D7", sql="""SELECT 'l_extendedprice' AS name, q, round(v, 6) AS value FROM (
    SELECT 0.1::DOUBLE AS q, quantile_cont(l_extendedprice, 0.1) AS v FROM lineitem UNION ALL
    SELECT 0.5, quantile_cont(l_extendedprice, 0.5) FROM lineitem UNION ALL
    SELECT 0.99, quantile_cont(l_extendedprice, 0.99) FROM lineitem)""")
def price_quantiles(spark, d):
    items = views.scan(spark, d, "lineitem", "l_extendedprice")
    found = quantiles.exact_quantiles(items, {"l_extendedprice": [0.1, 0.5, 0.99]})
    return found.select("name", "q", F.round("value", 6).alias("value"))


@query("D1 D2 I7", "activations", """SELECT sid, class, round(avg(score), 6) AS mean_score,
    round(stddev_pop(score), 6) AS std_score, count(score) AS n_segments FROM activations GROUP BY sid, class""")
def pooled_scores(spark, d):
    pooled = pooling.pool_scores(views.activations(spark, d), ["sid", "class"])
    return pooled.select("sid", "class", F.round("mean_score", 6).alias("mean_score"), F.round("std_score", 6).alias("std_score"), "n_segments")


@query("D2 D19", "activations", "SELECT sid, round(stddev_pop(score), 6) AS std_score, count(*) AS n_segments FROM activations GROUP BY sid")
def pooled_std(spark, d):
    pooled = pooling.pool_scores(views.activations(spark, d), ["sid"])
    return pooled.select("sid", F.round("std_score", 6).alias("std_score"), "n_segments")


@query("A4 C5 K1", "mood", "SELECT sid, " + ", ".join(f"round({m}, 6) AS {m}" for m in MOODS) + " FROM mood")
def mood_wide(spark, d):
    tables = [
        (views.event_moods(spark, d), {m: m for m in views.EVENT_MOODS.values()}),
        (views.item_moods(spark, d), {m: m for m in views.ITEM_MOODS}),
    ]
    return align.load_scores(tables, pool=lambda cell: F.round(cell, 6))


@query("D1 D2 H18", "vectors", """SELECT sid, round(list_avg(embedding), 6) AS mean_score,
    round(list_stddev_pop(embedding), 6) AS std_score, len(embedding) AS n FROM vectors""")
def array_pooling(spark, d):
    v = F.col("embedding")
    return views.vectors(spark, d).select(
        "sid", F.round(arrays.mean_of(v), 6).alias("mean_score"), F.round(arrays.std_of(v), 6).alias("std_score"),
        F.size(v).cast("long").alias("n"),
    )


@query("I7 D1 D2", "vectors", """SELECT sid, 'happy' AS class, round(list_avg(embedding[33:]), 6) AS mean_score,
    round(list_stddev_pop(embedding[33:]), 6) AS std_score FROM vectors""")
def activation_head(spark, d):
    table = views.vectors(spark, d).select("sid", F.slice("embedding", 1, 32).alias("not_happy"), F.slice("embedding", 33, 32).alias("happy"))
    head = pooling.pool_activation_head(table.withColumnRenamed("not_happy", "non_happy"))
    return head.select("sid", "class", *[F.round(c, 6).alias(c) for c in ("mean_score", "std_score")])


@query("D18", "genre_segments", """SELECT sid, class, round(avg(score), 6) AS top_mean FROM (
    SELECT *, row_number() OVER (PARTITION BY sid, class ORDER BY score DESC) AS r FROM genre_segments) WHERE r <= 3
    GROUP BY sid, class""")
def topk_mean_pool(spark, d):
    top = pooling.top_segments_mean(views.genre_segments(spark, d), ["sid", "class"], "score", 3)
    return top.withColumn("top_mean", F.round("top_mean", 6))


@query("D18", "vectors", "SELECT sid, round(list_avg(list_reverse_sort(embedding)[1:8]), 6) AS top_mean FROM vectors")
def topk_mean_arrays(spark, d):
    return views.vectors(spark, d).select("sid", F.round(arrays.top_mean(F.col("embedding"), 8), 6).alias("top_mean"))


@query("D17 D8", "vectors", """SELECT s AS pair_sum, count(*) AS n FROM (
    SELECT round(list_avg(list_transform(range(1, 33), lambda i: embedding[i] + embedding[i + 32])), 2) AS s FROM vectors) GROUP BY s""")
def complement_check(spark, d):
    half = views.vectors(spark, d).select(
        arrays.pair_mean(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)).alias("m")
    )
    return stats.value_counts(half.select(F.round("m", 2).alias("pair_sum")), "pair_sum")


@query("D3", sql="""SELECT label, (pos - 1)::INTEGER AS pos, round(avg(x), 6) AS mean_value FROM (
    SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
    GROUP BY label, pos""")
def vector_mean_by_label(spark, d):
    means = pooling.vector_means(views.vectors(spark, d), ["label"], "embedding")
    return means.select("label", F.posexplode("mean_vector").alias("pos", "x")).select("label", "pos", F.round("x", 6).alias("mean_value"))


@query("D3 D1", "vectors", """SELECT sid, (u.i - 1)::INTEGER AS pos, round(list_avg([embedding[u.i], embedding[u.i + 16],
    embedding[u.i + 32], embedding[u.i + 48]]), 6) AS mean_value FROM vectors, (SELECT unnest(range(1, 17)) AS i) u""")
def matrix_means(spark, d):
    segments = F.array(*[F.slice("embedding", 1 + 16 * s, 16) for s in range(4)])
    pooled = views.vectors(spark, d).select("sid", F.posexplode(arrays.column_means(segments)).alias("pos", "x"))
    return pooled.select("sid", "pos", F.round("x", 6).alias("mean_value"))


@query("I8 D1 D19", "vectors", """SELECT sid, round(list_avg([embedding[4 * k + 2] for k in range(16)]), 6) AS funk,
    round(list_avg([embedding[4 * k + 4] for k in range(16)]), 6) AS zouk, 16::BIGINT AS n_segments FROM vectors""")
def class_arrays(spark, d):
    matrix = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.slice("embedding", k * 4 + 1, 4))
    songs = views.vectors(spark, d).select("sid", matrix.alias("m"))
    kept = scoring.class_arrays(songs, "m", ["disco", "funk", "house", "zouk"], ["funk", "zouk"])
    means = scoring.class_means(kept)
    return means.join(kept.select("sid", F.size("funk").cast("long").alias("n_segments")), "sid").select(
        "sid", F.round("funk", 6).alias("funk"), F.round("zouk", 6).alias("zouk"), "n_segments"
    )


_GENRE_LONG = f"UNPIVOT genres ON {', '.join(GENRES)} INTO NAME label VALUE score"


@query("D4 H18", "genres", f"SELECT label, round(avg(score), 6) AS mean_score FROM ({_GENRE_LONG}) GROUP BY label ORDER BY avg(score) DESC, label LIMIT 6")
def class_mean_top(spark, d):
    top = stats.largest_class_means(views.genres(spark, d), "sid", 6)
    return top.withColumn("mean_score", F.round("mean_score", 6))


@query("D5", "genres", f"SELECT label, count(*) FILTER (score >= 0.5) AS n_songs FROM ({_GENRE_LONG}) GROUP BY label ORDER BY n_songs DESC, label LIMIT 25")
def class_over_threshold(spark, d):
    return stats.classes_over(views.genres(spark, d), "sid", 0.5, 25)


@query("D6 D12", "tags", """SELECT count(*) AS count, round_even(avg(bpm), 3) AS mean, round_even(stddev_samp(bpm), 3) AS std,
    round_even(min(bpm), 3) AS min, round_even(quantile_cont(bpm, 0.25), 3) AS p25, round_even(quantile_cont(bpm, 0.5), 3) AS p50,
    round_even(quantile_cont(bpm, 0.75), 3) AS p75, round_even(max(bpm), 3) AS max FROM tags WHERE bpm > 0""")
def describe(spark, d):
    return quantiles.describe(views.tags(spark, d).where("bpm > 0"), "bpm")


@query("D11", "tags", """WITH b AS (SELECT min(length) AS lo, max(length) AS hi FROM tags)
    SELECT i::INTEGER AS bin, round(lo + i * (hi - lo) / 50, 6) AS left_edge, coalesce(c, 0)::BIGINT AS n
    FROM b, (SELECT unnest(range(50)) AS i) LEFT JOIN (
        SELECT least(floor((length - lo) / (hi - lo) * 50), 49)::BIGINT AS slot, count(*) AS c FROM tags, b GROUP BY slot) ON slot = i""")
def histogram(spark, d):
    return stats.histogram(views.tags(spark, d), "length", 50).withColumn("left_edge", F.round("left_edge", 6))


@query("D8", "tags", "SELECT initialkey, count(*) AS n FROM tags WHERE initialkey IS NOT NULL GROUP BY initialkey")
def value_counts(spark, d):
    return stats.value_counts(views.tags(spark, d), "initialkey")


@query("D9 B14", "holed_tags", """SELECT count(*) FILTER (bpm IS NULL) AS bpm_nulls, count(*) FILTER (title IS NULL) AS title_nulls,
    count(*) FILTER (artist IS NULL) AS artist_nulls, count(*) FILTER (bpm IS NULL OR title IS NULL OR artist IS NULL) AS any_nulls FROM holed_tags""")
def null_counts(spark, d):
    return stats.null_counts(views.holed_tags(spark, d), ["bpm", "title", "artist"])


@query("D10 B15", "mood", """SELECT round(avg(CASE WHEN danceable < 0.42 THEN 1.0 ELSE 0 END), 6) AS low_dance,
    round(avg(CASE WHEN danceable < 0.5 AND happy >= 0.45 THEN 1.0 ELSE 0 END), 6) AS calm_and_happy FROM mood""")
def fraction_pred(spark, d):
    shares = stats.fraction(views.mood(spark, d), {
        "low_dance": F.col("danceable") < 0.42, "calm_and_happy": F.expr("danceable < 0.5 AND happy >= 0.45"),
    })
    return shares.select(*[F.round(c, 6).alias(c) for c in shares.columns])


@query("D13", "mood", "SELECT " + ", ".join(f"min({m}) AS {m}_min, max({m}) AS {m}_max" for m in MOODS) + " FROM mood")
def column_ranges(spark, d):
    return stats.column_ranges(views.mood(spark, d), MOODS)


@query("D14", "tags", "SELECT DISTINCT initialkey FROM tags")
def distinct_keys(spark, d):
    return stats.distinct_values(views.tags(spark, d), "initialkey")


@query("D16 D8", "genres", "SELECT sid, " + "CASE greatest(" + ", ".join(GENRES) + ") "
       + " ".join(f"WHEN {g} THEN '{g}'" for g in GENRES) + " END AS dominant, greatest(" + ", ".join(GENRES) + ") AS dominant_score FROM genres")
def dominant_class(spark, d):
    return stats.dominant_class(views.genres(spark, d), "sid", GENRES)


@query("D20 H10 D14", "genre_segments", """SELECT string_split(class, '___')[1] AS family, string_split(class, '___')[2] AS subgenre,
    count(DISTINCT sid) AS n_songs FROM genre_segments GROUP BY ALL""")
def genre_families(spark, d):
    from cratelight.functions.labels import family, subgenre

    songs = views.genre_segments(spark, d).select("sid", "class").distinct().groupBy("class").agg(F.count("*").alias("n_songs"))
    return songs.select(family(F.col("class")).alias("family"), subgenre(F.col("class")).alias("subgenre"), "n_songs")


@query("D20 H10", "genre_segments", """SELECT family, string_agg(subgenre, ',' ORDER BY subgenre) AS subgenres, count(subgenre)::INTEGER AS n_subgenres
    FROM (SELECT DISTINCT string_split(class, '___')[1] AS family, string_split(class, '___')[2] AS subgenre FROM genre_segments) GROUP BY family""")
def family_lists(spark, d):
    lists = schema.family_lists(views.genre_segments(spark, d))
    return lists.withColumn("subgenres", F.array_join("subgenres", ","))


@query("I13", "mood", "SELECT sid, " + ", ".join(
    f"round(({m} - (SELECT min({m}) FROM mood WHERE sid % 2 = 0)) / (SELECT max({m}) - min({m}) FROM mood WHERE sid % 2 = 0), 6) AS {m}_scaled" for m in MOODS) + " FROM mood")
def saved_scaler(spark, d):
    """Fitted on every second song, stored, read back, and applied to all."""
    mood, path = views.stored_mood(spark, d), scratch_path(spark, "scaler")
    scoring.value_range(mood.where("sid % 2 = 0"), MOODS).write.parquet(path)
    scaled = scoring.minmax_scale(mood, MOODS, spark.read.parquet(path))
    return scaled.select("sid", *[F.round(f"{m}_scaled", 6).alias(f"{m}_scaled") for m in MOODS])


@query("I13", "mood", "SELECT sid, " + ", ".join(
    f"round(({m} - (SELECT min({m}) FROM mood)) / (SELECT max({m}) - min({m}) FROM mood), 6) AS {m}_scaled" for m in MOODS) + " FROM mood")
def minmax_scale(spark, d):
    scaled = scoring.minmax_scale(views.stored_mood(spark, d), MOODS)
    return scaled.select("sid", *[F.round(f"{m}_scaled", 6).alias(f"{m}_scaled") for m in MOODS])


@query("F1 D7 C4", "genres tags", """SELECT sid, title, artist, round_even(rock___funk, 4) AS rock___funk FROM (
    SELECT sid, rock___funk FROM genres WHERE rock___funk IS NOT NULL ORDER BY rock___funk DESC, sid LIMIT 10) LEFT JOIN tags USING (sid)""")
def top_songs(spark, d):
    return ranking.top_songs(views.genres(spark, d), views.tags(spark, d), "rock___funk", 10)


@query("F1", "mood tags", """SELECT sid, title, artist, round_even(arousal, 4) AS arousal FROM (
    SELECT sid, arousal FROM mood WHERE arousal IS NOT NULL ORDER BY arousal, sid LIMIT 10) LEFT JOIN tags USING (sid)""")
def bottom_songs(spark, d):
    return ranking.top_songs(views.mood(spark, d), views.tags(spark, d), "arousal", 10, ascending=True)


@query("F2 F3 C13", "mood tags", """SELECT sid, title, artist, bpm, initialkey, happy FROM (
    SELECT sid, happy FROM mood WHERE happy IS NOT NULL ORDER BY happy DESC, sid LIMIT 20) JOIN tags USING (sid)""")
def top_songs_tagged(spark, d):
    fields = ("title", "artist", "bpm", "initialkey")
    return ranking.top_songs(views.mood(spark, d), views.tags(spark, d), "happy", 20, how="inner", fields=fields, decimals=None)


@query("E2 H18 H11", "genres", f"""SELECT sid, label, score, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY sid
    ORDER BY score DESC, label) AS rank FROM ({_GENRE_LONG})) WHERE rank <= 5""")
def top_n_per_song(spark, d):
    return stats.top_classes(views.genres(spark, d), "sid", 5)


@query("E2", "genre_segments", """SELECT sid, class, rank::INTEGER AS rank, mean_score FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY mean_score DESC, class) AS rank
    FROM (SELECT sid, class, round(avg(score), 9) AS mean_score FROM genre_segments GROUP BY ALL)) WHERE rank <= 3""")
def top_n_long(spark, d):
    pooled = pooling.pool_scores(views.genre_segments(spark, d), ["sid", "class"]).select("sid", "class", F.round("mean_score", 9).alias("mean_score"))
    return ranking.top_per_group(pooled, "sid", "mean_score", 3, "class")


_MOOD_LONG = "SELECT sid, label, score FROM (" + " UNION ALL ".join(f"SELECT sid, '{m}' AS label, {m} AS score FROM mood" for m in MOODS) + ") WHERE score IS NOT NULL"
_SCALED_LONG = " UNION ALL ".join(
    f"SELECT sid, '{m}' AS label, {m} AS score, round(({m} - (SELECT min({m}) FROM mood)) / (SELECT max({m}) - min({m}) FROM mood), 6) AS scaled FROM mood" for m in MOODS)


@query("I18 E2 I13 H11", "genres mood", f"""SELECT sid, 'genre' AS kind, array_to_string(list_transform(string_split(regexp_replace(label, '_+', ' ', 'g'), ' '),
        lambda w: upper(w[1]) || lower(w[2:])), ' ') AS label, score, NULL::DOUBLE AS scaled FROM (SELECT *, row_number() OVER (PARTITION BY sid
    ORDER BY score DESC, label) AS rank FROM ({_GENRE_LONG})) WHERE rank <= 5
    UNION ALL SELECT sid, 'mood', upper(label[1]) || label[2:], score, scaled FROM ({_SCALED_LONG}) WHERE score IS NOT NULL""")
def song_card(spark, d):
    return song_cards(views.genres(spark, d), views.stored_mood(spark, d))


def song_cards(genres, mood):
    """Top five genres and all moods, raw and scaled, of every song."""
    from cratelight.functions.labels import display_label

    best = stats.top_classes(genres, "sid", 5)
    moods = [c for c in mood.columns if c != "sid"]
    scaled = scoring.minmax_scale(mood, moods)
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("label"), F.col(m).alias("score"), F.col(f"{m}_scaled").alias("scaled")) for m in moods]))
    parts = [
        best.select("sid", F.lit("genre").alias("kind"), "label", "score", F.lit(None).cast("double").alias("scaled")),
        scaled.select("sid", F.lit("mood").alias("kind"), each.alias("m")).select("sid", "kind", "m.label", "m.score", F.round("m.scaled", 6).alias("scaled")).where("score IS NOT NULL"),
    ]
    return parts[0].unionByName(parts[1]).withColumn("label", display_label(F.col("label")))


@query("F6 B10", "mood tags", """SELECT sid, title, artist, round_even(happy, 4) AS happy, round_even(sad, 4) AS sad FROM (SELECT * FROM mood
    WHERE happy >= 0.45 AND happy < 0.55 ORDER BY md5('1:' || sid), sid LIMIT 10) JOIN tags USING (sid)""")
def seeded_sample(spark, d):
    return ranking.seeded_sample(views.mood(spark, d), views.tags(spark, d), "happy", (0.45, 0.55), 10, 1, carry=("sad",))


@query("F5", "tags mood", f"SELECT * FROM ({_scenario_sql('winebar_relaxed')}) ORDER BY md5('1:' || sid), sid LIMIT 5")
def random_sample(spark, d):
    return ranking.random_sample(_scenario("winebar_relaxed")(spark, d), 5, seed=1)


@query("H14 E1", "activations", """SELECT sid, class, pos, round(pos * 2.05::DOUBLE, 6) AS start_second, round(score, 9) AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY sid, class ORDER BY ts, event_id) - 1 AS pos FROM activations)""")
def timeline(spark, d):
    placed = pooling.positions(views.activations(spark, d), ["sid", "class"], ["ts", "event_id"])
    return pooling.timeline(placed).select("sid", "class", "pos", F.round("start_second", 6).alias("start_second"), F.round("score", 9).alias("score"))


@query("H14", "vectors", """SELECT sid, (generate_subscripts(embedding, 1) - 1)::INTEGER AS pos, round((generate_subscripts(embedding, 1) - 1) * 2.05::DOUBLE, 6) AS start_second,
    unnest(embedding) AS score FROM vectors""")
def array_timeline(spark, d):
    rows = pooling.timeline_from_arrays(views.vectors(spark, d), "sid", "embedding")
    return rows.select("sid", "pos", F.round("start_second", 6).alias("start_second"), F.col("score").cast("double").alias("score"))


@query("H22", "activations", """WITH placed AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY ts, event_id) - 1 AS pos FROM activations),
    cut AS (SELECT sid, pos // 12 AS patch, count(*) AS n_frames, sum(score) AS total, arg_min(score, pos) AS head FROM placed GROUP BY ALL)
    SELECT sid, patch, n_frames::INTEGER AS n_frames, 12::INTEGER AS width, round(total, 6) AS total, round(head, 6) AS head FROM cut WHERE n_frames = 12 OR patch = 0""")
def patches(spark, d):
    placed = pooling.positions(views.activations(spark, d), ["sid"], ["ts", "event_id"])
    cut = pooling.patches(placed, ["sid"], "pos", "score", 12)
    return cut.select("sid", "patch", "n_frames", F.size("frames").alias("width"),
                      F.round(F.aggregate("frames", F.lit(0.0), lambda a, x: a + x), 6).alias("total"), F.round(F.col("frames")[0], 6).alias("head"))


@query("H23", "activations", "SELECT sid, event_id, round(log10(10000 * score + 1), 6) AS compressed FROM activations")
def log_compress(spark, d):
    return views.activations(spark, d).select("sid", "event_id", F.round(arrays.log_compress(F.col("score")), 6).alias("compressed"))


@query("H18", "mood", _MOOD_LONG)
def unpivot_scores(spark, d):
    return stats.long_scores(views.mood(spark, d), "sid").where("score IS NOT NULL")
