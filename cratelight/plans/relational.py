"""Filters, joins, set operations and schema operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratelight.operators import align, repair, scenario, schema
from cratelight.plans import views
from cratelight.plans.registry import query
from cratelight.plans.views import GENRES, scan


@query("A1 B1 B2 D12", "tags", "SELECT sid, title, artist, bpm FROM tags")
def projected_scan(spark, d):
    return views.tags(spark, d).drop("length", "genre", "not_there").select("sid", "title", "artist", "bpm")


@query("A2 B11", sql="SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity <= 10 AND l_discount > 0.02")
def compare_filter(spark, d):
    items = scan(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return items.where("l_quantity <= 10 AND l_discount > 0.02").drop("l_discount")


@query("B7", "tags", "SELECT * FROM tags WHERE title = 'red widget'")
def point_lookup(spark, d):
    return views.tags(spark, d).where(F.col("title") == "red widget")


@query("B8 G4", "tags", "SELECT sid, title, initialkey FROM tags WHERE initialkey IN ('1A', '12A', '2A', '1B')")
def in_list(spark, d):
    return views.tags(spark, d).where(F.col("initialkey").isin("1A", "12A", "2A", "1B")).select("sid", "title", "initialkey")


@query("B8", "tags", "SELECT sid, title, genre FROM tags WHERE genre NOT IN ('PROMO', 'SMALL')")
def not_in_list(spark, d):
    return views.tags(spark, d).where(~F.col("genre").isin("PROMO", "SMALL")).select("sid", "title", "genre")


@query("B9 H13", "tags", "SELECT sid, bpm FROM tags WHERE bpm BETWEEN 100 AND 120")
def range_closed(spark, d):
    return views.tags(spark, d).where(F.col("bpm").cast("string").try_cast("double").between(100, 120)).select("sid", "bpm")


@query("B10", "mood", "SELECT sid, happy FROM mood WHERE happy >= 0.4 AND happy < 0.5")
def range_half_open(spark, d):
    return views.mood(spark, d).where((F.col("happy") >= 0.4) & (F.col("happy") < 0.5)).select("sid", "happy")


@query("B13", "export", "SELECT TrackID FROM export WHERE contains(path, 'LaCie')")
def substring_filter(spark, d):
    return views.export(spark, d).where(F.col("Location").contains("LaCie")).select("TrackID")


@query("B14", "holed_tags", "SELECT sid, title FROM holed_tags WHERE bpm IS NULL AND title IS NOT NULL")
def null_filter(spark, d):
    return views.holed_tags(spark, d).where("bpm IS NULL").dropna(subset=["title"]).select("sid", "title")


@query("B15 C6", "mood", "SELECT sid, danceable, happy FROM mood WHERE danceable < 0.5 AND happy >= 0.5")
def two_column_filter(spark, d):
    return views.mood(spark, d).where("danceable < 0.5 AND happy >= 0.5").select("sid", "danceable", "happy")


@query("B16 B9 B8 C6", "tags mood genres", """SELECT t.*, m.danceable, m.happy, g.electronic___house FROM tags t JOIN mood m USING (sid) JOIN genres g USING (sid)
    WHERE bpm BETWEEN 95 AND 135 AND initialkey IN ('1A', '2A', '3A', '4B', '5B', '6A') AND danceable BETWEEN 0.4 AND 0.6
    AND happy BETWEEN 0.2 AND 0.8 AND electronic___house BETWEEN 0.1 AND 0.9""")
def song_filter(spark, d):
    return scenario.filter_songs(
        views.tags(spark, d), views.mood(spark, d), views.genres(spark, d), {"danceable": (0.4, 0.6), "happy": (0.2, 0.8)},
        {"electronic___house": (0.1, 0.9)}, (95, 135), ["1A", "2A", "3A", "4B", "5B", "6A"],
    )


@query("B16", "tags", "SELECT * FROM tags WHERE bpm BETWEEN 95 AND 135")
def song_filter_tags_only(spark, d):
    return scenario.filter_songs(views.tags(spark, d), bpm=(95, 135))


@query("B17 B1", "genres", "SELECT sid, " + ", ".join(g for g in GENRES if not g.startswith("rock___")) + " FROM genres")
def drop_families(spark, d):
    return schema.drop_families(views.genres(spark, d), ["rock"])


@query("B3", "mood genres", "SELECT sid, " + ", ".join(g for g in GENRES if g.startswith("funk")) + " FROM genres")
def prefix_family(spark, d):
    return schema.split_by_prefix(views.genres(spark, d), {"soul": "funk", "jazz": "jazz"})["soul"]


@query("C1 A2", "tags files", "SELECT t.sid, artist, length, title, bpm, initialkey, file_path FROM tags t JOIN files f ON f.sid = t.sid")
def join_inner(spark, d):
    joined = views.tags(spark, d).join(views.files(spark, d), "sid")
    return joined.select("sid", "artist", "length", "title", "bpm", "initialkey", "file_path")


@query("C4", "vectors tags mood", "SELECT v.sid, label, title, happy FROM vectors v LEFT JOIN tags USING (sid) LEFT JOIN mood USING (sid)")
def join_left(spark, d):
    vectors = views.vectors(spark, d).select("sid", "label")
    return vectors.join(views.tags(spark, d).select("sid", "title"), "sid", "left").join(views.mood(spark, d).select("sid", "happy"), "sid", "left")


@query("C3", "vectors tags", """SELECT sid, label, title, v.sid IS NOT NULL AS in_left, t.sid IS NOT NULL AS in_right
    FROM vectors v FULL JOIN (SELECT * FROM tags WHERE bpm > 100) t USING (sid)""")
def join_outer(spark, d):
    left = views.vectors(spark, d).select("sid", "label")
    right = views.tags(spark, d).where("bpm > 100").select("sid", "title")
    return align.reconcile(left, right, "sid")


@query("C2 H6 H7 H8", "holed_tags export", "SELECT sid, TrackID, Name FROM holed_tags JOIN export ON file_path = path")
def nfkc_join(spark, d):
    return repair.match_export(views.holed_tags(spark, d), views.export(spark, d)).select("sid", "TrackID", "Name")


@query("C6", "tags mood vectors", "SELECT t.sid, title, happy, label FROM tags t JOIN mood USING (sid) JOIN vectors USING (sid)")
def align_inner(spark, d):
    frames = [views.tags(spark, d).select("sid", "title"), views.mood(spark, d).select("sid", "happy"), views.vectors(spark, d).select("sid", "label")]
    return align.align_inner(frames)


@query("C5", "tags mood vectors", "SELECT sid, title, danceable, label FROM tags FULL JOIN mood USING (sid) FULL JOIN vectors USING (sid)")
def align_outer(spark, d):
    frames = [views.tags(spark, d).select("sid", "title"), views.mood(spark, d).select("sid", "danceable"), views.vectors(spark, d).select("sid", "label")]
    return align.align_outer(frames)


@query("C9", "tags vectors", "SELECT sid, title FROM tags WHERE sid IN (SELECT sid FROM vectors)")
def semi(spark, d):
    return align.only_known(views.tags(spark, d).select("sid", "title"), views.vectors(spark, d))


@query("C10", "tags vectors", "SELECT sid, title FROM tags WHERE sid NOT IN (SELECT sid FROM vectors)")
def anti(spark, d):
    return align.only_new(views.tags(spark, d).select("sid", "title"), views.vectors(spark, d))


@query("G1", "tags vectors", "SELECT sid FROM tags INTERSECT SELECT sid FROM vectors")
def intersect_ids(spark, d):
    return views.tags(spark, d).select("sid").intersect(views.vectors(spark, d).select("sid"))


@query("G2", "tags vectors", "SELECT sid FROM tags EXCEPT SELECT sid FROM vectors")
def except_ids(spark, d):
    return views.tags(spark, d).select("sid").subtract(views.vectors(spark, d).select("sid"))


@query("G3", "tags vectors", "SELECT sid, title, NULL::INTEGER AS label FROM tags UNION ALL SELECT sid, NULL, label FROM vectors")
def union_batches(spark, d):
    return views.tags(spark, d).select("sid", "title").unionByName(views.vectors(spark, d).select("sid", "label"), allowMissingColumns=True)


@query("G4", sql="SELECT DISTINCT l_orderkey AS playlist, l_partkey AS sid FROM lineitem")
def playlist_set(spark, d):
    return scan(spark, d, "lineitem", "l_orderkey", "l_partkey").toDF("playlist", "sid").dropDuplicates(["playlist", "sid"])


@query("H15 B5", "mood", "SELECT sid, round(danceable * 100, 4) AS danceable, round(happy * 100, 4) AS happy FROM mood")
def cell_function(spark, d):
    scores = views.mood(spark, d).select("sid", F.col("danceable").alias("mood_score_danceable"), F.col("happy").alias("mood_score_happy"))
    return schema.last_part_names(schema.apply_cells(scores, lambda c: F.round(c * 100, 4)))


@query("H16", "vectors", "SELECT sid, " + ", ".join(f"embedding[{i + 1}] AS embedding_{i}" for i in range(64)) + " FROM vectors")
def list_to_columns(spark, d):
    doubles = views.vectors(spark, d).select("sid", F.col("embedding").cast("array<double>").alias("embedding"))
    return schema.list_to_columns(doubles, "embedding")


@query("D9 C3 D12", "holed_tags export", """SELECT count(sid) AS songs, count(TrackID) AS tracks, count(*) FILTER (sid IS NOT NULL AND TrackID IS NOT NULL) AS matched
    FROM holed_tags FULL JOIN export ON file_path = path""")
def export_reconciliation(spark, d):
    joined = repair.reconcile_export(views.holed_tags(spark, d), views.export(spark, d))
    return joined.agg(F.count_if("in_left").alias("songs"), F.count_if("in_right").alias("tracks"), F.count_if(F.col("in_left") & F.col("in_right")).alias("matched"))
