"""Ingest: content ids, documents, exports, repair and the file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratelight.functions.paths import export_path
from cratelight.operators import repair, schema
from cratelight.plans import views
from cratelight.plans.registry import query
from cratelight.session import scratch_path
from cratelight.sources import documents, library_xml, tables
from cratelight.sources.audio_files import existing_only, hashed_files, list_files
from cratelight.plans.views import scan
from cratelight.streaming import ingest as library
from cratelight.streaming.ingest import ingest_stream, new_content

_CONTENT = "SELECT md5(text) AS sid, min('/' || lang || '/' || source || '/' || lpad(doc_id::VARCHAR, 12, '0')) AS file_path FROM documents"


def _content(df):
    path = F.concat(F.lit("/"), "lang", F.lit("/"), "source", F.lit("/"), F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    return df.select(F.md5("text").alias("sid"), path.alias("file_path"))


@query("A9 C10 A14", sql=f"{_CONTENT} WHERE md5(text) NOT IN (SELECT md5(text) FROM documents JOIN labels USING (doc_id)) GROUP BY 1")
def dedupe_ingest(spark, d):
    docs = scan(spark, d, "documents", "doc_id", "text", "lang", "source")
    known = _content(docs.join(scan(spark, d, "labels", "doc_id"), "doc_id", "left_semi"))
    return new_content(_content(docs), known)


_FILES = "sid string, file_path string"


def _arriving(spark, d):
    """The documents as a file stream; the table may be one file or a folder of part files, so it is named by a pattern that fits either."""
    fields = scan(spark, d, "documents").schema
    return spark.readStream.schema(fields).parquet(f"{d}/documents.parque[t]")


@query("A14 A9 G3", sql=f"{_CONTENT} GROUP BY 1")
def stream_ingest(spark, d):
    table, progress = scratch_path(spark, "files"), scratch_path(spark, "progress")
    ingest_stream(spark, _content(_arriving(spark, d)), table, progress)
    return tables.read_or_empty(spark, table, _FILES).select("sid", "file_path")


@query("A14 A9 G3", sql="""WITH c AS (SELECT lang, md5(text) AS sid, '/' || lang || '/' || source || '/' || lpad(doc_id::VARCHAR, 12, '0') AS file_path FROM documents),
    a AS (SELECT sid, min(file_path) AS file_path FROM c WHERE lang IN ('de', 'en') GROUP BY sid),
    b AS (SELECT sid, min(file_path) AS file_path FROM c WHERE lang IN ('de', 'fr') GROUP BY sid),
    e AS (SELECT sid, min(file_path) AS file_path FROM c GROUP BY sid),
    ab AS (SELECT * FROM a UNION ALL SELECT * FROM b WHERE sid NOT IN (SELECT sid FROM a))
    SELECT * FROM ab UNION ALL SELECT * FROM e WHERE sid NOT IN (SELECT sid FROM ab)""")
def stream_two_sources(spark, d):
    # two overlapping sources and then everything under a third checkpoint fill one table; nothing written earlier is lost
    table = scratch_path(spark, "files")
    for languages in (["de", "en"], ["de", "fr"], None):
        arriving = _arriving(spark, d)
        if languages is not None:
            arriving = arriving.where(F.col("lang").isin(languages))
        ingest_stream(spark, _content(arriving), table, scratch_path(spark, "progress"))
    return tables.read_or_empty(spark, table, _FILES).select("sid", "file_path")


@query("A16 A14", "tags", """SELECT CASE sid % 3 WHEN 0 THEN 'malformed' ELSE 'no id' END AS reason,
    CASE sid % 3 WHEN 0 THEN '{"metadata": ' || sid ELSE '{"tonal":{"key":' || sid || '}}' END AS document FROM tags WHERE sid % 3 < 2""")
def document_rejects(spark, d):
    # every third document is broken, every third has no id
    sid = F.col("sid").cast("string")
    text = (F.when(F.col("sid") % 3 == 0, F.concat(F.lit('{"metadata": '), sid))
            .when(F.col("sid") % 3 == 1, F.concat(F.lit('{"tonal": {"key": '), sid, F.lit("}}")))
            .otherwise(F.concat(F.lit('{"metadata": {"audio_properties": {"md5_encoded": "'), sid, F.lit('"}, "tags": {"bpm": [1.0]}}, "tonal": {"key": 1}}'))))
    arrived, root = scratch_path(spark, "arrived"), scratch_path(spark, "library")
    views.tags(spark, d).select(text.alias("value")).write.text(arrived)
    shape = "metadata struct<audio_properties: struct<md5_encoded: string>, tags: struct<bpm: array<double>>>, tonal struct<key: bigint>, _corrupt string"
    stream = spark.readStream.schema(shape).option("columnNameOfCorruptRecord", "_corrupt").json(arrived)
    library.ingest_documents(spark, stream, root, scratch_path(spark, "progress"))
    return spark.read.parquet(f"{root}/rejects").select("reason", "document")


@query("A5 A6 B5", sql="SELECT event_id, (props->>'k')::BIGINT AS props_k FROM events")
def flatten_json(spark, d):
    events = scan(spark, d, "events", "event_id", "props")
    return documents.parse_column(events, "props", "struct<k:bigint>")


@query("A5 A6 A16 B3 B4 B6 H16", "tags", "SELECT sid, bpm, title, artist FROM tags")
def document_tags(spark, d):
    # feature documents as the extractor writes them, then read back as files
    songs = views.tags(spark, d)
    nested = songs.select(
        F.struct(
            F.struct(F.col("sid").cast("string").alias("md5_encoded")).alias("audio_properties"),
            F.struct(F.array("bpm").alias("bpm"), F.array("title").alias("title"), F.array("artist").alias("artist")).alias("tags"),
        ).alias("metadata"),
        F.struct(F.array(F.col("length"), F.col("bpm")).alias("beats")).alias("rhythm"),
    )
    folder = scratch_path(spark, "documents")
    nested.write.json(folder)
    good, _ = documents.split_corrupt(documents.read_json(spark, folder, nested.schema, multi_line=False))
    rows = documents.feature_rows(good)
    meta = schema.split_by_prefix(rows, {"meta": "meta"})["meta"]
    from cratelight.functions.tags import collapse_tag

    named, _ = schema.conform(schema.last_part_names(schema.apply_cells(meta, collapse_tag)))
    return named.select(F.col("sid").cast("long").alias("sid"), "bpm", "title", "artist")


@query("A14 A5 A11 B3 B4 B6 H1 H16 G3", "tags", """SELECT sid, title, bpm, length AS rhythm_length, sid % 7 AS tonal_key, length AS beat, u.i::INTEGER AS pos
    FROM tags, (SELECT unnest([0, 1]) AS i) u""")
def ingest_documents(spark, d):
    songs = views.tags(spark, d)
    nested = songs.select(
        F.struct(F.struct(F.col("sid").cast("string").alias("md5_encoded")).alias("audio_properties"),
                 F.struct(F.array("title", "title").alias("title"), F.array("bpm").alias("bpm")).alias("tags")).alias("metadata"),
        F.struct(F.col("length"), F.array("length", "length").alias("beats")).alias("rhythm"),
        F.struct((F.col("sid") % 7).alias("key")).alias("tonal"),
    )
    arrived, root = scratch_path(spark, "arrived"), scratch_path(spark, "library")
    nested.write.json(arrived)
    nested.write.mode("append").json(arrived)  # every document arrives twice
    stream = spark.readStream.schema(nested.schema).json(arrived)
    library.ingest_documents(spark, stream, root, scratch_path(spark, "progress"))
    stored = {name: spark.read.parquet(f"{root}/{name}").drop("stream", "batch") for name in ("tags", "rhythm_features", "tonal_features", "rhythm_beats_tbl")}
    joined = stored["tags"].join(stored["rhythm_features"], "sid").join(stored["tonal_features"], "sid").join(stored["rhythm_beats_tbl"], "sid")
    beats = F.posexplode("rhythm_beats").alias("pos", "beat")
    return joined.select(F.col("sid").cast("long").alias("sid"), "title", "bpm", "rhythm_length", "tonal_key", beats)


@query("I15 C2 H6 H7 H8", "holed_tags export", """SELECT sid, file_path, coalesce(bpm, AverageBpm) AS bpm, coalesce(title, Name) AS title,
    coalesce(artist, Artist_1) AS artist, coalesce(initialkey, Tonality) AS initialkey
    FROM holed_tags LEFT JOIN (SELECT path, AverageBpm, Name, Artist AS Artist_1, Tonality FROM export) ON file_path = path""")
def tag_repair(spark, d):
    return repair.repair_tags(views.holed_tags(spark, d), views.export(spark, d))


@query("A7 B5 B13", "export", """SELECT TrackID, Name, Artist, AverageBpm::VARCHAR AS AverageBpm, Tonality, path, 'c' || TrackID AS Comments,
    AverageBpm::VARCHAR AS first_bpm, 2 AS marks FROM export WHERE contains(path, 'LaCie')""")
def xml_collection(spark, d):
    folder = scratch_path(spark, "collection")
    tracks = views.export(spark, d)
    mark = lambda at: F.struct(F.lit(at).alias("_Inizio"), F.col("_AverageBpm").alias("_Bpm"))
    written = tracks.toDF(*[f"_{c}" for c in tracks.columns]).withColumn("_Comments", F.concat(F.lit("c"), "_TrackID"))
    written.withColumn("TEMPO", F.array(mark("0.1"), mark("0.9"))).write.format("xml").option("rootTag", "COLLECTION").option("rowTag", "TRACK").save(folder)
    read = library_xml.read_collection(spark, folder, "LaCie")
    return read.select("TrackID", "Name", "Artist", "AverageBpm", "Tonality", export_path(F.col("Location")).alias("path"), "Comments",
                       F.col("TEMPO")[0]["_Bpm"].alias("first_bpm"), F.size("TEMPO").alias("marks"))


def _playlist_tree(spark, d):
    """A playlist tree per conversation turn: folder = role, playlist = conversation, tracks = the words of the text."""
    turns = scan(spark, d, "conversations", "conv_id", "turn", "role", "text")
    keys = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("_Key")))
    playlist = F.struct(F.concat(F.lit("list "), F.col("conv_id").cast("string")).alias("_Name"), F.size(F.split("text", " ")).cast("string").alias("_Entries"), keys.alias("TRACK"))
    folder = F.struct(F.col("role").alias("_Name"), F.lit("1").alias("_Entries"), F.array(playlist).alias("NODE"))
    return turns.select(F.struct(F.lit("ROOT").alias("_Name"), F.array(folder).alias("NODE")).alias("NODE"))


@query("H19 H20", sql="""SELECT 'list ' || conv_id AS name, key AS TrackID, count(*) AS n FROM (
    SELECT conv_id, unnest(string_split(text, ' ')) AS key FROM conversations WHERE role = 'user') GROUP BY ALL""")
def explode_playlists(spark, d):
    lists = library_xml.folder_playlists(_playlist_tree(spark, d), "user")
    return library_xml.playlist_tracks(lists).groupBy("name", "TrackID").agg(F.count("*").alias("n"))


@query("I16 H19 H20 C7", "tags", "SELECT 'order ' || l_orderkey AS name, l_partkey::VARCHAR AS TrackID, sid, title, artist FROM lineitem JOIN tags ON sid = l_partkey")
def playlist_labels(spark, d):
    items = scan(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_returnflag")
    track = F.array(F.struct(F.col("l_partkey").cast("string").alias("_Key")))
    lists = items.select(F.col("l_returnflag").alias("folder"), F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("name"), track.alias("TRACK"))
    songs = views.tags(spark, d).select(F.col("sid").cast("string").alias("TrackID"), "sid", "title", "artist")
    return library_xml.playlist_labels(lists, songs).select("name", "TrackID", "sid", "title", "artist")


@query("A11 A13 A10", sql="SELECT vec_id AS sid, generate_subscripts(embedding, 1)::INTEGER - 1 AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings")
def array_round_trip(spark, d):
    path = scratch_path(spark, "vectors")
    tables.append(views.vectors(spark, d).select("sid", "embedding"), path)
    back = spark.read.parquet(path)
    return back.select("sid", F.posexplode("embedding").alias("pos", "x")).select("sid", "pos", F.col("x").cast("double").alias("x"))


@query("A11 A12", "files", "SELECT sid, file_path FROM files UNION ALL SELECT sid, file_path FROM files WHERE sid IN (SELECT vec_id FROM embeddings)")
def append_files(spark, d):
    path, files = scratch_path(spark, "files"), views.files(spark, d)
    tables.insert_files(files, path)
    tables.insert_files(files.join(views.vectors(spark, d).select("sid"), "sid", "left_semi"), path)
    return spark.read.parquet(path)


@query("A15", "holed_tags export", "SELECT sid, file_path FROM holed_tags WHERE file_path IN (SELECT path FROM export)")
def existing_paths(spark, d):
    listing = views.export(spark, d).select(export_path(F.col("Location")).alias("file_path"))
    return existing_only(views.files(spark, d), listing).select("sid", "file_path")


def _written_files(spark, d):
    """A folder of files, two alike for every brand: what its songs add up to."""
    brands = scan(spark, d, "part", "p_brand", "p_partkey").groupBy("p_brand").agg(F.count("*").alias("n"), F.sum("p_partkey").alias("total"))
    text = F.concat("p_brand", F.lit(" "), F.col("n").cast("string"), F.lit(" "), F.col("total").cast("string"))
    folder = scratch_path(spark, "drop")
    copies = F.explode(F.array(F.lit("a"), F.lit("b"))).alias("side")
    brands.select(text.alias("value"), F.translate("p_brand", "#", "-").alias("brand"), copies).write.partitionBy("side", "brand").text(folder)
    return folder


def _place(path):
    return F.regexp_extract(path, "side=([^/]*)/brand=([^/]*)", 1).alias("side"), F.regexp_extract(path, "side=([^/]*)/brand=([^/]*)", 2).alias("brand")


_TEXTS = "b AS (SELECT replace(p_brand, '#', '-') AS brand, p_brand || ' ' || count(*) || ' ' || sum(p_partkey) || chr(10) AS text FROM part GROUP BY p_brand)"


@query("A8", sql=f"WITH {_TEXTS} SELECT unnest(['a', 'b']) AS side, brand, strlen(text) AS length FROM b")
def listed_files(spark, d):
    return list_files(spark, _written_files(spark, d), "part-*").select(*_place(F.col("file_path")), "length")


@query("A8 A9", sql=f"WITH {_TEXTS} SELECT 'a' AS side, brand, md5(text) AS sid FROM b")
def hashed_contents(spark, d):
    # the copies on side b have the same content; of two paths the smaller counts
    return hashed_files(spark, _written_files(spark, d), "part-*").select(*_place(F.col("file_path")), "sid")
