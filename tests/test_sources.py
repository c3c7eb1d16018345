"""Sources, sinks and the file stream on small files."""

import json

import pytest

from pyspark.sql import functions as F

from cratelight.sources import audio_files, documents, library_xml, tables
from cratelight.streaming.ingest import audio_stream, ingest_stream

EXPORT = """<?xml version="1.0" encoding="UTF-8"?>
<DJ_PLAYLISTS Version="1.0.0">
  <COLLECTION Entries="2">
    <TRACK TrackID="1" Name="One" Artist="A" AverageBpm="" Location="file://localhost/Volumes/LaCie/One%20x.wav" Tonality="1A"><TEMPO Inizio="0.1" Bpm="120"/></TRACK>
    <TRACK TrackID="2" Name="Two" Artist="B" AverageBpm="121.50" Location="file://localhost/Users/me/two.wav" Tonality=""/>
  </COLLECTION>
  <PLAYLISTS>
    <NODE Type="0" Name="ROOT" Count="3">
      <NODE Name="Genres" Type="0" Count="2">
        <NODE Name="Disco" Type="1" Entries="2"><TRACK Key="1"/><TRACK Key="2"/></NODE>
        <NODE Name="House" Type="1" Entries="1"><TRACK Key="2"/></NODE>
      </NODE>
      <NODE Name="Vibes" Type="0" Count="1">
        <NODE Name="Calm" Type="1" Entries="1"><TRACK Key="1"/></NODE>
      </NODE>
      <NODE Name="Loose" Type="1" Entries="1"><TRACK Key="2"/></NODE>
    </NODE>
  </PLAYLISTS>
</DJ_PLAYLISTS>
"""


def test_library_export(spark, tmp_path):
    path = tmp_path / "export.xml"
    path.write_text(EXPORT)
    tracks = library_xml.read_collection(spark, str(path))
    assert sorted((r.TrackID, r.Name, r.AverageBpm) for r in tracks.collect()) == [("1", "One", ""), ("2", "Two", "121.50")]
    assert [r.TrackID for r in library_xml.read_collection(spark, str(path), "LaCie").collect()] == ["1"]
    tree = library_xml.read_playlists(spark, str(path))
    genres = library_xml.folder_playlists(tree, "Genres")
    assert sorted((r.folder, r.name, r.entries) for r in genres.collect()) == [("Genres", "Disco", 2), ("Genres", "House", 1)]
    assert sorted((r.name, r.TrackID) for r in library_xml.playlist_tracks(genres).collect()) == [("Disco", "1"), ("Disco", "2"), ("House", "2")]
    every = library_xml.playlist_tracks(library_xml.folder_playlists(tree))
    assert ("Vibes", "Calm", "1") in {(r.folder, r.name, r.TrackID) for r in every.collect()}
    labelled = library_xml.playlist_labels(genres, tracks.select("TrackID", "Name"))
    assert sorted((r.name, r.Name) for r in labelled.withColumnRenamed("name", "playlist").toDF("TrackID", "folder", "name", "Name").collect()) == [("Disco", "One"), ("Disco", "Two"), ("House", "Two")]


def _odd_export(tracks):
    odd = """ <TRACK TrackID="a" Name="One &amp; x > y" Artist=""><TEMPO Inizio="0.1" Bpm="120"/></TRACK>
 <TRACK TrackID="b" Name='T/>w "q"' B="  s " x-y.z="1"/><TRACK TrackID="c"></TRACK><TRACK/><TRACK></TRACK>
 <TRACK
   TrackID="d">text<TEMPO Inizio="1"/><TEMPO Inizio="2" Bpm="4">w</TEMPO><X>1</X></TRACK>
"""
    many = "".join(f'<TRACK TrackID="{i}" Name="n é {i}" Location="file://x/{i}.wav"><TEMPO Inizio="{i}"/></TRACK>\n' for i in range(tracks))
    return f'\n<C Entries="2">\n{odd}{many}<PLAYLISTS><NODE Name="p"><TRACK Key="1"/><TRACK Key="2"></TRACK></NODE></PLAYLISTS></C>'


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_one_export_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    path = tmp_path / "export.xml"
    path.write_text(_odd_export(4000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20011")
    try:
        split = library_xml.read_collection(spark, str(path))
        assert split.rdd.getNumPartitions() > 5
        found = _rows(split)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    monkeypatch.setattr(library_xml, "_plain", lambda pieces: False)
    whole = library_xml.read_collection(spark, str(path))
    assert split.schema == whole.schema and found == _rows(whole) and len(found) == 4004


@pytest.mark.parametrize("hidden", ['<!-- <TRACK TrackID="9"/> -->', '<TRACK TrackID="9"><X><![CDATA[<TRACK TrackID="8"/>]]></X></TRACK>',
                                    '<TRACK TrackID="9"><TRACKER A="1"/><TEMPO Bpm="7"/></TRACK>'])
def test_tags_elsewhere_are_no_tracks(spark, tmp_path, hidden, monkeypatch):
    path = tmp_path / "export.xml"
    path.write_text(_odd_export(3).replace("<PLAYLISTS>", f"{hidden}<PLAYLISTS>"))
    found = _rows(library_xml.read_collection(spark, str(path)))
    monkeypatch.setattr(library_xml, "_plain", lambda pieces: False)
    assert found == _rows(library_xml.read_collection(spark, str(path))) and len(found) == (7 if "!--" in hidden else 8)


def test_json_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"metadata": {"audio_properties": {"md5_encoded": "x1", "length": 3.5}}, "rhythm": {"bpm": 120.0}}, indent=1))
    (tmp_path / "b.json").write_text('{"metadata": {"audio_properties": {"md5_encoded": ')
    inferred = documents.read_json(spark, str(tmp_path / "a.json"))
    rows = documents.feature_rows(inferred)
    assert rows.first().asDict() == {"metadata_audio_properties_length": 3.5, "sid": "x1", "rhythm_bpm": 120.0}
    good, bad = documents.split_corrupt(documents.read_json(spark, str(tmp_path), inferred.schema).cache())
    assert good.count() == 1 and bad.count() == 1


def test_json_lines_with_a_bad_one(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"a": {"b": 1}}\n{"a": {"b": \n')
    from pyspark.sql.types import LongType, StructType

    schema = StructType().add("a", StructType().add("b", LongType()))
    good, bad = documents.split_corrupt(documents.read_json(spark, str(tmp_path), schema, multi_line=False).cache())
    assert [r.a.b for r in good.collect()] == [1] and bad.count() == 1


def _files(folder):
    folder.mkdir()
    for name, content in {"a.wav": b"one", "b.mp3": b"two", "c.wav": b"one", "d.txt": b"no", "e.aiff": b"three"}.items():
        (folder / name).write_bytes(content)
    return folder


def test_audio_files(spark, tmp_path):
    folder = _files(tmp_path / "new")
    listed = audio_files.list_files(spark, str(folder))
    assert sorted(r.file_path.rsplit("/", 1)[1] for r in listed.collect()) == ["a.wav", "b.mp3", "c.wav", "e.aiff"]
    hashed = audio_files.hashed_files(spark, str(folder)).collect()
    assert sorted(r.file_path.rsplit("/", 1)[1] for r in hashed) == ["a.wav", "b.mp3", "e.aiff"]
    import hashlib

    assert hashlib.md5(b"one").hexdigest() in {r.sid for r in hashed}
    paths = spark.createDataFrame([(f"{folder}/a.wav",), (f"{folder}/gone.wav",)], "file_path string")
    assert [r.file_path for r in audio_files.existing_only(paths, listed).collect()] == [f"{folder}/a.wav"]


def test_stream_takes_each_content_once(spark, tmp_path):
    folder, table, progress = _files(tmp_path / "drop"), str(tmp_path / "files"), str(tmp_path / "progress")
    ingest_stream(spark, audio_stream(spark, str(folder), files_per_batch=1), table, progress)
    assert spark.read.parquet(table).count() == 3
    (folder / "f.wav").write_bytes(b"two")
    (folder / "g.wav").write_bytes(b"four")
    ingest_stream(spark, audio_stream(spark, str(folder)), table, progress)
    stored = spark.read.parquet(table)
    assert stored.count() == 4 and stored.select("sid").distinct().count() == 4


def test_streams_never_replace_each_other(spark, tmp_path):
    first, second, table = _files(tmp_path / "one"), tmp_path / "two", str(tmp_path / "files")
    second.mkdir()
    (second / "z.wav").write_bytes(b"two")
    (second / "y.wav").write_bytes(b"five")
    ingest_stream(spark, audio_stream(spark, str(first)), table, str(tmp_path / "progress1"))
    ingest_stream(spark, audio_stream(spark, str(second)), table, str(tmp_path / "progress2"))
    once = sorted(spark.read.parquet(table).select("sid", "file_path").collect())
    assert len(once) == 4 and len({r.sid for r in once}) == 4
    # a renewed checkpoint sees every file again and adds nothing
    ingest_stream(spark, audio_stream(spark, str(first)), table, str(tmp_path / "renewed"))
    assert sorted(spark.read.parquet(table).select("sid", "file_path").collect()) == once


def test_streams_of_a_table_in_parts_and_of_one_file(spark, tmp_path):
    from cratelight.plans.registry import load

    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(1, "one", "de", "a", 3), (2, "two", "fr", "a", 3), (3, "one", "en", "b", 3), (4, "three", "it", "a", 5)]
    expected = {(sid, path) for sid, path in spark.createDataFrame(rows, schema).groupBy(F.md5("text")).agg(
        F.min(F.concat(F.lit("/"), "lang", F.lit("/"), "source", F.lit("/"), F.lpad(F.col("doc_id").cast("string"), 12, "0")))).collect()}
    for name, some in {"parts": rows, "none": []}.items():
        spark.createDataFrame(some, schema).repartition(3).write.parquet(str(tmp_path / name / "documents.parquet"))
    single = tmp_path / "single"
    single.mkdir()
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "whole"))
    next((tmp_path / "whole").glob("*.parquet")).rename(single / "documents.parquet")
    for name in ("stream_ingest", "stream_two_sources"):
        for folder in ("parts", "single", "none"):
            stored = load()[name].run(spark, str(tmp_path / folder))
            assert stored.columns == ["sid", "file_path"]
            found = stored.collect()
            assert {(r.sid, r.file_path) for r in found} == (set() if folder == "none" else expected) and len(found) == len(set(found))


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    from cratelight.streaming.ingest import batch_folder, known_before, new_content

    table = str(tmp_path / "files")
    rows = spark.createDataFrame([("a", "/a"), ("b", "/b")], "sid string, file_path string")
    for _ in range(2):
        known = known_before(spark, table, "sid string, file_path string", "s", 0)
        new_content(rows, known).write.mode("overwrite").parquet(batch_folder(table, "s", 0))
        assert spark.read.parquet(table).count() == 2


def test_read_or_empty_hides_no_other_failure(spark, tmp_path):
    from pyspark.errors import AnalysisException

    spark.range(3).write.parquet(str(tmp_path / "t"))
    with pytest.raises(AnalysisException):
        tables.read_or_empty(spark, str(tmp_path / "t"), "no such type")


def test_append_and_round_trip(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", [[0.0, 1.0], [2.0, 3.0]])], "sid string, m array<array<float>>")
    assert tables.append(df, path) == 1 and tables.append(df, path) == 1
    assert [r.m for r in spark.read.parquet(path).collect()] == [[[0.0, 1.0], [2.0, 3.0]]] * 2
    rows = tables.insert_families({"tonal_features": spark.createDataFrame([("a", 1.0), ("b", 2.0)], "sid string, tonal_x double")}, str(tmp_path))
    assert rows == {"tonal_features": 2} and spark.read.parquet(str(tmp_path / "tonal_features")).count() == 2
    assert tables.insert_lists(df, str(tmp_path)) == {"m": 1} and spark.read.parquet(str(tmp_path / "m_tbl")).columns == ["sid", "m"]
    files = spark.createDataFrame([("a", "/x", 1)], "sid string, file_path string, other int")
    assert tables.insert_files(files, str(tmp_path / "files")) == 1
    assert tables.read_or_empty(spark, str(tmp_path / "nothing"), "sid string").count() == 0


def test_list_tables(spark):
    spark.range(1).createOrReplaceTempView("tags_view")
    assert "tags_view" in [r.name for r in tables.list_tables(spark).collect()]


def test_documents_become_tables_once(spark, tmp_path):
    from pyspark.sql.types import StructType

    from cratelight.streaming.ingest import ingest_documents

    folder = tmp_path / "docs"
    folder.mkdir()
    schema = StructType.fromDDL(
        "metadata struct<audio_properties:struct<md5_encoded:string,length:double>,tags:struct<title:array<string>,artist:array<string>>>,"
        "lowlevel struct<loudness:double,mfcc:array<double>>, rhythm struct<bpm:double>"
    )

    def document(sid, title):
        return json.dumps({"metadata": {"audio_properties": {"md5_encoded": sid, "length": 9.5}, "tags": {"title": title, "artist": ["x", "y", "z"]}},
                           "lowlevel": {"loudness": 0.5, "mfcc": [1.0, 2.0]}, "rhythm": {"bpm": 120.0}})

    def drain():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
        ingest_documents(spark, stream, str(tmp_path / "library"), str(tmp_path / "progress"))

    (folder / "1.json").write_text(document("a", ["One"]) + "\n" + document("a", ["One"]))
    (folder / "2.json").write_text(document("b", ["Two", "two"]))
    drain()
    (folder / "3.json").write_text(document("a", ["again"]) + "\n{broken\n" + document("c", []))
    drain()

    def stored(name):
        return spark.read.parquet(str(tmp_path / "library" / name)).drop("stream", "batch")

    assert sorted((r.sid, r.title, r.artist, r.length) for r in stored("tags").collect()) == [
        ("a", "One", None, 9.5), ("b", "two", None, 9.5), ("c", None, None, 9.5)]
    assert stored("lowlevel_features").columns == ["sid", "lowlevel_loudness"] and stored("lowlevel_features").count() == 3
    assert stored("rhythm_features").columns == ["sid", "rhythm_bpm"]
    assert [r.lowlevel_mfcc for r in stored("lowlevel_mfcc_tbl").collect()] == [[1.0, 2.0]] * 3
