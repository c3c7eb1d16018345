"""The library export: its track collection and its playlist tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from cratelight.operators.schema import clean_names

# The attributes that every track has in the result; others are kept as they occur.
TRACK_FIELDS = [
    "TrackID", "Name", "Artist", "Genre", "Size", "TotalTime", "AverageBpm", "PlayCount", "Location", "Tonality",
]
TEMPO = "TEMPO"
PLAYLIST_TREE = (
    "NODE struct<_Name:string,NODE:array<struct<_Name:string,_Entries:string,"
    "NODE:array<struct<_Name:string,_Entries:string,TRACK:array<struct<_Key:string>>>>>>>"
)


ROW_TAG = "TRACK"
START_TAG = r"""^[^"'>]*+(?:(?:"[^"]*+"|'[^']*+')[^"'>]*+)*+>"""


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The export cut before every track: a file that splits, unlike an XML file, which one task reads whole."""
    return spark.read.text(path, lineSep=f"<{ROW_TAG}").select("value")


def _plain(pieces: DataFrame) -> bool:
    """Whether pieces are the tracks: no comment or CDATA that could hold one, no other tag that starts alike, and UTF-8."""
    value = F.col("value")
    hidden = value.contains("<!--") | value.contains("<![CDATA[") | value.contains("\0") | value.contains("\ufffd")
    other = ~value.rlike(r"^([\s/>]|\ufeff?<|$)")
    encoded = value.rlike(r"""(?i)<\?xml[^>]*encoding\s*=\s*["'](?!utf-?8["'])""")
    return not pieces.where(hidden | other | encoded).limit(1).count()


def _elements(pieces: DataFrame) -> DataFrame:
    """(record): every track element alone; what stands before the first and after each is dropped."""
    start, end = F.regexp_extract("value", START_TAG, 0), f"</{ROW_TAG}>"
    whole = F.when(start.endswith("/>"), start).otherwise(F.concat(F.substring_index("value", end, 1), F.lit(end)))
    tracks = pieces.where(F.col("value").rlike(r"^[\s/>]") & ~F.col("value").rlike(r"^\s*<"))
    return tracks.select(F.concat(F.lit(f"<{ROW_TAG}"), whole).alias("record"))


def read_collection(spark: SparkSession, path: str, location_part: str | None = None) -> DataFrame:
    """The collection's tracks with all their attributes, as strings, and ``TEMPO``, an array of beat-grid marks.

    One pass finds which attributes occur; playlist entries share the tag name but carry no TrackID. Files are split at tracks, and each
    track is parsed alone; an export where the tag's text can stand elsewhere than in front of a track is read file by file.
    """
    options = {"rowTag": ROW_TAG, "inferSchema": "false"}
    reader, pieces = spark.read.format("xml").options(**options), _pieces(spark, path)
    plain = _plain(pieces)
    records = _elements(pieces)
    found = spark.read.options(**options).xml(records.rdd.map(lambda row: row["record"])).schema if plain else reader.load(path).schema
    marks = found[TEMPO].dataType if TEMPO in found.names else None
    inside = marks.elementType if isinstance(marks, ArrayType) else marks
    fields = [StructField(f"_{name}", StringType()) for name in TRACK_FIELDS]
    fields += [StructField(f.name, StringType()) for f in found if f.name.startswith("_") and f.name[1:] not in TRACK_FIELDS and f.name != "_Key"]
    fields += [StructField(TEMPO, ArrayType(inside))] if isinstance(inside, StructType) else []
    schema = StructType(fields)
    if plain:
        tracks = records.select(F.from_xml("record", schema, options).alias("track")).select("track.*")
    else:
        tracks = reader.schema(schema).load(path)
    tracks = clean_names(tracks.where(F.col("_TrackID").isNotNull()))
    return tracks if location_part is None else tracks.where(F.col("Location").contains(location_part))


def read_playlists(spark: SparkSession, path: str) -> DataFrame:
    """The playlist tree, one row per export; folders with one playlist and with several read alike."""
    return spark.read.format("xml").option("rowTag", "PLAYLISTS").schema(PLAYLIST_TREE).load(path)


def folder_playlists(tree: DataFrame, folder: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(folder, name, entries, TRACK) of the playlists in a folder such as Genres, Regions, Energies or Vibes."""
    nodes = tree.select(*keep, F.explode("NODE.NODE").alias("f"))
    if folder is not None:
        nodes = nodes.where(F.col("f._Name") == folder)
    lists = nodes.select(*keep, F.col("f._Name").alias("folder"), F.explode("f.NODE").alias("p"))
    return lists.select(
        *keep, "folder", F.col("p._Name").alias("name"), F.col("p._Entries").try_cast("long").alias("entries"), F.col("p.TRACK").alias("TRACK")
    )


def playlist_tracks(playlists: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One (folder, name, TrackID) row per playlist entry."""
    keys = F.transform("TRACK", lambda track: track["_Key"])
    return playlists.select(*keep, "folder", "name", F.explode(keys).alias("TrackID"))


def playlist_labels(playlists: DataFrame, matched: DataFrame) -> DataFrame:
    """Playlist entries joined to the songs matched with the export, on TrackID."""
    return playlist_tracks(playlists).join(matched, "TrackID")
