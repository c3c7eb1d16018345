"""The music tables, derived from the given Parquet tables: each view in Spark and as SQL for the check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelight.operators.align import align_outer
from cratelight.operators.pooling import pool_wide
from cratelight.session import scratch_path
from cratelight.sources import tables

# The schemas of the given tables.
SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Which column of the given tables stands for which mood or genre.
EVENT_MOODS = {"click": "electronic", "error": "arousal", "purchase": "valence", "signup": "relaxed", "view": "bright"}
ITEM_MOODS = {
    "danceable": "l_quantity / 50",
    "aggressive": "l_discount * 10",
    "party": "l_tax * 12.5",
    "approachable": "l_linenumber / 7.0e0",
    "engaging": "(l_suppkey % 10) / 9.0e0",
    "acoustic": "(l_orderkey % 16) / 15.0e0",
    "happy": "(l_orderkey % 7) / 6.0e0",
    "sad": "(l_orderkey % 9) / 8.0e0",
}
MOODS = [*EVENT_MOODS.values(), *ITEM_MOODS]
FAMILIES = {"A": "electronic", "N": "funk__soul", "R": "rock"}
SUBGENRES = {1: "disco", 2: "house", 3: "funk", 4: "techno", 5: "boogie", 6: "samba", 7: "zouk"}
GENRES = [f"{family}___{sub}" for family in FAMILIES.values() for sub in SUBGENRES.values()]


def scan(spark: SparkSession, folder: str, name: str, *columns: str | Column) -> DataFrame:
    """A given table, or some of its columns."""
    return tables.scan(spark, folder, name, *columns, schema=SCHEMAS[name])


def tags(spark: SparkSession, folder: str) -> DataFrame:
    """One row per song; a part is a song. Some tempos, titles, artists and keys are missing."""
    part = scan(spark, folder, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    letter = F.when(F.floor(F.col("p_partkey") / 12) % 2 == 0, "A").otherwise("B")
    return part.select(
        F.col("p_partkey").alias("sid"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist"),
        F.col("p_type").alias("genre"),
        (F.col("p_size") + 90).cast("double").alias("bpm"),
        F.concat((F.col("p_partkey") % 12 + 1).cast("string"), letter).alias("initialkey"),
        (F.col("p_retailprice") / 2).alias("length"),
    )


def activations(spark: SparkSession, folder: str) -> DataFrame:
    """Segment scores (sid, class, ts, event_id, score); a user is a song, an event type a class."""
    events = scan(spark, folder, "events", "event_id", "ts", "user_id", "event_type", "value")
    largest = events.agg(F.max("value").alias("m")).scalar()
    return events.select(
        F.col("user_id").alias("sid"), F.col("event_type").alias("class"), "ts", "event_id",
        (F.col("value") / largest).alias("score"),
    )


def event_moods(spark: SparkSession, folder: str) -> DataFrame:
    pooled = pool_wide(activations(spark, folder), "sid", "class", "score", EVENT_MOODS)
    return pooled.select("sid", *[F.round(c, 9).alias(c) for c in EVENT_MOODS.values()])


def item_moods(spark: SparkSession, folder: str) -> DataFrame:
    items = scan(spark, folder, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return items.groupBy(F.col("l_partkey").alias("sid")).agg(
        *[F.round(F.avg(F.expr(score)), 9).alias(name) for name, score in ITEM_MOODS.items()]
    )


def mood(spark: SparkSession, folder: str) -> DataFrame:
    """Mean mood scores per song from both score tables, aligned outer."""
    return align_outer([event_moods(spark, folder), item_moods(spark, folder)])


def stored_mood(spark: SparkSession, folder: str) -> DataFrame:
    """The mood table written once as Parquet, for queries that read some of its columns several times."""
    pooled, path = mood(spark, folder), scratch_path(spark, "mood")
    pooled.write.parquet(path)
    return spark.read.schema(pooled.schema).parquet(path)


def genre_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segment scores per genre class (sid, class, score); a line item is a segment."""
    items = scan(spark, folder, "lineitem", "l_partkey", "l_returnflag", "l_linenumber", "l_quantity")
    family = F.coalesce(*[F.when(F.col("l_returnflag") == k, v) for k, v in FAMILIES.items()])
    sub = F.coalesce(*[F.when(F.col("l_linenumber") == k, v) for k, v in SUBGENRES.items()])
    return items.select(
        F.col("l_partkey").alias("sid"), F.concat(family, F.lit("___"), sub).alias("class"),
        (F.col("l_quantity") / 50).alias("score"),
    )


def genres(spark: SparkSession, folder: str) -> DataFrame:
    """Mean genre scores per song, one column per class."""
    pooled = pool_wide(genre_segments(spark, folder), "sid", "class", "score", {c: c for c in GENRES})
    return pooled.select("sid", *[F.round(c, 9).alias(c) for c in GENRES])


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(sid, embedding, label)."""
    return scan(spark, folder, "embeddings", "vec_id", "embedding", "label").withColumnRenamed("vec_id", "sid")


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(sid, file_path) of every song, the path as a file system shows it."""
    part = scan(spark, folder, "part", "p_partkey", "p_name", "p_brand")
    return part.select(F.col("p_partkey").alias("sid"), F.concat(
        F.lit("/Volumes/LaCie/"), F.col("p_partkey").cast("string"), F.lit(" "), F.col("p_name"), F.lit(" ("),
        F.replace("p_brand", F.lit("#"), F.lit(" é")), F.lit(").wav")).alias("file_path"))


def export(spark: SparkSession, folder: str) -> DataFrame:
    """The library export's tracks: decomposed, percent-encoded file URLs; every 20th song is elsewhere."""
    part = scan(spark, folder, "part", "p_partkey", "p_name", "p_brand", "p_size")
    disk = F.when(F.col("p_partkey") % 20 == 7, "Backup").otherwise("LaCie")
    name = F.replace("p_name", F.lit(" "), F.lit("%20"))
    brand = F.replace("p_brand", F.lit("#"), F.lit("%20e%CC%81"))
    return part.select(
        F.col("p_partkey").cast("string").alias("TrackID"),
        F.initcap("p_name").alias("Name"),
        F.upper("p_brand").alias("Artist"),
        (F.col("p_size") + 90.5).cast("string").alias("AverageBpm"),
        F.concat((F.col("p_partkey") % 12 + 1).cast("string"), F.lit("A")).alias("Tonality"),
        F.concat(F.lit("file://localhost/Volumes/"), disk, F.lit("/"), F.col("p_partkey").cast("string"), F.lit("%20"),
                 name, F.lit("%20%28"), brand, F.lit("%29.wav")).alias("Location"),
    )


def holed_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Tags with file paths, and holes in tempo, title, artist and key."""
    def hole(column: str, step: int, rest: int):
        return F.when(F.col("sid") % step != rest, F.col(column)).alias(column)

    full = tags(spark, folder).join(files(spark, folder), "sid")
    return full.select("sid", "file_path", hole("bpm", 3, 0), hole("title", 5, 1), hole("artist", 7, 2), hole("initialkey", 4, 3))


def _events_sql() -> str:
    moods = ", ".join(f"round(avg(score) FILTER (class = '{k}'), 9) AS {v}" for k, v in EVENT_MOODS.items())
    return f"SELECT sid, {moods} FROM activations GROUP BY sid"


def _items_sql() -> str:
    moods = ", ".join(f"round(avg({expr}), 9) AS {name}" for name, expr in ITEM_MOODS.items())
    return f"SELECT l_partkey AS sid, {moods} FROM lineitem GROUP BY l_partkey"


def _case(column: str, values: dict, quote: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {quote}{k}{quote} THEN '{v}'" for k, v in values.items()) + " END"


SQL = {
    "tags": """SELECT p_partkey AS sid, p_name AS title, p_brand AS artist, p_type AS genre,
        CAST(p_size + 90 AS DOUBLE) AS bpm,
        (p_partkey % 12 + 1)::VARCHAR || CASE WHEN (p_partkey // 12) % 2 = 0 THEN 'A' ELSE 'B' END AS initialkey,
        p_retailprice / 2 AS length FROM part""",
    "activations": """SELECT user_id AS sid, event_type AS class, ts, event_id,
        value / (SELECT max(value) FROM events) AS score FROM events""",
    "event_moods": _events_sql(),
    "item_moods": _items_sql(),
    "mood": "SELECT * FROM event_moods FULL JOIN item_moods USING (sid)",
    "genre_segments": f"""SELECT l_partkey AS sid, {_case('l_returnflag', FAMILIES, "'")} || '___' ||
        {_case('l_linenumber', SUBGENRES, '')} AS class, l_quantity / 50 AS score FROM lineitem""",
    "genres": "SELECT sid, "
    + ", ".join(f"round(avg(score) FILTER (class = '{c}'), 9) AS {c}" for c in GENRES)
    + " FROM genre_segments GROUP BY sid",
    "vectors": "SELECT vec_id AS sid, embedding::DOUBLE[] AS embedding, label FROM embeddings",
    "files": """SELECT p_partkey AS sid, '/Volumes/LaCie/' || p_partkey || ' ' || p_name || ' (' ||
        replace(p_brand, '#', ' é') || ').wav' AS file_path FROM part""",
    "export": """SELECT p_partkey::VARCHAR AS TrackID,
        array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS Name,
        upper(p_brand) AS Artist, p_size + 90.5 AS AverageBpm, (p_partkey % 12 + 1)::VARCHAR || 'A' AS Tonality,
        '/Volumes/' || CASE WHEN p_partkey % 20 = 7 THEN 'Backup' ELSE 'LaCie' END || '/' || p_partkey || ' ' || p_name
        || ' (' || replace(p_brand, '#', ' é') || ').wav' AS path FROM part""",
    "holed_tags": """SELECT sid, file_path, CASE WHEN sid % 3 <> 0 THEN bpm END AS bpm,
        CASE WHEN sid % 5 <> 1 THEN title END AS title, CASE WHEN sid % 7 <> 2 THEN artist END AS artist,
        CASE WHEN sid % 4 <> 3 THEN initialkey END AS initialkey FROM tags JOIN files USING (sid)""",
}
NEEDS = {
    "event_moods": ["activations"], "mood": ["event_moods", "item_moods"], "genres": ["genre_segments"],
    "holed_tags": ["tags", "files"],
}


def with_views(names: str, body: str) -> str:
    """SQL with the named views (and those they need) in front of ``body``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    text = ",\n".join(f"{name} AS ({SQL[name]})" for name in ordered)
    if body.lstrip().upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {text},\n{body.lstrip()[len('WITH RECURSIVE '):]}"
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {text},\n{body.lstrip()[len('WITH '):]}"
    return f"WITH {text}\n{body}"
