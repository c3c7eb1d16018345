"""Scalar functions on whole columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratelight.functions import harmony, labels, paths, tags
from cratelight.plans import views
from cratelight.plans.registry import query
from cratelight.plans.views import scan


@query("H1 B4", sql="""WITH l AS (SELECT l_orderkey, list_sort(list_distinct(list(l_returnflag))) AS v FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, len(v)::INTEGER AS n_values, CASE WHEN len(v) <= 2 THEN v[-1] END AS flag FROM l""")
def tag_collapse(spark, d):
    # a set of flags per order: at most as long as there are flags
    lists = scan(spark, d, "lineitem", "l_orderkey", "l_returnflag").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("v"))
    return lists.select("l_orderkey", F.size("v").alias("n_values"), tags.collapse_tag(F.col("v")).alias("flag"))


@query("H1", sql="""WITH l AS (SELECT doc_id, list_sort(list_distinct(string_split(text, ' '))) AS v FROM documents)
    SELECT doc_id, CASE WHEN len(v) <= 2 THEN v[-1] END AS tag FROM l""")
def tag_collapse_text(spark, d):
    docs = scan(spark, d, "documents", "doc_id", "text")
    return docs.select("doc_id", tags.collapse_tag(F.split("text", " ")).alias("tag"))


@query("H2", sql="""WITH l AS (SELECT p_partkey, p_brand || ', ' || p_type || ' & Co/Sons''---' || p_name AS label FROM part)
    SELECT p_partkey, lower(replace(replace(replace(replace(replace(replace(label, '-', '_'), ' ', '_'), '&', ''), '''', ''), ',', ''), '/', '')) AS slug FROM l""")
def slug(spark, d):
    label = F.concat("p_brand", F.lit(", "), "p_type", F.lit(" & Co/Sons'---"), "p_name")
    return scan(spark, d, "part", "p_partkey", "p_brand", "p_type", "p_name").select("p_partkey", labels.slug(label).alias("slug"))


@query("H2", sql="""SELECT doc_id, md5(lower(replace(replace(replace(replace(replace(replace(text, '-', '_'), ' ', '_'), '&', ''), '''', ''), ',', ''), '/', ''))) AS slug_md5 FROM documents""")
def slug_text(spark, d):
    return scan(spark, d, "documents", "doc_id", "text").select("doc_id", F.md5(labels.slug(F.col("text"))).alias("slug_md5"))


# The number words spelled out for the check, by units and tens; nothing here comes from the code under test.
_UNITS_SQL = "['one','two','three','four','five','six','seven','eight','nine','ten','eleven','twelve','thirteen','fourteen','fifteen','sixteen','seventeen','eighteen','nineteen']"
_TENS_SQL = "['ten','twenty','thirty','forty','fifty','sixty','seventy','eighty','ninety']"


def _below_1000_sql(n: str) -> str:
    tail = f"CASE WHEN {n} % 100 = 0 THEN '' WHEN {n} % 100 < 20 THEN {_UNITS_SQL}[{n} % 100] ELSE {_TENS_SQL}[{n} % 100 // 10] || CASE WHEN {n} % 10 > 0 THEN '-' || {_UNITS_SQL}[{n} % 10] ELSE '' END END"
    return f"(CASE WHEN {n} >= 100 THEN {_UNITS_SQL}[{n} // 100] || ' hundred' || CASE WHEN {n} % 100 > 0 THEN ' and ' ELSE '' END ELSE '' END || {tail})"


def _number_sql(n: str) -> str:
    """SQL words of a whole number below a billion."""
    million, thousand, rest = f"({n} // 1000000)", f"({n} // 1000 % 1000)", f"({n} % 1000)"
    head = f"concat_ws(', ', CASE WHEN {million} > 0 THEN {_below_1000_sql(million)} || ' million' END, CASE WHEN {thousand} > 0 THEN {_below_1000_sql(thousand)} || ' thousand' END)"
    joint = f"CASE WHEN {n} < 1000 OR {rest} = 0 THEN '' WHEN {rest} < 100 THEN ' and ' ELSE ', ' END"
    return f"CASE WHEN {n} = 0 THEN 'zero' ELSE {head} || {joint} || {_below_1000_sql(rest)} END"


def _plural_sql(words: str) -> str:
    return f"CASE WHEN ends_with({words}, 'y') THEN {words}[:-2] || 'ies' WHEN ends_with({words}, 'six') THEN {words} || 'es' ELSE {words} || 's' END"


@query("H3", sql=f"""WITH l AS (SELECT DISTINCT l_linenumber, l_partkey * l_quantity::BIGINT % 3000000 AS q FROM lineitem), w AS (SELECT *, {_number_sql('q')} AS word FROM l)
    SELECT l_linenumber, q, CASE WHEN l_linenumber = 1 THEN 'q' || q WHEN l_linenumber % 2 = 0 THEN word ELSE {_plural_sql('word')} END AS words FROM w""")
def number_words(spark, d):
    items = scan(spark, d, "lineitem", "l_linenumber", "l_partkey", "l_quantity")
    items = items.select("l_linenumber", (F.col("l_partkey") * F.col("l_quantity").cast("long") % 3000000).alias("q")).distinct()
    text = F.col("q").cast("string")
    label = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("q"), text)).when(F.col("l_linenumber") % 2 == 0, text).otherwise(F.concat(text, F.lit("s")))
    return items.select("l_linenumber", "q", labels.number_words(label).alias("words"))


@query("H21 H3", sql=f"""WITH w AS (SELECT *, {_number_sql('p_size::BIGINT')} AS word FROM part)
    SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN {_plural_sql('word')} ELSE replace(p_name, ' ', '_') END AS score_column,
    lower(replace(p_type, '#', '')) || '_' || replace(p_name, ' ', '_') || '_' || (p_size % 3) || '_activations' AS score_table FROM w""")
def classifier_names(spark, d):
    part = scan(spark, d, "part", "p_partkey", "p_name", "p_type", "p_size")
    size = F.col("p_size").cast("string")
    label = F.when(F.col("p_partkey") % 2 == 0, F.concat(size, F.lit("s"))).otherwise(F.col("p_name"))
    model = F.concat(F.lit("models/v1/"), F.lower("p_type"), F.lit("-"), F.translate("p_name", " ", "-"), F.lit("-"), (F.col("p_size") % 3).cast("string"), F.lit(".onnx"))
    return part.select("p_partkey", labels.score_column(label).alias("score_column"), labels.score_table(model).alias("score_table"))


_KEYS = ["Ab", "A", "Bb", "B", "C", "C#", "D", "Eb", "E", "F", "F#", "G", "H"]


@query("H4 H9 C13", sql=f"""WITH k AS (SELECT p_partkey, {_KEYS}[p_partkey % 13 + 1] || CASE WHEN p_size % 2 = 0 THEN 'major' ELSE 'minor' END AS name FROM part)
    SELECT p_partkey, name, map {dict(harmony.CAMELOT)}[name] AS camelot FROM k""")
def camelot(spark, d):
    part = scan(spark, d, "part", "p_partkey", "p_size")
    key = F.array(*map(F.lit, _KEYS))[(F.col("p_partkey") % 13).cast("int")]
    scale = F.when(F.col("p_size") % 2 == 0, "major").otherwise("minor")
    return part.select("p_partkey", F.concat(key, scale).alias("name"), harmony.camelot(key, scale).alias("camelot"))


_NEXT_KEY = "(l_suppkey % 12 + 1)::VARCHAR || CASE WHEN l_linenumber % 2 = 0 THEN 'A' ELSE 'B' END"
_STEPS_SQL = """(CASE WHEN abs(n1 - n2) = 11 THEN 1 ELSE abs(n1 - n2) END + CASE WHEN k1[-1] <> k2[-1] THEN 1 ELSE 0 END)"""


@query("H5", "tags", f"""WITH p AS (SELECT initialkey AS k1, {_NEXT_KEY} AS k2 FROM lineitem JOIN tags ON sid = l_partkey),
    g AS (SELECT k1, k2, count(*) AS n FROM p GROUP BY ALL),
    s AS (SELECT *, k1[:-2]::INTEGER AS n1, k2[:-2]::INTEGER AS n2 FROM g)
    SELECT k1, k2, {_STEPS_SQL}::INTEGER AS steps, {_STEPS_SQL} < 2 AS matches, n FROM s""")
def key_match_pairs(spark, d):
    items = scan(spark, d, "lineitem", "l_partkey", "l_suppkey", "l_linenumber")
    other = F.concat((F.col("l_suppkey") % 12 + 1).cast("string"), F.when(F.col("l_linenumber") % 2 == 0, "A").otherwise("B"))
    songs = views.tags(spark, d).select(F.col("sid").alias("l_partkey"), F.col("initialkey").alias("k1"))
    pairs = items.join(songs, "l_partkey").groupBy("k1", other.alias("k2")).agg(F.count("*").alias("n"))
    return pairs.select("k1", "k2", harmony.key_distance(F.col("k1"), F.col("k2")).alias("steps"), harmony.keys_match(F.col("k1"), F.col("k2")).alias("matches"), "n")


@query("H9 H11", "tags genre_segments", """SELECT sid, title || ' -- ' || coalesce(CASE WHEN sid % 3 > 0 THEN artist END, '') AS song,
    array_to_string(list_transform(string_split(lower(artist || ' ' || genre), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS label FROM tags""")
def label_case(spark, d):
    artist = F.when(F.col("sid") % 3 > 0, F.col("artist"))
    name = F.concat("artist", F.lit("___"), "genre")
    return views.tags(spark, d).select("sid", labels.song_label(F.col("title"), artist).alias("song"), labels.display_label(name).alias("label"))


@query("H6 H7", "export", "SELECT TrackID, path || ' 100% pure%2' AS fixed FROM export")
def url_fix(spark, d):
    # malformed escapes stay as they are
    location = F.concat("Location", F.lit("%20100%25%20pure%2"))
    fixed = paths.nfkc(paths.percent_decode(paths.strip_file_url(F.replace(location, F.lit("100%25"), F.lit("100%")))))
    return views.export(spark, d).select("TrackID", fixed.alias("fixed"))


@query("H7", sql="SELECT page_id, url_decode(replace(url, '/', '%2F')) || '+' AS url FROM pages")
def percent_decode(spark, d):
    encoded = F.concat(F.replace("url", F.lit("/"), F.lit("%2F")), F.lit("+"))
    return scan(spark, d, "pages", "page_id", "url").select("page_id", paths.percent_decode(encoded).alias("url"))


@query("H8", sql="SELECT doc_id, md5(nfc_normalize(replace(text, 'é', 'e' || chr(769)))) AS text_md5, length(nfc_normalize(replace(text, 'é', 'e' || chr(769))))::INTEGER AS n FROM documents")
def nfkc_text(spark, d):
    split = F.replace("text", F.lit("é"), F.lit("é"))
    return scan(spark, d, "documents", "doc_id", "text").select("doc_id", paths.nfkc(split).alias("t")).select("doc_id", F.md5("t").alias("text_md5"), F.length("t").alias("n"))


@query("H24", "files", r"""WITH s AS (SELECT p_partkey AS sid, printf('%02d ', p_partkey % 100) || p_brand || CASE WHEN p_partkey % 3 = 0 THEN '_ ' || p_name
        WHEN p_partkey % 3 = 1 THEN '_-_' || p_type || ' - 0' || (p_partkey % 10) || ' ' || p_name ELSE '' END || CASE WHEN p_partkey % 2 = 0 THEN ' (' || p_type || '_Edit)' ELSE '' END || '_PN' AS stem,
        p_brand, p_name, p_type FROM part)
    SELECT sid, CASE WHEN sid % 3 < 2 THEN p_brand END AS artist, CASE WHEN sid % 3 < 2 THEN p_name ELSE p_brand END AS title,
        CASE WHEN sid % 2 = 0 THEN p_type || ' Edit' END AS remixer, CASE WHEN sid % 3 = 1 THEN p_type END AS album FROM s""")
def path_metadata(spark, d):
    key = F.col("p_partkey")
    middle = (
        F.when(key % 3 == 0, F.concat(F.lit("_ "), "p_name"))
        .when(key % 3 == 1, F.concat(F.lit("_-_"), "p_type", F.lit(" - 0"), (key % 10).cast("string"), F.lit(" "), "p_name"))
        .otherwise("")
    )
    bracket = F.when(key % 2 == 0, F.concat(F.lit(" ("), "p_type", F.lit("_Edit)"))).otherwise("")
    stem = F.concat(F.lpad((key % 100).cast("string"), 2, "0"), F.lit(" "), "p_brand", middle, bracket, F.lit("_PN"))
    part = scan(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type")
    return part.select(key.alias("sid"), tags.path_metadata(stem).alias("m")).select("sid", "m.*")
