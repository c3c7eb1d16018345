"""URL filter: host and path rules, and for the rest a Bloom filter cascade over the hosts of the corpus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelight.llm.common import discard, stored, table

#: (verdict, host, path): a rule fits its host and all subdomains if the url's path starts with its path.
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
#: Labels of hosts that the list of the query holds, with any subdomain in front.
LISTED_NAMES = ("ads-track", "free-bets", "cheap-pills", "spam-farm", "casino-win", "adult-x")
FIRST_BITS_PER_KEY, BITS_PER_KEY, HASHES = 12, 8, 4
#: Words of 64 bits that may be sent to every task; a larger level is kept in segments that are joined by segment number.
MOST_WORDS = 1 << 20


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case; empty without ``://`` or url."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does; of equal lengths the first by text."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _bits(key: Column, level: int, bits: int) -> list[Column]:
    """The bit positions of a key at a level: double hashing of two 64-bit hashes."""
    one = F.pmod(F.xxhash64(key, F.lit(2 * level)), F.lit(bits))
    two = F.pmod(F.xxhash64(key, F.lit(2 * level + 1)), F.lit(bits - 1)) + 1
    return [F.pmod(one + two * F.lit(i), F.lit(bits)) for i in range(HASHES)]


@dataclass
class Level:
    """One Bloom filter: its 64-bit words by index (segment, words), where each segment holds ``width`` words."""

    number: int
    bits: int
    width: int
    segments: DataFrame

    @property
    def whole(self) -> bool:
        return self.bits <= 64 * self.width


def _level(keys: DataFrame, number: int, count: int, most_words: int) -> Level:
    words = max(1, -(-count * (BITS_PER_KEY if number else FIRST_BITS_PER_KEY) // 64))
    bits, width = 64 * words, min(words, most_words)
    position = F.explode(F.array(*_bits(F.col("key"), number, bits)))
    parts = keys.select(position.alias("bit")).groupBy(F.floor(F.col("bit") / 64).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))).alias("value"))
    parts = parts.select(F.floor(F.col("word") / width).alias("segment"), (F.col("word") % width).alias("word"), "value")
    packed = parts.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("word", "value"))).alias("by_word"))
    filled = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(width - 1).cast("long")), lambda w: F.coalesce(F.col("by_word")[w], F.lit(0).cast("long")))
    return Level(number, bits, width, stored(packed.select("segment", filled.alias("words")), "bloom"))


def _passes(rows: DataFrame, key: str, level: Level, out: str) -> DataFrame:
    """Adds ``out``: whether every bit of the key is set at the level."""
    bits = _bits(F.col(key), level.number, level.bits)
    if level.whole:  # a value of bounded size, in no join
        words = level.segments.agg(F.first("words")).scalar()
        rows = rows.withColumn("_words", words)
        hit = [F.bit_get(F.col("_words")[F.floor(b / 64).cast("int")], (b % 64).cast("int")) == 1 for b in bits]
        test = hit[0]
        for h in hit[1:]:
            test = test & h
        return rows.withColumn(out, F.coalesce(test, F.lit(False))).drop("_words")
    # too large to send: each distinct key asks the segments that hold its bits
    asked = rows.select(key).distinct().select(key, F.explode(F.array(*bits)).alias("bit"))
    asked = asked.select(key, F.floor(F.col("bit") / (64 * level.width)).alias("segment"), (F.col("bit") % (64 * level.width)).alias("at"))
    asked = asked.join(level.segments, "segment", "left")
    set_ = F.coalesce(F.bit_get(F.col("words")[F.floor(F.col("at") / 64).cast("int")], (F.col("at") % 64).cast("int")) == 1, F.lit(False))
    answer = asked.select(key, set_.alias("set")).groupBy(key).agg(F.bool_and("set").alias(out))
    return rows.join(answer, key, "left")


@dataclass
class Cascade:
    """Filters that take turns: listed keys, then those of the rest that pass, then listed ones that pass that, and so on."""

    levels: list[Level]

    def listed(self, rows: DataFrame, key: str, out: str) -> DataFrame:
        """Adds ``out``: whether the key is listed. Exact for every key of the universe: it is listed if the first level
        that it does not pass has an odd place (counted from 0), or it passes all and their number is odd."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in self.levels:
            rows = _passes(rows, key, level, f"_pass{level.number}")
        for level in reversed(self.levels):
            answer = F.when(~F.col(f"_pass{level.number}"), F.lit(level.number % 2 == 1)).otherwise(answer)
        return rows.withColumn(out, answer).drop(*[f"_pass{level.number}" for level in self.levels])


def build_cascade(universe: DataFrame, most_words: int = MOST_WORDS) -> Cascade:
    """The cascade of a universe (key, listed) of distinct keys that are not null.

    Each level needs only the keys that pass it wrongly, a few percent of the larger side, so it ends after a few levels; a
    level adds hashes of its own, so a key that passes one passes the next by chance only.
    """
    inside, outside = stored(universe.where("listed").select("key"), "listed"), universe.where("NOT listed").select("key")
    levels: list[Level] = []
    spent = []
    while count := inside.count():
        level = _level(inside, len(levels), count, most_words)
        levels.append(level)
        wrong = stored(_passes(outside, "key", level, "_in").where("_in").select("key"), "passing")
        spent.append(inside)
        inside, outside = wrong, inside
    discard(*spent, inside)
    return Cascade(levels)


def judge(pages: DataFrame, names: tuple[str, ...] = LISTED_NAMES, rules=RULES, most_words: int = MOST_WORDS) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    The longest rule that fits decides. Where none does, ``block`` if the host is listed: its last labels but two and the
    top one hold one of ``names``; the list is applied to the distinct hosts of the pages, which are the cascade's universe,
    and every page then asks the filters, so no page is joined with a list. Null urls and urls without ``://`` have an empty
    host and path, fit no rule and are allowed. Repeated rows are judged alike, extra columns are not read.
    """
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    universe = split.select("host").distinct().select(F.col("host").alias("key"), F.arrays_overlap(labels, F.array(*[F.lit(n) for n in names])).alias("listed"))
    cascade = build_cascade(stored(universe, "hosts"), most_words)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    asked = cascade.listed(split, "host", "_listed")
    return asked.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("_listed"), "block").otherwise("allow")).alias("verdict"))


def op7_bloom_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return judge(table(spark, folder, "pages").select("page_id", "url"))


def _fits_sql(host: str, path: str) -> str:
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"


OP7_SQL = f"""
WITH split AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
ruled AS (SELECT *, CASE WHEN {_fits_sql('example.org', '/en/1')} THEN 'example.org/en/1' WHEN {_fits_sql('example.org', '/es/')} THEN 'example.org/es/'
    WHEN {_fits_sql('com', '/fr/')} THEN 'com/fr/' WHEN {_fits_sql('com', '/de/')} THEN 'com/de/' WHEN {_fits_sql('org', '/')} THEN 'org/' END AS rule FROM split)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' WHEN rule IN ('com/fr/', 'org/') THEN 'allow'
    WHEN list_has_any(string_split(host, '.'), {list(LISTED_NAMES)}) THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""
