"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cratelight.llm.common import running_total, slices_for, stored, table

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SLOTS = 1 << 18
GOLDEN = 2654435769  # 2**32 / golden ratio
RING = 1 << 32


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII blanks; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Adds ``rank``, ``weight`` and ``target`` to (source, source_size), one row per source.

    Sources in code-point order, null last, take ``weights`` in turn. The targets share the sum of all sizes by weight, none
    above ``most`` times its size; what is cut off goes to the others by weight, until none is above. With the sources
    in the order of the level at which they are full, that level is found from running sums: no loop.
    """
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = ranked.withColumn("total", F.sum("source_size").over(everything)).withColumn(
        "level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    )
    full = F.col("cap") <= F.col("level") * F.col("weight")
    rest = F.max(F.when(~full, F.col("level"))).over(everything)
    return levels.withColumn("target", F.when(full, F.col("cap").cast("double")).otherwise(rest * F.col("weight"))).select(
        "source", "source_size", "rank", "weight", "target", "total")


def schedule(goals: DataFrame, block: int, slots: int, slots_per_slice: int = 1 << 14, most: int = MOST_REPEATS) -> DataFrame:
    """(rank, block, repeat, slot): which block of which source each slot of the mix takes.

    Slot i is the point i * GOLDEN mod 2**32; the source whose range of cumulative targets holds the point takes the slot. A
    source's slots are ranked in their order, slice by slice, and slot number k of a source takes its block k, going round
    at its last block, ``most`` times at most.
    """
    spark = goals.sparkSession
    ordered = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = goals.where("target > 0").withColumn("upto", F.sum("target").over(ordered)).withColumn("whole", F.sum("target").over(everything))
    ranges = ranges.withColumn("high", F.when(F.col("upto") >= F.col("whole"), F.lit(RING)).otherwise(F.floor(F.col("upto") / F.col("whole") * RING)).cast("long"))
    ranges = ranges.withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("rank")), F.lit(0).cast("long")))
    ladder = ranges.agg(F.sort_array(F.collect_list(F.struct("high", "rank", "low"))).alias("steps"))  # one step per source
    points = spark.range(slots).select(F.col("id").alias("slot"), ((F.col("id") * GOLDEN) % RING).alias("point"))
    found = F.expr("""aggregate(sequence(1, 32), struct(0 AS lo, size(steps) - 1 AS hi), (s, i) -> if(s.lo < s.hi,
        if(steps[shiftright(s.lo + s.hi, 1)].high <= point, struct(shiftright(s.lo + s.hi, 1) + 1 AS lo, s.hi AS hi), struct(s.lo AS lo, shiftright(s.lo + s.hi, 1) AS hi)), s),
        s -> steps[s.lo].rank)""")
    picked = points.withColumn("steps", ladder.scalar()).select("slot", found.alias("rank"))
    cut = picked.withColumn("slice", F.floor(F.col("slot") / slots_per_slice))
    sums = cut.groupBy("rank", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("rank").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("rank", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("rank", "slice").orderBy("slot")) - 1
    numbered = cut.withColumn("own", place).join(offsets, ["rank", "slice"])
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    k = F.col("own") + F.col("offset")
    dealt = numbered.join(F.broadcast(goals.select("rank", "source_size")), "rank")  # one row per source
    return dealt.select("rank", (k % blocks).alias("block"), F.floor(k / blocks).alias("repeat"), "slot").where(F.col("repeat") < most)


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, digest), stored: the texts are read once."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), digest.alias("digest")), "sizes")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, slots: int = SLOTS, rows_per_slice: int = 50_000) -> DataFrame:
    """One row per document and block: (doc_id, source, size, source_size, target, at, first, last, slots).

    The documents of a source stand in the order of the md5 of their id; their words form a line that is cut into blocks of
    total / ``slots`` words (the last one is shorter). ``first`` and ``last`` bound the words of the document, counted from 0,
    that lie in the block, ``slots`` are the places of the mix that take the block, in order; empty if none does. ``at``
    is where the document begins on its source's line. The size of a block only sets how finely the mix alternates.
    A document without words (null text too) is one row with nothing taken. Null ids and sources are ids and a source like
    others, repeated rows are documents of their own. Columns other than doc_id, text and source are not read.
    """
    small = sized(docs)
    sources = small.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(sources, weights), "targets")  # one row per source
    total = goals.agg(F.max("total")).first()[0] or 0
    block = max(1, -(-total // slots))
    ranked = small.join(goals.select(F.col("source").alias("_source"), "rank", "source_size", "target"), F.col("source").eqNullSafe(F.col("_source")))
    count = small.count()
    placed = running_total(ranked.drop("_source"), "rank", "digest", ["doc_id", "size"], F.col("size"), "at", slices_for(count, rows_per_slice))
    last = F.greatest(F.col("at"), F.col("at") + F.col("size") - 1)
    parts = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor(last / block))))
    taken = schedule(goals, block, -(-total // block), most=MOST_REPEATS).groupBy("rank", "block").agg(F.sort_array(F.collect_list("slot")).alias("slots"))
    begin = F.greatest(F.lit(0).cast("long"), F.col("block") * block - F.col("at"))
    end = F.least(F.col("size"), (F.col("block") + 1) * block - F.col("at"))
    return parts.join(taken, ["rank", "block"], "left").select(
        "doc_id", "source", "size", "source_size", "target", "digest", "at", begin.alias("first"), end.alias("last"),
        F.coalesce("slots", F.array().cast("array<bigint>")).alias("slots"))


def taken_words(mixed: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per document of a mix."""
    words = (F.col("last") - F.col("first")) * F.size("slots")
    # documents without words may share a place; each keeps its row
    some = mixed.where("size > 0").groupBy("doc_id", "source", "digest", "at", "size", "source_size", "target").agg(F.sum(words).alias("taken"))
    none = mixed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    columns = ["doc_id", "source", "size", "source_size", "target", "taken"]
    return some.select(columns).union(none.select(columns))


def op6_golden_mix(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to the weights 5, 2, 1 in turn: the words that the mix takes of each."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return taken_words(mix(docs)).select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = rf"""
WITH sized AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS digest,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS rank FROM sized GROUP BY source),
weighted AS (SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, 3 * source_size AS cap, sum(source_size) OVER () AS total FROM sources),
levels AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted),
goals AS (SELECT *, CASE WHEN cap <= level * weight THEN cap::DOUBLE ELSE max(CASE WHEN cap > level * weight THEN level END) OVER () * weight END AS target FROM levels),
size AS (SELECT greatest(1, ceil(max(total) / {SLOTS}.0))::BIGINT AS block, max(total)::BIGINT AS total FROM goals),
steps AS (SELECT rank, sum(target) OVER (ORDER BY rank ROWS UNBOUNDED PRECEDING) AS upto, sum(target) OVER () AS whole FROM goals WHERE target > 0),
highs AS (SELECT rank, CASE WHEN upto >= whole THEN {RING} ELSE floor(upto / whole * {RING}) END::BIGINT AS high FROM steps),
ranges AS (SELECT rank, high, coalesce(lag(high) OVER (ORDER BY rank), 0) AS low FROM highs),
points AS (SELECT i AS slot, (i * {GOLDEN}) % {RING} AS point FROM (SELECT unnest(range((SELECT ceil(total / block) FROM size)::BIGINT)) AS i)),
dealt AS (SELECT rank, row_number() OVER (PARTITION BY rank ORDER BY slot) - 1 AS k FROM points JOIN ranges ON point >= low AND point < high),
taken AS (SELECT d.rank, k % ceil(source_size / block)::BIGINT AS block, count(*) AS times FROM dealt d JOIN goals USING (rank), size
    WHERE k // ceil(source_size / block)::BIGINT < 3 GROUP BY ALL),
placed AS (SELECT s.doc_id, s.size, s.digest, g.rank, g.source_size, g.target, coalesce(sum(s.size) OVER (PARTITION BY g.rank ORDER BY s.digest, s.doc_id, s.size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
parts AS (SELECT p.*, size.block AS width, unnest(range(begins // size.block, greatest(begins, begins + size - 1) // size.block + 1)) AS block FROM placed p, size)
SELECT p.doc_id, p.size::BIGINT AS size, p.source_size, p.target, coalesce(sum(times * (least(p.begins + p.size, (p.block + 1) * width) - greatest(p.begins, p.block * width))), 0)::BIGINT AS taken
FROM parts p LEFT JOIN taken t ON p.rank = t.rank AND p.block = t.block GROUP BY p.doc_id, p.size, p.source_size, p.target, p.begins, p.digest
"""
