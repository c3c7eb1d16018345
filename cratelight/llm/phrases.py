"""Collocations: every shard of a language keeps its words as ids under a suffix order, finds its phrases by extending
intervals of the Burrows-Wheeler transform by one word on either side, and the shards' counts are summed."""

from __future__ import annotations

from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratelight.llm.common import U64, _classes, discard, mix, pieces_of, slices_for, stored, table, text_bytes, tokens
from cratelight.session import Bucketed

WORDS_PER_SHARD = 1_000_000
LONGEST = 5
# Bytes that end a piece, and bytes that only part words.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
PARTS = b" \t"
KINDS = _classes(PIECE_ENDS + PARTS, False)
SHARDS = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("local", T.IntegerType()),
    T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("codes", T.BinaryType()),
])
PHRASES_PER_BUCKET = 2_000_000
NARROW = "shard long, codes binary, gids binary, n_codes long"
FOUND = "shard long, bucket long, heads binary, rests binary, sizes binary"
LEVEL = "shard long, gid long, head long, rest long, f long, length int, heads binary, rests binary, ids binary"


# ---- from texts to shards -----------------------------------------------------------------------------------------------


def words_of(texts) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """An Arrow string array as word hashes with 0 before each piece, the distinct hashes, and their words."""
    data, bounds = text_bytes(texts)
    data = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))
    found = tokens(data, bounds, KINDS)
    if not len(found.starts):
        return np.zeros(0, U64), np.zeros(0, U64), []
    ends_before = np.concatenate([[0], np.cumsum(np.isin(data, np.frombuffer(PIECE_ENDS, np.uint8)), dtype=np.int64)])[found.starts]
    new = np.append(True, ends_before[1:] != ends_before[:-1])
    firsts = found.bounds[:-1]
    new[firsts[firsts < len(new)]] = True
    hashes = np.maximum(found.hashes, U64(1))
    out = np.zeros(len(hashes) + int(new.sum()), U64)
    out[np.arange(len(hashes)) + np.cumsum(new)] = hashes
    distinct, at = np.unique(hashes, return_index=True)
    begin = found.starts[at]
    gaps = np.append(np.flatnonzero(KINDS[data] == 0), len(data))
    end = np.minimum(gaps[np.searchsorted(gaps, begin)], bounds[np.searchsorted(bounds, begin, "right")])
    raw = data.tobytes()
    return out, distinct, [raw[b:e] for b, e in zip(begin.tolist(), end.tolist(), strict=True)]


def _squeezed(codes: np.ndarray) -> bytes:
    """Ids as compressed planes of equal bytes: as frequent words have small ids, the upper planes are nearly all 0."""
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(codes, "<i4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unsqueezed(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


class _Shard:
    def __init__(self) -> None:
        self.parts, self.known, self.words, self.size = [], [], [], 0

    def add(self, texts) -> None:
        codes, distinct, words = words_of(texts)
        self.parts.append(codes)
        self.known.append(distinct)
        self.words.append(words)
        self.size += len(codes)

    def rows(self, shard: int, lang: str):
        """The shard's sequence of local word ids (0 parts pieces, then by falling count), and a row for each of its words."""
        hashes = np.concatenate([*self.parts, np.zeros(1, U64)])
        known, at = np.unique(np.concatenate(self.known), return_index=True)
        words = [w for part in self.words for w in part]
        codes = np.where(hashes == 0, 0, np.searchsorted(known, hashes) + 1)
        n = len(known)
        counts = np.bincount(codes, minlength=n + 1)
        order = np.argsort(-counts[1:], kind="stable")
        local = np.zeros(n + 1, np.int32)
        local[order + 1] = np.arange(1, n + 1)
        codes, counts = local[codes], np.append(counts[:1], counts[1:][order])
        names = [words[i] for i in at[order].tolist()]
        columns = [
            pa.array([shard] * (n + 1), pa.int64()), pa.array([lang] * (n + 1), pa.string()), pa.array([None, *range(1, n + 1)], pa.int32()),
            pa.array([None, *[w.decode("utf-8", "replace") for w in names]], pa.string()), pa.array([int(counts[1:].sum()), *counts[1:].tolist()], pa.int64()),
            pa.array([_squeezed(codes)] + [None] * n, pa.binary()),
        ]
        rows = pa.RecordBatch.from_arrays(columns, SHARDS.names)
        for at in range(0, n + 1, 50_000):
            yield rows.slice(at, 50_000)


def _shards(words_per_shard: int):
    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[str, _Shard] = {}
        for batch in batches:
            for part in pieces_of(batch):
                langs = part.column("lang")
                for lang in langs.unique().to_pylist():
                    own = held.setdefault(lang, _Shard())
                    own.add(part.filter(pa.compute.equal(langs, lang)).column("text"))
                    if own.size >= words_per_shard:
                        yield from held.pop(lang).rows(number, lang)
                        number += 1
        for lang, own in held.items():
            yield from own.rows(number, lang)
            number += 1

    return run


def shards_of(docs: DataFrame, words_per_shard: int = WORDS_PER_SHARD) -> DataFrame:
    """Texts (null: empty) of one language (null: ``und``) in shards of about ``words_per_shard`` words: a row with the codes,
    and a row (local, word, n) for each distinct word of the shard."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    return rows.mapInArrow(_shards(words_per_shard), SHARDS)


# ---- the index of a shard -----------------------------------------------------------------------------------------------


class Index:
    """Burrows-Wheeler transform of a sequence under the order of its suffixes' first eight words.

    That order is enough for phrases of up to eight words: an interval of rows holds the places of a phrase, and stepping
    from a row to the row of the place before it (``step``) keeps rows of equal words in order.
    """

    def __init__(self, codes: np.ndarray) -> None:
        rank, width = codes.astype(np.int64), 1
        while width < LONGEST:
            shifted = np.append(rank[width:], np.zeros(min(width, len(rank)), np.int64))
            rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + shifted, return_inverse=True)[1]
            width *= 2
        order = np.argsort(rank, kind="stable")
        self.before = codes[order - 1]
        by_word = np.argsort(self.before, kind="stable")
        self.step = np.empty(len(codes), np.int64)
        self.step[by_word] = np.arange(len(codes))


def _rows_of(low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All rows of the intervals and the interval each belongs to."""
    owner = np.repeat(np.arange(len(low)), size)
    return low[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size), owner


def extended(index: Index, words: int, low: np.ndarray, other: np.ndarray, size: np.ndarray, gid: np.ndarray):
    """Intervals one word longer: (owner, low, other, size, known).

    ``low`` are intervals in ``index``, ``other`` those of the same phrases in the index of the reversed sequence: each word
    that stands before an interval's rows gives one longer phrase, found in the other index after all smaller words.
    ``known`` is the gid of the longer phrase without its far word; phrases where that is not among ``gid`` are left out.
    """
    rows, owner = _rows_of(low, size)
    mark = np.zeros(len(index.before), np.int64)
    mark[rows] = gid[owner]
    key = owner * (words + 1) + index.before[rows]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    own = owner[order[first]]
    inside = first - (np.cumsum(size) - size)[own]  # places in the interval before smaller words
    new = index.step[rows[order[first]]]
    known = mark[new]
    keep = (key[first] % (words + 1) > 0) & (known > 0)
    return own[keep], new[keep], (other[own] + inside)[keep], count[keep], known[keep]


def _packed(values: np.ndarray) -> bytes:
    """64-bit numbers as compressed planes of equal bytes: small or slowly growing numbers take a byte or two."""
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpacked(column) -> np.ndarray:
    parts = [np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8) for raw in column.to_pylist()]
    return np.concatenate([np.ascontiguousarray(p.reshape(8, -1).T).view("<i8").ravel() for p in parts]) if parts else np.zeros(0, np.int64)


def _table(schema: str, *columns) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns or [[]] * len(fields), fields, strict=True)], [n for n, _ in fields])


def _compact(sequence: np.ndarray) -> np.ndarray:
    """One 0 between runs of words, and around all; runs of one word are no phrase and go."""
    sequence = np.concatenate([[0], sequence, [0]])
    word = sequence > 0
    word[1:-1] &= word[:-2] | word[2:]
    sequence = np.where(word, sequence, 0)
    return sequence[word | np.append(True, word[:-1])].astype(np.int32)


def _narrow(codes: pa.Table, frequent: pa.Table) -> pa.Table:
    """The shard with its frequent words alone, numbered anew."""
    if not codes.num_rows or not frequent.num_rows:
        return _table(NARROW)
    sequence = _unsqueezed(codes.column("codes")[0].as_py())
    local, gids = frequent.column("local").to_numpy(), frequent.column("gid").to_numpy()
    order = np.argsort(local)
    numbers = np.zeros(max(int(sequence.max(initial=0)), int(local.max())) + 1, np.int32)
    numbers[local[order]] = np.arange(1, len(local) + 1)
    return _sequence_row(codes, _compact(numbers[sequence]), gids[order])


def _sequence_row(codes: pa.Table, sequence: np.ndarray, gids: np.ndarray) -> pa.Table:
    if not sequence.any():
        return _table(NARROW)
    return _table(NARROW, [codes.column("shard")[0].as_py()], [_squeezed(sequence)], [_packed(gids)], [len(sequence)])


def _numbers_of(heads: np.ndarray, rests: np.ndarray, known: pa.Table) -> np.ndarray:
    """The gid of each pair (head, rest) among the ``known`` frequent phrases, 0 where it is not one of them."""
    known_heads, known_rests, ids = (_unpacked(known.column(c)) for c in ("heads", "rests", "ids"))
    if not len(ids) or not len(heads):
        return np.zeros(len(heads), np.int64)
    all_heads, all_rests = np.unique(known_heads), np.unique(known_rests)
    wanted = np.searchsorted(all_heads, known_heads) * len(all_rests) + np.searchsorted(all_rests, known_rests)
    order = np.argsort(wanted)
    head, rest = np.searchsorted(all_heads, heads).clip(max=len(all_heads) - 1), np.searchsorted(all_rests, rests).clip(max=len(all_rests) - 1)
    key = head * len(all_rests) + rest
    at = order[np.searchsorted(wanted, key, sorter=order).clip(max=len(order) - 1)]
    return np.where((wanted[at] == key) & (all_heads[head] == heads) & (all_rests[rest] == rests), ids[at], 0)


def _thin(codes: pa.Table, known: pa.Table) -> pa.Table:
    """The shard with only those words that stand in a frequent pair."""
    if not codes.num_rows or not known.num_rows:
        return _table(NARROW)
    sequence, gids = _unsqueezed(codes.column("codes")[0].as_py()), np.append(0, _unpacked(codes.column("gids")))
    first = np.flatnonzero((sequence[:-1] > 0) & (sequence[1:] > 0))
    first = first[_numbers_of(gids[sequence[first]], gids[sequence[first + 1]], known) > 0]
    keep = np.zeros(len(sequence), bool)
    keep[first] = keep[first + 1] = True
    return _sequence_row(codes, _compact(np.where(keep, sequence, 0)), gids[1:])


def _runs(order: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
    """``order`` in pieces of equal ``key``, by which it is sorted."""
    return np.split(order, np.flatnonzero(np.diff(key[order])) + 1) if len(order) else []


def _phrases(target: int, buckets: int):
    """Phrases of ``target`` words of a shard with their counts, packed by bucket.

    From single words on, phrases grow by a word to the left (even lengths, in the index of the sequence) or to the right
    (odd lengths, in that of the reversed sequence); both intervals are kept. Only those frequent over all shards go on. For
    pairs nothing but the shards is needed, which are mapped where they lie.
    """

    def pairs(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # a shard is a row
                yield from run(pa.Table.from_batches([batch.slice(i, 1)]), None).to_batches()

    def run(codes: pa.Table, known: pa.Table | None) -> pa.Table:
        if not codes.num_rows:
            return _table(FOUND)
        sequence, gid = _unsqueezed(codes.column("codes")[0].as_py()), _unpacked(codes.column("gids"))
        words, indexes = len(gid), {}
        size = np.bincount(sequence, minlength=words + 1)
        forward = backward = np.cumsum(size)[:-1]  # of single words: equal intervals in both indexes
        size = size[1:]
        for length in range(2, target + 1):
            left = length % 2 == 0
            if left not in indexes:
                indexes[left] = Index(sequence if left else sequence[::-1])
            if left:
                own, forward, backward, size, side = extended(indexes[left], words, forward, backward, size, gid)
                heads, rests = side, gid[own]
            else:
                own, backward, forward, size, side = extended(indexes[left], words, backward, forward, size, gid)
                heads, rests = gid[own], side
            if length < target:
                gid = _numbers_of(heads, rests, known.filter(pa.compute.equal(known.column("length"), length)))
                often = gid > 0
                gid, forward, backward, size = gid[often], forward[often], backward[often], size[often]
        bucket = (mix(heads.astype(U64) ^ mix(rests.astype(U64))) % U64(buckets)).astype(np.int64)
        order = np.lexsort((heads, rests, bucket))
        blocks = _runs(order, bucket)
        shard = codes.column("shard")[0].as_py()
        return _table(FOUND, [shard] * len(blocks), [int(bucket[b[0]]) for b in blocks], *[[_packed(x[b]) for b in blocks] for x in (heads, rests, size)])

    return run if target > 2 else pairs


def _summed(min_count: int, length: int):
    """The frequent phrases of a bucket, and for each shard those of its phrases that are among them."""

    def run(found: pa.Table) -> pa.Table:
        parts = [[_unpacked(found.column(c)[i : i + 1]) for c in ("heads", "rests", "sizes")] for i in range(found.num_rows)]
        heads, rests, sizes = (np.concatenate([p[k] for p in parts]) for k in range(3))
        shards = np.repeat(found.column("shard").to_numpy(), [len(p[0]) for p in parts])
        order = np.lexsort((shards, heads, rests))
        heads, rests, shards = heads[order], rests[order], shards[order]
        first = np.flatnonzero(np.concatenate([[True], (heads[1:] != heads[:-1]) | (rests[1:] != rests[:-1])]))
        totals = np.add.reduceat(sizes[order], first)
        often = totals >= min_count
        base = (found.column("bucket")[0].as_py() << 32) + 1
        ids = np.where(often, base + np.cumsum(often) - 1, 0)
        entries = np.repeat(ids, np.diff(np.append(first, len(heads))))
        n = int(often.sum())
        none, size = [None] * n, [length] * n
        grams = _table(LEVEL, none, ids[often], heads[first][often], rests[first][often], totals[often], size, none, none, none)
        kept = np.flatnonzero(entries)
        kept = kept[np.argsort(shards[kept], kind="stable")]
        blocks = _runs(kept, shards)
        none = [None] * len(blocks)
        packed = [[_packed(x[b]) for b in blocks] for x in (heads, rests, entries)]
        back = _table(LEVEL, [int(shards[b[0]]) for b in blocks], none, none, none, none, [length] * len(blocks), *packed)
        return pa.concat_tables([grams, back])

    return run


# ---- counts over all shards ---------------------------------------------------------------------------------------------


def frequent_phrases(docs: DataFrame, min_count: int = 100, words_per_shard: int = WORDS_PER_SHARD, per_bucket: int = PHRASES_PER_BUCKET) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n): all words; and for each length from 1 a table (gid, lang, phrase, last, f, heads, rests) of the phrases that
    occur ``min_count`` times or more. ``heads`` and ``rests`` are the counts of a phrase's beginnings and ends by length.

    A phrase is as frequent as required only if both phrases one word shorter are, so each round extends only intervals of
    phrases frequent over all shards: the numbers of those go back to the shards that hold them, and to no other. Counts
    travel packed, by shard and bucket; a bucket of phrases meets in one task, with about ``per_bucket`` counts at most
    whatever the input, since a shard tells a phrase once. The shards themselves lie in buckets by their number, so what goes
    back is sent to them and no sequence passes through a shuffle.
    """
    with ExitStack() as kept:

        def clustered(df: DataFrame, name: str) -> DataFrame:
            return kept.enter_context(Bucketed(df, name, ["shard"], moved=False)).table

        shards = stored(shards_of(docs, words_per_shard), "shards")
        totals = stored(shards.where("local IS NULL").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
        counts, word = F.array().cast("array<bigint>"), Window.partitionBy("lang", "word")
        summed = shards.where("local IS NOT NULL").select("lang", "word", "shard", "local", F.sum("n").over(word).alias("f")).where(F.col("f") >= min_count)
        numbered = summed.withColumn("row", F.monotonically_increasing_id() + 1).withColumn("gid", F.min("row").over(word))
        words = stored(numbered, "words")  # a row for each shard that holds a frequent word, from one shuffle
        level = words.where("row = gid").select(
            "gid", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", counts.alias("heads"), counts.alias("rests"))
        levels = [level]
        back = words.select(F.col("shard").alias("at"), "local", "gid")
        codes = clustered(shards.where("local IS NULL").select("shard", "codes"), "codes")
        discard(shards)
        narrow = clustered(codes.groupBy("shard").cogroup(back.groupBy("at")).applyInArrow(_narrow, NARROW), "narrow")
        discard(codes)
        known = None
        for length in range(2, LONGEST + 1):
            buckets = slices_for(narrow.agg(F.coalesce(F.sum("n_codes"), F.lit(0))).first()[0], per_bucket)
            if known is None:
                found = narrow.mapInArrow(_phrases(length, buckets), FOUND)
            else:
                found = narrow.groupBy("shard").cogroup(known.groupBy("at")).applyInArrow(_phrases(length, buckets), FOUND)
            summed = stored(found.groupBy("bucket").applyInArrow(_summed(min_count, length), LEVEL), "summed")
            head = level.select(F.col("gid").alias("head"), "lang", F.col("phrase").alias("begin"), F.col("f").alias("head_f"), "heads")
            rest = level.select(F.col("gid").alias("rest"), "last", F.col("f").alias("rest_f"), "rests")
            grams = summed.where("shard IS NULL").select("gid", "head", "rest", "f")
            level = stored(grams.join(head, "head").join(rest, "rest").select(
                "gid", "lang", F.concat_ws(" ", "begin", "last").alias("phrase"), "last", "f",
                F.concat("heads", F.array("head_f")).alias("heads"), F.concat("rests", F.array("rest_f")).alias("rests"), "head", "rest"), "phrases")
            levels.append(level)
            more = summed.where("shard IS NOT NULL").select(F.col("shard").alias("at"), "length", "heads", "rests", "ids")
            if known is None:
                wide, narrow = narrow, clustered(narrow.groupBy("shard").cogroup(more.groupBy("at")).applyInArrow(_thin, NARROW), "thin")
                discard(wide)
            known = more if known is None else known.union(more)
    return totals, levels


def _best_cut(length: int) -> Column:
    """The lowest floor(1000 a n / (l r)) over all cuts, ties to the shortest first part; exact in decimals."""
    def number(c: Column) -> Column:
        return c.cast("decimal(18,0)")

    cuts = []
    for k in range(1, length):
        left, right = F.get("heads", F.lit(k - 1)), F.get("rests", F.lit(length - k - 1))
        score = F.call_function("div", number(F.col("f") * 1000) * number(F.col("n")), number(left) * number(right))
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(docs: DataFrame, min_count: int = 100, most: int = 2000, words_per_shard: int = WORDS_PER_SHARD) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``most`` best phrases of two to five words of each language.

    Texts are lower-cased (A-Z), parted into pieces at marks and line ends, and pieces into words; phrases stay within a
    piece. A phrase is left out where a longer one around it is as frequent, which one word more to either side shows. Null
    texts are empty, a null language is ``und``, repeated rows count each, an empty table gives no row; columns other than
    lang and text are not read. Ranks are gapless from 1 by score, count and phrase (UTF-8 bytes), so ties are settled.
    """
    totals, levels = frequent_phrases(docs, min_count, words_per_shard)
    rows = []
    for at, level in enumerate(levels[1:], 1):
        own = level.join(totals, "lang").withColumn("cut", _best_cut(at + 1))
        if at + 1 < len(levels):
            longer = levels[at + 1]
            around = longer.select(F.col("head").alias("gid"), F.col("f").alias("around")).union(longer.select("rest", "f"))
            most_around = around.groupBy("gid").agg(F.max("around").alias("around"))
            own = own.join(most_around, "gid", "left").where(F.coalesce("around", F.lit(0).cast("long")) < F.col("f"))
        rows.append(own.select("lang", "phrase", F.col("f").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")))
    every = rows[0]
    for more in rows[1:]:
        every = every.union(more)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return every.withColumn("rank", place).where(F.col("rank") <= most).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_fm_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2000 collocations of every language of all documents."""
    return collocations(table(spark, folder, "documents").select("lang", "text"))


OP13_SQL = """
WITH pieces AS (
  SELECT lang, piece
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
lists AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM pieces),
places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM lists),
grams AS (
  SELECT lang, w AS width, array_to_string(words[i:i + w - 1], ' ') AS phrase, count(*) AS f
  FROM places, range(1, 6) AS t(w) WHERE i + w - 1 <= len(words) GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
cuts AS (
  SELECT g.lang, g.phrase, g.width, g.f AS a, t.n, k, l.f AS l, r.f AS r, (1000::HUGEINT * g.f * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, width)) AS k, string_split(phrase, ' ') AS words FROM grams WHERE width > 1) g
  JOIN totals t USING (lang)
  JOIN grams l ON l.lang = g.lang AND l.phrase = array_to_string(g.words[1:k], ' ')
  JOIN grams r ON r.lang = g.lang AND r.phrase = array_to_string(g.words[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM grams q WHERE q.lang = b.lang AND q.width > b.width AND 100 * q.f >= 100 * b.a AND contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""
