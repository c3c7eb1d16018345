"""Prefix tries, line deduplication and collocations against plain versions on small inputs with planted cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from cratelight.llm import conversations, lines, phrases

# ---- prefix tries -------------------------------------------------------------------------------------------------------


def plain_tree(convs: dict[int, list[tuple[str, str]]]) -> set:
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(own) - 1) * (len(p[-1][1]) if p else 0)
    rows = set()
    for p, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(p))
        rows.add((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return rows


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, depth string, parent string, node string, heads string"


def rows_of(convs):
    return [(c, i, role, text, "x", "y", "z", "w") for c, turns in convs.items() for i, (role, text) in enumerate(turns)]


def test_two_fattest():
    for low in range(40):
        for high in range(low + 1, 41):
            assert conversations.two_fattest(low, high) == max(range(low + 1, high + 1), key=lambda f: f & -f)


def test_locate_takes_logarithmic_lookups():
    trie = conversations.ZFastTrie()
    draw = random.Random(3)
    found = []
    for c in range(300):
        length = draw.randrange(1, 200)
        keep = draw.randrange(0, length)
        base = found[draw.randrange(len(found))][0] if found else conversations.ROOT
        names = [base[16 * i : 16 * i + 16] for i in range(min(keep, len(base) // 16 - 1) + 1)]
        while len(names) <= length:
            names.append(hashlib.md5(names[-1] + bytes([draw.randrange(3)])).digest())
        found.append((b"".join(names), [1] * length, c))
    trie.insert_batch(found)

    class Counted(dict):
        looked = 0

        def get(self, key, default=None):
            Counted.looked += 1
            return dict.get(self, key, default)

    trie.handles = Counted(trie.handles)
    for heads, chars, _ in found:
        Counted.looked = 0
        node = trie.locate(heads, len(chars))
        assert node.extent == len(chars) and node.ends and Counted.looked <= 9
    assert trie.size <= 2 * len(found) + 1


@pytest.mark.parametrize("nodes", [3, 100_000])
def test_tree_equals_plain(spark, nodes):
    draw = random.Random(nodes)
    convs = {c: [(draw.choice("ua"), draw.choice(["", "a", "ab", "…é"])) for _ in range(draw.randrange(1, 9))] for c in range(-20, 150)}
    convs |= {c: convs[3] for c in range(200, 9000, 17)}  # a common conversation, over several chunks of ids
    convs[500_000] = [("u", str(i)) for i in range(700)]
    convs[500_001] = convs[500_000][:650] + [("u", "other")]
    data = spark.createDataFrame(rows_of(convs), SCHEMA).repartition(5)
    got = {tuple(r) for r in conversations.prefix_tree(conversations.sequences(data), nodes).select(COLUMNS).collect()}
    assert got == plain_tree(convs)


def test_turns_with_nulls_ties_and_strange_numbers(spark):
    rows = [(1, 2, "u", "b"), (1, None, None, "first"), (1, 0, "u", None), (2, -1, "", "x"), (2, -1, "", "x"), (None, 0, "u", "lost"), (3, 0, None, None)]
    data = spark.createDataFrame([(*r, "", "", "", "") for r in rows], SCHEMA)
    got = {tuple(r) for r in conversations.prefix_tree(conversations.sequences(data)).select(COLUMNS).collect()}
    assert got == plain_tree({1: [("", "first"), ("u", ""), ("u", "b")], 2: [("", "x"), ("", "x")], 3: [("", "")]})
    assert conversations.prefix_tree(conversations.sequences(data.limit(0))).count() == 0


def test_rebuilt(spark):
    import zlib

    convs = {c: [("u", f"{c} {i}") for i in range(c % 4 + 1)] for c in [0, 1, 7, 55, 103, 104, 199, 200, 201, 260]}
    got = {r.conv_id: [bytes(t.digest) for t in r.turns] for r in conversations.rebuilt(conversations.sequences(spark.createDataFrame(rows_of(convs), SCHEMA))).collect()}
    digest = lambda t: hashlib.md5(f"{len(t[0])}:{t[0]}{t[1]}".encode()).digest()
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        assert got[c] == [digest(t) for t in convs.get(c - c % 100, [])[:h] + turns[h:]]


# ---- lines --------------------------------------------------------------------------------------------------------------

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_lines(docs, min_chars, min_docs):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, text in docs:
        every = (text or "").split("\n")
        last = {k: max((x for x in h if x is not None), default=None) for k, h in holders.items() if len(k) >= min_chars and len(h) >= min_docs}
        kept = [x for x in every if key(x) not in last or last[key(x)] == i]
        out.append((i, len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_lines_equal_plain(spark):
    draw = random.Random(5)
    common = ["A line that many documents share with each", " \ta line that MANY documents share with each \r", "é" * 6, "short", "", "x" * 10]
    docs = [(i, "\n".join(draw.choice(common) + draw.choice(["", "", str(i)]) for _ in range(draw.randrange(1, 400)))) for i in range(60)]
    docs += [(None, None), (None, common[0]), (3, ""), (3, common[0] + "\n" + common[0]), (61, "\n\n"), (62, common[0] + "\n" * 3000 + common[1]), (62, common[0])]
    data = spark.createDataFrame([(i, t, "k", 1, "m") for i, t in docs], "doc_id long, text string, key string, pos int, bitmap string").repartition(4)
    for min_chars, min_docs in ((10, 5), (6, 2), (40, 61), (40, 1000)):
        got = lines.keep_lines(data, min_chars, min_docs)
        assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=str) == plain_lines(docs, min_chars, min_docs)
        assert {(r.rest.key, r.rest.pos, r.rest.bitmap) for r in got.collect()} == {("k", 1, "m")}
    assert lines.keep_lines(data.limit(0)).count() == 0


def test_lines_read_no_text_twice(spark, folder):
    """One shuffle of ranges, none of whole texts before the bitmaps meet the documents; nothing in Python."""
    data = spark.read.parquet(f"{folder}/documents.parquet")
    plan = lines.repeated_keys(lines.line_hashes(data))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h1" in plan and "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange ") <= 3


# ---- phrases ------------------------------------------------------------------------------------------------------------


def plain_phrases(docs, least, most):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for w in range(1, 6):
                for i in range(len(words) - w + 1):
                    f[lang][tuple(words[i : i + w])] += 1
    rows = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        own = []
        for p, a in often.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in often.items()):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            own.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(own)[:most], 1):
            rows.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(rows)


def phrase_docs():
    draw = random.Random(9)
    words = [f"w{i}" for i in range(12)] + ["É", "Ab c", "x" * 50, "(a)", "I", "i"]
    docs = []
    for i in range(300):
        body = [draw.choice(words) + draw.choice(["", "", "", " ", ".", ",", "\n", "\t"]) for _ in range(draw.randrange(0, 60))]
        docs.append((draw.choice(["en", "fr", None, "und", "é"]), " ".join(body) + draw.choice(["", " strong fixed long phrase here"])))
    return docs + [("en", None), ("en", ""), ("en", " . , "), ("fr", "aa aa aa aa aa aa aa " * 500), (None, "one"), ("en", "w1" * 100_000)] + [("en", "copy of a copy")] * 7


@pytest.mark.parametrize("least,most,size", [(3, 10_000, 1_000_000), (5, 7, 100), (4, 10_000, 1500)])
def test_phrases_equal_plain(spark, least, most, size):
    docs = phrase_docs()
    data = spark.createDataFrame([(t, lang, "p", 1) for lang, t in docs], "text string, lang string, phrase string, n int").repartition(3)
    got = phrases.collocations(data, least, most, size)
    assert sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()) == plain_phrases(docs, least, most)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", None), (None, "")], "lang string, text string")).count() == 0
    few = [("en", "a b. a b. a b"), ("fr", "c d. c d. c d. x c d e. x c d e. x c d e"), ("de", "f. f. f. f")]  # pairs without longer phrases, words without pairs
    assert sorted(tuple(r) for r in phrases.collocations(spark.createDataFrame(few, "lang string, text string"), 3).collect()) == plain_phrases(few, 3, 10)


def test_sequences_pass_through_no_shuffle(spark, monkeypatch):
    """What goes back to the shards is sent to where they lie; words meet once; ids are small for frequent words, so sequences are small."""
    from cratelight import session

    plans = []
    keep, bucket = phrases.stored, session.Bucketed.__init__

    def text(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString().splitlines())

    monkeypatch.setattr(phrases, "stored", lambda df, name: text(df) or keep(df, name))
    monkeypatch.setattr(session.Bucketed, "__init__", lambda self, df, *rest, **more: text(df) or bucket(self, df, *rest, **more))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        data = spark.createDataFrame(phrase_docs(), "lang string, text string").repartition(3)
        phrases.frequent_phrases(data, 3, 1500)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    of_words = 0
    for lines_ in plans:
        tree = [(len(line) - len(line.lstrip(" :+-")), line) for line in lines_]
        for at, (depth, line) in enumerate(tree):
            if "Exchange hashpartitioning(lang" in line and "word" in line:
                of_words += 1
            if "Exchange" not in line:
                continue
            for deeper, below in tree[at + 1 :]:  # what this exchange moves
                if deeper <= depth or "InArrow" in below:
                    break
                assert "codes" not in below
    assert plans and of_words == 1
    sequence = phrases.np.arange(100_000) % 200
    assert (phrases._unsqueezed(phrases._squeezed(sequence)) == sequence).all()


def test_frequent_words_of_a_shard_have_small_ids():
    import pyarrow as pa

    shard = phrases._Shard()
    shard.add(pa.array(["b a c. a b a", "a c d"]))
    rows = pa.Table.from_batches(shard.rows(7, "en")).to_pylist()
    assert [r["n"] for r in rows] == [9, 4, 2, 2, 1] and rows[1]["word"] == "a" and rows[4]["word"] == "d"
    names = {0: "|"} | {r["local"]: r["word"] for r in rows[1:]}
    assert "".join(names[i] for i in phrases._unsqueezed(rows[0]["codes"]).tolist()) == "|bac|aba|acd|"


def test_scores_beyond_64_bits(spark):
    """1000 a n passes 64 bits long before the counts do."""
    from pyspark.sql import functions as F

    a, n, left, right = 10**12 + 7, 10**13 + 9, 3 * 10**12 + 1, 10**12 + 11
    row = spark.range(1).select(F.lit(a).alias("f"), F.lit(n).alias("n"), F.array(F.lit(left)).alias("heads"), F.array(F.lit(right)).alias("rests"))
    assert row.select(phrases._best_cut(2).alias("c")).first().c.score == 1000 * a * n // (left * right)
