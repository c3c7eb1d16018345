import collections
import re

import numpy as np
import pyarrow as pa

from cratelight.llm import language, quality
from cratelight.llm.common import WORDS, table, text_bytes, tokens


def figures(s: str) -> tuple:
    """The contract's five figures, by plain strings."""
    words = re.findall(r"[^\x20\x09-\x0D]+", s)
    grams = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    count, covered, seen, dup = collections.Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered.update(range(i, i + 5))
    for line in s.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(s.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_figures(spark, folder, edges, tags):
    rows = [r.text or "" for r in edges.collect()] + ["a\na\n a\na ", "a b c d e a b c d e f", "\n\n", "#*$%&|<>\x0b\x0c", "a b c d e a b c d e a b c d e", "é é\n\ré"]
    rows += [r.text for r in table(spark, folder, "documents").collect()]
    found = quality.base_figures(*text_bytes(pa.array(rows)))
    assert list(zip(*[found[c].tolist() for c in quality.FIGURES], strict=True)) == [figures(s) for s in rows]


def test_token_hashes_do_not_depend_on_where_a_text_lies():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("ab \n"), 50)) for _ in range(300)] + ["y" * 3_000_000, "y" * 3_000_000 + "z", "ab"]
    found = tokens(*text_bytes(pa.array(texts)), WORDS)
    names: dict = {}
    flat = [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
    assert found.counts().tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]
    for word, value in zip(flat, found.hashes.tolist(), strict=True):
        assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)


def test_verdicts_follow_the_labels(spark):
    folder = "/root/testdata/sf0.01"
    rows = quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels")).join(table(spark, folder, "labels"), "doc_id").collect()
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in rows)
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0 and not r.base_failed]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.5


def test_without_trusted_rows_the_base_rules_decide(spark, edges):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.kept == (not r.base_failed) and r.score == 0 for r in quality.judge(edges, none).collect())


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = language.op3_naive_bayes(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_unknown_and_brute_force(spark, edges):
    model = language.fit(edges.where("lang in ('en', 'es')"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(edges, model).collect()}
    assert got[20] == got[21] == got[22] == ("und", 0.0) and got[29] == ("und", 0.0) and got[23][0] in ("en", "es")
    assert all(r.lang_pred == "und" for r in language.predict(edges, None).collect())
    # the same sum, n-gram by n-gram
    s = "Ñandú de la\n12 quick"
    points = [ord(c) if c.isalpha() else 32 for c in " " + s.lower() + " "]
    total = model.prior.copy()
    for n in language.LENGTHS:
        for i in range(len(points) - n + 1):
            own = points[i : i + n]
            if set(own) == {32} or (n == 1 and i == len(points) - 1):
                continue
            code = n * 0x85EBCA6B & 0xFFFFFFFF
            for c in own:
                code = (code ^ c) * 0x9E3779B1 & 0xFFFFFFFF
                code ^= code >> 15
            total += model.scores[code >> (32 - language.BUCKET_BITS)]
    _, chance, _ = model.posterior(pa.array(["", s, "x"]))
    want = np.exp(total - total.max())
    assert abs(chance[1] - want.max() / want.sum()) < 1e-5
