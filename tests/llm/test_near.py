"""Near-duplicates of texts and vectors against brute force."""

import collections

import numpy as np
import pyarrow as pa
import pytest

from cratelight.llm import dedup, vectors
from cratelight.llm.common import components, table, text_bytes


def shingles(text):
    w = (text or "").split()
    return collections.Counter(zip(w, w[1:], w[2:], w[3:], w[4:], strict=False)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])


def classes_of(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    bags = {i: shingles(t) for i, t in rows}
    linked, ids = [], sorted(bags)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = sum((bags[i] & bags[j]).values())
            if both and 5 * both >= 4 * sum((bags[i] | bags[j]).values()):
                linked.append((i, j))
    return classes_of(ids, linked)


def mutated(n: int):
    """A group of copies of one text with more and more words changed, and a chain in which only neighbours are alike."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in rng.integers(0, 500, 120)]
    rows = []
    for i in range(n):
        own = base[:]
        for k in rng.choice(120, int(rng.integers(0, 5)), replace=False):
            own[k] = f"x{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(own)))
    long = [f"c{i}" for i in range(400)]
    rows += [(1000 + i, " ".join(long[8 * i : 8 * i + 150])) for i in range(25)]
    rows += [(2000 + i, " ".join(["same"] * i)) for i in range(30)]
    return rows


@pytest.mark.parametrize("block", [1024, 16])
def test_classes(spark, block):
    rows = mutated(80)
    got = dedup.classes(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
    assert {r.doc_id: r.class_id for r in got} == brute(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_classes_of_a_table(spark, folder):
    docs = table(spark, folder, "documents")
    got = {r.doc_id: r.class_id for r in dedup.op4_bag_minhash(spark, folder).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_one_of_each(spark, edges):
    kept = dedup.one_of_each(edges).collect()
    ids = [r.doc_id for r in kept]
    assert ids.count(27) == 0 and ids.count(3) == 1 and ids.count(20) == 1 and ids.count(None) == 2


def test_signatures_are_unbiased():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 3, 400)
    y = x.copy()
    y[rng.integers(0, 400, 12)] = rng.integers(0, 3, 12)
    pair = [" ".join("abc"[i] for i in z) for z in (x, y)]
    bags = [shingles(t) for t in pair]
    exact = sum((bags[0] & bags[1]).values()) / sum((bags[0] | bags[1]).values())
    sets = dedup.multisets(*dedup.shingles(*text_bytes(pa.array(pair))))
    signature = dedup.signatures(*sets, 2, 20_000)
    assert abs((signature[0] == signature[1]).mean() - exact) < 0.015
    assert dedup.overlaps(*sets, 2)[0, 1] == sum((bags[0] & bags[1]).values())


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1200)] + [tuple(map(int, rng.integers(2000, 2300, 2))) for _ in range(150)] + [(5, 5)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = classes_of({x for e in edges if e[0] != e[1] for x in e}, edges)
    by_root = collections.defaultdict(set)
    for r in got:
        by_root[r.root].add(r.id)
    assert sorted(map(sorted, by_root.values())) == sorted(sorted(k for k in want if want[k] == c) for c in set(want.values()))


def vector_rows():
    rng = np.random.default_rng(6)
    rows, base = [], rng.standard_normal(16)
    for i in range(300):
        v = rng.standard_normal(16) if i % 3 else base + rng.standard_normal(16) * 0.3
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 2 if i % 50 else None))
    rows += [(400 + i, rows[3][1], rows[3][2]) for i in range(40)]
    rows += [(500, [2 * x for x in rows[3][1]], rows[3][2]), (501, None, 1), (502, [], 1), (503, [0.0] * 16, 1), (504, [float("nan")] + [1.0] * 15, 1), (505, [float("inf")] + [1.0] * 15, 1)]
    rows += [(506, [None] + [1.0] * 15, 1), (507, [1.0, 2.0], 1), (508, [1.0, 2.0], 1), (509, [3.0], 1), (None, rows[3][1], rows[3][2]), (400, rows[3][1], rows[3][2])]
    return rows


@pytest.mark.parametrize("block", [2048, 32])
def test_vectors(spark, block):
    rows = vector_rows()
    got = vectors.near_vectors(spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, links string"), block=block).collect()
    units = [u if u is not None and r[2] is not None and r[0] is not None else None for u, r in zip(vectors.units([r[1] for r in rows]), rows, strict=True)]
    links, linked = collections.Counter(), []
    for a in range(len(rows)):
        for b in range(a):
            if units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.93:
                linked.append((rows[a][0], rows[b][0]))
                links[a] += 1
                links[b] += 1
    want = classes_of({r[0] for r in rows if r[0] is not None}, linked)
    expected = collections.Counter((r[0], links[k], want.get(r[0]), r[0] is None or want[r[0]] == r[0]) for k, r in enumerate(rows))
    assert collections.Counter(tuple(r) for r in got) == expected
