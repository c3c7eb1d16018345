import re

from pyspark.sql import functions as F

from cratelight.llm import mixing


def level(sizes: dict, total: int) -> dict:
    """Targets by the contract's own words: share, stop at three times the size, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, full, left = dict.fromkeys(names, 0.0), set(), float(total)
    while left > 1e-9 and len(full) < len(names):
        share = sum(weight[s] for s in names if s not in full)
        for s in names:
            if s not in full:
                target[s] += left * weight[s] / share
        left = 0.0
        for s in names:
            if s not in full and target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                full.add(s)
    return target


def test_targets_and_taken_words(spark, edges):
    rows = mixing.taken_words(mixing.mix(edges, slots=1 << 14, rows_per_slice=4)).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes: dict = {}
    for r in edges.collect():
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    want = level(sizes, sum(sizes.values()))
    taken: dict = {}
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 40 * max(1, -(-sum(sizes.values()) // (1 << 14)))


def test_slots_cover_the_blocks_they_take(spark, edges):
    mixed = mixing.mix(edges, slots=128)
    slots = [s for r in mixed.select("source", "first", "last", "at", F.explode("slots").alias("slot")).collect() for s in [r.slot]]
    assert slots and min(slots) >= 0
    again = mixing.mix(edges, slots=128)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, again.collect()))
