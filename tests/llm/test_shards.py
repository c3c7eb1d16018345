import zlib

from cratelight.llm import shards


def jump(key: int, n: int) -> int:
    """The published loop, in Python's integers."""
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    keys = [*range(-50, 300), 2**63 - 1, -(2**63), 10**12]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 40):
        assert [r[1] for r in df.select("k", shards.jump_hash(df.k, n)).collect()] == [jump(k, n) for k in keys]


def test_slots_are_gapless_in_any_slicing(spark, edges):
    for per_slice in (3, 10_000):
        rows = shards.shard(edges, 4, rows_per_slice=per_slice).collect()
        for s in {r.shard for r in rows}:
            own = sorted(r.slot for r in rows if r.shard == s)
            assert own == list(range(len(own)))
        assert all(r.grown_shard in (r.shard, 4) for r in rows)
    texts = {r.doc_id: r.text or "" for r in edges.collect()}
    for r in rows:
        if r.doc_id is not None:
            assert (r.size, r.text_crc32) == (len(texts[r.doc_id].encode()) + 1, zlib.crc32(texts[r.doc_id].encode()))


def test_files(spark, edges, tmp_path):
    shards.write_shards(edges.drop("shard"), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == edges.count() and {r[0] for r in back.select("shard").distinct().collect()} <= set(range(4))
