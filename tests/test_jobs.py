"""Jobs that append: history read by parts, scores written once."""

import pytest
from pyspark.sql import functions as F

from cratelight.operators import scoring
from cratelight.streaming import ingest


def test_history_is_neither_shuffled_nor_read_whole(spark, tmp_path):
    table = str(tmp_path / "files")
    rows = spark.range(400).select(F.md5(F.col("id").cast("string")).alias("sid"), F.col("id").cast("string").alias("file_path"))
    ingest.store_batch(rows, ingest.batch_folder(table, "s", 0))
    batch = rows.where("file_path IN ('3', '5')").unionByName(spark.createDataFrame([("new", "x"), (None, "y")], "sid string, file_path string"))
    assert {r.sid for r in ingest.known_of(batch, table, "s", 1).collect()} == {r.sid for r in rows.where("file_path IN ('3', '5')").collect()}
    assert ingest.known_of(batch, table, "s", 0).count() == 0  # a repeated batch does not know itself
    history = ingest.known_before(spark, table, "sid string, part int", "s", 1)
    ids = spark.createDataFrame([("new",)], "sid string")
    plan = ingest.history_hits(history, ids, [3, 9])._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    assert "part#" in lines[scan] and "IN (3,9)" in lines[scan].replace("in (3,9)", "IN (3,9)")
    assert not any("Exchange hashpartitioning" in line or "Exchange SinglePartition" in line for line in lines)


def test_large_batches_meet_the_whole_history(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "MOST_IDS", 5)
    table = str(tmp_path / "files")
    rows = spark.range(40).select(F.md5(F.col("id").cast("string")).alias("sid"), F.lit("p").alias("file_path"))
    ingest.store_batch(rows.limit(30), ingest.batch_folder(table, "s", 0))
    known = ingest.known_of(rows, table, "s", 1)
    assert rows.join(known, "sid", "left_anti").count() == 10


def test_songs_are_scored_once(spark, tmp_path):
    def total(file):
        with open(file) as text:
            factor = float(text.read())

        def model(segments):
            if (segments < 0).any():
                raise ValueError("negative")
            return factor * segments.sum(axis=1, keepdims=True)

        return model

    def broken(file):
        raise RuntimeError("no such model")

    root = str(tmp_path)
    model, classes = scoring.store_file(spark, "2", "model"), scoring.store_file(spark, "loud\n", "classes")
    schema = "sid long, segments array<array<double>>, job string, error string"
    rows = [(1, [[1.0, 2.0], [3.0, 4.0]], "x", None), (1, [[9.0, 9.0]], "x", None), (2, [[-1.0, 0.0]], None, "e"), (3, [], None, None), (4, None, None, None), (None, [[1.0, 1.0]], None, None)]

    def run(some, job):
        stored = scoring.score_job(spark.createDataFrame(some, schema), model, classes, total, root, "heads", job)
        return {(r.job, r.sid): r.loud for r in stored.collect()}

    first = {("a", 1): [6.0, 14.0], ("a", 3): [], ("a", 4): None}
    assert run(rows, "a") == first
    assert [r.sid for r in spark.read.parquet(f"{root}/heads_rejects").collect()] == [2]
    mended = [(1, [[5.0, 5.0]], None, None), (2, [[1.0, 0.0]], None, None), (5, [[0.0, 0.5]], None, None)]
    both = first | {("b", 2): [2.0], ("b", 5): [1.0]}
    assert run(mended, "b") == both
    assert run(mended, "b") == both  # repeated: replaces itself
    assert run([], "c") == both
    with pytest.raises(Exception, match="no such model"):
        scoring.score_job(spark.createDataFrame(rows, schema), scoring.store_file(spark, "no", "broken"), classes, broken, root, "heads", "d").collect()
    assert run([(6, [[1.0, 1.0]], None, None)], "d") == both | {("d", 6): [4.0]}  # the failed job left nothing behind
