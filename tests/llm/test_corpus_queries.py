"""The registered corpus queries: those with SQL against it, the pipeline against its stages done plainly."""

import pytest
from compare import connect, difference

import __spark_entry__ as contract
import corpus_pipeline
from cratelight.llm.common import table
from cratelight.llm.queries import QUERIES, SQL
from cratelight.plans.registry import Query


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, folder, name):
    assert difference(spark, connect(folder), name, Query(QUERIES[name], SQL[name], ""), folder) is None


def test_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(SQL) <= set(QUERIES) and [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"


def test_pipeline(spark, folder):
    """Every stage removes what its operator's query says of the stage's input, and run() is the stages one after the other."""
    from cratelight.llm import dedup, mixing, quality, toxicity
    from cratelight.llm.common import stored

    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    stages = dict(corpus_pipeline.STAGES)
    clean = stored(stages["toxicity"](spark, docs, folder), "t")
    said = toxicity.score(docs, toxicity.fit(docs, labels), ["doc_id"])
    assert ids(clean) == ids(said.where("predicted = 0")) and clean.join(docs, docs.columns).count() == clean.count()
    good = stored(stages["quality_rules"](spark, clean, folder), "q")
    assert ids(good) == ids(quality.judge(clean, labels).where("kept"))
    single = stored(stages["minhash_near_duplicates"](spark, good, folder), "d")
    assert ids(single) == ids(dedup.classes(good).where("kept"))
    mixed = stored(stages["source_mixing"](spark, single, folder), "m")
    want = [r.doc_id for r in mixing.taken_words(mixing.mix(single)).collect() for _ in range(round(r.taken / r.size))]
    assert ids(mixed) == sorted(want)
    packed = stages["best_fit_packing"](spark, mixed, folder)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    run = corpus_pipeline.run(spark, folder)
    assert sorted(run.select(columns).collect()) == sorted(packed.select(columns).collect())
