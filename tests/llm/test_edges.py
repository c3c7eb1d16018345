"""Every operator and stage over nulls, empty and very long texts, ties, repeated rows, no rows, and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cratelight.llm import dedup, language, mixing, packing, quality, shards, toxicity, urls, vectors, warc


def run(name, docs, labels):
    if name == "packing":
        return packing.pack_documents(docs).where("piece = 0")
    if name == "language":
        return language.predict(docs, language.fit(docs))
    if name == "dedup":
        return dedup.classes(docs)
    if name == "toxicity":
        return toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, labels, 20), ["doc_id"])
    if name == "mixing":
        return mixing.taken_words(mixing.mix(docs, slots=64))
    if name == "shards":
        return shards.shard(docs, 5)
    return quality.judge(docs, labels)


@pytest.mark.parametrize("name", ["packing", "language", "dedup", "toxicity", "mixing", "shards", "quality"])
def test_every_row_has_a_result(name, edges, nothing, tags):
    found = sorted((r.doc_id is None, r.doc_id or 0) for r in run(name, edges, tags).collect())
    assert found == sorted((r.doc_id is None, r.doc_id or 0) for r in edges.collect())
    assert run(name, nothing, tags).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, name, stage, edges, nothing, tags, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("labels"))
    tags.write.parquet(f"{folder}/labels.parquet")
    result = stage(spark, edges, folder)
    if name != "best_fit_packing":
        assert result.columns == edges.columns and result.dtypes == edges.dtypes
    assert result.count() > 0
    assert stage(spark, nothing, folder).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_with_columns_named_as_helpers(spark, name, stage, edges, tags, tmp_path_factory):
    """Columns called as a stage's own helpers come back with their values."""
    folder = str(tmp_path_factory.mktemp("labels"))
    tags.write.parquet(f"{folder}/labels.parquet")
    helpers = ["_times", "_id", "_source", "_copy", "_size", "_slice", "class_id"]
    docs = edges.withColumns({c: F.concat(F.lit(c), F.lit("-"), F.col("doc_id")) for c in helpers})
    result = stage(spark, docs, folder)
    assert result.columns == docs.columns and result.count() > 0
    assert result.where(" OR ".join(f"NOT {c} <=> concat('{c}-', doc_id)" for c in helpers)).count() == 0


def test_empty_tables_of_other_inputs(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge(pages).count() == 0
    assert warc.read_archives(warc.write_archives(pages)).count() == 0
