"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelight.llm import dedup, mixing, packing, quality, toxicity
from cratelight.llm.common import discard, stored, table
from cratelight.session import ship_package


def _boxed(docs: DataFrame) -> DataFrame:
    """``text``, ``doc_id`` and all columns as one, so that no column can clash with what an operator adds."""
    return docs.select("text", "doc_id", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest"))


def _unboxed(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the network, trained on the labelled ones among them, does not predict to be toxic. Null and empty
    texts stay; without labels of both classes all do."""
    ship_package(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    net = toxicity.fit(docs, labels)
    return _unboxed(toxicity.score(_boxed(docs), net, ["text", "rest"]).where("predicted = 0"), docs)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the base rules and whose n-grams look like those of documents labelled as good. Null and blank
    texts fail the base rules."""
    ship_package(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return _unboxed(quality.judge(_boxed(docs), labels, ("text", "rest")).where("kept"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id; documents without words or id stay."""
    ship_package(spark)
    return dedup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as the mix takes its words, rounded: at most one document of a source differs from the mix.

    Rows that repeat an id and source are taken equally often. Documents without words are in no mix. One row per document
    comes back to the texts, so that table grows with the corpus and is joined by a shuffle at every size.
    """
    ship_package(spark)
    taken = mixing.taken_words(mixing.mix(docs.select("doc_id", "source", "text"))).where("size > 0").groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"))
    times = stored(taken.agg(F.round(F.sum("taken") / F.sum("size")).cast("int").alias("_times")).where("_times > 0"), "times")
    boxed = _boxed(docs).where(mixing.word_count(F.col("text")) > 0)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("rest").getField("source").eqNullSafe(F.col("_source"))
    copies = boxed.join(times.hint("shuffle_merge"), same).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return _unboxed(copies, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 2048 ids."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", keep_good),
    ("minhash_near_duplicates", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: The stages learn a network, hash and search, which SQL cannot express; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        result = stored(stage(spark, docs, sf_dir), name)
        if number:
            discard(docs)
        docs = result
    return docs
