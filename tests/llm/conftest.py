import random

import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from cratelight.session import ship_package

    ship_package(spark)


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("size", "score", "kept", "shard", "rest", "digest", "node", "block")],
])
WORDS = "the quick brown fox jumps over a lazy dog while seven wise owls watch from old oak trees near quiet river banks".split()


def text(seed: int, n: int = 60) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "s", "ed", ".", ","]) for _ in range(n))


def edge_rows() -> list[tuple]:
    """Nulls in each column, empty, blank and very long texts, repeated rows, copies, and columns named as operators name theirs."""
    more = ("7", "0.5", "no", "3", "r", "d", "n", "b")
    rows = [(i, text(i), "en" if i % 2 else "fr", f"s{i % 3}", 10) for i in range(20)]
    rows += [(20, None, "en", "s0", None), (21, "", "fr", "s1", 0), (22, " \n\t ", None, None, 3), (23, "one two", "en", None, 7), (None, text(1), "en", "s1", 5), (None, None, None, None, None)]
    rows += [(24, text(5, 40_000), "en", "s2", 1), (25, "x" * 300_000, "en", "s2", 1), (26, text(3), "en", "s0", 1), (27, text(3), "en", "s0", 1), (27, text(3), "en", "s0", 1)]
    rows += [(28, "… ¿? ￥ \u0301 \U0001f600 ñandú Ωμέγα", "es", "é", 1), (29, "*** $$$ %%% ||| " * 30, "en", "s1", 1)]
    return [r + more for r in rows]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tags(spark):
    """Labels of the edge documents, with nulls and an id that no document has."""
    rows = [(i, i % 2, int(i % 4 == 0)) for i in range(20)] + [(None, 1, 1), (23, None, None), (99, 1, 0), (3, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
