from pyspark.sql import functions as F

from cratelight.llm import urls

CASES = [
    ("https://WWW.Example.ORG/es/1?x", "www.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/en/12#a", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("http://notexample.org/es/2", "notexample.org", "/es/2", "org/", "allow"),
    ("x://a.com/fr/://b", "a.com", "/fr/://b", "com/fr/", "allow"),
    ("x://a.com/de/", "a.com", "/de/", "com/de/", "block"),
    ("x://org", "org", "", None, "allow"),
    ("x://a.spam-farm.net?q=/fr/", "a.spam-farm.net", "", None, "block"),
    ("x://spam-farmer.net/", "spam-farmer.net", "/", None, "allow"),
    ("x://Ü.net\n/a", "Ü.net\n", "/a", None, "allow"),
    ("no scheme", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"), ("://", "", "", None, "allow"),
]


def test_cases(spark):
    rows = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(CASES)] + [(0, CASES[0][0], "x")], "page_id long, url string, rule string")
    for words in (1, 1 << 20):  # one word a segment: filters too large to send
        got = sorted(tuple(r) for r in urls.judge(rows, most_words=words).collect())
        want = sorted([(i, *c[1:]) for i, c in enumerate(CASES)] + [(0, *CASES[0][1:])], key=lambda r: r[0])
        assert sorted(got, key=str) == sorted(want, key=str)


def test_cascade_is_exact(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("h"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = urls.build_cascade(universe)
    assert 2 <= len(cascade.levels) <= 8
    assert cascade.listed(universe, "key", "said").where("said <> listed").count() == 0
    parts = urls.build_cascade(universe, most_words=100)
    assert not parts.levels[0].whole
    assert parts.listed(universe, "key", "said").where("said <> listed").count() == 0
