"""Column functions on literal values."""

import math

import pytest
from pyspark.sql import functions as F

from cratelight.functions import arrays, harmony, labels, paths, tags, vectors


@pytest.mark.parametrize("label, words", [
    ("60", "sixty"), ("73", "seventy-three"), ("80s", "eighties"), ("90s", "nineties"),
    ("7", "seven"), ("11", "eleven"), ("disco", "disco"), ("80s pop", "80s pop"), ("173", "one hundred and seventy-three"), ("1204", "one thousand, two hundred and four"), ("2000045s", "two million and forty-fives"), ("0", "zero"), ("100s", "one hundreds"), ("1100", "one thousand, one hundred"), ("007", "seven"), ("9" * 19, "9" * 19), ("21s", "twenty-ones"), ("6s", "sixes"),
])
def test_number_words(cell, label, words):
    assert cell(labels.number_words(F.lit(label))) == words
    assert labels.number_word(label) == words


@pytest.mark.parametrize("values, expected", [
    (["Kiki Gyan"], "Kiki Gyan"), (["a", "b"], "b"), (["b", "a", "b"], "b"), (["a", "b", "c"], None), ([110, 110], 110),
])
def test_collapse_tag(cell, values, expected):
    assert cell(tags.collapse_tag(F.array(*map(F.lit, values)))) == expected


def test_collapse_tag_passes_scalars_and_empties(spark, cell):
    from pyspark.sql.types import StringType

    assert cell(tags.collapse_tag(F.lit("disco"), StringType())) == "disco"
    assert cell(tags.collapse_tag(F.array().cast("array<string>"))) is None
    assert cell(tags.collapse_tag(F.lit(None).cast("array<string>"))) is None


@pytest.mark.parametrize("left, right, thresh, expected", [
    ("6A", "7A", 2, True), ("5A", "5B", 2, True), ("12A", "1A", 2, True), ("4A", "6A", 2, False), ("2A", "8B", 2, False),
    ("9A", "4A", 2, False), ("12A", "2A", 2, False), ("12A", "1B", 2, False), ("12A", "2A", 11, True), ("12A", "2A", 10, False),
])
def test_keys_match(cell, left, right, thresh, expected):
    assert cell(harmony.keys_match(F.lit(left), F.lit(right), thresh)) is expected
    assert (right in cell(harmony.compatible_keys(F.lit(left), thresh))) is expected


def test_missing_key_matches_nothing(cell):
    nothing = F.lit(None).cast("string")
    assert cell(harmony.keys_match(nothing, F.lit("1A"))) is None
    assert cell(harmony.compatible_keys(nothing)) is None
    assert cell(harmony.compatible_keys(F.lit("13C"))) is None


@pytest.mark.parametrize("key, scale, code", [
    ("G", "minor", "6A"), ("A", "minor", "8A"), ("A", "major", "11B"), ("Bb", "major", "3A"), ("H", "minor", None),
])
def test_camelot(cell, key, scale, code):
    assert cell(harmony.camelot(F.lit(key), F.lit(scale))) == code


def test_camelot_is_whole():
    assert len(harmony.CAMELOT) == 24 and set(harmony.CAMELOT.values()) == set(harmony.WHEEL) - {"6B"}


def test_labels(cell):
    assert cell(labels.slug(F.lit("Folk, World, & Country---Zouk"))) == "folk_world__country___zouk"
    assert cell(labels.slug(F.lit("Rock---Rock & Roll/R'n'B"))) == "rock___rock__rollrnb"
    assert cell(labels.display_label(F.lit("electronic___deep_house"))) == "Electronic Deep House"
    assert cell(labels.song_label(F.lit("T"), F.lit(None).cast("string"))) == "T -- "
    assert cell(labels.family(F.lit("funk__soul___disco"))) == "funk__soul"
    assert cell(labels.subgenre(F.lit("funk__soul___disco"))) == "disco"
    assert labels.classifier_columns(["not danceable", "80s", "60"]) == ["not_danceable", "eighties", "sixty"]
    assert labels.classifier_table("models/mood-happy-1.onnx") == "mood_happy_1_activations"
    assert labels.classifier_table("x/moon.onnx") == "moon_activations"


@pytest.mark.parametrize("url, path", [
    ("file://localhost/home/me/x%20y.wav", "/home/me/x y.wav"),
    ("file://localhost/Volumes/LaCie/a+b%2Bc.wav", "/Volumes/LaCie/a+b+c.wav"),
    ("file://localhost/host/file.wav", "/host/file.wav"),
    ("file://localhost/Caf%C3%A9.wav", "/Café.wav"),
    ("file://localhost/Cafe%CC%81 ﬁ.wav", "/Café fi.wav"),
])
def test_export_path(spark, url, path):
    assert spark.createDataFrame([(url,)], "u string").select(paths.export_path(F.col("u")).alias("p")).first()["p"] == path


def test_nfkc_keeps_null(spark):
    assert [r[0] for r in spark.createDataFrame([(None,), ("x",)], "u string").select(paths.nfkc("u")).collect()] == [None, "x"]


@pytest.mark.parametrize("stem, expected", [
    ("02 Kiki Gyan_ Sexy Dancer (Combo Edit)_PN", ("Kiki Gyan", "Sexy Dancer", "Combo Edit", None)),
    ("Parisian Soul - XPRESS Edits Vol.4 - 01 Love You Madly (Parisian Soul Re-Edit)_PN",
     ("Parisian Soul", "Love You Madly", "Parisian Soul Re-Edit", "XPRESS Edits Vol.4")),
    ("1-4_M_International_-_Space_Operator_(Donato_Dozzy_Cadillac_Rhythms_Reshape)_PN",
     ("4 M International", "Space Operator", "Donato Dozzy Cadillac Rhythms Reshape", None)),
    ("Let's Go", (None, "Let's Go", None, None)),
    ("80s Hits - Song", ("80s Hits", "Song", None, None)),
])
def test_path_metadata(spark, stem, expected):
    row = spark.createDataFrame([(stem,)], "s string").select(tags.path_metadata(F.col("s")).alias("m")).select("m.*").first()
    assert (row.artist, row.title, row.remixer, row.album) == expected


def test_arrays(spark):
    row = spark.createDataFrame([([1.0, 2.0, 4.0], [], [[1.0, 2.0], [3.0, 6.0]])], "a array<float>, e array<float>, m array<array<float>>").select(
        arrays.mean_of(F.col("a")).alias("mean"), arrays.std_of(F.col("a")).alias("std"), arrays.mean_of(F.col("e")).alias("none"),
        arrays.top_mean(F.col("a"), 2).alias("top"), arrays.top_mean(F.col("a"), 9).alias("all"),
        arrays.pair_mean(F.col("a"), F.col("a")).alias("pair"), arrays.column_means(F.col("m")).alias("cols"),
        arrays.matrix_column(F.col("m"), 1).alias("col1"), arrays.log_compress(F.lit(0.0099)).alias("log"),
    ).first()
    assert row["mean"] == pytest.approx(7 / 3) and row["std"] == pytest.approx(math.sqrt(14) / 3) and row["none"] is None
    assert row["top"] == 3.0 and row["all"] == pytest.approx(7 / 3) and row["pair"] == pytest.approx(14 / 3)
    assert row["cols"] == [2.0, 4.0] and row["col1"] == [2.0, 6.0] and row["log"] == pytest.approx(2.0)


def test_vectors(cell):
    a, b, zero = (F.array(*map(F.lit, v)) for v in ([3.0, 4.0], [4.0, 3.0], [0.0, 0.0]))
    assert cell(vectors.euclidean(a, b)) == pytest.approx(math.sqrt(2))
    assert cell(vectors.cosine_distance(a, b)) == pytest.approx(1 - 24 / 25)
    assert cell(vectors.cosine_distance(a, a)) == 0.0
    assert cell(vectors.cosine_distance(a, zero)) == 1.0
