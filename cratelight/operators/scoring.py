"""Class scores from embeddings, and scaling of scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelight.functions.arrays import matrix_column, mean_of
from cratelight.functions.vectors import dot
from cratelight.operators.align import only_known, only_new_groups
from cratelight.session import scratch_path, written
from cratelight.sources.tables import read_or_empty

Predict = Callable[[np.ndarray], np.ndarray]


def score(
    df: DataFrame, load_model: Callable[[], Predict], classes: list[str], key: str = "sid", vector: str = "embedding",
    new_ids: DataFrame | None = None,
) -> DataFrame:
    """Scores vectors with a user's model, one double column per class plus ``error``.

    ``load_model`` runs once per partition and returns a function from a (rows, width) array to a (rows, classes)
    array. A batch the model rejects is halved until
    it passes or is one row, and rows it still rejects carry the message in ``error``.
    """
    if new_ids is not None:
        df = only_known(df, new_ids, key)
    schema = f"{key} {dict(df.dtypes)[key]}, " + "".join(f"`{c}` double, " for c in classes) + "error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load_model()

        def attempt(part: pd.DataFrame) -> pd.DataFrame:
            try:
                scores = np.asarray(predict(np.stack(part[vector].to_list()).astype(np.float32)), dtype=np.float64)
                out, error = pd.DataFrame(scores, columns=classes), None
            except Exception as problem:
                if len(part) > 1:
                    half = len(part) // 2
                    return pd.concat([attempt(part.iloc[:half]), attempt(part.iloc[half:])], ignore_index=True)
                out, error = pd.DataFrame([[np.nan] * len(classes)], columns=classes), f"{type(problem).__name__}: {problem}"
            out.insert(0, key, part[key].to_numpy())
            return out.assign(error=error)

        for batch in batches:
            if len(batch):
                yield attempt(batch)

    return df.select(key, vector).mapInPandas(run, schema)


def score_segments(
    df: DataFrame, load_model: Callable[[], Predict], classes: list[str], key: str = "sid", matrix: str = "segments", batch_rows: int = 4096,
) -> DataFrame:
    """Scores every segment of every song: one array column per class, in the order of the segments, plus ``error``.

    ``matrix`` is an array of segment vectors. The segments of a batch of songs go to the model together, at most about
    ``batch_rows`` in a call; if the model rejects them the songs are halved, and a song it still rejects carries the message. A song
    without segments has empty arrays, a song whose matrix is NULL has NULLs.
    """
    schema = f"{key} {dict(df.dtypes)[key]}, " + "".join(f"`{c}` array<double>, " for c in classes) + "error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load_model()

        def attempt(ids: list, songs: list) -> list[tuple]:
            try:
                counts = [len(song) for song in songs]
                flat = [np.asarray(v, np.float32) for song in songs for v in song]
                scores = np.asarray(predict(np.stack(flat)), np.float64) if flat else np.zeros((0, len(classes)))
                if scores.shape != (len(flat), len(classes)):
                    raise ValueError(f"the model gave {scores.shape} for {len(flat)} segments")
                ends = np.cumsum(counts)
                return [(i, *[scores[e - c : e, k].tolist() for k in range(len(classes))], None) for i, c, e in zip(ids, counts, ends)]
            except Exception as problem:
                if len(ids) == 1:
                    return [(ids[0], *[None] * len(classes), f"{type(problem).__name__}: {problem}")]
                half = len(ids) // 2
                return attempt(ids[:half], songs[:half]) + attempt(ids[half:], songs[half:])

        for batch in batches:
            rows, ids, songs, size = [], [], [], 0
            for i, song in zip(batch[key].tolist(), batch[matrix].tolist()):
                if song is None:
                    rows.append((i, *[None] * len(classes), None))
                    continue
                ids.append(i)
                songs.append(song)
                size += len(song)
                if size >= batch_rows:
                    rows += attempt(ids, songs)
                    ids, songs, size = [], [], 0
            if ids:
                rows += attempt(ids, songs)
            yield pd.DataFrame(rows, columns=[key, *classes, "error"])

    return df.select(key, matrix).mapInPandas(run, schema)


_LOADED: dict[str, Predict] = {}  # models of this worker process, by file


def _loaded(load_model: Callable[[str], Predict], file: str) -> Predict:
    """A shipped model; at module level, so that workers share the table of their process."""
    if file not in _LOADED:
        _LOADED[file] = load_model(SparkFiles.get(file))
    return _LOADED[file]


def store_file(spark: SparkSession, text: str, name: str) -> str:
    """Writes a text as one file in the shared folder and returns its path, as ``score_job`` takes it."""
    folder = scratch_path(spark, name)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(folder)
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path").first()["path"]


def score_job(
    songs: DataFrame, model_file: str, classes_file: str, load_model: Callable[[str], Predict], root: str, name: str, job: str,
    key: str = "sid", matrix: str = "segments",
) -> DataFrame:
    """Scores the segments of songs not scored yet and appends them to ``<root>/<name>_activations``; returns that table.

    Model and class list (one class a line) are files; they are shipped to the workers, and ``load_model`` gets the model's local path
    once per worker process. Every job owns the folder ``job=<job>`` and writes it with overwrite, so a job that is repeated replaces
    itself, and what all other jobs wrote is left out. Songs the model rejects go to ``<root>/<name>_rejects`` and are tried
    again by the next job. Of rows with one id the smallest matrix counts; rows without id are left out.
    """
    spark = songs.sparkSession
    classes = [line for line in spark.read.text(classes_file, wholetext=True).first()["value"].split("\n") if line]
    spark.sparkContext.addFile(model_file)
    file = model_file.rsplit("/", 1)[-1]

    id_type = dict(songs.dtypes)[key]
    columns = ", ".join([f"{key} {id_type}", *[f"`{c}` array<double>" for c in classes]])
    table = f"{root}/{name}_activations"
    known = read_or_empty(spark, table, f"{columns}, job string").where(F.col("job") != job)
    single = songs.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(matrix).alias(matrix), F.count("*").alias("_copies"))
    scored = written(score_segments(only_new_groups(single, known, "_copies", key), lambda: _loaded(load_model, file), classes, key, matrix), "scored")
    good, bad = split_errors(scored)
    bad.select(key, "error").write.mode("overwrite").parquet(f"{root}/{name}_rejects/job={job}")
    good.write.mode("overwrite").parquet(f"{table}/job={job}")
    return spark.read.schema(f"{columns}, job string").parquet(table)


def split_errors(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of a scored frame."""
    return scored.where("error IS NULL").drop("error"), scored.where("error IS NOT NULL")


def linear_head(vector: Column, weights: Column) -> Column:
    """Logistic scores of a linear head, one per row of ``weights`` (array of arrays), inside the JVM."""
    return F.transform(weights, lambda w: F.lit(1.0) / (F.lit(1.0) + F.exp(-dot(vector, w))))


def class_arrays(df: DataFrame, matrix: str, classes: list[str], keep: list[str], key: str = "sid") -> DataFrame:
    """A segments x classes matrix per song as one score array per kept class."""
    return df.select(key, *[matrix_column(F.col(matrix), classes.index(c)).alias(c) for c in keep])


def class_means(arrays: DataFrame, key: str = "sid") -> DataFrame:
    """The mean of every score array."""
    return arrays.select(key, *[mean_of(F.col(c)).alias(c) for c in arrays.columns if c != key])


def value_range(df: DataFrame, columns: list[str]) -> DataFrame:
    """Two rows, the smallest and the largest value of each column: a fitted scaler that can be stored as a table and later
    stand for ``df`` as ``fitted`` of ``minmax_scale``."""
    ends = df.agg(*[F.array(F.min(c), F.max(c)).alias(c) for c in columns])
    return ends.select(F.explode(F.arrays_zip(*columns)).alias("end")).select(*[F.col("end").getField(c).alias(c) for c in columns])


def minmax_scale(df: DataFrame, columns: list[str], fitted: DataFrame | None = None) -> DataFrame:
    """Columns scaled to [0, 1] by the range in ``fitted`` (default: the frame itself), as ``<column>_scaled``.

    A constant column scales to 0, as a min-max scaler does.
    """
    source = df if fitted is None else fitted
    ranges = source.agg(F.struct(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).alias("r")).scalar()

    def scaled(c: str) -> Column:
        low, high = F.col("_ranges").getField(f"lo_{c}"), F.col("_ranges").getField(f"hi_{c}")
        return (F.col(c) - low) / F.when(high > low, high - low).otherwise(1.0)

    return df.withColumn("_ranges", ranges).withColumns({f"{c}_scaled": scaled(c) for c in columns}).drop("_ranges")
