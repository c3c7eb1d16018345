"""Two-dimensional maps and clusters of songs."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Projection:
    """A fitted two-component PCA: centred, each axis turned so that its largest loading is positive."""

    def __init__(self, model: PCAModel, mean: np.ndarray):
        loadings = model.pc.toArray()
        largest = np.abs(loadings).argmax(axis=0)
        self.signs = np.sign(loadings[largest, np.arange(loadings.shape[1])])
        self.shift = (mean @ loadings) * self.signs
        self.model = model
        self.mean = mean
        self.explained = model.explainedVariance.toArray()

    def apply(self, vectors: DataFrame) -> DataFrame:
        """(sid, component1, component2, ...) of every song."""
        axes = self.model.transform(vectors.select("sid", array_to_vector("embedding").alias("_in")))
        values = vector_to_array("_out")
        return axes.select(
            "sid",
            *[
                (values[i] * float(sign) - float(shift)).alias(f"component{i + 1}")
                for i, (sign, shift) in enumerate(zip(self.signs, self.shift))
            ],
        )


    def save(self, folder: str) -> None:
        """Writes the model and the mean below ``folder``, a path all executors can reach; an earlier one is replaced."""
        spark = SparkSession.active()
        self.model.write().overwrite().save(f"{folder}/model")
        mean = spark.createDataFrame([(self.mean.tolist(),)], "mean array<double>")
        mean.coalesce(1).write.mode("overwrite").parquet(f"{folder}/mean")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Projection:
        """The projection that ``save`` wrote, in any later session; axes are turned as they were."""
        mean = spark.read.parquet(f"{folder}/mean").first()["mean"]
        return cls(PCAModel.load(f"{folder}/model"), np.array(mean))


def fit_projection(vectors: DataFrame, components: int = 2) -> Projection:
    """Fits the projection; only the width x width covariance reaches the driver."""
    from pyspark.ml.stat import Summarizer

    rows = vectors.select(array_to_vector("embedding").alias("_in"))
    model = PCA(k=components, inputCol="_in", outputCol="_out").fit(rows)
    mean = rows.agg(Summarizer.mean(F.col("_in")).alias("m")).first()["m"].toArray()
    return Projection(model, mean)


def song_map(projection: Projection, vectors: DataFrame, tags: DataFrame) -> DataFrame:
    """Components with bpm, key, title and artist of every song that has both."""
    return projection.apply(vectors).join(tags.select("sid", "bpm", "initialkey", "title", "artist"), "sid")


def clusters(vectors: DataFrame, k: int, seed: int = 1) -> tuple[DataFrame, float]:
    """(sid, cluster) and the silhouette of the clustering."""
    rows = vectors.select("sid", array_to_vector("embedding").alias("features"))
    placed = KMeans(k=k, seed=seed, initMode="k-means||").fit(rows).transform(rows)
    quality = ClusteringEvaluator().evaluate(placed)
    return placed.select("sid", F.col("prediction").alias("cluster")), quality


def labelled_vectors(vectors: DataFrame, labels: DataFrame, tags: DataFrame, how: str = "inner") -> DataFrame:
    """Embedding, dominant genre, title and artist per song, for an external map."""
    return vectors.join(labels, "sid", how).join(tags.select("sid", "title", "artist"), "sid", how)
