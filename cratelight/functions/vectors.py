"""Distances between two array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine_distance(left: Column, right: Column) -> Column:
    """1 - cosine similarity, kept inside [0, 2]; a zero vector is at distance 1 from everything."""
    return cosine_of(dot(left, right), norm(left) * norm(right))


def cosine_of(product: Column, lengths: Column) -> Column:
    """The cosine distance from the scalar product and the product of the lengths."""
    distance = F.greatest(F.lit(0.0), F.least(F.lit(2.0), F.lit(1.0) - product / lengths))
    return F.when(lengths > 0, distance).when(lengths == 0, 1.0)


def euclidean(left: Column, right: Column) -> Column:
    squares = F.zip_with(
        left, right, lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


METRICS = {"cosine": cosine_distance, "euclidean": euclidean}
