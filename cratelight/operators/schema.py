"""Shaping feature documents into typed tables, decided from the schema and never from a row."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

# The tag table's columns, and the feature families with their column prefixes.
TAG_COLUMNS = [
    "length", "gain", "codec", "file_name", "bpm", "initialkey", "title", "album", "artist", "date", "genre", "label",
]
FEATURE_FAMILIES = {"tonal_features": "tonal", "lowlevel_features": "lowlevel", "rhythm_features": "rhyt"}


def _leaves(schema: StructType, path: tuple[str, ...] = ()) -> Iterable[tuple[str, ...]]:
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def require_unique(names: list[str]) -> None:
    """ValueError when a name occurs twice."""
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"duplicate columns: {twice}")


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs to flat columns named by their path; arrays stay arrays."""
    paths = list(_leaves(df.schema))
    names = [sep.join(path).replace(".", sep) for path in paths]
    require_unique(names)
    return df.select(*[F.col(".".join(f"`{p}`" for p in path)).alias(name) for path, name in zip(paths, names)])


def list_columns(df: DataFrame) -> list[str]:
    """Names of the array columns."""
    return [field.name for field in df.schema if isinstance(field.dataType, ArrayType)]


def split_lists(df: DataFrame, key: str = "sid") -> tuple[DataFrame, DataFrame]:
    """(scalar columns, list columns), both keyed."""
    lists = list_columns(df)
    return df.drop(*lists), df.select(key, *[c for c in lists if c != key])


def split_by_prefix(df: DataFrame, families: dict[str, str] = FEATURE_FAMILIES, key: str = "sid") -> dict[str, DataFrame]:
    """One frame per family of columns sharing a prefix; families without columns are left out."""
    found = {name: [c for c in df.columns if c != key and c.startswith(prefix)] for name, prefix in families.items()}
    return {name: df.select(key, *columns) for name, columns in found.items() if columns}


def last_part_names(df: DataFrame, key: str = "sid", sep: str = "_") -> DataFrame:
    """Columns renamed to what follows their last ``_``, ``name`` to ``file_name``."""
    names = [c if c == key else c.split(sep)[-1] for c in df.columns]
    names = ["file_name" if c == "name" else c for c in names]
    require_unique(names)
    return df.toDF(*names)


def clean_names(df: DataFrame, strip: str = "@_", replace: dict[str, str] | None = None) -> DataFrame:
    """Columns without leading or trailing marker characters, and with ``.`` as ``_``."""
    names = []
    for name in df.columns:
        name = name.strip(strip)
        for old, new in (replace or {".": "_"}).items():
            name = name.replace(old, new)
        names.append(name)
    require_unique(names)
    return df.toDF(*names)


def conform(df: DataFrame, expected: list[str] = TAG_COLUMNS, key: str = "sid") -> tuple[DataFrame, list[str]]:
    """The expected columns that are present, in their expected order, and the names of the missing ones."""
    present = [c for c in expected if c in df.columns]
    if not present:
        raise ValueError(f"none of the expected columns {expected} in {df.columns}")
    return df.select(key, *present), [c for c in expected if c not in df.columns]


def apply_cells(df: DataFrame, fn: Callable[[Column], Column], key: str = "sid") -> DataFrame:
    """``fn`` on every cell but the key's."""
    return df.select(key, *[fn(F.col(c)).alias(c) for c in df.columns if c != key])


def list_to_columns(df: DataFrame, column: str, key: str = "sid", width: int | None = None) -> DataFrame:
    """A list column as ``<column>_0 .. <column>_n-1``; the width is the longest list unless given."""
    if width is None:
        width = df.agg(F.max(F.size(column))).first()[0] or 0
    return df.select(key, *[F.get(column, F.lit(i)).alias(f"{column}_{i}") for i in range(width)])


def family_map(columns: list[str], sep: str = "___") -> dict[str, list[str]]:
    """Sub-genres per exact genre family of a list of class columns."""
    families: dict[str, list[str]] = {}
    for name in columns:
        head, _, sub = name.partition(sep)
        families.setdefault(head, []).append(sub)
    return families


def family_lists(classes: DataFrame, column: str = "class", sep: str = "___") -> DataFrame:
    """(family, subgenres, n_subgenres): the distinct sub-genres of every family in order; a class without sub-genre adds none.

    Names are made distinct before they are gathered, so a list is as long as its family has sub-genres.
    """
    parts = F.split(F.col(column), sep)
    names = classes.select(F.get(parts, F.lit(0)).alias("family"), F.get(parts, F.lit(1)).alias("subgenre")).where("family IS NOT NULL").distinct()
    lists = names.groupBy("family").agg(F.array_sort(F.collect_list("subgenre")).alias("subgenres"))
    return lists.withColumn("n_subgenres", F.size("subgenres"))


def drop_families(df: DataFrame, families: list[str], key: str = "sid", sep: str = "___") -> DataFrame:
    """Without the class columns of some genre families."""
    return df.select(*[c for c in df.columns if c == key or c.split(sep)[0] not in families])
