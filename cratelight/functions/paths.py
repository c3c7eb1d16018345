"""File paths of two sources made comparable."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def strip_file_url(url: Column) -> Column:
    """``file://localhost/a/b`` -> ``/a/b``."""
    return F.regexp_replace(url, "^file://localhost/?", "/")


def percent_decode(text: Column) -> Column:
    """Percent-decoding that leaves ``+`` and any ``%`` that no two hex digits follow alone."""
    kept = F.regexp_replace(F.replace(text, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(kept)


@F.pandas_udf(StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(
        lambda value: value if value is None or value.isascii() else unicodedata.normalize("NFKC", value)
    )


# declared non-deterministic so that a null check inferred for a join does not evaluate it a second time
_nfkc_once = _nfkc.asNondeterministic()


def nfkc(text: Column | str) -> Column:
    """Unicode NFKC form; Spark has no built-in for it. ASCII values are already normal and pass untouched."""
    return _nfkc_once(text)


def export_path(location: Column) -> Column:
    """Join key of a track location in the library export."""
    return nfkc(percent_decode(strip_file_url(location)))
