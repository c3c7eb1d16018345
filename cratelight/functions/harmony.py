"""Musical keys: Camelot codes and harmonic compatibility."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key + scale to Camelot code. Bbmajor shares 3A with Bbminor and 6B is unused, as published.
CAMELOT = {
    "Abmajor": "4B", "Abminor": "1A",
    "Amajor": "11B", "Aminor": "8A",
    "Bbmajor": "3A", "Bbminor": "3A",
    "Bmajor": "1B", "Bminor": "10A",
    "Cmajor": "8B", "Cminor": "5A",
    "C#major": "3B", "C#minor": "12A",
    "Dmajor": "10B", "Dminor": "7A",
    "Ebmajor": "5B", "Ebminor": "2A",
    "Emajor": "12B", "Eminor": "9A",
    "Fmajor": "7B", "Fminor": "4A",
    "F#major": "2B", "F#minor": "11A",
    "Gmajor": "9B", "Gminor": "6A",
}
WHEEL = [f"{number}{letter}" for letter in "AB" for number in range(1, 13)]


def camelot(key: Column, scale: Column) -> Column:
    """Camelot code of a key such as ``G`` with a scale such as ``minor``; NULL when unknown."""
    table = ", ".join(f"'{name}', '{code}'" for name, code in CAMELOT.items())
    return F.try_element_at(F.expr(f"map({table})"), F.concat(key, scale))


def key_distance(left: Column, right: Column) -> Column:
    """Steps between two Camelot codes: number gap (11 wraps to 1) plus one for a change of letter."""

    def number(key: Column) -> Column:
        return F.regexp_extract(key, "^([0-9]+)", 1).try_cast("int")

    gap = F.abs(number(left) - number(right))
    letter = (F.right(left, F.lit(1)) != F.right(right, F.lit(1))).cast("int")
    return F.when(gap == 11, 1).otherwise(gap) + letter


def keys_match(left: Column, right: Column, thresh: int = 2) -> Column:
    """Whether two Camelot codes are closer than ``thresh`` steps; NULL when either key is missing."""
    return key_distance(left, right) < thresh


def _steps(left: str, right: str) -> int:
    gap = abs(int(left[:-1]) - int(right[:-1]))
    return (1 if gap == 11 else gap) + (left[-1] != right[-1])


def compatible_keys(key: Column, thresh: int = 2) -> Column:
    """All Camelot codes that match ``key``, as an array; NULL for a missing or unknown key."""
    rows = []
    for code in WHEEL:
        matches = ", ".join(f"'{other}'" for other in WHEEL if _steps(code, other) < thresh)
        rows.append(f"'{code}', array({matches})")
    return F.try_element_at(F.expr(f"map({', '.join(rows)})"), key)
