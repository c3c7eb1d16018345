"""Names and labels: slugs, number words, display labels, genre families, classifier names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English number words.
UNITS = [
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine",
    "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen",
]
TENS = ["", "", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety"]
# Plurals that do not just add an s.
IRREGULAR_PLURALS = {"six": "sixes"}

# Characters a class-name slug turns into "_" and characters it drops.
SLUG_TO_UNDERSCORE = "- "
SLUG_DROPPED = "&',/"


def slug(label: Column) -> Column:
    """Class label to column name: ``Folk, World, & Country---Zouk`` -> ``folk_world__country___zouk``."""
    return F.lower(
        F.translate(label, SLUG_TO_UNDERSCORE + SLUG_DROPPED, "_" * len(SLUG_TO_UNDERSCORE))
    )


SCALES = ["", " thousand", " million", " billion", " trillion", " quadrillion"]
MOST_DIGITS = 3 * len(SCALES)


def _below_1000(n: int) -> str:
    """Words of 0 to 999, nothing for 0."""
    hundreds, rest = divmod(n, 100)
    if rest < 20:
        tail = UNITS[rest] if rest else ""
    else:
        tail = TENS[rest // 10] + (f"-{UNITS[rest % 10]}" if rest % 10 else "")
    return " and ".join(part for part in (f"{UNITS[hundreds]} hundred" if hundreds else "", tail) if part)


def _plural(words: str) -> str:
    cut = max(words.rfind("-"), words.rfind(" ")) + 1
    last = words[cut:]
    return words[:cut] + (last[:-1] + "ies" if last.endswith("y") else IRREGULAR_PLURALS.get(last, last + "s"))


def number_words(label: Column) -> Column:
    """Labels that are a whole number, or one with a plural s, as words; every other label unchanged.

    ``73`` -> ``seventy-three``, ``80s`` -> ``eighties``, ``1204`` -> ``one thousand, two hundred and four``, ``disco`` -> ``disco``.
    Groups of three digits are looked up and joined by commas, a last group below 100 by ``and``. Numbers of more than
    ``MOST_DIGITS`` digits have no name here and stay as they are.
    """
    small = F.expr("array(" + ", ".join(f"'{_below_1000(n)}'" for n in range(1000)) + ")")
    scales = F.array(*map(F.lit, reversed(SCALES)))
    digits = F.lpad(F.regexp_extract(label, f"^([0-9]{{1,{MOST_DIGITS}}})s?$", 1), MOST_DIGITS, "0")
    groups = F.transform(F.sequence(F.lit(0), F.lit(len(SCALES) - 1)), lambda i: F.substr(digits, 1 + 3 * i, F.lit(3)).try_cast("int"))
    named = F.transform(groups, lambda g, i: F.when(g > 0, F.concat(F.element_at(small, g + 1), F.element_at(scales, i + 1))))

    def joined(parts: Column) -> Column:
        head = F.concat_ws(", ", F.slice(parts, 1, len(SCALES) - 1))
        last = F.element_at(parts, -1)
        joint = F.when((head == "") | last.isNull(), "").when(last.contains("hundred"), ", ").otherwise(" and ")
        return F.concat(head, joint, F.coalesce(last, F.lit("")))

    def plural(words: Column) -> Column:
        irregular = [F.when(words.rlike(f"(^|[- ]){one}$"), F.regexp_replace(words, f"{one}$", many)) for one, many in IRREGULAR_PLURALS.items()]
        return F.coalesce(*irregular, F.when(words.endswith("y"), F.regexp_replace(words, "y$", "ies")), F.concat(words, F.lit("s")))

    # one-element arrays, so that each step is evaluated once
    words = F.transform(F.transform(F.array(named), joined), lambda w: F.when(w == "", UNITS[0]).otherwise(w))
    named_label = F.transform(words, lambda w: F.when(label.endswith("s"), plural(w)).otherwise(w))[0]
    return F.when(label.rlike(f"^[0-9]{{1,{MOST_DIGITS}}}s?$"), named_label).otherwise(label)


def number_word(label: str) -> str:
    """``number_words`` for one driver-side name."""
    found = re.fullmatch(f"([0-9]{{1,{MOST_DIGITS}}})(s?)", label)
    if not found:
        return label
    digits = found[1].zfill(MOST_DIGITS)
    groups = [int(digits[i : i + 3]) for i in range(0, MOST_DIGITS, 3)]
    head = ", ".join(_below_1000(g) + scale for g, scale in zip(groups[:-1], list(reversed(SCALES))[:-1]) if g)
    last = _below_1000(groups[-1])
    joint = "" if not head or not last else " and " if groups[-1] < 100 else ", "
    words = head + joint + last or UNITS[0]
    return _plural(words) if found[2] else words


def display_label(name: Column) -> Column:
    """Column name to chart label: separators to spaces, title case."""
    return F.initcap(F.regexp_replace(name, "_+", " "))


def song_label(title: Column, artist: Column) -> Column:
    """``title -- artist`` with a missing artist shown as nothing."""
    return F.concat(title, F.lit(" -- "), F.coalesce(artist, F.lit("")))


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def family(name: Column) -> Column:
    """``family___sub`` -> ``family``."""
    return F.split_part(name, F.lit("___"), F.lit(1))


def subgenre(name: Column) -> Column:
    """``family___sub`` -> ``sub``."""
    return F.split_part(name, F.lit("___"), F.lit(2))


def score_column(label: Column) -> Column:
    """Score-column name of a class label: spaces to ``_``, number labels to words."""
    return number_words(F.translate(label, " ", "_"))


def score_table(model_path: Column) -> Column:
    """Activation-table name of a model path, as ``classifier_table``."""
    stem = F.regexp_replace(F.element_at(F.split(model_path, "/"), -1), r"\.onnx$", "")
    return F.concat(F.translate(stem, "-", "_"), F.lit("_activations"))


def classifier_columns(classes: list[str]) -> list[str]:
    """Score-column names of a classifier: spaces to ``_``, number labels to words."""
    return [number_word(name.replace(" ", "_")) for name in classes]


def classifier_table(model_path: str) -> str:
    """Activation-table name of a model file: its stem with ``-`` as ``_``, plus ``_activations``."""
    stem = re.sub(r"\.onnx$", "", model_path.split("/")[-1])
    return stem.replace("-", "_") + "_activations"
