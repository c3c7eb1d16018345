"""Exact quantiles with linear interpolation by counting alone: no sketch, no sort and no window over values.

A first pass counts the values by sign and part of an octave, in the order of the numbers. Each further pass cuts only the
part that holds a wanted rank into ``CELLS`` equal cells, until such a cell holds one value: two to four more passes, since
each settles 16 bits of a double. Counts combine before their shuffle, so a value that fills the column is one row a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratelight.functions.labels import sql_text

CELLS = 65_536
OCTAVE = 8  # parts of an octave in the first pass
ZERO = 10_000  # above the number of a part of any finite double's octave, below as well


def _magnitude(x: Column) -> Column:
    """A whole number that grows with ``x``, the same for values of one sign within an eighth of an octave; 0 for zero alone
    and one for each infinity."""
    part = F.when(F.abs(x) == float("inf"), 2 * ZERO).otherwise(F.floor(F.log2(F.abs(x)) * OCTAVE) + ZERO).cast("int")
    return F.when(x == 0, 0).when(x > 0, part).otherwise(-part)


def _placed(counted: DataFrame, group: str) -> DataFrame:
    """(group, cell, held, least, most) with ``before``, the values in earlier cells, and ``n``, all of the group."""
    earlier = Window.partitionBy(group).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0))).withColumn("n", F.sum("held").over(Window.partitionBy(group)))


def _counted(rows: DataFrame, group: str, cell: Column) -> DataFrame:
    return rows.groupBy(group, cell.alias("cell")).agg(F.count(F.lit(1)).alias("held"), F.min("x").alias("least"), F.max("x").alias("most"))


def _literals(spark, rows: list[tuple], names: list[str]) -> DataFrame:
    """Rows of a request as a plan of constants."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]], cells: int = CELLS) -> DataFrame:
    """(name, q, value) for each column of ``df`` named in ``wanted`` and each of its quantiles; NULL and NaN skipped.

    ``df`` is read once a pass. What comes back to the driver in a pass is one row for each wanted rank.
    """
    spark, columns = df.sparkSession, list(wanted)
    asked = [(c, float(q)) for c in columns for q in wanted[c]]
    x = F.col("x") + F.lit(0.0)  # one zero
    scores = (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], columns, "name", "x")
        .where(F.col("x").isNotNull() & ~F.isnan("x")).select("name", x.alias("x"))
    )
    request = _literals(spark, [(i, c, q, end) for i, (c, q) in enumerate(asked) for end in (0, 1)], ["slot", "name", "q", "end"])
    exact = F.col("q") * (F.col("n") - 1)
    rank = F.when(F.col("end") == 0, F.floor(exact)).otherwise(F.ceil(exact))
    first = _placed(_counted(scores, "name", _magnitude(F.col("x"))), "name")
    held = (rank >= F.col("before")) & (rank < F.col("before") + F.col("held"))
    found = first.join(F.broadcast(request), "name").where(held).select("slot", "end", "name", "least", "most", "before", "n", exact.alias("at"), rank.alias("rank"))
    known = {(r.slot, r.end): r for r in found.collect()}
    values = {k: r.least for k, r in known.items() if r.least == r.most}
    open_ = {k: (r.name, r.least, r.most, r.rank - r.before) for k, r in known.items() if r.least < r.most}
    while open_:
        brackets = sorted({(name, low, high) for name, low, high, _ in open_.values()})
        number = {b: i for i, b in enumerate(brackets)}
        table = _literals(spark, [(i, *b) for b, i in number.items()], ["bracket", "name", "low", "high"])
        targets = _literals(spark, [(number[b[:3]], slot, end, int(b[3])) for (slot, end), b in open_.items()], ["bracket", "slot", "end", "rank"])
        inside = scores.join(F.broadcast(table), "name").where(F.col("x").between(F.col("low"), F.col("high")))
        cell = F.least(F.floor((F.col("x") - F.col("low")) / (F.col("high") - F.col("low")) * cells), F.lit(cells - 1)).cast("int")
        placed = _placed(_counted(inside, "bracket", cell), "bracket")
        held = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("held"))
        rows = placed.join(F.broadcast(targets), "bracket").where(held).select("slot", "end", "least", "most", (F.col("rank") - F.col("before")).alias("rank")).collect()
        names = {k: b[0] for k, b in open_.items()}
        values |= {(r.slot, r.end): r.least for r in rows if r.least == r.most}
        open_ = {(r.slot, r.end): (names[r.slot, r.end], r.least, r.most, r.rank) for r in rows if r.least < r.most}
    out = []
    for i, (c, q) in enumerate(asked):
        if (i, 0) in values:
            low, high, r = values[i, 0], values[i, 1], known[i, 0]
            out.append((c, q, low if low == high else low + (high - low) * (r["at"] - int(r["rank"]))))
    if not out:
        return spark.createDataFrame([], "name string, q double, value double")
    return _literals(spark, out, ["name", "q", "value"])


def quantile_row(df: DataFrame, wanted: dict[str, list[float]]) -> tuple[DataFrame, dict[tuple[str, float], str]]:
    """The same quantiles as one row, with the field name of each (column, q)."""
    fields = {(c, float(q)): f"t{i}" for i, (c, q) in enumerate((c, q) for c, qs in wanted.items() for q in qs)}
    picks = [F.expr(f"max(value) FILTER (WHERE name = {sql_text(c)} AND q = {q!r}d) AS {field}") for (c, q), field in fields.items()]
    return exact_quantiles(df, wanted).agg(*picks), fields


def describe(df: DataFrame, column: str, decimals: int = 3) -> DataFrame:
    """count, mean, sample std, min, quartiles and max of one column, rounded half to even, in one row."""
    quartiles, fields = quantile_row(df, {column: [0.25, 0.5, 0.75]})
    x = F.col(column).cast("double")
    row = F.struct(*[F.col(field) for field in fields.values()])
    cuts = quartiles.select(row.alias("_cuts")).scalar()
    plain = df.where(x.isNotNull() & ~F.isnan(x)).agg(
        F.count("*").alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"), F.max(x).alias("max"),
    )
    return plain.withColumn("_cuts", cuts).select(
        "count",
        *[F.bround(c, decimals).alias(c) for c in ("mean", "std", "min")],
        *[
            F.bround(F.col("_cuts").getField(field), decimals).alias(f"p{int(q * 100)}")
            for (_, q), field in fields.items()
        ],
        F.bround("max", decimals).alias("max"),
    )
