"""Exact medians and missing-value fill that stay distributed at any row count."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLICES = 4096


def frequencies(df: DataFrame, value: str, *extra, count: str = "n") -> DataFrame:
    """One row per distinct value: map-side combined, so a hot value costs one row per task."""
    return df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias(count), *extra)


def weighted_stddev(value: str, count: str) -> Column:
    """Sample deviation of an integer column given as (value, count); null for fewer than two rows.

    The sums are exact integers, so nothing is lost to cancellation or to the order of rows. They
    fit for values up to 7200 and 10^15 rows.
    """
    whole = "decimal(38,0)"
    x, n = F.col(value).cast("decimal(10,0)"), F.col(count).cast("decimal(18,0)")
    rows, values, squares = (F.sum(e.cast(whole)).cast(whole) for e in (n, x * n, x * x * n))
    scatter = (rows * squares).cast(whole) - (values * values).cast(whole)
    pairs = rows.cast("double") * (rows.cast("double") - 1.0)
    return F.sqrt(F.try_divide(scatter.cast("double"), pairs))


def frequency_median(freq: DataFrame, value: str, count: str = "n", out: str = "median") -> DataFrame:
    """One-row exact median of an integer column given as (value, count).

    Two levels keep every single-task window small: slices of 4096 neighbouring values first (an
    int column has at most 2^20 slices), then only the values of the one or two middle slices.
    """
    # A key that cannot be null keeps both uses of the counts the same plan, so they are made once.
    known = freq.filter(F.col(value).isNotNull())
    sliced = known.withColumn("_slice", F.coalesce(F.floor(F.col(value) / F.lit(float(_SLICES))), F.lit(0)))
    running = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = sliced.groupBy("_slice").agg(F.sum(count).alias("_c")).withColumn("_end", F.sum("_c").over(running))
    whole = Window.partitionBy()
    middle = (
        slices.withColumn("_n", F.max("_end").over(whole))
        .withColumn("_lo", F.floor((F.col("_n") + 1) / F.lit(2.0)))
        .withColumn("_hi", F.floor(F.col("_n") / F.lit(2.0)) + 1)
        .withColumn("_start", F.col("_end") - F.col("_c"))
        .filter(
            ((F.col("_start") < F.col("_lo")) & (F.col("_lo") <= F.col("_end")))
            | ((F.col("_start") < F.col("_hi")) & (F.col("_hi") <= F.col("_end")))
        )
        .select("_slice", "_start", "_lo", "_hi")
    )
    # At most two rows remain in ``middle``.
    inside = Window.partitionBy("_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (
        sliced.join(F.broadcast(middle), "_slice")
        .withColumn("_upto", F.col("_start") + F.sum(count).over(inside))
        .withColumn("_from", F.col("_upto") - F.col(count))
    )

    def at(rank: str):
        hit = (F.col("_from") < F.col(rank)) & (F.col(rank) <= F.col("_upto"))
        return F.max(F.when(hit, F.col(value)))

    return ranked.agg(((at("_lo") + at("_hi")) / F.lit(2.0)).alias(out))


def exact_median(df: DataFrame, column: str) -> float | None:
    """Exact median of a numeric column; null without values. NaN is not a value."""
    return medians(df, [column], always=True).get(column)


def medians(df: DataFrame, columns: list[str], always: bool = False) -> dict[str, float]:
    """Exact medians of those columns that contain nulls, or of all; by narrowing equal-width histograms.

    Each pass is one scan for all columns and both middle ranks, with a map-side combined count of at
    most 4096 slices for each; no sort and no shuffle of the values. A pass shrinks the value ranges
    4096-fold, so ints and doubles end after a few passes whatever the skew.
    """
    def value(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x), x)

    facts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(value(c)).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max))],
        *[F.count(c).alias(f"known{i}") for i, c in enumerate(columns)],
    ).first()
    spans = []
    for i, c in enumerate(columns):
        n = facts[f"n{i}"]
        if n and (always or facts[f"known{i}"] < facts["rows"]):
            spans += [_Span(c, rank, facts[f"lo{i}"], facts[f"hi{i}"]) for rank in ((n + 1) // 2, n // 2 + 1)]
    while open_spans := [s for s in spans if s.lo < s.hi]:
        _narrow(df.select(*[value(c).alias(c) for c in dict.fromkeys(s.column for s in open_spans)]), open_spans)
    picked = {s.column: [t.lo for t in spans if t.column == s.column] for s in spans}
    return {c: low if low == high else low / 2 + high / 2 for c, (low, high) in picked.items()}


@dataclass
class _Span:
    """A range of values of a column that holds the one with 1-based ``rank``, counted from ``lo``."""

    column: str
    rank: int
    lo: float
    hi: float

    def slot(self) -> Column:
        x, width = F.col(self.column), (self.hi - self.lo) / _SLICES
        if math.isinf(self.lo) or math.isinf(self.hi):
            return F.when(x == float("-inf"), 0).when(x == float("inf"), 2).otherwise(1)
        if math.isinf(width):  # the range is too wide for a double; halve it
            return F.when(x > self.lo / 2 + self.hi / 2, 1).otherwise(0)
        if width == 0:
            return F.when(x > self.lo, 1).otherwise(0)
        return F.least(F.floor((x - F.lit(self.lo)) / F.lit(width)), F.lit(_SLICES - 1))


def _narrow(values: DataFrame, spans: list[_Span]) -> None:
    """One pass: each span shrinks to the slice that holds its rank."""
    hits = [
        F.when(F.col(s.column).between(s.lo, s.hi), F.struct(
            F.lit(i).alias("i"), s.slot().cast("int").alias("slot"), F.col(s.column).alias("x")))
        for i, s in enumerate(spans)
    ]
    slices = (
        values.select(F.explode(F.array_compact(F.array(*hits))).alias("hit"))
        .groupBy("hit.i", "hit.slot").agg(F.count(F.lit(1)).alias("c"), F.min("hit.x").alias("lo"), F.max("hit.x").alias("hi"))
    )
    along = Window.partitionBy("i").orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = F.element_at(F.array(*[F.lit(s.rank) for s in spans]), F.col("i") + 1)
    found = (
        slices.withColumn("upto", F.sum("c").over(along))
        .filter((F.col("upto") >= rank) & (F.col("upto") - F.col("c") < rank))
        .collect()  # one row per span
    )
    for row in found:
        span = spans[row.i]
        if (row.lo, row.hi) == (span.lo, span.hi):
            raise ArithmeticError(f"no narrower range than {row.lo} to {row.hi}")
        span.rank, span.lo, span.hi = span.rank - (row.upto - row.c), row.lo, row.hi


def fill_with(df: DataFrame, values: dict[str, float]) -> DataFrame:
    """Nulls replaced by the given values; the filled columns become doubles."""
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in values.items()
    }) if values else df
