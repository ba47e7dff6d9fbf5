"""A5: a global percentile of one column, exact or approximate.

``percentile_disc`` and ``percentile`` in Spark keep every distinct value of
a group in one buffer and merge them in one task, so an exact global
percentile over the whole history would land in a single task. The exact
method here brackets the value by a sketch and resolves it by counting:

1. a mergeable quantile sketch of the rows gives two values around the wanted
   rank (its rank error is at most ``n / ACCURACY``, whatever the values are);
2. one pass counts the rows below and above the bracket, and inside it the
   rows per distinct value (partial aggregation: a value that holds a third of
   all rows collapses on the map side);
3. a running count over the bracket's values gives the answer.

Ranks come from counting, so the answer is exact whatever the sketch says: if
the wanted rank lies outside the bracket, the search goes on there. A bracket
of more than ``LAST_ROWS`` rows is only counted and bracketed again, so the
running count sees a bounded number of values at any size and any skew (bins of
equal width would keep nearly all values beside one outlier). Only scalars
reach the driver; the jobs run when the function is called, and the result is a
one-row DataFrame. The approximate method is Spark's ``percentile_approx``.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import ROUND_CEILING, Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000               # of the sketch
MARGIN = 1.5                    # sketch errors between the wanted rank and the ends of the bracket
LAST_ROWS = 1_000_000           # rows of a bracket whose values are counted one by one
PARTS = 64                      # even parts of counted values


@dataclass
class Found:
    """The value at a rank and how it was found."""

    value: object
    passes: int                 # over the rows
    last_values: int            # distinct values that the running count saw


BELOW, FIRST, INSIDE, LAST, ABOVE = range(5)      # where a row lies: the bracket's ends by themselves


def _ends(values: DataFrame, share: float) -> tuple[float, float, int]:
    """The sketch's values around a share of the rows, and the rows; one pass."""
    v, slack = F.col(values.columns[0]), MARGIN / ACCURACY
    shares = [min(max(share - slack, 0.0), 1.0), min(share + slack, 1.0)]
    at = values.agg(F.percentile_approx(v.cast("double"), shares, ACCURACY).alias("ends"), F.count(F.lit(1)).alias("rows")).first()
    return (*(at["ends"] or (None, None)), at["rows"])


def find_percentile(df: DataFrame, column: str, p: float) -> Found:
    """The smallest value whose cumulative count reaches ceil(n * p), at least
    1; nulls are ignored, without values it is None."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be within [0, 1]")
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("v"))
    a, b, rows = _ends(values, p)
    if not rows:
        return Found(None, 1, 0)
    rank = max(int((Decimal(rows) * Decimal(repr(p))).to_integral_value(ROUND_CEILING)), 1)
    passes, v, d = 1, F.col("v"), F.col("v").cast("double")
    ordered = Window.orderBy("side", "v").rowsBetween(Window.unboundedPreceding, 0)
    while True:
        side = (F.when(d < F.lit(a), BELOW).when(d == F.lit(a), FIRST).when(d < F.lit(b), INSIDE)
                .when(d == F.lit(b), LAST).otherwise(ABOVE))
        single = [FIRST, LAST] + ([INSIDE] if 2 * MARGIN / ACCURACY * rows <= LAST_ROWS else [])
        cells = (values.groupBy(side.alias("side"), F.when(side.isin(single), v).alias("v")).agg(F.count(F.lit(1)).alias("c"))
                 .withColumn("upto", F.sum("c").over(ordered)))
        hit = cells.agg(F.min(F.when(F.col("upto") >= rank, F.struct("side", "v", "upto", "c"))).alias("s"),
                        F.count(F.lit(1)).alias("cells")).first()
        passes += 1
        if hit["s"]["side"] in single:
            return Found(hit["s"]["v"], passes, hit["cells"])
        rank -= hit["s"]["upto"] - hit["s"]["c"]
        values = values.where(side == hit["s"]["side"])
        a, b, rows = _ends(values, rank / hit["s"]["c"])
        passes += 1


def find_weighted_percentile(counts: DataFrame, column: str, weight: str, p: float):
    """The same for values that come with their number of rows: a sketch of
    the distinct values cuts them into even parts until few are left."""
    v, c = F.col(column), F.col(weight)
    values = counts.where(v.isNotNull() & (c > 0)).select(v.alias("v"), c.alias("c"))
    v, d = F.col("v"), F.col("v").cast("double")
    rows, distinct = values.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    rank = max(int((Decimal(rows) * Decimal(repr(p))).to_integral_value(ROUND_CEILING)), 1)
    ordered = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    while distinct:
        few = distinct <= LAST_ROWS
        cuts = [] if few else values.agg(F.percentile_approx(d, [i / PARTS for i in range(1, PARTS)], ACCURACY)).first()[0]
        part = sum((F.when(d > F.lit(x), 1).otherwise(0) for x in sorted(set(cuts))), F.lit(0))
        few = few or len(set(cuts)) < 2
        at = values.groupBy((v if few else part).alias("at")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("distinct"))
        hit = at.withColumn("upto", F.sum("c").over(ordered)).agg(
            F.min(F.when(F.col("upto") >= rank, F.struct("at", "upto", "c", "distinct")))).first()[0]
        if few:
            return hit["at"]
        values, rank, distinct = values.where(part == hit["at"]), rank - (hit["upto"] - hit["c"]), hit["distinct"]
    return None


def percentile_exact(df: DataFrame, column: str, p: float, alias: str = "p") -> DataFrame:
    """Discrete percentile (SQL percentile_disc): the smallest value whose
    cumulative count reaches ceil(n * p).

    Nulls are ignored; empty input gives one row holding null.
    """
    value = F.lit(find_percentile(df, column, p).value).cast(df.schema[column].dataType)
    return df.sparkSession.range(1).select(value.alias(alias))


def percentile_approx(df: DataFrame, column: str, p: float, alias: str = "p",
                      accuracy: int = 10000) -> DataFrame:
    """Sketch-based percentile (approx_percentile, as the original market models used)."""
    return df.agg(F.percentile_approx(column, p, accuracy).alias(alias))


def percentile(df: DataFrame, column: str, p: float, alias: str = "p",
               method: str = "exact", accuracy: int = 10000) -> DataFrame:
    if method == "exact":
        return percentile_exact(df, column, p, alias)
    if method == "approx":
        return percentile_approx(df, column, p, alias, accuracy)
    raise ValueError(f"unknown percentile method {method!r}")
