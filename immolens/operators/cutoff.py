"""S12 (generic form): per group, keep rows up to a first stop row.

A running-max window would sort each whole group in one task, so a group
holding a third of all rows would sit in a single task. Instead the first
stop of each group is found with an aggregation (combined on the map side)
and joined back on the group keys; AQE splits a skewed group of that join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cut_at_first(df: DataFrame, group: Sequence[str], order: Sequence[str],
                 stop_after: Column | None = None, stop_before: Column | None = None, few_groups: bool = False) -> DataFrame:
    """Rows of each group sorted by ``order`` (a total order), kept up to and
    including the first row where ``stop_after`` holds, and strictly before
    the first row where ``stop_before`` holds. Groups with no stop keep all.
    A null in an order column sorts first, as in ``ORDER BY ... ASC``: such a
    row is kept unless a stop sorts first too. With ``few_groups`` (such as
    dates) the stops, one row a group, are broadcast and no row is shuffled.
    """
    group, order = list(group), list(order)
    key = F.struct(*[F.col(c) for c in order])          # never null itself; null fields sort first
    stops = {name: cond for name, cond in (("_after", stop_after), ("_before", stop_before))
             if cond is not None}
    if not stops:
        return df

    # The stop keys are projected first, so the aggregation (and any sort it
    # needs) sees narrow rows, not the wide rows the conditions read.
    marks = df.select(*group, *[F.when(cond, key).alias(name) for name, cond in stops.items()])
    firsts = marks.groupBy(*group).agg(*[F.min(name).alias(name) for name in stops])
    any_stop = F.lit(False)
    for name in stops:
        any_stop = any_stop | F.col(name).isNotNull()
    firsts = firsts.where(any_stop).select(*[F.col(g).alias(f"_g_{g}") for g in group], *stops)

    if few_groups:
        firsts = F.broadcast(firsts)
    same_group = F.lit(True)
    for g in group:
        same_group = same_group & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    keep = F.lit(True)
    if "_after" in stops:
        keep = keep & (F.col("_after").isNull() | (key <= F.col("_after")))
    if "_before" in stops:
        keep = keep & (F.col("_before").isNull() | (key < F.col("_before")))
    return df.join(firsts, same_group, "left").where(keep).select(*df.columns)
