"""Profiles, data checks and freshness, each in one pass.

Every check is an aggregate expression; a suite of checks is one
aggregation over the table followed by an unpivot of the single result row,
so the table is read once whatever the number of checks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row, number of nulls of each column (named as the column)."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def profile(df: DataFrame) -> DataFrame:
    """Long table ``(column, type, rows, nulls)`` from one aggregation."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(f.name).isNull()).alias(f"_n{i}") for i, f in enumerate(fields)]
    one = df.agg(*aggs)
    entries = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                        F.col("_rows").alias("rows"), F.col(f"_n{i}").alias("nulls"))
               for i, f in enumerate(fields)]
    return one.select(F.inline(F.array(*entries)))


@dataclass(frozen=True)
class Check:
    """One column test. ``kind`` is ``not_null`` or ``between``; bounds of
    ``between`` are inclusive and either may be open (None)."""
    column: str
    kind: str
    min_value: float | None = None
    max_value: float | None = None

    @property
    def name(self) -> str:
        if self.kind == "between":
            lo = "" if self.min_value is None else f"{self.min_value:g}"
            hi = "" if self.max_value is None else f"{self.max_value:g}"
            return f"between[{lo},{hi}]"
        return self.kind

    def failures(self, among: Column | None = None) -> Column:
        """Number of failing rows (of those that meet ``among``)."""
        failed = self._failed()
        return F.count_if(failed if among is None else among & failed)

    def _failed(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":                                           # Q1
            return c.isNull()
        if self.kind == "between":                                            # Q2
            cond = F.lit(True)
            if self.min_value is not None:
                cond = cond & (c >= F.lit(self.min_value))
            if self.max_value is not None:
                cond = cond & (c <= F.lit(self.max_value))
            # A null value neither passes nor fails a range test.
            return c.isNotNull() & ~cond
        raise ValueError(f"unknown check kind {self.kind!r}")


# The checks of the staging view and of the history source.
STAGING_CHECKS = (
    Check("id_annonce", "not_null"),
    Check("price_eur", "not_null"),
    Check("price_eur", "between", min_value=0),
    Check("surface_m2", "not_null"),
    Check("surface_m2", "between", min_value=5),
    Check("price_m2", "not_null"),
    Check("date_scraping", "not_null"),
)
SOURCE_CHECKS = (
    Check("id_annonce", "not_null"),
    Check("date_scraping", "not_null"),
)


def check_failures(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Q4 (wide form): one row, one failure count per check, one pass."""
    return df.agg(*[chk.failures().alias(f"c{i}") for i, chk in enumerate(checks)])


def run_checks(df: DataFrame, table: str, checks: Sequence[Check] = STAGING_CHECKS) -> DataFrame:
    """Q4: ``(table, column, check, failures, status)``, one row per check."""
    wide = check_failures(df, checks)
    entries = [F.struct(F.lit(table).alias("table"), F.lit(chk.column).alias("column"),
                        F.lit(chk.name).alias("check"), F.col(f"c{i}").alias("failures"))
               for i, chk in enumerate(checks)]
    return (wide.select(F.inline(F.array(*entries)))
                .withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail")))


def freshness(df: DataFrame, loaded_at: Column, as_of, warn_after_hours: float = 48,
              error_after_hours: float = 96) -> DataFrame:
    """Q3: age of the newest row against ``as_of``: pass, warn or error.

    No rows at all is an error. ``as_of`` is a timestamp (or its text) so
    the check is deterministic in tests.
    """
    if isinstance(as_of, dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    # Wall-clock (NTZ) arithmetic: the age does not depend on the session zone.
    as_of_col = F.lit(as_of).cast("timestamp_ntz")
    newest = df.agg(F.max(loaded_at.cast("timestamp_ntz")).alias("max_loaded_at"))
    age_hours = (F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), as_of_col)
                 / F.lit(3_600_000_000.0))
    return newest.select(
        "max_loaded_at",
        as_of_col.alias("as_of"),
        age_hours.alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), "error")
         .when(age_hours > error_after_hours, "error")
         .when(age_hours > warn_after_hours, "warn")
         .otherwise("pass").alias("status"),
    )


def snapshot_loaded_at(date_col: str = "date_scraping") -> Column:
    """Load time of a snapshot: midnight of its date."""
    return F.col(date_col).cast("timestamp_ntz")


def written_metrics(columns: Sequence[str]) -> list[Column]:
    """A7, A8, H4, Q1, Q2 as metrics to observe while History rows are
    written: rows, nulls per column, failures per source check and, on the rows
    that staging keeps, per staging check."""
    from immolens.operators.staging import is_staged
    from immolens.functions import price_per_m2

    staged = F.coalesce(is_staged(), F.lit(False))
    checks = [chk.failures().alias(f"source_{i}") for i, chk in enumerate(SOURCE_CHECKS)]
    recomputed = price_per_m2("price_eur", "surface_m2")
    checks += [F.count_if(staged & (recomputed.isNull() if chk.column == "price_m2" else chk._failed())).alias(f"staging_{i}")
               for i, chk in enumerate(STAGING_CHECKS)]
    return [F.count(F.lit(1)).alias("rows"), F.count_if(staged).alias("staged_rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns], *checks]


def written_report(metrics: dict, columns: Sequence[str], staging_table: str, source_table: str) -> dict:
    """Observed metrics as a report: ``rows``, ``staged_rows``, ``nulls`` by
    column and ``checks`` as ``run_checks`` lists them."""
    checks = [{"table": table, "column": c.column, "check": c.name, "failures": metrics[f"{kind}_{i}"],
               "status": "pass" if metrics[f"{kind}_{i}"] == 0 else "fail"}
              for table, kind, some in ((staging_table, "staging", STAGING_CHECKS), (source_table, "source", SOURCE_CHECKS))
              for i, c in enumerate(some)]
    return {"rows": metrics["rows"], "staged_rows": metrics["staged_rows"],
            "nulls": {c: metrics[f"null_{c}"] for c in columns}, "checks": checks}
