"""What making and merging states costs: no sort of all rows, no map-side copy
of all listings, no decimals per row; the results stay as they were."""

import datetime as dt

from pyspark.sql import Window, functions as F

from immolens.functions import price_per_m2, whole_price_per_m2
from immolens.operators import lattice, marts
from immolens.operators.marts import BEST_DEAL_COLUMNS, DEAL_ORDER
from immolens.operators.staging import to_staging
from immolens.schema import GOLD

DAY = dt.date(2025, 1, 1)


def history(spark):
    """A snapshot of many prices, one of a single price, one of few rows, one without a date."""
    rows = [(f"i{i}", f"t{i}", 300 + 7 * (i * 37 % 1009), 20 + i % 11, i % 5, None, "c", "d", "u", DAY) for i in range(1000)]
    rows += [(f"j{i}", "t", 500, 20, 1, None, "c", "d", "u", DAY + dt.timedelta(days=1)) for i in range(60)]
    rows += [(f"k{i}", "t", 100 + i, 20, 1, None, "c", "d", "u", DAY + dt.timedelta(days=2)) for i in range(5)]
    rows += [(f"l{i}", "t", 400 - i, 30, 1, None, "c", "d", "u", None) for i in range(300)]
    rows += [("n", "t", None, 30, 1, None, "c", "d", "u", DAY), ("z", "t", 10, 0, 1, None, "c", "d", "u", DAY)]
    return spark.createDataFrame(rows, GOLD)


def test_only_rows_below_a_bound_are_sorted_for_the_best_deals(spark):
    got = lattice.deal_states(history(spark))
    cheapest = Window.partitionBy("date_scraping").orderBy(*[F.col(c).asc_nulls_last() for c in DEAL_ORDER])
    want = (to_staging(history(spark)).where("price_m2 is not null").select(*BEST_DEAL_COLUMNS)
            .withColumn("_place", F.row_number().over(cheapest)).where("_place <= 20").drop("_place"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == 65
    assert "_bound" in got._jdf.queryExecution().executedPlan().toString()


def test_listing_states_travel_before_they_are_merged(spark):
    states = lattice.listing_states(history(spark))
    days = [DAY + dt.timedelta(days=i) for i in range(3)]
    got = lattice.persistence(states, days)
    assert got.collect() == marts.persistence(to_staging(history(spark)), snapshots=days).collect()
    plan = lattice.persistence(spark.createDataFrame(states.collect(), states.schema), days)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan


def test_sums_of_longs_are_exact_beyond_a_long(spark):
    values = [(1 << 62,), (1 << 62,), (1 << 62,), (-7,), (None,), (-(1 << 33) - 1,)]
    df = spark.createDataFrame(values, "x long")
    assert int(df.agg(lattice._long_sum("x")).first()[0]) == sum(v for (v,) in values if v is not None)
    assert df.where("x is null").agg(lattice._long_sum("x")).first()[0] is None
    assert "decimal" not in str(df.agg(F.sum("x"))._jdf.queryExecution().executedPlan()) and "sum(cast" not in str(
        df.agg(lattice._long_sum("x"))._jdf.queryExecution().executedPlan()).lower()


def test_whole_prices_are_divided_alike(spark):
    pairs = [(p, s) for p in (0, 1, 5, 101, 999, 123457, 2147483647, -1, -5, -333, -2147483648, None) for s in (1, 2, 3, 8, 40, 200, 1000, 2147483647, 0, -4, None)]
    pairs += [(p, 200) for p in range(1, 400)] + [(p, 8) for p in range(-50, 50)]
    df = spark.createDataFrame(pairs, "p int, s int")
    rows = df.select(whole_price_per_m2("p", "s").alias("a"), price_per_m2("p", "s").alias("b")).collect()
    assert [repr(r["a"]) for r in rows] == [repr(r["b"]) for r in rows]
