"""A5: the sketch-bracketed exact percentile against sorting."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from immolens.operators import percentile as P
from immolens.operators.marts import best_deals
from immolens.operators.staging import to_staging
from immolens.plans.adapters import history_from_tables


def wanted(values, p, key=lambda x: x):
    return sorted(values, key=key)[max(1, math.ceil(round(len(values) * p, 9))) - 1]


def test_one_outlier_leaves_few_values(spark):
    """Equal-width bins would keep all values beside 10^18 in one bin."""
    rows = spark.range(400_000).select((F.col("id") % 200_000 / 7.0).alias("x")).unionByName(
        spark.createDataFrame([(1e18,)], "x double"))
    found = P.find_percentile(rows, "x", 0.2)
    assert found.value == wanted([i % 200_000 / 7.0 for i in range(400_000)] + [1e18], 0.2)
    assert found.last_values <= 4 * 400_001 / P.ACCURACY and found.passes == 2


def test_large_brackets_are_bracketed_again(spark, monkeypatch):
    monkeypatch.setattr(P, "LAST_ROWS", 20)
    rng = random.Random(3)
    values = [rng.expovariate(1) ** 9 for _ in range(30_000)] + [0.5] * 10_000 + [1e300, float("inf"), -1e300]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    for p in (0.0, 0.003, 0.2, 0.5, 0.77, 0.9999, 1.0):
        found = P.find_percentile(df, "x", p)
        assert found.value == wanted(values, p) and found.last_values <= 40


@pytest.mark.parametrize("lie", [(-5.0, -4.0), (900.0, 901.0), (0.0, 999.0), (500.0, 500.0), (499.5, 499.6)], ids=range(5))
def test_a_wrong_sketch_costs_passes_only(spark, monkeypatch, lie):
    monkeypatch.setattr(P, "LAST_ROWS", 1)
    real, calls = P._ends, []

    def ends(values, share):
        calls.append(share)
        a, b, rows = real(values, share)
        return (*lie, rows) if len(calls) == 1 else (a, b, rows)

    monkeypatch.setattr(P, "_ends", ends)
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    assert P.find_percentile(df, "x", 0.3).value == 299.0


@pytest.mark.parametrize("kind, values", [
    ("bigint", [2**53 + i for i in range(40)] + [-5, 2**62]), ("int", list(range(100))), ("float", [0.1, 0.2, 0.1, 7.5]),
    ("decimal(38,10)", [Decimal(10) ** 20 + Decimal(i) / 10**9 for i in range(50)]), ("double", [float("nan"), 1.0, 2.0, float("nan")]),
], ids=lambda x: x if isinstance(x, str) else "")
def test_column_types(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], f"x {kind}")
    ordered = sorted(values, key=lambda v: (v != v, v))
    for p in (0.0, 0.2, 0.5, 1.0):
        out = P.percentile_exact(df, "x", p)
        got, want = out.first()[0], ordered[max(1, math.ceil(round(len(values) * p, 9))) - 1]
        assert out.dtypes == [("p", kind)]
        assert got == want or (got != got and want != want) or (kind == "float" and abs(got - want) < 1e-6)


def test_empty_and_bad_share(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert P.percentile_exact(df, "x", 0.5).collect()[0][0] is None
    with pytest.raises(ValueError):
        P.percentile_exact(df, "x", 1.5)


def test_best_deals_with_an_outlier(spark):
    history = history_from_tables(spark, "/root/testdata/sf0.001")
    odd = history.limit(1).withColumn("price_eur", F.lit(2_000_000_000)).withColumn("surface_m2", F.lit(1)) \
        .withColumn("date_scraping", F.lit(dt.date(2030, 1, 1)))
    stg = to_staging(history.unionByName(odd)).select("price_m2", "id_annonce", "title", "city", "price_eur", "surface_m2", "date_scraping", "description")
    values = [r.price_m2 for r in stg.select("price_m2").collect() if r.price_m2 is not None]
    cut = wanted(values, 0.2)
    assert best_deals(stg, limit=None).count() == sum(v <= cut for v in values)
