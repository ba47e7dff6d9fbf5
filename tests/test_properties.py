
import bisect

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from immolens.functions import clean_text
from immolens.operators import marts
from immolens.operators.percentile import percentile_approx
from immolens.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def test_gold_is_unique_per_snapshot_and_id(spark):
    gold = QUERIES["gold_from_html"](spark, SF)
    dup = gold.groupBy("date_scraping", "id_annonce").count().where("count > 1").count()
    assert dup == 0 and gold.count() > 0


def test_counts_add_up(spark):
    stg = QUERIES["staging"](spark, SF)
    evo = marts.price_evolution(stg).agg(F.sum("nb_annonces")).collect()[0][0]
    kpi = marts.market_kpi(stg).collect()[0]["total_annonces"]
    assert evo == kpi == stg.count()
    n_dates = stg.select("date_scraping").distinct().count()
    assert marts.mean_of_snapshot_means(stg).agg(F.max("nb_weeks")).collect()[0][0] <= n_dates


def test_every_best_deal_is_at_or_below_the_cut(spark):
    stg = QUERIES["staging"](spark, SF)
    cut = marts.price_cut(stg).collect()[0][0]
    deals = marts.best_deals(stg, limit=None)
    assert deals.where(F.col("price_m2") > cut).count() == 0
    below = stg.where(F.col("price_m2") <= cut).count()
    assert deals.count() == below


def test_approx_percentile_rank_error_is_bounded(spark):
    stg = QUERIES["staging"](spark, SF)
    values = sorted(r[0] for r in stg.select("price_m2").collect())
    n, accuracy = len(values), 100
    got = percentile_approx(stg, "price_m2", 0.2, accuracy=accuracy).collect()[0][0]
    rank = bisect.bisect_right(values, got)
    assert abs(rank - 0.2 * n) <= n / accuracy + 1


WS = "\t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u2009\u3000 "
TEXT = st.text(alphabet=st.sampled_from(list(WS + "abé²x")), max_size=30)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=20))
def test_clean_text_properties(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r[0] for r in df.select(clean_text("t")).collect()]
    again = [r[0] for r in spark.createDataFrame([(o,) for o in out], "t string")
             .select(clean_text("t")).collect()]
    for t, o, o2 in zip(texts, out, again):
        if not t:
            assert o is None                                    # null and "" -> null
            continue
        assert all(c == " " or not c.isspace() for c in o)      # only plain spaces left
        assert "  " not in o and o == o.strip()                 # single, inner spaces
        assert o.replace(" ", "") == "".join(c for c in t if not c.isspace())
        assert o2 == (o if o else None)                         # cleaning twice changes nothing
