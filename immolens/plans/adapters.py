"""Shape the driver's test tables as listing layers.

The test data is TPC-H-like, not scraped listings, so the registered queries
map it onto the contract columns. ``lineitem`` rows become observations, a
part is a listing, its supplier's nation the city and the ship week the
snapshot. Every mapping runs over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from immolens.functions import whole_price_per_m2


LISTING_URL_BASE = "https://listings.example/annonce/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def observations_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined with its part, its supplier and the supplier's nation
    (all rows).

    A left-deep chain from the big table: each dimension is judged on its
    own scan size, so one that fits under the broadcast threshold is
    broadcast and a large one is sort-merge joined (AQE re-checks at run
    time and splits skewed ``l_partkey``/``l_suppkey`` partitions). Joining
    ``supplier`` to ``nation`` first would hide the supplier size behind a
    join estimate and shuffle ``lineitem`` for nothing.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_quantity", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (li.join(part, li.l_partkey == part.p_partkey)
              .join(supp, li.l_suppkey == supp.s_suppkey)
              .join(nation, supp.s_nationkey == nation.n_nationkey)
              .drop("p_partkey", "s_suppkey", "s_nationkey", "n_nationkey"))


def snapshot_week(ts_col: str):
    """Monday of the week of a timestamp, computed on dates only (no time
    zone enters: the tables hold zone-less timestamps)."""
    return F.trunc(F.to_date(ts_col), "week")


def history_columns() -> list:
    """Contract columns over ``observations_from_tables``."""
    price = F.floor("l_extendedprice").cast("int")
    surface = F.floor("l_quantity").cast("int")
    return [
        F.col("l_partkey").cast("string").alias("id_annonce"),
        F.upper("p_name").alias("title"),
        price.alias("price_eur"),
        surface.alias("surface_m2"),
        F.nullif(F.col("p_size") % 8, F.lit(7)).cast("int").alias("nb_pieces"),
        whole_price_per_m2(price, surface).alias("price_m2"),
        F.col("n_name").alias("city"),
        F.col("p_type").alias("description"),
        F.concat(F.lit(LISTING_URL_BASE), F.col("l_partkey").cast("string"),
                 F.lit("/")).alias("url"),
        snapshot_week("l_shipdate").alias("date_scraping"),
    ]


def history_from_tables(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """History-shaped observations (Gold schema, every row kept); ``keep``
    adds source columns (e.g. a tie-break key)."""
    return observations_from_tables(spark, sf_dir).select(*(keep or []), *history_columns())


def silver_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped listing text built from the tables, with the snapshot
    date of each row. Variants (no price, no rooms, no city, URL without
    trailing slash, non-http URL) are picked by line number so every row is
    kept and every branch of the Gold rules is exercised."""
    obs = observations_from_tables(spark, sf_dir)
    ln = F.col("l_linenumber")
    city_word = F.concat(F.substring("n_name", 1, 1),
                         F.lower(F.translate(F.substring("n_name", 2, 2147483647), "0123456789_", "abcdefghij ")))
    key = F.col("l_partkey").cast("string")
    return obs.select(
        F.when(ln % 3 == 0, F.concat(F.lit("Studio "), F.col("p_name")))
         .otherwise(F.concat(F.lit("Appartement "), (F.col("p_size") % 8).cast("string"),
                             F.lit(" Pièces "), F.upper("p_name"))).alias("title"),
        F.concat(F.col("p_type"), F.lit(" "), F.floor("l_quantity").cast("string"), F.lit(" m² - "),
                 city_word, F.when(ln % 4 == 0, F.lit("")).otherwise(F.lit(" (76)"))).alias("details"),
        F.when(ln % 5 == 0, F.lit("Prix sur demande"))
         .otherwise(F.concat(F.floor("l_extendedprice").cast("string"), F.lit(" €"))).alias("price"),
        F.concat(F.col("p_type"), F.lit("\r\n"), F.col("p_name"), F.lit("\n\nBel appartement")).alias("description"),
        F.when(ln == 7, F.concat(F.lit("ftp://listings.example/"), key))
         .when(ln % 2 == 0, F.concat(F.lit(LISTING_URL_BASE), key))
         .otherwise(F.concat(F.lit(LISTING_URL_BASE), key, F.lit("/"))).alias("url"),
        F.concat(F.lit("raw/"), snapshot_week("l_shipdate").cast("string"),
                 F.lit("/page_"), (F.col("l_orderkey") % 10).cast("string"), F.lit(".html")).alias("source_file"),
        (F.col("l_orderkey") * 8 + ln).alias("position"),
        snapshot_week("l_shipdate").alias("snapshot_date"),
    )


# Rounding to cents in whole numbers, independent of the library's ROUND:
# (2a + b) div 2b is a / b rounded half up, for a >= 0 and b > 0.
def sql_ratio2(a: str, b: str) -> str:
    """Two whole-number expressions' ratio, to two decimals."""
    return f"(CAST(200 * CAST({a} AS HUGEINT) + CAST({b} AS HUGEINT) AS HUGEINT) // (2 * CAST({b} AS HUGEINT))) / 100.0"


def sql_mean2(x: str) -> str:
    """Mean of a column of whole cents, to two decimals."""
    cents = f"sum(CAST(round({x} * 100) AS HUGEINT))"
    return f"CAST((CAST(2 * {cents} + count({x}) AS HUGEINT) // (2 * nullif(count({x}), 0))) / 100.0 AS DOUBLE)"


# DuckDB form of ``history_from_tables`` used by the oracle SQL.
HISTORY_SQL = f"""
history AS (
  SELECT CAST(l.l_partkey AS VARCHAR) AS id_annonce,
         upper(p.p_name) AS title,
         CAST(floor(l.l_extendedprice) AS INTEGER) AS price_eur,
         CAST(floor(l.l_quantity) AS INTEGER) AS surface_m2,
         CAST(nullif(p.p_size % 8, 7) AS INTEGER) AS nb_pieces,
         CASE WHEN floor(l.l_quantity) > 0
              THEN {sql_ratio2("floor(l.l_extendedprice)", "floor(l.l_quantity)")}
         END AS price_m2,
         n.n_name AS city,
         p.p_type AS description,
         'https://listings.example/annonce/' || CAST(l.l_partkey AS VARCHAR) || '/' AS url,
         CAST(date_trunc('week', l.l_shipdate) AS DATE) AS date_scraping,
         l.l_orderkey, l.l_linenumber
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

STAGING_SQL = HISTORY_SQL + f""",
stg AS (
  SELECT id_annonce,
         upper(substr(title, 1, 1)) || lower(substr(title, 2)) AS title,
         CAST(price_eur AS DOUBLE) AS price_eur,
         CAST(surface_m2 AS DOUBLE) AS surface_m2,
         nb_pieces,
         {sql_ratio2("price_eur", "nullif(surface_m2, 0)")} AS price_m2,
         upper(substr(city, 1, 1)) || lower(substr(city, 2)) AS city,
         trim(description) AS description,
         date_scraping
  FROM history
  WHERE price_eur IS NOT NULL AND surface_m2 > 0
)"""


# Fixed values of the generated result pages (test data only).
PAGE_ORIGIN = "https://listings.example"
ORDERS_PER_PAGE = 4096
END_PAGE_NO = 1 << 40


def _html_escape(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def _page(week, page_no, header, body):
    return (week.alias("snapshot_date"), page_no.alias("page_no"),
            F.concat(F.lit("<html><body><h1>"), F.lit(header), F.lit("</h1>"), body,
                     F.lit("</body></html>")).alias("html"),
            F.concat(F.lit("raw/"), week.cast("string"), F.lit("/page_"), page_no.cast("string"),
                     F.lit(".html")).alias("source_file"),
            F.lit(None).cast("int").alias("status_code"))


def _article(row):
    """The markup of a line item (a struct), as ``listing_pages_from_tables`` says."""
    ln = row["l_linenumber"]
    city_word = F.concat(F.substring(row["n_name"], 1, 1),
                         F.lower(F.translate(F.substring(row["n_name"], 2, 2147483647), "0123456789_", "abcdefghij ")))
    title = (F.when(ln % 3 == 0, F.concat(F.lit("Studio "), row["p_name"]))
              .otherwise(F.concat(F.lit("Appartement "), (row["p_size"] % 8).cast("string"),
                                  F.lit(" Pièces "), F.upper(row["p_name"]))))
    details = F.concat(row["p_type"], F.lit(" "), F.floor(row["l_quantity"]).cast("string"), F.lit(" m² - "),
                       city_word, F.when(ln % 4 == 0, F.lit("")).otherwise(F.lit(" (76)")))
    price = F.when(ln % 5 != 0, F.concat(F.floor(row["l_extendedprice"]).cast("string"), F.lit(" €")))
    desc = F.when(ln % 6 != 0, F.concat(row["p_type"], F.lit("\r\n"), row["p_name"],
                                        F.lit("\n\nBel appartement")))
    href = F.concat(F.lit("/immobilier/annonce/"), row["l_partkey"].cast("string"),
                    F.when(ln % 2 == 0, F.lit("")).otherwise(F.lit("/")))
    title_attr = F.when(ln != 7, F.concat(F.lit(' title="'), _html_escape(title), F.lit('"')))
    return F.concat(
        F.lit('<article><a href="'), href, F.lit('"'), F.coalesce(title_attr, F.lit("")), F.lit(">"),
        _html_escape(title), F.lit("</a><span>"), _html_escape(details), F.lit("</span>"),
        F.coalesce(F.concat(F.lit("<p>"), _html_escape(desc), F.lit("</p>")), F.lit("")),
        F.coalesce(F.concat(F.lit("<div>"), _html_escape(price), F.lit("</div>")), F.lit("")),
        F.lit("</article>"))


def listing_pages_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw result pages built from the tables.

    Page ``n`` of a week holds one ``<article>`` per line item shipped that
    week whose order falls in the ``n``-th block of 4096 orders, in order
    and line-number order: about 40 listings a page at any scale and never
    more than 7 * 4096, so the grouping that assembles a page stays bounded.
    Real pages say "10 annonces", which is not an end marker. After its
    last page every week has an end page ("Aucune annonce") and then one
    more page with a sentinel listing that the cut-off must drop.

    Variants by line number: no title attribute (7), no price (multiples of
    5), no description paragraph (multiples of 6), no city (multiples of
    4), no trailing slash on the link (even).
    """
    obs = observations_from_tables(spark, sf_dir)
    # The fields of an article travel, its markup is made where the page is put together.
    item = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity",
                    "p_name", "p_type", "p_size", "n_name")
    items = obs.select(
        snapshot_week("l_shipdate").alias("week"),
        F.floor(F.col("l_orderkey") / ORDERS_PER_PAGE).alias("page_no"), item.alias("item"))
    pages = (items.groupBy("week", "page_no").agg(F.collect_list("item").alias("items"))
             .select("week", "page_no", F.array_sort(F.transform("items", lambda x: F.struct(
                 x["l_orderkey"], x["l_linenumber"], _article(x).alias("html")))).alias("items"))
             .select(*_page(F.col("week"), F.col("page_no"), "10 annonces",
                            F.array_join(F.transform("items", lambda x: x["html"]), ""))))
    # the week list comes from one column of lineitem, not from the joined rows
    weeks = table(spark, sf_dir, "lineitem").select(snapshot_week("l_shipdate").alias("week")).distinct()
    sentinel = F.concat(F.lit('<article><a href="/immobilier/annonce/after-end-'), F.col("week").cast("string"),
                        F.lit('/" title="Appartement 1 pièce">x</a><p>after the end</p><div>1 €</div></article>'))
    end_pages = weeks.select(*_page(F.col("week"), F.lit(END_PAGE_NO), "Aucune annonce", F.lit("")))
    after_end = weeks.select(*_page(F.col("week"), F.lit(END_PAGE_NO + 1), "10 annonces", sentinel))
    return pages.unionByName(end_pages).unionByName(after_end)
