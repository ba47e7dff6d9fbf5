"""The queries of this subpackage, by name, and their DuckDB SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from immolens.llm.decontaminate import contaminations
from immolens.llm.maintext import with_main_text
from immolens.llm.neardup import near_duplicates
from immolens.llm.packing import pack, packed_digest
from immolens.llm.passages import repeated_passages
from immolens.llm.pii import find_pii
from immolens.llm.ppm import ppm_scores
from immolens.llm.quality import quality_scores
from immolens.llm.resample import importance_resample
from immolens.llm.reshard import reshard
from immolens.llm.runs import planted_periods, runs_digest, with_periodic_runs
from immolens.llm.tables import ship_package, table
from immolens.llm.topk import top_k
from immolens.llm.urls import judge

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(pack(table(spark, sf_dir, "documents")))


@query
def op2_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


# A vector that holds a null or non-finite component takes no part.
ORACLE_SQL["op2_bit_sliced_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op6_ngram_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


@query
def op4_setsketch_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE_SQL["op4_setsketch_neardup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END)) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 75 * (na.n + nb.n - shared)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS reached FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reached),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN c ON c.node = d.doc_id
"""


@query
def op5_min_cost_flow_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshard(table(spark, sf_dir, "documents"))


@query
def op8_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


@query
def op7_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


@query
def op10_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_scores(table(spark, sf_dir, "documents"))


@query
def op11_grammar_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted_periods(F.col("doc_id"), F.col("text")).alias("text"))
    return runs_digest(with_periodic_runs(docs))


@query
def op12_tag_ratio_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return with_main_text(pages).select("page_id", "url", "text", "n_chars")


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
