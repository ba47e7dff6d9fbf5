"""The registered queries and the pipeline on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from immolens.llm.catalog import ORACLE_SQL, QUERIES
from immolens.llm.decontaminate import contaminations
from immolens.llm.pii import base_spans
from immolens.llm.quality import quality_scores
from immolens.llm.tables import table
from llm_helpers import AWKWARD, components, documents, shingles
from tools.oracle_check import TABLES, canon

SF = "/root/testdata/sf0.001"

# Columns that the queries' contracts name.
COLUMNS = {
    "op1_": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op2_": "query_id rank vec_id score",
    "op3_": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op4_": "doc_id n_shingles component_id kept",
    "op5_": "doc_id size text_crc32 law shard slot grown_shard",
    "op6_": "page_id host path rule verdict",
    "op7_": "doc_id item_id similarity",
    "op8_": "doc_id held_out score predicted",
    "op9_": "doc_id start_word n_words source_id source_start",
    "op10_": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op11_": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op12_": "page_id url text n_chars",
    "op13_": "doc_id n_features weight score rank",
}


def test_one_query_per_operator():
    assert sorted(q.split("_")[0] + "_" for q in QUERIES) == sorted(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    found = QUERIES[name](spark, SF)
    wanted = COLUMNS[name.split("_")[0] + "_"].split()
    assert set(wanted) <= set(found.columns)
    rows = [tuple(r) for r in found.collect()]
    assert rows
    if name in ORACLE_SQL:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        cur = con.execute(ORACLE_SQL[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(found.columns)
        assert canon(rows, found.columns) == canon(cur.fetchall(), names)


def stages(spark, docs, tmp_dir):
    """(name, input, output) of every stage, written and read as in a run."""
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_dir}/{k}")
        out = spark.read.parquet(f"{tmp_dir}/{k}")
        yield name, docs, out
        docs = out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect() if r[0] is not None)


def test_every_stage_against_its_own_input(spark, tmp_dir):
    whole = table(spark, SF, "documents")
    for name, before, after in stages(spark, whole, tmp_dir):
        texts = dict(before.select("doc_id", "text").collect())
        if name != "packing":
            assert after.columns == whole.columns
        if name == "quality":
            assert ids(after) == ids(quality_scores(before, table(spark, SF, "labels")).where("predicted = 1"))
        elif name == "near_duplicates":
            sets = {i: shingles(t) for i, t in texts.items()}
            links = [(a, b) for a in sets for b in sets if a < b and (x := len(sets[a] & sets[b])) and 100 * x >= 75 * len(sets[a] | sets[b])]
            assert ids(after) == sorted(set(components(sets, links).values()))
        elif name == "decontamination":
            hit = set(ids(contaminations(before, table(spark, SF, "benchmark"))))
            assert hit and ids(after) == sorted(set(texts) - hit)
        elif name == "pii":
            new = {r["doc_id"]: r for r in after.collect()}
            assert ids(after) == sorted(texts)
            for i, t in texts.items():
                assert new[i]["n_chars"] == len(new[i]["text"]) or new[i]["text"] == t
                assert not base_spans(new[i]["text"]) and (base_spans(t) or len(new[i]["text"]) <= len(t))
        else:
            tokens = {r["doc_id"]: r["n"] for r in after.groupBy("doc_id").sum("length").toDF("doc_id", "n").collect()}
            total = {r["doc_id"]: r["doc_tokens"] for r in after.select("doc_id", "doc_tokens").distinct().collect()}
            assert tokens == total and set(tokens) == set(texts)


def test_run_returns_the_last_stage(spark, tmp_dir):
    *_, (_, _, last) = stages(spark, table(spark, SF, "documents"), tmp_dir)
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == last.columns and 4 <= len(corpus_pipeline.STAGES) <= 5
    pick = ["doc_id", "doc_tokens"]
    assert sorted(found.select(pick).distinct().collect()) == sorted(last.select(pick).distinct().collect())


def test_stages_take_awkward_and_empty_tables(spark, tmp_dir):
    for k, rows in enumerate((AWKWARD, [])):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name == "packing":
                assert out.count() >= len(rows) - 4
                break
            assert out.columns == docs.columns
            out.write.parquet(f"{tmp_dir}/{k}-{name}")
            docs = spark.read.parquet(f"{tmp_dir}/{k}-{name}")
            if name == "quality":                    # too few labels decide here; go on with all rows
                docs = documents(spark, rows)
            if name == "near_duplicates" and rows:
                kept = [r["doc_id"] for r in docs.collect()]
                assert kept.count(3) == 1 and kept.count(None) == 2 and 6 not in kept and 8 not in kept
