import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from immolens.llm import reshard as resharding
from immolens.llm.reshard import FlowNetwork, even_capacities, plan_transfers, reshard, rewrite_affected

from llm_helpers import AWKWARD, documents, words_text


def check(rows, texts, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_awkward_texts(spark):
    check(reshard(documents(spark, AWKWARD), 5).collect(), AWKWARD, 5)


def test_many_equal_rows(spark):
    texts = [(i, "same text") for i in range(500)] + [(i, words_text(i % 40)) for i in range(500, 800)]
    check(reshard(documents(spark, texts), 40).collect(), texts, 40)


def test_fewer_shards_than_before(spark):
    texts = [(i, words_text(i % 30, i)) for i in range(200)]
    docs = documents(spark, texts)
    check(reshard(docs, 3, old_shard=F.col("doc_id") % 7).collect(), texts, 3)


def test_only_the_smallest_rows_move(spark):
    texts = [(i, "x" * (2 ** (i % 12))) for i in range(240)]
    rows = reshard(documents(spark, texts), 8, old_shard=F.col("doc_id") % 4).collect()
    for old in range(4):
        moved = sorted(r["size"] for r in rows if r["old_shard"] == old and r["shard"] != old)
        assert moved == sorted(r["size"] for r in rows if r["old_shard"] == old)[:len(moved)]


def test_small_cells_move_the_smallest_rows_too(spark, monkeypatch):
    """Bytes moved with many cells a block: as few as with one."""
    texts = [(i, "x" * (200 + i * 37 % 211)) for i in range(2000)] + [(5000, "same")] * 1500
    docs = documents(spark, texts)

    def moved():
        rows = reshard(docs, 8, old_shard=F.col("doc_id") % 5).collect()
        check(rows, texts, 8)
        return sum(r["size"] for r in rows if r["old_shard"] != r["shard"])

    whole = moved()
    monkeypatch.setattr(resharding, "CELL_ROWS", 10)
    assert moved() <= whole * (1 + 2 ** (0.5 / resharding.SIZE_STEPS) - 1)


def test_equal_rows_part(spark, monkeypatch):
    """Rows equal in id and text lie in many cells and still get gapless slots."""
    monkeypatch.setattr(resharding, "CELL_ROWS", 100)
    texts = [(1, "same")] * 3000
    seen = []
    real = resharding.stored

    def keep(df, name):
        seen.append(real(df, name))
        return seen[-1]

    monkeypatch.setattr(resharding, "stored", keep)
    check(reshard(documents(spark, texts), 4).collect(), texts, 4)
    cells = seen[0].groupBy(F.pmod(F.xxhash64("doc_id", "text_crc32", "number_given"), F.lit(30))).count().collect()
    assert len(cells) == 30 and max(r["count"] for r in cells) < 300


def test_rewritten_files_hold_the_new_shards(spark, tmp_dir):
    texts = [(i, words_text(i % 20, i)) for i in range(90)]
    docs = documents(spark, texts)
    places = reshard(docs, 4, old_shard=F.col("doc_id") % 3).cache()
    affected = rewrite_affected(docs, places, f"{tmp_dir}/shards")
    back = {(r["doc_id"], r["text"], r["shard"]) for r in spark.read.parquet(f"{tmp_dir}/shards").collect()}
    text = dict(texts)
    assert back == {(r["doc_id"], text[r["doc_id"]], r["shard"]) for r in places.collect() if r["shard"] in affected}


def test_rewritten_files_hold_null_and_repeated_ids(spark, tmp_dir):
    texts = AWKWARD + [(None, "a text without an id")] * 3 + [(3, "other text"), (3, None)] + [(50, "same")] * 7
    docs = documents(spark, texts)
    places = reshard(docs, 5).cache()
    affected = rewrite_affected(docs, places, f"{tmp_dir}/awkward")
    back = spark.read.parquet(f"{tmp_dir}/awkward").collect()
    moved = [r for r in places.collect() if r["shard"] in affected]
    assert Counter((r["shard"], r["slot"], r["doc_id"], zlib.crc32((r["text"] or "").encode())) for r in back) == Counter(
        (r["shard"], r["slot"], r["doc_id"], r["text_crc32"]) for r in moved)
    assert len(affected) < 5 or Counter((r["doc_id"], r["text"]) for r in back) == Counter(texts)


def test_rewritten_rows_keep_their_old_shard(spark, tmp_dir):
    """Copies of one row that differ in another column alone."""
    docs = documents(spark, [(1, "same")] * 12).withColumn("n_chars", F.monotonically_increasing_id() % 3).cache()
    old = F.col("n_chars") % 3
    places = reshard(docs, 4, old_shard=old).cache()
    affected = rewrite_affected(docs, places, f"{tmp_dir}/copies", old_shard=old)
    back = Counter(r["n_chars"] for r in spark.read.parquet(f"{tmp_dir}/copies").collect())
    assert back == Counter(r["old_shard"] for r in places.collect() if r["shard"] in affected)


def test_empty_table(spark):
    assert reshard(documents(spark, []), 4).count() == 0


def test_capacities_must_suffice(spark):
    with pytest.raises(ValueError):
        reshard(documents(spark, [(1, "a"), (2, "b")]), capacities=[1])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5), st.integers(1, 9), st.integers(1, 50)), min_size=1, max_size=10,
                unique_by=lambda b: b[:2]), st.integers(1, 6))
def test_flow_is_a_cheapest_plan(blocks, shards):
    blocks = [(s, c, n, n * w) for s, c, n, w in blocks]
    old = Counter()
    for s, _, n, _ in blocks:
        old[s] += n
    capacities = even_capacities(old, shards)
    lanes, cost = plan_transfers(blocks, capacities)
    placed = Counter()
    for *_, first, end, shard, _ in lanes:
        placed[shard] += end - first
    assert placed == Counter({s: c for s, c in enumerate(capacities) if c})
    # every old shard must give up its surplus; the cheapest rows go
    least = 0
    for s, n in old.items():
        surplus = n - (capacities[s] if s < shards else 0)
        rows = sorted(w // k for o, _, k, w in blocks if o == s for _ in range(k))
        least += sum(rows[:max(0, surplus)])
    assert cost == least


def test_flow_by_hand():
    net = FlowNetwork(4)
    cheap, dear = net.add(0, 1, 3, 1), net.add(0, 2, 5, 4)
    net.add(1, 3, 2), net.add(2, 3, 2), net.add(1, 2, 5, 1)
    assert net.solve(0, 3) == 2 * 1 + 1 * 2 + 1 * 4 and (net.flow(cheap), net.flow(dear)) == (3, 1)
