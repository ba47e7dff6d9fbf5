"""Importance resampling against a plain-Python version of the contract."""

import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from llm_helpers import AWKWARD, documents, words_text

from immolens.llm import catalog
from immolens.llm.ngrams import NgramTable, crc32s, ngram_blocks, xxh64
from immolens.llm.resample import BUCKETS, bucket_counts, drawn_documents, importance_resample

SF = "/root/testdata/sf0.001"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER))


def features(text):
    w = words(text)
    return [b" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def counts(texts):
    c = Counter(crc32(f) % BUCKETS for t in texts for f in features(t))
    return [c[b] for b in range(BUCKETS)]


def plain(docs, target):
    """(doc_id, n_features, weight, score, rank) rows for (doc_id, text) rows."""
    s, t = counts(x for _, x in docs), counts(target)
    whole, aimed = sum(s), sum(t)
    gains = [math.floor(1000 * math.log((b + 1) * (whole + BUCKETS) / ((a + 1) * (aimed + BUCKETS)))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        f = features(text)
        weight = sum(gains[crc32(x) % BUCKETS] for x in f)
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, len(words(text)) >= 20])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = {id(r): k + 1 for k, r in enumerate(able[:5 * len(able) // 100])}
    return sorted(((r[0], *r[1:4], drawn.get(id(r))) for r in rows), key=str)


def collected(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert [t for _, t in df.dtypes] == ["bigint"] * 5
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    target = [r["text"] for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    assert collected(catalog.QUERIES["op13_importance_resampling"](spark, SF)) == plain(docs, target)


def test_awkward_rows_ties_and_repeats(spark):
    docs = AWKWARD + [(100 + i, words_text(30, i)) for i in range(60)] + [(130, words_text(30, 9))] * 5 \
        + [(None, words_text(25, 3))] * 2 + [(200, "A1b2 É2, x" + "y" * 300 + " z" * 30), (201, "wort" * 100_000 + " w" * 40)]
    target = [words_text(30, 2), None, "", "One two. THREE"]
    found = importance_resample(documents(spark, docs), documents(spark, [(0, t) for t in target]))
    assert collected(found) == plain(docs, target)


def test_whole_table_drawn_in_order(spark):
    docs = [(i, words_text(30 + i % 3, i % 40)) for i in range(400)]
    found = importance_resample(documents(spark, docs), documents(spark, [(0, words_text(50, 1))]), per_hundred=100)
    rows = sorted(found.collect(), key=lambda r: r.rank)
    assert [r.rank for r in rows] == list(range(1, 401))
    assert rows == sorted(rows, key=lambda r: (-r.score, r.doc_id))


def test_empty_tables_and_carried_columns(spark):
    none, some = documents(spark, []), documents(spark, [(i, words_text(40, i)) for i in range(40)])
    assert importance_resample(none, some).count() == 0
    assert importance_resample(some, none).where("rank is not null").count() == 2
    drawn = drawn_documents(some, none, carry=["text", "kind"]).collect()
    assert sorted(r.rank for r in drawn) == [1, 2] and all(r.text == words_text(40, r.doc_id) for r in drawn)
    with pytest.raises(ValueError):
        importance_resample(some, none, carry=["score"])


def test_counts_do_not_depend_on_partitions(spark):
    docs = documents(spark, AWKWARD)
    assert bucket_counts(docs).tolist() == bucket_counts(docs.repartition(7)).tolist() == counts(t for _, t in AWKWARD)


def test_blocks_within_a_text(monkeypatch):
    monkeypatch.setattr("immolens.llm.ngrams.BLOCK_WORDS", 7)
    texts = [words_text(50, 1), None, "a b", "", words_text(20, 2)]
    got = np.zeros(BUCKETS, dtype=np.int64)
    for _, _, blocks in ngram_blocks(pa.array(texts), range(1, 4), BUCKETS):
        for block in blocks:
            np.add.at(got, block.table.bucket, block.table.count)
    assert got.tolist() == counts(texts)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=130), min_size=1, max_size=30))
def test_hashes(slices):
    buffer = np.frombuffer(b"".join(slices) + bytes(8), dtype=np.uint8)
    lengths = np.array([len(s) for s in slices])
    starts = np.cumsum(lengths) - lengths
    assert xxh64(buffer, starts, lengths).tolist() == [xxhash.xxh64_intdigest(s) for s in slices]
    assert crc32s(buffer, starts, lengths).tolist() == [crc32(s) for s in slices]


@pytest.mark.parametrize("key", [lambda s: 5, lambda s: len(s), lambda s: s[0]], ids=["one", "length", "byte"])
def test_equal_keys_of_different_bytes_get_slots_of_their_own(key):
    slices = [bytes([97 + i % 5]) * (1 + i % 40) for i in range(300)] + [b"q" * 200, b"q" * 199 + b"r", b"q" * 200]
    buffer = np.frombuffer(b"".join(slices) + bytes(8), dtype=np.uint8)
    lengths = np.array([len(s) for s in slices])
    starts = np.cumsum(lengths) - lengths
    found = NgramTable(buffer, starts, lengths, 1000, np.array([key(s) for s in slices], dtype=np.uint64))
    ids = found.slot_ids.tolist()
    assert len(set(ids)) == len(set(slices)) == len(set(zip(ids, slices)))
    assert [int(found.count[i]) for i in ids] == [slices.count(s) for s in slices]
    assert [int(found.bucket[i]) for i in ids] == [crc32(s) % 1000 for s in slices]
