import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from immolens.llm.packing import HarmonicBins, cut_lengths, pack, packed_digest
from immolens.llm.tokens import encoder, tokenizer_path

from llm_helpers import AWKWARD, documents


def reference_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZé'  \n\t\xa0\x85strelvmd09²½.!<|>endoftx日\U0001F600", max_size=40), min_size=1, max_size=6))
def test_ids_are_those_of_the_tokenizer(texts):
    assert [x.tolist() for x in encoder(tokenizer_path()).encode(texts)] == reference_ids(texts)


def test_special_token_and_documents(spark):
    texts = [r[0] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts += ["before <|endoftext|> after", "we'll 'tis ''s", ""]
    assert [x.tolist() for x in encoder(tokenizer_path()).encode(texts)] == reference_ids(texts)


@pytest.mark.parametrize("n", [1, 2, 31, 1023, 1024, 1025, 2047, 2048, 2049, 5000, 70_001])
def test_cuts_cover_the_document(n):
    cuts = cut_lengths(n, 2048)
    assert sum(cuts) == n and all(0 < c <= 2048 for c in cuts)


def check(rows, texts, seq_len=2048):
    """Every id lies in one piece, sequences are gapless and hold at most
    seq_len ids; returns the padded share."""
    expected = reference_ids([t or "" for _, t in texts])
    bins, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append((r["start"], bytes(r["ids"]), r["doc_tokens"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= seq_len
    wanted = defaultdict(list)
    for (i, _), ids in zip(texts, expected):
        wanted[i].append([*ids, 1])
    for i, pieces in docs.items():
        total = sum(len(p) // 4 for _, p, _ in pieces)
        assert total == sum(map(len, wanted[i]))
        if len(wanted[i]) == 1:
            joined = b"".join(p for _, p, _ in sorted(pieces))
            assert np.frombuffer(joined, "<u4").tolist() == wanted[i][0]
            assert {t for _, _, t in pieces} == {total}
    assert set(docs) == set(wanted)
    sizes = [sum(n for _, n in p) for p in bins.values()]
    padding = sum(seq_len - s for s in sizes if s & (s - 1))
    return padding / max(1, sum(sizes))


def test_awkward_texts(spark):
    rows = pack(documents(spark, AWKWARD)).collect()
    assert check(rows, AWKWARD) < 0.02


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert check(pack(docs).collect(), texts) < 0.01


def test_short_sequences(spark):
    rows = pack(documents(spark, AWKWARD), seq_len=64).collect()
    check(rows, AWKWARD, 64)


def test_class_holds_its_count():
    bins = HarmonicBins(100)
    full = [bins.add((0, 0, np.zeros(30), 30)) for _ in range(3)]
    assert full[:2] == [None, None] and len(full[2]) == 3


def test_digest_is_the_checksum_of_the_ids(spark):
    pieces = pack(documents(spark, AWKWARD[:4])).cache()
    crc = {(r["doc_id"], r["start"], r["sequence_id"]): zlib.crc32(bytes(r["ids"])) for r in pieces.collect()}
    for r in packed_digest(pieces).collect():
        assert r["ids_crc32"] == crc[r["doc_id"], r["start"], r["sequence_id"]]


def test_empty_table(spark):
    assert pack(documents(spark, [])).count() == 0
