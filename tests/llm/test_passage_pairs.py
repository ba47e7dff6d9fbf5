import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import immolens.llm.passages as passages
from immolens.llm.passages import MARGIN, common_passages, passages_of_pairs, repeated_passages

from llm_helpers import documents

_KIND = pa.list_(pa.struct([("diagonal", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())]))


def _variant(rng, a, edits):
    """A text like ``a`` with words replaced, lost, added, moved and repeated."""
    b = list(a)
    for _ in range(edits):
        at, kind = rng.randrange(len(b)), rng.random()
        if kind < 0.6:
            b[at] = rng.getrandbits(60)
        elif kind < 0.75:
            del b[at:at + rng.randint(1, 3)]
        elif kind < 0.9:
            b[at:at] = [rng.getrandbits(60) for _ in range(rng.randint(1, 3))]
        elif kind < 0.95:
            b[at:at] = b[max(0, at - 40):at]
        else:
            piece = b[at:at + 60]
            del b[at:at + 60]
            b[len(b) // 2:len(b) // 2] = piece
        if not b:
            b = [1]
    return b


def _cases(rng, n):
    for _ in range(n):
        alphabet = rng.choice([1 << 60, 1 << 60, 1 << 60, 40, 3])
        a = [rng.randrange(alphabet) for _ in range(rng.choice([0, 30, 60, 150, 400, 1200]))]
        b = _variant(rng, a, rng.choice([0, 2, len(a) // 30, len(a) // 8])) if a else []
        b = [rng.getrandbits(60) for _ in range(rng.choice([0, 0, 5, 70]))] + b
        spans = []
        for _ in range(rng.choice([1, 1, 1, 2, 4])):
            lo = rng.randrange(max(1, len(a)))
            spans.append((rng.choice([0, 0, 0, 1, -1, (len(b) - len(a)) // 8]), lo, min(lo + rng.choice([0, 20, 300]), max(0, len(a) - 1))))
        yield np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64), spans


def test_pairs_at_once_as_one_by_one():
    rng = random.Random(17)
    for group in (1, 7, 60):
        for _ in range(3 if group > 1 else 40):
            parts, texts, spans, offset, more, expected = [], [], [], [], [], []
            for a, b, own in _cases(rng, group):
                x = max(0, min(s[1] for s in own) - MARGIN) if rng.random() < 0.5 else 0
                z = min(len(a), max(s[2] for s in own) + MARGIN + 5) if rng.random() < 0.5 else len(a)
                for repeat in range(rng.choice([1, 1, 3])):                 # the same text of b several times in a row
                    part = a[x:max(x, z)]
                    spans += [(len(parts), *s) for s in own]
                    parts.append(part)
                    texts.append(b)
                    offset.append(x)
                    more.append(z < len(a))
                    expected.append(common_passages(part, b, own, x, x > 0, z < len(a)))
            bounds = np.append(0, np.cumsum([len(p) for p in parts]))
            (row, *columns), open_ = passages_of_pairs(np.concatenate(parts), bounds, texts, tuple(np.array(c, dtype=np.int64) for c in zip(*spans)),
                                                       np.array(offset, dtype=np.int64), np.array(more))
            got = [[] for _ in parts]
            for r, *p in zip(row.tolist(), *(c.tolist() for c in columns)):
                got[r].append(tuple(p))
            assert open_.tolist() == [e is None for e in expected]
            assert [sorted(g) for g in got] == [sorted(e or []) for e in expected]


def test_near_copies_are_not_compared_pair_by_pair(monkeypatch):
    """40 variants of one text: all pairs are verified, none on its own."""
    rng = random.Random(3)
    text = [f"w{rng.randrange(10 ** 9)}" for _ in range(300)]
    rows = []
    for k in range(40):
        own = list(text)
        for at in rng.sample(range(300), 4):
            own[at] = f"e{k}_{at}"
        rows.append(" ".join(own))
    pairs = [(a, b) for b in range(40) for a in range(b)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64()), pa.array([[{"diagonal": 0, "lo": 100, "hi": 150}]] * len(pairs), _KIND),
         pa.array([0] * len(pairs), pa.int32()), pa.array([False] * len(pairs)), pa.array([rows[a] for a, _ in pairs]), pa.array([rows[b] for _, b in pairs])],
        names=["a", "b", "diagonals", "offset", "more", "part", "text"])
    alone, calls = passages.common_passages, []
    monkeypatch.setattr(passages, "common_passages", lambda *x: calls.append(1) or alone(*x))
    found = [r for out in passages._verify_parts(iter([batch])) for r in out.to_pylist()]
    assert {(r["source_id"], r["doc_id"]) for r in found} == set(pairs) and not any(r["open"] for r in found)
    assert not calls


def test_repeated_ids_are_one_row(spark):
    ids = documents(spark, [(1, ""), (2, ""), (3, ""), (9, "")]).select("doc_id")
    docs = documents(spark, [(1, "b"), (1, "a"), (1, None), (2, "c"), (3, None), (3, None), (4, "d"), (5, "e"), (5, "f")]).select("doc_id", "text")
    got = passages._one_row(docs, F.broadcast(ids)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got if r["text"] is not None) == [(1, "a"), (2, "c")]
    assert sorted(r["doc_id"] for r in got) == [1, 2, 3]


def test_the_least_text_of_a_repeated_id_is_compared(spark):
    rng = random.Random(4)
    p = " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(80))
    found = repeated_passages(documents(spark, [(1, p), (2, p), (2, "z" + p), (3, "a b c"), (3, p)])).collect()
    assert [(r["doc_id"], r["source_id"], r["start_word"], r["n_words"]) for r in found if r["doc_id"] == 2] == [(2, 1, 0, 80)]
