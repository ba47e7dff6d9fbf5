"""Periodic runs against a brute-force search over all periods."""

import hashlib
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st
from llm_helpers import AWKWARD, documents, words_text

from immolens.llm import catalog, runs as runs_module
from immolens.llm.grammar import Names, build_grammar, derivation
from immolens.llm.runs import merged, planted_periods, runs_digest, runs_of, with_periodic_runs
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def brute(w):
    """(start, end, period) of all runs: every period, least period first."""
    found = {}
    ids = np.unique(np.array(w, dtype=object), return_inverse=True)[1] if len(w) else np.zeros(0)
    for q in range(1, len(w) // 2 + 1):
        equal = ids[:-q] == ids[q:]
        if not equal.any():
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], equal.view(np.int8), [0]])))
        for i, j in edges.reshape(-1, 2).tolist():
            if j - i >= q and j - i + q >= 12:
                found.setdefault((i, j + q), q)
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def plant(doc_id, w):
    if doc_id is None:
        return w
    h = crc32(str(doc_id).encode())
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def digest(doc_id, w):
    found = brute(w)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    best = min(((s - e, s, q) for s, e, q in found), default=(None, None, None))
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), best[1], None if not found else -best[0], best[2],
            None if not found else 1000 * -best[0] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def joined(texts):
    ids, expected = [], []
    for w in texts:
        expected += [(s + len(ids), e + len(ids), q) for s, e, q in brute(w)]
        ids += [*w, -1]
    return np.array(ids, dtype=np.int64), expected


def found_in(ids, terminals):
    return list(zip(*(c.tolist() for c in runs_of(ids, terminals))))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 6), st.lists(st.integers(0, 3), max_size=9)), max_size=4))
def test_runs_equal_brute_force(parts):
    ids, expected = joined([block * times + rest + block for block, times, rest in parts])
    assert found_in(ids, 4) == expected


@pytest.mark.parametrize("text", [
    [0] * 300, [0, 1] * 100 + [0], [0, 1, 2, 3, 4, 5, 6] * 20 + [0, 1, 2], [0] * 11, [0] * 12, list(range(6)) * 2, list(range(7)) * 2,
    list(range(5)) * 2 + [9], ([0, 1] * 8 + [2]) * 5, [*range(40)] * 3 + [1] * 30 + [*range(40)] * 3,
], ids=range(10))
def test_planted_runs(text):
    ids, expected = joined([text, [7, 8], text, []])
    assert found_in(ids, 50) == expected


def test_fibonacci_and_thue_morse_words():
    fib, nxt, thue = [0], [0, 1], [0]
    while len(nxt) < 400:
        fib, nxt = nxt, nxt + fib
    while len(thue) < 512:
        thue = thue + [1 - x for x in thue]
    ids, expected = joined([nxt, thue])
    assert found_in(ids, 2) == expected


def test_few_rounds_and_small_blocks_give_the_same(monkeypatch):
    ids, expected = joined([[0, 1, 2] * 40 + [3] * 50 + [0, 1] * 30] * 2)
    monkeypatch.setattr("immolens.llm.grammar.MAX_ROUNDS", 1)
    monkeypatch.setattr(runs_module, "MAX_PAIRS", 3)
    assert found_in(ids, 4) == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=60), max_size=5))
def test_grammar_derives_the_texts(texts):
    ids = np.array([x for t in texts for x in [*t, -1]], dtype=np.int64)
    g = build_grammar(ids, 4)

    def expand(symbol):
        out, todo = [], [symbol]
        while todo:
            x = todo.pop()
            if x < 4:
                out.append(x)
            else:
                todo += [int(g.right[x - 4]), int(g.left[x - 4])]
        return out

    assert [expand(r) for r in g.roots] == [t for t in texts if t]
    assert len(set(zip(g.left.tolist(), g.right.tolist()))) == len(g.left)
    symbols, places = derivation(g, 2)
    assert all(ids[p:p + g.length[x]].tolist() == expand(x) for x, p in zip(symbols, places))


def test_repeated_text_is_one_nonterminal():
    block = list(range(30))
    g = build_grammar(np.array((block + [-1]) * 50), 30)
    assert len(set(g.roots.tolist())) == 1 and len(g.left) < 60


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=50), st.data())
def test_common_words(w, data):
    ids = np.array([*w, -1, *w, -1], dtype=np.int64)
    x = data.draw(st.integers(0, len(w) - 1))
    y = data.draw(st.integers(x, len(w) - 1))
    limit = len(w) - y
    want = next((k for k in range(limit) if w[x + k] != w[y + k]), limit)
    back = next((k for k in range(x + 1) if w[x - k] != w[y - k]), x + 1)
    names, at = Names(ids), len(w) + 1
    assert names.common(np.array([x]), np.array([y + at]), np.array([limit])) == [want]
    assert names.common(np.array([x]), np.array([y + at]), np.array([x + 1]), back=True) == [back]


def test_pieces_merge():
    s, e, q = (np.array(c) for c in zip((0, 20, 2), (15, 40, 2), (38, 60, 2), (59, 80, 2), (0, 20, 4), (100, 120, 5)))
    assert list(zip(*(c.tolist() for c in merged(s, e, q)))) == [(0, 60, 2), (0, 20, 4), (59, 80, 2), (100, 120, 5)]


def check(spark, rows):
    docs = documents(spark, rows).withColumn("text", planted_periods(F.col("doc_id"), F.col("text")))
    got = sorted(map(tuple, runs_digest(with_periodic_runs(docs)).collect()), key=str)
    assert got == sorted((digest(i, plant(i, words(t))) for i, t in rows), key=str)


def test_awkward_rows(spark):
    tens = [i for i in range(400) if crc32(str(i).encode()) % 10 == 0][:12]
    line = "the same line again with eight words "
    check(spark, AWKWARD + [(i, words_text(3 + 37 * k, k)) for k, i in enumerate(tens)]
          + [(1001, line * 30), (1002, "x " * 500 + line * 3 + "y " * 40), (1003, "été x " * 20 + "\x1c " * 15), (1004, "w" * 100_000 + " w" * 30),
             (tens[0], ""), (tens[1], "  "), (tens[2], "one"), (tens[3], None)])


def test_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(runs_module, "CHUNK_BYTES", 60)
    texts = ["a b " * 20, None, "", "c " * 30, words_text(50, 1) + " d" * 15, " "]
    [part] = runs_module._find([pa.array(texts)])
    for got, text in zip(part.to_pylist(), texts):
        found = brute(words(text))
        assert [(r["start"], r["start"] + r["length"], r["period"]) for r in got["runs"]] == found


def test_empty_table_and_other_columns(spark):
    none = with_periodic_runs(documents(spark, []))
    assert none.count() == 0 and {"start", "length", "runs", "collapsed"} <= set(none.columns)
    some = documents(spark, [(1, "z " * 20)]).withColumn("runs", F.lit("old")).withColumn("_x", F.lit(3))
    [row] = with_periodic_runs(some).collect()
    assert row.collapsed == "z" and [tuple(r) for r in row.runs] == [(0, 20, 1)] and row._x == 3


def test_query_equals_brute_force(spark):
    rows = catalog.QUERIES["op11_grammar_runs"](spark, SF)
    assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in rows.dtypes] == ["bigint"] * 6 + ["string"] * 2
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    expected = sorted((digest(r["doc_id"], plant(r["doc_id"], words(r["text"]))) for r in docs), key=str)
    assert sorted((tuple(r) for r in rows.collect()), key=str) == expected
