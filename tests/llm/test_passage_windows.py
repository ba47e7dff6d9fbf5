"""The first exchange of the passages: windows packed by bucket of their key."""

import random

import numpy as np
import pyarrow as pa

from immolens.llm import passages as P
from immolens.llm.passages import repeated_passages
from immolens.llm.words import shingle_hashes, word_chunks

from llm_helpers import documents


def _texts():
    r = np.random.default_rng(3)
    line = " ".join(f"s{i}" for i in range(90))
    return [(i * 3 - 5, " ".join(f"w{r.integers(0, 5000)}" for _ in range(150)) + (" " + line if i % 4 == 0 else "")) for i in range(40)] + [(1000, None), (1001, "few words")]


def _windows(rows):
    """(key, doc, at) of every window, one document at a time."""
    for doc, text in rows:
        for chunk in word_chunks(pa.array([text or ""])):
            shingles = shingle_hashes(chunk.hashes)
            found = P._window_keys(shingles, np.array([0, len(shingles)]))
            for key, c, left, right in zip(*found) if found else ():
                yield int(key.astype(np.int64)), doc, int(P._pack(c, left, right))


def test_windows_meet_as_they_do_one_by_one_and_travel_many_to_a_row(spark, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(P, "_CHUNK", 6000)
    rows = _texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    by_key = {}
    for key, doc, at in _windows(rows):
        by_key.setdefault(key, []).append((doc, at))
    want = {(key, doc, at) for key, held in by_key.items() if len({d for d, _ in held}) > 1 for doc, at in held}
    got = [tuple(r) for r in P.crowded_windows(docs).collect()]
    assert len(want) > 100 and {r[:3] for r in got} == want and len(got) == len(set(got))
    assert all((r[3], r[4]) in by_key[r[0]] and r[3] <= r[1] for r in got)
    for key in {r[0] for r in got}:                                   # all are led to the smallest document
        least = min(d for d, _ in by_key[key])
        led = {r[1]: r[3] for r in got if r[0] == key}
        for doc in led:
            while led[doc] != doc:
                doc = led[doc]
            assert doc == least
    windows = sum(len(h) for h in by_key.values())
    assert P.window_blobs(docs, 7).count() < windows / 5


def test_an_empty_table_has_no_windows(spark):
    assert P.crowded_windows(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_runs_of_a_period_are_cut_down_without_losing_a_passage():
    """Texts with runs of periods up to 52 words: every 50 words in a row, and
    every shingle, that the text holds is in the shortened one too."""
    rng = random.Random(1)
    cut = 0
    for _ in range(60):
        texts = []
        for _ in range(4):
            w = []
            for _ in range(rng.randrange(5)):
                unit = [rng.randrange(1000) for _ in range(rng.randrange(1, 53))]
                w += (unit * 400)[:rng.randrange(1, 400)] if rng.random() < .6 else [rng.randrange(1000) for _ in range(rng.randrange(200))]
            texts.append(w)
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in texts])])
        words_ = np.array(sum(texts, []), dtype=np.uint64)
        kept = P._without_long_runs(words_, bounds)
        cut += len(words_) - len(kept)
        for w, p, q in zip(texts, *(lambda e: (e[:-1], e[1:]))(np.searchsorted(kept, bounds))):
            short = words_[kept[p:q]].tolist()
            for n in (5, 50):
                assert {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} == {tuple(short[i:i + n]) for i in range(len(short) - n + 1)}
    assert cut > 1000


def test_texts_of_repeated_words_meet_at_few_places(spark):
    """Documents made of long runs of the same words, between words of their
    own: the places where pairs are compared stay few for each document, and
    each run of at least 50 words that an earlier document holds is found
    whole; shorter runs are not passages."""
    rng = random.Random(4)

    def fresh(n):
        return [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]

    rows, runs = [], {}
    for i in range(40):
        w = fresh(20)
        for word in rng.sample(["the", "are", "of a", "und"], 3):
            n = rng.choice([30, 40, 120, 300, 700])
            run = (word.split() * n)[:n]
            runs.setdefault((word, n >= 50), []).append((i, len(w), n))
            w += run + fresh(20)
        rows.append((i, " ".join(w)))
    docs = documents(spark, rows)
    crowded = P.crowded_windows(docs).cache()
    assert crowded.count() < 40 * 3 * 2 * 2 * 8
    pairs = P.candidate_pairs(crowded).cache()
    found_first, _ = P._verified(pairs, docs)
    done = P._diagonals(pairs)
    more = P.open_pairs(crowded, P.open_windows(crowded, found_first), done)
    places = [sum(len(r["diagonals"]) for r in p.collect()) for p in (pairs, more)]
    assert sum(places) < 40 * 30, places
    found = repeated_passages(docs).collect()
    text = {i: t.split() for i, t in rows}
    for r in found:
        x = text[r["doc_id"]][r["start_word"]:r["start_word"] + r["n_words"]]
        y = text[r["source_id"]][r["source_start"]:r["source_start"] + r["source_words"]]
        a, b = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (x, y))
        assert min(len(x), len(y)) >= 50 and abs(len(a & b) / len(a | b) - r["similarity"]) < 1e-9
    for (word, long), held in runs.items():
        for i, at, n in held[1:]:
            inside = [r for r in found if r["doc_id"] == i and r["start_word"] <= at + 2 and r["start_word"] + r["n_words"] >= at + n - 2]
            assert bool(inside) == long, (word, i, at, n)
