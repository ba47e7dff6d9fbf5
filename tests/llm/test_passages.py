import random

import numpy as np

from immolens.llm.hashing import mix64
from immolens.llm.passages import compact_windows, repeated_passages, without_passages

from llm_helpers import AWKWARD, documents, words, words_text


def test_compact_windows_partition_the_passages():
    """Every passage of at least `width` lies in exactly one window, and its
    minimum (the leftmost) is the window's centre."""
    rng = np.random.default_rng(0)
    for trial in range(30):
        lengths = rng.integers(0, 40, 4)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        values = mix64(rng.integers(0, 12, bounds[-1]).astype(np.uint64))        # with ties
        width = int(rng.integers(1, 12))
        found = list(zip(*(x.tolist() for x in compact_windows(values, bounds, width))))
        for a, b in zip(bounds[:-1], bounds[1:]):
            for i in range(a, b):
                for j in range(i + width - 1, b):
                    c = i + int(values[i:j + 1].argmin())
                    assert [w for w in found if w[0] <= i <= w[1] <= j <= w[2]] == [w for w in found if w[1] == c]
                    assert sum(w[1] == c for w in found) == 1


def planted():
    rng = random.Random(8)
    passage = [words_text(n, 700 + n) for n in (51, 60, 90, 200)]
    rows, n = list(AWKWARD), 100
    exact, near, short = [], [], []
    for k, p in enumerate(passage):
        for copy in range(6):
            w = p.split()
            if copy >= 4 and k >= 2:
                for _ in range(2):
                    w[rng.randrange(len(w))] = f"e{rng.random():.5f}"
                del w[len(w) // 3]
                near.append((n, k))
            else:
                exact.append((n, k))
            rows.append((n, " ".join([words_text(rng.randint(5, 90), 3 * n), *w, words_text(rng.randint(5, 90), 3 * n + 1)])))
            n += 1
    s = words_text(30, 4321)
    for _ in range(5):                                                     # too short to count
        rows.append((n, " ".join([words_text(60, 3 * n), s, words_text(60, 3 * n + 1)])))
        short.append(n)
        n += 1
    return rows, passage, exact, near, short


def test_planted_passages(spark):
    rows, passage, exact, near, short = planted()
    text = {i: words(t) for i, t in rows if i is not None}
    found = repeated_passages(documents(spark, rows)).collect()
    for r in found:
        assert r["source_id"] < r["doc_id"] and min(r["n_words"], r["source_words"]) >= 50
        x = text[r["doc_id"]][r["start_word"]:r["start_word"] + r["n_words"]]
        y = text[r["source_id"]][r["source_start"]:r["source_start"] + r["source_words"]]
        a, b = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (x, y))
        assert abs(len(a & b) / len(a | b) - r["similarity"]) < 1e-9 and r["similarity"] >= 0.75
    by_doc = {r["doc_id"] for r in found}
    first = {}
    for i, k in sorted(exact + near):
        if k in first:
            assert i in by_doc, (i, k)
        first.setdefault(k, i)
    assert not by_doc & set(short)
    assert 6 in by_doc and 7 not in by_doc and 2 not in by_doc             # 5 and 6 are copies


def test_cut_out(spark):
    rows, passage, exact, near, short = planted()
    docs = documents(spark, rows)
    found = repeated_passages(docs).cache()
    cut = without_passages(docs, found)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    kept = {r["doc_id"]: r["text"] for r in cut.collect() if r["doc_id"] is not None}
    whole = dict(rows)
    firsts = {}
    for i, k in exact:
        firsts.setdefault(k, i)
    for i, k in exact:
        if firsts[k] == i:
            assert passage[k] in kept[i]
        else:
            assert passage[k] not in kept[i] and len(kept[i]) < len(whole[i])
    assert all(kept[i] == whole[i] for i in short)


def test_empty_table(spark):
    assert repeated_passages(documents(spark, [])).count() == 0
    assert repeated_passages(documents(spark, [(1, None), (2, "a b")])).count() == 0


def test_holders_behind_fragments_and_variants(spark):
    """Many earlier documents hold too little of a passage, or too unlike a
    copy; the two that hold it whole are still found."""
    rng = random.Random(11)

    def fresh(n):
        return [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]

    rows, full = [], {}
    n = 10
    for k in range(6):
        p = fresh(52)
        for copy in range(60):
            at = copy % 5 * 3
            w = p[at:at + 40]                                              # a fragment
            if copy % 4 == 0:                                              # a variant: the rest, shuffled
                w = rng.sample(p[:at], at) + w + rng.sample(p[at + 40:], 12 - at)
            rows.append((n, " ".join([*fresh(60), *w, *fresh(60)])))
            n += 1
        for _ in range(2):
            rows.append((n, " ".join([*fresh(60), *p, *fresh(60)])))
            full.setdefault(k, []).append(n)
            n += 1
    found = {(r["source_id"], r["doc_id"]) for r in repeated_passages(documents(spark, rows)).collect()}
    assert set(map(tuple, full.values())) <= found


def test_recall_and_precision_against_brute_force(spark):
    """Planted passages of 50 words and more, with up to one edit in 60 words
    (also near an edge): every pair of documents with a passage is compared with
    a search of all alignments; at least 0.9 of the pairs' later documents are found."""
    rng = random.Random(5)

    def fresh(n):
        return [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]

    rows, holders = [], {}
    for k in range(25):
        p = fresh(rng.choice([50, 55, 62, 80, 130]))
        for copy in range(rng.randint(2, 4)):
            w = list(p)
            for e in range(len(p) // 60):
                w[rng.randrange(len(w))] = f"e{rng.random()}"
            rows.append((len(rows), " ".join([*fresh(rng.randint(0, 80)), *w, *fresh(rng.randint(0, 80))])))
            holders.setdefault(k, []).append(len(rows) - 1)
    for _ in range(10):                                                    # a line that is too short
        rows.append((len(rows), " ".join([*fresh(60), *"this line of twelve words stands in many documents of the table".split(), *fresh(60)])))
    found = repeated_passages(documents(spark, rows)).collect()
    whole = {b: g[0] for g in holders.values() for b in g[1:]}
    later = {r["doc_id"] for r in found}
    assert later <= set(whole) and len(later) >= 0.9 * len(whole)
    assert all(r["source_id"] in next(g for g in holders.values() if r["doc_id"] in g) for r in found)


def test_positions_outside_the_compared_range():
    """A passage that reaches far beyond the windows that met is found whole."""
    from immolens.llm.passages import common_passages
    rng = np.random.default_rng(3)
    shared = mix64(rng.integers(0, 2 ** 62, 3000).astype(np.uint64))
    a = np.concatenate([mix64(rng.integers(0, 2 ** 62, 500).astype(np.uint64)), shared])
    b = np.concatenate([mix64(rng.integers(0, 2 ** 62, 20).astype(np.uint64)), shared, shared[:7]])
    for lo in (500, 1700, 3499):
        assert [p[:4] for p in common_passages(a, b, [(-60, lo, lo)])] == [(500, 3500, 20, 3020)]
