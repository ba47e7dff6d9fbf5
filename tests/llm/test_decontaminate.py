import math
import random
from collections import Counter

import pytest

from immolens.llm import decontaminate as dc

from llm_helpers import AWKWARD, documents, words, words_text

ITEMS = "item_id long, text string, doc_id long, similarity double"


def items_table(spark, items):
    return spark.createDataFrame([(i, t, 1, 0.5) for i, t in items], ITEMS)


def runs(w, size):
    return [b" ".join(w[i:i + size]) for i in range(len(w) - size + 1)]


def brute(docs, items):
    """Best weighted Jaccard similarity over all item-sized windows."""
    sized = [(i, words(t)) for i, t in items]
    sets = [runs(w, min(5, len(w))) if w else [] for _, w in sized]
    df = Counter(s for x in sets for s in set(x))

    def weight(s):
        return math.log1p(len(items) / max(1, df[s]))

    found = {}
    for d, t in docs:
        w = words(t)
        for (i, iw), x in zip(sized, sets):
            own = set(x)
            if not own:
                continue
            g = runs(w, min(5, len(iw)))
            span = min(len(x), len(g))
            best = 0.0
            for s in range(len(g) - span + 1) if set(g) & own else []:
                win = set(g[s:s + span])
                both = sum(map(weight, win & own))
                best = max(best, both / (sum(map(weight, win)) + sum(map(weight, own)) - both))
            if best >= 0.75:
                found[d, i] = max(best, found.get((d, i), 0))
    return found


def cases():
    rng = random.Random(6)
    items = [(k, words_text(rng.randint(6, 40), 900 + k)) for k in range(25)]
    items += [(100, items[0][1]), (101, None), (102, ""), (103, "uniq1 uniq2"), (104, items[3][1] + " tail of words")]
    docs = list(AWKWARD)
    n = 1000
    for k, t in items[:25]:
        w = t.split()
        for edits in (0, 0, 1, 2, 4):
            v = list(w)
            for _ in range(edits):
                v[rng.randrange(len(v))] = f"e{rng.random():.5f}"
            docs.append((n, " ".join([words_text(rng.randint(0, 60), n), *v, words_text(rng.randint(0, 60), n + 1)])))
            n += 1
        docs.append((n, " ".join(w[: len(w) // 2])))
        n += 1
    docs += [(n, "we say UNIQ1  uniq2 here"), (n + 1, "uniq2 uniq1"), (n + 2, " ".join([items[1][1]] * 30))]
    return docs, items


def test_against_brute_force(spark):
    docs, items = cases()
    docs = [(i, t) for i, t in docs if t is None or len(t) < 100_000]
    rows = dc.contaminations(documents(spark, docs), items_table(spark, items)).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows}
    expected = brute(docs, items)
    assert set(got) == set(expected)
    assert all(got[k] == pytest.approx(expected[k], abs=1e-5) for k in expected)


@pytest.mark.parametrize("before", [0, 23])
def test_templated_items(spark, before):
    """Items that share all words but one: every pair of a document and an
    item above the similarity is found, whatever the distance."""
    template = words_text(56, 4).split()
    items = [(k, " ".join([*template, f"own{k}"])) for k in range(60)]
    items += [(70, " ".join(["again and", *["again and"] * 8, "once more"])), (71, " ".join(["so it goes"] * 12))]
    docs = [(100 + k, " ".join([words_text(before, 50 + k), *template, f"{'own' if k % 2 else 'new'}{k}", words_text(20, 90 + k)])) for k in range(24)]
    docs += [(200, " ".join(["again and"] * 30)), (201, " ".join(["so it goes"] * 11) + " with other words"), (202, items[0][1] + " " + " ".join(["so it goes"] * 12))]
    rows = dc.contaminations(documents(spark, docs), items_table(spark, items)).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows}
    expected = brute(docs, items)
    assert set(got) == set(expected) and len(expected) > 24 * 60 - 1
    assert any(r["distance"] > dc.RADIUS for r in rows)
    assert all(got[k] == pytest.approx(expected[k], abs=1e-5) for k in expected)


def test_windows_that_repeat_a_shingle():
    import numpy as np

    rng = np.random.default_rng(3)
    for n, span in ((1, 1), (5, 5), (200, 7), (300, 40)):
        shingles = rng.integers(0, 90, n).astype(np.uint64)
        expected = [len(set(shingles[s:s + span].tolist())) < span for s in range(n - span + 1)]
        assert dc._repeating(shingles, span).tolist() == expected


def test_several_passes_weigh_alike(spark, monkeypatch):
    docs, items = cases()

    def found():
        return {(r["doc_id"], r["item_id"]): r["similarity"] for r in dc.contaminations(documents(spark, docs), items_table(spark, items)).collect()}

    whole = found()
    monkeypatch.setattr(dc, "ITEMS_PER_PASS", 7)
    assert found() == whole
    kept = dc.decontaminated(documents(spark, docs), items_table(spark, items))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - {d for d, _ in whole}


def test_clean_documents_stay_with_all_columns(spark):
    docs, items = cases()
    table = documents(spark, docs)
    hit = {r["doc_id"] for r in dc.contaminations(table, items_table(spark, items)).collect()}
    kept = dc.decontaminated(table, items_table(spark, items))
    assert kept.columns == table.columns
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect()) == sorted((str(i), t or "") for i, t in docs if i not in hit)


def test_empty_tables(spark):
    docs = documents(spark, AWKWARD)
    assert dc.contaminations(docs, items_table(spark, [])).count() == 0
    assert dc.decontaminated(docs, items_table(spark, [])).count() == len(AWKWARD)
    assert dc.contaminations(documents(spark, []), items_table(spark, [(1, "a b c d e f")])).count() == 0


def test_multi_index_holds_everything_within_the_radius():
    import numpy as np

    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (4000, 8), dtype=np.uint8)
    flips = rng.integers(0, dc.RADIUS + 1, 4000)
    b = a.copy()
    for r, n in enumerate(flips):
        for bit in rng.choice(64, n, replace=False):
            b[r, bit // 8] ^= 1 << (bit % 8)
    assert dc._NEAR_VALUES[a, b].any(axis=1).all()
