import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from immolens.llm import ppm

from llm_helpers import AWKWARD, documents, words, words_text


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


class BruteModel:
    def __init__(self, texts):
        self.next = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
        for t in texts:
            b = self.framed(t)
            for k in range(ppm.ORDER, len(b)):
                for o in range(ppm.ORDER + 1):
                    self.next[o][b[k - o:k]][b[k]] += 1

    @staticmethod
    def framed(text):
        return b"\xfe" * ppm.ORDER + (text or "").encode() + b"\xff"

    def symbol(self, context, s):
        out, cost = set(), 0.0
        for o in range(ppm.ORDER, -1, -1):
            seen = {k: v for k, v in self.next[o][context[ppm.ORDER - o:]].items() if k not in out}
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if s in seen:
                return cost + math.log10(seen[s] / total)
            cost += math.log10(len(seen) / total)
            out |= set(seen)
        return cost - math.log10(255 - len(out))

    def score(self, text):
        b = self.framed(text)
        return sum(self.symbol(b[k - ppm.ORDER:k], b[k]) for k in range(ppm.ORDER, len(b)))


def check(spark, rows, chunk_bytes):
    got = ppm.ppm_scores(documents(spark, rows), chunk_bytes=chunk_bytes).collect()
    train = [t for i, t in rows if not held(i)]
    model, count = BruteModel(train), Counter()
    for t in train:
        count.update(words(t))
    n, v = sum(count.values()) + len(train), len(count) + (len(train) > 0)
    expected = []
    for i, t in rows:
        w = words(t)
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w) + math.log10((len(train) + 1) / (n + v + 1))
        expected.append((str(i), held(i), len(w) + 1, sum(count[x] > 0 for x in w) + (len(train) > 0), n, base, model.score(t)))
    key = lambda r: (r[0], r[2], r[6])
    got = sorted(((str(r["doc_id"]), *tuple(r)[1:]) for r in got), key=key)
    for a, b in zip(got, sorted(expected, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-6)


def test_against_brute_force(spark):
    rows = [r for r in AWKWARD if not r[1] or len(r[1]) < 10_000] + [(100 + k, words_text(40 + k, k) + " Zé"[: k % 4]) for k in range(60)]
    check(spark, rows, 1 << 10)


def test_long_text(spark):
    check(spark, [(4, AWKWARD[5][1]), (9, "held out?"), (None, "w")], 1 << 20)


def test_without_training_rows(spark):
    ids = [i for i in range(200) if held(i)][:3]
    check(spark, [(i, t) for i, t in zip(ids, ["abc", None, "é"])], 1 << 20)


def test_empty_table(spark):
    assert ppm.ppm_scores(documents(spark, [])).count() == 0


def test_probabilities_of_a_context_add_up():
    rng = np.random.default_rng(0)
    for _ in range(20):
        chain = [rng.poisson(p, 256).astype(float) for p in (0.01, 0.1, 0.5, 2)]
        for c in chain:
            c[ppm.START] = 0
        total = 10.0 ** ppm.context_costs(chain)
        assert total[ppm.START] == 0 and total.sum() <= 1 + 1e-9


def test_repeated_texts_are_easier(spark):
    rows = [(k, words_text(100, 1)) for k in range(40)] + [(1000, "zzzz qqqq " * 60)]
    got = {r["doc_id"]: r["score"] / len(dict(rows)[r["doc_id"]]) for r in ppm.ppm_scores(documents(spark, rows)).collect()}
    assert got[0] > got[1000] or held(1000) is False


def test_the_fourth_byte_back_counts(spark):
    """After a common three bytes the byte before them decides the next one."""
    train = [i for i in range(400) if not held(i)][:200]
    rows = [(i, "abcdX" if k % 2 else "zbcdY") for k, i in enumerate(train)] + [(i, "zbcdX") for i in range(400, 440) if held(i)]
    got = defaultdict(list)
    for r in ppm.ppm_scores(documents(spark, rows)).collect():
        got[r["held_out"]].append(r["score"])
    assert min(got[False]) > math.log10(0.4)               # the first byte is even, the rest nearly certain
    assert max(got[True]) < min(got[False]) - 1


def test_rows_that_repeat_very_often(spark):
    """Scored once, listed as often as they occur, also without id or text."""
    often = [(7, "again and again")] * 5000 + [(None, "again and again")] * 1200 + [(8, None)] * 1100
    rows = often + [(7, "another text")] * 3 + [(i, words_text(20, i)) for i in range(20, 40)]
    check(spark, rows, 1 << 10)


def test_counts_of_very_frequent_words_are_exact(spark):
    n = 60_001
    train = [i for i in range(400) if not held(i)][:200]
    docs = spark.createDataFrame([(i,) for i in [*train, *[k for k in range(400) if held(k)][:1]]], "doc_id long")
    docs = docs.selectExpr("doc_id", f"case when crc32(cast(doc_id as string)) % 7 = 2 then 'w w v' else repeat('w ', {n}) end as text")
    count, kinds = n * len(train), 2
    assert count > 1e7
    total = math.log10(count + len(train) + kinds + 1)
    for r in ppm.ppm_scores(docs).collect():
        ends = math.log10(len(train) + 1) - total
        words_ = 2 * (math.log10(count + 1) - total) + math.log10(1) - total if r["held_out"] else n * (math.log10(count + 1) - total)
        assert r["base_score"] == pytest.approx(words_ + ends, rel=1e-10)
        assert r["train_tokens"] == count + len(train)


def test_words_are_answered_by_their_counts(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(ppm, "stored", lambda df, name: kept.setdefault(name, df.localCheckpoint()))
    rows = [(i, "one two two three") for i in range(30)]
    got = ppm.ppm_scores(documents(spark, rows)).collect()
    taught = sum(not r["held_out"] for r in got)
    values = sorted(r["value"] for r in kept["values"].where("key < 0").collect())
    assert values == [taught, taught, 2 * taught]
    assert all(abs(r["base_score"] - (2 * math.log10(taught + 1) + 2 * math.log10(2 * taught + 1) + math.log10(taught + 1)
                                      - 5 * math.log10(5 * taught + 4 + 1))) < 1e-9 and r["n_known"] == 5 for r in got)
