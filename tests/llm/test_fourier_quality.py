import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from immolens.llm.quality import (STATS, FourierFeatures, accepted_documents, document_stats, isotonic, normal_equations, quality_scores)

from llm_helpers import AWKWARD, documents, words_text

LABELS = "doc_id long, quality int, toxic int, label int"


def labels_table(spark, rows):
    return spark.createDataFrame([(i, q, 0, 1) for i, q in rows], LABELS)


def corpus(n=600):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = words_text(rng.randint(30, 200), i).capitalize() + "."
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), " ".join(w + "###" for w in text.split()), " ".join([text.split()[0]] * 80)])
        docs.append((i, text))
        labels.append((i, int(good)))
    return docs, labels


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy_and_columns(spark):
    docs, labels = corpus()
    docs += [(i if i is None else i + 10_000, t) for i, t in AWKWARD]
    rows = quality_scores(documents(spark, docs), labels_table(spark, labels)).collect()
    assert len(rows) == len(docs)
    truth = dict(labels)
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    right = [r["predicted"] == truth[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean(right) > 0.93


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = corpus(300)
    flipped = [(i, 1 - q if held_out(i) else q) for i, q in labels]
    a = {r["doc_id"]: r["score"] for r in quality_scores(documents(spark, docs), labels_table(spark, labels)).collect()}
    b = {r["doc_id"]: r["score"] for r in quality_scores(documents(spark, docs), labels_table(spark, flipped)).collect()}
    assert a == pytest.approx(b)


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(i, 1) for i in range(9)], 1.0), ([(i, None) for i in range(9)] + [(None, 0)], 0.5)])
def test_too_few_labels(spark, labels, score):
    rows = quality_scores(documents(spark, AWKWARD), labels_table(spark, labels)).collect()
    assert len(rows) == len(AWKWARD) and {r["score"] for r in rows} == {score}


def test_few_labels_of_both_classes_and_empty_table(spark):
    docs, labels = corpus(12)
    labels = [(i, i % 2) for i, _ in labels]
    assert quality_scores(documents(spark, docs), labels_table(spark, labels + labels)).count() == 12
    assert quality_scores(documents(spark, []), labels_table(spark, labels)).count() == 0


def test_accepted_documents_agree_with_the_scores(spark):
    docs, labels = corpus(300)
    table = documents(spark, docs)
    kept = accepted_documents(table, labels_table(spark, labels))
    good = {r["doc_id"] for r in quality_scores(table, labels_table(spark, labels)).where("predicted = 1").collect()}
    assert kept.columns == table.columns and {r["doc_id"] for r in kept.collect()} == good


def test_normal_equations_are_those_of_numpy(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(500, STATS)), rng.integers(0, 2, 500)
    features = FourierFeatures(np.zeros(STATS), np.ones(STATS), 16)
    rows = spark.createDataFrame([([float(v) for v in np.float32(a)], int(b)) for a, b in zip(x, y)], "stats array<float>, label int").repartition(7)
    zz, zy = normal_equations(rows, features)
    z = features(np.float32(x).astype(float))
    assert np.allclose(zz, z.T @ z) and np.allclose(zy, z.T @ y)


def test_fourier_features_approximate_the_kernel():
    from immolens.llm.quality import BANDWIDTH

    rng = np.random.default_rng(1)
    features = FourierFeatures(np.zeros(8), np.ones(8), 20_000)
    x = rng.normal(size=(20, 8))
    z = features(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * BANDWIDTH ** 2))
    assert np.abs(z @ z.T - kernel).max() < 0.05


def test_isotonic():
    at, means, least = isotonic(np.array([3.0, 1.0, 2.0, 4.0]), np.array([0.0, 0.0, 1.0, 1.0]))
    assert means.tolist() == [0, 0.5, 1] and least.tolist() == [1, 2, 4] and (np.diff(at) > 0).all()


def test_statistics_of_texts():
    texts = ["", "AB ab AB\nab 12!!\nab 12!!", None]
    s = document_stats(pa.array(texts))
    assert s.shape == (3, STATS) and not s[0].any() and not s[2].any()
    assert s[1, 1] == pytest.approx(np.log1p(7)) and s[1, 4] == pytest.approx(2 / 7) and s[1, 13] == pytest.approx(2 / 3)
    joined = document_stats(pa.array(texts * 50))
    assert np.array_equal(joined, np.tile(s, (50, 1)))
