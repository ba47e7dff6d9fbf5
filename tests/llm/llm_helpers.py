"""Small corpora with the awkward cases, and brute-force versions."""

import re

from pyspark.sql import types as T

# Extra columns whose names clash with those the operators use inside.
EXTRA = ["start", "length", "key", "n", "a", "b", "chunk", "registers", "score", "kind", "stats", "rank"]

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in EXTRA]])


def documents(spark, rows):
    """A documents table of (doc_id, text) with extra columns."""
    full = [(i, t, None if k % 3 else "en", "src0", None if t is None else len(t), *([None if k % 2 else "x"] * len(EXTRA)))
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS)


def words_text(n, seed=0):
    """``n`` words of a small invented vocabulary."""
    x, out = seed * 7919 + 17, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("wa ke tol rim sen dop" .split()[x >> 8 & 3] + "abcdefghijklmnop"[x >> 12 & 15] + "lmnr"[x >> 20 & 3])
    return " ".join(out)


LONG = words_text(40_000, 5)

AWKWARD = [
    (0, None), (1, ""), (2, " \n\t "), (3, "one two three"), (3, "one two three"), (4, LONG), (5, words_text(80, 1)),
    (6, words_text(80, 1)), (7, words_text(80, 2)), (None, "a text without an id"), (None, None), (8, "One TWO three"),
    (9, "été à Paris – 日本語 \U0001F600 don't we'll 'tis"), (10, "x" * 5000),
]


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, size=5):
    w = words(text)
    if not w:
        return set()
    if len(w) < size:
        return {b" ".join(w)}
    return {b" ".join(w[i:i + size]) for i in range(len(w) - size + 1)}


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def sentence_words(text):
    return re.findall(r"\S+", text)
