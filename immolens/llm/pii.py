"""Personal data: high-recall candidates, boosted trees, calibrated thresholds.

Four kinds are found: e-mail, IP address, payment card, phone number. Base
patterns with checks (number ranges, Luhn, digit counts) give spans that are
always kept. Loose generators propose further, overlapping spans: addresses
written out ("name (at) host dot org"), digit runs with any separators. A
boosted-tree model judges each proposal from its format and its context, and
a proposal that beats its kind's threshold, overlaps no base span and no
better proposal, is added.

The model learns from a sample of at most ``MAX_TRAIN`` candidates. Base spans
are positive, each also rewritten in the loose forms of its kind and in its own
context; other candidates are negative, as are base spans whose checks are
broken (wrong check digit, numbers out of range). Half of the sample fits the
trees, the other half calibrates them (isotonic), and each kind's threshold is
the least score with a calibrated probability of ``PRECISION``.

Cases: a null text counts as empty and has no spans. Whole texts are read;
the cost is linear in their length. Repeated rows get equal results. Without
any candidate in the sample nothing is added to the base spans. Positions are
code points, ends exclusive. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from immolens.llm.boosting import BoostedTrees
from immolens.llm.memory import thrifty
from immolens.llm.quality import isotonic

KINDS = ("email", "ip", "card", "phone")
MAX_TRAIN = 20_000
TRAIN_DOCS = 20_000
PRECISION = 0.99

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")   # a match never begins inside a run of digits
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE_AT = re.compile(r"(?: ?[\[({] ?(?:at|@) ?[\])}] ?| at | @ ?|@ ?)"
                       r"[A-Za-z0-9-]+(?:(?: ?[\[({] ?(?:dot|\.) ?[\])}] ?| dot |\.)[A-Za-z0-9-]+)+")
_LOOSE_NUMBER = re.compile(r"[+(]{0,2}[0-9](?:[ .()/\[\]-]{0,3}[0-9])+")
_KEYWORDS = (re.compile(r"mail|contact|write|@", re.I), re.compile(r"\bip\b|host|server|address", re.I),
             re.compile(r"card|visa|pay|account", re.I), re.compile(r"tel|phone|call|fax|mobile", re.I))


def luhn(digits: str) -> bool:
    odd = digits[::-1]
    return sum(map(int, odd[0::2])) % 10 == -sum(sum(divmod(2 * int(d), 10)) for d in odd[1::2]) % 10


def _is_ip(match: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in match.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    spans, end = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            spans.append((start, 0, m.end()))
            end = m.end()
    spans += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _is_ip(m.group())]
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start():
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the loose generators; spans may overlap."""
    found, end = [], 0
    for m in _LOOSE_AT.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            found.append((start, 0, m.end()))
        end = m.end()
    for m in _LOOSE_NUMBER.finditer(text):
        a, b = m.span()
        if b - a < 7:
            continue
        shown = m.group()
        n = sum(c.isdigit() for c in shown)
        while text[a] == "(" and shown.count("(") > shown.count(")"):
            a, shown = a + 1, shown[1:]
        if 4 <= n <= 12 and len(re.findall("[0-9]+", shown)) == 4:
            found.append((a, 1, b))
        if 12 <= n <= 19:
            found.append((a, 2, b))
        if 7 <= n <= 15:
            found.append((a, 3, b))
    return found


def _char_kind(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isdigit() else 3 if c.isalpha() else 4 if c in ".,;:!?()" else 5


def span_features(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context of a span."""
    s = text[start:end]
    groups = re.findall("[0-9]+", s)
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    before, after = text[max(0, start - 24):start], text[end:end + 12]
    words = re.findall(r"[A-Za-z]+", s)
    return [float(v) for v in (
        kind, len(s), len(digits), len(groups), min(sizes), max(sizes), len(set(sizes)),
        max((int(g[:6]) for g in groups), default=0) <= 255, luhn(digits) if 12 <= len(digits) <= 19 else 0,
        s[:1] == "+", digits[:2] == "00", digits[:1] == "0", s.count("."), s.count(" "), s.count("-"), s.count("/"),
        s.count("("), "@" in s, "dot" in words, "at" in words, len(words), len(words[-1]) if words else 0, len(set(re.findall(r"[ .()/\[\]-]", s))),
        _char_kind(before[-1:]), _char_kind(after[:1]), _char_kind(before[-2:-1]),
        bool(_KEYWORDS[kind].search(before)), "=" in before[-3:] or '"' in before[-2:], len(set(digits)))]


def _loose_forms(s: str, kind: int, rng: random.Random) -> str:
    """A base span written in a loose form of its kind."""
    if kind == 0:
        at, dot = rng.choice([(" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" (at) ", "."), ("[at]", "."), (" @ ", ".")])
        local, _, host = s.partition("@")
        return local + at + host.replace(".", dot)
    if kind == 1:
        return s.replace(".", rng.choice(["[.]", " . ", "(.)", ". "]))
    digits = re.sub("[^0-9]", "", s)
    sep = rng.choice([".", "/", " - ", ". "] if kind == 2 else [".", " ", "-", "/"])
    if kind == 2:
        return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    head = rng.choice(["00", "0", "("])
    if head == "(":
        return f"({digits[-10:-7] or '0'}) {digits[-7:-4]}{rng.choice('-. ')}{digits[-4:]}"
    return head + sep.join([digits[:-7], digits[-7:-4], digits[-4:]])


def _broken(s: str, kind: int, rng: random.Random) -> str:
    """A base span whose check fails."""
    if kind == 0:
        return rng.choice([s.partition("@")[0] + " at " + rng.choice(["home", "work", "3.30", "1.5"]), s.replace("@", " ")])
    if kind == 1:
        parts = s.split(".")
        return ".".join(parts[:rng.choice([2, 3])] + [str(rng.randint(256, 9999))] * rng.choice([1, 2]))
    digits = [int(c) for c in s if c.isdigit()]
    if kind == 2:
        digits[rng.randrange(len(digits))] += rng.randint(1, 9)
        return "".join(str(d % 10) for d in digits)
    return rng.choice(["%04d-%02d-%02d %02d:%02d" % (rng.randint(1900, 2099), rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 23), rng.randint(0, 59)),
                       "%d.%d" % (rng.randint(1, 9999), rng.randint(0, 10 ** 7)), "%d" % rng.randint(10 ** 6, 10 ** 11),
                       "%d/%d/%d-%d" % (rng.randint(1, 31), rng.randint(1, 12), rng.randint(1900, 2099), rng.randint(1, 9999))])


def training_rows(text: str, seed: int) -> list[tuple[list[float], int]]:
    """Features and labels that one text teaches."""
    rng = random.Random(seed)
    base = base_spans(text)
    rows = []
    for start, kind, end in base:
        rows.append((span_features(text, start, kind, end), 1))
        for label, make in ((1, _loose_forms), (0, _broken)):
            s = make(text[start:end], kind, rng)
            changed = text[max(0, start - 24):start] + s + text[end:end + 12]
            at = min(24, start)
            for a, k, b in candidates(changed):
                if k == kind and abs(a - at) <= 2 and b >= at + len(s) - 2:
                    rows.append((span_features(changed, a, k, b), label))
    taken = [(a, b) for a, _, b in base]
    for a, k, b in candidates(text):
        if not any(x < b and a < y for x, y in taken):
            rows.append((span_features(text, a, k, b), 0))
    return rows


class PiiModel:
    """Trees and one threshold per kind (None: nothing is added)."""

    def __init__(self, trees: BoostedTrees | None = None, thresholds: dict[int, float] | None = None):
        self.trees, self.thresholds = trees, thresholds or {}

    def accepted(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = self.trees.raw(features)
        least = np.array([self.thresholds.get(k, np.inf) for k in range(len(KINDS))])
        return raw >= least[features[:, 0].astype(int)], raw


def fit_model(docs: DataFrame, max_train: int = MAX_TRAIN, train_docs: int = TRAIN_DOCS) -> PiiModel:
    """``docs``: (doc_id, text)."""
    share = min(1.0, train_docs / max(1, docs.count()))
    pick = F.xxhash64("doc_id", F.lit(3))
    sample = docs.where(F.pmod(pick, F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1.0)).select(pick.alias("seed"), "text")

    @thrifty
    def rows(batches):
        for batch in batches:
            found = [(s, x, y) for s, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for x, y in training_rows(t or "", s)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.float32())),
                                                  pa.array([f[2] for f in found], pa.int32())], names=["seed", "x", "y"])

    table = (sample.mapInArrow(rows, "seed long, x array<float>, y int")
             .orderBy("seed", "y", "x").limit(max_train).toPandas())
    if table["y"].nunique() < 2:
        return PiiModel()
    x, y = np.array(table["x"].tolist(), dtype=np.float64), table["y"].to_numpy()
    fits = table["seed"].to_numpy() % 2 == 0            # all rows of a text on one side
    if len(set(y[fits])) < 2 or len(set(y[~fits])) < 2:
        return PiiModel()
    trees = BoostedTrees().fit(x[fits], y[fits])
    thresholds = {}
    for k in range(len(KINDS)):
        rest = ~fits & (x[:, 0] == k)
        if rest.sum() >= 20:
            _, means, least = isotonic(trees.raw(x[rest]), y[rest].astype(float))
            good = least[means >= PRECISION]
            if len(good):
                thresholds[k] = float(good.min())
    return PiiModel(trees, thresholds)


def _spans_of(texts: list[str], model: PiiModel) -> list[tuple[list, list]]:
    """(base spans, all spans) of every text."""
    out, features, owner = [], [], []
    for i, text in enumerate(texts):
        base = base_spans(text)
        out.append((base, list(base)))
        if model.thresholds:
            starts = sorted(a for a, _, _ in base)
            reach = list(accumulate((b for _, b in sorted((a, b) for a, _, b in base)), max))
            for a, k, b in candidates(text):
                if not _overlaps(starts, reach, a, b):
                    features.append(span_features(text, a, k, b))
                    owner.append((i, a, k, b))
    if features:
        ok, raw = model.accepted(np.array(features, dtype=np.float64))
        added: dict[int, list] = {}
        for n in sorted(np.flatnonzero(ok).tolist(), key=lambda n: (-raw[n], owner[n])):
            i, a, k, b = owner[n]
            if not any(x < b and a < y for x, y in added.setdefault(i, [])):
                added[i].append((a, b))
                out[i][1].append((a, k, b))
        for i in added:
            out[i][1].sort()
    return out


def _overlaps(starts: list[int], reach: list[int], a: int, b: int) -> bool:
    """Whether [a, b) meets one of some spans: their starts in order, and the
    furthest end up to each of them."""
    i = bisect_left(starts, b)
    return i > 0 and reach[i - 1] > a


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_pii(docs: DataFrame, model: PiiModel | None = None, id_col: str = "doc_id", text_col: str = "text",
             redact: bool = False) -> DataFrame:
    """doc_id, the counts of base spans, a hash of the base spans, all spans,
    and with ``redact`` the text with each span replaced by its kind."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = model or fit_model(docs)
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

    @thrifty
    def find(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = _spans_of(texts, model)
            counts = np.zeros((len(texts), len(KINDS)), dtype=np.int64)
            for i, (base, _) in enumerate(found):
                for _, k, _ in base:
                    counts[i, k] += 1
            columns = [batch.column(0), *(pa.array(counts[:, k]) for k in range(len(KINDS))),
                       pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b, _ in found], pa.string()),
                       pa.array([_joined(s) for _, s in found], pa.string())]
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
            if redact:
                columns.append(pa.array([redacted(t, s) for t, (_, s) in zip(texts, found)], pa.string()))
                names.append("text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(find, schema + ", text string" * redact)


def redacted(text: str, spans) -> str:
    """``text`` with every span replaced by its kind; overlapping spans become
    one, named after the first."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redacted_documents(docs: DataFrame, model: PiiModel | None = None, id_col: str = "doc_id", text_col: str = "text",
                       length_col: str = "n_chars") -> DataFrame:
    """``docs`` with the spans of its texts replaced by their kinds and, if
    there is one, the length column brought up to date. A null text stays."""
    model = model or fit_model(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    at = docs.columns.index(text_col)
    counted = docs.columns.index(length_col) if length_col in docs.columns else None

    @thrifty
    def redact(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new = [t if t is None else redacted(t, s) for t, (_, s) in zip(texts, _spans_of([t or "" for t in texts], model))]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if counted is not None:
                field = batch.schema.field(counted)
                old = columns[counted].to_pylist()
                columns[counted] = pa.array([n if a == b else len(b) for n, a, b in zip(old, texts, new)], field.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(redact, docs.schema)
