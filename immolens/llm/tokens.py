"""Byte-level BPE ids of whole texts, vectorised around a piece cache.

The vocabulary file's BPE works on pieces: the text is split by one fixed
pattern and each piece is merged on its own. Pieces repeat, so a task splits
a batch with array operations, hashes the pieces, and merges only those it
has not met. Ids are those of ``tokenizers`` for the same file
(``add_special_tokens=False``); the tests compare them on all documents.
Texts with symbols beyond Latin, or with a special token's string, go to
``tokenizers`` itself.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

from immolens.llm.hashing import gather_runs, run_hashes

CHUNK_CHARS = 1 << 18
CACHE_PIECES = 1 << 19

# Symbol classes of the split pattern below U+0250 and its contractions.
_LATIN_END = 0x250
_CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")
_BEYOND_LATIN = re.compile("[^\x00-\u024f]").search
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _classes() -> np.ndarray:
    import regex

    kinds = np.full(_LATIN_END, _OTHER, dtype=np.uint8)
    for cp in range(_LATIN_END):
        ch = chr(cp)
        if regex.match(r"\p{L}", ch):
            kinds[cp] = _LETTER
        elif regex.match(r"\p{N}", ch):
            kinds[cp] = _NUMBER
        elif regex.match(r"\p{White_Space}", ch):
            kinds[cp] = _SPACE
    return kinds


class PieceEncoder:
    """Encodes batches of texts; one per Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.path = path
        self.special = [t["content"] for t in file["added_tokens"]]
        self.merge = self._piece_merger(file["model"]["vocab"])
        self.kinds = _classes()
        self._forget()

    @functools.cached_property
    def full(self):
        """The library's own encoder, loaded when a text needs it."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _piece_merger(self, vocab: dict[str, int]):
        """Ids of one piece, from the vocabulary's ranks (the same merges,
        without the cost of the library's result objects)."""
        import tiktoken

        # the vocabulary file writes each byte as one printable symbol
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown}
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of |= {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in self.special}
        return tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _forget(self):
        self.known = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _starts(self, points: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
        """Flags of the symbols that begin a piece."""
        n = len(points)
        kinds = self.kinds[points]
        first = np.zeros(n + 1, dtype=bool)
        first[doc_starts] = True
        first[n] = True
        space = kinds == _SPACE
        change = np.ones(n, dtype=bool)
        change[1:] = kinds[1:] != kinds[:-1]
        change |= first[:n]
        blank_before = np.zeros(n, dtype=bool)
        blank_before[1:] = points[:-1] == 32
        blank_before &= ~first[:n]
        # the last white space before a word of the same text begins a piece
        word_next = np.zeros(n, dtype=bool)
        word_next[:-1] = ~space[1:]
        word_next &= ~first[1:]
        start = np.where(space, change | word_next, change & ~blank_before)
        quotes = np.flatnonzero((points == 39) & start)
        if len(quotes):
            ends = np.append(doc_starts, n)
            limit = ends[np.searchsorted(ends, quotes, side="right")]
            for tail in _CONTRACTIONS:
                ok = quotes + len(tail) < limit
                for k, ch in enumerate(tail, 1):
                    ok &= points[np.minimum(quotes + k, n - 1)] == ord(ch)
                hit = quotes[ok]
                start[hit + 1] = False
                after = hit + len(tail) + 1
                start[after[after < limit[ok]]] = True
        return start

    def _learn(self, hashes, starts, ends, points):
        """Adds the pieces (unique hashes) that the cache lacks."""
        place = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), dtype=bool)
        if len(self.known):
            new = self.known[np.minimum(place, len(self.known) - 1)] != hashes
        if not new.any():
            return
        if len(self.known) + int(new.sum()) > CACHE_PIECES and len(self.known):
            self._forget()
            return self._learn(hashes, starts, ends, points)
        text = points.astype("<u4").tobytes().decode("utf-32-le")
        found = [self.merge(text[a:b]) for a, b in zip(starts[new].tolist(), ends[new].tolist())]
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        at = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, np.fromiter((i for f in found for i in f), dtype=np.uint32, count=int(size.sum()))])
        known = np.concatenate([self.known, hashes[new]])
        order = np.argsort(known, kind="stable")
        self.known, self.at, self.size = known[order], np.concatenate([self.at, at])[order], np.concatenate([self.size, size])[order]

    def _encode_latin(self, texts: list[str]) -> list[np.ndarray]:
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(lengths)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        if not len(points):
            return [np.zeros(0, dtype=np.uint32) for _ in texts]
        doc_starts = (ends - lengths)[lengths > 0]
        starts = np.flatnonzero(self._starts(points, doc_starts))
        stops = np.append(starts[1:], len(points))
        hashes = run_hashes(points, starts, stops)
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        self._learn(unique, starts[first], stops[first], points)
        place = np.searchsorted(self.known, unique)
        size = self.size[place][back]
        ids = gather_runs(self.ids, self.at[place][back], size)
        total = np.concatenate([[0], np.cumsum(size)])
        piece_end = np.searchsorted(starts, ends)          # pieces that begin before each text's end
        cuts = total[piece_end]
        return np.split(ids, cuts[:-1]) if len(texts) > 1 else [ids]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of every text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        batch: list[int] = []
        size = 0

        def flush():
            for k, ids in zip(batch, self._encode_latin([texts[k] for k in batch])):
                out[k] = ids
            batch.clear()

        for k, text in enumerate(texts):
            if _BEYOND_LATIN(text) or any(s in text for s in self.special):
                out[k] = np.array(self.full.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
                continue
            batch.append(k)
            size += len(text)
            if size >= CHUNK_CHARS:
                flush()
                size = 0
        flush()
        return out


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a vocabulary file (kept between tasks)."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
