"""Vectorised hashing of variable-length runs inside a flat array.

A batch of texts is one flat array of symbols (bytes or code points). Each
run (a word, a token piece) is hashed from prefix sums, so the cost does not
depend on the number of runs and no Python object is made per word. All
hashes are 64 bits wide; distinct runs collide with a chance of about
pairs / 2^64.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)                       # odd, so it has an inverse mod 2^64
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: np.uint64, n: int) -> np.ndarray:
    table = _powers.get(name)
    if table is None or len(table) < n:
        size = max(n, 1 << 16)
        table = np.full(size, base, dtype=np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        _powers[name] = table
    return table[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SYMBOL = mix64(np.arange(1, 257, dtype=np.uint64))


def run_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every run ``symbols[starts[i]:ends[i]]``."""
    n = len(symbols)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    values = _SYMBOL[symbols] if symbols.dtype == np.uint8 else mix64(symbols.astype(np.uint64) + np.uint64(1))
    np.cumsum(values * _power_table("up", _BASE, n), out=prefix[1:])
    inverse = _power_table("down", _BASE_INV, n + 1)
    return mix64((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def gather_runs(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[starts[i]:starts[i]+lengths[i]]`` for all i."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    ends = np.cumsum(lengths)
    index = np.arange(total, dtype=np.int64)
    index += np.repeat(starts - (ends - lengths), lengths)
    return values[index]
