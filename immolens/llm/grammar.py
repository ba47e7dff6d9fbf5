"""Re-Pair grammars of many texts at once, and exact comparisons inside them.

The word ids of several texts lie in one array, a separator after each. Every
round replaces the pairs that occur at least twice, most frequent first: of
overlapping pairs the more frequent one wins (ties by a hash of the pair,
runs of one symbol from the left), which does in one pass over the array what
single replacements would do one after the other. What is left of each text
is then paired up evenly until one symbol stands for it. Equal pairs share a
nonterminal, also across texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from immolens.llm.hashing import mix64

SEPARATOR = -1
_HALF = 31                      # bits of a symbol in a pair's key
MAX_ROUNDS = 64                 # of replacing repeated pairs; the even pairing ends any grammar


@dataclass
class Grammar:
    """Symbols below ``terminals`` are words; nonterminal ``terminals + i``
    is ``left[i] right[i]``."""

    terminals: int
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray          # words of every symbol
    roots: np.ndarray           # one symbol per text that is not empty
    starts: np.ndarray          # its first position in the array


def _chosen(pair: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Positions whose pair is replaced, no two of them overlapping. ``pair``
    is a pair's number at every position, ``rank`` its priority (0: none)."""
    same = np.zeros(len(pair), dtype=bool)                  # the same pair as the position before: one symbol repeated
    same[1:] = (pair[1:] == pair[:-1]) & (rank[1:] > 0)
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(pair))))
    even = (np.arange(len(pair)) - head) % 2 == 0
    before = np.concatenate([[0], rank[:-1]])
    after = np.concatenate([rank[1:], [0]])
    return np.flatnonzero((rank > 0) & even & (rank >= before) & (rank >= after) & ((rank > before) | same))


def build_grammar(words: np.ndarray, terminals: int) -> Grammar:
    """``words``: ids from 0 to ``terminals - 1``, and separators."""
    seq, at = words.astype(np.int64), np.arange(len(words))
    lefts, rights, lengths = [], [], [np.ones(terminals, dtype=np.int64)]
    length = lengths[0]
    known, known_as = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)      # pairs that have a nonterminal
    symbols, repeated, rounds = terminals, True, 0
    while True:
        solid = (seq[:-1] >= 0) & (seq[1:] >= 0) if len(seq) else np.zeros(0, dtype=bool)
        if not solid.any():
            break
        key = np.where(solid, seq[:-1] << _HALF | seq[1:], -1)
        found, pair, count = np.unique(key, return_inverse=True, return_counts=True)
        if repeated:
            able = (count >= 2) & (found >= 0)
            rounds += 1
            if not able.any() or rounds > MAX_ROUNDS:
                repeated = False
                continue
            rank = np.empty(len(found), dtype=np.int64)
            rank[np.lexsort((mix64(found.astype(np.uint64)), count))] = np.arange(1, len(found) + 1)
            i = _chosen(pair, np.where(able, rank, 0)[pair])
        else:                                               # even positions of every text
            begin = np.concatenate([[True], seq[:-1] < 0])
            head = np.maximum.accumulate(np.where(begin, np.arange(len(seq)), 0))[:-1]
            i = np.flatnonzero(solid & ((np.arange(len(solid)) - head) % 2 == 0))
        used, number = np.unique(pair[i], return_inverse=True)
        used = found[used]
        place = np.searchsorted(known, used)
        new = np.ones(len(used), dtype=bool)
        inside = place < len(known)
        new[inside] = known[place[inside]] != used[inside]
        name = np.empty(len(used), dtype=np.int64)
        name[~new] = known_as[place[~new]]
        name[new] = symbols + np.arange(int(new.sum()))
        a, b = used[new] >> _HALF, used[new] & ((1 << _HALF) - 1)
        lefts.append(a)
        rights.append(b)
        length = np.concatenate([length, length[a] + length[b]])
        known, known_as = np.insert(known, place[new], used[new]), np.insert(known_as, place[new], name[new])
        seq[i] = name[number]
        symbols += len(a)
        keep = np.ones(len(seq), dtype=bool)
        keep[i + 1] = False
        seq, at = seq[keep], at[keep]
    none = np.zeros(0, dtype=np.int64)
    whole = seq >= 0
    return Grammar(terminals, np.concatenate(lefts or [none]), np.concatenate(rights or [none]), length, seq[whole], at[whole])


def derivation(grammar: Grammar, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, position) of every nonterminal of at least ``least`` words in
    the texts' derivation trees, level by level."""
    symbol, at = grammar.roots, grammar.starts
    symbols, places = [], []
    while True:
        big = (symbol >= grammar.terminals) & (grammar.length[symbol] >= least)
        symbol, at = symbol[big], at[big]
        if not len(symbol):
            break
        symbols.append(symbol)
        places.append(at)
        rule = symbol - grammar.terminals
        a, b = grammar.left[rule], grammar.right[rule]
        symbol, at = np.concatenate([a, b]), np.concatenate([at, at + grammar.length[a]])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate(symbols or [none]), np.concatenate(places or [none])


class Names:
    """Numbers for the word sequences of 1, 2, 4, ... words at every position:
    equal numbers mean equal sequences. Separators equal nothing."""

    def __init__(self, words: np.ndarray):
        base = words.astype(np.int64)
        apart = np.flatnonzero(base < 0)
        base[apart] = int(base.max(initial=0)) + 1 + np.arange(len(apart))
        self.levels = [base]
        step = 1
        while len(base) > step:
            found, name = np.unique(base[:-step] * (int(base.max()) + 1) + base[step:], return_inverse=True)
            if len(found) == len(name):                     # nothing of this length repeats
                break
            self.levels.append(name)
            base, step = name, 2 * step

    def sixes(self) -> np.ndarray:
        """Numbers for six words at every position (none if no four repeat)."""
        if len(self.levels) < 3:
            return np.zeros(0, dtype=np.int64)
        two, four = self.levels[1], self.levels[2]
        n = len(self.levels[0]) - 5
        return np.unique(four[:n] * (int(two.max()) + 1) + two[4:4 + n], return_inverse=True)[1]

    def common(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words agree from ``x`` and ``y`` on, at most ``limit``;
        ``back``: from there to the left."""
        done = np.zeros(len(x), dtype=np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            names, step = self.levels[level], 1 << level
            shift = -done - step + 1 if back else done
            fits = np.flatnonzero(limit - done >= step)
            same = names[x[fits] + shift[fits]] == names[y[fits] + shift[fits]]
            done[fits[same]] += step
        return done
