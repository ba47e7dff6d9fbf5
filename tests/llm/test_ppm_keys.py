"""Sorting and finding the keys of words and runs."""

import numpy as np
import pytest

from immolens.llm.ppm import _distinct, _marked, _Places


def _keys(n):
    r = np.random.default_rng(n)
    return np.concatenate([r.integers(0, 1 << 40, n), r.integers(0, 300, n), -r.integers(1, 1 << 62, n)]).astype(np.int64)


@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_places_are_those_of_a_binary_search(n):
    keys = np.unique(_keys(n))
    wanted = np.random.default_rng(1).permutation(np.repeat(keys, 3))
    assert (_Places(keys).of(wanted) == np.searchsorted(keys, wanted)).all()
    assert (_distinct(_keys(n)) == keys).all()
    shuffled = np.random.default_rng(2).permutation(keys)
    assert (shuffled[_Places(shuffled).of(wanted)] == wanted).all()


def test_a_key_that_is_not_held_raises():
    with pytest.raises(IndexError):
        _Places(np.array([1, 2], dtype=np.int64)).of(np.array([77], dtype=np.int64))


@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_marks_are_counted_by_key(n):
    keys = _keys(n)
    keys = keys[keys >= 0]
    marks = np.random.default_rng(4).random(len(keys)) < 0.5
    got, counts = _marked(keys, marks)
    unique, back = np.unique(keys, return_inverse=True)
    assert (got == unique).all() and (counts == np.bincount(back, weights=marks, minlength=len(unique))).all()
