"""Findings of round three: fewer bytes of keys moved."""

import numpy as np

from racelake.llm import suffix_dedup


def test_keys_travel_in_few_bytes():
    rng = np.random.default_rng(7)
    for bits, n, most in ((48, 100_000, 4.2), (48, 14_000, 4.6), (32, 13_000, 2.6), (48, 1, 14), (32, 3, 9)):
        keys = np.sort(rng.integers(0, 1 << bits, n, np.uint64))
        packed = suffix_dedup._pack_keys(keys)
        assert len(packed) <= most * n
        assert (suffix_dedup._unpack_keys(packed) == keys).all()


def test_equal_keys_and_the_ends_of_their_range():
    for keys in ([0], [0, 0, 0], [(1 << 48) - 1] * 2, [0, (1 << 48) - 1], list(range(1000)), [5] * 300 + [1 << 40]):
        keys = np.array(keys, np.uint64)
        assert (suffix_dedup._unpack_keys(suffix_dedup._pack_keys(keys)) == keys).all()
