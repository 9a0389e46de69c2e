"""Keys are dealt to parts and looked up in time that does not hang on the number of parts."""
import time

import numpy as np

from tallystar.llm import suffix_tree


def test_values_of_keys_in_any_order():
    known = np.array([2, 5, 2 ** 63 + 1], np.uint64)
    values = np.array([0.5, 0.25, 0.125], np.float32)
    got = suffix_tree._looked_up(known, values, known[[2, 0, 1, 0]])
    assert got.tolist() == [0.125, 0.5, 0.25, 0.5] and got.dtype == np.float32
    assert len(suffix_tree._looked_up(known, values, known[:0])) == 0


def test_keys_are_dealt_to_many_parts():
    keys = np.arange(1_000_000, dtype=np.uint64) * np.uint64(7)
    part = (keys % np.uint64(2000)).astype(np.int64)
    began = time.process_time()
    rows = suffix_tree._dealt(suffix_tree.GRAMS, keys, keys.astype(np.int64), part, 2000)
    # Ordering all keys for every part took more than ten times as long.
    assert time.process_time() - began < 6
    assert [p for _, p, _, _ in rows] == [*range(2000)]
    for _, p, own, counts in rows[::400]:
        expected = keys[part == p]
        assert (suffix_tree._unpack_sorted(own) == expected).all()
        assert (suffix_tree._unpack(counts, np.int64) == expected.astype(np.int64)).all()
