"""The range coder: exact round trips, and fewer bytes where ids can be predicted."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kudosflow.llm.range_coder import decode, encode


def back(ids, vocabulary):
    words, counts = encode(ids, vocabulary)
    assert len(words) == counts.sum()
    return decode(words, counts, len(ids), vocabulary), 4 * len(words)


@pytest.mark.parametrize("vocabulary", [1, 2, 300, 50_000, 1 << 19])
@pytest.mark.parametrize("n", [1, 2, 257, 3_000, 70_000])
def test_round_trip(n, vocabulary):
    ids = (np.random.default_rng(n).zipf(1.3, n) % vocabulary).astype(np.int64)
    assert (back(ids, vocabulary)[0] == ids).all()


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=2_000))
def test_round_trip_of_any_ids(ids):
    ids = np.array(ids)
    assert (back(ids, 10)[0] == ids).all()


def test_more_lanes_than_longest_run_and_long_repeats():
    for ids in (np.zeros(100_001, np.int64), np.arange(100_001) % 7, np.arange(40_000)):
        found, size = back(ids, 50_000)
        assert (found == ids).all()
    assert back(np.arange(100_001) % 7, 50_000)[1] < 100_001 // 4


def test_frequent_and_following_ids_take_less_room():
    rng = np.random.default_rng(1)
    even = rng.integers(0, 4_096, 200_000)
    skewed = (rng.zipf(1.5, 200_000) % 4_096).astype(np.int64)
    follows = np.cumsum(rng.choice([1, 1, 1, 1, 5], 200_000)) % 4_096
    sizes = [back(ids, 4_096)[1] for ids in (even, skewed, follows)]
    assert sizes[1] < 0.6 * sizes[0]
    assert sizes[2] < 0.5 * sizes[0]
    assert sizes[0] < 1.1 * 200_000 * 12 / 8 + 8 * 8_192


def test_too_many_ids_are_refused():
    with pytest.raises(ValueError):
        encode(np.array([1]), 1 << 20)
