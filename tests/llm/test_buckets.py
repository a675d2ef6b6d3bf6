"""Large buckets of near-duplicates: few comparisons, and the answers of all pairs."""

import numpy as np
import pyarrow as pa
import pytest

from kudosflow.llm import near_duplicates
from kudosflow.llm.near_duplicates import Scheme

SCHEME = Scheme()


def bucket(rows, near, seed=0, alphabet=1 << 16):
    """Signatures that share the first key of chunk 3, some of them close to the one before."""
    drawn = np.random.default_rng(seed)
    symbols = drawn.integers(0, alphabet, (rows, 50)).astype(np.uint16).view(np.int16)
    for i in range(1, rows, max(1, rows // near) if near else rows + 1):
        symbols[i] = symbols[i - 1]
        places = drawn.choice(50, drawn.integers(0, 30), replace=False)
        symbols[i, places] = drawn.integers(0, 1 << 15, len(places))
    symbols[:, 16:20] = 7  # chunk 3 without its first place
    return symbols


def near_pairs(symbols):
    """All pairs that differ in few enough symbols, by comparing every row with all."""
    out = set()
    for i, row in enumerate(symbols):
        wrong = (symbols[i + 1 :] != row).sum(axis=1)
        out |= {(i, i + 1 + int(j)) for j in np.flatnonzero(wrong <= SCHEME.most_errors)}
    return out


@pytest.mark.parametrize("rows, near, alphabet", [(130, 40, 1 << 16), (900, 300, 1 << 16), (600, 9, 3)])
def test_no_near_pair_of_a_large_bucket_is_left_out(rows, near, alphabet):
    symbols = bucket(rows, near, rows, alphabet)
    number = np.full(rows, 3 * 5)
    found = set()
    for x, y in near_duplicates._candidates(np.array([0]), symbols, number, SCHEME):
        assert (x < y).all()
        found |= set(zip(x.tolist(), y.tolist()))
    wanted = near_pairs(symbols)
    assert wanted and wanted <= found


def test_distinct_classes_of_one_bucket_are_hardly_compared():
    """20,000 classes with one key, in blocks of 1,024 with each other: 200 million pairs."""
    symbols = bucket(20_000, 0)
    parts = np.array_split(np.arange(len(symbols)), 20)
    compared = 0
    for i, one in enumerate(parts):
        for two in parts[i:]:
            rows = symbols[np.union1d(one, two)]
            number = np.full(len(rows), 3 * 5)
            for x, _ in near_duplicates._candidates(np.array([0]), rows, number, SCHEME):
                compared += len(x)
    assert compared < 20_000


def test_links_of_a_large_bucket_are_those_of_small_ones(monkeypatch):
    symbols = bucket(400, 130, 5)
    drawn = np.random.default_rng(1)
    table = pa.table(
        {
            "key": np.full(400, (12345 << 7) | 15),
            "low": np.zeros(400, np.int32),
            "high": np.zeros(400, np.int32),
            "part": np.zeros(400, np.int32),
            "id": np.arange(400),
            "label": drawn.integers(0, 100, 400),
            "n_shingles": drawn.integers(80, 120, 400),
            "symbols": pa.array(list(symbols), pa.list_(pa.int16())),
        }
    )

    def due():
        found = near_duplicates._due(table, np.array([0]), SCHEME)
        return {pair for x, y in found for pair in zip(x.tolist(), y.tolist())}

    pruned = due()
    monkeypatch.setattr(near_duplicates, "_agreeing", lambda *_: None)
    assert pruned and pruned == due()
