"""The learned queries against models fitted by plain counts and loops."""

import math
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash

from kudosflow.llm import importance_resampling, language_id, registry

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="the driver's tables are not here")
MASK = (1 << 64) - 1


def read(name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{FOLDER}/{name}.parquet'").fetchall()


def word_buckets(text):
    """Buckets of words and of pairs of neighbours, hashed number by number."""
    powers = [int(x) for x in importance_resampling._POWERS]
    hashes = []
    for word in (text or "").lower().encode().split():
        h = sum((sign + 1) * powers[i & 63] for i, sign in enumerate(word)) & MASK
        hashes.append(h ^ h >> 31)
    pairs = [(a * powers[7] + b * powers[11]) & MASK for a, b in zip(hashes, hashes[1:])]
    both = [h * powers[3] & MASK for h in hashes] + [h * powers[5] & MASK for h in pairs]
    return Counter(h * importance_resampling.BUCKETS >> 64 for h in both)


def noise(number):
    """The Gumbel noise of an id, from the chain of hashes of the id, the seed and 29."""
    h = xxhash.xxh64_intdigest(number.to_bytes(8, "little", signed=True), 42)
    for part in (0, 29):
        h = xxhash.xxh64_intdigest(part.to_bytes(4, "little"), h)
    return -math.log(-math.log(((h >> 11) + 0.5) / (1 << 53)))


def test_scores_of_the_resampling_are_those_of_plain_counts(spark):
    counts = {number: word_buckets(text) for number, text in read("documents", "doc_id, text")}
    quality = dict(read("labels", "doc_id, quality"))
    raw, wanted = Counter(), Counter()
    for number, found in counts.items():
        raw.update(found)
        if quality.get(number) == 1:
            wanted.update(found)
    size = importance_resampling.BUCKETS
    totals = raw.total() + size, wanted.total() + size
    ratios = {
        number: sum(
            n * math.log((wanted[b] + 1) / totals[1] / ((raw[b] + 1) / totals[0]))
            for b, n in found.items()
        )
        for number, found in counts.items()
    }
    rows = registry.queries()["op3_importance_resampling"](spark, str(FOLDER)).collect()
    assert len(rows) == len(counts)
    for row in rows:
        assert row.log_ratio == pytest.approx(ratios[row.doc_id], rel=1e-9, abs=1e-6)
        assert row.score == pytest.approx(ratios[row.doc_id] + noise(row.doc_id), abs=1e-5)
    share = sum(quality.values()) / len(quality) + 0.02
    best = sorted(counts, key=lambda number: -ratios[number] - noise(number))
    assert {row.doc_id for row in rows if row.kept} == set(best[: round(share * len(rows))])


def letter_grams(text):
    """Buckets of the 1- to 3-grams of a text's letters; none without letters."""
    letters = re.sub(r"[\W\d_]+", " ", (text or "").lower()).strip()
    if not any(sign.isalpha() for sign in letters):
        return Counter()
    one, two, three = language_id._FACTORS
    codes, out = [32, *map(ord, letters), 32], []
    for i, code in enumerate(codes):
        if code != 32:
            out.append(code * one)
        if i >= 1:
            pair = codes[i - 1] * two + code * one
            out.append(pair * one)
        if i >= 2:
            before = codes[i - 2] * two + codes[i - 1] * one
            out.append((before * three + code * one) * one)
    return Counter((h & MASK) * language_id.BUCKETS >> 64 for h in out)


def unit(vector):
    norm = np.sqrt((vector * vector).sum())
    return vector / norm if norm else vector


def fitted(vectors, wanted=4, rounds=8):
    """Centroids of one language: the most central vector, the farthest ones, then means."""
    mean = sum(vectors)
    centres = [max(vectors, key=lambda v: v @ mean)]
    while len(centres) < min(wanted, len(vectors)):
        centres.append(min(vectors, key=lambda v: max(v @ c for c in centres)))
    for _ in range(rounds):
        groups = [[] for _ in centres]
        for v in vectors:
            groups[int(np.argmax([v @ c for c in centres]))].append(v)
        centres = [unit(sum(g)) if g else c for g, c in zip(groups, centres)]
    return centres


def test_languages_are_those_of_plain_centroids(spark):
    rows = read("documents", "doc_id, text, lang")
    grams = {number: letter_grams(text) for number, text, _ in rows}
    taught = {
        number: lang
        for number, _, lang in rows
        if zlib.crc32(str(number).encode()) % 4 != 2 and lang is not None and grams[number]
    }
    held = Counter(bucket for number in taught for bucket in grams[number])
    idf = np.array(
        [1 + math.log((1 + len(taught)) / (1 + held[b])) for b in range(language_id.BUCKETS)]
    )
    vectors = {}
    for number, found in grams.items():
        dense = np.zeros(language_id.BUCKETS)
        for bucket, n in found.items():
            dense[bucket] = (1 + math.log(n)) * idf[bucket]
        vectors[number] = unit(dense)
    centres = [
        (lang, centre)
        for lang in sorted(set(taught.values()))
        for centre in fitted([vectors[n] for n, own in taught.items() if own == lang])
    ]
    # The lowest cosine of a sampled text to its own language, of its length or longer.
    length = {number: found.total().bit_length() for number, found in grams.items()}
    close = {
        n: max(vectors[n] @ centre for own, centre in centres if own == lang)
        for n, lang in taught.items()
    }
    longest = max(length[n] for n in taught)

    def least(size):
        return 0.5 * min(c for n, c in close.items() if length[n] >= min(size, longest))

    found = registry.queries()["op9_language_id"](spark, str(FOLDER)).collect()
    assert len(found) == len(rows)
    for row in found:
        own = grams[row.doc_id]
        if not own:
            assert (row.lang_pred, row.score, row.rejected) == ("und", 0, True)
            continue
        cosines = [(lang, vectors[row.doc_id] @ centre) for lang, centre in centres]
        lang, score = max(cosines, key=lambda x: x[1])
        assert row.lang_pred == lang
        assert row.score == pytest.approx(score, abs=1e-4)
        assert row.rejected == (own.total() >= 100 and score < least(length[row.doc_id]))
