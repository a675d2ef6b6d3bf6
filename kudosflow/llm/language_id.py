"""Language identification by nearest centroid.

A text becomes a normalised TF-IDF vector of hashed character n-grams. Every language
has several centroids, found by spherical k-means; the closest one by cosine names the
language, and a text too far from all of them is rejected.

The fit uses at most ``per_language`` labelled texts of each language, those with the
smallest hash of their id; everything else covers all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kudosflow.llm.common import fresh, pieces, stored, with_answers

UNKNOWN = "und"
#: Buckets that n-grams are hashed to.
BUCKETS = 1 << 14
#: Length classes, by doubling, for the distance at which texts are rejected.
LENGTHS = 32
#: Marks a length class without a sampled text; no cosine is as large.
_UNSEEN = 2.0
#: Texts with fewer n-grams, about 35 letters, are too short for a distance to tell.
LEAST_GRAMS = 100
#: More languages than this are refused: all centroids go to every task.
MAX_LANGUAGES = 500

_NO_LETTERS = re.compile(r"[\W\d_]+")
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets and counts of the 1- to 3-grams of a text's letters; None without any."""
    letters = _NO_LETTERS.sub(" ", (text or "").lower()).strip()
    if not any(map(str.isalpha, letters)):
        return None
    padded = f" {letters} ".encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(padded, dtype="<u4").astype(np.uint64)
    one, two, three = (np.uint64(factor) for factor in _FACTORS)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    pairs = codes[:-1] * two + codes[1:] * one
    triples = pairs[:-1] * three + codes[2:] * one
    grams = np.concatenate([codes[codes != 32] * one, pairs * one, triples * one])
    counts = np.bincount((grams >> shift).astype(np.int64), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


@dataclass
class LanguageModel:
    """Centroids by row of ``names``; ``least`` is the rejecting cosine by length class."""

    names: list[str] = field(default_factory=list)
    centroids: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0), np.float32))
    idf: np.ndarray = field(default_factory=lambda: np.ones(BUCKETS, np.float32))
    least: np.ndarray = field(default_factory=lambda: np.zeros(LENGTHS))


def tfidf(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = (1 + np.log(counts)) * idf[found]
    return (weights / np.sqrt((weights * weights).sum())).astype(np.float32)


def length_class(counts: np.ndarray) -> int:
    return min(LENGTHS - 1, int(counts.sum()).bit_length())


def _clusters(vectors: np.ndarray, wanted: int, rounds: int) -> np.ndarray:
    """Spherical k-means from the most central vector and then the farthest ones."""
    mean = vectors.sum(0)
    chosen = [int(np.argmax(vectors @ mean))]
    nearest = vectors @ vectors[chosen[0]]
    while len(chosen) < min(wanted, len(vectors)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen]
    for _ in range(rounds):
        own = np.argmax(vectors @ centres.T, axis=1)
        sums = np.stack([vectors[own == k].sum(0) for k in range(len(centres))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centres)
    return centres.astype(np.float32)


def sample_per_language(df: DataFrame, doc_id: str, lang: str, per_language: int) -> DataFrame:
    """At most so many rows of each language, those with the smallest hash of the id."""
    counts = {row[0]: row[1] for row in df.groupBy(lang).count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return df
    # A hash below this share of its range keeps a little more than is wanted.
    bits = F.xxhash64(F.col(doc_id).cast("string"))
    place = F.shiftrightunsigned(bits, 24)
    limit = F.lit(0)
    for name, count in counts.items():
        share = min(1.0, (per_language + 6 * per_language**0.5 + 10) / count)
        limit = F.when(F.col(lang) == name, F.lit(int(share * (1 << 40)))).otherwise(limit)
    rank = fresh(df, "rank")
    order = Window.partitionBy(lang).orderBy(bits, F.col(doc_id))
    few = df.where(place <= limit).withColumn(rank, F.row_number().over(order))
    return few.where(F.col(rank) <= per_language).drop(rank)


def fit_languages(
    labelled: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = 1000,
    centroids: int = 4,
    rounds: int = 8,
    margin: float = 0.5,
) -> LanguageModel:
    """Learn from labelled texts; rows without label, text or letters teach nothing.

    A text is rejected if its cosine is below ``margin`` times the lowest one among the
    sampled texts as long as it or longer, and if none is as long, among the longest ones.
    Without labelled texts the model knows no language and rejects all. Memory of a fit:
    ``4 * BUCKETS * per_language`` bytes.
    """
    rows = labelled.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    chosen = sample_per_language(rows, "doc_id", "lang", per_language)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in pieces(batches):
            made = [(name, ngram_counts(t)) for name, t in zip(batch["lang"], batch["text"])]
            made = [(name, vector) for name, vector in made if vector]
            yield pd.DataFrame(
                {
                    "lang": [name for name, _ in made],
                    "found": [vector[0] for _, vector in made],
                    "counts": [vector[1] for _, vector in made],
                }
            )

    vectors = stored(
        chosen.mapInPandas(count, "lang string, found array<bigint>, counts array<bigint>"),
        "language-sample",
    )
    seen = vectors.select(F.explode("found").alias("bucket")).groupBy("bucket").count().collect()
    total = vectors.count()
    idf = np.full(BUCKETS, 1 + np.log1p(total), np.float32)
    for bucket, n in seen:
        idf[bucket] = 1 + np.log((1 + total) / (1 + n))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        dense = np.zeros((len(group), BUCKETS), np.float32)
        lengths = np.zeros(len(group), int)
        for i, (found, counts) in enumerate(zip(group["found"], group["counts"])):
            dense[i, found] = tfidf(found, counts, idf)
            lengths[i] = length_class(counts)
        centres = _clusters(dense, centroids, rounds)
        close = (dense @ centres.T).max(1)
        least = [float(close[lengths == n].min(initial=_UNSEEN)) for n in range(LENGTHS)]
        return pd.DataFrame(
            {
                "lang": group["lang"].iloc[0],
                "centre": list(centres),
                "least": [least] * len(centres),
            }
        )

    # Each group holds at most per_language vectors.
    fitted = (
        vectors.groupBy("lang")
        .applyInPandas(fit, "lang string, centre array<float>, least array<double>")
        .collect()
    )
    if not fitted:
        return LanguageModel()
    fitted = sorted(fitted, key=lambda row: (row["lang"], row["centre"]))
    lowest = np.array([row["least"] for row in fitted]).min(0)
    longest = np.flatnonzero(lowest < _UNSEEN)[-1]
    lowest[longest + 1 :] = lowest[longest]
    least = margin * np.minimum.accumulate(lowest[::-1])[::-1]
    return LanguageModel(
        names=[row["lang"] for row in fitted],
        centroids=np.array([row["centre"] for row in fitted], np.float32).T.copy(),
        idf=idf,
        least=least,
    )


def identify(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected`` to every row.

    A text that is missing or has no letter is ``und`` with score 0, and rejected.
    A rejected text still names its nearest language. Texts under ``LEAST_GRAMS`` n-grams
    are not rejected for their distance. Equal scores go to the language that sorts
    first. Where the table has columns of these names, the new ones, the last three, get
    close names.
    """
    parts = (model.names, model.centroids, model.idf, model.least)
    sent = df.sparkSession.sparkContext.broadcast(parts)

    def judge(value: str | None) -> tuple[str, float, bool]:
        names, centroids, idf, least = sent.value
        vector = ngram_counts(value) if names else None
        if vector is None:
            return UNKNOWN, 0.0, True
        cosines = tfidf(*vector, idf) @ centroids[vector[0]]
        best = int(np.argmax(cosines))
        score = float(min(1.0, max(0.0, cosines[best])))
        far = vector[1].sum() >= LEAST_GRAMS and score < least[length_class(vector[1])]
        return names[best], score, bool(far)

    def answers():
        return lambda texts: list(zip(*map(judge, texts)))

    names = [fresh(df, name) for name in ("lang_pred", "score", "rejected")]
    return with_answers(df, text, answers, **dict(zip(names, ("string", "double", "boolean"))))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a document is kept from the fit; one without id is not."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % 4 == 2, F.lit(False))
