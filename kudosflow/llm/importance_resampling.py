"""Quality by importance resampling.

Two generative models over hashed word n-grams, one of target texts and one of all raw
texts, give each document the log ratio of its likelihoods. Adding Gumbel noise and
keeping the largest sums draws documents without replacement in proportion to the ratio.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kudosflow.llm.common import cutoffs, lists, pieces, record_batch, stored

#: Buckets that one- and two-word n-grams are hashed to.
BUCKETS = 1 << 14
#: Parts of a unit that scores are ranked by, and bits of the hash that breaks ties.
_PARTS = 1 << 16
_TIE_BITS = 36
#: No score is further from 0 than this; larger ones rank alike, by hash.
_MOST = 1 << 30

_POWERS = np.random.default_rng(19).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + 1
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def ngram_buckets(text: str | None) -> np.ndarray:
    """Buckets of a text's words and pairs of neighbouring words, in lower case."""
    raw = np.frombuffer((text or "").lower().encode("utf-8", "replace"), np.uint8)
    solid = ~_SPACE[raw]
    edge = np.diff(np.concatenate([[False], solid, [False]]).view(np.int8))
    lengths = np.flatnonzero(edge == -1) - np.flatnonzero(edge == 1)
    if not len(lengths):
        return np.zeros(0, np.int64)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(starts, lengths)
    words = np.add.reduceat((raw[solid] + np.uint64(1)) * _POWERS[place & 63], starts)
    words ^= words >> np.uint64(31)
    pairs = words[:-1] * _POWERS[7] + words[1:] * _POWERS[11]
    both = np.concatenate([words * _POWERS[3], pairs * _POWERS[5]])
    return (both >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def log_ratios(docs: DataFrame, target_ids: DataFrame) -> np.ndarray:
    """The log ratio of each bucket. ``docs`` has ``doc_id`` and ``text``.

    Raw counts cover every document. ``target_ids`` must be few, as they are sent to all
    tasks. Every bucket starts at 1 in both models.
    """
    marked = docs.join(
        F.broadcast(target_ids.select("doc_id").distinct().withColumn("target", F.lit(True))),
        "doc_id",
        "left",
    ).select("text", F.coalesce("target", F.lit(False)).alias("target"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in pieces(batches):
            for text, target in zip(batch["text"], batch["target"]):
                found = np.bincount(ngram_buckets(text), minlength=BUCKETS)
                sums[0] += found
                if target:
                    sums[1] += found
        used = np.flatnonzero(sums[0])
        yield pd.DataFrame({"bucket": used, "raw": sums[0, used], "wanted": sums[1, used]})

    counted = marked.mapInPandas(count, "bucket int, raw bigint, wanted bigint")
    sums = np.ones((2, BUCKETS))
    for row in counted.groupBy("bucket").agg(F.sum("raw"), F.sum("wanted")).collect():
        sums[:, row[0]] += row[1], row[2]
    raw, wanted = np.log(sums / sums.sum(axis=1, keepdims=True))
    return wanted - raw


def resample(
    docs: DataFrame,
    labels: DataFrame,
    most_targets: int = 20_000,
    share: float | None = None,
    spare: float = 0.02,
    seed: int = 0,
) -> DataFrame:
    """``doc_id``, ``log_ratio``, ``score`` and ``kept`` of every document.

    ``docs`` has ``doc_id`` and ``text``; ``labels`` has ``doc_id`` and ``quality``, 1 for
    target texts. The target model is fitted on at most ``most_targets`` of them, those
    with the smallest hash of their id. As many documents are kept as ``share`` says, or
    as large a part as the labels call good and ``spare`` more, which is room for good
    texts of a kind that is rare among the targets; without labels, all. Ties in score go
    by a hash of the id, and rows that repeat an id stay or go together, so that a few
    less may be kept. A missing or empty text has the ratio 0.
    """
    good = F.col("quality") == 1
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    if share is None:
        share = known.agg(F.avg(good.cast("double"))).first()[0]
        share = 1.0 if share is None else min(1.0, share + spare)
    order = F.xxhash64("doc_id", F.lit(23))
    targets = known.where(good).select("doc_id").distinct().orderBy(order).limit(most_targets)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sent = docs.sparkSession.sparkContext.broadcast(log_ratios(rows, targets))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = sent.value
        for batch in lists(batches):
            sums = [float(ratios[ngram_buckets(text)].sum()) for text in batch["text"]]
            yield record_batch(doc_id=("int64", batch["doc_id"]), log_ratio=("float64", sums))

    uniform = (
        F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed), F.lit(29)), 11) + F.lit(0.5)
    ) / F.lit(float(1 << 53))
    score = F.col("log_ratio") - F.log(-F.log(uniform))
    clipped = F.least(F.greatest(F.col("score"), F.lit(float(-_MOST))), F.lit(float(_MOST)))
    rated = stored(
        rows.mapInArrow(rate, "doc_id bigint, log_ratio double")
        .withColumn("score", score)
        .withColumn("place", ((F.lit(float(_MOST)) - clipped) * _PARTS).cast("bigint"))
        .withColumn("tie", F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(31)), 64 - _TIE_BITS)),
        "scores",
    )
    wanted = round(share * rated.count())
    bits = (2 * _MOST * _PARTS).bit_length()
    one = F.lit(1).cast("bigint")
    cut = cutoffs(rated, F.lit(0), F.col("place"), one, [(0, wanted)], bits)[0]
    left = wanted - rated.where(F.col("place") < cut).count()
    at_cut = rated.where(F.col("place") == cut)
    tie = cutoffs(at_cut, F.lit(0), F.col("tie"), one, [(0, left)], _TIE_BITS)[0]
    kept = (F.col("place") < cut) | ((F.col("place") == cut) & (F.col("tie") < tie))
    return rated.select("doc_id", "log_ratio", "score", kept.alias("kept"))
