"""Benchmark decontamination by the q-gram lemma.

A stretch of a benchmark text of ``window`` characters that stands in a document with
at most ``edits`` edits shares at least ``window + 1 - q * (edits + 1)`` of its q-grams
with it, on diagonals (place in the document less place in the stretch) that lie within
``edits`` of each other. So shared q-grams are counted in overlapping bands of diagonals,
stretches with enough of them are retained, and a banded alignment decides.

Letters and digits count, in lower case, and anything between them is one space. A
benchmark text shorter than a window is one stretch, with its share of the edits. One
under ``shortest`` characters is searched as it is, from one word's border to another.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kudosflow.llm.common import all_columns, fresh, pieces, quoted, with_answers

#: Hashes of q-grams are looked up in a table of at least and at most so many bits before
#: anything else; it has eight places or more for each q-gram of a block.
_BITS = 22, 28
#: No code point.
_NO_SIGN = np.uint64(1 << 32)
#: Stretches that are aligned at once, and shared q-grams that are counted at once.
_ALIGNED = 128
_HITS = 1 << 20
#: Length of the q-grams that are counted once more where enough of the long ones are shared.
#: The lemma asks for more of them, so that few stretches are aligned in vain.
_SHORT = 8
#: Words of normalised texts; signs of scripts without spaces are words of their own.
_UNSPACED = (
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
    "\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
)
_WORDS = re.compile(f"[{_UNSPACED}]|[^ {_UNSPACED}]+")


class Bounds(NamedTuple):
    """Lengths in characters. ``q`` is as long as the lemma allows: 6 edits would have to
    break all of 13 characters each, and from 12 on most texts share few q-grams by chance.
    ``block_chars`` of benchmark text are sent to the tasks at once; a larger benchmark takes
    several passes."""

    window: int = 80
    edits: int = 5
    q: int = 12
    shortest: int = 40
    block_chars: int = 16 << 20


def letters_and_digits() -> np.ndarray:
    """For each code point, whether it counts."""
    return np.fromiter((chr(code).isalnum() for code in range(0x110000)), bool, 0x110000)


def normalised(text: str | None, counts: np.ndarray) -> np.ndarray:
    """Code points of a text in lower case, with one space for what does not count."""
    encoded = (text or "").lower().encode("utf-32-le", "surrogatepass")
    signs = np.frombuffer(encoded, "<u4")
    solid = counts[signs]
    kept = solid.copy()
    kept[:-1] |= solid[1:]  # of a run that does not count, its last sign becomes the space
    signs = np.where(solid, signs, np.uint32(32))[kept]
    start = int(len(signs) > 0 and signs[0] == 32)
    return signs[start:].astype(np.uint64)


def written(signs: np.ndarray) -> str:
    return signs.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def grams(signs: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all q-grams, put together from those of lengths 1, 2, 4 and so on."""
    if len(signs) < q:
        return np.zeros(0, np.uint64)
    part, length, factor = signs + np.uint64(1), 1, 0x9E3779B97F4A7C15
    hashes, done = None, 0
    while True:
        if q & length:
            if hashes is None:
                hashes = part
            else:
                hashes = hashes[: len(part) - done] * np.uint64(factor) + part[done:]
                hashes ^= hashes >> np.uint64(31)
            done += length
        if done == q:
            return hashes[: len(signs) - q + 1] * np.uint64(0xC2B2AE3D27D4EB4F)
        part = part[:-length] * np.uint64(factor) + part[length:]
        part ^= part >> np.uint64(29)
        length, factor = length * 2, (factor * factor + 2) % (1 << 64) | 1


def banded_distances(
    patterns: np.ndarray, text: np.ndarray, shifts: np.ndarray, width: int, most: int
) -> np.ndarray:
    """Edits to turn each row of ``patterns`` into a stretch of ``text``.

    Cells on the ``width`` diagonals from a row's shift on are filled, and the stretch may
    start and end at any of them. More than ``most`` comes back as ``most + 1``.
    """
    length = patterns.shape[1]
    at = np.arange(length + width - 1)[:, None] + shifts
    outside = (at < 0) | (at >= len(text))
    # A sign outside the text equals none: to replace one by it costs what dropping it does.
    signs = np.where(outside, _NO_SIGN, text[np.clip(at, 0, len(text) - 1)])
    offsets = np.arange(width, dtype=np.int32)[:, None]
    row = np.zeros((width, len(patterns)), np.int32)
    for i, sign in enumerate(patterns.T):
        best = row + (signs[i : i + width] != sign)
        np.minimum(best[:-1], row[1:] + np.int32(1), out=best[:-1])
        # Insertions run along the diagonals: a running minimum of cost less place.
        row = np.minimum.accumulate(best - offsets, axis=0) + offsets
        if i % 8 == 7 and row.min() > most:
            break
    return np.minimum(row.min(axis=0), most + 1)


class Benchmark:
    """The stretches of a block of benchmark texts and the places of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], bounds: Bounds) -> None:
        self.bounds, self.counts = bounds, letters_and_digits()
        texts = [(item, normalised(text, self.counts)) for item, text in items]
        short = [x for x in texts if 0 < len(x[1]) < max(bounds.shortest, bounds.q)]
        texts = [x for x in texts if len(x[1]) >= max(bounds.shortest, bounds.q)]
        self.items, self.texts = [item for item, _ in texts], [text for _, text in texts]
        # Short items by text, and by first word the numbers of words they have.
        self.short: dict[str, list[int]] = defaultdict(list)
        self.words: dict[str, set[int]] = defaultdict(set)
        for number, (item, text) in enumerate(short, len(self.items)):
            self.items.append(item)
            self.short[written(text)].append(number)
            words = _WORDS.findall(written(text))
            self.words[words[0]].add(len(words))
        hashes = [grams(text, bounds.q) for text in self.texts]
        owner = np.repeat(np.arange(len(texts)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes] or [np.zeros(0, int)])
        every = np.concatenate(hashes or [np.zeros(0, np.uint64)])
        order = np.argsort(every, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.hashes, self.first, self.held = np.unique(
            every[order], return_index=True, return_counts=True
        )
        stretches = [self.stretch(item) for item in range(len(texts))]
        # A stretch's diagonals span at most this many, and it shares so many q-grams.
        self.width = np.array([2 * edits + 1 for _, edits in stretches], np.int64)
        self.least = self._shared(stretches, bounds.q)
        self.least_short = self._shared(stretches, _SHORT)
        self.short_grams = [grams(text, _SHORT) for text in self.texts]
        self.bits = min(max(len(every).bit_length() + 3, _BITS[0]), _BITS[1])
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self._short(every)] = True

    @staticmethod
    def _shared(stretches: list[tuple[int, int]], q: int) -> np.ndarray:
        """How many q-grams each stretch shares at least, by the lemma."""
        least = [length + 1 - q * (edits + 1) for length, edits in stretches]
        return np.maximum(1, np.array(least, np.int64))

    def _short(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def stretch(self, item: int) -> tuple[int, int]:
        """Length of an item's stretches and the edits they may have."""
        length = min(len(self.texts[item]), self.bounds.window)
        return length, self.bounds.edits * length // self.bounds.window

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """Item, start and end in the normalised text, and edits of its best stretch."""
        signs = normalised(text, self.counts)
        return self._near(signs) + self._whole(signs)

    def _whole(self, signs: np.ndarray) -> list[tuple[int, int, int, int]]:
        """The first place of each short item."""
        best: dict[int, tuple[int, int, int, int]] = {}
        if not self.short:
            return []
        text = written(signs)
        spans = [word.span() for word in _WORDS.finditer(text)]
        for i, (start, end) in enumerate(spans):
            for count in self.words.get(text[start:end], ()):
                if i + count <= len(spans):
                    end = spans[i + count - 1][1]
                    for item in self.short.get(text[start:end], ()):
                        best.setdefault(item, (item, start, end, 0))
        return list(best.values())

    def _near(self, signs: np.ndarray) -> list[tuple[int, int, int, int]]:
        """The best stretches of the other items.

        The text is searched in parts that overlap by what a stretch may span. A part is as
        long as ``_HITS`` shared q-grams allow, so that a long text, or one with q-grams that
        stand in many items, takes more parts and not more memory.
        """
        hashes = grams(signs, self.bounds.q)
        at = np.flatnonzero(self.table[self._short(hashes)])
        if not len(at) or not len(self.hashes):
            return []
        slot = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        same = self.hashes[slot] == hashes[at]
        at, slot = at[same], slot[same]
        counts = self.held[slot]
        total, short = np.cumsum(counts), grams(signs, _SHORT)
        best: dict[int, tuple[int, int, int, int]] = {}
        span, first = self.bounds.window + self.bounds.edits, 0
        while first < len(at):
            # As many places as give no more hits, but all within a stretch's span at least.
            last = np.searchsorted(total, total[first] - counts[first] + _HITS, side="right")
            last = max(int(last), int(np.searchsorted(at, at[first] + 2 * span)))
            self._count(signs, short, at[first:last], slot[first:last], best)
            if last >= len(at):
                break
            first = max(first + 1, int(np.searchsorted(at, at[last - 1] - span)))
        return list(best.values())

    def _count(self, signs, short, at: np.ndarray, slot: np.ndarray, best: dict) -> None:
        """Count the q-grams at some places in bands, and align where there are enough."""
        counts = self.held[slot]
        if counts.sum() < self.least.min():
            return
        hit = np.repeat(self.first[slot] - np.cumsum(counts) + counts, counts)
        hit += np.arange(len(hit))
        at, owner, place = np.repeat(at, counts), self.owner[hit], self.place[hit]
        for lead in (0, 1):  # bands overlap by half, so that one holds all of a stretch
            width = self.width[owner]
            band = (at - place + lead * width) // (2 * width)
            key = (owner << 40) + band + (1 << 39)
            order = np.argsort(key, kind="stable")
            key = key[order]
            edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            enough = np.diff(edges) >= self.least[owner[order[edges[:-1]]]]
            for start, end in zip(edges[:-1][enough].tolist(), edges[1:][enough].tolist()):
                part = order[start:end]
                item = int(owner[part[0]])
                if item in best and best[item][3] == 0:
                    continue
                low = int(band[part[0]] * 2 * width[part[0]] - lead * width[part[0]])
                near = self._in_band(item, signs, short, (at - place)[part], place[part], low)
                if near and (item not in best or near[3] < best[item][3]):
                    best[item] = near

    def _in_band(self, item, signs, short, diagonal, place, low) -> tuple | None:
        """Align all stretches that hold enough of the q-grams shared in a band, long and
        short ones, which starts at the diagonal ``low``; the best one."""
        length, edits = self.stretch(item)
        text, width, best = self.texts[item], 2 * int(self.width[item]), None
        # Only stretches with some of the long q-grams.
        first = max(0, int(place.min()) + self.bounds.q - length)
        starts = np.arange(first, min(len(text) - length, int(place.max())) + 1)
        end = int(starts[-1]) + length
        long = np.zeros(end - first + 1, np.int64)
        long[place - first + 1] = 1  # a q-gram of the stretch counts once
        shared = _inside(long, starts - first, length - self.bounds.q + 1)
        due = starts[shared >= self.least[item]]
        if not len(due):
            return None
        own = self.short_grams[item][first : end - _SHORT + 1]
        at = np.arange(first, first + len(own)) + low + np.arange(width)[:, None]
        same = short[np.clip(at, 0, len(short) - 1)] == own
        same &= (at >= 0) & (at < len(short))
        present = np.concatenate([[0], same.any(axis=0)])
        shared = _inside(present, due - first, length - _SHORT + 1)
        due, shared = due[shared >= self.least_short[item]], shared[shared >= self.least_short[item]]
        order = np.argsort(-shared, kind="stable")
        due, shared = due[order], shared[order]
        # An edit takes at most so many of the q-grams, so no stretch has fewer than this.
        lowest = -((shared - (length - _SHORT + 1)) // _SHORT)
        most, start, size = edits, 0, 8
        while start < len(due) and lowest[start] <= most:
            some = due[start : start + size]
            start, size = start + size, min(2 * size, _ALIGNED)
            patterns = text[some[:, None] + np.arange(length)]
            distances = banded_distances(patterns, signs, some + low, width, most)
            distance = int(distances.min())
            if distance > most:
                continue
            found = int(some[np.argmin(distances)])
            inside = (place >= found) & (place <= found + length - self.bounds.q)
            shift = found + int(np.median(diagonal[inside]))
            best = item, max(0, shift), min(len(signs), shift + length), distance
            most = distance - 1
        return best


def _inside(present: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """How many of ``count`` places from each start on are marked, the first at 1."""
    total = np.cumsum(present)
    return total[starts + count] - total[starts]


def _blocks(benchmark: DataFrame, bounds: Bounds) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's texts in blocks of bounded size, one at a time."""
    block, size = [], 0
    for row in benchmark.toLocalIterator():
        if row["item_id"] is None or row["text"] is None:
            continue
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size >= bounds.block_chars:
            yield block
            block, size = [], 0
    yield block


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    bounds: Bounds = Bounds(),
) -> DataFrame:
    """One row per document and benchmark item found in it.

    ``start`` and ``end`` are places in the normalised text, ``edits`` the distance of the
    best stretch. Documents without text or id, and benchmark texts without id or without
    letters and digits, match nothing; those with fewer than ``shortest`` characters match
    as they are only. Rows of the documents that repeat an id give one row per item. The
    documents are read once for every ``block_chars`` of benchmark text and are not shuffled.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL"
    )
    kind = dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id bigint, item_id {kind}, start bigint, end bigint, edits bigint"
    found = None
    for block in _blocks(benchmark.select("item_id", "text"), bounds):
        sent = docs.sparkSession.sparkContext.broadcast((block, tuple(bounds)))

        def search(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            items, limits = sent.value
            index = Benchmark(items, Bounds(*limits))
            for batch in pieces(batches):
                out = [
                    (number, index.items[item], *place)
                    for number, value in zip(batch["doc_id"], batch["text"])
                    for item, *place in index.matches(value)
                ]
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "start", "end", "edits"])

        part = rows.mapInPandas(search, schema)
        found = part if found is None else found.unionByName(part)
    least = F.min(F.struct("edits", "start", "end")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(least).select("doc_id", "item_id", "best.*")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", bounds: Bounds = Bounds()
) -> DataFrame:
    """The rows in whose text no benchmark text was found, all columns as they are.

    Each row is judged by its own text, where it is read; nothing is shuffled. Null and empty
    texts stay. A benchmark without rows drops nothing, and an empty table gives an empty one.
    """
    clean = fresh(docs, "clean")
    names = all_columns(docs)
    for block in _blocks(benchmark.select("item_id", "text"), bounds):
        if not block:
            continue
        sent = docs.sparkSession.sparkContext.broadcast((block, tuple(bounds)))

        def judge(sent=sent):
            items, limits = sent.value
            index = Benchmark(items, Bounds(*limits))
            return lambda texts: [[not index.matches(value) for value in texts]]

        judged = with_answers(docs, text, judge, **{clean: "boolean"})
        docs = judged.where(F.col(quoted(clean))).select(*names)
    return docs
