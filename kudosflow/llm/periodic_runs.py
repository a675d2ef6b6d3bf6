"""Runs of words that repeat with a period, found by string synchronising sets.

A run is a stretch of consecutive words with smallest period p (words p apart are the
same) that holds its period three times or more and that no neighbouring word extends.

Periods up to ``SMALL`` are found by comparing words that far apart. For longer ones there
is one scale for each t = 4, 8, 16, ..., which finds the periods from 2t + 1 to 4t. Its
synchronising set holds the place i if, of the hashes of the t-word windows at i, ..., i+t,
the least is at i or i + t. So membership depends on the 2t words from i alone, and every
t places in a row have a member unless they lie in a stretch of period t // 3 or less.
Windows with such a period, known from smaller scales, take no part; where such a stretch
lies in a period, the place after it is a member.

Inside a run with period p, members come back p words on, with the same words after them.
As the words compared are at least p many, equal ones nearer than p would give a smaller
period. So neighbours among the places with equal context propose the period: contexts of
3t words for periods up to 3t, of 4t words for those up to 4t. In a run of three periods a
member, its context and the period fit whatever the scale's period is. Each proposal is
extended, word by word, to a whole run, so a hash decides nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kudosflow.llm.common import lists, record_batch

#: Periods that are found without a synchronising set: twice the smallest scale.
SMALL = 8
#: A run holds its period so many times.
TIMES = 3
#: Texts are searched together up to so many words; a longer text is searched by itself.
GROUP_WORDS = 200_000

#: What no window's hash reaches.
_NEVER = np.uint64((1 << 64) - 1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

_KIND = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    both = (left ^ (right << np.uint64(1))) * _FACTOR + right
    return (both ^ (both >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def _apart(words: np.ndarray, period: int) -> np.ndarray:
    """Start, end and period of all stretches with the period that hold it TIMES times."""
    differ = np.flatnonzero(words[:-period] != words[period:])
    edges = np.concatenate([[-1], differ, [len(words) - period]])
    chosen = np.flatnonzero(np.diff(edges) - 1 + period >= TIMES * period)
    start, end = edges[chosen] + 1, edges[chosen + 1] + period
    return np.stack([start, end, np.full(len(chosen), period)], axis=1)


def _extended(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The whole stretch with the period around ``at``."""
    low, step = at, 64
    while low > 0:
        size = min(step, low)
        part = slice(low - size, low)
        differ = np.flatnonzero(words[part] != words[low - size + period : low + period])
        if len(differ):
            low += int(differ[-1]) + 1 - size
            break
        low, step = low - size, 2 * step
    high, step, most = at, 64, len(words) - period
    while high < most:
        size = min(step, most - high)
        part = words[high + period : high + period + size]
        differ = np.flatnonzero(words[high : high + size] != part)
        if len(differ):
            high += int(differ[0])
            break
        high, step = high + size, 2 * step
    return low, high + period


def _members(hashes: np.ndarray, scale: int, periodic: np.ndarray) -> np.ndarray:
    """The synchronising set: ``hashes`` of windows of ``scale`` words, of which those at
    ``periodic`` places have a period of a third of that or less."""
    ids = np.where(periodic, _NEVER, hashes >> np.uint64(1))
    least, width = ids, 1
    while width < scale:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if len(ids) <= scale:
        return np.zeros(0, np.int64)
    least = np.minimum(least[: len(ids) - scale], ids[scale:])
    ends = (ids[: len(least)] == least) | (ids[scale:] == least)
    return np.flatnonzero(ends & (least != _NEVER))


def _covered(found: list[np.ndarray], scale: int, places: int) -> np.ndarray:
    """At which places a window of ``scale`` words has a period of ``scale // 3`` or less."""
    change = np.zeros(places + 1, np.int64)
    for part in found:
        start, end, period = part.T
        highly = (period <= scale // 3) & (end - start >= scale) & (start < places)
        np.add.at(change, start[highly], 1)
        np.add.at(change, np.minimum(end[highly] - scale + 1, places), -1)
    return np.cumsum(change[:-1]) > 0


def _proposed(
    members: np.ndarray, context: np.ndarray, shortest: int, longest: int
) -> np.ndarray:
    """Places and distances of neighbours with the same context, by distance and place."""
    order = np.argsort(context, kind="stable")
    place, context = members[order], context[order]
    distance = np.diff(place)
    fits = (context[1:] == context[:-1]) & (distance > shortest) & (distance <= longest)
    pairs = np.stack([distance[fits], place[:-1][fits]], axis=1)
    return pairs[np.lexsort(pairs.T[::-1])]


def _found_at(words: np.ndarray, hashes: np.ndarray, scale: int, found: list) -> np.ndarray:
    """Runs with periods over twice and up to four times the scale."""
    members = _members(hashes, scale, _covered(found, scale, len(hashes)))
    members = members[members + 2 * scale < len(hashes)]
    runs = []
    three = _mixed(_mixed(hashes[members], hashes[members + scale]), hashes[members + 2 * scale])
    inside = members + 3 * scale < len(hashes)
    longer = members[inside]
    four = _mixed(three[inside], hashes[longer + 3 * scale])
    for pairs in (
        _proposed(members, three, 2 * scale, 3 * scale),
        _proposed(longer, four, 3 * scale, 4 * scale),
    ):
        known = 0, 0, 0
        for period, place in pairs.tolist():
            if period == known[2] and known[0] <= place < known[1] - period:
                continue
            known = *_extended(words, place, period), period
            if known[1] - known[0] >= TIMES * period:
                runs.append(known)
    return np.array(runs, np.int64).reshape(-1, 3)


def runs_of(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Start, end and smallest period of all runs, by start and period.

    ``words`` are whole numbers from 0 of several texts, longest first, each followed by a
    negative number that is its own; ``ends`` are the places of those.
    """
    found = [np.zeros((0, 3), np.int64)]
    found += [_apart(words, period) for period in range(1, min(SMALL, len(words) - 1) + 1)]
    lengths = np.diff(ends, prepend=-1) - 1
    scale, hashes = 1, _mixed(words.astype(np.uint64), np.uint64(1))
    while True:
        if 2 * scale >= SMALL:
            # Only texts that can hold the scale's shortest period three times.
            count = int(np.searchsorted(-lengths, -TIMES * (2 * scale + 1), side="right"))
            if not count:
                break
            words = words[: ends[count - 1] + 1]
            hashes = hashes[: len(words) - scale + 1]
            found.append(_found_at(words, hashes, scale, found))
        if len(hashes) <= scale:
            break
        hashes, scale = _mixed(hashes[:-scale], hashes[scale:]), 2 * scale
    every = np.concatenate(found)
    # The same stretch with several periods: the least divides the others.
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    first = np.ones(len(every), bool)
    first[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    every = every[first]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def _searched(texts: list[list[bytes]], least: int) -> tuple[list[list[dict]], list[bytes]]:
    """Of each text, its runs, and its words without the repetitions."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    total = sum(map(len, texts)) + len(texts)
    words, ends, at = np.empty(total, np.int64), np.empty(len(texts), np.int64), 0
    for rank, i in enumerate(order):
        end = at + len(texts[i])
        words[at:end] = np.fromiter(map(numbers.__getitem__, texts[i]), np.int64, end - at)
        words[end], ends[rank], at = -1 - rank, end, end + 1
    del numbers
    runs = runs_of(words, ends)
    runs = runs[runs[:, 1] - runs[:, 0] >= least]
    dropped = np.zeros(total + 1, np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 1], -1)
    kept = np.cumsum(dropped[:-1]) == 0
    starts = np.concatenate([[0], ends[:-1] + 1])
    owner = np.searchsorted(ends, runs[:, 0])
    of_text: list[list[dict]] = [[] for _ in texts]
    for rank, (start, end, period) in zip(owner.tolist(), runs.tolist()):
        start, end = start - int(starts[rank]), end - int(starts[rank])
        run = {"start": start, "length": end - start, "period": period}
        of_text[order[rank]].append(run)
    collapsed = [b""] * len(texts)
    for rank, i in enumerate(order):
        part = texts[i]
        if of_text[i]:
            places = np.flatnonzero(kept[starts[rank] : ends[rank]])
            part = [part[place] for place in places.tolist()]
        collapsed[i] = b" ".join(part)
    return of_text, collapsed


def _groups(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    group, size = [], 0
    for row in rows:
        if group and size + len(row[1]) > GROUP_WORDS:
            yield group
            group, size = [], 0
        group.append(row)
        size += len(row[1])
    if group:
        yield group


def periodic_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: int = 24,
    change: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """``doc_id``, ``runs`` and ``collapsed`` of every row.

    ``runs`` has start (word number from 0), length and smallest period of each run of
    ``least`` words or more, by start, then period. ``collapsed`` has the words joined by one
    space, without those that some run holds after its first period. Words are what white
    space of ASCII divides. ``change`` may rewrite a text's words, in UTF-8, before.

    A null, an empty text and one without words have no runs and an empty ``collapsed``; an
    empty table gives an empty one. Rows that repeat an id, or have none, are rows of their
    own; other columns are not read. Texts are whole, however long: a worker needs some 150
    bytes for each word of the texts it searches together, 200,000 words or one longer text.
    """
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in lists(batches):
            split = (
                (number, change(number, words) if change else words)
                for number, words in (
                    (number, (value or b"").split())
                    for number, value in zip(part["doc_id"], part["text"])
                )
            )
            for group in _groups(split):
                runs, collapsed = _searched([words for _, words in group], least)
                yield record_batch(
                    doc_id=(pa.int64(), [number for number, _ in group]),
                    runs=(_RUNS, runs),
                    collapsed=(pa.binary(), collapsed),
                )

    found = rows.mapInArrow(search, f"doc_id bigint, runs {_KIND}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def foremost(runs: Column) -> Column:
    """The run that holds its period most often; of several the first, then the shortest
    period. Null if there is none."""

    def before(a: Column, b: Column) -> Column:
        # Exact: a length times a period stays far below 64 bits.
        more, less = a["length"] * b["period"], b["length"] * a["period"]
        return (
            F.when(more != less, F.when(more > less, -1).otherwise(1))
            .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
            .when(a["period"] != b["period"], F.when(a["period"] < b["period"], -1).otherwise(1))
            .otherwise(0)
        )

    return F.get(F.array_sort(runs, before), F.lit(0))


def written_runs(runs: Column) -> Column:
    """Each run's start, length and period as a line."""
    line = F.transform(runs, lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    return F.concat(F.array_join(line, "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))
