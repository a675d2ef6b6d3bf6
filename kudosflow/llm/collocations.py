"""Phrase collocation mining with exact counts from burst tries.

Phrases are counted in three passes: words, pairs, and phrases of three and four words. A
phrase occurs no more often than its parts, so a pass counts only phrases whose words, and
then whose pairs, may be frequent. Which may be is told by a bitmap of a fixed size: one
bit for each hash of a frequent phrase. Other phrases that meet a bit are counted in vain,
so a full bitmap costs time and changes no result.

A task counts in a trie over numbers of words, a trie for each language. Below a phrase's
first word hangs a hash container of the rest; one that grows too large bursts into a node
with a container for each next word. When the tries hold too many counts, whole subtrees are
spilled, the largest first, as sorted runs: the first word, and what follows it with its
counts. Runs meet in the partition of their language and first word and are merged there;
there are so many partitions that each merges about ``PART_ROWS`` occurrences. Subtrees of
frequent first words are dealt to ``SLICES`` partitions by a hash of the rest, so that none
holds much of all; all tasks learn these words from the first pass, as a bitmap too. Words
themselves are counted in one container, whose runs are dealt by a hash.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from kudosflow.llm.common import lists, record_batch, stored

#: Bits of a filter of frequent phrases, as a power of two: 8 MB.
FILTER_BITS = 26
#: Partitions of a frequent first word. A word is that with so many occurrences, or with
#: this share of all words if that is fewer.
SLICES = 256
SLICED_ROWS = 1_000_000
SLICED_SHARE = 1 / 500
#: Counts that a task's tries hold before subtrees are spilled, and words that it numbers.
HELD = 600_000
NUMBERED = 600_000
#: A container with more counts bursts.
BURST = 4_096
#: Partitions of the first pass; occurrences for each partition of the others, of which
#: there are at least 64.
WORD_PARTS = 2_048
PART_ROWS = 500_000
#: Bytes of text that are divided into words at once, phrases that are sorted at once before
#: they are counted, and counts in one row of a run.
CHUNK = 1 << 20
SORTED = 1 << 18
RUN_ROWS = 1 << 14

# A phrase's words after the first one are packed into one number, from the highest bits on.
_BITS = 21
_MASK = (1 << _BITS) - 1
_FACTOR = 0x9E3779B97F4A7C15
_WIDE = (1 << 64) - 1

# What divides a text into pieces becomes a word that no text has.
_BREAK = b"."
_SIGNS = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r",
    b"abcdefghijklmnopqrstuvwxyz.........",
)

_EDGE = re.compile(rb"[ \t.]")

_RUNS = "lang string, part int, subtrees binary, counts array<bigint>"
_COUNTS = "lang string, phrase string, words int, f bigint, place bigint"


class Mining(NamedTuple):
    """Candidates have ``least`` occurrences and are dropped inside a longer one with
    ``absorbed`` percent of theirs; the first ``top`` of each language are returned."""

    least: int = 30
    absorbed: int = 80
    top: int = 2_000


word_hash = xxh3_64_intdigest


def phrase_hash(lang: str, words: list[bytes]) -> int:
    value = word_hash(lang.encode())
    for word in words:
        value = (value ^ word_hash(word)) * _FACTOR & _WIDE
        value ^= value >> 29
    return value


def _joined(value: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word, as ``phrase_hash`` has them."""
    value = (value ^ words) * np.uint64(_FACTOR)
    return value ^ (value >> np.uint64(29))


class Filter:
    """The hashes that may be frequent, in ``1 << FILTER_BITS`` bits."""

    def __init__(self, bitmap: bytes) -> None:
        self.bitmap = np.frombuffer(bitmap, np.uint8)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - FILTER_BITS)
        bit = (place & np.uint64(7)).astype(np.uint8)
        return (self.bitmap[(place >> np.uint64(3)).astype(np.int64)] >> bit & 1).astype(bool)


class _Container(dict):
    """Counts of what follows, hashed."""


class _Node(dict):
    """A burst container: a container for each next word."""

    def __init__(self, container: _Container, shift: int) -> None:
        super().__init__()
        for rest, count in container.items():
            below = self.get(rest >> shift)
            if below is None:
                below = self[rest >> shift] = _Container()
            below[rest] = count

    def size(self) -> int:
        return sum(map(len, self.values()))


class Trie:
    """Counts of the phrases of one language: pairs, or phrases of three and four words."""

    def __init__(self, lang: str, longer: bool, parts: int, words, pairs, sliced) -> None:
        self.lang, self.longer, self.parts = lang, longer, parts
        self.is_frequent, self.is_pair, self.is_sliced = words, pairs, sliced
        # A pair's rest is one word; the highest of three words tells the next node.
        self.shift = 2 * _BITS if longer else 0
        self.clear()

    def clear(self) -> None:
        self.root: dict[int, _Container | _Node] = {}
        self.held = 0
        self.due: list[tuple[np.ndarray, ...]] = []
        self.words: list[bytes] = [_BREAK]
        self.numbers: dict[bytes, int] = defaultdict(None, {_BREAK: 0})
        self.numbers.default_factory = self.numbers.__len__
        self.hashes = np.zeros(1, np.uint64)
        self.frequent, self.sliced = np.zeros(1, bool), np.zeros(1, bool)
        self.start = np.uint64(word_hash(self.lang.encode()))

    def _learn(self) -> None:
        """What is asked of words, for those that are new."""
        new = list(islice(self.numbers, len(self.words), None))
        hashes = np.fromiter(map(word_hash, new), np.uint64, len(new))
        own = _joined(self.start, hashes)
        self.words += new
        self.hashes = np.concatenate([self.hashes, hashes])
        self.frequent = np.concatenate([self.frequent, self.is_frequent(own)])
        self.sliced = np.concatenate([self.sliced, self.is_sliced(own)])

    def add(self, tokens: list[bytes], known: int) -> None:
        """Count the phrases that do not lie in the first ``known`` tokens."""
        ids = np.fromiter(map(self.numbers.__getitem__, tokens), np.int64, len(tokens))
        if len(self.numbers) > len(self.words):
            self._learn()
        solid = self.frequent[ids]
        at = np.flatnonzero(solid[:-1] & solid[1:])
        if not self.longer:
            at = at[at >= known - 1]
            self.due.append((ids[at] << _BITS | ids[at + 1],))
        else:
            own = _joined(self.start, self.hashes[ids[at]])
            at = at[self.is_pair(_joined(own, self.hashes[ids[at + 1]]))]
            pair = np.zeros(len(ids) + 2, bool)
            pair[at] = True
            at = at[pair[at + 1]]
            four = at[pair[at + 2] & (at >= known - 3)]
            at = at[at >= known - 2]
            third = ids[at + 2] << _BITS, ids[four + 2] << _BITS | ids[four + 3]
            at = np.concatenate([at, four])
            self.due.append((ids[at] << _BITS | ids[at + 1], np.concatenate(third)))
        if sum(len(part[0]) for part in self.due) >= SORTED:
            self.count_due()

    def count_due(self) -> None:
        """Count what has been found since the last time, equal phrases at once."""
        if not self.due:
            return
        pairs, *third = map(np.concatenate, zip(*self.due))
        self.due = []
        if not self.longer:
            pairs, counts = np.unique(pairs, return_counts=True)
            self._insert(pairs >> _BITS, pairs & _MASK, counts)
            return
        # A phrase of four words is wider than 64 bits: its first two are numbered.
        pairs, number = np.unique(pairs, return_inverse=True)
        phrases, counts = np.unique(number << (2 * _BITS) | third[0], return_counts=True)
        pairs, last = pairs[phrases >> (2 * _BITS)], phrases & ((1 << 2 * _BITS) - 1)
        self._insert(pairs >> _BITS, (pairs & _MASK) << (2 * _BITS) | last, counts)

    def _insert(self, first: np.ndarray, rest: np.ndarray, counts: np.ndarray) -> None:
        root, shift, held = self.root, self.shift, 0
        for head, tail, count in zip(first.tolist(), rest.tolist(), counts.tolist()):
            below = root.get(head)
            if below is None:
                below = root[head] = _Container()
            if type(below) is _Node:
                node, below = below, below.get(tail >> shift)
                if below is None:
                    below = node[tail >> shift] = _Container()
            elif shift and len(below) > BURST:
                root[head] = _Node(below, shift)
                below = root[head].setdefault(tail >> shift, _Container())
            if tail in below:
                below[tail] += count
            else:
                below[tail] = count
                held += 1
        self.held += held

    def spilled(self, most: int) -> Iterator[tuple]:
        """Runs of the largest subtrees, until no more than ``most`` counts are held."""
        self.count_due()
        sizes = {
            head: below.size() if type(below) is _Node else len(below)
            for head, below in self.root.items()
        }
        gone = []
        for head in sorted(sizes, key=sizes.__getitem__, reverse=True):
            if self.held <= most:
                break
            gone.append(head)
            self.held -= sizes[head]
        runs = _Runs(self.lang)
        for head in sorted(gone, key=self.words.__getitem__):
            below = self.root.pop(head)
            if type(below) is _Node:
                below = {tail: n for part in below.values() for tail, n in part.items()}
            rests = list(map(self._rest, below) if self.longer else map(self.words.__getitem__, below))
            counts = dict(zip(rests, below.values()))
            rests.sort()
            word = self.words[head]
            first = zlib.crc32(word)
            if not self.sliced[head]:
                yield from runs.add(first % self.parts, word, rests, counts)
                continue
            slices = defaultdict(list)
            for rest in rests:
                slices[(first + zlib.crc32(rest) % SLICES) % self.parts].append(rest)
            for part, some in slices.items():
                yield from runs.add(part, word, some, counts)
        yield from runs.rest()

    def _rest(self, tail: int) -> bytes:
        words = self.words
        second, third, fourth = tail >> (2 * _BITS), tail >> _BITS & _MASK, tail & _MASK
        if fourth:
            return b" ".join((words[second], words[third], words[fourth]))
        return words[second] + b" " + words[third]


class _Runs:
    """Sorted runs of one spill, each of the subtrees that one partition merges.

    A subtree is its first word and what follows it, with tabs between, and a line ends it.
    """

    def __init__(self, lang: str) -> None:
        self.lang = lang
        self.held = defaultdict(lambda: ([], []))

    def add(self, part: int, head: bytes, rests: list[bytes], counts: dict) -> Iterator[tuple]:
        for start in range(0, len(rests), RUN_ROWS):
            some = rests[start : start + RUN_ROWS]
            subtrees, numbers = self.held[part]
            subtrees.append(b"\t".join([head, *some]))
            numbers.extend(map(counts.__getitem__, some))
            if len(numbers) >= RUN_ROWS:
                yield self._row(part)

    def rest(self) -> Iterator[tuple]:
        for part in sorted(self.held):
            yield self._row(part)

    def _row(self, part: int) -> tuple:
        subtrees, numbers = self.held.pop(part)
        return self.lang, part, b"\n".join(subtrees), numbers


class Words:
    """Counts of the words of one language, and of all of them under the empty word."""

    def __init__(self, lang: str) -> None:
        self.lang = lang
        self.clear()

    def clear(self) -> None:
        self.counts: Counter[bytes] = Counter()
        self.numbers = ()  # none has a number

    @property
    def held(self) -> int:
        return len(self.counts)

    def add(self, tokens: list[bytes], known: int) -> None:
        self.counts.update(tokens[known:] if known else tokens)
        self.counts[b""] += len(tokens) - known - self.counts.pop(_BREAK, 0)

    def spilled(self, most: int) -> Iterator[tuple]:
        """Runs of all words, if there are more than ``most`` of them."""
        if self.held <= most:
            return
        parts = defaultdict(list)
        for word in self.counts:
            parts[zlib.crc32(word) % WORD_PARTS].append(word)
        runs = _Runs(self.lang)
        for part, words in parts.items():
            yield from runs.add(part, b"", sorted(words), self.counts)
        yield from runs.rest()
        self.clear()


def _tokens(texts: list[bytes | None]) -> Iterator[tuple[list[bytes], int]]:
    """Words, with breaks between pieces, of chunks of the texts. If a chunk ends within a
    piece, its last words come again before the next one's; their number comes along."""
    text = _BREAK.join([value for value in texts if value]).translate(_SIGNS)
    start, last = 0, []
    while start < len(text):
        cut = _EDGE.search(text, start + CHUNK)
        end = cut.start() if cut else len(text)
        tokens = last + text[start:end].replace(_BREAK, b" . ").split()
        yield tokens, len(last)
        start, last = end, tokens[-3:] if cut and cut[0] != _BREAK else []


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        lang, part, subtrees, counts = zip(*held)
        return record_batch(
            lang=(pa.string(), lang),
            part=(pa.int32(), part),
            subtrees=(pa.binary(), subtrees),
            counts=(pa.list_(pa.int64()), counts),
        )

    for row in rows:
        held.append(row)
        size += len(row[3])
        if size >= 1 << 17:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _counted(docs: DataFrame, make, least: int) -> DataFrame:
    """Phrases with ``least`` occurrences, counted by what ``make`` gives for a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = {}

        def runs() -> Iterator[tuple]:
            for part in lists(batches, 1_024):
                texts = defaultdict(list)
                for lang, value in zip(part["lang"], part["text"]):
                    texts[lang].append(value)
                for lang, values in texts.items():
                    if lang not in tries:
                        tries[lang] = make(lang)
                    for tokens, known in _tokens(values):
                        tries[lang].add(tokens, known)
                        if sum(trie.held for trie in tries.values()) > HELD:
                            yield from max(tries.values(), key=lambda t: t.held).spilled(HELD // 8)
                        if sum(len(trie.numbers) for trie in tries.values()) > NUMBERED:
                            largest = max(tries.values(), key=lambda t: len(t.numbers))
                            yield from largest.spilled(0)
                            largest.clear()
            for trie in tries.values():
                yield from trie.spilled(0)

        with _uncollected():
            yield from _batches(runs())

    def frequent(lang: str, totals: dict[bytes, dict[bytes, int]]) -> Iterator[tuple]:
        for head, below in totals.items():
            start = [head] if head else []
            for rest, total in below.items():
                if total >= least or not rest:
                    phrase = [*start, *rest.split(b" ")] if rest else []
                    place = phrase_hash(lang, phrase) >> (64 - FILTER_BITS)
                    yield lang, b" ".join(phrase).decode(), len(phrase), total, place

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, totals = None, {}
        for rows in lists(batches, 64):
            columns = rows["lang"], rows["part"], rows["subtrees"], rows["counts"]
            for lang, part, subtrees, counts in zip(*columns):
                if (lang, part) != key:
                    yield from frequent(key[0], totals) if key else ()
                    key, totals = (lang, part), {}
                following = iter(counts)
                for subtree in subtrees.split(b"\n"):
                    head, *rests = subtree.split(b"\t")
                    below = totals.setdefault(head, {})
                    for rest, count in zip(rests, following):
                        below[rest] = below.get(rest, 0) + count
        yield from frequent(key[0], totals) if key else ()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _uncollected():
            rows = merged(batches)
            while out := list(islice(rows, 10_000)):
                lang, phrase, words, f, place = zip(*out)
                yield record_batch(
                    lang=(pa.string(), lang),
                    phrase=(pa.string(), phrase),
                    words=(pa.int32(), words),
                    f=(pa.int64(), f),
                    place=(pa.int64(), place),
                )

    dealt = docs.mapInArrow(count, _RUNS).repartition("lang", "part")
    dealt = dealt.sortWithinPartitions("lang", "part")
    return stored(dealt.mapInArrow(merge, _COUNTS), "phrases")


@contextmanager
def _uncollected() -> Iterator[None]:
    """Millions of counts are no garbage: they are not searched for cycles."""
    collecting = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if collecting:
            gc.enable()


def _bitmap(counts: DataFrame) -> bytes:
    """The filter of all phrases of a table of counts: a row for each 4 KB of it comes to the
    driver, however many phrases there are."""
    width = 1 << 15
    found = counts.groupBy(F.shiftright("place", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(width - 1))).alias("bits")
    )
    bitmap = bytearray(1 << (FILTER_BITS - 3))
    for row in found.collect():
        start = row["part"] * (width // 8)
        bitmap[start : start + width // 8] = row["bits"]
    return bytes(bitmap)


def count_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30
) -> tuple[DataFrame, DataFrame]:
    """All words and phrases of up to four words with ``least`` occurrences in a language, as
    ``lang, phrase, words, f``; and of each language the number ``n`` of its words."""
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.col(text).cast("binary").alias("text"),
    ).where("text IS NOT NULL")

    def sent(bitmap: bytes):
        return spark.sparkContext.broadcast(bitmap)

    one = _counted(rows, Words, least)
    totals = one.where("words = 0").select("lang", F.col("f").alias("n"))
    one = one.where("words = 1")
    every = totals.agg(F.sum("n")).first()[0] or 0
    sliced = sent(_bitmap(one.where(F.col("f") >= min(SLICED_ROWS, every * SLICED_SHARE))))
    words = sent(_bitmap(one))
    parts = max(64, every // PART_ROWS)

    def pair_trie(lang: str) -> Trie:
        return Trie(lang, False, parts, Filter(words.value), None, Filter(sliced.value))

    two = _counted(rows, pair_trie, least)
    pairs = sent(_bitmap(two))

    def longer_trie(lang: str) -> Trie:
        known = Filter(words.value), Filter(pairs.value), Filter(sliced.value)
        return Trie(lang, True, parts, *known)

    more = _counted(rows, longer_trie, least)
    return reduce(DataFrame.unionByName, (one, two, more)).drop("place"), totals


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", mining: Mining = Mining()
) -> DataFrame:
    """The foremost collocations of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lowered from A to Z, divided into pieces at ``.,;:!?`` and line ends, and into
    words at spaces and tabs. A candidate has two to four words of one piece and occurs
    ``a >= least`` times. Cut after k words, whose parts occur l and r times, it scores
    ``floor(2000000 * a / (l + r))``; its lowest score counts, of equal ones that with the
    smallest k. Candidates inside a longer one with enough of their occurrences are dropped.
    The order is score, then ``a``, both falling, then the phrase by its bytes. Products are
    decimals of 38 digits.

    A null language is ``und``. Null and empty texts have no words, and an empty table gives
    an empty one. Rows that are repeated count as often; other columns are not read. Texts are
    whole, however long; they are counted in chunks of about a megabyte.
    """
    counts, totals = count_phrases(docs, text, lang, mining.least)
    phrases = counts.where("words >= 2").withColumn("w", F.split("phrase", " "))

    def part(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cuts = phrases.select(
        "lang", "phrase", F.col("f").alias("a"), "w", "words",
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"),
    )
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        part(F.lit(1), F.col("k")).alias("first"),
        part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"),
    )
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr("CAST(2000000 AS DECIMAL(18,0)) * a DIV (CAST(l AS DECIMAL(20,0)) + r)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    scored = (
        cuts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .groupBy("lang", "phrase")
        .agg(F.first("a").alias("a"), best)
    )
    inside = F.expr(
        "flatten(transform(sequence(2, words - 1), size -> transform("
        "sequence(1, words - size + 1), start -> array_join(slice(w, start, size), ' '))))"
    )
    longest = (
        phrases.where("words > 2")
        .select("lang", F.explode(inside).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    enough = F.lit(100).cast("decimal(3,0)") * F.col("longer") >= F.lit(mining.absorbed).cast(
        "decimal(3,0)"
    ) * F.col("a")
    kept = scored.join(longest, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | ~enough
    )
    order = Window.partitionBy("lang").orderBy(F.col("best.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= mining.top
    )
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "best.l", "best.r", "n",
        "best.score",
    )


ORACLE_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]'
        )) AS piece
    FROM documents
    WHERE text IS NOT NULL
),
divided AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
),
totals AS (
    SELECT lang, sum(len(w)) AS n FROM divided GROUP BY lang
),
places AS (
    SELECT lang, number, unnest(w) AS w1, unnest(range(len(w))) AS place
    FROM (SELECT lang, w, row_number() OVER () AS number FROM divided)
),
following AS (
    SELECT *, lead(w1, 1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3, lead(w1, 3) OVER piece AS w4
    FROM places
    WINDOW piece AS (PARTITION BY number ORDER BY place)
),
counts AS MATERIALIZED (
    SELECT lang, phrase, words, count(*) AS f
    FROM (
        SELECT lang, 1 AS words, w1 AS phrase FROM following
        UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM following
        UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM following
        UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM following
    )
    WHERE phrase IS NOT NULL
    GROUP BY lang, phrase, words
    HAVING count(*) >= 30
),
phrases AS (
    SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE words >= 2
),
parts AS MATERIALIZED (
    SELECT p.lang, p.phrase, p.f AS a, k.k,
        array_to_string(p.w[1 : k.k], ' ') AS first, array_to_string(p.w[k.k + 1 :], ' ') AS rest
    FROM phrases p
    JOIN range(1, 4) AS k(k) ON k.k < p.words
),
cuts AS (
    SELECT p.lang, p.phrase, p.a, p.k, l.f AS l, r.f AS r,
        (2000000::HUGEINT * p.a) // (l.f + r.f) AS score
    FROM parts p
    JOIN counts l ON l.lang = p.lang AND l.phrase = p.first
    JOIN counts r ON r.lang = p.lang AND r.phrase = p.rest
),
scored AS (
    SELECT * FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
inside AS (
    SELECT p.lang, array_to_string(p.w[s.s : s.s + n.n - 1], ' ') AS phrase, max(p.f) AS longer
    FROM phrases p
    JOIN range(2, 4) AS n(n) ON n.n < p.words
    JOIN range(1, 4) AS s(s) ON s.s + n.n - 1 <= p.words
    GROUP BY 1, 2
),
ranked AS (
    SELECT s.*, row_number() OVER (
        PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase
    ) AS rank
    FROM scored s
    LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
    WHERE i.longer IS NULL OR 100 * i.longer < 80 * s.a
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n::BIGINT AS n, r.score::BIGINT AS score
FROM ranked r
JOIN totals t ON t.lang = r.lang
WHERE r.rank <= 2000
"""
