"""An adaptive context-mixing range coder for token ids.

A block's ids are cut into lanes, which are coded side by side: each step codes one id
of every lane and then updates one model from all of them, so that numpy does the work
and the model still learns from the whole block. The range is divided among three
predictions, whose shares are mixed from how often they have been right of late:

* the id that followed the last two ids before (order 2),
* the id that followed the last id before (order 1),
* and for any other, all ids by their frequency so far (order 0).

All of it is integer arithmetic, so that any machine decodes what another has coded.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_WORD, _LOW = U(32), U(0xFFFFFFFF)
#: Shares of the range have 24 bits, and frequencies of order 0 have 20, so that the
#: sixteenth of the range that is left to them gives each id a share. A range is kept
#: above 2**26.
_TOTAL, _ORDER0 = 24, 20
_LEAST = U(1 << 26)
#: Frequencies and mixing are learned from what was coded after 1, 2, 4 and more steps, and
#: then each time after so many.
_REFRESH = 16
_SLOTS = 18
_FACTOR1, _FACTOR2, _SHIFT = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(32 - _SLOTS)


class _Lanes:
    """The state of one range coder per lane, without carries, in 32-bit words."""

    def __init__(self, lanes: int) -> None:
        self.low = np.zeros(lanes, U)
        self.range = np.full(lanes, np.iinfo(U).max, U)

    def unit(self, n: int) -> np.ndarray:
        return self.range[:n] >> U(_TOTAL)

    def narrow(self, start: np.ndarray, width: np.ndarray) -> None:
        """Go on with a part of the range in each of the first lanes."""
        n = len(start)
        self.low[:n] += start
        self.range[:n] = width
        # A wider range cannot have its top word settled.
        at = np.flatnonzero(width <= _LOW)
        while len(at):
            low, size = self.low[at], self.range[at]
            settled = ((low ^ (low + size - U(1))) >> _WORD) == 0
            due = settled | (size < _LEAST)
            at, low, size, settled = at[due], low[due], size[due], settled[due]
            # A short range across two top words is cut to end with the first.
            size = np.where(settled, size, (~low + U(1)) & _LOW) << _WORD
            self._shift(at, low)
            self.low[at] = low << _WORD
            self.range[at] = size
            at = at[size <= _LOW]


class Writer(_Lanes):
    reads = False

    def __init__(self, lanes: int) -> None:
        super().__init__(lanes)
        self.words: list[np.ndarray] = []
        self.owners: list[np.ndarray] = []

    def _shift(self, at: np.ndarray, low: np.ndarray) -> None:
        self.words.append((low >> _WORD).astype(np.uint32))
        self.owners.append(at)

    def finished(self) -> tuple[np.ndarray, np.ndarray]:
        """Words by lane, and how many each lane has."""
        lanes = np.arange(len(self.low))
        for _ in range(2):
            self._shift(lanes, self.low)
            self.low = self.low << _WORD
        owners, words = np.concatenate(self.owners), np.concatenate(self.words)
        counts = np.bincount(owners, minlength=len(lanes)).astype(np.uint32)
        return words[np.argsort(owners.astype(np.uint16), kind="stable")], counts


class Reader(_Lanes):
    reads = True

    def __init__(self, words: np.ndarray, counts: np.ndarray) -> None:
        super().__init__(len(counts))
        self.words = words.astype(U)
        self.next = np.cumsum(counts.astype(np.int64)) - counts
        self.code = (self.words[self.next] << _WORD) | self.words[self.next + 1]
        self.next += 2

    def _shift(self, at: np.ndarray, low: np.ndarray) -> None:
        # A lane that is read to its end asks for words that decide nothing any more.
        place = np.minimum(self.next[at], len(self.words) - 1)
        self.code[at] = (self.code[at] << _WORD) | self.words[place]
        self.next[at] += 1

    def place(self, n: int) -> np.ndarray:
        """How far into their ranges the first lanes are."""
        return self.code[:n] - self.low[:n]


#: A context is how often order 2 and order 1 have been right of late, from 0 to 7 each, and
#: whether they agree.
_CONTEXTS = 128
_SURE2 = (np.arange(_CONTEXTS) >> 4) * 2 + np.arange(_CONTEXTS) % 2
_SURE1 = np.arange(_CONTEXTS) % 16
_AGREE = np.arange(_CONTEXTS) % 2 == 1
#: What becomes of such a count after a miss and after a hit.
_NEXT = np.array([[n >> 1 for n in range(8)], [min(n + 1, 7) for n in range(8)]], np.int32)


class _Mixed:
    """The chance of a prediction in two views of the context, weighed by which was closer."""

    def __init__(self, views: tuple[np.ndarray, np.ndarray]) -> None:
        self.views = views
        self.right = np.ones((2, 16), np.int64)
        self.seen = np.full((2, 16), 2, np.int64)
        self.weight = 1 << 15

    def chances(self) -> np.ndarray:
        """By context, in parts of 2**16."""
        one, two = ((self.right << 16) // self.seen)[[0, 1]]
        mixed = one[self.views[0]] * self.weight + two[self.views[1]] * ((1 << 16) - self.weight)
        return mixed >> 16

    def learn(self, wrong: np.ndarray, right: np.ndarray) -> None:
        """From how often the prediction was wrong and right in each context."""
        before, errors = (self.right << 16) // self.seen, []
        for k, view in enumerate(self.views):
            missed, hit = (
                np.bincount(view, counts, 16).astype(np.int64) for counts in (wrong, right)
            )
            errors.append(int((missed * before[k] + hit * ((1 << 16) - before[k])).sum()))
            self.right[k] += 2 * hit
            self.seen[k] += 2 * (hit + missed)
        full = self.seen > 1 << 20
        self.seen[full] >>= 1
        self.right[full] >>= 1
        self.right = np.clip(self.right, 1, self.seen - 1)
        if errors[0] != errors[1]:
            goal = 1 << 16 if errors[0] < errors[1] else 0
            self.weight = min(max(self.weight + ((goal - self.weight) >> 3), 2048), 63488)


class _Model:
    def __init__(self, vocabulary: int) -> None:
        self.vocabulary = vocabulary
        # What followed, and in the low bits how often that was right of late, to 7.
        self.after2 = np.zeros(1 << _SLOTS, np.int32)
        self.after1 = np.zeros(vocabulary, np.int32)
        self.first, self.second = _Mixed((_SURE2, _SURE1)), _Mixed((_SURE1, _SURE2))
        self.counts = np.ones(vocabulary, np.int64)
        self.recent: list[tuple] = []
        self.wait = 1
        self._take_over()

    def _take_over(self) -> None:
        chance = np.minimum(self.first.chances(), 59_000) + 64
        other = ((61_000 - chance) * self.second.chances() >> 16) + 64
        other[_AGREE] = 0
        # Where the shares of order 2 and then of order 1 end.
        self.end2 = (chance << 8).astype(U)
        self.end1 = ((chance + other) << 8).astype(U)
        sums = np.concatenate([[0], np.cumsum(self.counts)])
        scale = 1 << max(0, int(sums[-1]).bit_length() - 20)  # so that products stay small
        room = (1 << _ORDER0) - self.vocabulary
        parts = sums // scale * room // (int(sums[-1]) // scale + 1)
        self.sums = (parts + np.arange(len(sums))).astype(U)
        self.sums[-1] = U(1 << _ORDER0)
        self.owner = None  # of each part, if it is asked for

    def _owners(self) -> np.ndarray:
        if self.owner is None:
            parts = np.diff(self.sums).astype(np.int64)
            self.owner = np.repeat(np.arange(self.vocabulary, dtype=np.int32), parts)
        return self.owner

    def step(self, coder, last: np.ndarray, before: np.ndarray, ids: np.ndarray | None):
        """Code one id of each of the first lanes; ``ids`` is None when reading."""
        place = (last.view(np.uint32) * _FACTOR1 + before.view(np.uint32) * _FACTOR2) >> _SHIFT
        known2, known1 = self.after2.take(place), self.after1.take(last)
        two, one = known2 >> 3, known1 >> 3
        sure2, sure1 = known2 & 7, known1 & 7
        context = (sure2 << 4) + (sure1 << 1) + (two == one)
        unit = coder.unit(len(last))
        end2, end1 = unit * self.end2.take(context), unit * self.end1.take(context)
        if ids is None:
            value = coder.place(len(last))
            hit2, miss = value < end2, np.flatnonzero(value >= end1)
            ids = np.where(hit2, two, one)
        else:
            hit2 = ids == two
            miss = np.flatnonzero(~(hit2 | (ids == one)))
        start = np.where(hit2, U(0), end2)
        width = np.where(hit2, end2, end1 - end2)
        # The others share what is left by their frequencies.
        first, own = end1[miss], unit[miss]
        room = U(1 << _TOTAL) - self.end1.take(context[miss])
        if coder.reads:
            inside = np.minimum((value[miss] - first) // own, room - U(1))
            part = self._owners().take(((inside + U(1) << U(_ORDER0)) - U(1)) // room)
            ids[miss] = part
        else:
            part = ids[miss]
        begin = self.sums.take(part) * room >> U(_ORDER0)
        start[miss] = first + own * begin
        width[miss] = own * ((self.sums.take(part + 1) * room >> U(_ORDER0)) - begin)
        coder.narrow(start, width)
        right1 = ids == one
        self.after2[place] = (ids << 3) + _NEXT.take(sure2 + (hit2 << 3))
        self.after1[last] = (ids << 3) + _NEXT.take(sure1 + (right1 << 3))
        self.recent.append((ids, context * 4 + hit2 * 2 + right1))
        if len(self.recent) == self.wait:
            self.wait = min(2 * self.wait, _REFRESH)
            self._learn()
        return ids

    def _learn(self) -> None:
        ids, outcomes = map(np.concatenate, zip(*self.recent))
        self.recent = []
        # By context: neither right, order 1, order 2, both.
        neither, only1, only2, both = np.bincount(outcomes, minlength=4 * _CONTEXTS).reshape(-1, 4).T
        self.first.learn(neither + only1, only2 + both)
        self.second.learn(np.where(_AGREE, 0, neither), only1)
        self.counts += 32 * np.bincount(ids, minlength=self.vocabulary)
        self._take_over()


def lanes_of(n: int) -> int:
    """Lanes for a block of so many ids: enough steps to learn from, at most 8,192."""
    return max(1, min(8192, n // 256))


def _run(coder, n: int, lanes: int, vocabulary: int, ids: np.ndarray | None) -> np.ndarray:
    """Code ``n`` ids; lane by lane they are the block's, step by step they are coded."""
    steps, longer = divmod(n, lanes)  # the first lanes have one more
    cut = longer * (steps + 1)
    out = np.zeros((steps + (longer > 0), lanes), np.int32)
    if ids is not None:
        out[:, :longer] = ids[:cut].reshape(longer, -1).T if longer else 0
        out[:steps, longer:] = ids[cut:].reshape(lanes - longer, steps).T
    model = _Model(vocabulary)
    last, before = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
    for t in range(len(out)):
        active = lanes if t < steps else longer
        row = out[t, :active]
        found = model.step(coder, last[:active], before[:active], None if ids is None else row)
        row[:] = found
        before, last = last[:active], found
    return np.concatenate([out[:, :longer].T.ravel(), out[:steps, longer:].T.ravel()])


def encode(ids: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and their number by lane of at least one id, each below ``vocabulary``."""
    if vocabulary > 1 << (_ORDER0 - 1):
        raise ValueError(f"{vocabulary} ids are too many")
    lanes = lanes_of(len(ids))
    writer = Writer(lanes)
    _run(writer, len(ids), lanes, vocabulary, ids)
    return writer.finished()


def decode(words: np.ndarray, counts: np.ndarray, n: int, vocabulary: int) -> np.ndarray:
    return _run(Reader(words, counts), n, len(counts), vocabulary, None)
