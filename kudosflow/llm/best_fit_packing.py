"""Packing documents into sequences by linear grouping.

What is solved is the histogram of piece lengths, which has at most as many rows as a
sequence has tokens, however many documents there are:

1. Long lengths are sorted and cut into groups of equal cardinality, and rounded up to
   the longest of their group.
2. Configurations of these few sizes are chosen, each by a knapsack that fills a
   sequence best from the largest size left, and used as often as the sizes last.
3. Actual lengths take the places of the rounded ones, in order, so that sequences of
   equal contents stay in runs.
4. Short lengths go by best fit into what is left of the runs, then into new sequences.

The outcome says for each length which ranks of it go where. Every piece then finds its
place from its length and its rank among pieces of that length; the ranks are counted in
bins, so that no length ends up in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kudosflow.llm.common import lists, numbered, record_batch, stored
from kudosflow.llm.tokens import kept_encoder


@dataclass
class Run:
    """``n`` sequences of equal lengths, from ``(length, rank)`` of the first one's pieces."""

    n: int
    contents: list[tuple[int, int]]
    free: int

    def cut(self, n: int) -> tuple[Run, Run]:
        rest = [(length, rank + n) for length, rank in self.contents]
        return Run(n, list(self.contents), self.free), Run(self.n - n, rest, self.free)


class Packer:
    """Packs a histogram of lengths, all from 1 to ``limit``."""

    def __init__(self, histogram: dict[int, int], limit: int, groups: int, short: int) -> None:
        self.limit, self.short = limit, short
        self.counts = dict(histogram)
        self.taken = dict.fromkeys(histogram, 0)
        self.runs: list[Run] = []
        self._long(groups)
        self._short()

    def _take(self, length: int, n: int) -> int:
        """The rank of the first of the next ``n`` pieces of a length."""
        rank = self.taken[length]
        self.taken[length] = rank + n
        return rank

    def _grouped(self, groups: int) -> list[list[list[int]]]:
        """Long lengths, longest first, as groups of ``[length, count]``."""
        lengths = sorted((x for x in self.counts if x > self.short), reverse=True)
        total = sum(self.counts[x] for x in lengths)
        each, out, room = -(-total // groups) if total else 1, [], 0
        for length in lengths:
            left = self.counts[length]
            while left:
                if not room:
                    out.append([])
                    room = each
                n = min(left, room)
                out[-1].append([length, n])
                left, room = left - n, room - n
        return out

    def _configuration(self, sizes: list[int], left: list[int]) -> dict[int, int]:
        """Copies of each size for one sequence, with one of the largest size left."""
        first = next(i for i, n in enumerate(left) if n)
        start, mask = sizes[first], (1 << (self.limit + 1)) - 1
        reached, came = 1 << start, {}
        for i in range(first, len(sizes)):
            most = min(left[i] - (i == first), (self.limit - start) // sizes[i])
            for _ in range(most):
                new = (reached << sizes[i]) & mask & ~reached
                if not new:
                    break
                reached |= new
                while new:
                    low = new & -new
                    came[low.bit_length() - 1] = i
                    new ^= low
            if reached >> self.limit:
                break
        chosen, total = {first: 1}, reached.bit_length() - 1
        while total != start:
            chosen[came[total]] = chosen.get(came[total], 0) + 1
            total -= sizes[came[total]]
        return chosen

    def _long(self, groups: int) -> None:
        queues = self._grouped(groups)
        sizes = [queue[0][0] for queue in queues]
        left = [sum(n for _, n in queue) for queue in queues]
        while any(left):
            chosen = self._configuration(sizes, left)
            times = min(left[i] // copies for i, copies in chosen.items())
            slots = []
            for i, copies in chosen.items():
                left[i] -= copies * times
                for _ in range(copies):
                    slots.append(self._slot(queues[i], times))
            self._substitute(slots, times)

    def _slot(self, queue: list[list[int]], n: int) -> list[tuple[int, int, int]]:
        """The next ``n`` actual lengths of a group: place of the first, length, rank."""
        out, at = [], 0
        while at < n:
            length, held = queue[0]
            used = min(held, n - at)
            out.append((at, length, self._take(length, used)))
            at += used
            queue[0][1] -= used
            if not queue[0][1]:
                queue.pop(0)
        return out

    def _substitute(self, slots: list[list[tuple[int, int, int]]], times: int) -> None:
        cuts = sorted({at for slot in slots for at, _, _ in slot} | {times})
        index = [0] * len(slots)
        for start, end in zip(cuts, cuts[1:]):
            contents = []
            for k, slot in enumerate(slots):
                while index[k] + 1 < len(slot) and slot[index[k] + 1][0] <= start:
                    index[k] += 1
                at, length, rank = slot[index[k]]
                contents.append((length, rank + start - at))
            free = self.limit - sum(length for length, _ in contents)
            self.runs.append(Run(end - start, contents, free))

    def _short(self) -> None:
        by_free: list[list[Run]] = [[] for _ in range(self.limit + 1)]
        for run in self.runs:
            by_free[run.free].append(run)
        lengths = sorted((x for x in self.counts if x <= self.short), reverse=True)
        for length in lengths:
            left, free = self.counts[length], length
            while left:
                while free <= self.limit and not by_free[free]:
                    free += 1
                if free > self.limit:  # new sequences, as many as full ones need
                    each = self.limit // length
                    by_free[self.limit].append(Run(-(-left // each), [], self.limit))
                    free = self.limit
                run = by_free[free].pop()
                if run.n > left:
                    run, rest = run.cut(left)
                    by_free[free].append(rest)
                run.contents.append((length, self._take(length, run.n)))
                left -= run.n
                run.free -= length
                by_free[run.free].append(run)
                free = max(length, min(free, run.free))
        self.runs = [run for runs in by_free for run in runs if run.contents]

    def plan(self) -> np.ndarray:
        """Rows of length, first rank, first sequence and offset, by length and rank."""
        rows, sequence = [], 0
        for run in self.runs:
            offset = 0
            for length, rank in run.contents:
                rows.append((length, rank, sequence, offset))
                offset += length
            sequence += run.n
        return np.array(sorted(rows), np.int64).reshape(-1, 4)


def token_pieces(
    df: DataFrame,
    tokenizer_json: str,
    limit: int = 2048,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``limit`` tokens: ``doc_id, piece, start, length, ids_crc32``.

    A document is its text's ids and ``end_id``; a missing text is empty. Only longer
    ones are cut. With ``ids`` the token ids come along, as little-endian bytes.
    """
    sent = df.sparkSession.sparkContext.broadcast({"json": tokenizer_json})
    end = np.array([end_id], "<u4").tobytes()

    kinds = dict(doc_id="int64", piece="int32", start="int64", length="int64", ids_crc32="int64")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(sent.value)
        for batch in lists(batches):
            rows = []
            for number, found in zip(batch["doc_id"], encoder.ids(batch["text"])):
                found += end
                for piece, at in enumerate(range(0, len(found), 4 * limit)):
                    part = found[at : at + 4 * limit]
                    row = (number, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part) if ids else row)
            columns = zip((kinds | {"ids": "binary"} if ids else kinds).items(), zip(*rows))
            yield record_batch(**{name: (kind, values) for (name, kind), values in columns})

    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return rows.mapInArrow(cut, schema + ", ids binary" * ids)


#: Numbers of groups, and what the limit is divided by for the longest short length. Few
#: groups waste room in each sequence, many leave odd configurations at the end.
SHAPES = (256, 16), (512, 16), (1024, 8), (2048, 4), (2048, 2)


def fewest(counts: dict[int, int], limit: int, shapes=SHAPES) -> Packer:
    """The packing with the fewest sequences, by several numbers of groups; of equal ones the
    first. Each is planned on the histogram, whose size the limit bounds."""
    packers = (Packer(counts, limit, groups, limit // part) for groups, part in shapes)
    return min(packers, key=lambda packer: sum(run.n for run in packer.runs))


def pack(rows: DataFrame, limit: int = 2048, shapes=SHAPES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have ``length`` and an order.

    Pieces of one sequence follow each other without gaps. Equal pieces may stand for
    one another. The rows should be stored: they are read three times.
    """
    counts = {row["length"]: row["count"] for row in rows.groupBy("length").count().collect()}
    if any(not 1 <= length <= limit for length in counts):
        raise ValueError(f"a piece has no tokens or more than {limit}")
    plan = fewest(counts, limit, shapes).plan()
    sent = rows.sparkSession.sparkContext.broadcast(plan)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        keys = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            *passed, rank = batch.columns
            names = batch.schema.names[:-1]
            rank = rank.to_numpy().astype(np.int64)
            lengths = batch.column(names.index("length")).to_numpy().astype(np.int64)
            row = table[np.searchsorted(keys, (lengths << 48) + rank, "right") - 1]
            placed = [pa.array(row[:, 2] + rank - row[:, 1]), pa.array(row[:, 3])]
            yield pa.RecordBatch.from_arrays(
                [*passed, *placed], [*names, "sequence_id", "offset"]
            )

    order = [name for name in ("doc_id", "piece", "ids_crc32") if name in rows.columns]
    ranked = numbered(rows, "length", order, counts, "rank").select(*rows.columns, "rank")
    schema = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(df: DataFrame, tokenizer_json: str, limit: int = 2048, **options) -> DataFrame:
    """The pieces of all documents with their places, by ``token_pieces`` and ``pack``.

    An empty table gives no pieces. Rows that repeat an id or have none are packed like
    any others.
    """
    rows = stored(token_pieces(df, tokenizer_json, limit, **options), "pieces")
    return pack(rows, limit)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from packed pieces with their ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most a sequence's length
    joined = F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
