"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A signature has ``chunks * width`` symbols of 16 bits. Two signatures that differ in
fewer than ``chunks * (errors + 1)`` symbols differ, by the pigeonhole principle, in at
most ``errors`` symbols of some chunk. Enumerating the positions that may be wrong gives
``chunks * C(width, errors)`` keys per signature, and every such pair shares a key.

Links are confirmed on the full shingle sets. Groups are never expanded into all pairs:

1. Equal sets are one class.
2. Within a bucket (equal key) each class is compared with the smallest id only, of the
   bucket or, if the bucket is large, of the part of it that one task has read. What is
   confirmed is merged into components.
3. Buckets that still hold several components compare the classes of different
   components, block by block; in a large block only those that agree in enough places
   of another chunk, without which no pair is worth confirming. Each pair is due in the first bucket it shares. What
   comes out of a block is the classes with a pair to confirm, then, with their full
   sets at hand, one link for each component that is found to belong to another.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kudosflow.llm.common import WORD, lists, pieces, record_batch, stored
from kudosflow.llm.components import components

#: Shingles whose signature is computed at once.
_STEP = 1 << 14
#: Rows of keys among which a task looks for frequent ones.
_STRETCH = 1 << 20
#: Keys per signature that can be told apart.
_NUMBERS = 128
#: Groups with fewer rows are compared pair by pair without a further look.
_LARGE = 128


class Scheme(NamedTuple):
    """Words per shingle, least similarity in hundredths, and the shape of signatures.

    ``most_errors`` bounds the differing symbols of pairs worth confirming; ``block`` and
    ``often`` decide how large buckets are laid out, never what is found. With the
    defaults, signatures that differ in up to 19 of 50 symbols are sure to meet; at a
    similarity of 0.8 a pair differs in 10 symbols on average, and fails to meet with
    a probability of 2e-6 (all ten chunks with two errors or more).
    """

    words: int = 5
    percent: int = 80
    chunks: int = 10
    width: int = 5
    errors: int = 1
    most_errors: int = 25
    block: int = 1024
    often: int = 64


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _multipliers(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + 1


def shingles(text: str | None, words: int) -> np.ndarray:
    """Distinct 64-bit shingle hashes, sorted; A-Z count as a-z, only ASCII spaces divide.

    A text with fewer words is one shingle of all of them; one without words has none.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    if len(parts) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), len(parts))], np.uint64)
    one = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    ends, total = len(parts) - words + 1, np.zeros(len(parts) - words + 1, np.uint64)
    for i, factor in enumerate(_multipliers(7, words)):
        total += one[i : i + ends] * factor
    return np.unique(_mixed(total))


def signature(hashes: np.ndarray, symbols: int) -> np.ndarray:
    """16-bit symbols, each from the least of the hashes under another function."""
    factors, offsets = _multipliers(11, symbols), _multipliers(13, symbols)
    least = np.full(symbols, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), _STEP):
        part = hashes[start : start + _STEP, None] * factors + offsets
        least = np.minimum(least, part.min(axis=0))
    return (_mixed(least) & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16)


def sketches(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """Id, set size, 128-bit digest of the set and signature; nulls for empty sets."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in lists(batches):
            sizes, digests, shapes = [], [], []
            for text in piece["text"]:
                found = shingles(text, scheme.words)
                sizes.append(len(found))
                if len(found):
                    halves = divmod(xxhash.xxh3_128_intdigest(found.tobytes()), 1 << 64)
                    digests.append(np.array(halves, np.uint64).view(np.int64).tolist())
                    shapes.append(signature(found, scheme.chunks * scheme.width))
                else:
                    digests.append((None, None))
                    shapes.append(None)
            yield record_batch(
                doc_id=("int64", piece["doc_id"]),
                n_shingles=("int64", sizes),
                digest_a=("int64", [digest[0] for digest in digests]),
                digest_b=("int64", [digest[1] for digest in digests]),
                symbols=(pa.list_(pa.int16()), shapes),
            )

    schema = (
        "doc_id bigint, n_shingles bigint, digest_a bigint, digest_b bigint,"
        " symbols array<smallint>"
    )
    return docs.mapInArrow(sketch, schema)


def keys(symbols: Column, scheme: Scheme) -> Column:
    """The keys of a signature: each chunk without each choice of wrong positions.

    The low bits of a key are its number.
    """
    out = []
    for chunk in range(scheme.chunks):
        for wrong in combinations(range(scheme.width), scheme.errors):
            kept = [chunk * scheme.width + i for i in range(scheme.width) if i not in wrong]
            hashed = F.xxhash64(F.lit(len(out)), *[symbols[i] for i in kept])
            out.append(hashed.bitwiseAND(-_NUMBERS).bitwiseOR(len(out)))
    if len(out) > _NUMBERS:
        raise ValueError(f"more than {_NUMBERS} keys per signature")
    return F.array(*out)


def _comparable(size_a: Column, size_b: Column, scheme: Scheme) -> Column:
    """No pair with sizes further apart can be similar enough."""
    return F.least(size_a, size_b) * 100 >= F.greatest(size_a, size_b) * scheme.percent


def full_sets(docs: DataFrame, ids: DataFrame, scheme: Scheme) -> DataFrame:
    """The sorted shingle hashes of the documents with these ids."""

    def full(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in pieces(batches, 128):
            found = [np.sort(shingles(text, scheme.words).view(np.int64)) for text in batch["text"]]
            yield pd.DataFrame({"id": batch["doc_id"], "hashes": found})

    # The same plan at every size: texts are moved once, by their id.
    wanted = ids.select(F.col("id").alias("doc_id")).distinct().hint("merge")
    chosen = docs.join(wanted, "doc_id", "left_semi")
    return stored(chosen.mapInPandas(full, "id bigint, hashes array<bigint>"), "sets")


def _gathered(keyed: DataFrame, scheme: Scheme) -> DataFrame:
    """Keys and ids, with the rows of keys that a task meets often sent elsewhere.

    Of each key with ``scheme.often`` rows or more in a stretch of a task's rows only the
    smallest id goes where the key belongs, marked by itself as ``hub``. The others have
    it as their hub already and go anywhere, so that no key fills a task.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            found, ids = table["key"].to_numpy(), table["id"].to_numpy()
            order = np.lexsort((ids, found))
            found, ids = found[order], ids[order]
            starts = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
            sizes = np.diff(np.append(starts, len(found)))
            often = np.repeat(sizes >= scheme.often, sizes)
            hubs = np.repeat(ids[starts], sizes)
            away = often & (hubs != ids)
            place = np.where(away, _mixed(ids.view(np.uint64)).view(np.int64), found)
            columns = [place, found, ids, pa.array(hubs, mask=~often)]
            return pa.RecordBatch.from_arrays([*map(pa.array, columns)], names)

        names, held, rows = ["place", "key", "id", "hub"], [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= _STRETCH:
                yield out(held)
                held, rows = [], 0
        if rows:
            yield out(held)

    return keyed.mapInArrow(gather, "place bigint, key bigint, id bigint, hub bigint")


def met(classes: DataFrame, scheme: Scheme) -> DataFrame:
    """``key``, ``id`` and ``hub`` of the ids in buckets of several classes.

    The hub is the bucket's smallest id, or that of a part of the bucket whose smallest
    id is a row of its own. Rows stream through their task in order; only the last one
    and the bucket's first id are held.
    """
    keyed = classes.select(F.explode(keys(F.col("symbols"), scheme)).alias("key"), "id")
    dealt = _gathered(keyed, scheme).repartition("place").sortWithinPartitions("place", "id")

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_id, hub, said = None, None, None, True

        def out(found, ids, hubs):
            return pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(ids), pa.array(hubs)], ["key", "id", "hub"]
            )

        for batch in batches:
            found, ids = (batch.column(i).to_numpy() for i in (1, 2))
            known = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            given = batch.column(3).fill_null(0).to_numpy()
            away = known & (given != ids)
            if away.any():
                yield out(found[away], ids[away], given[away])
                found, ids, known = found[~away], ids[~away], known[~away]
            if not len(found):
                continue
            starts = np.append(True, found[1:] != found[:-1])
            starts[0] = last_key is None or found[0] != last_key
            if not starts[0] and not said:  # the last row was not alone after all
                yield out([last_key], [last_id], [hub])
            first = np.maximum.accumulate(np.where(starts, np.arange(len(ids)), -1))
            hubs = np.where(first >= 0, ids[np.maximum(first, 0)], ids[0] if hub is None else hub)
            grouped = ~starts | known
            grouped[:-1] |= ~starts[1:]
            last_key, last_id, hub, said = found[-1], ids[-1], hubs[-1], grouped[-1]
            if grouped.any():
                yield out(found[grouped], ids[grouped], hubs[grouped])

    return stored(dealt.mapInArrow(several, "key bigint, id bigint, hub bigint"), "met")


def _starred(together: DataFrame, classes: DataFrame, scheme: Scheme) -> DataFrame:
    """Near pairs ``a``, ``b`` of hubs with the other ids of their buckets."""
    pairs = together.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b"))
    wrong = F.size(
        F.filter(
            F.zip_with(F.col("one.symbols"), F.col("two.symbols"), lambda x, y: x != y),
            lambda differs: differs,
        )
    )
    return (
        pairs.distinct()
        .join(classes.alias("two"), F.col("b") == F.col("two.id"))
        .join(classes.alias("one"), F.col("a") == F.col("one.id"))
        .where(_comparable(F.col("one.n_shingles"), F.col("two.n_shingles"), scheme))
        .where(wrong <= scheme.most_errors)
        .select("a", "b")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    common = F.size(F.array_intersect("of_a", "of_b"))
    return (
        pairs.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("of_b")), "b")
        .join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("of_a")), "a")
        .where(common * 100 >= (F.size("of_a") + F.size("of_b") - common) * scheme.percent)
        .select("a", "b")
        .distinct()
    )


def _blocks(together: DataFrame, labels: DataFrame, scheme: Scheme) -> DataFrame:
    """Rows of the buckets that hold several components, dealt to pairs of blocks."""
    labelled = together.join(labels, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("label")
    )
    mixed = (
        labelled.groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
        .where("low < high")
        .select("key", F.ceil(F.col("n") / scheme.block).cast("int").alias("parts"))
    )
    part = F.pmod(F.xxhash64("id", F.lit(3)), F.col("parts")).cast("int")
    return (
        labelled.join(mixed, "key")
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "key",
            F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high"),
            "part",
            "id",
            "label",
        )
    )


_PLACE = ["key", "low", "high"]


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, and where each group starts; groups are bounded."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        starts = _group_starts(rest)
        if len(starts) > 1:
            yield rest.slice(0, starts[-1]), starts[:-1]
            rest = rest.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest, _group_starts(rest)


def _group_starts(table: pa.Table) -> np.ndarray:
    changed = np.ones(table.num_rows, bool)
    if table.num_rows:
        changed[1:] = False
        for name in _PLACE:
            values = table[name].to_numpy()
            changed[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changed)


def _candidates(
    starts: np.ndarray, symbols: np.ndarray, number: np.ndarray, scheme: Scheme
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a group to compare, some 100,000 pairs at a time; small groups together.

    Of large groups only the pairs that ``_agreeing`` cannot rule out, if those are fewer.
    """
    sizes = np.append(starts[1:], len(symbols)) - starts
    for size in np.unique(sizes):
        if size < 2:
            continue
        own = starts[sizes == size]
        if size < _LARGE:
            first, second = np.triu_indices(size, 1)
            step = max(1, (1 << 17) // len(first))
            for i in range(0, len(own), step):
                base = own[i : i + step, None]
                yield (base + first).ravel(), (base + second).ravel()
            continue
        for base in own:
            chunk = int(number[base]) // comb(scheme.width, scheme.errors)
            pairs = _agreeing(symbols[base : base + size], chunk, scheme)
            first, second = np.triu_indices(size, 1) if pairs is None else pairs
            for i in range(0, len(first), 1 << 17):
                yield base + first[i : i + (1 << 17)], base + second[i : i + (1 << 17)]


def _agreeing(
    symbols: np.ndarray, chunk: int, scheme: Scheme
) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs of rows that may differ in ``most_errors`` symbols at most; None for any pair.

    All rows share a key of ``chunk``. A pair worth confirming agrees in so many symbols
    outside of it that, by the pigeonhole principle, some other chunk has ``least`` of them.
    So rows that are equal in some ``least`` places of a chunk are the only ones to compare.
    """
    size, others = len(symbols), scheme.chunks - 1
    agree = others * scheme.width - scheme.most_errors
    least = min(4, -(-agree // others)) if others and agree > 0 else 0
    if least < 2:
        return None
    codes, orders, total = [], [], 0
    for other in range(scheme.chunks):
        if other == chunk:
            continue
        for places in combinations(range(scheme.width), least):
            code = np.zeros(size, np.int64)
            for place in places:
                code = code << 16 | symbols[:, other * scheme.width + place].view(np.uint16)
            order = np.argsort(code, kind="stable")
            code = code[order]
            cuts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1], [True]]))
            held = np.diff(cuts)
            total += int((held * (held - 1) // 2).sum())
            if total * 2 >= size * (size - 1):
                return None
            codes.append(code)
            orders.append(order)
    found = [np.zeros(0, np.int64)]
    for code, order in zip(codes, orders):
        at, step = np.arange(size), 1
        while len(at := at[at + step < size]) and len(at := at[code[at] == code[at + step]]):
            one, two = order[at], order[at + step]
            found.append(np.minimum(one, two) * size + np.maximum(one, two))
            step += 1
    return np.divmod(np.unique(np.concatenate(found)), size)


def _first_shared(equal: np.ndarray, scheme: Scheme) -> np.ndarray:
    """The number of the first key that two signatures share, from their equal symbols."""
    shared, number = np.full(len(equal), -1), 0
    for chunk in range(scheme.chunks):
        part = equal[:, chunk * scheme.width : (chunk + 1) * scheme.width]
        for wrong in combinations(range(scheme.width), scheme.errors):
            kept = [i for i in range(scheme.width) if i not in wrong]
            shared[(shared < 0) & part[:, kept].all(axis=1)] = number
            number += 1
    return shared


def _due(
    table: pa.Table, starts: np.ndarray, scheme: Scheme
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of near pairs of different components that are due in their group."""
    column = {name: table[name].to_numpy() for name in (*_PLACE, "part", "label", "n_shingles")}
    symbols = table["symbols"].combine_chunks().flatten().to_numpy()
    symbols = symbols.reshape(table.num_rows, -1)
    number = column["key"] & (_NUMBERS - 1)
    for x, y in _candidates(starts, symbols, number, scheme):
        across = column["low"][x] != column["high"][x]  # two blocks: only pairs across them
        due = (column["label"][x] != column["label"][y]) & (
            ~across | (column["part"][x] != column["part"][y])
        )
        sizes = column["n_shingles"][x], column["n_shingles"][y]
        due &= np.minimum(*sizes) * 100 >= np.maximum(*sizes) * scheme.percent
        x, y = x[due], y[due]
        equal = symbols[x] == symbols[y]
        near = equal.shape[1] - equal.sum(axis=1) <= scheme.most_errors
        x, y, equal = x[near], y[near], equal[near]
        here = _first_shared(equal, scheme) == number[x]
        yield x[here], y[here]


def _similar(x: int, y: int, sets: list[np.ndarray], scheme: Scheme) -> bool:
    common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
    return common * 100 >= (len(sets[x]) + len(sets[y]) - common) * scheme.percent


def _across(
    together: DataFrame, classes: DataFrame, labels: DataFrame, sets: DataFrame, scheme: Scheme
) -> DataFrame:
    """Links ``a``, ``b`` between components, enough to join all that belong together."""
    rows = _blocks(together, labels, scheme).join(classes, "id")
    names = [*_PLACE, "part", "id", "label", "n_shingles", "symbols"]
    dealt = rows.select(names).repartition(*_PLACE).sortWithinPartitions(*_PLACE, "id")

    def involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_groups(batches):
            marked = np.zeros(table.num_rows, bool)
            for x, y in _due(table, starts, scheme):
                marked[x] = marked[y] = True
            yield from table.filter(pa.array(marked)).combine_chunks().to_batches()

    near = stored(dealt.mapInArrow(involved, dealt.schema), "near")
    again = near.join(sets, "id").repartition(*_PLACE).sortWithinPartitions(*_PLACE, "id")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_groups(batches):
            ids, label = table["id"].to_numpy(), table["label"].to_numpy().copy()
            flat = table["hashes"].combine_chunks()
            values, cuts = flat.values.to_numpy(), flat.offsets.to_numpy()
            found = [values[i:j] for i, j in zip(cuts, cuts[1:])]
            ends = np.append(starts[1:], table.num_rows)
            group = np.repeat(np.arange(len(starts)), ends - starts)
            a, b = [], []
            for x, y in _due(table, starts, scheme):
                for i, j in zip(x, y):
                    if label[i] != label[j] and _similar(i, j, found, scheme):
                        a.append(ids[i])
                        b.append(ids[j])
                        own = slice(starts[group[i]], ends[group[i]])
                        label[own][label[own] == label[j]] = label[i]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, "int64"), pa.array(b, "int64")], ["a", "b"]
            )

    return again.mapInArrow(links, "a bigint, b bigint")


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", scheme: Scheme = Scheme()
) -> DataFrame:
    """One row per row of the table: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    ``component_id`` is the smallest id reachable over links, and ``kept`` marks the
    document of that id. Texts without words are linked with nothing. Rows of one id
    are one document, and stay or go together. Rows without an id cannot be named:
    they are linked with nothing, have no component and are kept.
    """
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    all_rows = stored(sketches(docs, scheme), "sketches")
    linkable = all_rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(
        linkable.groupBy("digest_a", "digest_b").agg(
            F.min("doc_id").alias("id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("symbols").alias("symbols"),
        ),
        "classes",
    )
    shapes = classes.select("id", "n_shingles", "symbols")
    together = met(shapes, scheme)
    sets = full_sets(docs, together, scheme)
    near = stored(_starred(together, shapes, scheme), "pairs")
    links = stored(_confirmed(near, sets, scheme), "links")
    more = stored(_across(together, shapes, components(links), sets, scheme), "links")
    links = links.unionByName(more)
    owners = stored(
        linkable.join(classes.select("digest_a", "digest_b", "id"), ["digest_a", "digest_b"])
        .select("doc_id", "n_shingles", "id"),
        "owners",
    )
    # A document whose rows have different texts links the classes it stands in.
    several = owners.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    same = owners.join(several.where("a < b"), "doc_id").where("id <> a")
    found = components(links.unionByName(same.select("a", F.col("id").alias("b"))))
    placed = owners.join(found, "id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "id").alias("component_id")
    )
    others = all_rows.where("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return placed.unionByName(others).withColumn("kept", kept)


#: The registered query in DuckDB, by all pairs of documents that share a shingle.
ORACLE_SQL = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{WORD}') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS shingle
  FROM texts, unnest(range(1, greatest(len(w) - 2, 2))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM sets AS x JOIN sets AS y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
  WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reached.doc_id, b FROM reached JOIN links ON a = other)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles,
  min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""
