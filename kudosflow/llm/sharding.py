"""Sharding by balanced label propagation.

Documents start in shards by a hash. In every round each linked document looks at the
shards of those it is linked with, and asks for the one that holds most of them; the
requests with the largest gain are granted as far as the wanted shard's capacity goes.
At the end, shards above the mean give the documents with the fewest links to those
below it.

Links are given as groups: the documents of a group are linked with each other, and are
never listed in pairs. All rows that move between tasks are narrow; texts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kudosflow.llm.common import cutoffs, numbered, stored

#: While documents move towards their neighbours, a shard may hold so many hundredths of
#: the mean; the last step evens the sizes out.
CAPACITY = 125
ROUNDS = 6
EVENINGS = 6
#: Shards may differ from the mean by so many of 100,000 parts, or one small document.
TOLERANCE = 20
_HASH_BITS = 24


def _sizes(state: DataFrame, shards: int) -> list[int]:
    found = {row[0]: row[1] for row in state.groupBy("shard").agg(F.sum("size")).collect()}
    return [found.get(shard, 0) for shard in range(shards)]


def _by_shard(values: list[int], shard: Column) -> Column:
    return F.element_at(F.array(*[F.lit(value).cast("bigint") for value in values]), shard + 1)


def _log2(value: Column) -> Column:
    return F.length(F.bin(value)) - 1


def _hash(row: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(row, F.lit(17)), 64 - _HASH_BITS)


def _round(state: DataFrame, members: DataFrame, shards: int) -> tuple[DataFrame, int]:
    """One round of requests; the new state and the number of granted ones."""
    held = members.join(state.select("row", "shard"), "row")
    counts = [
        F.count(F.when(F.col("shard") == shard, 1)).alias(f"v{shard}") for shard in range(shards)
    ]
    # Stored, as Spark splits a large group only in a join of tables that it has shuffled.
    votes = stored(held.groupBy("group_a", "group_b").agg(*counts), "votes")
    # A document counts itself, so that of two in different shards both want the same one.
    near = (
        held.join(votes, ["group_a", "group_b"])
        .groupBy("row", "shard")
        .agg(*[F.sum(f"v{shard}").alias(f"v{shard}") for shard in range(shards)])
    )
    best = F.greatest(
        *[F.struct(F.col(f"v{s}").alias("n"), F.lit(-s).alias("s")) for s in range(shards)]
    )
    own = F.element_at(F.array(*[F.col(f"v{s}") for s in range(shards)]), F.col("shard") + 1)
    asked = near.select(
        "row", "shard", (-best["s"]).alias("wanted"), (best["n"] - own + 1).alias("gain")
    )
    gain = F.lit(62) - _log2(F.col("gain"))
    requests = stored(
        asked.where("wanted <> shard")
        .drop("shard")
        .withColumn("place", F.shiftleft(gain.cast("bigint"), _HASH_BITS) + _hash(F.col("row")))
        .join(state.select("row", "size"), "row"),
        "requests",
    )
    sizes = _sizes(state, shards)
    most = sum(sizes) * CAPACITY // (100 * shards)
    quotas = [(shard, max(0, most - size)) for shard, size in enumerate(sizes)]
    cuts = cutoffs(
        requests, F.col("wanted"), F.col("place"), F.col("size"), quotas, _HASH_BITS + 6
    )
    granted = requests.where(F.col("place") < _by_shard(cuts, F.col("wanted")))
    moved = state.join(granted.select("row", "wanted"), "row", "left")
    after = moved.withColumn("shard", F.coalesce("wanted", "shard")).drop("wanted")
    return stored(after, "state"), granted.count()


def _evened(state: DataFrame, shards: int) -> DataFrame:
    """Move rows from shards above the mean to those below, those with few links first.

    Of these the large ones go first, so that a further call can move what is smaller
    than the difference that is left.
    """
    sizes = _sizes(state, shards)
    total = sum(sizes)
    targets = [total * (shard + 1) // shards - total * shard // shards for shard in range(shards)]
    over = [max(0, size - target) for size, target in zip(sizes, targets)]
    if max(over, default=0) * 100_000 * shards <= TOLERANCE * total:
        return state
    few = F.least(_log2(F.col("links")), F.lit(63)).cast("bigint")
    large = 63 - F.least(_log2(F.col("size")), F.lit(63)).cast("bigint")
    place = F.shiftleft(few * 64 + large, _HASH_BITS) + _hash(F.col("row"))
    # What is larger than all that a shard has to give stays.
    fits = F.col("size") <= _by_shard(over, F.col("shard"))
    givers = [(shard, room) for shard, room in enumerate(over) if room]
    bits = _HASH_BITS + 12
    cuts = dict(
        zip(
            (shard for shard, _ in givers),
            cutoffs(state.where(fits), F.col("shard"), place, F.col("size"), givers, bits),
        )
    )
    ends = _by_shard([cuts.get(shard, 0) for shard in range(shards)], F.col("shard"))
    given = fits & (place < ends)
    marked = stored(state.withColumn("given", given), "state")
    # What is given fills the gaps one after the other, in the order of the hash.
    gaps = [(shard, max(0, targets[shard] - sizes[shard])) for shard in range(shards)]
    filled, quotas = 0, []
    for shard, gap in gaps:
        filled += gap
        quotas.append((shard, filled))
    ends = cutoffs(
        marked.where("given"),
        F.lit(0),
        _hash(F.col("row")),
        F.col("size"),
        [(0, quota) for _, quota in quotas],
        _HASH_BITS,
    )
    takers = [shard for shard, gap in gaps if gap]
    into = F.lit(takers[-1])
    for shard, end in reversed(list(zip(range(shards), ends))):
        if shard in takers[:-1]:
            into = F.when(_hash(F.col("row")) < end, shard).otherwise(into)
    moved = marked.withColumn("shard", F.when(F.col("given"), into).otherwise(F.col("shard")))
    return stored(moved.drop("given"), "state")


def assign_shards(rows: DataFrame, members: DataFrame, shards: int) -> DataFrame:
    """Shards 0 and up of ``rows`` (``row``, ``size``) that ``members`` (``row``,
    ``group_a``, ``group_b``) link.

    ``row`` tells rows apart, ``size`` is at least 1. A group too large for a shard fills
    it up to its capacity and goes on in others. No rows give no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    if shards == 1:
        return rows.select("row", F.lit(0).alias("shard"))
    sized = members.groupBy("group_a", "group_b").agg(F.count(F.lit(1)).alias("n"))
    several = stored(sized.where("n > 1"), "groups")
    linked = stored(members.join(several, ["group_a", "group_b"]), "members")
    links = linked.groupBy("row").agg(F.sum("n").alias("links"))
    start = F.pmod(F.xxhash64("row", F.lit(5)), F.lit(shards)).cast("int").alias("shard")
    state = stored(
        rows.join(links, "row", "left").select(
            "row", "size", start, F.coalesce("links", F.lit(1)).alias("links")
        ),
        "state",
    )
    for _ in range(ROUNDS):
        state, moved = _round(state, linked.drop("n"), shards)
        if not moved:
            break
    for _ in range(EVENINGS):
        before, state = state, _evened(state, shards)
        if state is before:
            break
    return state.select("row", "shard")


def shard_documents(
    df: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Put documents into shards of nearly equal bytes, equal texts together.

    Returns ``doc_id``, ``size`` (bytes of the text and 1), ``text_crc32``, ``shard`` and
    ``slot``, the document's number in its shard, without gaps. A missing text is empty.
    Rows that repeat an id, or have none, are placed like any others.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = stored(
        df.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(content) + 1).cast("bigint").alias("size"),
            F.crc32(content).alias("text_crc32"),
            F.xxhash64(content).alias("group_a"),
            F.xxhash64(F.lit(1), content).alias("group_b"),
        ),
        "rows",
    )
    placed = assign_shards(
        rows.select("row", "size"), rows.select("row", "group_a", "group_b"), shards
    )
    joined = stored(rows.drop("group_a", "group_b").join(placed, "row"), "placed")
    counts = {row[0]: row[1] for row in joined.groupBy("shard").count().collect()}
    out = numbered(joined, "shard", ["doc_id", "row"], counts, "slot")
    return out.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("bigint"))
