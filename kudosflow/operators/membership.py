"""A filter by the keys of another side, of a size that does not grow with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kudosflow.operators.limits import DEFAULT, Limits, layout_value

# Bits of one row of a bitmap, as Spark's bitmap functions have them.
_PART_BITS = 15
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _place(df: DataFrame, keys: list[str], bits: int, name: str) -> DataFrame | None:
    """``df`` with a hash of its keys as ``name``; none for types whose equal values may
    hash differently. A key that is NULL has none."""
    values, known = [], F.lit(True)
    for key in keys:
        kind = df.schema[key].dataType
        column = F.col(f"`{key}`")
        if layout_value(column, kind) is None:
            return None
        values.append(column.cast("bigint") if kind.simpleString() in _WHOLE else column)
        known &= column.isNotNull()
    hashed = F.xxhash64(*values).bitwiseAND(F.lit((1 << bits) - 1))
    return df.withColumn(name, F.when(known, hashed))


def possible_matches(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    null_safe: bool = False,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """The rows of ``left`` whose keys may be among those of ``right``, by a bitmap.

    All rows with partners stay, and some without. Rows with a NULL among the keys go, or
    stay if the join is to be ``null_safe``. One pass over the keys of ``right`` sets a bit
    for the hash of each. The bitmap comes in parts of 4 KB, only those with a bit, and is
    sent to the rows of ``left`` where they are read: at most ``2 ** limits.filter_bits`` bits,
    however many keys there are. ``left`` comes back as it is where broadcasts are ruled out,
    or types differ or have no hash.
    """
    kinds = [[df.schema[key].dataType.simpleString() for key in keys] for df in (left, right)]
    alike = all(a == b or a in _WHOLE and b in _WHOLE for a, b in zip(*kinds))
    if limits.broadcast_bytes < 0 or not limits.filter_bits or not alike:
        return left
    own, other, part, bitmap = (f"member__{x}" for x in ("own", "other", "part", "bits"))
    rows = _place(left, keys, limits.filter_bits, own)
    marks = _place(right.select(*keys), keys, limits.filter_bits, other)
    if rows is None or marks is None:
        return left
    inside = F.lit((1 << _PART_BITS) - 1)
    marks = (
        marks.where(F.col(other).isNotNull())
        .groupBy(F.shiftright(other, _PART_BITS).alias(part))
        .agg(F.bitmap_construct_agg(F.col(other).bitwiseAND(inside)).alias(bitmap))
    )
    same_part = F.shiftright(own, _PART_BITS) == F.col(part)
    wanted = _bit(F.col(bitmap), F.col(own).bitwiseAND(inside)) == 1
    if null_safe:
        found = rows.join(F.broadcast(marks), same_part, "left").where(F.col(own).isNull() | wanted)
    else:
        found = rows.join(F.broadcast(marks), same_part).where(wanted)
    return found.drop(own, part, bitmap)


def _bit(bitmap: Column, place: Column) -> Column:
    byte = F.substring(bitmap, F.shiftright(place, 3).cast("int") + 1, F.lit(1))
    number = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.getbit(number, place.bitwiseAND(F.lit(7)).cast("int"))
