"""Measurements that decide how a join is laid out, never what it returns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructType,
)

from kudosflow.observed import observed


@dataclass(frozen=True)
class Limits:
    """When a side is small enough to broadcast and a key too frequent for one task.

    Rows of a frequent key are dealt to ``salts`` tasks if the partners, repeated that
    often, take no more than ``repeated_bytes``. A side too large to broadcast is sent as a
    bitmap of its keys with at most ``2 ** filter_bits`` bits, 32 MiB; 0 means none, as does
    a negative ``broadcast_bytes``.
    """

    broadcast_bytes: int = 64 << 20
    hot_share: float = 0.001
    hot_rows: int = 1_000_000
    salts: int = 64
    repeated_bytes: int = 1 << 30
    filter_bits: int = 28

    @property
    def hot_keys(self) -> int:
        """The most keys that can each hold ``hot_share`` of all rows."""
        return ceil(1 / self.hot_share)


DEFAULT = Limits()

# Types whose values an approximate count and a list can hold.
_SIMPLE = (BooleanType, ByteType, ShortType, IntegerType, LongType, DateType, DecimalType)

# Tasks that merge the sketches of all others.
SKETCH_GROUPS = 256


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's texts and nested values plus a fixed cost."""
    sizes = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (ArrayType, MapType, StructType)):
            column = F.to_json(F.struct(column))
        elif not isinstance(field.dataType, (StringType, BinaryType)):
            continue
        sizes.append(F.coalesce(F.octet_length(column), F.lit(0)).cast("long"))
    return reduce(Column.__add__, sizes, F.lit(16 + 8 * len(df.columns)).cast("long"))


def measured_sizes(sides: list[DataFrame]) -> list[int]:
    """Bytes of all values of each side plus a fixed cost per row.

    One job over all sides, without a shuffle: the sums are gathered while the rows pass.
    """
    rows = reduce(
        DataFrame.unionAll,
        [
            df.select(_row_bytes(df).alias("bytes"), F.lit(i).alias("side"))
            for i, df in enumerate(sides)
        ],
    )
    sums = [
        F.sum(F.when(F.col("side") == i, F.col("bytes"))).alias(f"s{i}")
        for i in range(len(sides))
    ]
    seen = Observation()
    rows.observe(seen, *sums).write.format("noop").mode("overwrite").save()
    found = observed(seen)
    return [found.get(f"s{i}") or 0 for i in range(len(sides))]


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all values of ``df`` plus a fixed cost per row; runs one job."""
    return measured_sizes([df])[0]


def which_fit(sides: list[DataFrame], limits: Limits = DEFAULT) -> list[bool]:
    """Which of the sides may be sent to every executor, each as a whole; one job."""
    if limits.broadcast_bytes < 0:
        return [False] * len(sides)
    return [size <= limits.broadcast_bytes for size in measured_sizes(sides)]


def fits_broadcast(df: DataFrame, limits: Limits = DEFAULT) -> bool:
    """Whether ``df`` as a whole may be sent to every executor."""
    return which_fit([df], limits)[0]


def frequent_values(df: DataFrame, key: str, limits: Limits = DEFAULT) -> list[Any]:
    """Layout values of ``key``, NULL among them, that hold too many rows for one task.

    One pass over one column. Every task sums up its rows in a sketch of fixed
    size; these are merged in groups first, as a large input has too many for
    one task. At most ``limits.hot_keys`` values reach the driver, and tracking
    ten times as many keeps the error well below the share asked for.
    """
    tracked = 10 * limits.hot_keys
    value = layout_value(F.col(f"`{key}`"), df.schema[key].dataType)
    if value is None:
        return []
    found = (
        df.select(value.alias("value"))
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("group"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.expr(f"approx_top_k_accumulate(value, {tracked})").alias("sketch"),
        )
        .groupBy(F.lit(0).alias("all"))  # so that no sketch is made of nothing
        .agg(
            F.sum("rows").alias("rows"),
            F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"),
        )
        .selectExpr("rows", f"approx_top_k_estimate(sketch, {limits.hot_keys}) AS top")
        .first()
    )
    if found is None:
        return []
    floor = max(limits.hot_rows, limits.hot_share * found["rows"])
    return [entry["item"] for entry in found["top"] if entry["count"] >= floor]


def layout_value(column: Column, kind: DataType) -> Column | None:
    """What stands for a key when its layout is decided; equal keys have equal values.

    Simple keys stand for themselves and others for a hash. There is none for
    floating-point numbers, of which unlike ones may be equal, and maps.
    """
    if isinstance(kind, _SIMPLE) or kind == StringType():
        return column
    text = kind.jsonValue() if isinstance(kind.jsonValue(), str) else kind.json()
    if any(name in text for name in ("float", "double", "map", "variant", "collate")):
        return None
    return F.when(column.isNotNull(), F.xxhash64(column))


def one_of(column: Column, values: list[Any]) -> Column:
    """True where ``column`` is one of ``values``, which may include NULL."""
    listed = column.isin([value for value in values if value is not None])
    return listed | column.isNull() if None in values else listed


def none_of(column: Column, values: list[Any]) -> Column:
    """The rows ``one_of`` leaves out."""
    unlisted = ~column.isin([value for value in values if value is not None])
    return unlisted & column.isNotNull() if None in values else unlisted | column.isNull()
