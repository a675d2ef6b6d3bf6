"""Full-refresh writers.

A table is written to a folder of its own and takes the old one's place when it is complete,
so that a failed write leaves the old table, and a plan may read the table it replaces. With
``in_place`` the old files are deleted first instead: for stores where a folder cannot be
renamed at once, such as most object stores. There a failed write leaves a table incomplete,
a plan must not read what it replaces, and only a table format with a log does better.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from kudosflow.observed import observed
from kudosflow.sinks.swap import replacing

# Fixed value: what Spark calls the directory of rows without a partition value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@contextmanager
def _target(spark: SparkSession, path: str, in_place: bool) -> Iterator[str]:
    if in_place:
        yield path
    else:
        with replacing(spark, path) as folder:
            yield folder


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", in_place: bool = False) -> None:
    """Replace the table at ``path``; every task writes its own rows, no shuffle."""
    with _target(df.sparkSession, path, in_place) as folder:
        df.write.format(fmt).mode("overwrite").save(folder)


def overwrite_partitioned(
    df: DataFrame,
    path: str,
    by: str,
    fmt: str = "parquet",
    rebalance: bool = True,
    in_place: bool = False,
) -> None:
    """Replace the table at ``path``, one directory per value of ``by``.

    The rebalance gathers each value into few files, yet splits a value that
    holds much of the data over as many tasks as its bytes need; hashing on
    ``by`` alone would give such a value to a single task. It is left out where
    adaptive execution, which does the splitting, is off, or where the caller
    would rather have one file per task and value than a shuffle. Whether there are
    rows is counted while they are written, so the table is not listed afterwards.
    """
    spark = df.sparkSession
    empty = df.drop(by).schema
    rows = Observation()
    df = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    if rebalance and spark.conf.get("spark.sql.adaptive.enabled") == "true":
        df = df.hint("rebalance", F.col(by))
    with _target(spark, path, in_place) as folder:
        (
            df.write.format(fmt)
            .partitionBy(by)
            .mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .save(folder)
        )
        if not observed(rows).get("rows"):
            # No rows, no files: one empty file keeps the columns for whoever reads next.
            none = spark.createDataFrame([], empty)
            none.write.format(fmt).save(f"{folder.rstrip('/')}/{by}={_NO_VALUE}")


def overwrite_merging_schema(
    df: DataFrame,
    path: str,
    by: str,
    fmt: str = "parquet",
    rebalance: bool = True,
    in_place: bool = False,
) -> None:
    """Replace the rows at ``path`` while its column set only grows.

    Columns that the table has and ``df`` lacks stay, as NULL, also after a refresh
    without rows. Only the schema of the old table is read.
    """
    old = _stored_schema(df.sparkSession, path, fmt)
    if old is not None:
        df = with_columns_of(df, old, untyped=(by,))
    overwrite_partitioned(df, path, by, fmt, rebalance, in_place)


def with_columns_of(df: DataFrame, old: StructType, untyped: tuple[str, ...] = ()) -> DataFrame:
    """``df`` plus the columns and nested fields only ``old`` has, as NULL.

    Fields are looked for inside structs, arrays and the values of maps. A column or
    field present in both must agree in type, except for columns in ``untyped``,
    whose stored type is a guess from directory names.
    """
    stored = {field.name.lower(): field for field in old}
    loose = {name.lower() for name in untyped}
    columns = []
    for field in df.schema:
        own = F.col(f"`{field.name}`")
        before = stored.pop(field.name.lower(), None)
        if before is not None and field.name.lower() not in loose:
            own = _grown(own, field.dataType, before.dataType, field.name)
        columns.append(own.alias(field.name))
    missing = [F.lit(None).cast(field.dataType).alias(field.name) for field in stored.values()]
    return df.select(*columns, *missing)


def _grown(value: Column, new: DataType, old: DataType, name: str) -> Column:
    """``value`` with the nested fields that only its ``old`` type has."""
    if isinstance(new, StructType) and isinstance(old, StructType):
        stored = {field.name.lower(): field for field in old}
        parts = []
        for field in new:
            part = value.getField(field.name)
            before = stored.pop(field.name.lower(), None)
            if before is not None:
                part = _grown(part, field.dataType, before.dataType, f"{name}.{field.name}")
            parts.append(part.alias(field.name))
        parts += [F.lit(None).cast(f.dataType).alias(f.name) for f in stored.values()]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(new, ArrayType) and isinstance(old, ArrayType):
        inner = new.elementType, old.elementType, f"{name}.element"
        return F.transform(value, lambda item: _grown(item, *inner))
    if isinstance(new, MapType) and isinstance(old, MapType):
        _grown(F.lit(None), new.keyType, old.keyType, f"{name}.key")
        inner = new.valueType, old.valueType, f"{name}.value"
        return F.transform_values(value, lambda _, item: _grown(item, *inner))
    if new.simpleString() != old.simpleString():
        raise ValueError(
            f"column {name}: stored as {old.simpleString()}, now {new.simpleString()}"
        )
    return value


def replace_external_table(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Create table ``name`` over ``path``, or replace its rows and schema."""
    df.write.format(fmt).mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def overwrite_bucketed(
    df: DataFrame,
    name: str,
    path: str,
    by: str,
    key: str,
    buckets: int,
    fmt: str = "parquet",
) -> DataFrame:
    """Replace external table ``name``, a directory per value of ``by``, its files by a hash of
    ``key``, while its column set only grows.

    A join on ``key`` then reads the table without a shuffle, through the catalog that knows
    the layout. Rows are gathered by value and bucket, and adaptive execution deals a bucket
    with much of the data to several tasks, which write a file each. Files are replaced in
    place, as by ``replace_external_table``.
    """
    spark = df.sparkSession
    old = _stored_schema(spark, path, fmt)
    if old is not None:
        df = with_columns_of(df, old, untyped=(by,))
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        bucket = F.pmod(F.hash(key), F.lit(buckets))
        dealt = df.withColumn("write__bucket", bucket)
        df = dealt.hint("rebalance", F.col(by), F.col("write__bucket")).drop("write__bucket")
    writer = df.write.format(fmt).mode("overwrite").option("path", path)
    writer.partitionBy(by).bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)


def _stored_schema(spark: SparkSession, path: str, fmt: str) -> StructType | None:
    """Schema of the table at ``path``, None where there is none yet."""
    try:
        return spark.read.format(fmt).load(path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
