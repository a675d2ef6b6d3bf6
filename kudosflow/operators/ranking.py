"""Row numbers and the first row of each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kudosflow.operators.limits import DEFAULT, Limits, layout_value, none_of, one_of
from kudosflow.session import scratch_path

# Rows of one group of equal rows that a single task writes out.
COPIES_PER_TASK = 100_000

# Hash buckets that a first count tells apart, and the most of them it may find full.
BUCKETS = 1 << 18
FULL_BUCKETS = 1 << 12


def first_per_group(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each ``key``.

    Catalyst turns the filter on the row number into a group limit that runs
    before the shuffle as well, so a task passes on one row per key however many
    it holds. ``order`` should be total, or a task that is run again may choose
    another of the tied rows.
    """
    helper = "row__first"
    numbered = df.withColumn(helper, F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return numbered.where(F.col(helper) == 1).drop(helper)


def number_rows(
    df: DataFrame,
    key: str,
    order: list[Column],
    name: str = "row",
    counted: DataFrame | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Number all rows of each ``key`` from 1 in the given order, as bigint.

    A window puts each key into one task. Keys with more than ``limits.hot_rows``
    rows are numbered apart, each over many tasks; if there are more than
    ``limits.hot_keys`` of them, all keys are. To count the rows of each key,
    ``counted`` may stand in for ``df``: a plan that is cheaper to run and holds
    each key as often or more. It is counted by a hash of the key first, and by the
    key itself only where a hash has as many rows as a large key.
    """
    value = layout_value(F.col(key), df.schema[key].dataType)
    alike = F.col(key) if value is None else value
    rows = _possibly_large(
        (df if counted is None else counted).select(alike.alias("row__value")), limits
    )
    if rows is None:
        window = Window.partitionBy(key).orderBy(*order)
        return df.withColumn(name, F.row_number().over(window).cast("bigint"))
    sizes = rows.groupBy("row__value").count()
    large = sizes.where(F.col("count") > limits.hot_rows)
    hot = large.limit(limits.hot_keys + 1).collect()
    window = Window.partitionBy(key).orderBy(*order)
    number = F.row_number().over(window).cast("bigint")
    if not hot:
        return df.withColumn(name, number)
    if len(hot) > limits.hot_keys or value is None:
        rows = (df if counted is None else counted).count()
        return _number_spread(df, rows, key, order, name, limits)
    values = [row["row__value"] for row in hot]
    rows = sum(row["count"] for row in hot)
    others = df.where(none_of(value, values)).withColumn(name, number)
    spread = _number_spread(df.where(one_of(value, values)), rows, key, order, name, limits)
    return others.unionByName(spread)


def _possibly_large(values: DataFrame, limits: Limits) -> DataFrame | None:
    """The rows of ``row__value`` that may belong to a key with over ``limits.hot_rows`` rows.

    One pass counts by a hash: each task sends ``BUCKETS`` rows at most, however many keys
    there are, and the driver gets the full buckets only. None if there is none; all rows if
    over ``FULL_BUCKETS`` are full, or equal keys may have unlike hashes.
    """
    if layout_value(F.col("row__value"), values.schema["row__value"].dataType) is None:
        return values
    bucket = F.pmod(F.xxhash64("row__value"), F.lit(BUCKETS)).cast("int")
    full = (
        values.groupBy(bucket.alias("bucket"))
        .count()
        .where(F.col("count") > limits.hot_rows)
        .select("bucket")
        .limit(FULL_BUCKETS + 1)
        .collect()
    )
    if len(full) > FULL_BUCKETS:
        return values
    if not full:
        return None
    return values.where(bucket.isin([row["bucket"] for row in full]))


def _comparable(df: DataFrame) -> list[Column]:
    """Columns that can be grouped and hashed: maps, wherever they are, as JSON."""
    return [
        F.to_json(F.struct(F.col(f"`{field.name}`")), {"ignoreNullFields": "false"})
        if '"map"' in field.json()
        else F.col(f"`{field.name}`")
        for field in df.schema
    ]


def _number_spread(
    df: DataFrame, rows: int, key: str, order: list[Column], name: str, limits: Limits
) -> DataFrame:
    """Number the rows of large keys, ``rows`` in all, over sorted slices.

    Equal rows are counted first and stand for themselves as one row. Slices by
    key and order are then even, and the number of a row is its number within
    the slice plus the size of the key's slices before. The slices are written
    out because their bounds come from a sample that a second evaluation might
    draw differently.
    """
    spark = df.sparkSession
    slices = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // limits.hot_rows)
    )
    # The hash makes the order total over rows that differ anywhere.
    same = {f"row__same{i}": column for i, column in enumerate(_comparable(df))}
    hashed = F.xxhash64(*same)
    firsts = [F.first(f"`{column}`").alias(column) for column in df.columns]
    placed = (
        df.withColumns(same)
        .groupBy(*same)
        .agg(*firsts, F.count(F.lit(1)).alias("row__copies"))
        .withColumn("row__hash", hashed)
        .drop(*same)
    )
    full = [*order, F.col("row__hash")]
    placed = placed.repartitionByRange(slices, F.col(key), *full).withColumn(
        "row__slice", F.spark_partition_id()
    )
    path = scratch_path(spark, "slices")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)

    # At most one row per slice and one more per hot key.
    before = Window.partitionBy("row__key").orderBy("row__of")
    starts = (
        placed.groupBy(F.col(key).alias("row__key"), F.col("row__slice").alias("row__of"))
        .agg(F.sum("row__copies").alias("row__size"))
        .withColumn(
            "row__start",
            F.sum("row__size").over(before.rowsBetween(Window.unboundedPreceding, 0))
            - F.col("row__size"),
        )
        .drop("row__size")
    )
    within = Window.partitionBy(key, "row__slice").orderBy(*full)
    ranges = (
        placed.withColumn(
            "row__last",
            F.sum("row__copies").over(within.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .join(
            F.broadcast(starts),
            F.col(key).eqNullSafe(F.col("row__key"))
            & (F.col("row__slice") == F.col("row__of")),
        )
        .withColumn("row__last", F.col("row__last") + F.col("row__start"))
        .withColumn("row__from", F.col("row__last") - F.col("row__copies") + 1)
    )
    if (placed.agg(F.max("row__copies")).first()[0] or 0) > COPIES_PER_TASK:
        blocks = F.sequence("row__from", "row__last", F.lit(COPIES_PER_TASK).cast("long"))
        ranges = (
            ranges.withColumn("row__from", F.explode(blocks))
            .repartition(slices, key, "row__from")
            .withColumn(
                "row__last",
                F.least("row__last", F.col("row__from") + F.lit(COPIES_PER_TASK - 1)),
            )
        )
    numbers = F.explode(F.sequence("row__from", "row__last")).alias(name)
    return ranges.select(*[f"`{column}`" for column in df.columns], numbers)
