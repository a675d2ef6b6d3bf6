"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from kudosflow.session import scratch_path

#: The characters between words, as a class for regular expressions.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"

#: Rows that one task numbers, and the most bins there may be for all keys.
BIN_ROWS = 20_000
MOST_BINS = 200_000

#: Python workers get their rows in pieces of so many, whatever Arrow hands over.
PIECE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: no executor's loss undoes them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sum(values: Column, block: int = 256) -> Column:
    """Sums up to and with each number of an array; appends stay within blocks."""

    def appended(part: Column, start: Column) -> Column:
        first = F.struct(start.alias("sum"), F.array().cast("array<bigint>").alias("out"))

        def step(state: Column, value: Column) -> Column:
            total = state["sum"] + value
            return F.struct(total.alias("sum"), F.concat(state["out"], F.array(total)).alias("out"))

        return F.aggregate(part, first, step, lambda state: state["out"])

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def blocks(numbers: Column) -> Column:
        last = F.floor((F.size(numbers) - 1) / block).cast("int")
        cut = F.transform(
            F.sequence(F.lit(0), last), lambda b: F.slice(numbers, b * block + 1, block)
        )
        return let(
            cut,
            lambda parts: let(
                appended(F.transform(parts, total), F.lit(0).cast("bigint")),
                lambda ends: F.flatten(
                    F.transform(
                        parts,
                        lambda part, i: appended(
                            part, F.coalesce(F.get(ends, i - 1), F.lit(0).cast("bigint"))
                        ),
                    )
                ),
            ),
        )

    empty = F.array().cast("array<bigint>")
    return let(
        values.cast("array<bigint>"), lambda v: F.when(F.size(v) > 0, blocks(v)).otherwise(empty)
    )


def numbered(
    rows: DataFrame, key: str, order: list[str], counts: dict[int, int], name: str
) -> DataFrame:
    """Number the rows of each key from 0 without gaps, in bins of about BIN_ROWS rows.

    ``counts`` has the rows of each key, which are few numbers. A task sorts one bin; what
    is sent to all tasks is the first number of each bin, at most MOST_BINS and one per
    key. Rows that ``order`` does not tell apart may change places.
    """
    each = max(BIN_ROWS, -(-sum(counts.values()) // MOST_BINS))
    several = {value: -(-n // each) for value, n in counts.items() if n > each}
    bins = F.lit(1)
    if several:
        known = F.create_map(*[F.lit(x).cast("bigint") for pair in several.items() for x in pair])
        bins = F.coalesce(F.try_element_at(known, F.col(key).cast("bigint")), F.lit(1))
    part, first = fresh(rows, "bin"), fresh(rows, "first")
    binned = rows.withColumn(part, F.pmod(F.xxhash64(*order), bins))
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        binned.groupBy(key, part)
        .agg(F.count(F.lit(1)).alias("rows_of_bin"))
        .select(key, part, F.coalesce(F.sum("rows_of_bin").over(before), F.lit(0)).alias(first))
    )
    inside = Window.partitionBy(key, part).orderBy(*order)
    return (
        binned.withColumn(name, F.row_number().over(inside) - 1)
        .join(F.broadcast(firsts), [key, part])
        .withColumn(name, F.col(name) + F.col(first))
        .drop(part, first)
    )


#: Bits of a priority that one pass of ``cutoffs`` tells apart.
_DIGIT = 12


def cutoffs(
    rows: DataFrame, group: Column, priority: Column, weight: Column, quotas: list, bits: int
) -> list[int]:
    """For each ``(group, quota)``, the largest cutoff whose rows weigh no more.

    Rows of the group with a priority, from 0 below ``2**bits``, under the cutoff weigh at
    most the quota together. Each pass sums weights by 12 more bits of the priorities, so
    that 4,096 sums per quota come to the driver, whatever the number of rows. The rows
    should be stored.
    """
    narrow = rows.select(group.alias("g"), priority.alias("p"), weight.alias("w"))
    states = [[g, 0, quota] for g, quota in quotas]  # group, prefix found, weight left
    done = 0
    open_states = list(range(len(states)))
    while done < bits and open_states:
        step = min(_DIGIT, bits - done)
        rest = bits - done - step
        wanted = F.lit(False)
        for i in open_states:
            same = F.shiftright("p", bits - done) == states[i][1] if done else F.lit(True)
            wanted |= (F.col("g") == states[i][0]) & same
        place = F.shiftright("p", rest).alias("place")
        sums = narrow.where(wanted).groupBy("g", place).agg(F.sum("w").alias("w"))
        weights = {(row["g"], row["place"]): row["w"] for row in sums.collect()}
        for i in list(open_states):
            g, prefix, left = states[i]
            digits = sorted(p for (own, p) in weights if own == g and p >> step == prefix)
            found = None
            for place_no in digits:
                if weights[g, place_no] > left:
                    found = place_no
                    break
                left -= weights[g, place_no]
            if found is None:  # all of them fit
                states[i] = [g, (prefix + 1) << (bits - done), left]
                open_states.remove(i)
            else:
                states[i] = [g, found, left]
        done += step
    return [states[i][1] for i in range(len(states))]


def pieces(batches: Iterator[pd.DataFrame], rows: int = PIECE_ROWS) -> Iterator[pd.DataFrame]:
    """Batches cut so that what a worker derives from one of them stays small."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.iloc[start : start + rows]


def quoted(name: str) -> str:
    """A column's name as an expression, whatever signs it has."""
    return "`" + name.replace("`", "``") + "`"


def all_columns(df: DataFrame) -> list[Column]:
    return [F.col(quoted(name)) for name in df.columns]


def with_answers(
    df: DataFrame, column: str, answer: Callable[[], Callable], rows: int = PIECE_ROWS, **kinds: str
) -> DataFrame:
    """Add what ``answer()(values)``, a list for each of ``kinds``, says of a column's values.

    All other columns pass through as Arrow arrays and keep their values as they are.
    """
    place = df.columns.index(column)
    named = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # names with dots are no matter
    schema = widened(named, **{f"a{i}": kind for i, kind in enumerate(kinds.values())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = answer()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                new = answers(part.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *map(pa.array, new)], schema.names
                )

    return named.mapInArrow(run, schema).toDF(*df.columns, *kinds)


def lists(
    batches: Iterator[pa.RecordBatch], rows: int = PIECE_ROWS
) -> Iterator[dict[str, list]]:
    """Batches as lists by column, cut as by ``pieces``. Whole numbers beside nulls stay
    whole, which they do not in pandas."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows).to_pydict()


def record_batch(**columns: tuple[str | pa.DataType, list]) -> pa.RecordBatch:
    """A batch of columns given by type and values."""
    arrays = [pa.array(values, kind) for kind, values in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def widened(df: DataFrame, **kinds: str) -> StructType:
    """The table's schema with further columns."""
    added = [StructField(name, DataType.fromDDL(kind)) for name, kind in kinds.items()]
    return StructType([*df.schema.fields, *added])


def fresh(df: DataFrame, name: str) -> str:
    """A column name close to ``name`` that the table does not have."""
    taken, own, n = {column.lower() for column in df.columns}, name, 1
    while own.lower() in taken:
        n += 1
        own = f"{name}_{n}"
    return own
