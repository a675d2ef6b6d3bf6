"""Readers for bronze JSON lines and for the columnar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from kudosflow.sources.lossless import all_fields, declared_fields


def read_json_lines(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    declared: StructType | None = None,
    others: bool = True,
) -> DataFrame:
    """One row per object in lines of JSON.

    With ``declared`` fields these come first, found by name without regard to case, with
    the types declared, whether the input has them or not. All other fields follow, unless
    ``others`` is false. The input is read once. If some line does not fit, the text of each
    such line is kept in ``_corrupt_record`` (see ``lossless.all_fields``).

    A ``schema`` is taken as it is: the input is read once, only fields spelled as in it are
    read, and a malformed line becomes a row of NULLs. With neither, Spark infers all, which
    reads the input twice.
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    if schema is not None:
        return reader.schema(schema).json(path)
    if declared is None:
        return reader.json(path)
    if others:
        return all_fields(spark, path, declared)
    return declared_fields(spark, path, declared)


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """A table by path, with the declared column types and order.

    Directory names carry no types, so only a declared ``schema`` keeps a string
    partition value such as ``01`` a string; the ``select`` puts the partition
    column back in its place.
    """
    reader = spark.read.format(fmt)
    if schema is None:
        return reader.load(path)
    return reader.schema(schema).load(path).select(*[f"`{name}`" for name in schema.names])
