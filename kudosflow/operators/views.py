"""Session views, plain and cached."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def register_views(**frames: DataFrame) -> None:
    """Register each DataFrame under its keyword, replacing a view of that name."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def sql_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """Register the result of ``query``, still lazy, as view ``name``."""
    spark.sql(query).createOrReplaceTempView(name)
    return spark.table(name)


@contextmanager
def cached_view(spark: SparkSession, name: str) -> Iterator[DataFrame]:
    """View ``name`` held in memory and on disk while the block runs.

    The cache holds every column of the view, so it pays only where the view is
    read more than once; blocks lost with an executor are computed again.
    """
    spark.catalog.cacheTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.catalog.uncacheTable(name)
