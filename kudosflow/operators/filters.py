"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from kudosflow.functions import is_complete


def drop_incomplete(df: DataFrame, subset: str | Iterable[str] | None = None) -> DataFrame:
    """Rows with no NULL or NaN in any column, or in any column of ``subset``.

    Names are resolved as Spark does it, and one that is unknown is an error.
    """
    fields = df.schema
    if subset is not None:
        names = [subset] if isinstance(subset, str) else list(subset)
        fields = df.select(*(f"`{name}`" for name in names)).schema
    return df.where(is_complete(list(fields)))
