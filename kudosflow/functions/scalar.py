"""Column expressions whose NULL and zero cases do not depend on ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField


def token_count(text: Column, pattern: str = ",", null_count: int | None = None) -> Column:
    """Number of tokens between matches of ``pattern``, empty ones included.

    A NULL text gives ``null_count``: NULL by default, -1 for what Spark's
    ``size`` answers with ANSI mode off.
    """
    absent = F.lit(null_count).cast("int")
    return F.when(text.isNull(), absent).otherwise(F.size(F.split(text, pattern)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Floating-point quotient, NULL where the denominator is zero or NULL."""
    return F.try_divide(numerator, denominator)


def is_complete(fields: list[StructField]) -> Column:
    """True where no given field is NULL or NaN.

    One test per column rather than ``na.drop``: Catalyst can then push each
    test below a join or into the scan and turn a left join into an inner one.
    """
    tests = ["true"]
    for field in fields:
        tests.append(f"`{field.name}` IS NOT NULL")
        if isinstance(field.dataType, (FloatType, DoubleType)):
            tests.append(f"NOT isnan(`{field.name}`)")
    return F.expr(" AND ".join(tests))
