"""Joins that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kudosflow.operators.limits import (
    DEFAULT,
    Limits,
    fits_broadcast,
    frequent_values,
    layout_value,
    one_of,
)
from kudosflow.operators.membership import possible_matches

# Keys of these types may differ in width: their layout values are equal if they are.
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def null_safe_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` in which NULL matches NULL; one key column results."""
    other = f"{key}__right"
    renamed = right.withColumnRenamed(key, other)
    return left.join(renamed, F.col(key).eqNullSafe(F.col(other)), how).drop(other)


def _join(left: DataFrame, right: DataFrame, key: str, how: str, null_safe: bool) -> DataFrame:
    return null_safe_join(left, right, key, how) if null_safe else left.join(right, key, how)


def large_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    null_safe: bool = False,
    bound: DataFrame | None = None,
    counted: DataFrame | None = None,
    selective: bool = False,
    limits: Limits = DEFAULT,
    fits: bool | None = None,
) -> DataFrame:
    """Join a large ``left`` without shuffling it where ``right`` allows that.

    ``right`` is broadcast if its measured size permits, and otherwise joined as
    in ``split_join``. ``bound`` is a plan at least as large as ``right`` but
    cheaper to measure, and ``fits`` says what a measurement before has found. ``how`` is inner, left or left_semi. If the join is ``selective``,
    so that few rows of ``left`` have partners, a bitmap of the keys of ``bound`` takes most
    others out where they are read, before the shuffle.
    """
    keys = right if bound is None else bound
    if fits_broadcast(keys, limits) if fits is None else fits:
        return _join(left, F.broadcast(right), key, how, null_safe)
    if selective and how != "left":
        names = [F.col(f"`{name}`") for name in left.columns]
        whole, left = left, possible_matches(left, keys, [key], null_safe, limits)
        if how == "left_semi" and left is not whole:
            # Spark would move a semi join, with its shuffle, below the bitmap.
            right = right.select(key).distinct()
            return split_join(left, right, key, "inner", null_safe, counted, limits).select(*names)
    return split_join(left, right, key, how, null_safe, counted, limits)


def split_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    null_safe: bool = False,
    counted: DataFrame | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Join by key, with the rows of over-frequent left keys dealt to many tasks.

    Each such row gets the number of the task that reads it, modulo
    ``limits.salts``, as a second key, and its partners on the right are repeated for
    every number. So the left side runs once, and any number gives the same rows. To
    find the keys, ``counted`` may stand in for ``left``: a plan that is cheaper to
    run and holds each key about as often. If the partners are too large to be
    repeated, or the key is of a type that has no layout value, the join is left
    to adaptive execution. Filter ``left`` before: the number hides a later filter.
    """
    if how == "left_semi":
        right = right.select(key).distinct()
    kinds = [df.schema[key].dataType for df in (left, right)]
    hot = frequent_values(left if counted is None else counted, key, limits)
    if not null_safe and how != "left":
        hot = [value for value in hot if value is not None]
    simple = layout_value(F.col(key), kinds[1]) is not None
    alike = kinds[0] == kinds[1] or all(kind.simpleString() in _WHOLE for kind in kinds)
    if not hot or not simple or not alike:
        return _join(left, right, key, how, null_safe)
    partners = right.where(one_of(layout_value(F.col(key), kinds[1]), hot))
    repeated = Limits(limits.repeated_bytes // limits.salts)
    if not fits_broadcast(partners, repeated):
        return _join(left, right, key, how, null_safe)
    salt, other = f"{key}__salt", f"{key}__right"
    task = F.pmod(F.spark_partition_id(), F.lit(limits.salts))
    dealt = F.when(one_of(layout_value(F.col(key), kinds[0]), hot), task).otherwise(0)
    each = F.sequence(F.lit(0), F.lit(limits.salts - 1))
    is_hot = one_of(layout_value(F.col(key), kinds[1]), hot)
    salts = F.explode(F.when(is_hot, each).otherwise(F.array(F.lit(0)))).alias(salt)
    salted = right.select("*", salts)
    if not null_safe:
        return left.withColumn(salt, dealt).join(salted, [key, salt], how).drop(salt)
    renamed = salted.withColumnsRenamed({key: other, salt: f"{salt}__right"})
    on = F.col(key).eqNullSafe(F.col(other)) & (F.col(salt) == F.col(f"{salt}__right"))
    joined = left.withColumn(salt, dealt).join(renamed, on, how)
    return joined.drop(salt, f"{salt}__right", other)


def semi_join_in(
    left: DataFrame,
    right: DataFrame,
    key: str,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Rows of ``left`` whose ``key`` occurs in ``right``, as IN with a subquery.

    With few left keys the much larger right side is reduced to them where it is
    read, so that what comes back is no larger than they are and is broadcast in
    turn. With many, a bitmap of them takes most other rows of the right side out there.
    """
    keys = left.select(key)
    if fits_broadcast(keys, limits):
        present = right.select(key).join(F.broadcast(keys), key, "left_semi").distinct()
        return left.join(F.broadcast(present), key, "left_semi")
    right = possible_matches(right.select(key), keys, [key], limits=limits)
    return split_join(left, right, key, "left_semi", limits=limits)
