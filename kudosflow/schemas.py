"""Declared schemas of the bronze, silver and gold tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields])


def extended(schema: StructType, extra: Iterable[StructField]) -> StructType:
    """``schema`` followed by further fields that a source is known to carry."""
    return StructType([*schema.fields, *extra])


# Column names, types and order of each table.

CHECKIN = _struct(("business_id", StringType()), ("date", StringType()))

USER = _struct(
    ("user_id", StringType()),
    ("name", StringType()),
    ("yelping_since", StringType()),
    ("review_count", LongType()),
    ("average_stars", DoubleType()),
    ("useful", LongType()),
)

BUSINESS = _struct(
    ("name", StringType()),
    ("stars", DoubleType()),
    ("review_count", LongType()),
    ("state", StringType()),
    ("city", StringType()),
    ("categories", StringType()),
    ("business_id", StringType()),
)

REVIEW = _struct(
    ("review_id", StringType()),
    ("business_id", StringType()),
    ("user_id", StringType()),
    ("stars", DoubleType()),
    ("text", StringType()),
    ("date", StringType()),
    ("funny", LongType()),
)

CHECKIN_COUNTS = extended(CHECKIN, [StructField("checkin_count", IntegerType())])
ENGAGED_USERS = USER
TOP_RATED_BUSINESSES = BUSINESS
CLEANED_REVIEWS = _struct(
    ("review_id", StringType()),
    ("business_id", StringType()),
    ("user_id", StringType()),
    ("stars", DoubleType()),
    ("review_text", StringType()),
    ("date", StringType()),
)

BEST_REVIEWS = _struct(
    ("business_id", StringType()),
    ("name", StringType()),
    ("stars", DoubleType()),
    ("review_count", LongType()),
    ("state", StringType()),
    ("city", StringType()),
    ("categories", StringType()),
    ("username", StringType()),
    ("user_average_stars", DoubleType()),
    ("useful", LongType()),
    ("review_text", StringType()),
    ("review_id", StringType()),
    ("review_date", StringType()),
)

REVIEWED_BY_ENGAGED = _struct(
    ("business_id", StringType()),
    ("name", StringType()),
    ("city", StringType()),
    ("state", StringType()),
    ("stars", DoubleType()),
)
