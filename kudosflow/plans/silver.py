"""Bronze to silver: the four curated tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kudosflow import schemas
from kudosflow.functions import ratio, token_count


def checkin_counts(
    checkins: DataFrame, pattern: str = ",", null_count: int | None = None
) -> DataFrame:
    """All check-in columns plus the number of dates listed in ``date``."""
    return checkins.withColumn("checkin_count", token_count(F.col("date"), pattern, null_count))


def engaged_users(
    users: DataFrame,
    min_reviews: int = 25,
    stars_range: tuple[float, float] = (2.49, 4.01),
    max_ratio: float = 2,
) -> DataFrame:
    """Users with more than ``min_reviews`` reviews, a middling average and
    fewer than ``max_ratio`` reviews per useful vote.

    The range includes both ends; no useful votes, or an unknown number, means
    not engaged.
    """
    return users.select(*schemas.ENGAGED_USERS.names).where(
        (F.col("review_count") > min_reviews)
        & F.col("average_stars").between(*stars_range)
        & (ratio(F.col("review_count"), F.col("useful")) < max_ratio)
    )


def top_rated_businesses(
    businesses: DataFrame, min_stars: float = 3.5, min_reviews: int = 50
) -> DataFrame:
    """Businesses with at least the given rating and number of reviews."""
    return businesses.select(*schemas.TOP_RATED_BUSINESSES.names).where(
        (F.col("stars") >= min_stars) & (F.col("review_count") >= min_reviews)
    )


def cleaned_reviews(
    reviews: DataFrame,
    unwanted: tuple[str, ...] = ("funny",),
    renamed: Mapping[str, str] | None = None,
) -> DataFrame:
    """Reviews without the unwanted columns, ``text`` called ``review_text``.

    Columns that are not there are passed over; all others are kept.
    """
    names = {"text": "review_text"} if renamed is None else dict(renamed)
    return reviews.drop(*unwanted).withColumnsRenamed(names)
