"""Silver to gold: the two answers about top-rated businesses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kudosflow import schemas
from kudosflow.operators import (
    Limits,
    drop_incomplete,
    first_per_group,
    large_join,
    null_safe_join,
    possible_matches,
    register_views,
    split_join,
    sql_view,
    which_fit,
)
from kudosflow.operators.limits import DEFAULT
from kudosflow.session import scratch_path

# Rank of a review within its business. The user's useful votes decide; the rest
# makes the order total, so that a recomputed task picks the same review.
TIE_BREAK = ["review_id", "username", "review_date", "review_text", "user_average_stars"]

# What is known of a review without its text, and the part of its rank before the text.
_REVIEW = ["business_id", "user_id", "review_id", "review_date"]
_NARROW = ["review_id", "username", "review_date"]


def best_users(users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is told of a review's user, and the best ranked user of each ``user_id``.

    That user decides any choice among reviews, and NULL users do not multiply NULL reviews.
    """
    people = users.select(
        "user_id",
        F.col("name").alias("username"),
        F.col("average_stars").alias("user_average_stars"),
        "useful",
    )
    order = [F.col("useful").desc(), F.col("username"), F.col("user_average_stars")]
    return people, first_per_group(people, "user_id", order)


def best_reviews(
    businesses: DataFrame,
    users: DataFrame,
    reviews: DataFrame,
    rating: float = 5,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """For each business the review with ``rating`` whose user has most useful votes.

    A NULL user matches NULL users. A business whose row or chosen review has a NULL or NaN
    anywhere is left out; no other review takes the place of the chosen one.

    The choice is made on narrow rows, and the text is fetched for the chosen reviews. Where
    broadcasts are ruled out, that would shuffle all texts, so they come along instead.
    """
    businesses = drop_incomplete(businesses.select(*schemas.TOP_RATED_BUSINESSES.names))
    rated = reviews.where(F.col("stars") == rating).withColumnRenamed("date", "review_date")
    people, best = best_users(users)
    few, small = which_fit([businesses, people], limits)
    if few:
        ids = F.broadcast(businesses.select("business_id"))
        wanted = rated.join(ids, "business_id", "left_semi")
    else:
        wanted = possible_matches(rated, businesses, ["business_id"], limits=limits)
    if not small:
        wanted = possible_matches(wanted, people, ["user_id"], True, limits)

    def with_users(rows: DataFrame) -> DataFrame:
        if small:
            return null_safe_join(rows, F.broadcast(best), "user_id").drop("user_id")
        return split_join(rows, best, "user_id", null_safe=True, counted=rated, limits=limits).drop(
            "user_id"
        )

    if limits.broadcast_bytes < 0:
        candidates = with_users(wanted.select(*_REVIEW, "review_text"))
        chosen = first_per_group(candidates, "business_id", [F.col("useful").desc(), *TIE_BREAK])
    else:
        narrow = with_users(wanted.select(*_REVIEW)).select("business_id", "useful", *_NARROW)
        narrow = first_per_group(narrow, "business_id", [F.col("useful").desc(), *_NARROW])
        # What is incomplete now is left out in the end, so all keys are equal from here on.
        narrow = drop_incomplete(narrow)
        texts = rated.select(*_REVIEW, "review_text")
        found = _chosen(texts, narrow, few, limits)
        candidates = with_users(found).where(
            (F.col("useful") == F.col("chosen_useful"))
            & (F.col("username") == F.col("chosen_username"))
        )
        # Mostly one review of a business is left; more differ in what ranks last only.
        last = F.min(F.struct("review_text", "user_average_stars")).alias("last")
        chosen = candidates.groupBy("business_id", "useful", *_NARROW).agg(last)
        chosen = chosen.select("business_id", "useful", *_NARROW, "last.*")
    chosen = drop_incomplete(chosen)
    if few:
        joined = chosen.join(F.broadcast(businesses), "business_id")
    else:
        joined = split_join(businesses, chosen, "business_id", limits=limits)
    return joined.select(*schemas.BEST_REVIEWS.names)


def _chosen(texts: DataFrame, narrow: DataFrame, few: bool, limits: Limits) -> DataFrame:
    """The reviews with their texts that the narrow choice names, user and votes beside."""
    keys = ["business_id", "review_id", "review_date"]
    narrow = narrow.withColumnsRenamed(
        {"useful": "chosen_useful", "username": "chosen_username"}
    )
    if few:  # no more rows than ids of businesses were sent
        return texts.join(F.broadcast(narrow), keys)
    path = scratch_path(narrow.sparkSession, "chosen")
    narrow.write.parquet(path)
    narrow = narrow.sparkSession.read.schema(narrow.schema).parquet(path)
    return possible_matches(texts, narrow, keys, limits=limits).join(narrow, keys)


def reviewed_by_engaged(
    businesses: DataFrame,
    users: DataFrame,
    reviews: DataFrame,
    rating: float = 5,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Businesses with a review of ``rating`` by one of the users; NULL ids never match."""
    businesses = businesses.select(*schemas.REVIEWED_BY_ENGAGED.names)
    ids = businesses.select("business_id")
    picks = reviews.where(F.col("stars") == rating).select("business_id", "user_id")
    engaged = users.select("user_id")
    few, small = which_fit([ids, engaged], limits)
    if few:
        picks = picks.join(F.broadcast(ids), "business_id", "left_semi")
    else:
        picks = possible_matches(picks, ids, ["business_id"], limits=limits)
    by_engaged = large_join(
        picks, engaged, "user_id", "left_semi", selective=True, limits=limits, fits=small
    )
    if few:
        # No more ids than were sent out are left.
        found = F.broadcast(by_engaged.select("business_id").distinct())
        return businesses.join(found, "business_id", "left_semi")
    return split_join(businesses, by_engaged, "business_id", "left_semi", limits=limits)


# The same question as SQL. The first statement needs the three silver tables as
# session views, and the second the first one's ids as a view.

REVIEWED_IDS = "ids_reviewed_by_engaged"

REVIEWED_IDS_SQL = """
SELECT opinion.business_id
FROM user_review opinion
LEFT SEMI JOIN engaged_users person ON person.user_id = opinion.user_id
WHERE opinion.stars = {rating}
"""

REVIEWED_BY_ENGAGED_SQL = f"""
SELECT place.business_id, place.name, place.city, place.state, place.stars
FROM top_rated_business place
WHERE EXISTS (SELECT 1 FROM {REVIEWED_IDS} found WHERE found.business_id = place.business_id)
"""


def reviewed_ids_view(
    spark: SparkSession,
    businesses: DataFrame,
    users: DataFrame,
    reviews: DataFrame,
    rating: float = 5,
) -> DataFrame:
    """Register the silver views and, over them, the ids with a review that counts."""
    register_views(top_rated_business=businesses, engaged_users=users, user_review=reviews)
    return sql_view(spark, REVIEWED_IDS, REVIEWED_IDS_SQL.format(rating=rating))


def reviewed_by_engaged_sql(spark: SparkSession) -> DataFrame:
    """The answer from the views that ``reviewed_ids_view`` registers."""
    return spark.sql(REVIEWED_BY_ENGAGED_SQL)
