"""One registered query per operator, source, sink and composite answer.

Each takes a session and a folder of tables and reads its tables whole. Queries
about writing write to the shared folder and return what is read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kudosflow.functions import ratio, token_count
from kudosflow.operators import (
    cached_view,
    drop_incomplete,
    first_per_group,
    large_join,
    number_rows,
    semi_join_in,
    split_join,
)
from kudosflow.plans import gold
from kudosflow.plans.silver import checkin_counts
from kudosflow.registry import views
from kudosflow.session import scratch_path
from kudosflow.sinks import (
    overwrite,
    overwrite_merging_schema,
    overwrite_partitioned,
    replace_external_table,
)
from kudosflow.sources import read_json_lines, read_table

Query = Callable[[SparkSession, str], DataFrame]


def _rank_order() -> list[Column]:
    return [F.col("useful").desc(), *(F.col(name) for name in gold.TIE_BREAK)]


# Sources


def _events_as_json(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    # Times are text in the records, like every date of the review data.
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    events = views.table(spark, sf_dir, "events").withColumn("ts", text)
    path = scratch_path(spark, "events.json")
    events.write.mode("overwrite").json(path)
    return events, path


def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, path = _events_as_json(spark, sf_dir)
    return read_json_lines(spark, path, events.schema)


def ingest_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, path = _events_as_json(spark, sf_dir)
    return read_json_lines(spark, path)


def ingest_json_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fields are declared, and the records have four more."""
    events, path = _events_as_json(spark, sf_dir)
    declared = StructType([events.schema["event_id"], events.schema["user_id"]])
    return read_json_lines(spark, path, declared=declared)


def ingest_json_misfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared field that is spelled in several ways, and holds text in some lines."""
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    number = F.col("event_id") % 10
    spelled = F.when(number < 3, "User_ID").when(number < 5, "USER_ID").otherwise("user_id")
    value = F.when(number == 7, F.concat(F.lit('"u'), "user_id", F.lit('"')))
    value = F.when(number == 8, F.concat("user_id", F.lit(".5"))).otherwise(value)
    lines = F.concat(
        F.lit('{"Event_Id":'), "event_id", F.lit(',"'), spelled, F.lit('":'),
        F.coalesce(value, F.col("user_id").cast("string")),
        F.lit(',"event_type":"'), "event_type", F.lit('"}'),
    )
    path = scratch_path(spark, "events")
    events.select(lines.alias("value")).write.text(path)
    declared = StructType([events.schema["event_id"], events.schema["user_id"]])
    return read_json_lines(spark, path, declared=declared)


# Sinks and catalog


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = views.cleaned_reviews(spark, sf_dir)
    path = scratch_path(spark, "user_review")
    overwrite_partitioned(cleaned, path, "stars")
    return read_table(spark, path, cleaned.schema)


def partition_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitioned_roundtrip(spark, sf_dir).where(F.col("stars") == 5)


def schema_merge_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = views.cleaned_reviews(spark, sf_dir)
    path = scratch_path(spark, "user_review")
    overwrite_partitioned(cleaned.withColumn("extra", F.lit("old")), path, "stars")
    overwrite_merging_schema(cleaned, path, "stars")
    return read_table(spark, path)


def external_table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "top_rated")
    name = f"top_rated_{uuid.uuid4().hex}"  # so that no other run replaces it
    replace_external_table(views.businesses(spark, sf_dir), name, path)
    return replace_external_table(views.top_rated(spark, sf_dir), name, path)


# Projections and scalar functions


def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.businesses(spark, sf_dir).select("name", "stars", "state", "business_id")


def drop_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = views.reviews(spark, sf_dir).drop("funny", "not_there")
    return cleaned.withColumnRenamed("text", "review_text")


def checkin_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = views.checkins(spark, sf_dir).withColumn("checkin_count", token_count(F.col("date")))
    return counted.select("doc_id", "checkin_count")


# Filters


def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.users(spark, sf_dir).where(F.col("average_stars").between(2.49, 4.01))


def ratio_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    few = ratio(F.col("review_count"), F.col("useful")) < 2
    return views.users(spark, sf_dir).where(few)


def drop_any_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_incomplete(views.businesses(spark, sf_dir))


def drop_null_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column with NULLs, one with NaNs, named in other cases; a third may be NULL."""
    stars = F.when(F.col("review_count") % 7 == 0, float("nan")).otherwise(F.col("stars"))
    city = F.nullif("city", F.lit("PROMO"))
    shops = views.businesses(spark, sf_dir).withColumns({"stars": stars, "city": city})
    return drop_incomplete(shops, ["Stars", "CATEGORIES"])


# Joins


def _by_user(
    spark: SparkSession, sf_dir: str, null_safe: bool, best_user: bool = False
) -> DataFrame:
    """Reviews by engaged users; ``best_user`` leaves one user for each id, NULL included."""
    engaged = views.engaged_users(spark, sf_dir).select(
        "user_id",
        F.col("name").alias("username"),
        F.col("average_stars").alias("user_average_stars"),
        "useful",
    )
    if best_user:
        order = [F.col("useful").desc(), F.col("username"), F.col("user_average_stars")]
        engaged = first_per_group(engaged, "user_id", order)
    cleaned = views.cleaned_reviews(spark, sf_dir).withColumnRenamed("date", "review_date")
    orders = views.table(spark, sf_dir, "orders")
    users = orders.select(views.user_id(F.col("o_custkey")))
    return large_join(cleaned, engaged, "user_id", null_safe=null_safe, counted=users)


def null_safe_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_user(spark, sf_dir, null_safe=True)


def using_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_user(spark, sf_dir, null_safe=False)


def join_filter_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_safe_join(spark, sf_dir).where(F.col("stars") == 5)


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-star reviews with the best user of their id: enough where one row is chosen."""
    return _by_user(spark, sf_dir, null_safe=True, best_user=True).where(F.col("stars") == 5)


def left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = top1_per_group(spark, sf_dir).select("business_id", "review_id", "username")
    return split_join(views.top_rated(spark, sf_dir), best, "business_id", "left")


def left_join_drop_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_incomplete(left_join(spark, sf_dir))


def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semi_join_in(views.businesses(spark, sf_dir), _rated(spark, sf_dir), "business_id")


# Aggregation and windows


def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.reviews(spark, sf_dir).select("business_id").distinct()


def row_number_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The join adds no review, so the table read by itself shows any hot business.
    lines = views.table(spark, sf_dir, "lineitem").where(F.col("l_linenumber") >= 5)
    return number_rows(
        join_filter_literal(spark, sf_dir).withColumn("useful", F.nullif("useful", F.lit(20))),
        "business_id",
        _rank_order(),
        counted=lines.select(F.col("l_partkey").alias("business_id")),
    )


def top1_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_group(_rated(spark, sf_dir), "business_id", _rank_order())


# Silver tables


def silver_checkin_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = checkin_counts(views.checkins(spark, sf_dir))
    path = scratch_path(spark, "checkin_count_business")
    overwrite(counted, path)
    return read_table(spark, path, counted.schema)


def silver_engaged_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    engaged = views.engaged_users(spark, sf_dir)
    path = scratch_path(spark, "engaged_users")
    overwrite_partitioned(engaged, path, "average_stars")
    return read_table(spark, path, engaged.schema)


def silver_top_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    top_rated = views.top_rated(spark, sf_dir)
    path = scratch_path(spark, "top_rated_business")
    overwrite_partitioned(top_rated, path, "state")
    return read_table(spark, path, top_rated.schema)


def silver_user_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = views.cleaned_reviews(spark, sf_dir)
    path = scratch_path(spark, "user_review")
    overwrite_merging_schema(cleaned, path, "stars")
    return read_table(spark, path, cleaned.schema)


# Gold answers


def _silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        views.top_rated(spark, sf_dir),
        views.engaged_users(spark, sf_dir),
        views.cleaned_reviews(spark, sf_dir),
    )


def gold_best_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.best_reviews(*_silver(spark, sf_dir))


def gold_reviewed_by_engaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.reviewed_by_engaged(*_silver(spark, sf_dir))


def gold_reviewed_by_engaged_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold.reviewed_ids_view(spark, *_silver(spark, sf_dir))
    return gold.reviewed_by_engaged_sql(spark)


def cached_view_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold.reviewed_ids_view(spark, *_silver(spark, sf_dir))
    path = scratch_path(spark, "reviewed")
    with cached_view(spark, gold.REVIEWED_IDS):
        overwrite(gold.reviewed_by_engaged_sql(spark), path)
    return read_table(spark, path)


def queries() -> dict[str, Query]:
    named = {"semi_join_in": semi_join}
    plain = [
        ingest_json,
        ingest_json_inferred,
        ingest_json_passthrough,
        ingest_json_misfit,
        partitioned_roundtrip,
        partition_pruned_scan,
        schema_merge_overwrite,
        external_table_replace,
        project_columns,
        drop_rename,
        checkin_count,
        range_filter,
        ratio_filter,
        drop_any_null,
        drop_null_subset,
        null_safe_join,
        using_join,
        join_filter_literal,
        left_join,
        left_join_drop_null,
        distinct_keys,
        row_number_rank,
        top1_per_group,
        silver_checkin_count,
        silver_engaged_users,
        silver_top_rated,
        silver_user_review,
        gold_best_review,
        gold_reviewed_by_engaged,
        gold_reviewed_by_engaged_sql,
        cached_view_semi,
    ]
    return {query.__name__: query for query in plain} | named
