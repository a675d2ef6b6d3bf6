"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from kudosflow import schemas
from kudosflow.operators import Limits, drop_incomplete, first_per_group, large_join
from kudosflow.plans import gold
from kudosflow.sinks import overwrite_bucketed, overwrite_partitioned
from kudosflow.sources import read_table

SHUFFLED = Limits(broadcast_bytes=-1)


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    """Silver tables in which one user and one business hold a third of the rows each."""
    root = tmp_path_factory.mktemp("silver")
    number = F.col("id")
    reviews = spark.range(0, 60_000, 1, 8).select(
        number.cast("string").alias("review_id"),
        F.when(number % 3 == 0, F.lit("b0"))
        .otherwise(F.concat(F.lit("b"), number % 500))
        .alias("business_id"),
        F.when(number % 3 == 1, F.lit("u0"))
        .otherwise(F.concat(F.lit("u"), number % 700))
        .alias("user_id"),
        (number % 5 + 1).cast("double").alias("stars"),
        F.concat(F.lit("text "), number).alias("review_text"),
        F.lit("2020-01-01").alias("date"),
    )
    users = spark.range(700).select(
        F.concat(F.lit("u"), number).alias("user_id"),
        F.concat(F.lit("name "), number).alias("name"),
        F.lit("2010").alias("yelping_since"),
        F.lit(30).cast("long").alias("review_count"),
        (F.lit(2.5) + number % 3 / 4).alias("average_stars"),
        (number % 90 + 20).alias("useful"),
    )
    businesses = spark.range(500).select(
        F.lit("n").alias("name"),
        F.lit(4.0).alias("stars"),
        F.lit(60).cast("long").alias("review_count"),
        F.concat(F.lit("s"), number % 4).alias("state"),
        F.lit("c").alias("city"),
        F.lit("k").alias("categories"),
        F.concat(F.lit("b"), number).alias("business_id"),
    )
    tables = []
    for df, by, schema in (
        (businesses, "state", schemas.TOP_RATED_BUSINESSES),
        (users, "average_stars", schemas.ENGAGED_USERS),
        (reviews, "stars", schemas.CLEANED_REVIEWS),
    ):
        overwrite_partitioned(df, str(root / by), by, rebalance=False)
        tables.append(read_table(spark, str(root / by), schema))
    return tables


@pytest.fixture
def no_small_sides(set_conf):
    set_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    set_conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")


def test_best_reviews_reads_one_partition_and_limits_before_the_shuffle(silver, plan_of):
    plan = plan_of(gold.best_reviews(*silver))
    assert "PartitionFilters: [isnotnull(stars" in plan
    assert "= 5.0" in plan
    assert "LeftOuter" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # Each small side is sent to the reviews, whose narrow rows are shuffled once, cut to one
    # row per business and task; the rest are joins that fetch what was chosen.
    assert plan.count("row_number(), 1, Partial") == 3
    assert plan.count("BroadcastHashJoin") == 5
    assert "SortMergeJoin" not in plan
    limited = plan.index("row_number(), 1, Partial")
    assert plan.index("Exchange hashpartitioning(business_id") < limited


def test_the_text_is_fetched_for_chosen_reviews(silver, plan_of):
    """No text is sorted by, nor moved before it meets the choice where it is read."""
    df = gold.best_reviews(*silver)
    df.collect()
    plan = re.sub(r"#\d+L?", "", plan_of(df)).split("== Initial Plan ==")[0].splitlines()
    sorted_by = [re.search(r"Sort \[.*?\]", line) for line in plan]
    assert not any("review_text" in found[0] for found in sorted_by if found)
    scans = [i for i, line in enumerate(plan) if "FileScan" in line and "review_id" in line]
    assert sum("review_text" in plan[i].split("]")[0] for i in scans) == 1 and len(scans) == 2
    at = next(i for i in scans if "review_text" in plan[i].split("]")[0])
    chosen = "BroadcastHashJoin [business_id, review_id, review_date]"
    met = max(i for i in range(at) if chosen in plan[i])
    assert not any(re.search("Exchange|Sort|Window", line) for line in plan[met:at])


@pytest.mark.parametrize("bits", [28, 16])
def test_sides_beyond_the_broadcast_prune_the_reviews_by_a_bitmap(
    silver, plan_of, rows_of, no_small_sides, bits
):
    limits = Limits(broadcast_bytes=0, filter_bits=bits)
    best, reviewed = gold.best_reviews(*silver, limits=limits), gold.reviewed_by_engaged(
        *silver, limits=limits
    )
    assert rows_of(best) == rows_of(gold.best_reviews(*silver))
    assert rows_of(reviewed) == rows_of(gold.reviewed_by_engaged(*silver))
    plan = re.sub(r"#\d+L?", "", plan_of(reviewed)).split("== Initial Plan ==")[0].splitlines()
    (scan,) = [i for i, line in enumerate(plan) if "struct<business_id:string,user_id:string>" in line]
    moved = max(i for i in range(scan) if "Exchange hashpartitioning" in plan[i])
    assert sum("BroadcastHashJoin [shiftright(member__own" in x for x in plan[moved:scan]) == 2


def test_reviewed_reads_two_columns_of_the_reviews(silver, plan_of):
    plan = plan_of(gold.reviewed_by_engaged(*silver))
    assert "ReadSchema: struct<business_id:string,user_id:string>" in plan
    assert "= 5.0" in plan
    assert plan.count("LeftSemi") == 3
    assert "review_text" not in plan


def test_without_small_sides_all_joins_go_by_key(silver, plan_of, no_small_sides):
    best = plan_of(gold.best_reviews(*silver, limits=SHUFFLED))
    assert "Broadcast" not in best
    assert best.count("SortMergeJoin") == 2
    assert best.count("hashpartitioning(business_id") == 2
    reviewed = plan_of(gold.reviewed_by_engaged(*silver, limits=SHUFFLED))
    assert "Broadcast" not in reviewed
    assert reviewed.count("LeftSemi") == 2


def test_hot_users_are_dealt_out_in_one_pass(silver, plan_of, no_small_sides, rows_of):
    hot = Limits(broadcast_bytes=-1, hot_rows=3_000)
    best = gold.best_reviews(*silver, limits=hot)
    plan = plan_of(best)
    assert "user_id__salt" in plan
    assert "Union" not in plan
    assert plan.count("review_text:string") == 1  # the reviews are scanned once
    assert rows_of(best) == rows_of(gold.best_reviews(*silver))
    reviewed = gold.reviewed_by_engaged(*silver, limits=hot)
    plan = plan_of(reviewed)
    assert "user_id__salt" in plan
    assert plan.count("ReadSchema: struct<business_id:string,user_id:string>") == 1
    assert rows_of(reviewed) == rows_of(gold.reviewed_by_engaged(*silver))


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_reviews_laid_out_by_user_are_joined_where_they_lie(
    spark, silver, plan_of, rows_of, no_small_sides, set_conf, tmp_path, adaptive
):
    set_conf("spark.sql.adaptive.enabled", adaptive)
    businesses, users, reviews = silver
    name = f"reviews_by_user_{adaptive}"
    try:
        laid_out = overwrite_bucketed(reviews, name, str(tmp_path / "r"), "stars", "user_id", 16)
        assert rows_of(laid_out.select(*reviews.columns)) == rows_of(reviews)
        # Written again with a column less, the table keeps it.
        fewer = reviews.drop("review_text")
        again = overwrite_bucketed(fewer, name, str(tmp_path / "r"), "stars", "user_id", 16)
        assert again.where("review_text IS NULL").count() == reviews.count()
        limits = Limits(broadcast_bytes=0)
        answer = gold.reviewed_by_engaged(businesses, users, again, limits=limits)
        assert rows_of(answer) == rows_of(gold.reviewed_by_engaged(*silver))
        plan = re.sub(r"#\d+L?", "", plan_of(answer)).split("== Initial Plan ==")[0].splitlines()
        (scan,) = [i for i, line in enumerate(plan) if f"{name}[business_id,user_id" in line]
        met = max(i for i in range(scan) if "SortMergeJoin [user_id], [user_id]" in plan[i])
        assert not any("Exchange hashpartitioning" in line for line in plan[met:scan])
        assert "Bucketed: true" in plan[scan]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_the_answers_measure_their_sides_once(spark, silver):
    tracker = spark.sparkContext.statusTracker()
    for number, answer in enumerate((gold.best_reviews, gold.reviewed_by_engaged)):
        spark.sparkContext.setJobGroup(f"sides{number}", "before the answer returns")
        try:
            answer(*silver)
            assert len(tracker.getJobIdsForGroup(f"sides{number}")) == 1
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_cache_of_the_sql_answer_holds_one_column(silver, spark):
    view = gold.reviewed_ids_view(spark, *silver)
    assert view.columns == ["business_id"]


def test_adaptive_execution_splits_what_is_below_the_hot_limit(
    silver, plan_of, no_small_sides, set_conf, rows_of
):
    wanted = rows_of(gold.best_reviews(*silver))
    set_conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    set_conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8k")
    set_conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.2")
    set_conf("spark.sql.files.maxPartitionBytes", "64k")
    best = gold.best_reviews(*silver, limits=SHUFFLED)
    assert rows_of(best) == wanted
    assert "skew=true" in plan_of(best)


def test_complete_rows_turn_a_left_join_into_an_inner_one(silver, plan_of):
    businesses, _, reviews = silver
    best = first_per_group(reviews.drop("stars"), "business_id", [F.col("review_id")])
    joined = drop_incomplete(businesses.join(best, "business_id", "left"))
    assert "LeftOuter" not in plan_of(joined)


def test_filters_reach_the_scan(silver, plan_of):
    businesses, _, _ = silver
    plan = plan_of(drop_incomplete(businesses.select("name", "business_id")))
    assert "PushedFilters: [IsNotNull(name), IsNotNull(business_id)]" in plan
    assert "ReadSchema: struct<name:string,business_id:string>" in plan


def test_a_literal_filter_goes_below_the_join(silver, plan_of):
    _, users, reviews = silver
    joined = large_join(
        reviews, users.select("user_id", "useful"), "user_id", null_safe=True
    ).where(F.col("stars") == 5)
    assert "PartitionFilters: [isnotnull(stars" in plan_of(joined)
