"""Operators against plain Python on small tables, whatever the layout."""

from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kudosflow.functions import ratio, token_count
from kudosflow.operators import (
    Limits,
    cached_view,
    drop_incomplete,
    first_per_group,
    fits_broadcast,
    frequent_values,
    large_join,
    measured_bytes,
    measured_sizes,
    null_safe_join,
    number_rows,
    possible_matches,
    ranking,
    semi_join_in,
    split_join,
    sql_view,
    which_fit,
)
from kudosflow.plans import gold, silver

KEYS = st.one_of(st.none(), st.integers(0, 3))
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 5)), max_size=25)
SLOW = settings(
    max_examples=5,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
# Nothing is broadcast for its size, and any key held by three rows is hot.
SPLIT = Limits(broadcast_bytes=-1, hot_share=0.001, hot_rows=3)


def table(spark, rows, columns):
    return spark.createDataFrame(rows, ", ".join(columns))


def brute_join(left, right, how, null_safe):
    def same(a, b):
        return a == b and (null_safe or a is not None)

    if how == "left_semi":
        return [l for l in left if any(same(l[0], r[0]) for r in right)]
    found = [(l[0], l[1], r[1]) for l in left for r in right if same(l[0], r[0])]
    if how == "left":
        found += [(*l, None) for l in left if not any(same(l[0], r[0]) for r in right)]
    return found


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@SLOW
@given(left=ROWS, right=ROWS)
def test_joins_in_every_layout(spark, rows_of, how, null_safe, left, right):
    a = table(spark, left, ["k int", "x int"])
    b = table(spark, right, ["k int", "y int"])
    wanted = sorted(brute_join(left, right, how, null_safe), key=repr)
    for limits in (Limits(), SPLIT, Limits(hot_rows=1), Limits(broadcast_bytes=0)):
        joined = large_join(a, b, "k", how, null_safe, selective=True, limits=limits)
        assert rows_of(joined) == wanted
        assert rows_of(split_join(a, b, "k", how, null_safe, limits=limits)) == wanted


@pytest.mark.parametrize("how, null_safe", [("inner", True), ("left", False), ("left_semi", True)])
@pytest.mark.parametrize(
    "kind",
    ["binary", "struct<a:int,b:string>", "array<int>", "timestamp", "double", "decimal(9,2)",
     "date", "array<double>"],
)
def test_keys_of_any_type_in_every_layout(spark, rows_of, kind, how, null_safe):
    text = {
        "binary": "CAST(v AS BINARY)",
        "struct<a:int,b:string>": "named_struct('a', CAST(v AS INT), 'b', v)",
        "array<int>": "array(CAST(v AS INT), 0)",
        "array<double>": "array(CAST(v AS DOUBLE) * 0 - 0.0D)",
        "timestamp": "timestamp_seconds(CAST(v AS INT) * 1800)",
        "double": "CASE WHEN v = '1' THEN CAST('NaN' AS DOUBLE) ELSE CAST(v AS DOUBLE) END",
        "date": "date_add(DATE'2020-03-01', CAST(v AS INT))",
    }.get(kind, f"CAST(v AS {kind})")
    rows = [("0", 1), ("0", 2), ("0", 3), ("1", 4), (None, 5), (None, 6), (None, 7), ("2", 8)]
    a = table(spark, rows, ["v string", "x int"]).selectExpr(f"{text} AS k", "x")
    partners = [("0", 1), ("0", 2), (None, 3), ("1", 4), ("3", 5)]
    b = table(spark, partners, ["v string", "y int"]).selectExpr(f"{text} AS k", "y")
    wanted = rows_of(_plain_join(a, b, how, null_safe))
    for limits in (Limits(), SPLIT, Limits(broadcast_bytes=0)):
        joined = large_join(a, b, "k", how, null_safe, selective=True, limits=limits)
        assert repr(rows_of(joined)) == repr(wanted)


def _plain_join(a, b, how, null_safe):
    return null_safe_join(a, b, "k", how) if null_safe else a.join(b, "k", how)


def test_keys_of_different_width_in_every_layout(spark, rows_of):
    a = table(spark, [(1, 1), (1, 2), (1, 3), (2, 4)], ["k int", "x int"])
    for kind in ("bigint", "string", "double"):
        b = table(spark, [(1, 1), (3, 2)], ["k int", "y int"])
        b = b.select(F.col("k").cast(kind).alias("k"), "y")
        wanted = rows_of(a.join(b, "k").select("x", "y"))
        assert rows_of(split_join(a, b, "k", limits=SPLIT).select("x", "y")) == wanted
        pruned = large_join(a, b, "k", selective=True, limits=Limits(broadcast_bytes=0))
        assert rows_of(pruned.select("x", "y")) == wanted


@pytest.mark.parametrize("kind", ["string", "binary", "array<int>", "double", "timestamp"])
def test_number_rows_with_maps_and_any_key(spark, kind):
    key = {"array<int>": "array(CAST(id % 3 AS INT))", "timestamp": "timestamp_seconds(id % 3)"}
    text = key.get(kind, f"CAST(CAST(id % 3 AS STRING) AS {kind})")
    df = spark.range(0, 60, 1, 4).selectExpr(
        f"CASE WHEN id % 3 < 2 THEN {text} END AS k",
        "id % 4 AS x",
        "map('a', id % 2, 'b', NULL) AS m",
        "named_struct('n', map(id % 5, 1.5D)) AS s",
    )
    order = [F.col("x").desc()]
    for limits in (Limits(), Limits(hot_rows=15), Limits(hot_rows=1), Limits(1, 0.5, 1)):
        out = number_rows(df, "k", order, limits=limits)
        assert out.columns == [*df.columns, "row"]
        numbers = out.groupBy("k").agg(
            F.count("*").alias("n"), F.countDistinct("row").alias("d"), F.max("row").alias("m")
        )
        assert {(row.n, row.d, row.m) for row in numbers.collect()} == {(20, 20, 20)}
        back = out.orderBy("k", "row").select("k", "x").collect()
        again = df.orderBy("k", F.col("x").desc()).select("k", "x").collect()
        assert repr(back) == repr(again)
        left = [repr(row) for row in out.drop("row").collect()]
        assert sorted(left) == sorted(repr(row) for row in df.collect())


def test_a_key_above_the_floor_is_split_however_small_its_share(spark):
    df = spark.range(0, 5_000, 1, 4).select(
        F.when(F.col("id") < 12, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id"
    )
    out = number_rows(df, "k", [F.col("id")], limits=Limits(hot_rows=10))
    assert "Union" in out._jdf.queryExecution().optimizedPlan().toString()
    assert {(row.id, row.row) for row in out.where("k = -1").collect()} == {
        (i, i + 1) for i in range(12)
    }


def test_keys_are_counted_by_hash_before_one_by_one(spark):
    keys = spark.range(0, 5_000, 1, 4).select(
        F.when(F.col("id") < 100, F.lit(None)).otherwise(F.col("id")).alias("row__value")
    )
    # One other key shares the bucket of the NULLs.
    assert ranking._possibly_large(keys, Limits(hot_rows=101)) is None
    few = ranking._possibly_large(keys, Limits(hot_rows=50))
    assert 100 <= few.count() < 200 and few.where("row__value IS NULL").count() == 100
    before = ranking.FULL_BUCKETS
    ranking.FULL_BUCKETS = 10
    try:
        assert ranking._possibly_large(keys, Limits(hot_rows=0)).count() == 5_000
    finally:
        ranking.FULL_BUCKETS = before
    assert ranking._possibly_large(keys.limit(0), Limits(hot_rows=0)) is None


@SLOW
@given(left=ROWS, right=ROWS)
def test_semi_join_in(spark, rows_of, left, right):
    a = table(spark, left, ["k int", "x int"])
    b = table(spark, right, ["k int", "y int"])
    wanted = sorted(brute_join(left, right, "left_semi", False), key=repr)
    for limits in (Limits(), SPLIT):
        assert rows_of(semi_join_in(a, b, "k", limits=limits)) == wanted


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_null_safe_join_of_a_table_with_itself(spark, how):
    df = table(spark, [(1, 1), (None, 2)], ["k int", "x int"])
    assert null_safe_join(df, df.select("k"), "k", how).count() == 2


@SLOW
@given(rows=ROWS)
def test_first_per_group(spark, rows_of, rows):
    df = table(spark, rows, ["k int", "x int"])
    firsts = {}
    for key, value in rows:
        firsts[key] = max(value, firsts.get(key, value))
    assert rows_of(first_per_group(df, "k", [F.col("x").desc()])) == sorted(
        firsts.items(), key=repr
    )


@pytest.mark.parametrize("copies_per_task", [2, 100_000])
@SLOW
@given(rows=ROWS)
def test_number_rows(spark, rows_of, copies_per_task, rows):
    df = table(spark, rows, ["k int", "x int"])
    ordered = sorted(rows, key=lambda row: (repr(row[0]), -row[1]))
    wanted = [
        (*row, number)
        for _, group in groupby(ordered, key=lambda row: row[0])
        for number, row in enumerate(group, 1)
    ]
    before = ranking.COPIES_PER_TASK
    ranking.COPIES_PER_TASK = copies_per_task
    try:
        more = df.union(table(spark, [(9, 9)] * 3, ["k int", "x int"]))
        for limits in (Limits(), SPLIT, Limits(hot_rows=1)):
            numbered = number_rows(df, "k", [F.col("x").desc()], counted=more, limits=limits)
            assert numbered.schema["row"].dataType.simpleString() == "bigint"
            assert rows_of(numbered) == sorted(wanted, key=repr)
    finally:
        ranking.COPIES_PER_TASK = before


def test_number_rows_over_many_slices(spark):
    """One key with most rows, each of several copies, ends up in many slices."""
    df = (
        spark.range(30_000)
        .withColumn("other", (F.col("id") % 7).cast("string"))
        .withColumn("k", F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.col("other")))
        .withColumn("x", F.col("id") % 5_000)
        .drop("id", "other")
    )
    order = [F.col("x").desc()]
    spread = number_rows(df, "k", order, limits=Limits(hot_rows=10_000))
    plain = number_rows(df, "k", order)
    assert spread.exceptAll(plain).count() == 0
    assert plain.exceptAll(spread).count() == 0


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_frequent_values(spark, set_conf, adaptive):
    set_conf("spark.sql.adaptive.enabled", adaptive)
    df = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None))
        .when(F.col("id") % 3 == 1, F.lit("often"))
        .otherwise(F.col("id").cast("string"))
        .alias("k")
    )
    assert set(frequent_values(df, "k", Limits(hot_rows=100))) == {None, "often"}
    assert frequent_values(df, "k") == []
    assert frequent_values(df.limit(0), "k", Limits(hot_rows=1)) == []
    nothing = df.where("k IS NULL AND k IS NOT NULL AND rand() < 2").repartition(3)
    assert frequent_values(nothing, "k", Limits(hot_rows=1)) == []
    assert frequent_values(df.where("k IS NULL"), "k", Limits(hot_rows=1)) == [None]


def test_frequent_values_misses_no_key_at_the_limit(spark):
    """Ninety keys of one per cent each between a hundred thousand rare ones."""
    df = spark.range(0, 1_000_000, 1, 300).select(
        F.when(F.col("id") % 10 < 9, F.col("id") % 100).otherwise(F.col("id")).alias("k")
    )
    found = frequent_values(df, "k", Limits(hot_share=0.009, hot_rows=1_000))
    assert set(found) == {number for number in range(100) if number % 10 < 9}


def test_measured_bytes(spark):
    assert measured_bytes(table(spark, [], ["a string"])) == 0
    narrow = table(spark, [("abc", 1), (None, 2)], ["a string", "b int"])
    assert measured_bytes(narrow) == 2 * (16 + 2 * 8) + 3
    nested = table(spark, [(["x" * 100],)], ["a array<string>"])
    assert measured_bytes(nested) > 100
    assert fits_broadcast(narrow, Limits(broadcast_bytes=67))
    assert not fits_broadcast(narrow, Limits(broadcast_bytes=66))


def test_sides_are_measured_in_one_job(spark):
    narrow = table(spark, [("abc", 1), (None, 2)], ["a string", "b int"])
    empty = table(spark, [], ["a string"])
    grouped = spark.range(0, 100, 1, 4).groupBy((F.col("id") % 5).alias("k")).count()
    assert measured_sizes([narrow, empty, grouped]) == [67, 0, 5 * 32]
    assert measured_sizes([empty, narrow.where("b > 2")]) == [0, 0]
    assert which_fit([narrow, grouped], Limits(broadcast_bytes=100)) == [True, False]
    assert which_fit([empty, grouped], Limits(broadcast_bytes=-1)) == [False, False]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("measured", "one job")
    try:
        which_fit([narrow, spark.range(0, 100, 1, 4)])
        assert len(tracker.getJobIdsForGroup("measured")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_scalar_functions(spark, set_conf, ansi):
    set_conf("spark.sql.ansi.enabled", ansi)
    texts = table(spark, [("a, b",), ("",), (",",), ("a,",), (None,)], ["t string"])
    counts = texts.select(token_count(F.col("t")), token_count(F.col("t"), null_count=-1))
    assert [tuple(row) for row in counts.collect()] == [(2, 2), (1, 1), (2, 2), (2, 2), (None, -1)]
    pairs = table(spark, [(3, 2), (1, 0), (1, None), (None, 1), (4, -2)], ["a bigint", "b bigint"])
    quotients = [row[0] for row in pairs.select(ratio(F.col("a"), F.col("b"))).collect()]
    assert quotients == [1.5, None, None, None, -2.0]


def test_nan(spark):
    nan = float("nan")
    rows = [("n", nan, 99, "s", "c", "x", "b1"), ("n", 4.0, 99, "s", "c", "x", "b2")]
    columns = [
        "name string", "stars double", "review_count bigint", "state string", "city string",
        "categories string", "business_id string",
    ]
    top = silver.top_rated_businesses(table(spark, rows, columns))
    assert top.count() == 2
    assert [row.business_id for row in drop_incomplete(top).collect()] == ["b2"]
    users = table(
        spark,
        [("u", "n", "d", 30, nan, 99)],
        ["user_id string", "name string", "yelping_since string", "review_count bigint",
         "average_stars double", "useful bigint"],
    )
    assert silver.engaged_users(users).count() == 0


def test_drop_incomplete_equals_na_drop(spark, rows_of):
    rows = [("a", 1.0), ("", float("nan")), (None, 2.0), ("b", None), ("", 0.0)]
    df = table(spark, rows, ["s string", "x double"])
    assert rows_of(drop_incomplete(df)) == rows_of(df.na.drop("any"))
    by_one = rows_of(drop_incomplete(df, ["s"]))
    assert repr(by_one) == repr(rows_of(df.na.drop("any", subset=["s"])))
    for subset in (["S"], "s", ["X", "s"], "X", ("x",), []):
        wanted = [subset] if isinstance(subset, str) else list(subset)
        kept = df.na.drop("any", subset=wanted) if wanted else df
        assert repr(rows_of(drop_incomplete(df, subset))) == repr(rows_of(kept))
    with pytest.raises(AnalysisException):
        drop_incomplete(df, ["nope"])


def test_cleaned_reviews_passes_over_missing_columns(spark):
    bare = table(spark, [("r", 1)], ["review_id string", "n int"])
    assert silver.cleaned_reviews(bare).columns == ["review_id", "n"]
    nested = table(spark, [("t", (1, 2))], ["text string", "s struct<a:int,b:int>"])
    assert silver.cleaned_reviews(nested).dtypes == [
        ("review_text", "string"),
        ("s", "struct<a:int,b:int>"),
    ]


def test_cached_view(spark):
    sql_view(spark, "numbers", "SELECT id FROM range(10)")
    with cached_view(spark, "numbers") as view:
        assert spark.catalog.isCached("numbers")
        assert view.count() == 10
    assert not spark.catalog.isCached("numbers")
    with pytest.raises(RuntimeError):
        with cached_view(spark, "numbers"):
            raise RuntimeError
    assert not spark.catalog.isCached("numbers")


REVIEW_ROWS = st.lists(
    st.tuples(
        st.integers(0, 4),
        st.one_of(st.none(), st.integers(0, 3)),
        st.integers(0, 3),
        st.sampled_from([4.0, 5.0]),
        st.one_of(st.none(), st.sampled_from("ab")),
    ),
    max_size=25,
)
USER_ROWS = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 3)),
        st.one_of(st.none(), st.sampled_from("xy")),
        st.one_of(st.none(), st.integers(0, 3)),
    ),
    max_size=8,
)


@SLOW
@given(reviews=REVIEW_ROWS, users=USER_ROWS, ids=st.lists(st.integers(0, 4), max_size=6))
def test_best_reviews_against_brute_force(spark, rows_of, reviews, users, ids):
    """Duplicate businesses and users included; every pair is formed and ranked."""
    shops = [("n", 4.0, 60, "s", "c", None if number == 4 else "k", number) for number in ids]

    def rank(pair):
        review, user = pair
        votes = (user[2] is None, -(user[2] or 0))
        name = (user[1] is not None, user[1] or "")
        text = (review[4] is not None, review[4] or "")
        return votes, review[0], name, text

    wanted = []
    for shop in shops:
        pairs = [
            (review, user)
            for review in reviews
            for user in users
            if review[3] == 5 and review[2] == shop[6] and review[1] == user[0]
        ]
        if not pairs:
            continue
        review, user = min(pairs, key=rank)
        row = (shop[6], *shop[:6], user[1], 3.0, user[2], review[4], review[0], "d")
        if None not in row:
            wanted.append(row)

    tables = (
        table(
            spark, shops,
            ["name string", "stars double", "review_count int", "state string", "city string",
             "categories string", "business_id int"],
        ),
        table(
            spark, users, ["user_id int", "name string", "useful int"],
        ).withColumn("average_stars", F.lit(3.0)),
        table(
            spark, reviews,
            ["review_id int", "user_id int", "business_id int", "stars double",
             "review_text string"],
        ).withColumn("date", F.lit("d")),
    )
    for limits in (Limits(), SPLIT, Limits(broadcast_bytes=-1, hot_rows=1)):
        assert rows_of(gold.best_reviews(*tables, limits=limits)) == sorted(wanted, key=repr)
        reviewed = gold.reviewed_by_engaged(*tables, limits=limits)
        known = {user[0] for user in users if user[0] is not None}
        hit = {review[2] for review in reviews if review[3] == 5 and review[1] in known}
        assert [row[0] for row in rows_of(reviewed)] == sorted(
            number for number in ids if number in hit
        )


def test_possible_matches_by_several_keys(spark, rows_of):
    left = spark.range(2_000).selectExpr("id % 50 AS a", "CAST(id AS STRING) AS b", "id AS x")
    left = left.unionByName(spark.sql("SELECT NULL AS a, '7' AS b, -1 AS x"))
    right = spark.range(0, 2_000, 100).selectExpr("CAST(id % 50 AS INT) AS a", "CAST(id AS STRING) AS b")
    found = {row.x for row in possible_matches(left, right, ["a", "b"]).collect()}
    assert found == set(range(0, 2_000, 100))
    kept = {row.x for row in possible_matches(left, right, ["a", "b"], null_safe=True).collect()}
    assert kept == found | {-1}
    few = Limits(filter_bits=16)
    assert found <= {row.x for row in possible_matches(left, right, ["a", "b"], limits=few).collect()}
    for off in (Limits(filter_bits=0), Limits(broadcast_bytes=-1)):
        assert possible_matches(left, right, ["a", "b"], limits=off) is left
    assert possible_matches(left, right.limit(0), ["a", "b"]).count() == 0
