"""The six jobs end to end on a small lake with every edge case in it."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField

from kudosflow import jobs, schemas
from kudosflow.operators import Limits
from kudosflow.plans import gold

USERS = [
    ("u1", "Ana", 30, 3.50, 100),
    ("u2", "Ben", 25, 3.50, 100),  # not more than 25
    ("u3", "Cyd", 26, 2.49, 14),  # lower end
    ("u4", "Dee", 40, 4.01, 20),  # ratio of exactly 2
    ("u5", "Eli", 40, 4.01, 21),  # upper end
    ("u6", "Fay", 40, 4.02, 100),
    ("u7", "Gus", 40, 3.00, 0),  # division by zero
    ("u8", "Hal", 40, None, 100),
    ("u9", None, 40, 3.00, 50),
    (None, "Ivy", 40, 3.00, 500),
    ("u10", "Jo", 40, 3.00, None),
]
BUSINESSES = [
    ("b1", 4.0, 60, "NC", "cat"),
    ("b2", 3.5, 50, "01", "cat"),
    ("b3", 3.49, 60, "NC", "cat"),
    ("b4", 4.5, 49, "NC", "cat"),
    ("b5", 4.5, 100, "AZ", None),
    ("b6", 4.5, 100, "AZ", "cat"),
    ("b7", 4.5, 100, "", "cat"),
    ("b8", 5.0, 100, "AZ", "cat"),
    ("b9", 4.5, 100, "AZ", "cat"),
    ("b10", None, 100, "AZ", "cat"),
    ("b11", 4.0, 60, "NC", "cat"),
]
REVIEWS = [
    ("r01", "b1", "u1", 5, "good", 0),
    ("r02", "b1", "u3", 5, "great", 999),  # a review's own votes do not count
    ("r03", "b1", "u1", 5, "again", 1),  # ties with r01
    ("r04", "b2", "u5", 5, "ok", 0),
    ("r05", "b5", "u1", 5, "t", 0),
    ("r06", "b6", None, 5, "t", 0),
    ("r07", "b7", "u1", 5, "t", 0),
    ("r08", "b8", "u1", 4, "t", 0),
    ("r09", "b9", "u1", 5, None, 0),  # wins with a NULL text
    ("r10", "b9", "u3", 5, "runner", 0),
    ("r11", None, "u1", 5, "t", 0),
    ("r12", "b3", "u1", 5, "t", 0),
    ("r13", "b1", "u2", 5, "t", 0),
    ("r14", "b11", "u9", 5, "t", 0),
]
CHECKINS = ["a, b, c", "a", "", "a,", ",", None]


def _lines(path, records, *, broken=False):
    lines = [
        json.dumps({name: value for name, value in record.items() if value is not None})
        for record in records
    ]
    path.write_text("\n".join([*lines, "{broken"] if broken else lines) + "\n")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    bronze = root / "bronze"
    bronze.mkdir()
    user = ["user_id", "name", "review_count", "average_stars", "useful"]
    _lines(
        bronze / "user.json",
        [dict(zip(user, row)) | {"yelping_since": "2010-01-01", "fans": 3} for row in USERS],
        broken=True,
    )
    business = ["business_id", "stars", "review_count", "state", "categories"]
    _lines(
        bronze / "business.json",
        [dict(zip(business, row)) | {"name": f"B {row[0]}", "city": "C"} for row in BUSINESSES],
    )
    review = ["review_id", "business_id", "user_id", "stars", "text", "useful"]
    extra = {"date": "2020-01-01", "funny": 1, "tags": ["x", "y"]}
    _lines(
        bronze / "review.json",
        [dict(zip(review, row)) | extra for row in REVIEWS],
        broken=True,
    )
    _lines(
        bronze / "checkin.json",
        [
            {"business_id": f"c{number}", "date": date, "source": {"app": "x", "tags": [number]}}
            for number, date in enumerate(CHECKINS)
        ],
    )
    lake = jobs.Lake(spark, str(root))
    for job in jobs.JOBS.values():
        job(lake)
    return lake


def test_checkin_counts(lake):
    table = lake.silver(jobs.CHECKIN_COUNTS, schemas.CHECKIN_COUNTS)
    counts = {row.business_id: row.checkin_count for row in table.collect()}
    assert counts == {"c0": 3, "c1": 1, "c2": 1, "c3": 2, "c4": 2, "c5": None}
    sources = {row.business_id: row.source for row in lake.silver(jobs.CHECKIN_COUNTS).collect()}
    assert sources["c4"].asDict(recursive=True) == {"app": "x", "tags": [4]}


def test_engaged_users(lake):
    table = lake.silver(jobs.ENGAGED_USERS, schemas.ENGAGED_USERS)
    assert table.schema == schemas.USER
    rows = {row.user_id: row for row in table.collect()}
    assert set(rows) == {"u1", "u3", "u5", "u9", None}
    assert rows["u3"].average_stars == 2.49
    assert rows["u5"].average_stars == 4.01


def test_top_rated_businesses(lake):
    table = lake.silver(jobs.TOP_RATED, schemas.TOP_RATED_BUSINESSES)
    assert table.schema == schemas.BUSINESS
    states = {row.business_id: row.state for row in table.collect()}
    assert set(states) == {"b1", "b2", "b5", "b6", "b7", "b8", "b9", "b11"}
    assert states["b2"] == "01"
    assert states["b7"] is None


def test_cleaned_reviews(lake):
    table = lake.silver(jobs.REVIEWS)
    assert set(table.columns) == {
        "review_id", "business_id", "user_id", "stars", "review_text", "date", "useful", "tags",
        "_corrupt_record",
    }
    rows = table.collect()
    assert len(rows) == len(REVIEWS) + 1
    assert {tuple(row.tags) for row in rows if row.review_id} == {("x", "y")}
    assert [row["_corrupt_record"] for row in rows if not row.review_id] == ["{broken"]


def test_best_reviews(lake):
    table = lake.gold(jobs.BEST_REVIEWS, schemas.BEST_REVIEWS)
    assert table.schema == schemas.BEST_REVIEWS
    found = {(row.business_id, row.review_id, row.username, row.state) for row in table.collect()}
    assert found == {
        ("b1", "r01", "Ana", "NC"),
        ("b2", "r04", "Eli", "01"),
        ("b6", "r06", "Ivy", "AZ"),
    }


def test_reviewed_by_engaged(lake, spark):
    table = spark.table(jobs.REVIEWED)
    assert table.schema == schemas.REVIEWED_BY_ENGAGED
    assert {row.business_id for row in table.collect()} == {"b1", "b2", "b5", "b7", "b9", "b11"}
    assert lake.gold(jobs.REVIEWED).count() == 6


@pytest.mark.parametrize(
    "limits",
    [
        Limits(),
        Limits(broadcast_bytes=-1),
        Limits(broadcast_bytes=-1, hot_share=0.01, hot_rows=2),
        Limits(broadcast_bytes=-1, hot_share=0.01, hot_rows=1),
    ],
)
def test_layout_does_not_change_the_answers(lake, rows_of, limits):
    tables = jobs._silver_tables(lake)
    best = gold.best_reviews(*tables, limits=limits)
    assert rows_of(best) == rows_of(lake.gold(jobs.BEST_REVIEWS, schemas.BEST_REVIEWS))
    reviewed = gold.reviewed_by_engaged(*tables, limits=limits)
    assert rows_of(reviewed) == rows_of(lake.gold(jobs.REVIEWED))


def test_order_and_partitioning_of_the_input_do_not_matter(lake, rows_of):
    tables = jobs._silver_tables(lake)
    best, reviewed = rows_of(gold.best_reviews(*tables)), rows_of(gold.reviewed_by_engaged(*tables))
    for parts, seed in ((1, 1), (7, 2)):
        mixed = [df.repartition(parts).sort(F.rand(seed)) for df in tables]
        assert rows_of(gold.best_reviews(*mixed)) == best
        assert rows_of(gold.reviewed_by_engaged(*mixed)) == reviewed


def test_reviews_in_buckets_give_the_same_answers(lake, spark, rows_of):
    inputs = {name: lake.path("bronze", f"{name}.json") for name in ("user", "business", "review")}
    root = f"{lake.root}/buckets"
    own = jobs.Lake(spark, root, inputs=inputs, review_buckets=4)
    first = ["engaged_users", "top_rated_businesses", "cleaned_reviews"]
    for name in [*first, "cleaned_reviews"]:  # the reviews once more over themselves
        jobs.JOBS[name](own)
    try:
        assert spark.catalog.tableExists(own.reviews_by_user)
        reviews = own.silver(jobs.REVIEWS, schemas.CLEANED_REVIEWS)
        assert rows_of(reviews) == rows_of(lake.silver(jobs.REVIEWS, schemas.CLEANED_REVIEWS))
        for answer in (gold.best_reviews, gold.reviewed_by_engaged):
            for limits in (Limits(), Limits(broadcast_bytes=0), Limits(broadcast_bytes=-1)):
                found = answer(*jobs._silver_tables(own), limits=limits)
                assert rows_of(found) == rows_of(answer(*jobs._silver_tables(lake)))
    finally:
        jobs.cleaned_reviews(jobs.Lake(spark, root, inputs=inputs))
    assert not spark.catalog.tableExists(own.reviews_by_user)
    found = gold.best_reviews(*jobs._silver_tables(own))  # without the catalog, by path
    assert rows_of(found) == rows_of(gold.best_reviews(*jobs._silver_tables(lake)))


def test_sql_answer(lake, spark, rows_of):
    view = gold.reviewed_ids_view(spark, *jobs._silver_tables(lake))
    assert view.columns == ["business_id"]
    assert rows_of(gold.reviewed_by_engaged_sql(spark)) == rows_of(lake.gold(jobs.REVIEWED))


def test_running_again_changes_nothing(lake, rows_of):
    before = rows_of(lake.gold(jobs.BEST_REVIEWS, schemas.BEST_REVIEWS))
    for job in jobs.JOBS.values():
        job(lake)
    assert rows_of(lake.gold(jobs.BEST_REVIEWS, schemas.BEST_REVIEWS)) == before
    assert lake.silver(jobs.REVIEWS).count() == len(REVIEWS) + 1


def test_a_given_schema_drops_what_it_does_not_name(lake, spark):
    declared = jobs.Lake(spark, lake.root, {"review": schemas.REVIEW}).bronze("review")
    assert declared.schema == schemas.REVIEW
    assert declared.count() == len(REVIEWS) + 1


def test_command_line_runs_chosen_jobs(lake, rows_of, tmp_path):
    (tmp_path / "elsewhere.json").write_text(json.dumps({"business_id": "c", "date": "x,y"}))
    jobs.main([lake.root, "--only", "checkin_counts", "--input", f"checkin={tmp_path}/*.json"])
    counts = lake.silver(jobs.CHECKIN_COUNTS, schemas.CHECKIN_COUNTS)
    assert [tuple(row) for row in counts.collect()] == [("c", "x,y", 2)]
    chosen = ["--only", "checkin_counts", "cleaned_reviews"]
    jobs.main([lake.root, *chosen, "--declared-only", "--no-rebalance"])
    assert lake.silver(jobs.CHECKIN_COUNTS).columns == schemas.CHECKIN_COUNTS.names
    reviews = lake.silver(jobs.REVIEWS)
    assert reviews.where("tags IS NOT NULL").count() == 0
    jobs.main([lake.root, *chosen])
    assert lake.silver(jobs.CHECKIN_COUNTS).count() == len(CHECKINS)
    reviews = lake.silver(jobs.REVIEWS)
    assert {"useful", "tags", "_corrupt_record"} <= set(reviews.columns)
    before = rows_of(lake.gold(jobs.BEST_REVIEWS, schemas.BEST_REVIEWS))
    jobs.main([lake.root, "--only", "best_reviews", "--broadcast-mib", "0"])
    assert rows_of(lake.gold(jobs.BEST_REVIEWS, schemas.BEST_REVIEWS)) == before
    assert reviews.count() == len(REVIEWS) + 1
    assert rows_of(gold.reviewed_by_engaged(*jobs._silver_tables(lake))) == rows_of(
        lake.gold(jobs.REVIEWED)
    )


def test_bounds_of_the_command_line(lake, spark, tmp_path, capsys):
    inputs = [f"{name}={lake.root}/bronze/{name}.json" for name in ("checkin", "user", "review")]
    inputs.append(f"business={lake.root}/bronze/business.json")
    root = str(tmp_path)
    jobs.main([root, "--input", *inputs, "--null-count", "-1", "--user-min-reviews", "24",
               "--min-stars", "4.4", "--rating", "4"])
    own = jobs.Lake(spark, root)
    counts = own.silver(jobs.CHECKIN_COUNTS).collect()
    assert {row.business_id: row.checkin_count for row in counts}["c5"] == -1
    users = own.silver(jobs.ENGAGED_USERS, schemas.ENGAGED_USERS).collect()
    assert "u2" in {row.user_id for row in users}
    shops = own.silver(jobs.TOP_RATED, schemas.TOP_RATED_BUSINESSES).collect()
    assert {row.business_id for row in shops} == {"b5", "b6", "b7", "b8", "b9"}
    assert [row.business_id for row in own.gold(jobs.REVIEWED).collect()] == ["b8"]
    said = capsys.readouterr().err
    assert "lives in memory" in said and f"{root}/gold" in said
    jobs.main([lake.root, "--only", "reviewed_by_engaged"])  # the name is the fixture's again
