"""The six jobs over one lake root: ``spark-submit`` this file or run it as a module.

    python -m kudosflow.jobs ROOT [--only JOB ...] [--input NAME=PATH ...] [OPTION ...]

Each job is a full refresh. Without ``--only`` all run, silver before gold; ``--help``
lists the options, among them the bounds of the jobs.
"""

from __future__ import annotations

import argparse
import sys
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from kudosflow import schemas
from kudosflow.operators.limits import DEFAULT, Limits
from kudosflow.plans import gold, silver
from kudosflow.session import build_session
from kudosflow.sinks import (
    overwrite,
    overwrite_bucketed,
    overwrite_merging_schema,
    overwrite_partitioned,
    replace_external_table,
)
from kudosflow.sources import read_json_lines, read_table

# Table names below the silver and gold folders.
CHECKIN_COUNTS = "checkin_count_business"
ENGAGED_USERS = "engaged_users"
TOP_RATED = "top_rated_business"
REVIEWS = "user_review"
BEST_REVIEWS = "useful_reviews_five_stars_business"
REVIEWED = "top_rated_business_reviewed_by_engaged_users"


@dataclass(frozen=True)
class Bounds:
    """What the jobs compare with; the defaults are fixed values."""

    delimiter: str = ","
    null_count: int | None = None
    user_min_reviews: int = 25
    user_stars: tuple[float, float] = (2.49, 4.01)
    user_max_ratio: float = 2
    min_stars: float = 3.5
    min_reviews: int = 50
    rating: float = 5


class Lake:
    """Paths below one root, how bronze records are read and tables laid out.

    Fields are found by name without regard to case and have their declared types. Check-ins
    and reviews keep all other fields as well, with types inferred; a schema for them in
    ``bronze_schemas`` is declared instead, and drops what it does not name. ``inputs``
    names records that are not at ``bronze/NAME.json``. With ``review_buckets`` the cleaned
    reviews are a table of the catalog as well, laid out in so many buckets by user.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        bronze_schemas: dict[str, StructType] | None = None,
        inputs: dict[str, str] | None = None,
        rebalance: bool = True,
        limits: Limits = DEFAULT,
        bounds: Bounds = Bounds(),
        in_place: bool = False,
        review_buckets: int | None = None,
    ):
        self.review_buckets = review_buckets
        self.bounds = bounds
        self.spark = spark
        self.inputs = inputs or {}
        self.rebalance = rebalance
        self.in_place = in_place
        self.limits = limits
        self.root = root.rstrip("/")
        # Of users and businesses only declared columns are used.
        named = {"user": schemas.USER, "business": schemas.BUSINESS}
        self.bronze_schemas = named | (bronze_schemas or {})

    @property
    def reviews_by_user(self) -> str:
        """The catalog's name of the reviews in buckets; other lakes have other ones."""
        return f"{REVIEWS}_by_user_{zlib.crc32(self.root.encode()):08x}"

    @property
    def layout(self) -> dict[str, bool]:
        """How partitioned tables are written."""
        return {"rebalance": self.rebalance, "in_place": self.in_place}

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def bronze(self, name: str) -> DataFrame:
        path = self.inputs.get(name, self.path("bronze", f"{name}.json"))
        only = self.bronze_schemas.get(name)
        declared = only or {"checkin": schemas.CHECKIN, "review": schemas.REVIEW}[name]
        return read_json_lines(self.spark, path, declared=declared, others=only is None)

    def silver(self, name: str, schema: StructType | None = None) -> DataFrame:
        return read_table(self.spark, self.path("silver", name), schema)

    def gold(self, name: str, schema: StructType | None = None) -> DataFrame:
        return read_table(self.spark, self.path("gold", name), schema)


def checkin_counts(lake: Lake) -> None:
    bounds = lake.bounds
    counted = silver.checkin_counts(lake.bronze("checkin"), bounds.delimiter, bounds.null_count)
    overwrite(counted, lake.path("silver", CHECKIN_COUNTS), in_place=lake.in_place)


def engaged_users(lake: Lake) -> None:
    bounds = lake.bounds
    engaged = silver.engaged_users(
        lake.bronze("user"), bounds.user_min_reviews, bounds.user_stars, bounds.user_max_ratio
    )
    path = lake.path("silver", ENGAGED_USERS)
    overwrite_partitioned(engaged, path, "average_stars", **lake.layout)


def top_rated_businesses(lake: Lake) -> None:
    bounds = lake.bounds
    top_rated = silver.top_rated_businesses(
        lake.bronze("business"), bounds.min_stars, bounds.min_reviews
    )
    path = lake.path("silver", TOP_RATED)
    overwrite_partitioned(top_rated, path, "state", **lake.layout)


def cleaned_reviews(lake: Lake) -> None:
    cleaned = silver.cleaned_reviews(lake.bronze("review"))
    path = lake.path("silver", REVIEWS)
    if lake.review_buckets:
        name, buckets = lake.reviews_by_user, lake.review_buckets
        overwrite_bucketed(cleaned, name, path, "stars", "user_id", buckets)
    else:
        # The files stay; a layout that they will not have is forgotten.
        lake.spark.sql(f"DROP TABLE IF EXISTS {lake.reviews_by_user}")
        overwrite_merging_schema(cleaned, path, "stars", **lake.layout)


def _silver_tables(lake: Lake) -> tuple[DataFrame, DataFrame, DataFrame]:
    if lake.review_buckets and lake.spark.catalog.tableExists(lake.reviews_by_user):
        reviews = lake.spark.table(lake.reviews_by_user).select(*schemas.CLEANED_REVIEWS.names)
    else:  # a catalog that forgot the buckets: the same files by their path
        reviews = lake.silver(REVIEWS, schemas.CLEANED_REVIEWS)
    return (
        lake.silver(TOP_RATED, schemas.TOP_RATED_BUSINESSES),
        lake.silver(ENGAGED_USERS, schemas.ENGAGED_USERS),
        reviews,
    )


def best_reviews(lake: Lake) -> None:
    best = gold.best_reviews(*_silver_tables(lake), lake.bounds.rating, lake.limits)
    path = lake.path("gold", BEST_REVIEWS)
    overwrite_merging_schema(best, path, "state", **lake.layout)


def reviewed_by_engaged(lake: Lake) -> None:
    reviewed = gold.reviewed_by_engaged(*_silver_tables(lake), lake.bounds.rating, lake.limits)
    replace_external_table(reviewed, REVIEWED, lake.path("gold", REVIEWED))


# In the order their inputs require.
JOBS: dict[str, Callable[[Lake], None]] = {
    "checkin_counts": checkin_counts,
    "engaged_users": engaged_users,
    "top_rated_businesses": top_rated_businesses,
    "cleaned_reviews": cleaned_reviews,
    "best_reviews": best_reviews,
    "reviewed_by_engaged": reviewed_by_engaged,
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Refresh the review tables below a lake root.")
    parser.add_argument("root", help="any path or URI Spark can read and write")
    parser.add_argument("--only", nargs="+", choices=list(JOBS), default=list(JOBS))
    parser.add_argument(
        "--input",
        nargs="+",
        default=[],
        metavar="NAME=PATH",
        help="where user, business, review or checkin records are, if not in ROOT/bronze",
    )
    parser.add_argument(
        "--declared-only",
        action="store_true",
        help="drop the fields of check-ins and reviews that are not declared; stores no copy",
    )
    parser.add_argument(
        "--no-rebalance",
        action="store_true",
        help="write partitioned tables without a shuffle, one file per task and value",
    )
    parser.add_argument(
        "--in-place",
        action="store_true",
        help="delete a table's files before its new ones are written, where folders cannot be"
        " renamed at once; a failed write then leaves the table incomplete",
    )
    parser.add_argument(
        "--review-buckets",
        type=int,
        help="lay the cleaned reviews out in so many buckets by user, for joins without a"
        " shuffle; wants --hive, or all jobs in one session",
    )
    parser.add_argument(
        "--broadcast-mib",
        type=int,
        default=DEFAULT.broadcast_bytes >> 20,
        help="largest measured size of a join side to broadcast (default %(default)s)",
    )
    parser.add_argument(
        "--hive",
        action="store_true",
        help="keep the second answer's table in a Hive catalog, where other sessions find it",
    )
    own = Bounds()
    bounds = parser.add_argument_group("bounds of the jobs")
    bounds.add_argument("--delimiter", default=own.delimiter, help="pattern between check-ins")
    bounds.add_argument("--null-count", type=int, help="count of a check-in list that is NULL")
    bounds.add_argument("--user-min-reviews", type=int, default=own.user_min_reviews)
    bounds.add_argument(
        "--user-stars", type=float, nargs=2, default=own.user_stars, metavar=("LOW", "HIGH")
    )
    bounds.add_argument("--user-max-ratio", type=float, default=own.user_max_ratio)
    bounds.add_argument("--min-stars", type=float, default=own.min_stars)
    bounds.add_argument("--min-reviews", type=int, default=own.min_reviews)
    bounds.add_argument("--rating", type=float, default=own.rating, help="that reviews need")
    options = parser.parse_args(arguments)
    catalog = {"spark__sql__catalogImplementation": "hive"} if options.hive else {}
    spark = build_session("kudosflow", **catalog)
    declared = {"checkin": schemas.CHECKIN, "review": schemas.REVIEW}
    inputs = dict(entry.split("=", 1) for entry in options.input)
    limits = Limits(broadcast_bytes=options.broadcast_mib << 20)
    lake = Lake(
        spark,
        options.root,
        declared if options.declared_only else None,
        inputs,
        not options.no_rebalance,
        limits,
        Bounds(
            options.delimiter,
            options.null_count,
            options.user_min_reviews,
            tuple(options.user_stars),
            options.user_max_ratio,
            options.min_stars,
            options.min_reviews,
            options.rating,
        ),
        options.in_place,
        options.review_buckets,
    )
    for name, job in JOBS.items():
        if name in options.only:
            job(lake)
    if "reviewed_by_engaged" in options.only and _forgetful(spark):
        print(
            f"The catalog lives in memory: the name {REVIEWED} ends with this session. Its "
            f"files stay in {lake.path('gold', REVIEWED)}; see --hive.",
            file=sys.stderr,
        )


def _forgetful(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "in-memory"


if __name__ == "__main__":
    main()
