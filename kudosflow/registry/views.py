"""The sales tables seen as review data.

Parts stand for businesses, customers for users, and line items with the customer
of their order for reviews. One customer key becomes NULL on both sides, so that
null-safe and plain equality differ, and some users have no useful votes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kudosflow.operators import large_join
from kudosflow.plans import silver


# The columns of the sales tables that are read here, with their types.
# Declared, a table is opened without a job that looks at its files.
TABLES = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_returnflag string,"
    " l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("business_id"),
        F.col("p_name").alias("name"),
        (F.col("p_size").cast("double") / 10).alias("stars"),
        (F.col("p_partkey") % 100).alias("review_count"),
        F.col("p_brand").alias("state"),
        F.col("p_type").alias("city"),
        F.nullif(F.col("p_type"), F.lit("ECONOMY")).alias("categories"),
    )


def user_id(customer: Column) -> Column:
    return F.nullif(customer, F.lit(30).cast("long")).alias("user_id")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        user_id(key),
        F.nullif(F.col("c_name"), F.lit("Customer#000000044")).alias("name"),
        F.col("c_mktsegment").alias("yelping_since"),
        (key % 60).alias("review_count"),
        ((100 + (key * 7) % 401).cast("double") / 100).alias("average_stars"),
        (key % 37).alias("useful"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return large_join(lines, orders, "o_orderkey").select(
        (F.col("o_orderkey") * 10 + F.col("l_linenumber")).alias("review_id"),
        user_id(F.col("o_custkey")),
        F.col("l_partkey").alias("business_id"),
        F.least(F.col("l_linenumber"), F.lit(5)).cast("double").alias("stars"),
        F.concat("l_returnflag", "l_linestatus").alias("text"),
        F.col("l_shipdate").alias("date"),
        F.lit(1).alias("funny"),
    )


def checkins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts, whose commas separate the tokens to count."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("date"))


def engaged_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.engaged_users(users(spark, sf_dir))


def top_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.top_rated_businesses(businesses(spark, sf_dir))


def cleaned_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.cleaned_reviews(reviews(spark, sf_dir))
