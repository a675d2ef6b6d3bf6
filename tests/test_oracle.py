"""Every registered query against its SQL in DuckDB, values and types."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from kudosflow import registry

FOLDER = Path("/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert registry.queries().keys() == registry.oracle_sql().keys()
    assert registry.queries().items() <= driver.queries().items()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(name, spark, duck):
    df = driver.queries()[name](spark, str(FOLDER))
    columns = sorted(df.columns)
    ours = sorted(map(repr, (tuple(row) for row in df.select(columns).collect())))
    wanted = f"SELECT {', '.join(columns)} FROM ({driver.oracle_sql()[name]})"
    answer = duck.execute(f"SELECT * FROM ({driver.oracle_sql()[name]})")
    assert sorted(entry[0] for entry in answer.description) == columns
    answer = duck.execute(wanted)
    kinds = {entry[0]: str(entry[1]) for entry in answer.description}
    assert kinds == {field.name: TYPES[field.dataType.simpleString()] for field in df.schema}
    theirs = sorted(map(repr, answer.fetchall()))
    assert ours
    assert ours == theirs


def test_flagship(spark):
    assert driver.entry(spark).count() == 25


def test_gold_answers_agree(spark):
    """A business with a best review was reviewed; only its categories may bar it."""
    run = driver.queries()
    best = run["gold_best_review"](spark, str(FOLDER)).where("username <> 'Customer#000000030'")
    reviewed = run["gold_reviewed_by_engaged"](spark, str(FOLDER))
    assert best.join(reviewed, "business_id", "left_anti").count() == 0
