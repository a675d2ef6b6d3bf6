import pytest

from kudosflow.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__checkpoint__dir=str(folder / "shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan_of():
    """The text of a physical plan, final if the DataFrame has been run."""

    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text


@pytest.fixture
def rows_of():
    """The rows of a DataFrame in an order of their own."""

    def rows(df) -> list[tuple]:
        return sorted((tuple(row) for row in df.collect()), key=repr)

    return rows


@pytest.fixture
def set_conf(spark):
    """Change session settings for one test."""
    before = {}

    def change(name: str, value: str) -> None:
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
