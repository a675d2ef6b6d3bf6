import pytest
from pyspark.sql import functions as F

from kudosflow.sinks import (
    overwrite,
    overwrite_merging_schema,
    overwrite_partitioned,
    replace_external_table,
    with_columns_of,
)
from kudosflow.sources import read_json_lines, read_table


@pytest.fixture
def codes(spark):
    return spark.createDataFrame(
        [(1, "01", "x"), (2, "1", "y"), (3, "", "z"), (4, None, "w")],
        "id int, code string, rest string",
    )


def test_partition_values_keep_type_and_place(spark, codes, rows_of, tmp_path):
    path = str(tmp_path / "t")
    overwrite_partitioned(codes, path, "code")
    back = read_table(spark, path, codes.schema)
    assert back.schema == codes.schema
    assert rows_of(back) == [
        (1, "01", "x"),
        (2, "1", "y"),
        (3, None, "z"),  # directory names cannot tell empty from NULL
        (4, None, "w"),
    ]


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_overwrite_replaces_all_partitions(spark, codes, set_conf, tmp_path, fmt):
    set_conf("spark.sql.sources.partitionOverwriteMode", "dynamic")
    path = str(tmp_path / "t")
    overwrite_partitioned(codes, path, "code", fmt)
    overwrite_partitioned(codes.where("id = 1"), path, "code", fmt)
    assert read_table(spark, path, codes.schema, fmt).count() == 1
    overwrite(codes, path, fmt)
    assert read_table(spark, path, fmt=fmt).count() == 4


def test_rebalance_gathers_small_values_and_splits_large_ones(spark, set_conf, tmp_path):
    rows = spark.range(0, 200_000, 1, 8).select(
        "id",
        F.xxhash64("id").alias("noise"),
        F.when(F.col("id") % 100 == 0, F.col("id") % 7).otherwise(-1).alias("part"),
    )
    set_conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    set_conf("spark.sql.shuffle.partitions", "64")
    path = tmp_path / "t"
    overwrite_partitioned(rows, str(path), "part")
    files = {folder.name: len(list(folder.glob("*.parquet"))) for folder in path.glob("part=*")}
    assert files.pop("part=-1") >= 4
    assert set(files.values()) == {1}
    assert spark.read.parquet(str(path)).count() == 200_000


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_rebalance_can_be_left_out(spark, codes, set_conf, tmp_path, adaptive):
    set_conf("spark.sql.adaptive.enabled", adaptive)
    path = str(tmp_path / "t")
    overwrite_partitioned(codes, path, "code", rebalance=adaptive == "false")
    assert read_table(spark, path, codes.schema).count() == 4


def test_schema_grows_and_rows_are_replaced(spark, rows_of, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame(
        [("a", 1, (1, "p"))], "part string, old int, s struct<a:int,gone:string>"
    )
    overwrite_merging_schema(first, path, "part")
    second = spark.createDataFrame([("01", 2.5, (7,))], "part string, new double, s struct<a:int>")
    overwrite_merging_schema(second, path, "part")
    back = read_table(spark, path)
    assert set(back.columns) == {"part", "old", "new", "s"}
    row = back.first()
    assert (row.old, row.new, row.s.asDict()) == (None, 2.5, {"a": 7, "gone": None})
    overwrite_merging_schema(second, path, "part")
    assert read_table(spark, path).count() == 1
    assert {"old", "new"} <= set(read_table(spark, path).columns)


def test_schema_conflict_is_refused_before_anything_is_written(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_merging_schema(spark.createDataFrame([("a", 1)], "part string, n int"), path, "part")
    with pytest.raises(ValueError, match="column n"):
        overwrite_merging_schema(
            spark.createDataFrame([("a", "1")], "part string, n string"), path, "part"
        )
    assert read_table(spark, path).first().n == 1


def test_columns_outlive_a_refresh_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    kind = "part string, n int, extra string, s struct<a:int>"
    full = spark.createDataFrame([("a", 1, "x", (1,))], kind)
    overwrite_merging_schema(full, path, "part")
    overwrite_merging_schema(full.drop("extra").limit(0), path, "part")
    empty = read_table(spark, path)
    assert set(empty.columns) == {"part", "n", "extra", "s"}
    assert empty.count() == 0
    overwrite_merging_schema(full.drop("extra"), path, "part")
    back = read_table(spark, path)
    assert [(row.part, row.n, row.extra) for row in back.collect()] == [("a", 1, None)]
    overwrite_partitioned(full.limit(0), path, "part")
    assert read_table(spark, path, full.schema).count() == 0


@pytest.mark.parametrize(
    "old, new",
    [
        ("s struct<a:string>", "s struct<a:int>"),
        ("s struct<a:struct<b:string>>", "s struct<a:struct<b:int>>"),
        ("s array<struct<a:string>>", "s array<struct<a:int>>"),
        ("s map<string,bigint>", "s map<string,int>"),
        ("s map<int,bigint>", "s map<string,bigint>"),
        ("s struct<a:int>", "s int"),
    ],
)
def test_nested_type_changes_are_refused(spark, tmp_path, old, new):
    path = str(tmp_path / "t")
    overwrite_merging_schema(spark.createDataFrame([], f"part string, {old}"), path, "part")
    before = read_table(spark, path).schema
    with pytest.raises(ValueError, match="column s"):
        overwrite_merging_schema(spark.createDataFrame([], f"part string, {new}"), path, "part")
    assert read_table(spark, path).schema == before


def test_missing_fields_inside_arrays_and_maps_are_added(spark, tmp_path):
    path = str(tmp_path / "t")
    old = "part string, l array<struct<a:int,b:string>>, m map<string,struct<c:int,d:int>>"
    overwrite_merging_schema(spark.createDataFrame([], old), path, "part")
    new = spark.createDataFrame(
        [("x", [(1,), None], {"k": (2,), "n": None}), ("y", None, None)],
        "part string, l array<struct<a:int>>, m map<string,struct<c:int>>",
    )
    overwrite_merging_schema(new, path, "part")
    rows = {row.part: row.asDict(recursive=True) for row in read_table(spark, path).collect()}
    assert rows["x"]["l"] == [{"a": 1, "b": None}, None]
    assert rows["x"]["m"] == {"k": {"c": 2, "d": None}, "n": None}
    assert (rows["y"]["l"], rows["y"]["m"]) == (None, None)


def test_added_columns_cost_no_union(spark, plan_of):
    new = spark.range(3).select("id")
    old = spark.createDataFrame([], "id bigint, extra string").schema
    grown = with_columns_of(new, old)
    assert grown.dtypes == [("id", "bigint"), ("extra", "string")]
    assert "Union" not in plan_of(grown)


def test_an_empty_folder_is_no_table_yet(spark, codes, tmp_path):
    (tmp_path / "t").mkdir()
    overwrite_merging_schema(codes, str(tmp_path / "t"), "code")
    assert read_table(spark, str(tmp_path / "t")).count() == 4


def test_external_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_external_table(spark.range(3), "external_numbers", path)
    table = replace_external_table(
        spark.range(2).withColumn("x", F.lit("y")), "external_numbers", path
    )
    assert table.columns == ["id", "x"]
    assert spark.table("external_numbers").count() == 2
    about = {row.col_name: row.data_type for row in spark.sql(
        "DESCRIBE TABLE EXTENDED external_numbers").collect()}
    assert about["Type"] == "EXTERNAL"
    assert read_table(spark, path).count() == 2


def test_json_lines(spark, tmp_path):
    file = tmp_path / "t.json"
    file.write_text('{"a": 1, "b": "x"}\n{broken\n{"a": "bad", "b": "y", "c": [1]}\n')
    declared = spark.createDataFrame([], "a bigint, b string").schema
    rows = [tuple(row) for row in read_json_lines(spark, str(file), declared).collect()]
    assert rows == [(1, "x"), (None, None), (None, "y")]
    inferred = read_json_lines(spark, str(file))
    assert inferred.columns == ["_corrupt_record", "a", "b", "c"]
    assert inferred.select("a", "b").count() == 3
    both = read_json_lines(spark, str(file), declared=spark.createDataFrame(
        [], "a bigint, z double").schema)
    assert both.dtypes == [("a", "bigint"), ("z", "double"), ("_corrupt_record", "string"),
                           ("b", "string"), ("c", "array<bigint>")]
    rows = [(row.a, row.b, row.c, row["_corrupt_record"]) for row in both.collect()]
    assert rows == [
        (1, "x", None, None),
        (None, None, None, "{broken"),
        (None, "y", [1], '{"a": "bad", "b": "y", "c": [1]}'),
    ]


def _read(spark, tmp_path, lines, declared, **options):
    file = tmp_path / "t.json"
    file.write_text("\n".join(lines) + "\n", encoding="utf-8")
    schema = spark.createDataFrame([], declared).schema
    return read_json_lines(spark, str(file), declared=schema, **options)


KINDS = "stars double, useful bigint, name string"


def test_fields_are_found_whatever_their_case(spark, tmp_path):
    lines = ['{"Stars":5,"Extra":1}', '{"STARS":4,"extra":2}', '{"stars":3.5,"NAME":7}', '{"x y":{"A":[]}}']
    df = _read(spark, tmp_path, lines, KINDS)
    assert df.dtypes == [
        ("stars", "double"), ("useful", "bigint"), ("name", "string"), ("Extra", "bigint"),
        ("x y", "struct<A:array<string>>"),
    ]
    rows = [(row.stars, row.useful, row.name, row.Extra, row["x y"]) for row in df.collect()]
    assert rows == [
        (5.0, None, None, 1, None), (4.0, None, None, 2, None), (3.5, None, "7", None, None),
        (None, None, None, None, ([],)),
    ]
    only = _read(spark, tmp_path, lines, KINDS, others=False)
    assert [tuple(row) for row in only.collect()] == [row[:3] for row in rows]


@pytest.mark.parametrize(
    "line, values",
    [
        ('{"stars":"five","name":"a"}', (None, None, "a")),
        ('{"stars":true}', (None, None, None)),
        ('{"stars":[1]}', (None, None, None)),
        ('{"useful":3.7}', (None, None, None)),
        ('{"useful":"many","stars":1}', (1.0, None, None)),
        ('{"stars":1,"Stars":2}', (1.0, None, None)),
        ('{"Stars":2,"stars":null}', (2.0, None, None)),
        ('{"extra":1,"EXTRA":2}', (None, None, None)),
        ('{"stars":1,"name":"a","name":"a"}', (1.0, None, "a")),
        ("{broken", (None, None, None)),
        ("7", (None, None, None)),
        ('"text"', (None, None, None)),
        ("[]", (None, None, None)),
    ],
)
def test_a_line_that_does_not_fit_keeps_its_text(spark, tmp_path, line, values):
    good = '{"stars":"4.5","useful":2.0,"name":{"a":1}}'
    df = _read(spark, tmp_path, [line, "", " \t", good], KINDS)
    rows = {row["_corrupt_record"]: (row.stars, row.useful, row.name) for row in df.collect()}
    assert rows == {line: values, None: (4.5, 2, '{"a":1}')}


def test_json_arrays_marks_and_odd_names(spark, tmp_path):
    lines = ['\ufeff[{"stars":1},{"stars":2,"it\'s":"é"}]', '{"a`b":null,"n":1.5,"m":1,"m2":1e3}', '{"m":"x"}']
    df = _read(spark, tmp_path, lines, "stars double")
    assert df.dtypes == [
        ("stars", "double"), ("a`b", "string"), ("it's", "string"), ("m", "string"),
        ("m2", "double"), ("n", "double"),
    ]
    rows = sorted(map(tuple, df.collect()), key=repr)
    assert rows == sorted(
        [
            (1.0, None, None, None, None, None), (2.0, None, "é", None, None, None),
            (None, None, None, "1", 1000.0, 1.5), (None, None, None, "x", None, None),
        ],
        key=repr,
    )


def test_json_without_rows(spark, tmp_path):
    df = _read(spark, tmp_path, [""], KINDS)
    assert df.columns == ["stars", "useful", "name"] and df.count() == 0


def test_the_input_is_read_once(spark, tmp_path, plan_of):
    df = _read(spark, tmp_path, ['{"stars":1,"x":2}'], KINDS)
    file = tmp_path / "t.json"
    file.unlink()  # what is returned reads what was parsed, not the input
    assert [(row.stars, row.x) for row in df.collect()] == [(1.0, 2)]


def _failing(df):
    """The rows, and a failure at the end of one task."""
    bad = F.when(F.col("id") == 999, F.raise_error(F.lit("no more")).cast("string"))
    return df.unionByName(df.sparkSession.range(999, 1000).select(
        F.col("id").cast("int").alias("id"), F.coalesce(bad, F.lit("q")).alias("code"),
        F.lit("r").alias("rest")))


WRITERS = {
    "overwrite": lambda df, path, **o: overwrite(df, path, **o),
    "partitioned": lambda df, path, **o: overwrite_partitioned(df, path, "code", **o),
    "merging": lambda df, path, **o: overwrite_merging_schema(df, path, "code", **o),
}


@pytest.mark.parametrize("writer", WRITERS.values(), ids=WRITERS)
def test_a_failed_write_leaves_the_old_table(spark, codes, rows_of, tmp_path, writer):
    path = str(tmp_path / "t")
    writer(codes, path)
    before = rows_of(read_table(spark, path, codes.schema))
    with pytest.raises(Exception, match="no more"):
        writer(_failing(codes), path)
    assert rows_of(read_table(spark, path, codes.schema)) == before
    assert [item.name for item in tmp_path.iterdir()] == ["t"]
    writer(codes.limit(1), path)
    assert read_table(spark, path, codes.schema).count() == 1
    with pytest.raises(Exception, match="no more"):
        writer(_failing(codes), path, in_place=True)
    assert rows_of(spark.read.schema(codes.schema).parquet(path)) != before


@pytest.mark.parametrize("writer", WRITERS.values(), ids=WRITERS)
def test_a_plan_may_read_what_it_replaces(spark, codes, tmp_path, writer):
    path = str(tmp_path / "t")
    writer(codes, path)
    cached = read_table(spark, path, codes.schema).cache()
    assert cached.count() == 4
    writer(read_table(spark, path, codes.schema).where("id > 2"), path)
    assert read_table(spark, path, codes.schema).count() == 2
    assert cached.count() == 2  # what was cached is read again
    cached.unpersist()


def test_an_exchange_that_stopped_half_way_is_mended(spark, codes, tmp_path):
    path = tmp_path / "t"
    overwrite(codes, str(path))
    path.rename(tmp_path / ".t.old")  # stopped after the first rename
    with pytest.raises(Exception, match="no more"):
        overwrite(_failing(codes), str(path))
    assert read_table(spark, str(path)).count() == 4
    (tmp_path / ".t.old").mkdir()  # stopped after the second
    overwrite(codes.limit(3), str(path))
    assert read_table(spark, str(path)).count() == 3
    assert [item.name for item in tmp_path.iterdir()] == ["t"]


def test_a_table_with_rows_is_not_listed_after_the_write(spark, codes, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameReader

    def refuse(*_, **__):
        raise AssertionError("opened")

    for name in ("load", "parquet", "orc", "json", "table"):
        monkeypatch.setattr(DataFrameReader, name, refuse)
    overwrite_partitioned(codes, str(tmp_path / "t"), "code")
    overwrite(codes, str(tmp_path / "u"))
