"""Table operators: name normalisation (the reference's five cases and more),
projection, dropping, keyed de-duplication."""

import pytest
from pyspark.sql import functions as F

from transitlake.operators import dedup_by_key, drop_columns, normalize_names, project, stamp_ingestion


def test_names_lower_cased(spark):
    df = spark.createDataFrame([("John", 25), ("Jane", 30)], ["NAME", "AGE"])
    out = normalize_names(df)
    assert "name" in out.columns and "age" in out.columns
    assert "NAME" not in out.columns and "AGE" not in out.columns


def test_names_stripped(spark):
    out = normalize_names(spark.createDataFrame([("John", 25)], ["  Name  ", " Age "]))
    assert out.columns == ["name", "age"]


def test_inner_spaces(spark):
    out = normalize_names(spark.createDataFrame([("John", 25, "New York")], ["First Name", "Age", "City Name"]))
    assert out.columns == ["first_name", "age", "city_name"]


def test_combined(spark):
    out = normalize_names(spark.createDataFrame([("John", 25)], ["  First NAME  ", " LAST name "]))
    assert out.columns == ["first_name", "last_name"]


def test_data_preserved(spark):
    rows = normalize_names(spark.createDataFrame([("John", 25), ("Jane", 30)], ["NAME", "AGE"])).collect()
    assert len(rows) == 2
    assert rows[0]["name"] == "John" and rows[0]["age"] == 25


def test_accents_kept_unless_asked(spark):
    df = spark.createDataFrame([("x",)], ["SAÍDA"])
    assert normalize_names(df).columns == ["saída"]
    assert normalize_names(df, strip_accents=True).columns == ["saida"]


def test_dotted_name(spark):
    assert normalize_names(spark.createDataFrame([("x",)], ["A.B"])).columns == ["a.b"]


def test_collision_raises(spark):
    df = spark.createDataFrame([("x", "y")], ["A", "a "])
    with pytest.raises(ValueError, match="normalise"):
        normalize_names(df)


def test_blank_name_dropped(spark):
    df = normalize_names(spark.createDataFrame([("x", "y")], ["keep", " "]))
    assert df.columns == ["keep", ""]
    assert drop_columns(df, ["absent"]).columns == ["keep"]


def test_project_orders_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"])
    assert project(df, ["c", "a"]).columns == ["c", "a"]


def test_dedup_keeps_smallest_survivor(spark):
    df = spark.createDataFrame([(1, 7, "b"), (1, 6, "z"), (2, None, "a"), (2, 5, "a")], "k int, v int, w string")
    out = {r.k: (r.v, r.w) for r in dedup_by_key(df, ["k"]).collect()}
    assert out == {1: (6, "z"), 2: (None, "a")}


def test_dedup_null_key_is_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "k int, v int")
    assert dedup_by_key(df, ["k"]).collect() == [(None, 1)]


def test_dedup_is_idempotent(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(30)], "k int, v int")
    once = dedup_by_key(df, ["k"])
    assert sorted(once.collect()) == sorted(dedup_by_key(once, ["k"]).collect())


def test_dedup_keeps_column_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, k int, b int")
    assert dedup_by_key(df, ["k"]).columns == ["a", "k", "b"]


def test_dedup_plan_combines_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedup_by_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_stamp_ingestion(spark):
    out = stamp_ingestion(spark.createDataFrame([("x",)], "value string"), "gps")
    row = out.first()
    assert row["_source_file"] == "gps" and row["_ingestion_timestamp"] is not None
