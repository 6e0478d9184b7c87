"""Profiles and rules (the reference's null and duplicate cases, as DataFrames)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from transitlake.operators import (
    RuleViolation,
    duplicate_profile,
    enforce,
    null_profile,
    profile_table,
    rule_report,
)


def nulls(df):
    return {r.column_name: r.null_count for r in null_profile(df).collect()}


def dups(df, keys=None):
    return duplicate_profile(df, keys).first()["duplicate_rows"]


def test_no_nulls(spark):
    assert nulls(spark.createDataFrame([("John", 25), ("Jane", 30)], ["name", "age"])) == {"name": 0, "age": 0}


def test_some_nulls(spark):
    df = spark.createDataFrame([("John", 25), (None, 30), ("Bob", None)], "name string, age bigint")
    assert nulls(df) == {"name": 1, "age": 1}


def test_all_nulls(spark):
    schema = StructType([StructField("name", StringType(), True), StructField("age", IntegerType(), True)])
    assert nulls(spark.createDataFrame([(None, None), (None, None)], schema)) == {"name": 2, "age": 2}


def test_many_columns_one_pass(spark):
    df = spark.createDataFrame([tuple("abcdef")], [f"col{i}" for i in range(1, 7)])
    assert nulls(df) == {f"col{i}": 0 for i in range(1, 7)}


def test_mixed_types(spark):
    df = spark.createDataFrame(
        [("John", 25, "NY"), (None, 30, None), ("Bob", None, None)], "name string, age int, city string"
    )
    assert nulls(df) == {"name": 1, "age": 1, "city": 2}


def test_no_duplicates(spark):
    assert dups(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], ["name", "age"])) == 0


def test_row_three_times(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("b", 2)], ["name", "age"])
    assert dups(df) == 2


def test_all_the_same(spark):
    assert dups(spark.createDataFrame([("a", 1)] * 3, ["name", "age"])) == 2


def test_partial(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("b", 2), ("c", 3)], ["name", "age"])
    assert dups(df) == 2


def test_duplicates_on_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2)], ["name", "age"])
    assert dups(df, ["name"]) == 1


def test_empty_table_profile_is_zero(spark):
    df = spark.createDataFrame([], "a string, b int")
    rows = profile_table(df, "silver", "t").collect()
    assert {r.value for r in rows} == {0}
    assert len(rows) == 3


def test_rule_report_and_enforce(spark):
    df = spark.createDataFrame([(None, 1), (2, -1), (3, None)], "line int, speed int")
    report = rule_report(df, {"line_null": F.col("line").isNull(), "negative": F.col("speed") < 0})
    assert [(r.rule, r.violations) for r in report.collect()] == [("line_null", 1), ("negative", 1)]
    with pytest.raises(RuleViolation, match="line_null"):
        enforce(report)
    assert enforce(report, "warn") == [("line_null", 1), ("negative", 1)]


def test_fingerprint_mode_matches_exact(spark, sf_small):
    from transitlake.sources import adapters

    for df in [
        adapters.gps_raw(spark, sf_small),
        adapters.trips_raw(spark, sf_small),
        spark.createDataFrame([(None, "a"), ("a", None), (None, "a"), (None, None)], "x string, y string"),
    ]:
        exact = duplicate_profile(df).first()
        quick = duplicate_profile(df, fingerprint=True).first()
        assert exact == quick


def test_fingerprint_separates_null_positions(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert duplicate_profile(df, fingerprint=True).first().duplicate_rows == 0


def test_stored_profiles_read_new_and_changed_partitions_alone(spark):
    from transitlake.plans import profiles
    from transitlake.sources.lake import Lake

    lake = Lake.on_shared_storage(spark)
    schema = "v int, w string, x double, day string"

    def write(rows, **kwargs):
        lake.write(spark.createDataFrame(rows, schema), "silver", "t", ["day"], **kwargs)

    def merged():
        return {r.column_name: (r.rows, r.nulls, r.distinct_estimate) for r in profiles.merged_profile(spark, lake, "silver", "t", "day").collect()}

    write([(1, "a", 0.5, "d1"), (2, None, 0.5, "d1"), (2, "b", None, "d2"), (None, "b", 1.5, None)])
    assert profiles.update_profile(spark, lake, "silver", "t", "day") == 3
    assert merged() == {"v": (4, 1, 2), "w": (4, 1, 2), "x": (4, 1, 2)}
    assert profiles.update_profile(spark, lake, "silver", "t", "day") == 0
    # a new day and a rewritten one: two partitions are read, and the old state of the rewritten one no longer counts
    write([(7, "c", 0.1, "d2"), (8, "d", 0.2, "d2"), (9, None, 0.3, "d3")])
    assert profiles.update_profile(spark, lake, "silver", "t", "day") == 2
    assert merged() == {"v": (6, 1, 5), "w": (6, 2, 4), "x": (6, 0, 5)}
