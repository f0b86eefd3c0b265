import json

import pytest
from pyspark.sql import functions as F

from trendmill.operators import quality, tabletests
from trendmill.plans import checks
from trendmill.schemas import BRONZE, SOURCE

GOOD = {
    "video_id": "v", "channel_id": "c", "region": "US", "title": "t", "description": "d",
    "channel_title": "ct", "category_id": "10", "tags": ["x"], "duration": "PT1M",
    "default_language": "en", "published_at": "2026-01-01T00:00:00Z",
    "ingested_at": "2026-01-02T00:00:00.123456+00:00", "view_count": 1, "like_count": 1,
    "comment_count": 1, "source": SOURCE, "pipeline_version": "1.0",
}

BAD = {
    "video_id_not_null": ("video_id", None),
    "region_not_null": ("region", None),
    "ingested_at_not_null": ("ingested_at", None),
    "view_count_not_null": ("view_count", None),
    "channel_id_not_null": ("channel_id", None),
    "region_in_expected_set": ("region", "FR"),
    "view_count_non_negative": ("view_count", -1),
    "like_count_non_negative": ("like_count", -1),
    "comment_count_non_negative": ("comment_count", -1),
    f"source_is_{SOURCE}": ("source", "other"),
    "published_at_iso8601_format": ("published_at", "2026-01-01T00:00:00"),
    "ingested_at_iso8601_format": ("ingested_at", "2026-01-02 00:00:00"),
    "duration_iso8601_format": ("duration", "P1DT2H"),
}


def records(spark, *changes):
    rows = [GOOD | {"video_id": f"v{i}"} | change for i, change in enumerate(changes)]
    return spark.createDataFrame(rows, BRONZE)


def verdicts(df):
    return {row.expectation: row for row in checks.validate_bronze(df).collect()}


def test_all_pass_on_good_records(spark):
    seen = verdicts(records(spark, {}, {}))
    assert len(seen) == 15
    assert all(row.success for row in seen.values())
    assert [name for name, row in seen.items() if not row.critical] == ["video_region_key_mostly_unique"]


@pytest.mark.parametrize("name", BAD)
def test_each_check_fails_alone(spark, name):
    column, value = BAD[name]
    seen = verdicts(records(spark, {}, {column: value}))
    failed = [check for check, row in seen.items() if not row.success]
    assert failed == [name]
    assert seen[name].unexpected_count == 1


def test_nulls_pass_value_checks(spark):
    nulls = {column: None for column in GOOD if column != "video_id"}
    seen = verdicts(records(spark, nulls, nulls))
    failed = {name for name, row in seen.items() if not row.success}
    assert failed == {"region_not_null", "ingested_at_not_null", "view_count_not_null", "channel_id_not_null"}
    assert seen["duration_iso8601_format"].missing_count == 2


def test_threshold_is_inclusive(spark):
    exact = verdicts(records(spark, *[{}] * 19, {"duration": "x"}))
    below = verdicts(records(spark, *[{}] * 18, {"duration": "x"}, {"duration": None}))
    assert exact["duration_iso8601_format"].success
    assert not below["duration_iso8601_format"].success


def test_duplicates_fail_all_members(spark):
    same = {"video_id": "same"}
    seen = verdicts(records(spark, same, same, {}))["video_region_key_mostly_unique"]
    assert (seen.unexpected_count, seen.success, seen.critical) == (2, False, False)


def test_empty_input(spark):
    seen = verdicts(spark.createDataFrame([], BRONZE))
    assert [name for name, row in seen.items() if not row.success] == ["dataset_not_empty"]


def test_gate(spark):
    bad = checks.validate_bronze(records(spark, {"region": "FR"}))
    with pytest.raises(quality.ExpectationsFailed, match="region_in_expected_set"):
        checks.gate(bad)
    assert checks.gate(bad, fail_on_error=False) == []
    same = {"video_id": "same"}
    warned = checks.validate_bronze(records(spark, same, same))
    assert checks.gate(warned) == ["video_region_key_mostly_unique"]


def test_report(spark, tmp_path):
    results = checks.fixed_results(checks.validate_bronze(records(spark, {}, {"region": "FR"})))
    checks.write_report(checks.report_document(results, "in", "stamp"), str(tmp_path / "report"))
    report = json.loads(checks.read_report(spark, str(tmp_path / "report")).first()[0])
    assert (report["total_expectations"], report["passed"]) == (15, 14)
    assert (report["critical_failures"], report["warning_failures"]) == (1, 0)
    assert (report["overall_success"], report["bronze_path"], report["run_timestamp"]) == (False, "in", "stamp")
    regions = next(r for r in report["results"] if r["expectation"] == "region_in_expected_set")
    assert (regions["success"], regions["critical"], regions["result"]["unexpected_percent"]) == (False, True, 50.0)
    assert [r["expectation"] for r in report["results"]] == [e.name for e in checks.bronze_expectations()]


def test_violations(spark):
    df = records(spark, {}, {"region": "FR"})
    declared = {e.name: e for e in checks.bronze_expectations()}
    assert [r.region for r in quality.violations(df, declared["region_in_expected_set"]).collect()] == ["FR"]
    with pytest.raises(ValueError):
        quality.violations(df, declared["dataset_not_empty"])


def test_bronze_is_read_once(spark):
    plan = checks.validate_bronze(records(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_key_skips_null_parts(spark):
    df = records(spark, {"region": None}, {"video_id": None})
    assert [r[0] for r in df.select(checks.video_region_key()).collect()] == ["v0", "US"]


def test_table_tests(spark):
    df = spark.createDataFrame([(None, "a"), (1, "x"), (2, "x"), (3, None)], "id int, label string")
    seen = tabletests.run_table_tests({"t": df}, {"t": ["id"]}, {("t", "label"): ["a"], ("other", "label"): ["a"]})
    rows = {(r.test, r.column_name): (r.failures, r.should_error) for r in seen.collect()}
    assert rows == {("not_null", "id"): (1, True), ("accepted_values", "label"): (1, True)}


def watched_tests(spark, df, not_null, accepted, work):
    seen, own = tabletests.watched(df, "t", not_null, accepted)
    work(seen)
    return tabletests.observed_tests(spark, [own], {"t": df})


@pytest.mark.parametrize("rows", [[(None, "a"), (1, "x"), (2, "x"), (3, None)], [(1, "a"), (2, None)], []])
@pytest.mark.parametrize("work", [
    lambda df: df.write.format("noop").mode("overwrite").save(),
    lambda df: df.groupBy("label").count().collect(),
    lambda df: df.orderBy("id").collect(),
    lambda df: df.join(df.groupBy("label").count(), "label").collect(),
])
def test_tests_that_are_counted_meanwhile(spark, rows, work):
    """The same verdicts, whatever reads the rows; a sort reads them twice, and a join with itself as well."""
    df = spark.createDataFrame(rows, "id int, label string")
    not_null, accepted = {"t": ["id"], "other": ["id"]}, {("t", "label"): ["a"], ("other", "label"): ["a"]}
    expected = tabletests.run_table_tests({"t": df}, not_null, accepted).collect()
    assert sorted(watched_tests(spark, df, not_null, accepted, work).collect()) == sorted(expected)


def test_only_failed_tests_are_read_again(spark, tmp_path):
    spark.createDataFrame([(1, None, "a"), (2, 5, "b")], "id int, other int, label string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")

    def plan(columns, values):
        seen = watched_tests(spark, df, {"t": columns}, {("t", "label"): values}, lambda x: x.write.parquet(f"{tmp_path}/{len(values)}"))
        return seen._jdf.queryExecution().executedPlan().toString()

    assert "FileScan" not in plan(["id"], ["a", "b"])
    again = plan(["id", "other"], ["a", "b", "c"])
    assert again.count("FileScan") == 1 and "ReadSchema: struct<other:int>" in again


def test_filters_stay_above_what_is_watched(spark, tmp_path):
    spark.range(10).selectExpr("if(id = 9, null, id) AS id", "id AS b", "id AS c").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    seen, own = tabletests.watched(df, "t", {"t": ["id"]}, {})
    few = seen.filter("b < 2").select("b")
    assert "ReadSchema: struct<id:bigint,b:bigint>" in few._jdf.queryExecution().executedPlan().toString()
    assert few.count() == 2
    assert [r.failures for r in tabletests.observed_tests(spark, [own], {"t": df}).collect()] == [1]


def test_row_gate_by_counts():
    tabletests.require_counts({"full": 1})
    with pytest.raises(tabletests.EmptyTables, match="2 table.*first, second"):
        tabletests.require_counts({"first": 0, "full": 1, "second": 0})


def test_row_gate_names_every_empty_table(spark):
    full, empty = spark.range(1), spark.range(0)
    tabletests.require_rows({"full": full})
    with pytest.raises(tabletests.EmptyTables, match="2 table.*first, second"):
        tabletests.require_rows({"first": empty, "full": full, "second": empty})


def test_declared_tests_number_47():
    assert sum(map(len, checks.NOT_NULL.values())) + len(checks.ACCEPTED) == 47


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert [tuple(r) for r in quality.duplicate_keys(df, F.col("k")).collect()] == [("a", 2)]


def test_several_uniqueness_checks(spark):
    df = records(spark, {}, {"video_id": "v0"}, {"region": None})
    by_video = quality.expect_unique("by_video", F.col("video_id"))
    by_region = quality.expect_unique("by_region", F.col("region"))
    not_null = quality.expect_not_null("region_not_null", "region")
    seen = {r.expectation: r for r in quality.validate(df, [by_video, not_null, by_region]).collect()}
    assert seen["by_video"].unexpected_count == 2 and seen["by_region"].unexpected_count == 2
    assert seen["region_not_null"].unexpected_count == 1
    assert {r.element_count for r in seen.values()} == {3}


def test_only_key_mask_and_count_are_shuffled(spark):
    plan = checks.validate_bronze(records(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    first = plan[plan.rindex("Exchange hashpartitioning") :].splitlines()
    below = next(line for line in first[1:] if "HashAggregate" in line)
    assert "partial_count(1)" in below and below.count("partial_") == 1
