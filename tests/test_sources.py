import json

import pytest
from pyspark.sql import functions as F

from trendmill.plans.silver import silver_videos
from trendmill.schemas import BRONZE, SILVER, SILVER_PARTITIONS
from trendmill.operators.lookup import literal_dimension
from trendmill.session import scratch_root, stage
from trendmill.sources import bronze, tables
from test_quality import GOOD, records

ITEM = {
    "id": "a",
    "snippet": {"channelId": "c", "title": "t", "description": "d" * 600, "tags": ["x"], "categoryId": "10"},
    "statistics": {"viewCount": "12", "likeCount": "", "commentCount": "many"},
    "contentDetails": {"duration": "PT1M"},
}


def payloads(spark, *texts):
    rows = [(f"R{i}", "2026-01-01T00:00:00Z", text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "region string, ingested_at string, payload string")


def test_flatten(spark):
    bare = {"id": "b", "snippet": {}}
    decoded = bronze.decode_payload(payloads(spark, json.dumps({"items": [ITEM, bare]})))
    flat = bronze.flatten_payload(decoded)
    assert [f.simpleString() for f in flat.schema] == [
        f.simpleString() for f in spark.createDataFrame([], BRONZE).schema
    ]
    first, second = flat.orderBy("video_id").collect()
    assert (first.description, first.view_count, first.like_count, first.comment_count) == ("d" * 500, 12, 0, 0)
    assert (second.description, second.tags, second.view_count, second.title) == ("", [], 0, None)


def test_ingest_summary(spark):
    good = json.dumps({"items": [ITEM | {"statistics": {}}]})
    decoded = bronze.decode_payload(payloads(spark, good, json.dumps({"items": [ITEM]}), '{"items": [', "{}", None))
    seen = {r.region: tuple(r)[1:] for r in bronze.ingest_summary(decoded).collect()}
    assert seen == {
        "R0": (1, 0, 0, "SUCCESS"),
        "R1": (1, 0, 1, "PARTIAL"),
        "R2": (0, 1, 0, "PARTIAL"),
        "R3": (0, 0, 0, "SUCCESS"),
        "R4": (0, 1, 0, "PARTIAL"),
    }
    assert bronze.flatten_payload(decoded).count() == 2


def test_malformed_lines(spark, tmp_path):
    wrong_type = json.dumps(GOOD | {"view_count": "abc"})
    (tmp_path / "part.json").write_text("\n".join([json.dumps(GOOD), "not json", wrong_type]) + "\n")
    rows = bronze.read_bronze(spark, str(tmp_path)).collect()
    assert [r.view_count for r in rows if r.video_id] == [1, None]
    assert sum(r.video_id is None for r in rows) == 1


def test_landing_folders(spark, tmp_path):
    for hour in ("01", "02"):
        bronze.land(records(spark, {}), str(tmp_path / "2026/01/01" / hour))
    assert bronze.read_bronze(spark, bronze.landing_glob(f"{tmp_path}/2026/")).count() == 2
    both = [f"{tmp_path}/2026/01/01/01", f"{tmp_path}/2026/01/01/02"]
    assert bronze.read_bronze(spark, both).count() == 2


def test_empty_input_is_refused(spark):
    with pytest.raises(bronze.EmptyInput, match="silver"):
        bronze.require_input(spark.createDataFrame([], BRONZE), "silver")


def test_write_counts_and_types(spark, tmp_path):
    path = str(tmp_path / "silver")
    silver = silver_videos(records(spark, {}, {"region": "GB"}, {"published_at": "2025-12-01T00:00:00Z"}))
    assert tables.write_table(silver, path, SILVER_PARTITIONS, ["ingested_at"]) == 3
    back = tables.read_table(spark, path, SILVER)
    assert sorted(back.dtypes) == sorted(silver.dtypes)
    stamp = "_silver_processed_at"
    names = [c for c in silver.columns if c != stamp]
    assert back.select(names).exceptAll(silver.select(names)).isEmpty()
    pruned = back.filter("region = 'GB'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in pruned


def test_second_write_replaces_all_or_some(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("a", 1), ("b", 1)], "p string, v int")
    new = spark.createDataFrame([("a", 2)], "p string, v int")
    tables.write_table(old, path, ["p"])
    tables.write_table(new, path, ["p"], dynamic=True)
    assert sorted((r.p, r.v) for r in spark.read.parquet(path).collect()) == [("a", 2), ("b", 1)]
    wider = new.withColumn("w", F.lit(1))
    assert tables.write_table(wider, path, ["p"]) == 1
    assert [sorted(r.asDict()) for r in spark.read.parquet(path).collect()] == [["p", "v", "w"]]


def test_files_are_sorted(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(500).select(F.pmod(F.col("id"), F.lit(3)).alias("p"), F.xxhash64("id").alias("v"))
    tables.write_table(df, path, ["p"], ["v"])
    back = spark.read.parquet(path).select("p", "v", F.input_file_name().alias("f")).collect()
    for name in {r.f for r in back}:
        values = [r.v for r in back if r.f == name]
        assert values == sorted(values)


def test_registration(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", [1, 2]), ("b", None)], "p string, v array<int>")
    tables.write_table(df, path, ["p"])
    schema = "p string, v array<int>"
    for _ in range(2):
        tables.register_table(spark, "trendmill_test.t", path, schema, ["p"])
        seen = tables.read_catalog(spark, "trendmill_test.t")
        assert (seen.count(), dict(seen.dtypes)["v"]) == (2, "array<int>")
    spark.sql("ALTER TABLE trendmill_test.t SET TBLPROPERTIES ('kept' = 'yes')")
    changed = spark.createDataFrame([("b", [3]), ("c", [4])], schema)
    tables.replace_partitions(changed, path, ["p"], [{"p": "a"}, {"p": "b"}])
    tables.register_table(spark, "trendmill_test.t", path, schema, ["p"])
    assert sorted(r.p for r in spark.table("trendmill_test.t").collect()) == ["b", "c"]
    assert [r.value for r in spark.sql("SHOW TBLPROPERTIES trendmill_test.t ('kept')").collect()] == ["yes"]
    spark.sql("DROP DATABASE trendmill_test CASCADE")
    assert spark.read.parquet(path).count() == 2


def test_names_of_a_dimension_are_literals(spark):
    names = {1: "Rock 'n' Roll", 2: 'say "x"'}
    rows = literal_dimension(spark, names, "k", "v").collect()
    assert {r.k: r.v for r in rows} == names


def test_database_names():
    assert tables.database_for(None, "main") == "main"
    assert tables.database_for(" marts ", "main") == "marts"


def test_view(spark):
    tables.register_view(spark.range(3), "three")
    assert spark.sql("SELECT count(*) FROM three").first()[0] == 3


def test_stage_uses_the_shared_folder(spark):
    staged = stage(spark.range(5), "numbers")
    assert staged.count() == 5
    assert all(scratch_root(spark) in f for f in staged.inputFiles())


def test_answers_are_parsed_once(spark):
    flat = bronze.flatten_payload(bronze.decode_payload(payloads(spark, "{}")))
    assert flat._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1


def test_large_partition_is_written_by_several_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64KB")
    try:
        df = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "small").otherwise("hot").alias("p"), F.xxhash64("id").alias("v")
        )
        assert tables.write_table(df, str(tmp_path / "t"), ["p"], ["v"]) == 200_000
    finally:
        spark.conf.unset(size)
    assert len(list((tmp_path / "t" / "p=hot").glob("*.parquet"))) > 1
