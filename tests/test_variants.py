"""Answers as VARIANT values against the fixed struct, and answers whose fields have changed."""

import json

from trendmill.sources.bronze import decode_payload, flatten_payload
from trendmill.sources.variants import decode_variant, flatten_variant, item_schemas


def answers(spark, *payloads):
    rows = [("US", "2026-01-01T00:00:00Z", p if p is None or isinstance(p, str) else json.dumps(p)) for p in payloads]
    return spark.createDataFrame(rows, "region STRING, ingested_at STRING, payload STRING")


def item(video, **snippet):
    return {"id": video, "snippet": {"title": "t", **snippet}, "statistics": {"viewCount": "5"}, "contentDetails": {"duration": "PT1M"}}


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_equals_the_fixed_struct(spark):
    given = answers(
        spark, {"items": [item("a", tags=["x", "y"], description="d" * 900), item("b"), None, {}]},
        {"items": []}, {"items": None}, {}, '{"items": [{"id"', "", None,
    )
    assert rows_of(flatten_variant(decode_variant(given))) == rows_of(flatten_payload(decode_payload(given)))
    plain = [(r.readable, r.region) for r in decode_variant(given).collect()]
    assert [readable for readable, _ in plain] == [True, True, True, True, False, False, False]


def test_retyped_and_unknown_fields_keep_their_rows(spark):
    changed = item("a", tags="none", categoryId=10, new={"k": 1}) | {"statistics": {"viewCount": 7, "likeCount": {"no": 1}}}
    decoded = decode_variant(answers(spark, {"items": [changed, item("b"), "text"]}))
    rows = {row.video_id: row for row in flatten_variant(decoded).collect()}
    assert set(rows) == {"a", "b", None}
    assert (rows["a"].view_count, rows["a"].category_id, rows["a"].tags, rows["b"].view_count) == (7, "10", [], 5)
    assert rows["a"].like_count == 0


def test_schema_of_a_region_shows_what_is_new(spark):
    decoded = decode_variant(answers(spark, {"items": [item("a", new=1), item("b")]}))
    [row] = item_schemas(decoded).collect()
    assert "new: BIGINT" in row.item_schema and "title: STRING" in row.item_schema


def test_no_answers(spark):
    decoded = decode_variant(answers(spark))
    assert flatten_variant(decoded).count() == 0 and item_schemas(decoded).count() == 0
