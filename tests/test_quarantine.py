"""Lines that are no sound record: set aside, counted, replayed."""

import json

from pyspark.sql import functions as F

from trendmill.plans.silver import silver_videos
from trendmill.sources import bronze, quarantine
from test_quality import GOOD


def landed(tmp_path, **files):
    for name, lines in files.items():
        (tmp_path / f"{name}.json").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


LINES = {
    "one": [json.dumps(GOOD), "not json", json.dumps(GOOD | {"view_count": "abc"}), "", "   "],
    "two": [json.dumps(GOOD | {"video_id": None}), '{"video_id": "w"', "[1, 2]", "7", "{}", json.dumps(GOOD | {"video_id": "w"})],
}


def test_reasons_and_counts(spark, tmp_path):
    lines = quarantine.read_lines(spark, landed(tmp_path, **LINES))
    name = F.regexp_extract("file", r"(\w+)\.json", 1).alias("name")
    seen = {r["name"]: tuple(r)[1:] for r in quarantine.line_counts(lines, name).collect()}
    assert seen == {"one": (3, 1, 1, 1, 0), "two": (6, 1, 3, 0, 2)}
    aside = quarantine.quarantined(lines)
    assert aside.columns == quarantine.QUARANTINE and aside.count() == 7
    assert "not json" in {r.line for r in aside.filter("reason = 'not_json'").collect()}


def test_records_are_those_of_the_plain_scan(spark, tmp_path):
    path = landed(tmp_path, **LINES)
    plain = bronze.read_bronze(spark, path).filter("video_id IS NOT NULL AND region IS NOT NULL")
    own = quarantine.records(quarantine.read_lines(spark, path)).filter("video_id IS NOT NULL AND region IS NOT NULL")
    assert own.exceptAll(plain).isEmpty() and plain.exceptAll(own).isEmpty()
    assert own.count() == 3


def test_replayed_lines_reach_silver(spark, tmp_path):
    wrong = json.dumps(GOOD | {"view_count": "12 views"})
    stray = "# " + json.dumps(GOOD | {"video_id": "w", "view_count": 7})
    lines = quarantine.read_lines(spark, landed(tmp_path, one=[wrong, stray, "hopeless"]))
    store = str(tmp_path / "aside")
    quarantine.write_quarantine(lines, store)
    again = quarantine.replayed(
        quarantine.read_quarantine(spark, store), F.regexp_replace(F.regexp_replace("line", "^# ", ""), r'"(\d+) views"', "$1")
    )
    assert [r.line for r in quarantine.quarantined(again).collect()] == ["hopeless"]
    before = silver_videos(quarantine.records(lines)).select("video_id", "view_count").collect()
    assert [tuple(r) for r in before] == [("v", None)]
    silver = silver_videos(quarantine.records(lines).unionByName(quarantine.records(again)))
    assert sorted(tuple(r) for r in silver.select("video_id", "view_count").collect()) == [("v", 12), ("w", 7)]


def test_no_lines(spark, tmp_path):
    lines = quarantine.read_lines(spark, landed(tmp_path, one=[""]))
    assert lines.count() == 0 and quarantine.records(lines).count() == 0
