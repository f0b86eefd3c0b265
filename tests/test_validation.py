"""Validation day by day against validation of all records at once."""

import pytest

from trendmill.operators.quality import expect_not_null
from trendmill.plans import daily
from trendmill.plans.checks import validate_bronze
from trendmill.plans.validation import CountStore, NoCounts, day_counts, results_with, store_counts
from trendmill.schemas import GOLD
from trendmill.session import stage
from trendmill.sources.bronze import land
from test_layers import at
from test_quality import records


def verdicts(df):
    return list(map(str, df.collect()))


def day(number, n=4):
    """Some records of a day: keys shared with other days, a NULL, a bad duration."""
    rows = [at(number, video_id=f"v{i}", view_count=i - 1) for i in range(n)]
    return [*rows, at(number, video_id=f"only{number}"), at(number, channel_id=None), at(number, duration="x")]


def test_days_added_one_by_one_equal_all_at_once(spark, tmp_path):
    store, seen = CountStore(str(tmp_path)), []
    for number in (1, 2, 3):
        seen += day(number)
        stamp = None if number == 1 else f"2026-01-0{number}"
        counts = stage(day_counts(records(spark, *day(number))), "counts")
        assert verdicts(results_with(counts, store, stamp)) == verdicts(validate_bronze(records(spark, *seen)))
        store_counts(counts, store, stamp)
    assert len(list(tmp_path.glob("*/snapshot_date=*"))) == 3


def test_a_replaced_day_and_records_without_a_day(spark, tmp_path):
    store = CountStore(str(tmp_path))
    lost = [{"ingested_at": "bad"}, {"ingested_at": None}]
    store_counts(day_counts(records(spark, *day(1), *day(2, 2), *lost)), store)
    again = stage(day_counts(records(spark, *day(2, 9))), "counts")
    wanted = verdicts(validate_bronze(records(spark, *day(1), *day(2, 9), *lost)))
    for _ in range(2):  # once more changes nothing
        assert verdicts(results_with(again, store, "2026-01-02")) == wanted
        store_counts(again, store, "2026-01-02")
    empty = day_counts(records(spark, {}).limit(0))
    assert verdicts(results_with(empty, store, "2026-01-02")) == verdicts(validate_bronze(records(spark, *day(1), *lost)))
    store_counts(empty, store, "2026-01-02")
    assert len(list(tmp_path.glob("*/snapshot_date=*"))) == 2


def test_counts_of_other_expectations_are_not_used(spark, tmp_path):
    store = CountStore(str(tmp_path))
    counts = day_counts(records(spark, *day(1)))
    store_counts(counts, store)
    with pytest.raises(NoCounts):
        results_with(counts, store, "2026-01-01", [expect_not_null("other", "title")])


def test_a_day_run_is_judged_with_its_history(spark, tmp_path):
    lake = daily.Lake(str(tmp_path / "lake"))
    begin = [at(1, video_id=f"v{i}") for i in range(40)]
    land(records(spark, *begin, at(2, video_id="v0", view_count=70)), str(tmp_path / "first"))
    land(records(spark, *[at(3, video_id=f"v{i}") for i in range(40)]), str(tmp_path / "later"))
    later = {"bronze_path": str(tmp_path / "later"), "day": "2026-01-03", "keep_counts": True}
    assert daily.run_daily(spark, str(tmp_path / "first"), lake, keep_counts=True).warnings == []
    assert daily.run_daily(spark, lake=lake, **later).warnings == ["video_region_key_mostly_unique"]
    assert daily.run_daily(spark, lake=lake, **later | {"keep_counts": False}).warnings == []
    with pytest.raises(NoCounts):
        daily.run_daily(spark, lake=daily.Lake(str(tmp_path / "other")), **later)
    assert set(daily.read_gold(spark, lake)) == set(GOLD)
