import pytest
from pyspark.sql import functions as F

from trendmill.functions import measures, parsing


def one_column(spark, values, kind, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row[1] for row in df.select("i", function(F.col("x"))).orderBy("i").collect()]


DURATIONS = {
    "PT1H2M3S": 3723,
    "P1DT2H": 93600,
    "PT45S": 45,
    "PT": 0,
    "PT1.5S": 0,
    "PT5Mjunk": 300,
    "P0D": None,
    "P1W": None,
    "xPT1S": None,
    "": None,
    None: None,
    "PT99999999999999999999S": None,
    "P99999DT1S": None,
}


def test_duration_seconds(spark):
    assert one_column(spark, list(DURATIONS), "string", parsing.duration_seconds) == list(DURATIONS.values())


def test_text_to_timestamp(spark):
    texts = ["2026-04-05T14:22:35Z", "2026-04-05T14:22:35.544117+00:00", "2026-04-05T16:22:35+02:00", "bad", "", None]
    seen = one_column(spark, texts, "string", lambda c: parsing.to_timestamp(c).cast("string"))
    assert seen == ["2026-04-05 14:22:35", "2026-04-05 14:22:35.544117", "2026-04-05 14:22:35", None, None, None]


def test_text_to_int(spark):
    texts = ["10", " 7 ", "10.9", "n/a", "", None, "99999999999"]
    assert one_column(spark, texts, "string", parsing.to_int) == [10, 7, 10, None, None, None, None]


def test_counts_given_as_text(spark):
    texts = ["12", "", None, "many"]
    assert one_column(spark, texts, "string", parsing.count_text_to_long) == [12, 0, 0, 0]
    assert one_column(spark, texts, "string", parsing.is_bad_count) == [False, False, False, True]


def test_truncation_counts_characters(spark):
    seen = one_column(spark, ["é" * 600, "short", None], "string", lambda c: parsing.truncated(c, 500))
    assert seen == ["é" * 500, "short", ""]


def test_arrays(spark):
    arrays = [["a", "b"], [], None]
    assert one_column(spark, arrays, "array<string>", measures.array_size) == [2, 0, 0]
    assert one_column(spark, arrays, "array<string>", parsing.array_or_empty) == [["a", "b"], [], []]


@pytest.mark.parametrize(
    "likes, views, ratio",
    [(3, 10, 0.3), (None, 10, None), (3, 0, 0.0), (3, -1, 0.0), (3, None, 0.0), (None, None, 0.0), (None, 0, 0.0)],
)
def test_safe_ratio(spark, likes, views, ratio):
    df = spark.createDataFrame([(likes, views)], "likes bigint, views bigint")
    assert df.select(measures.safe_ratio(F.col("likes"), F.col("views"))).first()[0] == ratio


@pytest.mark.parametrize(
    "now, before, pct", [(121, 100, 21.0), (100, 0, None), (100, None, None), (50, 100, -50.0), (None, 100, None)]
)
def test_percent_change(spark, now, before, pct):
    df = spark.createDataFrame([(now, before)], "now bigint, before bigint")
    assert df.select(measures.percent_change(F.col("now"), F.col("before"))).first()[0] == pct


def test_share_is_computed_in_double(spark):
    df = spark.createDataFrame([(5, 9), (5, 0), (5, None)], "a bigint, b bigint")
    seen = df.select(measures.percent(measures.share(F.col("a"), F.col("b")), 2)).collect()
    assert [row[0] for row in seen] == [55.56, None, None]


def test_rounding_is_half_up_on_the_decimal_rendering(spark):
    values = [0.005, 1.005, 2.5, -2.5]
    assert one_column(spark, values, "double", lambda c: F.round(c, 2)) == [0.01, 1.01, 2.5, -2.5]
    assert one_column(spark, values, "double", lambda c: F.round(c, 0)) == [0.0, 1.0, 3.0, -3.0]


def test_labels(spark):
    from trendmill.plans.staging import MOMENTUM_BANDS

    def label(c):
        return measures.label_by_threshold(c, MOMENTUM_BANDS, (0, "flat"), "declining")

    values = [20.0, 21.0, 0.0, -1.0, None, 0.5]
    expected = ["growing", "accelerating", "flat", "declining", None, "growing"]
    assert one_column(spark, values, "double", label) == expected


def test_overflow_does_not_fail_the_job(spark):
    largest = 2**63 - 1
    df = spark.createDataFrame([(largest, -largest)], "now bigint, before bigint")
    assert df.select(measures.percent_change(F.col("now"), F.col("before"))).first()[0] is None
