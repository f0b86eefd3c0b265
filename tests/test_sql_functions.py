"""SQL functions against the column functions of the same name."""

import pytest
from pyspark.sql import functions as F

from trendmill.functions import measures, parsing
from trendmill.functions.sql import FUNCTIONS, register_functions
from trendmill.plans.staging import MOMENTUM_BANDS

TEXTS = ["PT1H2M3S", "P1DT2H", "PT45S", "PT", "PT1.5S", "PT5Mjunk", "P0D", "P1W", "xPT1S", "", None, "PT99999999999S", "P99999DT1S", "12", "12.7", " 5", "x", "2026-01-01T00:00:00Z"]
NUMBERS = [(v, p) for v in (None, 0, 3, -1, 2**63 - 1) for p in (None, 0, 10, -5, 2**62)]


@pytest.mark.parametrize("database", [None, "trendmill_sql"])
def test_same_as_columns(spark, database):
    names = dict(zip(FUNCTIONS, register_functions(spark, database), strict=True))
    texts = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for name, column in [
        ("duration_seconds", parsing.duration_seconds), ("text_to_timestamp", parsing.to_timestamp),
        ("text_to_int", parsing.to_int), ("count_text_to_long", parsing.count_text_to_long),
    ]:
        rows = texts.select(F.expr(f"{names[name]}(t)").alias("a"), column(F.col("t")).alias("b"))
        assert rows.dtypes[0][1] == rows.dtypes[1][1] and all(r.a == r.b for r in rows.collect()), name
    numbers = spark.createDataFrame(NUMBERS, "v bigint, p bigint")
    for name, column in [("safe_ratio", measures.safe_ratio), ("percent_change", measures.percent_change), ("share_of", measures.share)]:
        rows = numbers.select("v", "p", F.expr(f"{names[name]}(v, p)").alias("a"), column(F.col("v"), F.col("p")).alias("b")).collect()
        assert all(r.a == r.b for r in rows), [r for r in rows if r.a != r.b]
    labels = spark.createDataFrame([(x,) for x in (None, 20.0, 20.1, 0.0, -0.0, 0.1, -3.0)], "v double")
    assert all(r.a == r.b for r in labels.select(F.expr(f"{names['momentum_label']}(v)").alias("a"), measures.label_by_threshold(F.col("v"), MOMENTUM_BANDS, (0, "flat"), "declining").alias("b")).collect())
    sizes = spark.createDataFrame([(None,), ([],), (["a", None],)], "a array<string>")
    assert [r[0] for r in sizes.selectExpr(f"{names['array_size_or_zero']}(a)").collect()] == [0, 0, 2]


def test_catalog_functions_outlive_the_session(spark):
    register_functions(spark, "trendmill_sql")
    assert spark.newSession().sql("SELECT trendmill_sql.duration_seconds('PT2M')").first()[0] == 120
    plan = spark.sql("SELECT trendmill_sql.duration_seconds(CAST(id AS STRING)) FROM range(3)")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "WholeStageCodegen" in plan or "*(1)" in plan
