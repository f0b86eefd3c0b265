
from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from trendmill.functions.parsing import duration_seconds as seconds_of
from trendmill.functions.parsing import to_timestamp
from trendmill.functions.sql import register_functions
from trendmill.operators.aggregates import distinct_values
from trendmill.operators.aggregates import loss_accounting as losses
from trendmill.operators.quality import SUMMARY, all_violations, duplicate_keys, summarize
from trendmill.operators.scale import largest_group, numbered
from trendmill.operators.tabletests import row_counts, run_table_tests, value_histogram
from trendmill.plans import checks, daily, gold, marts, staging
from trendmill.plans.silver import ENTITY, SNAPSHOT, latest_records
from trendmill.plans.silver import silver_videos as build_silver
from trendmill.plans.validation import CountStore, day_counts, results_with, store_counts
from trendmill.schemas import BRONZE_COLUMNS, GOLD, GOLD_PARTITIONS, SILVER, SILVER_PARTITIONS
from trendmill.session import configure, scratch_path, stage
from trendmill.sources import bronze as raw
from trendmill.sources import quarantine, variants
from trendmill.sources.buckets import Bucketed, buckets_for, read_bucketed, write_bucketed
from trendmill.sources.events import bronze_from_events, payloads_from_events, read_events
from trendmill.sources.tables import read_catalog, read_table, register_table, write_table
from trendmill.sources.versions import VersionedTable, publish, read_version, write_version
from trendmill.streaming.arrivals import arrival_counts, wait_for_arrivals
from trendmill.streaming.feed import Feed, feed_silver, start_feed, stream_bronze

try:
    import corpus_pipeline
    import trendmill.llm.queries as llm
except ModuleNotFoundError as error:  # the folder of these operators may be taken away
    if not str(error.name).startswith(("trendmill.llm", "corpus_pipeline")):
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Types both engines render alike: text for dates and times, bigint for integers.

    Processing times are left out, arrays are joined, and averages of doubles, whose last digits
    depend on the order of summation, are rounded.
    """
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if name.endswith("_processed_at"):
            continue
        if kind == "date":
            column = column.cast("string")
        elif kind == "timestamp":
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
            column = F.regexp_replace(column, r"\.?0*$", "") if name == "ingested_at" else F.substring(column, 1, 19)
        elif kind == "int":
            column = column.cast("bigint")
        elif kind == "array<string>":
            column = F.array_join(column, "|")
        elif name == "avg_engagement_rate":
            column = F.round(column, 9)
        columns.append(column.alias(name))
    return df.select(*columns)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from_events(read_events(configure(spark), sf_dir))


def _snaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.snapshots(build_silver(_bronze(spark, sf_dir)))


def _day_bound(spark: SparkSession, sf_dir: str) -> int:
    """No group of a later table has more rows per region and day than the raw records have."""
    seen = F.to_date(to_timestamp(F.col("ingested_at")))
    return largest_group(_bronze(spark, sf_dir).select("region", seen.alias(SNAPSHOT)), gold.DAY)


def _split(df: DataFrame) -> dict[str, int]:
    """A limit below the largest group, which makes any table take the plans for large groups."""
    return {"max_group_rows": max(1, largest_group(df, gold.DAY) // 4)}


def _staging(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, build = staging.STAGING[name]
    snaps = _snaps(spark, sf_dir)
    make = getattr(gold, source)
    if source == "daily_trending_rank":
        return build(make(snaps, _day_bound(spark, sf_dir)))
    return build(make(snaps))


def silver_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(build_silver(_bronze(spark, sf_dir)))


def silver_latest_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(build_silver(_bronze(spark, sf_dir), "latest"))


def _latest(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    snaps = gold.snapshots(build_silver(_bronze(spark, sf_dir), grain))
    return comparable(snaps.select(*ENTITY, SNAPSHOT, "ingested_at", "view_count"))


def latest_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(spark, sf_dir, "day")


def latest_per_video_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(spark, sf_dir, "latest")


def duration_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    durations = _bronze(spark, sf_dir).select("duration", seconds_of(F.col("duration")).alias("duration_seconds"))
    return comparable(durations)


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.decode_payload(payloads_from_events(read_events(configure(spark), sf_dir)))


def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = raw.flatten_payload(_decoded(spark, sf_dir))
    return comparable(flat.withColumn("tags_count", F.size("tags")))


def json_flatten_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records from answers read as VARIANT values, without a fixed struct."""
    answers = payloads_from_events(read_events(configure(spark), sf_dir))
    flat = variants.flatten_variant(variants.decode_variant(answers))
    return comparable(flat.withColumn("tags_count", F.size("tags")))


def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.ingest_summary(_decoded(spark, sf_dir))


def region_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir).groupBy("region").agg(F.count(F.lit(1)).alias("records"))


def daily_trending_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(gold.daily_trending_rank(_snaps(spark, sf_dir), _day_bound(spark, sf_dir)))


def daily_trending_rank_in_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    snaps = stage(_snaps(spark, sf_dir), "snaps")
    return comparable(gold.daily_trending_rank(snaps, **_split(snaps)))


def category_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(gold.category_stats(_snaps(spark, sf_dir)))


def channel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(gold.channel_stats(_snaps(spark, sf_dir)))


def channel_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(gold.channel_titles(_snaps(spark, sf_dir)))


def view_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(gold.view_velocity(_snaps(spark, sf_dir)))


def _staging_query(name: str) -> Query:
    return lambda spark, sf_dir: comparable(_staging(spark, sf_dir, name))


def fct_trending_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = gold.daily_trending_rank(_snaps(spark, sf_dir), top=marts.LEADERBOARD_SIZE)
    return comparable(marts.fct_trending_leaderboard(staging.stg_daily_trending_rank(best)))


def fct_top_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound = _day_bound(spark, sf_dir)
    return comparable(marts.fct_top_channels(_staging(spark, sf_dir, "stg_channel_stats"), bound))


def fct_top_channels_in_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = stage(_staging(spark, sf_dir, "stg_channel_stats"), "stg_channel_stats")
    return comparable(marts.fct_top_channels(stg, **_split(stg)))


def fct_category_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = _staging(spark, sf_dir, "stg_category_stats")
    return comparable(marts.fct_category_performance(stg, _day_bound(spark, sf_dir)))


def fct_category_performance_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = stage(_staging(spark, sf_dir, "stg_category_stats"), "stg_category_stats")
    return comparable(marts.fct_category_performance(stg, by_join=True))


def fct_momentum_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = _staging(spark, sf_dir, "stg_view_velocity")
    return comparable(marts.fct_momentum_videos(stg, _day_bound(spark, sf_dir)))


def fct_momentum_videos_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = stage(_staging(spark, sf_dir, "stg_view_velocity"), "stg_view_velocity")
    return comparable(marts.fct_momentum_videos(stg, **_split(stg)))


def partition_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(distinct_values(build_silver(_bronze(spark, sf_dir)), SILVER_PARTITIONS))


def loss_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return losses(_bronze(spark, sf_dir), ENTITY)


def dq_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.validate_bronze(_bronze(spark, sf_dir))


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(dq_expectations(spark, sf_dir))


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(_bronze(spark, sf_dir), checks.video_region_key())


def dq_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The violating rows of every not-null and value check, with the name of the check."""
    found = all_violations(_bronze(spark, sf_dir), checks.bronze_expectations())
    return found.select("expectation", "video_id", "region", "ingested_at")


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation report as stored, without the stamp: totals, and each result in its order."""
    path = scratch_path(configure(spark), "report")
    checks.write_report(checks.report_document(dq_expectations(spark, sf_dir), "events", "now"), path)
    kind = f"""bronze_path STRING, {", ".join(f"{name} BIGINT" for name in SUMMARY[:-1])}, overall_success BOOLEAN,
        results ARRAY<STRUCT<expectation: STRING, critical: BOOLEAN, success: BOOLEAN, result: STRUCT<
            element_count: BIGINT, missing_count: BIGINT, unexpected_count: BIGINT>>>"""
    report = checks.read_report(spark, path).select(F.from_json("value", kind).alias("r")).select("r.*")
    return report.select("bronze_path", *SUMMARY, F.posexplode("results").alias("position", "entry")).select(
        "bronze_path", *SUMMARY, F.col("position").cast("bigint").alias("position"), "entry.expectation", "entry.result.unexpected_count"
    )


def _built(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All tables from silver up; silver and gold are stored once and read by what follows."""
    snaps = stage(_snaps(spark, sf_dir), "silver")
    bound = largest_group(snaps, gold.DAY)
    layer = {name: stage(df, name) for name, df in daily.gold_tables(snaps, bound).items()}
    stg = {name: build(layer[source]) for name, (source, build) in staging.STAGING.items()}
    return layer | stg | daily.mart_tables(stg, bound)


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_table_tests(_built(spark, sf_dir), checks.NOT_NULL, {})


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_table_tests(_built(spark, sf_dir), {}, checks.ACCEPTED)


def dq_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All verdicts on gold, staging and marts, counted while the marts were written."""
    lake = daily.Lake(scratch_path(configure(spark), "lake"))
    daily.build_silver(_bronze(spark, sf_dir), lake)
    daily.build_gold(spark, lake)
    return daily.store_tested_marts(spark, lake)[1]


def dq_value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per value of every column whose values are tested."""
    tables = _built(spark, sf_dir)
    found = [
        value_histogram(tables[table], column).select(
            F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
            F.col("value_field").cast("string").alias("value_field"), "n_records",
        )
        for table, column in checks.ACCEPTED
    ]
    return reduce(DataFrame.unionByName, found)


def dq_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts({name: df for name, df in _built(spark, sf_dir).items() if name.startswith("fct_")})


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(configure(spark), "roundtrip")
    write_table(build_silver(_bronze(spark, sf_dir)), path, SILVER_PARTITIONS)
    return comparable(read_table(spark, path, SILVER))


def _dealt_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records, made and written by all cores however few files or row groups the events come in."""
    events = read_events(configure(spark), sf_dir)
    return bronze_from_events(events.repartition(2 * spark.sparkContext.defaultParallelism))


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """All records as JSON lines below a landing prefix, in eight files or more."""
    prefix = scratch_path(configure(spark), "landing")
    bronze = _dealt_bronze(spark, sf_dir)
    raw.land(bronze, f"{prefix}/2024/01/01/00", rows_per_file=max(100, read_events(spark, sf_dir).count() // 8))
    return raw.landing_glob(f"{prefix}/2024")


def json_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = raw.read_bronze(spark, _landed(spark, sf_dir))
    tags_count = F.when(F.col("tags").isNull(), -1).otherwise(F.size("tags"))
    return comparable(landed.withColumn("tags_count", tags_count))


def _fed(spark: SparkSession, sf_dir: str) -> Feed:
    landed = _landed(spark, sf_dir)
    files = len(raw.read_bronze(spark, landed).inputFiles())
    feed = Feed(scratch_path(spark, "feed"))
    start_feed(stream_bronze(spark, landed, math.ceil(files / 2)), feed).awaitTermination()
    return feed


def _incremental(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    return comparable(feed_silver(spark, _fed(spark, sf_dir), grain))


def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir, "day")


def incremental_latest_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir, "latest")


def latest_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest record per day where all records of a day have one time and some counts are missing."""
    bronze = _bronze(spark, sf_dir)
    day = F.concat(F.substring("ingested_at", 1, 10), F.lit("T00:00:00.000000Z"))
    shifted = bronze.withColumn("ingested_at", day).withColumn(
        "comment_count", F.when(F.col("like_count").isNotNull(), F.col("comment_count"))
    )
    return comparable(latest_records(shifted).select(*ENTITY, SNAPSHOT, "title", "description", "view_count", "like_count", "comment_count"))


def _late_lake(spark: SparkSession, sf_dir: str) -> daily.Lake:
    """A lake built without some records of a day, and with a region that this day later loses; then the day is replaced."""
    lake = daily.Lake(scratch_path(configure(spark), "lake"))
    bronze = _bronze(spark, sf_dir)
    late_day = bronze.agg(F.mode(F.substring("ingested_at", 1, 10))).first()[0]
    of_day = F.col("ingested_at").startswith(late_day)
    early = bronze.filter(~of_day | (F.col("comment_count") % 3 != 0))
    lost = bronze.filter(of_day & (F.col("region") == "US")).withColumn("region", F.lit("ZZ"))
    daily.build_silver(early.unionByName(lost), lake)
    daily.build_gold(spark, lake)
    daily.build_silver(bronze.filter(of_day), lake, day=late_day)
    daily.build_gold(spark, lake, late_day)
    return lake


def gold_after_late_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth after a day was replaced."""
    return comparable(daily.read_gold(spark, _late_lake(spark, sf_dir))["view_velocity"])


def ranks_after_late_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks after a day was replaced."""
    return comparable(daily.read_gold(spark, _late_lake(spark, sf_dir))["daily_trending_rank"])


def incremental_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fastest risers, from landed files over the feed, silver and gold to the mart."""
    lake = daily.Lake(scratch_path(configure(spark), "lake"))
    daily.run_feed(spark, _fed(spark, sf_dir), lake)
    return comparable(spark.read.parquet(lake.path("marts", "fct_momentum_videos")))


def _followed_lake(spark: SparkSession, sf_dir: str) -> daily.Lake:
    """A lake that was built from a feed without some records of three days, and then followed it when they came, some corrected."""
    root = scratch_path(configure(spark), "followed")
    bronze = _dealt_bronze(spark, sf_dir)
    day = F.substring("ingested_at", 1, 10)
    late_days = [row[0] for row in _bronze(spark, sf_dir).groupBy(day.alias("day")).count().orderBy(F.desc("count"), "day").limit(3).collect()]
    late = day.isin(late_days) & (F.col("comment_count") % 3 == 0)
    wrong = day.isin(late_days) & (F.col("comment_count") % 7 == 1)  # came early in the day, with no views; corrected later
    early = bronze.filter(~late).withColumns(
        {
            "view_count": F.when(wrong, 0).otherwise(F.col("view_count")).cast("bigint"),
            "ingested_at": F.when(wrong, F.concat(day, F.lit("T00:00:00.000000Z"))).otherwise(F.col("ingested_at")),
        }
    )
    feed, lake = Feed(f"{root}/feed"), daily.Lake(f"{root}/lake")
    for part in (early, bronze.filter(late | wrong)):
        raw.land(part, f"{root}/landing/2024/01/01/00")
        start_feed(stream_bronze(spark, raw.landing_glob(f"{root}/landing/2024")), feed).awaitTermination()
        daily.run_feed(spark, feed, lake)
    return lake


def feed_gold_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth in a lake that took up late and corrected records."""
    return comparable(daily.read_gold(spark, _followed_lake(spark, sf_dir))["view_velocity"])


def catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category statistics written, registered twice and read by name."""
    path, name = scratch_path(configure(spark), "catalog"), "trendmill_check.category_stats"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    stats = gold.category_stats(_snaps(spark, sf_dir))
    write_table(stats, path, GOLD_PARTITIONS)
    for _ in range(2):
        register_table(spark, name, path, GOLD["category_stats"], GOLD_PARTITIONS)
    return comparable(read_catalog(spark, name))


def _other_place(table: str) -> str:
    """A name of the catalog for one run, so that runs side by side do not meet."""
    return f"trendmill_check.{table}_{uuid.uuid4().hex}"


def catalog_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category statistics under one name, first with fewer, other and further columns, then as they are, at another place."""
    root, name = scratch_path(configure(spark), "evolution"), _other_place("evolving")
    stats = stage(gold.category_stats(_snaps(spark, sf_dir)), "stats")
    first = stats.select("category_id", F.col("video_count").cast("int"), F.lit("old").alias("obsolete"), *GOLD_PARTITIONS)
    write_table(first, f"{root}/first", GOLD_PARTITIONS)
    register_table(spark, name, f"{root}/first", first.schema, GOLD_PARTITIONS)
    read_catalog(spark, name).count()  # what a reader sees now must not stay
    write_table(stats, f"{root}/second", GOLD_PARTITIONS)
    register_table(spark, name, f"{root}/second", GOLD["category_stats"], GOLD_PARTITIONS)
    return comparable(read_catalog(spark, name))


def _published(spark: SparkSession, sf_dir: str) -> tuple[VersionedTable, DataFrame]:
    """Category statistics in two versions, the first without a region."""
    table = VersionedTable(_other_place("versioned"), scratch_path(configure(spark), "versions"), GOLD["category_stats"], tuple(GOLD_PARTITIONS))
    stats = stage(gold.category_stats(_snaps(spark, sf_dir)), "stats")
    for df in (stats.filter("region <> 'US'"), stats):
        publish(spark, table, write_version(df, table)[0])
    return table, stats


def _as_of(seen: str, df: DataFrame) -> DataFrame:
    wanted = df.select(F.lit(seen).alias("seen"), "category_id", *GOLD_PARTITIONS, "video_count", "total_views", "top_video_id")
    return comparable(wanted)


def table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions as they were, and what the catalog shows after the first was published again."""
    table, _ = _published(spark, sf_dir)
    publish(spark, table, 1)
    found = [_as_of("one", read_version(spark, table, 1)), _as_of("two", read_version(spark, table, 2)), _as_of("catalog", spark.table(table.name))]
    return reduce(DataFrame.unionByName, found)


def crash_between_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after a third build has failed half-way: both versions, and the second in the catalog."""
    table, stats = _published(spark, sf_dir)
    fails = F.when(F.col("region") == "IN", F.raise_error(F.lit("half-way")).cast("string")).otherwise(F.col("top_video_id"))
    try:
        write_version(stats.withColumn("top_video_id", fails), table)
    except Exception as error:
        if "half-way" not in str(error):
            raise
    found = [_as_of("one", read_version(spark, table, 1)), _as_of("two", read_version(spark, table, 2)), _as_of("catalog", spark.table(table.name))]
    return reduce(DataFrame.unionByName, found)


def _landed_with_mistakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records landed as lines in eight folders, some after a stray mark, some with a count in quotes; read again."""
    path = scratch_path(configure(spark), "mistakes")
    bronze = bronze_from_events(read_events(spark, sf_dir), "event_id")
    line = F.to_json(F.struct(*BRONZE_COLUMNS))
    line = F.when(F.col("event_id") % 37 == 0, F.concat(F.lit("### "), line)).otherwise(line)
    quoted = F.regexp_replace(line, r'"view_count":(\d+)', '"view_count":"$1 views"')
    line = F.when(F.col("event_id") % 41 == 0, quoted).otherwise(line)
    bronze.select(line.alias("value"), (F.col("event_id") % 8).alias("part")).write.partitionBy("part").text(path)
    return quarantine.read_lines(spark, path)


def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per landing folder: sound, no JSON, with a field of another type, and without a key."""
    part = F.regexp_extract("file", r"part=(\d+)", 1).cast("bigint").alias("part")
    return quarantine.line_counts(_landed_with_mistakes(spark, sf_dir), part)


def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver from the sound lines and those set aside and repaired."""
    path = scratch_path(configure(spark), "quarantine")
    lines = _landed_with_mistakes(spark, sf_dir)
    quarantine.write_quarantine(lines, path)
    mended = F.regexp_replace(F.regexp_replace("line", "^### ", ""), r'"view_count":"(\d+) views"', '"view_count":$1')
    again = quarantine.replayed(quarantine.read_quarantine(spark, path), mended)
    return comparable(build_silver(quarantine.records(lines).unionByName(quarantine.records(again))))


def velocity_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth from a history stored by video and region, which needs no shuffle any more."""
    table = Bucketed(_other_place("by_key"), scratch_path(configure(spark), "by_key"), tuple(ENTITY), (SNAPSHOT,))
    snaps = stage(_snaps(spark, sf_dir), "snaps")
    write_bucketed(snaps, table, max(8, buckets_for(snaps.count())))
    return comparable(gold.view_velocity(read_bucketed(spark, table)))


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate says of all records: why it stops the run, and the warnings it lets pass."""
    results = checks.fixed_results(dq_expectations(spark, sf_dir))
    warnings, stop = checks.gate(results, fail_on_error=False), ""
    try:
        checks.gate(results)
    except checks.ExpectationsFailed as error:
        stop = str(error)
    return spark.createDataFrame([(stop, ", ".join(warnings))], "stop STRING, warnings STRING")


def dq_day_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdicts on all records, from the kept counts of the other days and those of a day that is replaced."""
    store = CountStore(scratch_path(configure(spark), "counts"))
    bronze = _bronze(spark, sf_dir)
    late_day = bronze.agg(F.mode(F.substring("ingested_at", 1, 10))).first()[0]
    of_day = F.coalesce(F.col("ingested_at").startswith(late_day), F.lit(False))
    store_counts(day_counts(bronze.filter(~of_day | (F.col("comment_count") % 3 != 0))), store)
    counts = stage(day_counts(bronze.filter(of_day)), "counts")
    store_counts(counts, store, late_day)
    return results_with(counts, store, late_day)


def feed_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per region and hour that a waiting feed has taken up, and whether the hour is closed."""
    landed = _landed(spark, sf_dir)
    files = len(raw.read_bronze(spark, landed).inputFiles())
    feed = Feed(scratch_path(spark, "feed"))
    wait_for_arrivals(stream_bronze(spark, landed, math.ceil(files / 2)), feed, "1 seconds", quiet=2)
    counts = arrival_counts(spark, feed, "2 hours")
    return comparable(counts.select("region", F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "records", "closed"))


def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations, ratios and typed text by SQL alone, with functions that the catalog keeps."""
    database = "trendmill_functions"
    register_functions(configure(spark), database)
    view = f"bronze_{uuid.uuid4().hex}"
    _bronze(spark, sf_dir).createOrReplaceTempView(view)
    f = database
    return spark.sql(f"""
        SELECT video_id, region, ingested_at, CAST({f}.duration_seconds(duration) AS BIGINT) AS duration_seconds,
               CAST({f}.text_to_int(category_id) AS BIGINT) AS category_id, CAST({f}.array_size_or_zero(tags) AS BIGINT) AS tags_count,
               {f}.safe_ratio(like_count + comment_count, view_count) AS engagement_rate,
               {f}.safe_ratio(like_count, view_count) AS like_to_view_ratio,
               {f}.text_to_timestamp(published_at) IS NULL AS bad_time
        FROM {view}""")


def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the writers of the gold tables counted, and the rows found in the tables."""
    root = scratch_path(configure(spark), "counts")
    snaps = _snaps(spark, sf_dir)
    counted = {}
    for name, df in daily.gold_tables(snaps, _day_bound(spark, sf_dir)).items():
        counted[name] = write_table(df, f"{root}/{name}", GOLD_PARTITIONS)
    found = row_counts({name: spark.read.parquet(f"{root}/{name}") for name in counted})
    written = F.create_map(*[F.lit(x) for pair in counted.items() for x in pair])
    return found.withColumn("written_rows", written[F.col("table_name")].cast("bigint"))


def report_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaderboard with the position of each row in report order."""
    best = gold.daily_trending_rank(_snaps(spark, sf_dir), top=marts.LEADERBOARD_SIZE)
    board = marts.fct_trending_leaderboard(staging.stg_daily_trending_rank(best))
    placed = numbered(board, [F.asc(column) for column in marts.REPORT_ORDER["fct_trending_leaderboard"]], "position")
    return comparable(placed.select("position", "region", SNAPSHOT, "trending_rank", "video_id"))


def ingest_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.ingest_total(raw.ingest_summary(_decoded(spark, sf_dir)))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the trending leaderboard, from raw records to report, in report order."""
    return marts.in_report_order(fct_trending_leaderboard(spark, "/root/testdata/sf0.001"), "fct_trending_leaderboard")


def queries() -> dict[str, Query]:
    registered = [
        silver_videos, silver_latest_only, latest_per_day, latest_per_video_region,
        duration_seconds, json_flatten, ingest_summary, region_counts, daily_trending_rank,
        daily_trending_rank_in_cells, category_stats, channel_stats, channel_titles, view_velocity,
        fct_trending_leaderboard, fct_top_channels, fct_top_channels_in_cells,
        fct_category_performance, fct_category_performance_by_join, fct_momentum_videos,
        fct_momentum_videos_by_join, partition_values, loss_accounting, dq_expectations,
        dq_summary, dq_duplicates, dq_violations, dq_not_null, dq_accepted_values,
        dq_value_histogram, dq_row_counts, partitioned_roundtrip, json_lines_roundtrip,
        incremental_silver, incremental_latest_only, incremental_marts, latest_with_ties,
        gold_after_late_day, ranks_after_late_day, dq_report, catalog_roundtrip, observed_counts,
        report_order, ingest_total, catalog_evolution, table_versions, crash_between_versions,
        feed_gold_changes, quarantine_counts, quarantine_replay, sql_functions,
        velocity_in_buckets, dq_day_by_day, feed_arrivals, json_flatten_variant, dq_gate, dq_observed,
    ]
    named = {query.__name__: query for query in registered}
    named |= {name: _staging_query(name) for name in staging.STAGING}
    return named | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


def oracle_sql() -> dict[str, str]:
    known = oracles.sql() | (llm.oracle_sql() if llm else {})
    return known | ({"pipeline": corpus_pipeline.ORACLE_SQL} if llm and corpus_pipeline.ORACLE_SQL else {})
