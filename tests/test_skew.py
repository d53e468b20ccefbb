"""Hot keys: a group of copies holding a third of all rows is tagged exactly and split by AQE."""

from pyspark.sql import functions as F

from orderlake.operators import gold, ingest

SKEW_CONF = {
    # thresholds scaled down so that a 60,000-row input counts as skewed on one machine
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def hot_input(spark, n):
    return spark.range(n).select(
        # a third of all rows are copies of one event (a replay storm)
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("e"), F.col("id").cast("string")))
        .alias("event_id"),
        (F.lit(1_700_000_000_000) + F.col("id")).alias("ingested_at"),
        (F.col("id") % 8).cast("string").alias("kafka_partition"),
        F.col("id").cast("string").alias("kafka_offset"),
    )


def test_hot_duplicate_group_is_split_by_aqe_and_exact(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        tagged = ingest.tag_duplicates(hot_input(spark, n))
        rows = tagged.collect()
        hot = [r.is_duplicate for r in rows if r.event_id == "HOT"]
        assert hot.count("false") == 1 and hot.count("true") == n // 3 - 1
        assert sum(r.is_duplicate == "false" for r in rows) == n - n // 3 + 1
        final = tagged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in final  # the hot partition was split across tasks
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_join_back_has_its_own_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # large inputs: no broadcast
    try:
        plan = ingest.tag_duplicates(hot_input(spark, 1_000))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # rows → join, partial → final aggregate, aggregate → join: three ordinary shuffles,
    # so both inputs of the sort-merge join are shuffle reads, the shape the skew join needs
    assert plan.count("ENSURE_REQUIREMENTS") == 3 and "SortMergeJoin" in plan


def test_hot_city_hour_is_pre_aggregated(spark):
    from orderlake.plans.chain import Lake
    from tests.conftest import SF_SMALL
    s = Lake(spark, SF_SMALL).silver.withColumn("city", F.lit("HOT"))
    plan = gold.hourly_orders(s)._jdf.queryExecution().executedPlan().toString()
    # partial aggregates run before every exchange: a hot group is combined map-side
    assert plan.count("partial_") >= 1 and "Window" not in plan


def test_first_copies_equals_tag_and_filter_and_combines_map_side(spark):
    df = hot_input(spark, 30_000)
    a = ingest.non_duplicates(ingest.tag_duplicates(df)).drop("is_duplicate")
    b = ingest.first_copies(df)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert b.where("event_id = 'HOT'").first().kafka_offset == "0"
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Join" not in plan  # one aggregate, combined before the shuffle


def test_a_scan_tags_its_rows_against_copies_outside_it(spark):
    rows = [("a", "PLACED", 5, "0"), ("a", "DELIVERED", 3, "0"), ("b", "PLACED", 9, "0"), ("b", "PLACED", 9, "1"),
            (None, "PLACED", 2, "0"), (None, "DELIVERED", 1, "0"), ("c", "DELIVERED", 1, "0")]
    df = spark.createDataFrame(rows, "event_id string, event_type string, ingested_at long, kafka_offset string").withColumn("kafka_partition", F.lit("0"))
    wanted, cols = F.col("event_type") == "PLACED", ["event_id", "ingested_at", "kafka_offset", "is_duplicate"]
    some = sorted(tuple(r) for r in ingest.tag_duplicates_where(df, wanted).select(*cols).na.fill("").collect())
    assert some == sorted(tuple(r) for r in ingest.tag_duplicates(df).where(wanted).select(*cols).na.fill("").collect())
    assert some == [("", 2, "0", "true"), ("a", 5, "0", "true"), ("b", 9, "0", "false"), ("b", 9, "1", "true")]


def test_first_copies_sorts_by_a_hash_of_the_key(spark):
    rows = [("a", "x", 5, "1"), ("a", "y", 3, "0"), (None, "z", 2, "0"), (None, "w", 1, "0"), ("b", None, None, "0")]
    df = spark.createDataFrame(rows, "event_id string, city string, ingested_at long, kafka_offset string").withColumn("kafka_partition", F.lit("0"))
    got = ingest.first_copies(df, columns=["city", "event_id"])
    assert got.columns == ["city", "event_id"]
    assert {tuple(r) for r in got.collect()} == {("y", "a"), ("w", None), (None, "b")} and got.count() == 3
    assert sorted(r.event_id or "" for r in ingest.first_copies(df, columns=["event_id"]).collect()) == ["", "a", "b"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    sorts = [line.split("Sort [", 1)[1] for line in plan.splitlines() if "Sort [" in line]
    assert sorts and not any(s.startswith("event_id#") for s in sorts)  # the hash first, not the key itself, whose first bytes are alike
