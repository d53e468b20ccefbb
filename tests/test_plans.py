"""Plan-shape checks: JVM-only expressions, partition/column pruning, pushed filters, zone independence."""


import pytest

from orderlake.plans import registry
from orderlake.operators import gold, silver
from orderlake.plans.chain import Lake
from orderlake.sources import tables
from tests.conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_python_in_query_plans(spark, name):
    plan = plan_of(registry.QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in plan


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    lake = Lake(spark, SF_SMALL)
    tables.append_batch(lake.bronze, f"{root}/bronze", 0)
    lake.silver.write.partitionBy("event_date").parquet(f"{root}/silver")
    return root


def test_bronze_date_scan_prunes_partitions(spark, stored):
    df = silver.read_bronze(spark.read.parquet(f"{stored}/bronze"), "1998-06-15")
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan and "1998-06-15" in plan
    assert "PushedFilters: [IsNotNull(is_duplicate), EqualTo(is_duplicate,false)]" in plan


def test_silver_scan_prunes_partitions_and_columns(spark, stored):
    s = silver.read_silver(spark.read.parquet(f"{stored}/silver"), "1998-06-15")
    plan = plan_of(gold.hourly_orders(s))
    assert "PartitionFilters: [isnotnull(event_date" in plan
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "payload" not in read_schema and "pincode" not in read_schema and "amount" in read_schema


def test_processing_date_filter_is_pushed_to_parquet(spark, stored):
    df = silver.by_processing_date(spark.read.parquet(f"{stored}/silver"), "1998-06-15")
    plan = plan_of(df)
    assert "EqualTo(processing_date,1998-06-15)" in plan


def test_dq_suite_is_single_pass(spark, stored):
    from orderlake.operators import quality
    s = spark.read.parquet(f"{stored}/silver")
    plan = plan_of(quality.run_suite(s, quality.silver_suite(0)))
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("name", ["p12_silver_orders", "j5_city_as_of", "m8_records_per_minute", "d7_full_history",
                                  "a1_hourly_orders"])
def test_results_do_not_depend_on_session_time_zone(spark, name):
    q = registry.QUERIES[name]
    utc = sorted(map(tuple, q(spark, SF_SMALL).collect()), key=str)
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = sorted(map(tuple, q(spark, SF_SMALL).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other


def test_published_values_are_parsed_once(spark):
    plan = plan_of(registry.QUERIES["s19_keyed_publish"](spark, SF_SMALL))
    assert "get_json_object" not in plan and plan.count("Generate inline(array(from_json") == 1


def test_orders_keep_their_tasks_before_they_fan_out(spark):
    assert "REPARTITION_BY_NUM" in plan_of(Lake(spark, SF_SMALL).raw)


@pytest.mark.parametrize("name, unused", [("m10_silver_count", ["pincode", "discount_pct"]), ("d7_full_history", ["pincode", "amount"]), ("m5_duration_percentiles", ["device", "city"]),
                                          ("k13_gate_by_date", ["pincode", "device"]), ("s10_upsert_indexed", ["pincode", "device"])])
def test_silver_holds_only_the_columns_that_a_query_reads(spark, monkeypatch, name, unused):
    asked = []

    def spy(self, *columns):
        asked.append(columns)
        return kept(self, *columns)

    kept = Lake.silver_of
    monkeypatch.setattr(Lake, "silver_of", spy)
    registry.QUERIES[name](spark, SF_SMALL)
    assert asked and not any(c in columns for columns in asked for c in unused)
    plan = plan_of(Lake(spark, SF_SMALL).silver_of(*asked[0]))
    narrow = [line for line in plan.splitlines() if "partial_min_by" in line]
    assert narrow and not any(c in line for line in narrow for c in [*unused, "payload"])


@pytest.mark.parametrize("name", ["a7_bronze_profile", "d1_scd2_apply", "d8_dimension_violations", "j5_city_as_of", "k11_checksum_recon", "k11_reconciliation", "k12_backfill_dates", "k13_gate_by_date",
                                  "m2_records_by_layer", "m5_duration_percentiles", "s4_bronze_date_scan", "s10_merge", "w1_bronze_duplicates", "x3_sla_compliance"])
def test_rows_read_more_than_once_are_stored_first(spark, name):
    assert "from_json" not in plan_of(registry.QUERIES[name](spark, SF_SMALL))  # else each branch of the plan parses every message again


def test_orders_are_dealt_after_their_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many customers
    try:
        lines = plan_of(Lake(spark, SF_SMALL).raw).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    at = lambda what: [i for i, line in enumerate(lines) if what in line]
    assert at("SortMergeJoin") and at("Generate inline")[-1] < at("REPARTITION_BY_NUM")[0] < at("SortMergeJoin")[0]  # the plan's root is its first line


def test_messages_are_built_outside_the_parser(spark):
    # from_json generates no code for what stands inside it, so the message must reach it as a column
    plan = Lake(spark, SF_SMALL).typed.select("event_id", "city")._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.splitlines() if "from_json" in line]
    assert len(lines) == 1 and "to_json" not in lines[0] and "StructsToJson" not in lines[0]
    assert "to_json" in plan or "StructsToJson" in plan


def test_customer_history_is_computed_once(spark):
    from orderlake.operators import scd2
    # closed and current versions come from one pass over the daily states: no union of two
    dim = scd2.scd2_history(Lake(spark, SF_SMALL).silver)
    plan = plan_of(scd2.scd2_apply(dim, scd2.customer_snapshot(Lake(spark, SF_SMALL).silver), "2000-01-01"))
    assert "Union" not in plan and plan.count("FullOuter") == 1
