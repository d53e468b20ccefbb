"""

1. DQ suite: one aggregate for all checks vs two count jobs per check.
2. Bronze scan of one date partition vs the whole table.
3. Upsert of one day into Silver: touched partitions only vs full-table rewrite.

Writes its tables under a fresh scratch folder given as the second argument.
"""

from __future__ import annotations

import json
import sys
import time

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from orderlake.operators import quality, silver  # noqa: E402
from orderlake.plans.chain import Lake  # noqa: E402
from orderlake.session import local_session  # noqa: E402
from orderlake.sources import tables  # noqa: E402


def timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return round(time.perf_counter() - t0, 3), out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    root = sys.argv[2]
    spark = local_session(8, 16)
    lake = Lake(spark, sf)
    res = {"sf_dir": sf}
    res["write_bronze_s"], _ = timed(lambda: tables.append_batch(lake.bronze, f"{root}/bronze", 0))
    res["write_silver_s"], _ = timed(lambda: tables.clustered(silver.cast_and_extract(
        silver.read_bronze(spark.read.parquet(f"{root}/bronze"))), "event_date").write.partitionBy("event_date")
        .parquet(f"{root}/silver"))
    s = spark.read.parquet(f"{root}/silver")
    suite = quality.silver_suite(quality.as_of_millis("2001-08-03"))

    def per_check():
        out = []
        for e in suite:
            out.append(s.agg(e.metric().alias("m")).first()[0])  # metric job
            out.append(s.agg(e.passed(e.metric()).alias("p")).first()[0])  # check job
        return out

    timed(lambda: quality.run_suite(s, suite).collect())  # warm-up
    res["dq_single_pass_s"], _ = timed(lambda: quality.run_suite(s, suite).collect())
    res["dq_per_check_16_jobs_s"], _ = timed(per_check)
    b = spark.read.parquet(f"{root}/bronze")
    res["bronze_scan_one_date_s"], n1 = timed(lambda: silver.read_bronze(b, "1998-06-15").count())
    res["bronze_scan_full_s"], n2 = timed(lambda: silver.read_bronze(b).count())
    res["bronze_rows_one_date"], res["bronze_rows_full"] = n1, n2
    day = silver.cast_and_extract(silver.read_bronze(b, "1998-06-15"))
    res["upsert_touched_partitions_s"], m = timed(lambda: tables.upsert(
        day, f"{root}/silver", ["event_id"], "event_date", order_cols=["ingested_at"]))
    res["upsert_metrics"] = m

    def full_rewrite():
        tgt = spark.read.parquet(f"{root}/silver")
        merged = tgt.join(day.select("event_id"), "event_id", "left_anti").unionByName(day)
        tables.clustered(merged, "event_date").write.mode("overwrite").partitionBy("event_date") \
            .parquet(f"{root}/silver_full")

    res["upsert_full_rewrite_s"], _ = timed(full_rewrite)
    print(json.dumps(res))


if __name__ == "__main__":
    main()
