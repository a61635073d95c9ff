"""Bench: the layer jobs as production runs them, on storage.

events -> bronze (conflict-ignoring load) -> silver (full; an incremental
carried run; a recompute from a given day) -> gold (full; incremental) ->
serving queries and quality suites.
Layers are written as date-partitioned Parquet under the session's shared
checkpoint folder; serving reads gold from storage.  Prints one JSON line.

All layer jobs run BENCH_REPEAT times (default 3), each time into fresh
folders; every query reports its median time (timings on a shared VM are
noisy run to run).

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from barlake.operators import bars, quality, serving, writes  # noqa: E402
from barlake.plans import jobs  # noqa: E402
from barlake.session import build_session, scratch_path  # noqa: E402
from barlake.sources import fixtures  # noqa: E402

AS_OF = "2024-01-31 00:00:00"
CUT = "2024-01-20 00:00:00"
LATE_DAY = "2024-01-10"


def run_layers(spark, sf_dir: str) -> tuple[dict[str, float], dict[str, int]]:
    base = scratch_path(spark, "bench")
    paths = {k: f"{base}/{k}" for k in ("bronze", "silver", "silver_inc", "gold")}
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    events = fixtures.load_table(spark, sf_dir, "events")

    # bronze: conflict-ignoring, idempotent load of every landed bar
    raw = fixtures.wide_bars(events).drop("id")
    timed("bronze_load", lambda: writes.append_bronze(spark, raw, paths["bronze"]).collect())
    bronze = spark.read.parquet(paths["bronze"]).drop("date")

    # silver: full refresh, written by date
    timed("silver_full", lambda: jobs.refresh_silver(spark, bronze, paths["silver"], mode="full",
                                                     updated_at=AS_OF))

    # silver: incremental run with carried state after a second delivery
    inc_bronze = f"{base}/bronze_inc"
    cut = F.lit(CUT).cast("timestamp")
    writes.write_layer(bronze.filter(F.col("timestamp") < cut).withColumn("date", F.to_date("timestamp")),
                       inc_bronze)
    jobs.refresh_silver(spark, spark.read.parquet(inc_bronze), paths["silver_inc"],
                        mode="carry", state_path=f"{base}/state", updated_at=AS_OF)
    jobs.refresh_gold(spark, paths["silver_inc"], f"{base}/gold_inc", updated_at=AS_OF)
    writes.write_layer(bronze.filter(F.col("timestamp") >= cut).withColumn("date", F.to_date("timestamp")),
                       inc_bronze, mode="append")
    slices = timed("silver_incremental", lambda: jobs.refresh_silver(
        spark, spark.read.parquet(inc_bronze), paths["silver_inc"], mode="carry",
        state_path=f"{base}/state", updated_at=AS_OF))
    timed("gold_incremental", lambda: jobs.refresh_gold_slices(
        spark, paths["silver_inc"], f"{base}/gold_inc", slices, updated_at=AS_OF))
    # late-row policy: the slices that one late day touches are rebuilt
    late = bronze.filter(F.to_date("timestamp") == F.lit(LATE_DAY).cast("date"))
    timed("silver_recompute", lambda: jobs.refresh_silver(
        spark, spark.read.parquet(inc_bronze), paths["silver_inc"], mode="recompute",
        state_path=f"{base}/state", updated_at=AS_OF, changed=late))

    timed("gold_refresh", lambda: jobs.refresh_gold(spark, paths["silver"], paths["gold"], updated_at=AS_OF))
    silver = spark.read.parquet(paths["silver"]).drop("date")
    gold = spark.read.parquet(paths["gold"])

    timed("latest_prices", lambda: run(serving.latest_prices(gold)))
    timed("price_history", lambda: run(serving.price_history(gold, "CLICK1-USD", "1M", AS_OF)))
    timed("performance_summary", lambda: run(serving.performance_summary(
        serving.compare_symbols(gold, serving.default_selection(gold, 3), 90, AS_OF))))
    timed("quality_bronze", lambda: run(quality.run_suite(bronze, quality.BRONZE_SUITE, "bronze")))
    timed("quality_silver", lambda: run(quality.run_suite(silver, quality.SILVER_SUITE, "silver")))
    timed("quality_gold", lambda: run(quality.run_suite(gold, quality.GOLD_SUITE, "gold")))
    timed("freshness", lambda: run(quality.freshness(bronze, AS_OF)))
    timed("bars_15m", lambda: run(bars.resample(fixtures.tick_bars(events), "15 minutes")))

    sizes = {"bronze": bronze.count(), "silver": silver.count(), "gold": gold.count()}
    return times, sizes


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app="barlake-bench")
    # JVM / codegen / parquet-reader warm-up on an unrelated table
    fixtures.load_table(spark, sf_dir, "orders").groupBy("o_orderstatus").count().collect()
    runs = [run_layers(spark, sf_dir) for _ in range(repeat)]
    sizes = runs[0][1]
    runs = [times for times, _ in runs]
    times = {k: round(statistics.median(r[k] for r in runs), 3) for k in runs[0]}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "layers_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "rows": sizes, "cpus": cpus, "repeat": repeat,
                      "total_per_run": [round(sum(r.values()), 3) for r in runs]}))
    spark.stop()


if __name__ == "__main__":
    main()
