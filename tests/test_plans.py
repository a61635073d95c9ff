"""Physical-plan properties that matter at scale."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from barlake.catalog import REGISTRY, gold, raw, silver
from barlake.operators import serving, writes
from barlake.plans import gold as gold_plan
from barlake.plans import silver as silver_plan

from conftest import SF_GATE, SF_SMALL

STREAMS = {"stream_silver_replay", "stream_bronze", "stream_dedup", "stream_silver", "stream_daily_bars", "stream_silver_late",
           "stream_daily_from_silver_feed"}


def plan(df, mode="formatted") -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def final_plan(df) -> str:
    df.collect()
    text = plan(df)
    return text.split("== Initial Plan ==")[0]


def test_silver_has_partial_dedup_and_hash_aggregates_only(spark):
    p = plan(silver(spark, SF_GATE), "simple")
    assert "WindowGroupLimit" in p and "Partial" in p
    assert "SortAggregate" not in p


def test_silver_lag_is_split_by_symbol_and_hour(spark):
    p = plan(silver(spark, SF_GATE), "simple")
    assert "hashpartitioning(symbol#" in p and "_bucket" in p
    # the summaries that go up a level are hash aggregates of the carried columns only
    assert "partial_max_by(close" in p and "partial_max_by(volume" in p


def test_gold_rollup_is_a_partial_hash_aggregate(spark, tmp_path):
    path = str(tmp_path / "silver")
    writes.write_layer(silver(spark, SF_SMALL).withColumn("date", F.to_date("timestamp")), path)
    stored = spark.read.parquet(path).drop("date")
    p = plan(gold_plan.build_gold(stored, updated_at="2024-01-31"), "simple")
    assert "partial_min_by(open" in p and "SortAggregate" not in p
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "flag_missing_open" not in scan and "log_return" not in scan      # column pruning


def test_serving_prunes_partitions_and_pushes_symbol(spark, tmp_path):
    path = str(tmp_path / "gold")
    writes.write_layer(gold(spark, SF_SMALL), path, sort_by=("symbol",))
    g = spark.read.parquet(path)
    lp = plan(serving.latest_prices(g), "simple")
    assert "PartitionFilters: [isnotnull(date" in lp and "Subquery" in lp
    ph = plan(serving.price_history(g, "CLICK-USD", "7D", "2024-01-31"), "simple")
    assert "EqualTo(symbol,CLICK-USD)" in ph
    assert "PartitionFilters: [isnotnull(date" in ph and "date#" in ph


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - STREAMS))
def test_no_cartesian_products_or_python_udfs(spark, name):
    p = plan(entry.queries()[name](spark, SF_SMALL), "simple")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, f"{name}: {bad}"


def test_load_reads_only_the_batch_date_range_of_bronze(spark, tmp_path):
    from bars_data import bronze, ts
    path = str(tmp_path / "bronze")
    history = bronze(spark, [{"timestamp": ts(1, days=d)} for d in range(10)])
    writes.write_layer(history.withColumn("date", F.to_date("timestamp")), path)
    target = spark.read.parquet(path)
    batch = bronze(spark, [{"timestamp": ts(2, days=9), "id": 99}])
    p = plan(writes.insert_if_absent(batch, target), "simple")
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    filters = scan[scan.index("PartitionFilters"):]
    assert "date#" in filters and str(ts(2, days=9).date()) in filters
    assert writes.insert_if_absent(batch, target).count() == 1


def test_incremental_silver_prunes_bronze_partitions(spark, tmp_path):
    path = str(tmp_path / "bronze")
    writes.write_layer(raw(spark, SF_SMALL).withColumn("date", F.to_date("timestamp")), path)
    bronze = spark.read.parquet(path)
    p = plan(silver_plan.build_silver(bronze, high_water="2024-01-25 00:00:00"), "simple")
    scans = [line for line in p.splitlines() if "FileScan parquet" in line]
    assert all("PartitionFilters: [isnotnull(date" in s_ and "2024-01-25" in s_ for s_ in scans)


def _folders(path: str) -> dict[str, set]:
    return {d: set(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if "=" in d}


def test_one_late_bar_rewrites_only_its_days(spark, tmp_path):
    from bars_data import bronze, ts
    from barlake.plans import jobs
    path, state = str(tmp_path / "silver"), str(tmp_path / "state")
    rows = bronze(spark, [{"timestamp": ts(3, days=d), "close": 10.0 + d / 10, "id": d + 1} for d in range(12)])
    jobs.refresh_silver(spark, rows, path, mode="full", state_path=state)
    before, days = _folders(path), _folders(state + "/days")
    late = bronze(spark, [{"timestamp": ts(1, days=4), "id": 99, "close": 10.2}])
    slices = jobs.refresh_silver(spark, rows.unionByName(late), path, state_path=state, changed=late)
    touched = {f"date={ts(0, days=d).date()}" for d in (4, 5)}          # the bar's day and the symbol's next one
    assert {f"date={r.day}" for r in slices.collect()} == touched
    assert {d for d, files in _folders(path).items() if before.get(d) != files} == touched
    assert {d for d, files in _folders(state + "/days").items() if days.get(d) != files} == {f"day={ts(0, days=4).date()}"}


def test_carry_merges_only_the_marks_day(spark, tmp_path):
    from bars_data import bronze, ts
    from barlake.plans import jobs
    path, state = str(tmp_path / "silver"), str(tmp_path / "state")
    rows = bronze(spark, [{"timestamp": ts(3, days=d), "close": 10.0 + d / 10, "id": d + 1} for d in range(6)])
    jobs.refresh_silver(spark, rows, path, mode="full", state_path=state)
    before = _folders(path)
    more = bronze(spark, [{"timestamp": ts(5, days=5), "id": 50, "close": 10.6}, {"timestamp": ts(1, days=6), "id": 51, "close": 10.7}])
    jobs.refresh_silver(spark, rows.unionByName(more), path, mode="carry", state_path=state)
    changed = {d for d, files in _folders(path).items() if before.get(d) != files}
    assert changed == {f"date={ts(0, days=d).date()}" for d in (5, 6)}
    assert spark.read.parquet(path).count() == 8
