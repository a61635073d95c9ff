"""Semantic traps, each on a few hand-written rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bars_data import bronze, ts
from barlake.functions.columns import round_half_up
from barlake.operators import quality, serving, writes
from barlake.plans import gold as gold_plan
from barlake.plans import ingest
from barlake.plans import silver as silver_plan

AS_OF = "2024-01-31 00:00:00"


def by_ts(df):
    return sorted(df.collect(), key=lambda r: (r.symbol, r.timestamp))


def test_repairs_and_flags_read_raw_columns(spark):
    b = bronze(spark, [
        {"open": None, "high": -1.0, "low": None, "close": 5.0, "volume": None},
        {"open": 0.0, "high": 6.0, "low": 4.0, "close": 5.0, "volume": 0.0},
    ])
    rows = by_ts(silver_plan.validated(b))
    a, c = rows
    assert (a.open, a.high, a.low, a.volume) == (5.0, 5.0, 5.0, 0.0)
    assert (a.flag_missing_open, a.flag_missing_high, a.flag_missing_low, a.flag_zero_volume) == (1, 0, 1, 0)
    assert (c.open, c.flag_missing_open, c.flag_zero_volume) == (5.0, 0, 1)   # <= 0 repaired, not flagged
    assert a.flag_missing_close == 0 and c.flag_missing_close == 0


def test_null_ingestion_time_wins_dedup_and_ties_are_deterministic(spark):
    b = bronze(spark, [
        {"timestamp": ts(1), "close": 1.0, "ingestion_timestamp": ts(5), "source": "a"},
        {"timestamp": ts(1), "close": 2.0, "ingestion_timestamp": None, "source": "b"},
        {"timestamp": ts(2), "close": 3.0, "ingestion_timestamp": ts(7), "source": "z"},
        {"timestamp": ts(2), "close": 4.0, "ingestion_timestamp": ts(7), "source": "y"},
    ])
    from barlake.operators.dedup import dedup_latest
    rows = by_ts(dedup_latest(b))
    assert [r.close for r in rows] == [2.0, 4.0]


def test_lag_runs_before_the_outlier_filter(spark):
    b = bronze(spark, [{"close": 10.0}, {"close": 30.0}, {"close": 31.0}, {"close": 0.5}])
    rows = by_ts(silver_plan.build_silver(b, updated_at=AS_OF))
    assert [r.close for r in rows] == [10.0, 31.0, 0.5]
    assert rows[0].simple_return_pct is None                       # first row kept
    assert rows[1].simple_return_pct == pytest.approx((31 - 30) / 30 * 100)
    assert rows[2].simple_return_pct == pytest.approx((0.5 - 31) / 31 * 100)  # -98%: one-sided filter


def test_incremental_boundary_reference_vs_carry(spark):
    b = bronze(spark, [{"close": 10.0}, {"close": 11.0}, {"close": 30.0}, {"close": 12.0}])
    cut = ts(2.5)
    part1 = b.filter(F.col("timestamp") < F.lit(cut))
    s1 = silver_plan.build_silver(part1, updated_at=AS_OF)
    full = {r.timestamp: r for r in silver_plan.build_silver(b, updated_at=AS_OF).collect()}
    ref = silver_plan.build_silver(b, updated_at=AS_OF, high_water=silver_plan.high_water(s1))
    ref_rows = by_ts(ref)
    # reference mode: the boundary row has no previous close, so the +172% outlier escapes
    assert [r.close for r in ref_rows] == [30.0, 12.0]
    assert ref_rows[0].simple_return_pct is None
    state = silver_plan.silver_state(part1)
    hwm = state.agg(F.max("timestamp")).scalar()
    carry = by_ts(silver_plan.build_silver(b, updated_at=AS_OF, high_water=hwm, initial_state=state))
    assert [r.close for r in carry] == [12.0]
    assert carry[0].simple_return_pct == full[carry[0].timestamp].simple_return_pct
    assert carry[0].prev_volume == full[carry[0].timestamp].prev_volume


def test_first_arrival_wins_and_reload_is_idempotent(spark, tmp_path):
    target = bronze(spark, [{"timestamp": ts(1), "close": 10.0}])
    batch = bronze(spark, [{"timestamp": ts(1), "close": 12.0}, {"timestamp": ts(2), "close": 13.0}])
    new = writes.insert_if_absent(batch, target)
    assert [r.close for r in new.collect()] == [13.0]
    path = str(tmp_path / "bronze")
    s1 = writes.append_bronze(spark, batch, path).first()
    s2 = writes.append_bronze(spark, batch, path).first()
    assert (s1.inserted, s1.duplicates, s1.total) == (2, 0, 2)
    assert (s2.inserted, s2.duplicates, s2.total) == (0, 2, 2)
    assert spark.read.parquet(path).count() == 2


def test_null_key_part_never_conflicts(spark):
    b = bronze(spark, [{"timestamp": ts(1), "source": None}, {"timestamp": ts(1), "source": None}])
    assert writes.insert_if_absent(b, b).count() == 2
    assert b.dropDuplicates(["timestamp", "symbol", "source"]).count() == 1   # what not to use


def test_daily_and_hourly_bars_on_one_day_are_summed(spark):
    b = bronze(spark, [
        {"timestamp": ts(0), "volume": 1000.0, "source": "yahoo_finance_daily"},
        {"timestamp": ts(1), "volume": 10.0, "source": "yahoo_finance_hourly"},
        {"timestamp": ts(2), "volume": 10.0, "source": "yahoo_finance_hourly"},
    ])
    g = gold_plan.build_gold(silver_plan.build_silver(b, updated_at=AS_OF), updated_at=AS_OF).first()
    assert (g.volume, g.data_points) == (1020.0, 3)


def test_nan_becomes_null_at_ingest(spark):
    up = spark.createDataFrame([(datetime(2024, 1, 1), 1.0, 2.0, 0.5, float("nan"), 5.0, "BTC-USD")],
                               "Datetime timestamp, Open double, High double, Low double, Close double, Volume double, symbol string")
    r = ingest.normalize_upstream(up, source="yahoo_finance", ingested_at=AS_OF).first()
    assert r.close is None and r.source == "yahoo_finance"


def test_rounding_is_half_away_from_zero_on_decimal_value(spark):
    df = spark.createDataFrame([(1.005,), (0.125,), (-0.125,)], "x double")
    got = [r.y for r in df.select(round_half_up("x", 2).alias("y")).collect()]
    assert got == [1.01, 0.13, -0.13]


def test_std_of_one_row_is_null(spark):
    g = spark.createDataFrame([(datetime(2024, 1, 1).date(), "BTC-USD", 2.0, 1.0, 1.5, 5.0)],
                              "date date, symbol string, high double, low double, close double, daily_return_pct double")
    r = serving.period_stats(g).first()
    assert r.volatility_pct is None and r.avg_daily_return_pct == 5.0 and r.total_return_pct == 0.0


def test_symbol_missing_on_last_date_drops_out_and_gaps_use_previous_row(spark):
    b = bronze(spark, [
        {"timestamp": ts(1, days=0), "symbol": "A-USD", "close": 10.0},
        {"timestamp": ts(1, days=2), "symbol": "A-USD", "close": 11.0},   # gap of one day
        {"timestamp": ts(1, days=0), "symbol": "B-USD", "close": 5.0},
    ])
    g = gold_plan.build_gold(silver_plan.build_silver(b, updated_at=AS_OF), updated_at=AS_OF)
    latest = serving.latest_prices(g).collect()
    assert [r.symbol for r in latest] == ["A-USD"]
    assert latest[0].daily_return_pct == 10.0


def test_bad_records(spark):
    b = bronze(spark, [{"close": 1e13}, {"symbol": "X" * 21}, {"volume": float("nan")}, {}])
    good, bad = writes.split_bad_records(b)
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["close overflows decimal(20,8)", "symbol too long", "volume is NaN"]
    assert good.count() == 1


def test_late_rows_at_and_before_the_mark_and_new_old_symbol(spark):
    target = silver_plan.build_silver(bronze(spark, [{"close": 1.0}, {"close": 1.0}]), updated_at=AS_OF)
    incoming = bronze(spark, [{"timestamp": ts(2)}, {"timestamp": ts(1), "symbol": "NEW-USD"},
                              {"timestamp": ts(3)}])
    late = sorted((r.symbol, r.timestamp) for r in silver_plan.late_rows(incoming, target).collect())
    assert late == [("BTC-USD", ts(2)), ("NEW-USD", ts(1))]
    inc = silver_plan.build_silver(incoming, updated_at=AS_OF, high_water=silver_plan.high_water(target))
    assert [r.timestamp for r in inc.collect()] == [ts(3)]


@pytest.mark.parametrize("clock,status", [("2024-01-31 00:00:00", "fresh"),
                                          ("2024-01-31 00:45:00", "stale"),
                                          ("2024-01-31 02:00:00", "empty")])
def test_freshness_states(spark, clock, status):
    from barlake.catalog import raw
    assert quality.freshness(raw(spark, "/root/testdata/sf0.001"), clock).first().status == status


@pytest.mark.parametrize("sf,status", [("0.001", "warn"), ("0.01", "pass"), ("0.1", "pass")])
def test_source_freshness_states(spark, sf, status):
    from barlake.catalog import raw
    r = quality.source_freshness(raw(spark, f"/root/testdata/sf{sf}"), "2024-01-31 00:00:00").first()
    assert r.status == status


def test_gate_and_batch_checks_raise(spark):
    b = bronze(spark, [{"close": None}, {}])
    report = quality.run_suite(b, quality.BRONZE_SUITE, "bronze")
    with pytest.raises(AssertionError):
        quality.gate(report)
    v = quality.validate_batch(b)
    assert v.first().severity == "error"
    with pytest.raises(ValueError):
        quality.check_batch(v)


def test_silver_with_hour_slices_equals_day_slices(spark):
    from barlake.catalog import raw
    r = raw(spark, "/root/testdata/sf0.001")
    a = silver_plan.build_silver(r, updated_at=AS_OF)
    b = silver_plan.build_silver(r, updated_at=AS_OF, lag_slices=("hour", "day"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() == 555


def test_zero_denominators_are_null_not_ansi_errors(spark):
    from barlake.functions.columns import log_return, pct, simple_return_pct
    df = spark.createDataFrame([(5.0, 0.0), (0.0, 2.0), (3.0, None)], "a double, b double")
    rows = df.select(pct("a", "b").alias("p"), simple_return_pct("a", "b").alias("r"),
                     log_return("a", "b").alias("l")).collect()
    assert rows[0].p is None and rows[0].r is None and rows[0].l is None
    assert rows[1].p == 0.0 and rows[1].r == -100.0 and rows[1].l is None      # ln(0) is NULL in Spark
    assert rows[2].p is None


def test_hot_group_of_copies_dedups_to_one_row(spark):
    """A third of the batch is copies of one key: one survivor, the latest."""
    rows = [{"timestamp": ts(1), "close": float(i), "ingestion_timestamp": ts(0, days=i % 50), "id": 1000 + i}
            for i in range(60)]
    rows += [{"timestamp": ts(2 + i)} for i in range(120)]
    b = bronze(spark, rows).repartition(8)
    from barlake.operators.dedup import dedup_latest
    d = dedup_latest(b)
    hot = d.filter(F.col("timestamp") == F.lit(ts(1))).collect()
    assert d.count() == 121 and len(hot) == 1
    assert hot[0].ingestion_timestamp == ts(0, days=49) and hot[0].id == 1049     # the latest
    # first arrival: ids 1000 and 1050 share the earliest time; the lower id wins
    assert writes.first_arrivals(b).filter(F.col("timestamp") == F.lit(ts(1))).first().id == 1000
