"""The two-level LAG equals a plain per-key LAG."""

from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from barlake.operators.sequence import with_previous

T0 = datetime(2024, 1, 1)


def _check(spark, rows, initial=None):
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp, close double")
    init_df = None
    if initial:
        init_df = spark.createDataFrame(initial, "symbol string, timestamp timestamp, close double")
    got = {(r.symbol, r.timestamp): r.prev_close
           for r in with_previous(df, ["symbol"], "timestamp", {"close": "prev_close"},
                                  initial=init_df).collect()}
    base = df if init_df is None else df.unionByName(init_df)
    w = Window.partitionBy("symbol").orderBy("timestamp")
    want = {(r.symbol, r.timestamp): r.p
            for r in base.select("symbol", "timestamp", F.lag("close").over(w).alias("p")).collect()}
    want = {k: v for k, v in want.items() if k in {(r[0], r[1]) for r in rows}}
    assert got == want


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 24 * 9)),
                min_size=1, max_size=60, unique=True))
def test_matches_plain_lag(spark, pts):
    rows = [(s, T0 + timedelta(hours=h), float(h)) for s, h in pts]
    _check(spark, rows)


def test_one_hot_symbol_over_many_days(spark):
    rows = [("HOT", T0 + timedelta(hours=7 * i), float(i)) for i in range(300)]
    rows += [("COLD", T0 + timedelta(days=3), 1.0)]
    _check(spark, rows)


def test_initial_state_continues_the_sequence(spark):
    rows = [("A", T0 + timedelta(days=5, hours=i), float(i)) for i in range(5)]
    _check(spark, rows, initial=[("A", T0 + timedelta(days=1), 99.0), ("B", T0, 1.0)])


def _check_levels(spark, rows, slices):
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp, close double")
    got = {(r.symbol, r.timestamp): r.prev_close
           for r in with_previous(df, ["symbol"], "timestamp", {"close": "prev_close"},
                                  slices=slices).collect()}
    w = Window.partitionBy("symbol").orderBy("timestamp")
    want = {(r.symbol, r.timestamp): r.p
            for r in df.select("symbol", "timestamp", F.lag("close").over(w).alias("p")).collect()}
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 24 * 60 * 4)),
                min_size=1, max_size=80, unique=True))
def test_nested_slices_match_plain_lag(spark, pts):
    rows = [(s, T0 + timedelta(minutes=m), float(m)) for s, m in pts]
    _check_levels(spark, rows, ("hour", "day"))


def test_hot_day_spread_over_hours(spark):
    rows = [("HOT", T0 + timedelta(minutes=3 * i), float(i)) for i in range(480)]
    rows += [("HOT", T0 + timedelta(days=2, minutes=i), float(i)) for i in range(5)]
    _check_levels(spark, rows, ("hour", "day"))
    _check_levels(spark, rows, ("minute", "hour", "day"))


def test_small_keys_need_no_slices(spark):
    from barlake.plans import jobs, silver
    rows = [(s, T0 + timedelta(hours=9 * i), float(i), 1.0) for s in "AB" for i in range(40)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp, close double, volume double")
    days, newest, slices = jobs._summary(spark, df, None)
    assert slices == () and newest.columns == silver.STATE_COLUMNS and newest.count() == 2
    first = spark.createDataFrame([("A", T0 - timedelta(days=3), -1.0)], "symbol string, timestamp timestamp, close double")
    plain, sliced = (with_previous(df, ["symbol"], "timestamp", {"close": "p"}, initial=first, slices=x) for x in ((), ("day",)))
    assert plain.count() == 80 and plain.exceptAll(sliced.select(*plain.columns)).isEmpty()
    assert plain.filter("p is null").count() == 1 and plain.filter("p = -1").count() == 1
