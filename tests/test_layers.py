"""Stored layers: the record of columns, pruned reads, whole replacement, neighbours."""

import os
from datetime import date, timedelta

import pytest
from bars_data import bronze, ts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators import layers, writes
from barlake.plans import jobs
from barlake.session import scratch_path


def rows(spark, days, **more):
    return bronze(spark, [{"timestamp": ts(1, days=d), **more} for d in days]).select("timestamp", "symbol", "close", "volume")


def with_date(df):
    return df.withColumn("date", F.to_date("timestamp"))


def test_columns_evolve_over_three_writes(spark, tmp_path):
    path = str(tmp_path / "silver")
    loads = [rows(spark, [0, 1]).drop("volume").withColumn("n", F.lit(1)),
             rows(spark, [1, 2]).withColumn("n", F.lit(2).cast("long")),
             rows(spark, [3]).withColumn("extra", F.lit("x"))]
    for load in loads:
        jobs.merge_into_layer(spark, load, path)
    version, schema = layers.layer_record(spark, path)
    assert version == 3 and sorted(os.listdir(path + "_schema"))[-1].startswith("v") and schema["n"].dataType == T.LongType()
    got = {r.timestamp: r for r in layers.read_stored(spark, path).collect()}
    assert [got[ts(1, days=d)].n for d in range(4)] == [1, 2, 2, None]
    assert [got[ts(1, days=d)].volume is None for d in range(4)] == [True, False, False, False]
    assert [got[ts(1, days=d)].extra for d in range(4)] == [None, None, None, "x"]
    jobs.merge_into_layer(spark, loads[0], path)             # nothing new: the same version
    assert layers.layer_record(spark, path)[0] == 3


def test_another_type_is_an_error_before_any_write(spark, tmp_path):
    path = str(tmp_path / "silver")
    jobs.merge_into_layer(spark, rows(spark, [0]), path)
    with pytest.raises(ValueError, match="close is stored as double, not string"):
        jobs.merge_into_layer(spark, rows(spark, [0]).withColumn("close", F.lit("a")), path)
    assert [r.close for r in layers.read_stored(spark, path).collect()] == [rows(spark, [0]).first().close]


def test_widening_rules():
    field = lambda t: T.StructType([T.StructField("c", t)])
    merge = lambda a, b: layers.merged_schema(field(a), field(b))["c"].dataType
    assert merge(T.IntegerType(), T.LongType()) == merge(T.LongType(), T.IntegerType()) == T.LongType()
    assert merge(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert merge(T.DecimalType(10, 2), T.DecimalType(20, 2)) == T.DecimalType(20, 2)
    for a, b in ((T.IntegerType(), T.DoubleType()), (T.StringType(), T.DateType()), (T.DecimalType(10, 2), T.DecimalType(20, 8))):
        with pytest.raises(ValueError):
            merge(a, b)


def test_a_read_of_days_lists_their_folders_only(spark, tmp_path):
    path = str(tmp_path / "silver")
    writes.write_layer(with_date(rows(spark, range(20))), path)
    some = layers.read_stored(spark, path, [date(2024, 1, 3), date(2024, 1, 5), date(2030, 1, 1)])
    assert {f.split("date=")[1][:10] for f in some.inputFiles()} == {"2024-01-03", "2024-01-05"}
    assert some.count() == 2 and some.columns == layers.read_stored(spark, path).columns
    assert layers.read_stored(spark, path, [date(2030, 1, 1)]).count() == 0
    assert layers.read_stored(spark, str(tmp_path / "none")) is None
    assert layers.stored_days(spark, path) == [date(2024, 1, 1) + timedelta(d) for d in range(20)]


def test_write_whole_replaces_days_and_columns(spark, tmp_path):
    path = str(tmp_path / "gold")
    writes.write_whole(with_date(rows(spark, [0, 1, 2])), path)
    writes.write_whole(with_date(rows(spark, [2, 3], close=5.0).drop("volume")), path)
    got = layers.read_stored(spark, path)
    assert sorted(r.timestamp for r in got.collect()) == [ts(1, days=2), ts(1, days=3)]
    assert {r.close for r in got.collect()} == {5.0} and "volume" not in got.columns
    writes.write_whole(with_date(rows(spark, [0])).limit(0), path)
    assert layers.read_stored(spark, path).count() == 0 and layers.stored_days(spark, path) == []


def test_no_read_merges_footers():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, names in os.walk(os.path.join(root, "barlake")):
        for n in names:
            if n.endswith(".py"):
                assert "mergeSchema" not in open(os.path.join(folder, n)).read(), n


def test_create_layers_makes_the_folders_and_keeps_what_is_there(spark, tmp_path):
    root = str(tmp_path / "lake")
    paths = writes.create_layers(spark, root)
    assert [os.path.isdir(p) for p in paths] == [True] * 3
    writes.write_layer(with_date(rows(spark, [0])), paths[0])
    writes.create_layers(spark, root)
    assert layers.read_stored(spark, paths[0]).count() == 1


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ABC"), st.integers(0, 40)), min_size=1, max_size=25, unique=True),
       st.lists(st.tuples(st.sampled_from("ABCD"), st.integers(0, 40), st.booleans()), min_size=1, max_size=5,
                unique_by=lambda x: x[:2]), st.booleans())
def test_neighbourhood_holds_each_slices_neighbours(spark, stored, changes, give_newest):
    day = lambda n: date(2024, 1, 1) + timedelta(n)
    path = scratch_path(spark, "test-days")
    frame = lambda r: spark.createDataFrame([(s, day(n), float(n)) for s, n in r], "symbol string, day date, close double")
    writes.write_layer(frame(stored), path, partition_by="day", sort_by=("symbol",))
    touched = frame([c[:2] for c in changes]).select("symbol", "day")
    fresh = frame([c[:2] for c in changes if c[2]])
    newest = frame(stored).groupBy("symbol").agg(F.max("day").alias("day")) if give_newest else None
    got = {(r.symbol, r.day) for r in jobs.neighbourhood(spark, path, "day", touched, fresh, newest).collect()}
    after = ({(s, day(n)) for s, n in stored} - {(s, day(n)) for s, n, _ in changes}) | {(s, day(n)) for s, n, ok in changes if ok}
    assert got <= after
    for s, n, _ in changes:
        mine = sorted(d for x, d in after if x == s)
        before, behind = [d for d in mine if d < day(n)], [d for d in mine if d > day(n)]
        assert not before or (s, before[-1]) in got
        assert not behind or (s, behind[0]) in got


def _loads(spark, late_days):
    bars = lambda days, start, **more: [{"timestamp": ts(start, days=d), "id": 100 * start + d, **more} for d in days]
    first = bars(range(0, 60, 2), 1, symbol="A") + bars(range(1, 60, 5), 1, symbol="B")
    late = bars(late_days, 2, symbol="A", close=11.0) + bars(late_days, 2, symbol="B", close=0.01)
    return bronze(spark, first), bronze(spark, late)


@pytest.mark.parametrize("late_days", [range(3, 50, 4), [21]])
def test_a_recompute_reads_bronze_once_and_stages_no_layer(spark, tmp_path, monkeypatch, late_days):
    reads, staged = [], []
    of_slices, scratch = jobs._of_slices, jobs.scratch_path
    monkeypatch.setattr(jobs, "_of_slices", lambda *a: reads.append(1) or of_slices(*a))
    monkeypatch.setattr(jobs, "scratch_path", lambda s, name: staged.append(name) or scratch(s, name))
    monkeypatch.setattr("barlake.session.scratch_path", lambda s, name: staged.append(name) or scratch(s, name))
    first, late = _loads(spark, late_days)
    root, every = str(tmp_path / "lake"), first.unionByName(late)
    jobs.refresh_layers(spark, first, root, updated_at="2024-04-01")
    staged.clear()
    jobs.refresh_layers(spark, every, root, changed=late, updated_at="2024-04-01")
    assert len(reads) == 1
    assert not {"slices", "silver-known", "gold-known"} & set(staged), staged     # days written straight over the old ones
    looks = 1 if len(late_days) > 1 else 2          # most folders lie around the late days: one look at the state and at gold
    assert staged.count("neighbours") <= 2 * looks
    full = str(tmp_path / "full")
    jobs.refresh_layers(spark, every, full, updated_at="2024-04-01")
    for layer in ("silver", "gold"):
        got, want = (layers.read_stored(spark, f"{r}/{layer}") for r in (root, full))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), layer


def test_replaced_slices_come_from_the_folders_they_replace(spark, tmp_path):
    path = str(tmp_path / "silver")
    writes.write_layer(with_date(rows(spark, [0, 1, 2], symbol="A").unionByName(rows(spark, [1], symbol="B"))), path)
    slices = spark.createDataFrame([("A", date(2024, 1, 1)), ("A", date(2024, 1, 2))], "symbol string, day date")
    fresh = layers.read_stored(spark, path).filter("symbol = 'A' and date = '2024-01-02'").withColumn("close", F.lit(7.0))
    writes.replace_slices(spark, path, fresh, slices)
    got = {(r.symbol, r.date.day, r.close) for r in layers.read_stored(spark, path).collect()}
    assert {(s, d) for s, d, _ in got} == {("A", 2), ("B", 2), ("A", 3)} and ("A", 2, 7.0) in got
    assert layers.stored_days(spark, path) == [date(2024, 1, 2), date(2024, 1, 3)]       # an emptied day has no folder
