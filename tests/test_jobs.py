"""Jobs on storage and streams: idempotency, merges, late data, formats."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bars_data import bronze, ts
from barlake.operators import layers, serving, writes
from barlake.plans import jobs, ingest
from barlake.plans import silver as silver_plan
from barlake.schema import BRONZE_SCHEMA, UPSTREAM_SCHEMA
from barlake.sources import landing
from barlake.streaming import run_bronze_stream, run_silver_stream
from barlake.streaming.jobs import dedup_stream, _run

AS_OF = "2024-01-31 00:00:00"


def test_csv_landing_read_with_pushdown(spark, tmp_path):
    up = spark.createDataFrame(
        [(None, datetime(2024, 1, 1, h), 1.0 + h, 2.0 + h, 0.5, 1.5 + h, 10.0, sym)
         for h in range(6) for sym in ("BTC-USD", "ETH-USD")], UPSTREAM_SCHEMA)
    for name, frame in (("both", up), ("intraday", up.drop("Date")),
                        ("daily", up.drop("Date").withColumnRenamed("Datetime", "Date"))):
        path = str(tmp_path / name)
        frame.write.option("header", "true").csv(path)
        got = landing.read_bars(spark, path, "csv", start="2024-01-01 02:00:00", end="2024-01-01 05:00:00",
                                symbols=["ETH-USD"])
        plan = got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
        assert "PushedFilters" in plan and "ETH-USD" in plan
        rows = ingest.normalize_upstream(got, source="yahoo_finance_hourly", ingested_at=AS_OF).collect()
        assert sorted(r.timestamp.hour for r in rows) == [2, 3, 4]
        assert {r.symbol for r in rows} == {"ETH-USD"} and rows[0].source == "yahoo_finance_hourly"


def test_require_rows_and_presets(spark):
    with pytest.raises(ValueError):
        landing.require_rows(spark.range(0), "empty")
    assert landing.require_rows(spark.range(2)).count() == 2
    assert serving.lookback_days("ALL") is None and serving.lookback_days("3M") == 90
    assert serving.lookback_days(None) == 30 and serving.lookback_days(12) == 12
    g = spark.createDataFrame([("A",), ("B",)], "symbol string")
    assert serving.filter_symbols(g, ["All"]).count() == 2
    assert serving.filter_symbols(g, ["B"]).count() == 1
    assert serving.filter_symbols(g, None).count() == 2


def test_create_layers(spark, tmp_path):
    paths = writes.create_layers(spark, str(tmp_path))
    assert [os.path.basename(p) for p in paths] == ["bronze", "silver", "gold"] and all(map(os.path.isdir, paths))


def test_json_staging_keeps_microseconds(spark):
    b = bronze(spark, [{"ingestion_timestamp": datetime(2024, 1, 1, 1, 2, 3, 456789)}])
    back = writes.unstage_records(writes.stage_records(b), BRONZE_SCHEMA).first()
    assert back.ingestion_timestamp == datetime(2024, 1, 1, 1, 2, 3, 456789)


def test_merge_appends_new_columns_and_touches_only_new_dates(spark, tmp_path):
    path = str(tmp_path / "silver")
    old = bronze(spark, [{"timestamp": ts(1, days=0)}, {"timestamp": ts(1, days=1)}]).select("timestamp", "symbol", "close")
    jobs.merge_into_layer(spark, old, path)
    before = {p for p in os.listdir(path) if p.startswith("date=")}
    new = bronze(spark, [{"timestamp": ts(1, days=1), "close": 99.0}, {"timestamp": ts(1, days=2)}]) \
        .select("timestamp", "symbol", "close", F.lit(7).alias("extra"))
    jobs.merge_into_layer(spark, new, path)
    got = {r.timestamp: r for r in layers.read_stored(spark, path).collect()}
    assert len(got) == 3
    assert got[ts(1, days=1)].close == 99.0 and got[ts(1, days=1)].extra == 7
    assert got[ts(1, days=0)].extra is None
    assert before < {p for p in os.listdir(path) if p.startswith("date=")}


def test_bronze_stream_retry_without_progress_adds_nothing(spark, tmp_path):
    b = bronze(spark, [{"timestamp": ts(h)} for h in range(5)] + [{"timestamp": ts(1), "close": 3.0}])
    land, out = str(tmp_path / "landing"), str(tmp_path / "bronze")
    b.write.parquet(land)
    run_bronze_stream(spark, land, BRONZE_SCHEMA, out, str(tmp_path / "ckpt1"))
    first = spark.read.parquet(out).count()
    run_bronze_stream(spark, land, BRONZE_SCHEMA, out, str(tmp_path / "ckpt2"))   # lost checkpoint: replay
    assert first == 5 and spark.read.parquet(out).count() == 5


def test_silver_stream_reports_late_rows(spark, tmp_path):
    land = str(tmp_path / "landing")
    p = {k: str(tmp_path / k) for k in ("silver", "state", "late", "ckpt")}
    bronze(spark, [{"timestamp": ts(h), "close": 10.0 + h} for h in range(1, 6)]).write.parquet(land)
    run_silver_stream(spark, land, BRONZE_SCHEMA, p["silver"], p["state"], p["late"], p["ckpt"], updated_at=AS_OF)
    bronze(spark, [{"timestamp": ts(3), "id": 50, "close": 11.0},
                   {"timestamp": ts(7), "id": 51, "close": 12.0}]).write.mode("append").parquet(land)
    run_silver_stream(spark, land, BRONZE_SCHEMA, p["silver"], p["state"], p["late"], p["ckpt"], updated_at=AS_OF)
    silver = spark.read.parquet(p["silver"]).drop("date").orderBy("timestamp").collect()
    assert [r.timestamp for r in silver] == [ts(h) for h in (1, 2, 3, 4, 5, 7)]
    assert silver[-1].simple_return_pct == pytest.approx((12.0 - 15.0) / 15.0 * 100)   # carried across batches
    late = spark.read.parquet(p["late"]).collect()
    assert [(r.timestamp, r.id) for r in late] == [(ts(3), 50)]


def test_dedup_stream_first_wins_within_watermark(spark, tmp_path):
    land, out = str(tmp_path / "landing"), str(tmp_path / "out")
    bronze(spark, [{"timestamp": ts(1)}, {"timestamp": ts(2)}]).write.parquet(land)
    bronze(spark, [{"timestamp": ts(1), "id": 9}, {"timestamp": ts(3)}]).write.mode("append").parquet(land)
    s = dedup_stream(spark.readStream.schema(BRONZE_SCHEMA).parquet(land))
    _run(s.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", str(tmp_path / "ckpt")).outputMode("append"))
    got = sorted(r.timestamp for r in spark.read.parquet(out).collect())
    assert got == [ts(1), ts(2), ts(3)]


def test_reference_job_and_carry_job_differ_only_at_the_boundary(spark, tmp_path):
    b = bronze(spark, [{"close": 10.0}, {"close": 11.0}, {"close": 30.0}, {"close": 12.0}])
    part1 = b.filter(F.col("timestamp") < F.lit(ts(2.5)))
    ref, car = str(tmp_path / "ref"), str(tmp_path / "car")
    for load in (part1, b):
        jobs.refresh_silver(spark, load, ref, mode="reference", updated_at=AS_OF)
        jobs.refresh_silver(spark, load, car, mode="carry", state_path=str(tmp_path / "st"), updated_at=AS_OF)
    closes = lambda p: [r.close for r in spark.read.parquet(p).orderBy("timestamp").collect()]
    assert closes(ref) == [10.0, 11.0, 30.0, 12.0]       # boundary outlier escapes
    assert closes(car) == [10.0, 11.0, 12.0]              # equals a full refresh
    full = [r.close for r in silver_plan.build_silver(b, updated_at=AS_OF).orderBy("timestamp").collect()]
    assert closes(car) == full


@pytest.mark.parametrize("since", ["2024-01-20 00:00:00", "2024-01-20 13:30:00", "2024-01-02 05:00:00"])
def test_gold_since_equals_full_build_for_those_days(spark, since):
    from barlake.catalog import silver
    from barlake.plans import gold as gold_plan
    s = silver(spark, "/root/testdata/sf0.001")
    full = gold_plan.build_gold(s, updated_at=AS_OF)
    day = F.to_date(F.lit(since))
    part = gold_plan.build_gold_since(s, full.filter(F.col("date") < day), since, updated_at=AS_OF)
    want = full.filter(F.col("date") >= day)
    assert part.count() == want.count() > 0
    assert part.exceptAll(want).count() == 0


def test_command_line_runs_the_layers(spark, tmp_path, capsys):
    from barlake.__main__ import main
    from barlake.catalog import AS_OF as Q_AS_OF
    from barlake.sources import fixtures
    up = fixtures.upstream_bars(fixtures.load_table(spark, "/root/testdata/sf0.001", "events"))
    up.withColumn("Datetime", F.col("Datetime").cast("timestamp")).write.parquet(str(tmp_path / "landing"))
    root = str(tmp_path / "lake")
    main(["--root", root, "load", "--landing", str(tmp_path / "landing"), "--source", "yahoo_finance_hourly",
          "--expected", "CLICK-USD", "VIEW-USD", "ERROR-USD", "PURCHASE-USD", "SIGNUP-USD"])
    main(["--root", root, "silver"])
    main(["--root", root, "gold"])
    main(["--root", root, "test", "--layer", "silver", "--gate"])
    main(["--root", root, "serve", "latest"])
    out = capsys.readouterr().out
    assert "inserted" in out and "PURCHASE-USD" in out
    from barlake.plans import gold as gold_plan
    bronze_ = spark.read.parquet(root + "/bronze")
    assert bronze_.count() == bronze_.select("timestamp", "symbol").distinct().count()   # one source, first wins
    want = gold_plan.build_gold(silver_plan.build_silver(bronze_)).drop("updated_at")
    got = spark.read.parquet(root + "/gold").drop("updated_at").select(*want.columns)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    assert Q_AS_OF.startswith("2024-01-31")


def test_recompute_repairs_late_rows_that_carry_and_reference_drop(spark, tmp_path):
    b = bronze(spark, [{"timestamp": ts(h), "close": 10.0 + h} for h in (1, 2, 30, 31, 54)])
    late = bronze(spark, [{"timestamp": ts(3), "id": 90, "close": 40.0},       # outlier on day 0
                          {"timestamp": ts(29), "id": 91, "close": 41.0}])     # day 1
    every = b.unionByName(late)
    full = sorted((r.timestamp, r.close, r.simple_return_pct)
                  for r in silver_plan.build_silver(every, updated_at=AS_OF).collect())
    outs = {}
    for mode in ("carry", "recompute"):
        path, st = str(tmp_path / mode), str(tmp_path / f"{mode}-state")
        jobs.refresh_silver(spark, b, path, mode=mode, state_path=st, updated_at=AS_OF)
        jobs.refresh_silver(spark, every, path, mode=mode, state_path=st, updated_at=AS_OF, changed=late)
        outs[mode] = sorted((r.timestamp, r.close, r.simple_return_pct)
                            for r in spark.read.parquet(path).collect())
    assert outs["recompute"] == full
    assert outs["carry"] != full and len(outs["carry"]) == 4    # late rows dropped (hour 30 is an outlier)


def test_empty_or_missing_layers_read_as_empty_frames(spark, tmp_path):
    root = str(tmp_path / "lake")
    for layer in ("bronze", "silver", "gold"):
        df = landing.read_layer(spark, root, layer)
        assert df.count() == 0 and "date" in df.columns and "symbol" in df.columns
    g = landing.read_layer(spark, root, "gold")
    assert serving.latest_prices(g).count() == 0
    assert set(gold_cols := g.columns) >= {"daily_return_pct", "log_return", "data_points"}, gold_cols


@pytest.mark.parametrize("mode", ["carry", "recompute"])
def test_refresh_layers_keeps_gold_equal_to_a_full_build(spark, tmp_path, mode):
    from barlake.catalog import raw
    from barlake.plans import gold as gold_plan
    r = raw(spark, "/root/testdata/sf0.001")
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp")
    first, second = r.filter(F.col("timestamp") < cut), r.filter(F.col("timestamp") >= cut)
    if mode == "recompute":      # a late backfill: one source arrives after the rest
        first, second = r.filter(F.col("source") == "yahoo_finance"), r.filter(F.col("source") != "yahoo_finance")
    root = str(tmp_path / "lake")
    assert jobs.refresh_layers(spark, first, root, mode=mode, updated_at=AS_OF) is None     # first run: full
    day = jobs.refresh_layers(spark, r, root, mode=mode, changed=second, updated_at=AS_OF)
    assert day is not None
    want = gold_plan.build_gold(silver_plan.build_silver(r, updated_at=AS_OF), updated_at=AS_OF).drop("updated_at")
    got = spark.read.parquet(root + "/gold").drop("updated_at").select(*want.columns)
    assert got.count() == want.count() == 148 and got.exceptAll(want).count() == 0


def test_command_line_refresh_after_a_second_load(spark, tmp_path, capsys):
    from barlake.__main__ import main
    from barlake.plans import gold as gold_plan
    from barlake.catalog import raw
    r = raw(spark, "/root/testdata/sf0.001")
    root = str(tmp_path / "lake")
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp")
    writes.write_layer(r.filter(F.col("timestamp") < cut).withColumn("date", F.to_date("timestamp")), root + "/bronze")
    main(["--root", root, "refresh"])
    writes.write_layer(r.filter(F.col("timestamp") >= cut).withColumn("date", F.to_date("timestamp")), root + "/bronze",
                       mode="append")
    main(["--root", root, "refresh"])
    assert "symbol days" in capsys.readouterr().out
    want = gold_plan.build_gold(silver_plan.build_silver(r)).drop("updated_at")
    got = spark.read.parquet(root + "/gold").drop("updated_at").select(*want.columns)
    assert got.count() == want.count() == 148 and got.exceptAll(want).count() == 0


def test_broken_lines_and_wrong_types_go_to_quarantine(spark, tmp_path):
    from barlake.plans import ingest
    land, out = tmp_path / "landing", str(tmp_path / "bronze")
    land.mkdir()
    good = '{"Date":"2024-01-01T00:00:00Z","Open":1.0,"High":2.0,"Low":0.5,"Close":1.5,"Volume":3.0,"symbol":"%s"}'
    lines = [good % f"S{i}" for i in range(6)] + ['{"Date":"2024-01-02T0', good.replace("1.0", '"abc"', 1) % "S1",
                                                 good.replace("2024-01-01", "2024-01-03").replace("1.5", "1e13") % "S2"]
    (land / "a.json").write_text("\n".join(lines))
    bars_ = landing.read_bars(spark, str(land), "json")
    report = ingest.ingest_live(spark, bars_, out, "2024-01-04 00:00:00")
    s = report["stats"].first()
    assert (s.inserted, s.duplicates, s.failed, s.total) == (6, 0, 3, 9)
    bad = spark.read.parquet(out + "_quarantine").collect()
    assert sorted(r.reason for r in bad) == ["close overflows decimal(20,8)", "corrupt record", "corrupt record"]
    assert {r.corrupt_record for r in bad if r.reason == "corrupt record"} == {lines[6], lines[7]}
    again = ingest.ingest_live(spark, bars_, out, "2024-01-04 01:00:00")["stats"].first()
    assert (again.inserted, again.duplicates, again.failed) == (0, 6, 3)
    assert spark.read.parquet(out).select("id").distinct().count() == 6


@pytest.mark.parametrize("fail_at", [2, 5, 8, 10])
def test_silver_stream_survives_a_failure_between_two_writes(spark, tmp_path, monkeypatch, fail_at):
    from pyspark.sql.readwriter import DataFrameWriter
    land = str(tmp_path / "landing")
    p = {k: str(tmp_path / k) for k in ("silver", "state", "late", "ckpt", "feed")}

    def run():
        run_silver_stream(spark, land, BRONZE_SCHEMA, p["silver"], p["state"], p["late"], p["ckpt"], updated_at=AS_OF,
                          feed_path=p["feed"])

    first = bronze(spark, [{"timestamp": ts(h), "close": 10.0 + h / 10, "id": h} for h in range(1, 5)])
    first.write.parquet(land)
    run()
    second = bronze(spark, [{"timestamp": ts(2), "id": 50, "close": 11.0}] +
                    [{"timestamp": ts(h), "close": 10.0 + h / 10, "id": h} for h in (5, 6, 30)])
    second.write.mode("append").parquet(land)
    write, calls = DataFrameWriter.parquet, []

    def failing(self, *args, **kwargs):
        calls.append(1)
        if len(calls) == fail_at:
            raise RuntimeError("lost")
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(Exception, match="lost"):
        run()
    run()
    rows = sorted((r.timestamp, r.close, r.simple_return_pct) for r in spark.read.parquet(p["silver"]).collect())
    every = first.unionByName(second.filter("id <> 50"))
    assert rows == sorted((r.timestamp, r.close, r.simple_return_pct)
                          for r in silver_plan.build_silver(every, updated_at=AS_OF).collect())
    assert [r.id for r in spark.read.parquet(p["late"]).collect()] == [50]
    assert sorted(r.timestamp for r in spark.read.parquet(p["feed"]).collect()) == [r[0] for r in rows]
