"""The change feed: late rows, emptied slices, repeated and stale epochs."""

import random
from pathlib import Path

import pytest
from bars_data import bronze, ts
from pyspark.sql import functions as F

from barlake.operators.layers import read_stored
from barlake.plans import by_symbol, jobs
from barlake.plans import gold as gold_plan
from barlake.plans import silver as silver_plan
from barlake.schema import BRONZE_SCHEMA
from barlake.streaming import expire_changes, run_gold_stream, run_silver_stream
from barlake.streaming.jobs import apply_changes, write_changes

AS_OF = "2024-01-31 00:00:00"


def loads(spark):
    """Bars of three symbols over days; the later loads hold late rows, one of
    which makes a day's only bar an outlier."""
    rng = random.Random(3)
    rows = [{"symbol": s, "timestamp": ts(rng.randrange(24), days=d), "close": 10 + rng.random(), "open": 10.0, "id": 10 * d + i}
            for d in range(5) for i, s in enumerate(("A", "B", "C")) if (d + i) % 4]
    first = [r for r in rows if r["timestamp"].day < 4]
    second = [r for r in rows if r["timestamp"].day >= 4] + [
        {"symbol": "A", "timestamp": ts(23.5, days=1), "close": 0.01, "open": 0.01, "id": 900}]       # empties A's next day
    third = [{"symbol": s, "timestamp": ts(5.5, days=d), "close": 10.5, "open": 10.0, "id": 950 + d} for d, s in enumerate("ABCAB")]
    return [bronze(spark, x) for x in (first, second, third)]


def gold_of(every):
    g = gold_plan.build_gold(silver_plan.build_silver(every, updated_at=AS_OF), updated_at=AS_OF).drop("updated_at")
    return sorted(map(tuple, g.select(sorted(g.columns)).collect()), key=str)


def stored(spark, path):
    g = spark.read.parquet(path).drop("updated_at")
    return sorted(map(tuple, g.select(sorted(g.columns)).collect()), key=str)


@pytest.mark.parametrize("policy", ["recompute", "carry"])
def test_gold_follows_the_feed(spark, tmp_path, policy):
    p = {k: str(tmp_path / k) for k in ("landing", "silver", "state", "late", "ckpt", "changes", "gold", "gold_state")}
    every = None
    for i, load in enumerate(loads(spark)[:3 if policy == "recompute" else 2]):
        if policy == "carry" and every is not None:        # carry: rows in time order only
            load = load.filter(F.col("timestamp") > F.lit(every.agg(F.max("timestamp")).first()[0]))
        every = load if every is None else every.unionByName(load)
        load.write.parquet(f"{p['landing']}/load={i}")
        for attempt in range(2):
            run_silver_stream(spark, f"{p['landing']}/load={i}", BRONZE_SCHEMA, p["silver"], p["state"], p["late"],
                              f"{p['ckpt']}/{i}-{attempt}", updated_at=AS_OF, policy=policy, first_batch=i,
                              changes_path=p["changes"], table_path=p["landing"])
        run_gold_stream(spark, p["changes"], p["gold"], p["gold_state"], p["ckpt"] + "-gold", updated_at=AS_OF)
        assert stored(spark, p["gold"]) == gold_of(every)
    if policy == "carry":
        return
    want = gold_of(every)
    # a lost checkpoint, one file at a time: epochs come again, old ones after new ones
    run_gold_stream(spark, p["changes"], p["gold"], p["gold_state"], p["ckpt"] + "-again", updated_at=AS_OF, max_files_per_trigger=1)
    assert stored(spark, p["gold"]) == want
    apply_changes(spark, p["changes"], [0], p["gold"], p["gold_state"], AS_OF)            # a stale epoch alone
    assert stored(spark, p["gold"]) == want
    feed = read_stored(spark, p["changes"])
    void, kept = (feed.filter(F.col("change") == c).select("symbol", "day", "epoch").distinct() for c in ("retract", "insert"))
    assert kept.exceptAll(void).isEmpty()
    assert not void.exceptAll(kept).isEmpty()              # an emptied slice is a retraction alone
    expire_changes(spark, p["changes"], 2)
    assert {r.epoch for r in spark.read.parquet(p["changes"]).select("epoch").distinct().collect()} <= {2}


def test_an_epoch_is_written_once(spark, tmp_path):
    silver = str(tmp_path / "silver")
    jobs.refresh_silver(spark, loads(spark)[0], silver, mode="full", updated_at=AS_OF)
    slices = spark.read.parquet(silver).select("symbol", F.col("date").alias("day"))
    for part in (slices, slices.limit(1), slices.limit(0)):
        write_changes(spark, silver, part, 4, str(tmp_path / "changes"))
    feed = spark.read.parquet(str(tmp_path / "changes"))
    assert feed.filter("change = 'insert'").count() == spark.read.parquet(silver).count()


def test_layout_by_symbol_follows_and_opens_few_files(spark, tmp_path):
    root = str(tmp_path / "lake")
    symbols = [f"S{i}-USD" for i in range(40)]
    def made(days, ids):
        return bronze(spark, [{"symbol": s, "timestamp": ts(h, days=d), "close": 10.0 + (d + i) % 5, "id": ids + 100 * d + i}
                              for i, s in enumerate(symbols) for d in days for h in (3,)])
    first, late = made(range(0, 90, 6), 0), made((1, 33, 61), 100_000)
    silver, path = f"{root}/silver", f"{root}/by_symbol"
    jobs.refresh_silver(spark, first, silver, state_path=f"{root}/state", updated_at=AS_OF)
    by_symbol.build(spark, read_stored(spark, silver), path, buckets=16)
    every = first.unionByName(late)
    slices = jobs.refresh_silver(spark, every, silver, state_path=f"{root}/state", updated_at=AS_OF, changed=late)
    by_symbol.refresh(spark, silver, path, slices)
    by_symbol.refresh(spark, silver, path, slices)                          # again: the same
    want = read_stored(spark, silver).drop("date")
    got = spark.read.parquet(path).drop("bucket", "month").select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    one = by_symbol.read_symbols(spark, path, ["S7-USD"])
    assert one.exceptAll(want.filter("symbol = 'S7-USD'").select(*one.columns)).isEmpty() and one.count() == 18
    by_day = read_stored(spark, silver).filter("symbol = 'S7-USD'")
    assert len(one.inputFiles()) <= 3 < 18 <= len(by_day.inputFiles())      # one bucket, three months
    month = by_symbol.read_symbols(spark, path, ["S7-USD"], "2024-02-01 00:00:00", "2024-02-20 00:00:00")
    assert len(month.inputFiles()) == 1 and month.count() == want.filter(
        "symbol = 'S7-USD' and timestamp >= '2024-02-01' and timestamp < '2024-02-20'").count() > 0
    assert by_symbol.read_symbols(spark, path, ["NONE"]).count() == 0


def test_layout_by_symbol_drops_emptied_folders(spark, tmp_path):
    silver, path = str(tmp_path / "silver"), str(tmp_path / "by_symbol")
    b = bronze(spark, [{"symbol": "A", "timestamp": ts(1)}, {"symbol": "A", "timestamp": ts(1, days=40)}])
    jobs.refresh_silver(spark, b, silver, mode="full", updated_at=AS_OF)
    by_symbol.build(spark, read_stored(spark, silver), path, buckets=4)
    gone = read_stored(spark, silver).filter("date > '2024-02-01'").select("symbol", F.col("date").alias("day"))
    gone.write.parquet(str(tmp_path / "gone"))
    jobs.refresh_silver(spark, b.limit(1), silver, mode="full", updated_at=AS_OF)
    by_symbol.refresh(spark, silver, path, spark.read.parquet(str(tmp_path / "gone")))
    assert by_symbol.read_symbols(spark, path, ["A"]).count() == 1 and len(by_symbol.read_symbols(spark, path, ["A"]).inputFiles()) == 1


def files_of(path):
    return {(str(f), f.stat().st_mtime_ns) for f in Path(path).rglob("*.parquet")}


def test_a_finished_batch_is_not_done_again(spark, tmp_path):
    """Repeated with lost checkpoints: silver, the feed and gold keep their files; a lost gold is built again."""
    p = {k: str(tmp_path / k) for k in ("landing", "silver", "state", "late", "ckpt", "changes", "gold", "gold_state")}
    every = None
    for i, load in enumerate(loads(spark)[:2]):
        every = load if every is None else every.unionByName(load)
        load.write.parquet(f"{p['landing']}/load={i}")
        seen = []
        for attempt in range(2):
            run_silver_stream(spark, f"{p['landing']}/load={i}", BRONZE_SCHEMA, p["silver"], p["state"], p["late"],
                              f"{p['ckpt']}/{i}-{attempt}", updated_at=AS_OF, policy="recompute", first_batch=i,
                              changes_path=p["changes"], table_path=p["landing"])
            run_gold_stream(spark, p["changes"], p["gold"], p["gold_state"], f"{p['ckpt']}-gold/{i}-{attempt}", updated_at=AS_OF)
            seen.append([files_of(p[k]) for k in ("silver", "changes", "gold")])
        assert seen[0] == seen[1]
        assert stored(spark, p["gold"]) == gold_of(every)
    run_gold_stream(spark, p["changes"], p["gold"] + "2", p["gold_state"], p["ckpt"] + "-gold2", updated_at=AS_OF)
    assert stored(spark, p["gold"] + "2") == gold_of(every)
