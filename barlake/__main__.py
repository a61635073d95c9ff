"""Command line: the operations of the original system on a lake root.

    python -m barlake load    --root LAKE --landing PATH [--format parquet] [--source S] [--expected SYM ...]
    python -m barlake silver  --root LAKE [--mode recompute|carry|reference|full] [--since T] [--slices hour day]
    python -m barlake gold    --root LAKE [--since 'YYYY-MM-DD HH:MM:SS']
    python -m barlake refresh --root LAKE [--mode recompute|carry|full] [--since T]   (silver, then gold, for what was loaded)
    python -m barlake test    --root LAKE --layer bronze|silver|gold [--as-of T] [--gate]
    python -m barlake serve   --root LAKE latest|history|candles|compare|stats|summary [--symbol S] [--days N]

Under spark-submit the cluster's session is used as is (plus UTC / ANSI).
Results are printed whole, one tab-separated line per row, streamed partition
by partition; with --out PATH they are written as Parquet instead.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from barlake.operators import quality, serving
from barlake.operators.layers import read_stored
from barlake.plans import ingest, jobs
from barlake.schema import DEFAULT_COMPARE_DAYS, SOURCE_LIVE, UPSTREAM_SCHEMA
from barlake.session import REQUIRED_CONF
from barlake.sources import landing


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("barlake").getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def _emit(df: DataFrame, name: str, out: str | None) -> None:
    """Every row of a result, to a folder or to standard output."""
    if out:
        df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}")
        return
    print(f"== {name}")
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="barlake")
    p.add_argument("--root", required=True, help="lake root (bronze/, silver/, gold/ below it)")
    sub = p.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load")
    ld.add_argument("--landing", required=True)
    ld.add_argument("--format", default="parquet")
    ld.add_argument("--source", default=SOURCE_LIVE)
    ld.add_argument("--expected", nargs="*", default=None)
    ld.add_argument("--start", default=None, help="first bar time (inclusive)")
    ld.add_argument("--end", default=None, help="bar time to stop before")
    sv = sub.add_parser("silver")
    sv.add_argument("--mode", default=None, choices=["carry", "recompute", "reference", "full"])
    sv.add_argument("--since", default=None, help="recompute: first bar time (or day) to rebuild from")
    sv.add_argument("--slices", nargs="+", default=None, help="LAG slices, e.g. hour day; by row counts if left out")
    rf = sub.add_parser("refresh")
    rf.add_argument("--mode", default=None, choices=["carry", "recompute", "full"])
    rf.add_argument("--since", default=None)
    rf.add_argument("--slices", nargs="+", default=None)
    gd = sub.add_parser("gold")
    gd.add_argument("--since", default=None)
    ts = sub.add_parser("test")
    ts.add_argument("--layer", required=True, choices=["bronze", "silver", "gold"])
    ts.add_argument("--as-of", default=None)
    ts.add_argument("--gate", action="store_true")
    se = sub.add_parser("serve")
    se.add_argument("query", choices=["latest", "history", "candles", "compare", "stats", "summary"])
    se.add_argument("--symbol", default=None)
    se.add_argument("--symbols", nargs="*", default=None)
    se.add_argument("--days", default=None)
    se.add_argument("--as-of", default=None)
    p.add_argument("--out", default=None, help="write results as Parquet below this folder")
    a = p.parse_args(argv)

    spark = _session()
    root = a.root.rstrip("/")
    bronze_path, silver_path, gold_path = f"{root}/bronze", f"{root}/silver", f"{root}/gold"
    as_of = getattr(a, "as_of", None) or _now()

    slices = None if getattr(a, "slices", None) is None else tuple(a.slices)
    pending = f"{root}/_touched"           # (symbol, day) pairs loaded since the last refresh
    if a.cmd == "load":
        landed = landing.read_bars(spark, a.landing, a.format, UPSTREAM_SCHEMA, a.start, a.end)
        if a.expected:
            out = ingest.backfill(spark, landed, bronze_path, a.source, a.expected, ingested_at=_now())
        else:
            out = ingest.ingest_live(spark, landed, bronze_path, _now(), source=a.source)
        out.pop("touched").write.mode("append").parquet(pending)
        for name, df in out.items():
            _emit(df, name, a.out)
    elif a.cmd in ("silver", "refresh"):
        bronze = landing.read_layer(spark, root, "bronze")
        changed = None
        if a.since is None and a.mode in (None, "recompute"):
            changed = read_stored(spark, pending)
            if a.mode == "recompute" and changed is None:
                p.error("--mode recompute needs --since or a load before it")
        if a.cmd == "silver":
            jobs.refresh_silver(spark, bronze, silver_path, mode=a.mode, state_path=f"{root}/_silver_state",
                                lag_slices=slices, since=a.since, changed=changed)
        else:
            done = jobs.refresh_layers(spark, bronze, root, mode=a.mode, since=a.since, changed=changed, lag_slices=slices)
            print("silver and gold " + ("rebuilt" if done is None else f"refreshed: {done.count()} symbol days"))
            if changed is not None:         # only `refresh` brings both layers up to date
                spark.createDataFrame([], changed.schema).write.mode("overwrite").parquet(pending)
    elif a.cmd == "gold":
        if a.since:
            jobs.refresh_gold_since(spark, silver_path, gold_path, a.since)
        else:
            jobs.refresh_gold(spark, silver_path, gold_path)
    elif a.cmd == "test":
        suite = {"bronze": quality.BRONZE_SUITE, "silver": quality.SILVER_SUITE, "gold": quality.GOLD_SUITE}[a.layer]
        df = landing.read_layer(spark, root, a.layer)
        report = quality.run_suite(df, suite, a.layer)
        _emit(report, "tests", a.out)
        if a.layer == "bronze":
            _emit(quality.source_freshness(df, as_of), "freshness", a.out)
        if a.gate:
            quality.gate(report)
    elif a.cmd == "serve":
        gold = landing.read_layer(spark, root, "gold")
        days = None if a.days is None else (int(a.days) if a.days.isdigit() else a.days)
        if a.query == "latest":
            df = serving.latest_prices(gold)
        elif a.query == "history":
            df = serving.price_history(gold, a.symbol, days, as_of)
        elif a.query == "candles":
            df = serving.candles(gold, a.symbol, days, as_of)
        elif a.query == "stats":
            df = serving.period_stats(serving.price_history(gold, a.symbol, days, as_of))
        else:
            sel = a.symbols or serving.default_selection(gold, 3)
            compared = serving.compare_symbols(gold, sel, serving.lookback_days(days or DEFAULT_COMPARE_DAYS), as_of)
            df = compared if a.query == "compare" else serving.performance_summary(compared)
        _emit(df, a.query, a.out)


if __name__ == "__main__":
    main()
