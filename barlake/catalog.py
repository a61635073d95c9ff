"""Registered queries: one per operator family of the survey's inventory.

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with the
DuckDB SQL that must give the same rows on the same parquet tables (or no
SQL, for the few checked by row count only).  All inputs derive from the
driver's `events` table through the fixture `raw` (FIXTURES.md), so every
query's work grows with the tables.

Clock columns (`updated_at`) are left out of compared results; silver log
returns are compared rounded to 10 digits (the two engines' `ln` differ in
the last bit).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake import oracle
from barlake.functions.columns import round_half_up
from barlake.operators import bars, quality, serving, writes
from barlake.operators.dedup import dedup_latest
from barlake.plans import gold as gold_plan
from barlake.plans import ingest
from barlake.plans import silver as silver_plan
from barlake.schema import CORRUPT, SOURCE_DAILY, SOURCE_HOURLY, SOURCE_LIVE
from barlake.sources import fixtures, landing

# Parameters of the registered queries (FIXTURES.md: fixed clock and cut).
AS_OF = "2024-01-31 00:00:00"
CUT = "2024-01-20 00:00:00"
HISTORY_SYMBOL = "CLICK-USD"
CANDLE_SYMBOL = "VIEW-USD"
SELECTED = ["CLICK-USD", "VIEW-USD"]
EXPECTED_SYMBOLS = ["BTC-USD", "CLICK-USD", "ERROR-USD", "ETH-USD", "PURCHASE-USD", "SIGNUP-USD", "VIEW-USD"]
RANGE_START, RANGE_END = "2024-01-10 00:00:00", "2024-01-20 00:00:00"

Q = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    run: Q
    sql: str | None
    ops: str


REGISTRY: dict[str, Entry] = {}


def register(name: str, ops: str, sql: str | None):
    def deco(fn: Q) -> Q:
        REGISTRY[name] = Entry(fn, sql, ops)
        return fn
    return deco


# ---------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------
def raw(spark, d) -> DataFrame:
    return fixtures.raw_from_dir(spark, d)


def silver(spark, d) -> DataFrame:
    return silver_plan.build_silver(raw(spark, d), updated_at=AS_OF)


def gold(spark, d) -> DataFrame:
    return gold_plan.build_gold(silver(spark, d), updated_at=AS_OF)


def silver_cmp(df: DataFrame) -> DataFrame:
    return df.drop("updated_at").withColumn("log_return", round_half_up("log_return", 10))


def _cmp_sql(src: str) -> str:
    return f"SELECT * REPLACE ({oracle.r('log_return', 10)} AS log_return) FROM {src}"


S = oracle.sql
TS_AS_OF = f"TIMESTAMP '{AS_OF}'"
TS_CUT = f"TIMESTAMP '{CUT}'"
RAW_COLS = 'id, "timestamp", symbol, open, high, low, close, volume, source, ingestion_timestamp'
GOLD_NO_CLOCK = [c for c in gold_plan.GOLD_COLUMNS if c != "updated_at"]


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# ---------------------------------------------------------------------------
# bronze: normalise, type, load
# ---------------------------------------------------------------------------
@register("bronze_typed", "P01 P02 P03 P04 P07 P08",
          S("raw", f"""SELECT "timestamp", symbol,
  CAST(open AS DECIMAL(20,8)) AS open, CAST(high AS DECIMAL(20,8)) AS high,
  CAST(low AS DECIMAL(20,8)) AS low, CAST(close AS DECIMAL(20,8)) AS close,
  CAST(volume AS DECIMAL(20,2)) AS volume, 'yahoo_finance' AS source, {TS_AS_OF} AS ingestion_timestamp
FROM raw"""))
def q_bronze_typed(spark, d):
    up = fixtures.upstream_bars(fixtures.load_table(spark, d, "events"))
    return ingest.bronze_typed(ingest.normalize_upstream(up, source=None, ingested_at=AS_OF))


_FIRSTS = f"""firsts AS (
  SELECT {RAW_COLS} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY "timestamp", symbol, source
                                 ORDER BY ingestion_timestamp ASC NULLS LAST, id ASC NULLS LAST) AS rn
    FROM raw) WHERE rn = 1
)"""
_INSERTED = f"""inserted AS (
  SELECT f.* FROM firsts f
  WHERE NOT EXISTS (SELECT 1 FROM raw t WHERE t.ingestion_timestamp < {TS_CUT}
                    AND t."timestamp" = f."timestamp" AND t.symbol = f.symbol AND t.source = f.source)
)"""


def _insert_case(spark, d):
    r = raw(spark, d)
    target = r.filter(F.col("ingestion_timestamp") < F.lit(CUT).cast("timestamp"))
    return r, writes.insert_if_absent(r, target)


@register("bronze_insert_if_absent", "K01 J02", S("raw", "SELECT * FROM inserted", [_FIRSTS, _INSERTED]))
def q_insert_if_absent(spark, d):
    return _insert_case(spark, d)[1]


def _dirty(spark, d) -> DataFrame:
    return fixtures.dirty_bars(raw(spark, d))


_GOOD_FIRSTS = """good_firsts AS (
  SELECT DISTINCT ON ("timestamp", symbol, source) * FROM good ORDER BY "timestamp", symbol, source, ingestion_timestamp, id
)"""


@register("bronze_load_stats", "K02 K03", S("raw", f"""SELECT count_if(fresh) AS inserted,
  (SELECT count(*) FROM good) - count_if(fresh) AS duplicates,
  (SELECT count(*) FROM dirty) - (SELECT count(*) FROM good) AS failed, (SELECT count(*) FROM dirty) AS total
FROM (SELECT ingestion_timestamp >= {TS_CUT} AS fresh FROM good_firsts)""", [oracle.DIRTY, oracle.GOOD, _GOOD_FIRSTS]))
def q_load_stats(spark, d):
    good, bad = writes.split_bad_records(_dirty(spark, d))
    target = good.filter(F.col("ingestion_timestamp") < F.lit(CUT).cast("timestamp"))
    return writes.load_stats(_dirty(spark, d), writes.insert_if_absent(good, target), bad)


@register("bronze_bad_records", "K03 T09", S("raw", """SELECT id, "timestamp", symbol, source, reason FROM (
  SELECT *, CASE WHEN length(symbol) > 20 THEN 'symbol too long' WHEN isnan(close) THEN 'close is NaN'
                 WHEN close >= 1e12 THEN 'close overflows decimal(20,8)' END AS reason FROM dirty)
WHERE reason IS NOT NULL""", [oracle.DIRTY]))
def q_bad_records(spark, d):
    return writes.split_bad_records(_dirty(spark, d))[1].select("id", "timestamp", "symbol", "source", "reason")


def _two_loads(spark, d) -> str:
    """Bronze after two loads of rows without ids, split at CUT."""
    path = _stream_dirs(spark, "bronze-two-loads")["out"]
    batch = _dirty(spark, d).drop("id")
    cut = F.lit(CUT).cast("timestamp")
    for part in (batch.filter(F.col("ingestion_timestamp") < cut), batch.filter(F.col("ingestion_timestamp") >= cut)):
        writes.load_bronze(spark, part, path)
    return path


@register("bronze_load_job", "K01 K02 K03 J02", S("raw", """SELECT "timestamp", symbol, open, high, low, close, volume,
  source, ingestion_timestamp FROM good_firsts""", [oracle.DIRTY, oracle.GOOD, _GOOD_FIRSTS]))
def q_load_job(spark, d):
    return spark.read.parquet(_two_loads(spark, d)).drop("id", "date")


@register("bronze_quarantine", "K03 T09", S("raw", """SELECT reason, count(*) AS n_rows FROM (
  SELECT CASE WHEN length(symbol) > 20 THEN 'symbol too long' WHEN isnan(close) THEN 'close is NaN'
              ELSE 'close overflows decimal(20,8)' END AS reason FROM dirty WHERE id NOT IN (SELECT id FROM good))
GROUP BY reason""", [oracle.DIRTY, oracle.GOOD]))
def q_quarantine(spark, d):
    bad = spark.read.parquet(_two_loads(spark, d) + "_quarantine")
    return bad.groupBy("reason").agg(F.count("*").alias("n_rows"))


@register("surrogate_ids", "P09", S("raw", """SELECT count(*) AS n_rows, count(*) AS n_ids, true AS positive
FROM good_firsts""", [oracle.DIRTY, oracle.GOOD, _GOOD_FIRSTS]))
def q_surrogate_ids(spark, d):
    return spark.read.parquet(_two_loads(spark, d)).agg(
        F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids"), (F.min("id") >= 1).alias("positive"))


@register("json_stage_roundtrip", "K08 P05", S("raw", "SELECT * FROM raw"))
def q_json_roundtrip(spark, d):
    r = raw(spark, d)
    return writes.unstage_records(writes.stage_records(r), r.schema)


@register("flatten_header", "P06", S("raw", 'SELECT "timestamp", symbol, open, high, low, close, volume FROM raw'))
def q_flatten(spark, d):
    r = raw(spark, d)
    nested = r.select("timestamp", "symbol", F.struct("open", "high", "low", "close", "volume").alias("Price"))
    return landing.flatten_columns(nested, "Price")


@register("union_sources", "U01", S("raw", f"""
SELECT {RAW_COLS} FROM raw WHERE source = 'yahoo_finance'
UNION ALL
SELECT id, "timestamp", symbol, open, high, low, close, volume, source, CAST(NULL AS TIMESTAMP) AS ingestion_timestamp
FROM raw WHERE source <> 'yahoo_finance'"""))
def q_union_sources(spark, d):
    r = raw(spark, d)
    live = r.filter(F.col("source") == SOURCE_LIVE)
    backfill = r.filter(F.col("source") != SOURCE_LIVE).drop("ingestion_timestamp")
    return live.unionByName(backfill, allowMissingColumns=True)


@register("time_range_scan", "S02", S("raw", f"""SELECT * FROM raw
WHERE "timestamp" >= TIMESTAMP '{RANGE_START}' AND "timestamp" < TIMESTAMP '{RANGE_END}'"""))
def q_time_range(spark, d):
    return landing.time_range(raw(spark, d), RANGE_START, RANGE_END)


@register("missing_symbols", "S03 S04", S("raw", f"""SELECT symbol FROM (VALUES {", ".join(f"('{s}')" for s in EXPECTED_SYMBOLS)}) t(symbol)
WHERE symbol NOT IN (SELECT symbol FROM raw WHERE symbol IN ({_in(EXPECTED_SYMBOLS)}))"""))
def q_missing(spark, d):
    tracked = landing.only_symbols(raw(spark, d), EXPECTED_SYMBOLS)
    return landing.missing_symbols(tracked, EXPECTED_SYMBOLS)


# ---------------------------------------------------------------------------
# bronze checks and counts
# ---------------------------------------------------------------------------
@register("batch_validation", "A08 A15", S("raw", """SELECT count(*) AS total_records,
  count(DISTINCT symbol) AS symbols_found, min("timestamp") AS date_range_start,
  max("timestamp") AS date_range_end, count_if(close IS NULL) AS null_prices,
  count_if(close < 0) AS negative_prices,
  CASE WHEN count(DISTINCT symbol) < 5 THEN 'error' WHEN count(*) < 1000 THEN 'warn' ELSE 'ok' END AS severity
FROM raw"""))
def q_validation(spark, d):
    return quality.validate_batch(raw(spark, d))


@register("critical_nulls", "A09 A10", S("raw", """SELECT * , value > 0 AS is_issue FROM (
  SELECT 'nulls_timestamp' AS "check", count_if("timestamp" IS NULL) AS value FROM raw
  UNION ALL SELECT 'nulls_symbol', count_if(symbol IS NULL) FROM raw
  UNION ALL SELECT 'nulls_close', count_if(close IS NULL) FROM raw
  UNION ALL SELECT 'nulls_volume', count_if(volume IS NULL) FROM raw
  UNION ALL SELECT 'negative_close', count_if(close < 0) FROM raw)"""))
def q_critical_nulls(spark, d):
    return quality.batch_issues(raw(spark, d))


@register("coverage_by_source", "A04 F08", S("raw", f"""SELECT symbol, count(*) AS record_count,
  min("timestamp") AS earliest, max("timestamp") AS latest
FROM raw WHERE source = '{SOURCE_DAILY}' GROUP BY symbol ORDER BY symbol"""))
def q_coverage(spark, d):
    return quality.coverage(raw(spark, d), SOURCE_DAILY)


@register("count_by_source", "A05", S("raw", "SELECT source, count(*) AS total_records FROM raw GROUP BY source"))
def q_count_by_source(spark, d):
    return quality.count_by(raw(spark, d), "source")


@register("count_by_symbol", "A06", S("silver", "SELECT symbol, count(*) AS records FROM silver GROUP BY symbol"))
def q_count_by_symbol(spark, d):
    return quality.count_by(silver(spark, d), "symbol", "records")


@register("gold_coverage", "A06", S("gold", """SELECT symbol, count(*) AS daily_records,
  min(date) AS earliest_date, max(date) AS latest_date FROM gold GROUP BY symbol ORDER BY symbol"""))
def q_gold_coverage(spark, d):
    return quality.gold_coverage(gold(spark, d))


@register("total_rows", "A07", S("raw", "SELECT count(*) AS total_rows FROM raw"))
def q_total_rows(spark, d):
    return quality.total_rows(raw(spark, d))


@register("latest_bar_per_symbol", "A14", S("raw", 'SELECT symbol, max("timestamp") AS latest_timestamp FROM raw GROUP BY symbol'))
def q_latest_bar(spark, d):
    return quality.latest_bar_per_symbol(raw(spark, d))


def _age(ts: str) -> str:
    return f"CAST(epoch_us({TS_AS_OF}) - epoch_us({ts}) AS DOUBLE) / CAST(60000000 AS DOUBLE)"


@register("freshness", "A03 F09 P23 P22", S("raw", f"""SELECT latest_timestamp, record_count, symbol_count,
  {_age("latest_timestamp")} AS age_minutes,
  CASE WHEN record_count = 0 THEN 'empty' WHEN {_age("latest_timestamp")} > 90 THEN 'stale' ELSE 'fresh' END AS status
FROM (SELECT max("timestamp") AS latest_timestamp, count(*) AS record_count, count(DISTINCT symbol) AS symbol_count
      FROM raw WHERE "timestamp" > {TS_AS_OF} - INTERVAL '2 hours')"""))
def q_freshness(spark, d):
    return quality.freshness(raw(spark, d), AS_OF)


@register("source_freshness", "T05", S("raw", f"""SELECT max_loaded_at, {_age("max_loaded_at")} AS age_minutes,
  CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN {_age("max_loaded_at")} > 60 THEN 'error'
       WHEN {_age("max_loaded_at")} > 30 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max(ingestion_timestamp) AS max_loaded_at FROM raw)"""))
def q_source_freshness(spark, d):
    return quality.source_freshness(raw(spark, d), AS_OF)


def _suite_sql(table: str, layer: str, suite: list[quality.Test]) -> str:
    """Each test is a failing-rows query; failures = its row count."""
    parts = []
    for t in suite:
        c = f'"{t.column}"'
        where = f" AND ({t.where})" if t.where else ""
        if t.kind == "not_null":
            q = f"SELECT * FROM {table} WHERE {c} IS NULL{where}"
        elif t.kind == "unique":
            key = ", ".join(f'"{k}"' for k in t.column.split(","))
            full = " AND ".join(f'"{k}" IS NOT NULL' for k in t.column.split(","))
            q = f"SELECT {key} FROM {table} WHERE {full}{where} GROUP BY {key} HAVING count(*) > 1"
        elif t.kind == "accepted_range":
            lo, hi, inc = t.params.get("min_value"), t.params.get("max_value"), t.params.get("inclusive", True)
            conds = []
            if lo is not None:
                conds.append(f"{c} {'>=' if inc else '>'} {lo}")
            if hi is not None:
                conds.append(f"{c} {'<=' if inc else '<'} {hi}")
            q = f"SELECT * FROM {table} WHERE NOT ({' AND '.join(conds)}){where}"
        elif t.kind == "accepted_values":
            q = (f"SELECT {c} FROM {table} WHERE {c} NOT IN ({_in(t.params['values'])}){where} GROUP BY {c}")
        elif t.kind == "max_length":
            q = f"SELECT * FROM {table} WHERE length({c}) > {t.params['length']}{where}"
        parts.append(f"SELECT '{layer}' AS layer, '{t.column}' AS column_name, '{t.kind}' AS test, "
                     f"(SELECT count(*) FROM ({q})) AS failures")
    body = "\nUNION ALL ".join(parts)
    return f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({body})"


@register("bronze_constraints", "T09 K09", S("raw", _suite_sql("raw", "bronze", quality.BRONZE_CONSTRAINTS)))
def q_constraints(spark, d):
    return quality.run_suite(raw(spark, d), quality.BRONZE_CONSTRAINTS, "bronze")


@register("quality_bronze", "T01 T02 T03 T04 T07", S("raw", _suite_sql("raw", "bronze", quality.BRONZE_SUITE)))
def q_quality_bronze(spark, d):
    return quality.run_suite(raw(spark, d), quality.BRONZE_SUITE, "bronze")


_SILVER_STAMPED = f"silver_t AS (SELECT *, {TS_AS_OF} AS updated_at FROM silver)"
_GOLD_STAMPED = f"gold_t AS (SELECT *, {TS_AS_OF} AS updated_at FROM gold)"


@register("quality_silver", "T01 T02 T03 T07", S("silver", _suite_sql("silver_t", "silver", quality.SILVER_SUITE), [_SILVER_STAMPED]))
def q_quality_silver(spark, d):
    return quality.run_suite(silver(spark, d), quality.SILVER_SUITE, "silver")


@register("quality_gold", "T01 T03 T07", S("gold", _suite_sql("gold_t", "gold", quality.GOLD_SUITE), [_GOLD_STAMPED]))
def q_quality_gold(spark, d):
    return quality.run_suite(gold(spark, d), quality.GOLD_SUITE, "gold")


@register("quality_gate_silver", "T08 T07", S("silver", _suite_sql("silver_t", "silver", quality.SILVER_SUITE), [_SILVER_STAMPED]))
def q_quality_gate(spark, d):
    return quality.gate(quality.run_suite(silver(spark, d), quality.SILVER_SUITE, "silver"))


@register("unique_key_violations", "T06 T02", S("raw", """SELECT "timestamp", symbol, count(*) AS n_records
FROM raw WHERE "timestamp" IS NOT NULL AND symbol IS NOT NULL GROUP BY "timestamp", symbol HAVING count(*) > 1"""))
def q_unique_key(spark, d):
    return quality.unique_violations(raw(spark, d), ["timestamp", "symbol"])


@register("accepted_values_violations", "T04", S("raw", f"""SELECT source, count(*) AS n_records FROM raw
WHERE source IS NOT NULL AND source NOT IN ({_in(quality.ACCEPTED_SOURCES)}) GROUP BY source"""))
def q_accepted_values(spark, d):
    t = quality.Test("source", "accepted_values", {"values": quality.ACCEPTED_SOURCES})
    return quality.failing_rows(raw(spark, d), t)


# ---------------------------------------------------------------------------
# silver
# ---------------------------------------------------------------------------
@register("silver_dedup", "W01 F02", S("newest", "SELECT * FROM newest"))
def q_silver_dedup(spark, d):
    return dedup_latest(raw(spark, d))


@register("silver_repaired", "P10 P11 P12 F03", S("usable", "SELECT * FROM usable"))
def q_silver_repaired(spark, d):
    return silver_plan.validated(raw(spark, d))


@register("silver_returns", "P13 P14 P15 P16 P17 W03 W04", S("moves", _cmp_sql("moves")))
def q_silver_returns(spark, d):
    x = silver_plan.with_returns(silver_plan.validated(raw(spark, d)))
    return x.withColumn("log_return", round_half_up("log_return", 10))


@register("silver_full", "C03 F04 P20 P21", S("silver", _cmp_sql("silver")))
def q_silver_full(spark, d):
    return silver_cmp(silver(spark, d))


def _first_run(spark, d):
    r = raw(spark, d)
    part1 = r.filter(F.col("timestamp") < F.lit(CUT).cast("timestamp"))
    return r, part1, silver_plan.build_silver(part1, updated_at=AS_OF)


_INC_REF = ([oracle.RAW, f"""raw1 AS (SELECT * FROM raw WHERE "timestamp" < {TS_CUT})""",
             *oracle.silver_ctes("s1_", "raw1"),
             """raw2 AS (SELECT * FROM raw WHERE "timestamp" > (SELECT max("timestamp") FROM s1_silver))""",
             *oracle.silver_ctes("s2_", "raw2"),
             """upserted AS (
  SELECT * FROM s1_silver o WHERE NOT EXISTS (
    SELECT 1 FROM s2_silver n WHERE n."timestamp" = o."timestamp" AND n.symbol = o.symbol)
  UNION ALL SELECT * FROM s2_silver)"""])


@register("silver_incremental_reference", "F01 J04 K05 U03 J03", oracle.with_ctes(_INC_REF, _cmp_sql("upserted")))
def q_silver_inc_ref(spark, d):
    r, _, s1 = _first_run(spark, d)
    inc = silver_plan.build_silver(r, updated_at=AS_OF, high_water=silver_plan.high_water(s1))
    return silver_cmp(silver_plan.upsert_by_key(s1, inc))


def _carry_run(spark, d):
    r, part1, s1 = _first_run(spark, d)
    state = silver_plan.silver_state(part1)
    hwm = state.agg(F.max("timestamp")).scalar()
    s2 = silver_plan.build_silver(r, updated_at=AS_OF, high_water=hwm, initial_state=state)
    return s1, s2


@register("silver_incremental_carry", "F01 K05 W03 (carried state)", S("silver", _cmp_sql("silver")))
def q_silver_inc_carry(spark, d):
    s1, s2 = _carry_run(spark, d)
    return silver_cmp(silver_plan.upsert_by_key(s1, s2))


@register("schema_evolution", "K06", S("silver", f"""SELECT * REPLACE (
  {oracle.r('log_return', 10)} AS log_return,
  CASE WHEN "timestamp" < {TS_CUT} THEN NULL ELSE spread END AS spread,
  CASE WHEN "timestamp" < {TS_CUT} THEN NULL ELSE spread_pct END AS spread_pct) FROM silver"""))
def q_schema_evolution(spark, d):
    s1, s2 = _carry_run(spark, d)
    old = s1.drop("spread", "spread_pct")          # written by an older model version
    return silver_cmp(silver_plan.upsert_by_key(old, s2).select(*s2.columns))


@register("late_rows", "R04", oracle.with_ctes(
    [oracle.RAW, "live AS (SELECT * FROM raw WHERE source = 'yahoo_finance')", *oracle.silver_ctes("l_", "live")],
    """SELECT * FROM raw WHERE source <> 'yahoo_finance'
  AND "timestamp" <= (SELECT max("timestamp") FROM l_silver)"""))
def q_late_rows(spark, d):
    r = raw(spark, d)
    target = silver_plan.build_silver(r.filter(F.col("source") == SOURCE_LIVE), updated_at=AS_OF)
    return silver_plan.late_rows(r.filter(F.col("source") != SOURCE_LIVE), target)


# ---------------------------------------------------------------------------
# gold
# ---------------------------------------------------------------------------
@register("gold_daily_bars", "A01 A02 P19", S("daily", "SELECT * FROM daily"))
def q_gold_daily(spark, d):
    return bars.daily_bars(silver(spark, d))


@register("gold_full", "C04 W05 P18 K07", S("gold", "SELECT * FROM gold"))
def q_gold_full(spark, d):
    return gold(spark, d).drop("updated_at")


@register("gold_first_last_window", "W02", S("daily", "SELECT date, symbol, open, close FROM daily"))
def q_gold_window(spark, d):
    return bars.first_last_by_window(silver(spark, d))


# ---------------------------------------------------------------------------
# serving
# ---------------------------------------------------------------------------
_LATEST = """latest AS (
  SELECT date, symbol, close AS price, daily_return_pct, volume, open, high, low
  FROM gold WHERE date >= ALL (SELECT date FROM gold)
)"""


@register("latest_prices", "J01 F07 A13 O03 C05 S07", S("gold", "SELECT * FROM latest ORDER BY symbol", [_LATEST]))
def q_latest_prices(spark, d):
    return serving.latest_prices(gold(spark, d))


def _money(x: str, digits: int = 2) -> str:
    return f"'$' || format('{{:,.{digits}f}}', {x})"


@register("latest_price_table", "P24 P27", S("gold", f"""SELECT symbol AS "Symbol", {_money('price')} AS "Price",
  printf('%.2f%%', daily_return_pct) AS "Daily Return", {_money('open')} AS "Open", {_money('high')} AS "High",
  {_money('low')} AS "Low", {_money('volume', 0)} AS "Volume" FROM latest""", [_LATEST]))
def q_latest_table(spark, d):
    return serving.latest_price_table(serving.latest_prices(gold(spark, d)))


@register("price_cards", "P25 P26", S("gold", f"""SELECT replace(symbol, '-USD', '') AS label, {_money('price')} AS value,
  printf('%.2f%%', daily_return_pct) AS delta,
  CASE WHEN daily_return_pct >= 0 THEN 'normal' ELSE 'inverse' END AS delta_color FROM latest""", [_LATEST]))
def q_price_cards(spark, d):
    return serving.price_cards(serving.latest_prices(gold(spark, d)))


def _lookback(days: int) -> str:
    return f"date >= CAST({TS_AS_OF} AS DATE) - INTERVAL '{days} days'"


@register("price_history", "F05 F11 O03", S("gold", f"""SELECT date, symbol, open, high, low, close, volume,
  daily_return_pct, price_change_pct FROM gold
WHERE symbol = '{HISTORY_SYMBOL}' AND {_lookback(7)} ORDER BY date"""))
def q_price_history(spark, d):
    return serving.price_history(gold(spark, d), HISTORY_SYMBOL, "7D", AS_OF)


@register("candles", "C06 P26", S("gold", f"""SELECT date, open, high, low, close, volume,
  CASE WHEN close < open THEN 'down' ELSE 'up' END AS direction FROM gold
WHERE symbol = '{CANDLE_SYMBOL}' AND {_lookback(30)} ORDER BY date"""))
def q_candles(spark, d):
    return serving.candles(gold(spark, d), CANDLE_SYMBOL, "1M", AS_OF)


_SELECTION = "selection AS (SELECT symbol FROM latest ORDER BY symbol LIMIT 3)"
_COMPARED = f"""compared AS (SELECT date, symbol, close, daily_return_pct FROM gold
  WHERE symbol IN (SELECT symbol FROM selection) AND {_lookback(90)})"""


def _compared(spark, d):
    g = gold(spark, d)
    return serving.compare_symbols(g, serving.default_selection(g, 3), 90, AS_OF)


@register("default_selection", "O06", S("gold", "SELECT * FROM selection", [_LATEST, _SELECTION]))
def q_default_selection(spark, d):
    return serving.default_selection(gold(spark, d), 3)


@register("compare_symbols", "F06 O03", S("gold", "SELECT * FROM compared ORDER BY date, symbol",
                                          [_LATEST, _SELECTION, _COMPARED]))
def q_compare(spark, d):
    return _compared(spark, d)


@register("normalized_performance", "W06", S("gold", """SELECT date, symbol, close,
  (close / first_value(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1) * 100 AS pct_change
FROM compared""", [_LATEST, _SELECTION, _COMPARED]))
def q_normalized(spark, d):
    return serving.normalized_performance(_compared(spark, d))


def _stats_sql(src: str, group: bool) -> str:
    cols = (f"""arg_min(close, date) AS start_price, arg_max(close, date) AS end_price,
  (arg_max(close, date) / arg_min(close, date) - 1) * 100 AS total_return_pct,
  {oracle.r('avg(daily_return_pct)', 8)} AS avg_daily_return_pct,
  {oracle.r('stddev_samp(daily_return_pct)', 8)} AS volatility_pct""")
    if group:
        return f"SELECT replace(symbol, '-USD', '') AS symbol, {cols} FROM {src} GROUP BY symbol ORDER BY symbol"
    return f"SELECT max(high) AS period_high, min(low) AS period_low, {cols} FROM {src}"


@register("period_stats", "A11", S("gold", _stats_sql("hist", False), [
    f"hist AS (SELECT * FROM gold WHERE symbol = '{HISTORY_SYMBOL}' AND {_lookback(30)})"]))
def q_period_stats(spark, d):
    return serving.period_stats(serving.price_history(gold(spark, d), HISTORY_SYMBOL, "1M", AS_OF))


@register("performance_summary", "A12 C05 S07", S("gold", _stats_sql("compared", True), [_LATEST, _SELECTION, _COMPARED]))
def q_performance(spark, d):
    return serving.performance_summary(_compared(spark, d))


@register("distinct_symbols", "U02", S("gold", "SELECT DISTINCT symbol FROM gold ORDER BY symbol"))
def q_distinct_symbols(spark, d):
    return serving.distinct_symbols(gold(spark, d))


@register("filter_symbols", "F10", S("gold", f"SELECT * FROM gold WHERE symbol IN ({_in(SELECTED)})"))
def q_filter_symbols(spark, d):
    return serving.filter_symbols(gold(spark, d), SELECTED).drop("updated_at")


@register("latest_rows_top20", "O02", S("gold", """SELECT date, symbol, open, high, low, close, volume, daily_return_pct
FROM gold ORDER BY date DESC, symbol LIMIT 20"""))
def q_top20(spark, d):
    return serving.latest_rows(gold(spark, d), 20)


@register("head_per_symbol", "O04", S("raw", """SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY "timestamp", id) AS rn FROM raw) WHERE rn <= 3"""))
def q_head(spark, d):
    return serving.head_per_symbol(raw(spark, d), 3)


@register("sample_rows", "O05", S("raw", "SELECT * FROM raw ORDER BY md5('42:' || id), id LIMIT 5"))
def q_sample(spark, d):
    return serving.sample_rows(raw(spark, d), 5)


# ---------------------------------------------------------------------------
# resampling (S08): events as ticks
# ---------------------------------------------------------------------------
def _bars_sql(interval: str) -> str:
    return f"""SELECT time_bucket(INTERVAL '{interval}', ts) AS bar_start,
  upper(event_type) || '-USD' AS symbol,
  arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close,
  CAST(count(*) AS DOUBLE) AS volume, count(*) AS data_points,
  min(ts) AS first_timestamp, max(ts) AS last_timestamp
FROM events GROUP BY 1, 2"""


@register("bars_15m", "S08 A01", _bars_sql("15 minutes"))
def q_bars_15m(spark, d):
    return bars.resample(fixtures.tick_bars(fixtures.load_table(spark, d, "events")), "15 minutes")


@register("bars_4h", "S08 A01", _bars_sql("4 hours"))
def q_bars_4h(spark, d):
    return bars.resample(fixtures.tick_bars(fixtures.load_table(spark, d, "events")), "4 hours")


# ---------------------------------------------------------------------------
# streams (R01-R05): deliveries land in a shared folder; each delivery is one
# availableNow run of the same query (same checkpoint), as an hourly schedule
# would run it.
# ---------------------------------------------------------------------------
DELIVERY_CUTS = ["2024-01-10 00:00:00", "2024-01-20 00:00:00"]


def _deliveries(df: DataFrame, col: str) -> list[DataFrame]:
    t = F.col(col)
    lo = None
    out = []
    for cut in [*DELIVERY_CUTS, None]:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (t >= F.lit(lo).cast("timestamp"))
        if cut is not None:
            cond = cond & (t < F.lit(cut).cast("timestamp"))
        out.append(df.filter(cond))
        lo = cut
    return out


def _stream_dirs(spark, name: str) -> dict[str, str]:
    from barlake.session import scratch_path
    base = scratch_path(spark, name)
    return {k: f"{base}/{k}" for k in ("landing", "out", "state", "late", "checkpoint")}


@register("stream_bronze", "R01 K01", S("raw", "SELECT * FROM firsts", [_FIRSTS]))
def q_stream_bronze(spark, d):
    from barlake.streaming import run_bronze_stream
    r = raw(spark, d)
    p = _stream_dirs(spark, "stream_bronze")
    for part in _deliveries(r, "ingestion_timestamp"):
        part.write.mode("append").parquet(p["landing"])
        run_bronze_stream(spark, p["landing"], r.schema, p["out"], p["checkpoint"])
    return spark.read.parquet(p["out"]).drop("date")


@register("stream_dedup", "R05", S("raw", 'SELECT DISTINCT "timestamp", symbol, source FROM raw'))
def q_stream_dedup(spark, d):
    from barlake.streaming import dedup_stream
    from barlake.streaming.jobs import _run
    r = raw(spark, d)
    p = _stream_dirs(spark, "stream_dedup")
    for part in _deliveries(r, "ingestion_timestamp"):
        part.write.mode("append").parquet(p["landing"])
        s = dedup_stream(spark.readStream.schema(r.schema).parquet(p["landing"]))
        _run(s.select("timestamp", "symbol", "source").writeStream.format("parquet")
             .outputMode("append").option("path", p["out"]).option("checkpointLocation", p["checkpoint"]))
    return spark.read.parquet(p["out"])


@register("stream_silver", "R02 R04", S("silver", _cmp_sql("silver")))
def q_stream_silver(spark, d):
    from barlake.streaming import run_silver_stream
    r = raw(spark, d)
    p = _stream_dirs(spark, "stream_silver")
    for part in _deliveries(r, "timestamp"):
        part.write.mode("append").parquet(p["landing"])
        run_silver_stream(spark, p["landing"], r.schema, p["out"], p["state"], p["late"],
                          p["checkpoint"], updated_at=AS_OF)
    return silver_cmp(spark.read.parquet(p["out"]).drop("date"))


@register("stream_daily_bars", "R03", S("daily", """SELECT date, symbol, open, high, low, close, volume,
  data_points, first_timestamp, last_timestamp FROM daily"""))
def q_stream_daily(spark, d):
    from barlake.streaming import run_daily_bars_stream
    s = silver(spark, d)
    p = _stream_dirs(spark, "stream_daily")
    for part in _deliveries(s, "timestamp"):
        part.write.mode("append").parquet(p["landing"])
        run_daily_bars_stream(spark, p["landing"], s.schema, p["out"], p["checkpoint"])
    return spark.read.parquet(p["out"])


# ---------------------------------------------------------------------------
# jobs on storage: landing reads (S01), live ingest (C01), backfill (C02),
# silver merge with carried state (K05 on partitions), gold refresh
# ---------------------------------------------------------------------------
def _landed(spark, d, fmt: str = "json") -> tuple[str, DataFrame]:
    """Upstream frames as a fetch lands them (bar time as a zoned TIMESTAMP)."""
    up = fixtures.upstream_bars(fixtures.load_table(spark, d, "events"))
    up = up.withColumn("Datetime", F.col("Datetime").cast("timestamp"))
    path = _stream_dirs(spark, f"landing-{fmt}")["landing"]
    w = up.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", "true")
    w.format(fmt).save(path)
    return path, up


_NORMALIZED = f"""SELECT "timestamp", symbol, open, high, low, close, volume,
  '{{source}}' AS source, {TS_AS_OF} AS ingestion_timestamp FROM raw"""


@register("landing_scan", "S01 S02 S03 P01 P02 P03 P04", S("raw", f"""{_NORMALIZED.format(source='yahoo_finance_hourly')}
WHERE symbol IN ({_in(SELECTED)}) AND "timestamp" >= TIMESTAMP '{RANGE_START}' AND "timestamp" < TIMESTAMP '{RANGE_END}'"""))
def q_landing_scan(spark, d):
    from barlake.schema import UPSTREAM_SCHEMA
    path, _ = _landed(spark, d, "json")
    bars_ = landing.read_bars(spark, path, "json", UPSTREAM_SCHEMA, start=RANGE_START, end=RANGE_END,
                              symbols=SELECTED)
    return ingest.normalize_upstream(bars_, source=SOURCE_HOURLY, ingested_at=AS_OF).drop(CORRUPT)


_KEYS_SQL = 'SELECT DISTINCT "timestamp", symbol FROM raw'


def _backfill(spark, d):
    from barlake.schema import UPSTREAM_SCHEMA
    path, _ = _landed(spark, d, "parquet")
    landed = landing.read_bars(spark, path, "parquet", UPSTREAM_SCHEMA)
    bronze_path = _stream_dirs(spark, "backfill")["out"]
    return ingest.backfill(spark, landed, bronze_path, SOURCE_HOURLY, EXPECTED_SYMBOLS, ingested_at=AS_OF)


@register("backfill_load_stats", "C02 K01 K02 K04 A08", S("raw", f"""SELECT
  (SELECT count(*) FROM ({_KEYS_SQL})) AS inserted,
  (SELECT count(*) FROM raw) - (SELECT count(*) FROM ({_KEYS_SQL})) AS duplicates,
  CAST(0 AS BIGINT) AS failed, (SELECT count(*) FROM raw) AS total"""))
def q_backfill_stats(spark, d):
    return _backfill(spark, d)["stats"]


@register("backfill_rows", "C02 K01 (which row survives)", S("raw", f"""
SELECT DISTINCT ON ("timestamp", symbol) "timestamp", symbol, open, high, low, close, volume,
  '{SOURCE_HOURLY}' AS source, {TS_AS_OF} AS ingestion_timestamp FROM raw
ORDER BY "timestamp", symbol, open NULLS LAST, high NULLS LAST, low NULLS LAST, close NULLS LAST, volume NULLS LAST"""))
def q_backfill_rows(spark, d):
    from barlake.schema import UPSTREAM_SCHEMA
    path, _ = _landed(spark, d, "parquet")
    out = _stream_dirs(spark, "backfill-rows")["out"]
    ingest.backfill(spark, landing.read_bars(spark, path, "parquet", UPSTREAM_SCHEMA), out, SOURCE_HOURLY,
                    EXPECTED_SYMBOLS, ingested_at=AS_OF)
    return spark.read.parquet(out).drop("id", "date")


@register("landing_daily_frames", "S01 P02 (bar time named Date)", S("raw", """SELECT "timestamp", symbol, open, high, low,
  close, volume FROM raw"""))
def q_daily_frames(spark, d):
    from barlake.schema import UPSTREAM_SCHEMA
    up = fixtures.upstream_bars(fixtures.load_table(spark, d, "events"))
    path = _stream_dirs(spark, "landing-daily")["landing"]
    (up.withColumn("Date", F.col("Datetime").cast("timestamp")).drop("Datetime").write.json(path))
    bars_ = ingest.normalize_upstream(landing.read_bars(spark, path, "json", UPSTREAM_SCHEMA), ingested_at=AS_OF)
    return bars_.select("timestamp", "symbol", "open", "high", "low", "close", "volume")


@register("backfill_coverage", "C02 A04 F08", S("raw", f"""SELECT symbol, count(*) AS record_count,
  min("timestamp") AS earliest, max("timestamp") AS latest FROM ({_KEYS_SQL}) GROUP BY symbol"""))
def q_backfill_coverage(spark, d):
    return _backfill(spark, d)["coverage"]


@register("ingest_live_freshness", "C01 S05 A03 A09 A10", S("raw", f"""SELECT latest_timestamp, record_count, symbol_count,
  {_age("latest_timestamp")} AS age_minutes,
  CASE WHEN record_count = 0 THEN 'empty' WHEN {_age("latest_timestamp")} > 90 THEN 'stale' ELSE 'fresh' END AS status
FROM (SELECT max("timestamp") AS latest_timestamp, count(*) AS record_count, count(DISTINCT symbol) AS symbol_count
      FROM ({_KEYS_SQL}) WHERE "timestamp" > {TS_AS_OF} - INTERVAL '2 hours')"""))
def q_ingest_live(spark, d):
    path, _ = _landed(spark, d, "parquet")
    from barlake.schema import UPSTREAM_SCHEMA
    landed = landing.read_bars(spark, path, "parquet", UPSTREAM_SCHEMA)
    return ingest.ingest_live(spark, landed, _stream_dirs(spark, "live")["out"], AS_OF)["freshness"]


def _bronze_loads(spark, d) -> tuple[str, list[DataFrame]]:
    """Bronze on storage, loaded in two deliveries split at CUT."""
    r = raw(spark, d)
    path = _stream_dirs(spark, "bronze-loads")["out"]
    cut = F.lit(CUT).cast("timestamp")
    return path, [r.filter(F.col("timestamp") < cut), r.filter(F.col("timestamp") >= cut)]


@register("silver_merge_job", "C03 K05 K06 F01 (carried state, partition merge)", S("silver", _cmp_sql("silver")))
def q_silver_merge_job(spark, d):
    from barlake.plans import jobs
    bronze_path, loads = _bronze_loads(spark, d)
    p = _stream_dirs(spark, "silver-job")
    for load in loads:
        writes.write_layer(load.withColumn("date", F.to_date("timestamp")), bronze_path, mode="append")
        bronze = spark.read.parquet(bronze_path)
        jobs.refresh_silver(spark, bronze, p["out"], mode="carry", state_path=p["state"], updated_at=AS_OF)
    return silver_cmp(spark.read.parquet(p["out"]).drop("date"))


@register("silver_reference_job", "C03 K05 F01 J04 (reference incremental)", oracle.with_ctes(_INC_REF, _cmp_sql("upserted")))
def q_silver_reference_job(spark, d):
    from barlake.plans import jobs
    bronze_path, loads = _bronze_loads(spark, d)
    out = _stream_dirs(spark, "silver-ref-job")["out"]
    for load in loads:
        writes.write_layer(load.withColumn("date", F.to_date("timestamp")), bronze_path, mode="append")
        bronze = spark.read.parquet(bronze_path)
        jobs.refresh_silver(spark, bronze, out, mode="reference", updated_at=AS_OF)
    return silver_cmp(spark.read.parquet(out).drop("date"))


@register("gold_refresh_job", "C04 K07 K10 K11 S06 O01", S("gold", "SELECT * FROM gold"))
def q_gold_refresh_job(spark, d):
    from barlake.plans import jobs
    from barlake.session import scratch_path
    root = scratch_path(spark, "lake")
    _, silver_path, gold_path = writes.create_layers(spark, root)
    jobs.refresh_silver(spark, raw(spark, d), silver_path, mode="full", updated_at=AS_OF)
    jobs.refresh_gold(spark, silver_path, gold_path, updated_at=AS_OF)
    return landing.read_layer(spark, root, "gold").drop("updated_at")


@register("gold_incremental_job", "C04 W05 K07 (days since the first touched day)", S("gold", "SELECT * FROM gold"))
def q_gold_incremental_job(spark, d):
    from barlake.plans import jobs
    from barlake.session import scratch_path
    root = scratch_path(spark, "lake-inc")
    bronze_path, silver_path, gold_path = writes.create_layers(spark, root)
    state = f"{root}/silver_state"
    r = raw(spark, d)
    cut = F.lit(CUT).cast("timestamp")
    for i, load in enumerate([r.filter(F.col("timestamp") < cut), r.filter(F.col("timestamp") >= cut)]):
        writes.write_layer(load.withColumn("date", F.to_date("timestamp")), bronze_path, mode="append")
        slices = jobs.refresh_silver(spark, spark.read.parquet(bronze_path), silver_path, mode="carry",
                                     state_path=state, updated_at=AS_OF)
        if i == 0:
            jobs.refresh_gold(spark, silver_path, gold_path, updated_at=AS_OF)
        else:
            jobs.refresh_gold_slices(spark, silver_path, gold_path, slices, updated_at=AS_OF)
    return spark.read.parquet(gold_path).drop("updated_at")


@register("silver_recompute_job", "R04 C03 K05 (late backfill after a live run, partition recompute)", S("silver", _cmp_sql("silver")))
def q_silver_recompute_job(spark, d):
    from barlake.plans import jobs
    r = raw(spark, d)
    p = _stream_dirs(spark, "silver-recompute")
    live = r.filter(F.col("source") == SOURCE_LIVE)
    backfill = r.filter(F.col("source") != SOURCE_LIVE)        # arrives later, bars of the whole month
    bronze_path = p["landing"]
    writes.write_layer(live.withColumn("date", F.to_date("timestamp")), bronze_path)
    jobs.refresh_silver(spark, spark.read.parquet(bronze_path), p["out"], mode="carry",
                        state_path=p["state"], updated_at=AS_OF)
    writes.write_layer(backfill.withColumn("date", F.to_date("timestamp")), bronze_path, mode="append")
    jobs.refresh_silver(spark, spark.read.parquet(bronze_path), p["out"], mode="recompute",
                        state_path=p["state"], updated_at=AS_OF, changed=backfill)
    return silver_cmp(spark.read.parquet(p["out"]).drop("date"))


@register("stream_silver_late", "R02 R04 (stream, late backfill recomputed)", S("silver", _cmp_sql("silver")))
def q_stream_silver_late(spark, d):
    from barlake.streaming import run_silver_stream
    r = raw(spark, d)
    p = _stream_dirs(spark, "stream-silver-late")
    live = r.filter(F.col("source") == SOURCE_LIVE)
    for part in [*_deliveries(live, "timestamp"), r.filter(F.col("source") != SOURCE_LIVE)]:
        part.write.mode("append").parquet(p["landing"])
        run_silver_stream(spark, p["landing"], r.schema, p["out"], p["state"], p["late"],
                          p["checkpoint"], updated_at=AS_OF, policy="recompute")
    return silver_cmp(spark.read.parquet(p["out"]).drop("date"))


@register("stream_daily_from_silver_feed", "R02 R03 (silver stream feed -> daily bars stream)",
          S("daily", """SELECT date, symbol, open, high, low, close, volume,
  data_points, first_timestamp, last_timestamp FROM daily"""))
def q_stream_daily_feed(spark, d):
    from barlake.streaming import run_daily_bars_stream, run_silver_stream
    r = raw(spark, d)
    p = _stream_dirs(spark, "stream-feed")
    feed, bars_out, ckpt2 = p["late"] + "-feed", p["out"] + "-daily", p["checkpoint"] + "-daily"
    feed_schema = silver(spark, d).withColumn("epoch", F.lit(0)).schema
    for part in _deliveries(r, "timestamp"):
        part.write.mode("append").parquet(p["landing"])
        run_silver_stream(spark, p["landing"], r.schema, p["out"], p["state"], p["late"],
                          p["checkpoint"], updated_at=AS_OF, feed_path=feed)
        run_daily_bars_stream(spark, feed, feed_schema, bars_out, ckpt2)
    return spark.read.parquet(bars_out)


# ---------------------------------------------------------------------------
# late rows that empty a day: a late row just before a day's only bar makes
# that bar an outlier
# ---------------------------------------------------------------------------
# All rows: each event is the only bar of its symbol and day, and every symbol has a
# late row on a day of its own.
_SPARSE = f"""sparse AS (
  SELECT * REPLACE (TIMESTAMP '2024-01-01 00:00:00' + CAST(id % 60 AS INTEGER) * INTERVAL '1 day' AS "timestamp",
                    replace(symbol, '-USD', '') || CAST(id // 60 AS VARCHAR) || '-USD' AS symbol),
         TIMESTAMP '2024-01-04 00:00:00' + CAST((id // 60) % 50 AS INTEGER) * INTERVAL '1 day' AS late_at
  FROM raw
), late AS (
  SELECT * EXCLUDE (late_at) REPLACE (late_at AS "timestamp", close / 1000 AS close, open / 1000 AS open,
                    TIMESTAMP '{AS_OF}' AS ingestion_timestamp, -id AS id)
  FROM (SELECT * FROM sparse WHERE close > 0 QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY id) = 1)
), both_loads AS (
  SELECT * EXCLUDE (late_at) FROM sparse WHERE "timestamp" <> late_at
  UNION ALL SELECT * FROM late
)"""


def _one_bar_a_day(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "timestamp": F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 60 as int))"),
        "symbol": F.expr("concat(replace(symbol, '-USD', ''), id div 60, '-USD')")})


def _late_of_symbols(rows: DataFrame, at: str) -> DataFrame:
    """One late row per symbol, from its first usable bar, at the time `at`."""
    columns = [c for c in rows.columns if c != at]
    return (rows.filter("close > 0").groupBy("symbol").agg(F.min_by(F.struct(*rows.columns), "id").alias("r")).select("r.*")
            .withColumns({"timestamp": F.col(at), "close": F.col("close") / 1000, "open": F.col("open") / 1000,
                          "id": -F.col("id"), "ingestion_timestamp": F.lit(AS_OF).cast("timestamp")}).select(*columns))


def _sparse_loads(spark, d) -> tuple[DataFrame, DataFrame]:
    r = _one_bar_a_day(raw(spark, d)).withColumn(
        "late_at", F.expr("timestamp'2024-01-04 00:00:00' + make_interval(0, 0, 0, cast((id div 60) % 50 as int))"))
    return r.filter(F.col("timestamp") != F.col("late_at")).drop("late_at"), _late_of_symbols(r, "late_at")


def _recomputed(spark, d, name: str, loads=_sparse_loads) -> tuple[str, DataFrame]:
    """Silver and gold, then the late rows, by the default mode."""
    from barlake.plans import jobs
    from barlake.session import scratch_path
    root = scratch_path(spark, name)
    first, late = loads(spark, d)
    late.write.parquet(f"{root}/late")              # one row per symbol, read for bronze and for its slices
    late = spark.read.schema(late.schema).parquet(f"{root}/late")
    bronze_path = f"{root}/bronze"
    for i, load in enumerate((first, late)):
        writes.write_layer(load.withColumn("date", F.to_date("timestamp")), bronze_path, mode="append")
        jobs.refresh_layers(spark, spark.read.parquet(bronze_path), root, changed=late if i else None, updated_at=AS_OF)
    return root, late


_LATE_PARTS = [oracle.RAW, _SPARSE, *oracle.silver_ctes("b_", "both_loads"), *oracle.gold_ctes("b_", "b_silver")]


@register("silver_recompute_emptied_day", "R04 C03 (a late row empties a day)", oracle.with_ctes(_LATE_PARTS, _cmp_sql("b_silver")))
def q_emptied_silver(spark, d):
    return silver_cmp(spark.read.parquet(_recomputed(spark, d, "emptied-silver")[0] + "/silver").drop("date"))


@register("gold_recompute_emptied_day", "R04 C04 (a late row empties a day)", oracle.with_ctes(_LATE_PARTS, "SELECT * FROM b_gold"))
def q_emptied_gold(spark, d):
    return spark.read.parquet(_recomputed(spark, d, "emptied-gold")[0] + "/gold").drop("updated_at")


@register("late_report_batch", "R04 (late rows of a carry run)", oracle.with_ctes([oracle.RAW, _SPARSE], f"SELECT {RAW_COLS} FROM late"))
def q_late_report(spark, d):
    from barlake.plans import jobs
    p = _stream_dirs(spark, "late-report")
    first, late = _sparse_loads(spark, d)
    jobs.refresh_silver(spark, first, p["out"], mode="carry", state_path=p["state"], updated_at=AS_OF)
    jobs.refresh_silver(spark, first.unionByName(late), p["out"], mode="carry", state_path=p["state"], updated_at=AS_OF,
                        changed=late)
    return spark.read.parquet(p["state"] + "/late").drop("mark")


# the same with all symbols' late rows on one day
_SPREAD_LATE_TS = "2024-01-21 00:00:00"
_SPREAD = f"""spread AS (
  SELECT * REPLACE (TIMESTAMP '2024-01-01 00:00:00' + CAST(id % 60 AS INTEGER) * INTERVAL '1 day' AS "timestamp",
                    replace(symbol, '-USD', '') || CAST(id // 60 AS VARCHAR) || '-USD' AS symbol)
  FROM raw
), late AS (
  SELECT * REPLACE (TIMESTAMP '{_SPREAD_LATE_TS}' AS "timestamp", close / 1000 AS close, open / 1000 AS open,
                    TIMESTAMP '{AS_OF}' AS ingestion_timestamp, -id AS id)
  FROM (SELECT * FROM spread WHERE close > 0 QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY id) = 1)
), both_loads AS (
  SELECT * FROM spread WHERE "timestamp" <> TIMESTAMP '{_SPREAD_LATE_TS}'
  UNION ALL SELECT * FROM late
)"""


def _spread_loads(spark, d) -> tuple[DataFrame, DataFrame]:
    r = _one_bar_a_day(raw(spark, d)).withColumn("late_at", F.lit(_SPREAD_LATE_TS).cast("timestamp"))
    return r.filter(F.col("timestamp") != F.col("late_at")).drop("late_at"), _late_of_symbols(r, "late_at")


_SPREAD_PARTS = [oracle.RAW, _SPREAD, *oracle.silver_ctes("b_", "both_loads"), *oracle.gold_ctes("b_", "b_silver")]


@register("silver_recompute_late_symbols", "R04 C03 (late rows of every symbol)", oracle.with_ctes(_SPREAD_PARTS, _cmp_sql("b_silver")))
def q_late_symbols_silver(spark, d):
    root = _recomputed(spark, d, "late-symbols-silver", _spread_loads)[0]
    return silver_cmp(spark.read.parquet(root + "/silver").drop("date"))


@register("gold_recompute_late_symbols", "R04 C04 (late rows of every symbol)", oracle.with_ctes(_SPREAD_PARTS, "SELECT * FROM b_gold"))
def q_late_symbols_gold(spark, d):
    return spark.read.parquet(_recomputed(spark, d, "late-symbols-gold", _spread_loads)[0] + "/gold").drop("updated_at")


@register("late_report_symbols", "R04 (late rows of every symbol, carry run)",
          oracle.with_ctes([oracle.RAW, _SPREAD], f"SELECT {RAW_COLS} FROM late"))
def q_late_report_symbols(spark, d):
    from barlake.plans import jobs
    p = _stream_dirs(spark, "late-report-symbols")
    first, late = _spread_loads(spark, d)
    jobs.refresh_silver(spark, first, p["out"], mode="carry", state_path=p["state"], updated_at=AS_OF)
    jobs.refresh_silver(spark, first.unionByName(late), p["out"], mode="carry", state_path=p["state"], updated_at=AS_OF,
                        changed=late)
    return spark.read.parquet(p["state"] + "/late").drop("mark")


@register("stream_silver_replay", "R02 (every batch run twice)", S("silver", "SELECT count(*) AS n_rows, count(*) AS n_feed FROM silver"))
def q_stream_replay(spark, d):
    """Each delivery is processed, its checkpointed progress forgotten, and processed again."""
    from barlake.streaming import run_silver_stream
    r = raw(spark, d)
    p = _stream_dirs(spark, "stream-replay")
    feed = p["late"] + "-feed"
    for i, part in enumerate(_deliveries(r, "timestamp")):
        path = f"{p['landing']}/{i}"
        part.write.parquet(path)
        for attempt in range(2):
            run_silver_stream(spark, path, r.schema, p["out"], p["state"], p["late"], f"{p['checkpoint']}/{i}-{attempt}",
                              updated_at=AS_OF, feed_path=feed, first_batch=i)
    rows = spark.read.parquet(p["out"]).agg(F.count("*").alias("n_rows"))
    return rows.withColumn("n_feed", spark.read.parquet(feed).agg(F.count("*")).scalar())


# ---------------------------------------------------------------------------
# a fixture whose key space grows with the table
# ---------------------------------------------------------------------------
_WIDE_PARTS = [oracle.RAW, oracle.WIDE, *oracle.silver_ctes("w_", "wide"), *oracle.gold_ctes("w_", "w_silver")]


def _wide(spark, d) -> DataFrame:
    return fixtures.wide_bars(fixtures.load_table(spark, d, "events"))


@register("silver_wide", "C03 W01 W03 (growing key space)", oracle.with_ctes(_WIDE_PARTS, _cmp_sql("w_silver")))
def q_silver_wide(spark, d):
    return silver_cmp(silver_plan.build_silver(_wide(spark, d), updated_at=AS_OF))


@register("gold_wide", "C04 A01 (growing key space)", oracle.with_ctes(_WIDE_PARTS, "SELECT * FROM w_gold"))
def q_gold_wide(spark, d):
    return gold_plan.build_gold(silver_plan.build_silver(_wide(spark, d), updated_at=AS_OF), updated_at=AS_OF).drop("updated_at")


@register("quality_silver_wide", "T02 T07 (rows of BTC-USD)", oracle.with_ctes(
    [*_WIDE_PARTS, f"silver_t AS (SELECT *, {TS_AS_OF} AS updated_at FROM w_silver)"],
    _suite_sql("silver_t", "silver", quality.SILVER_SUITE)))
def q_quality_wide(spark, d):
    return quality.run_suite(silver_plan.build_silver(_wide(spark, d), updated_at=AS_OF), quality.SILVER_SUITE, "silver")


@register("unique_violations_wide", "T02 T06 (BTC-USD before dedup)", oracle.with_ctes([oracle.RAW, oracle.WIDE], """
SELECT "timestamp", count(*) AS n_records FROM wide WHERE symbol = 'BTC-USD' GROUP BY "timestamp" HAVING count(*) > 1"""))
def q_unique_wide(spark, d):
    return quality.failing_rows(_wide(spark, d), quality.Test("timestamp", "unique", where="symbol = 'BTC-USD'"))


# ---------------------------------------------------------------------------
# LAG slices of any depth (W03, W04): ticks by minute, hour and day
# ---------------------------------------------------------------------------
_TICKS_SQL = """SELECT "timestamp", symbol, close, lag(close) OVER w AS prev_close, lag("timestamp") OVER w AS prev_timestamp
FROM (SELECT ts AS "timestamp", upper(event_type) || '-USD' AS symbol, arg_min(value, event_id) AS close
      FROM events WHERE value IS NOT NULL GROUP BY ts, event_type)
WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")"""


def _ticks(spark, d) -> DataFrame:
    events = fixtures.load_table(spark, d, "events").filter("value is not null")
    ticks = fixtures.tick_bars(events.groupBy("ts", "event_type").agg(F.min_by("value", "event_id").alias("value")))
    return ticks.select("timestamp", "symbol", "close")


def _with_last_tick(ticks: DataFrame, slices) -> DataFrame:
    from barlake.operators.sequence import with_previous
    return with_previous(ticks, ["symbol"], "timestamp", {"close": "prev_close", "timestamp": "prev_timestamp"}, slices=slices)


@register("tick_lag_nested", "W03 W04 (minute, hour and day slices)", _TICKS_SQL)
def q_tick_lag_nested(spark, d):
    return _with_last_tick(_ticks(spark, d), ("minute", "hour", "day"))


@register("tick_lag_measured", "W03 W04 (slices chosen from measured sizes)", _TICKS_SQL)
def q_tick_lag_measured(spark, d):
    from barlake.operators.sequence import choose_slices
    ticks = _ticks(spark, d)
    return _with_last_tick(ticks, choose_slices(ticks, ["symbol"], "timestamp", limit=24))


# ---------------------------------------------------------------------------
# change feed (R02-R04): late rows of every symbol through silver to gold as
# streams, every batch run twice
# ---------------------------------------------------------------------------
@register("stream_gold_changes", "R02 R03 R04 (change feed, late rows of every symbol, batches run twice)",
          oracle.with_ctes(_LATE_PARTS, "SELECT * FROM b_gold"))
def q_stream_gold_changes(spark, d):
    from barlake.streaming import run_gold_stream, run_silver_stream
    first, late = _sparse_loads(spark, d)
    p = _stream_dirs(spark, "stream-gold")
    feed, gold_path = p["late"] + "-changes", p["out"] + "-gold"
    for i, part in enumerate((first, late)):
        path = f"{p['landing']}/load={i}"
        part.write.parquet(path)
        for attempt in range(2):
            run_silver_stream(spark, path, first.schema, p["out"], p["state"], p["late"], f"{p['checkpoint']}/{i}-{attempt}",
                              updated_at=AS_OF, policy="recompute", first_batch=i, changes_path=feed, table_path=p["landing"])
            run_gold_stream(spark, feed, gold_path, p["state"] + "-gold", f"{p['checkpoint']}-gold/{attempt}", updated_at=AS_OF)
    return spark.read.parquet(gold_path).drop("updated_at")


# ---------------------------------------------------------------------------
# access by symbol
# ---------------------------------------------------------------------------
def _symbol_layout(spark, d) -> str:
    """A copy of silver by symbol bucket and month, kept up over a late load."""
    from barlake.plans import by_symbol, jobs
    from barlake.session import scratch_path
    root = scratch_path(spark, "by-symbol")
    first, late = _sparse_loads(spark, d)
    for i, load in enumerate((first, late)):
        writes.write_layer(load.withColumn("date", F.to_date("timestamp")), f"{root}/bronze", mode="append")
        slices = jobs.refresh_silver(spark, landing.read_layer(spark, root, "bronze"), f"{root}/silver", updated_at=AS_OF,
                                     state_path=f"{root}/state", changed=late if i else None)
        if i:
            by_symbol.refresh(spark, f"{root}/silver", f"{root}/by_symbol", slices)
        else:
            by_symbol.build(spark, landing.read_layer(spark, root, "silver"), f"{root}/by_symbol", buckets=8)
    return f"{root}/by_symbol"


@register("symbol_layout_rows", "K10 R04 (copy by symbol, after late rows)", oracle.with_ctes(_LATE_PARTS, _cmp_sql("b_silver")))
def q_symbol_layout_rows(spark, d):
    return silver_cmp(spark.read.parquet(_symbol_layout(spark, d)).drop("bucket", "month"))


@register("symbol_layout_history", "K10 F05 S03 (some symbols' period from their buckets)", oracle.with_ctes(_LATE_PARTS, f"""
{_cmp_sql("b_silver")} WHERE symbol IN ('CLICK0-USD', 'VIEW1-USD', 'SIGNUP3-USD') AND "timestamp" >= TIMESTAMP '{RANGE_START}'
  AND "timestamp" < TIMESTAMP '2024-02-20 00:00:00'"""))
def q_symbol_layout_history(spark, d):
    from barlake.plans import by_symbol
    return silver_cmp(by_symbol.read_symbols(spark, _symbol_layout(spark, d), ["CLICK0-USD", "VIEW1-USD", "SIGNUP3-USD"],
                                             RANGE_START, "2024-02-20 00:00:00"))


# ---------------------------------------------------------------------------
# stored columns of a layer over three writes
# ---------------------------------------------------------------------------
@register("schema_record_evolution", "K05 K06 S06 (columns added and widened over three writes)", S("silver", f"""
SELECT "timestamp", symbol, close, CAST(flag_zero_volume AS BIGINT) AS flag_zero_volume,
  CASE WHEN "timestamp" >= TIMESTAMP '{RANGE_START}' THEN volume END AS volume,
  CASE WHEN "timestamp" >= {TS_CUT} THEN spread END AS spread, CAST("timestamp" AS DATE) AS date FROM silver"""))
def q_schema_record(spark, d):
    from barlake.plans import jobs
    from barlake.session import scratch_path
    root, s = scratch_path(spark, "schema-record"), silver(spark, d)
    early, middle = F.lit(RANGE_START).cast("timestamp"), F.lit(CUT).cast("timestamp")
    t, base = F.col("timestamp"), ["timestamp", "symbol", "close"]
    loads = [s.filter(t < early).select(*base, "flag_zero_volume"),
             s.filter((t >= early) & (t < middle)).select(*base, F.col("flag_zero_volume").cast("long"), "volume"),
             s.filter(t >= middle).select(*base, "flag_zero_volume", "volume", "spread")]
    for load in loads:
        jobs.merge_into_layer(spark, load, f"{root}/silver")
    return landing.read_layer(spark, root, "silver")


# ---------------------------------------------------------------------------
# a landed file that can't be read (S01, S04): the other symbols load
# ---------------------------------------------------------------------------
_BROKEN = "ERROR-USD"


def _landed_with_broken_file(spark, d) -> str:
    """One file per symbol; that of one symbol is cut in half."""
    from barlake.operators.layers import storage
    path = _stream_dirs(spark, "landing-broken")["landing"]
    up = fixtures.upstream_bars(fixtures.load_table(spark, d, "events"))
    (up.withColumn("Datetime", F.col("Datetime").cast("timestamp")).repartition("symbol").write.partitionBy("symbol").parquet(path))
    fs, folder = storage(spark, f"{path}/symbol={_BROKEN}")
    for status in fs.listStatus(folder):
        if status.getPath().getName().startswith("part-"):
            source = fs.open(status.getPath())
            data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source)
            source.close()
            out = fs.create(status.getPath(), True)
            out.write(bytearray(data[:len(data) // 2]))
            out.close()
    return path


@register("landing_isolated_rows", "S01 S02 P01 P02 (one file unreadable)", S("raw", f"""{_NORMALIZED.format(source=SOURCE_HOURLY)}
WHERE symbol <> '{_BROKEN}' AND "timestamp" >= TIMESTAMP '{RANGE_START}'"""))
def q_landing_isolated(spark, d):
    bars_, _ = landing.read_isolated(spark, _landed_with_broken_file(spark, d), start=RANGE_START)
    return ingest.normalize_upstream(bars_, source=SOURCE_HOURLY, ingested_at=AS_OF)


@register("landing_symbol_report", "S01 S04 (rows, failed files and status per expected symbol)", S("raw", f"""
SELECT e.symbol, CASE WHEN e.symbol = '{_BROKEN}' THEN 0 ELSE count(r.symbol) END AS n_rows,
  CAST(e.symbol = '{_BROKEN}' AS BIGINT) AS n_failed,
  CASE WHEN e.symbol = '{_BROKEN}' THEN 'failed' WHEN count(r.symbol) > 0 THEN 'loaded' ELSE 'missing' END AS status
FROM (SELECT unnest([{_in(EXPECTED_SYMBOLS)}]) AS symbol) e LEFT JOIN raw r ON r.symbol = e.symbol GROUP BY e.symbol"""))
def q_landing_symbol_report(spark, d):
    bars_, failed = landing.read_isolated(spark, _landed_with_broken_file(spark, d))
    return landing.symbol_report(bars_, failed, EXPECTED_SYMBOLS)


# ---------------------------------------------------------------------------
# tests during the write (T01-T04, T07), uniqueness of touched days
# ---------------------------------------------------------------------------
@register("quality_gold_observed", "T01 T03 T07 (counted by the job that writes gold)",
          S("gold", _suite_sql("gold_t", "gold", quality.GOLD_SUITE), [_GOLD_STAMPED]))
def q_quality_gold_observed(spark, d):
    from barlake.plans import jobs
    from barlake.session import scratch_path
    root = scratch_path(spark, "gold-tested")
    jobs.refresh_silver(spark, raw(spark, d), f"{root}/silver", mode="full", updated_at=AS_OF)
    return jobs.refresh_gold(spark, f"{root}/silver", f"{root}/gold", updated_at=AS_OF, suite=quality.GOLD_SUITE)


@register("quality_bronze_observed", "T01 T02 T03 T04 T07 (counted by the job that writes bronze)",
          S("raw", _suite_sql("raw", "bronze", quality.BRONZE_SUITE)))
def q_quality_bronze_observed(spark, d):
    from barlake.operators.layers import read_stored
    from barlake.session import scratch_path
    path = scratch_path(spark, "bronze-tested")
    rows, seen = quality.observe_suite(raw(spark, d).withColumn("date", F.to_date("timestamp")), quality.BRONZE_SUITE)
    writes.write_layer(rows, path, mode="append")
    return quality.observed_report(spark, seen, quality.BRONZE_SUITE, "bronze", lambda: read_stored(spark, path))


@register("unique_in_touched_days", "T02 T06 (key repeats in the days of the last load)", S("raw", f"""
SELECT "timestamp", symbol, source, count(*) AS n_records FROM raw WHERE "timestamp" >= {TS_CUT}
GROUP BY "timestamp", symbol, source HAVING count(*) > 1"""))
def q_unique_touched(spark, d):
    path, loads = _bronze_loads(spark, d)
    for load in loads:
        writes.write_layer(load.withColumn("date", F.to_date("timestamp")), path, mode="append")
    days = [r[0] for r in loads[-1].select(F.to_date("timestamp")).distinct().collect()]
    return quality.key_violations_in(spark, path, days, ["timestamp", "symbol", "source"])


# ---------------------------------------------------------------------------
# counts kept up to date (A04-A07, A13-A15) over late rows and emptied days
# ---------------------------------------------------------------------------
def _silver_summary(spark, d) -> str:
    from barlake.plans import jobs, summary
    from barlake.session import scratch_path
    root = scratch_path(spark, "summary")
    first, late = _sparse_loads(spark, d)
    for i, load in enumerate((first, late)):
        writes.write_layer(load.withColumn("date", F.to_date("timestamp")), f"{root}/bronze", mode="append")
        slices = jobs.refresh_silver(spark, landing.read_layer(spark, root, "bronze"), f"{root}/silver", updated_at=AS_OF,
                                     state_path=f"{root}/state", changed=late if i else None)
        if i:
            summary.refresh(spark, f"{root}/silver", f"{root}/summary", slices)
        else:
            summary.build(landing.read_layer(spark, root, "silver"), f"{root}/summary")
    return f"{root}/summary"


@register("summary_coverage", "A04 A06 A13 A14 (kept up to date)", oracle.with_ctes(_LATE_PARTS, """
SELECT symbol, count(*) AS record_count, min("timestamp") AS earliest, max("timestamp") AS latest FROM b_silver GROUP BY symbol"""))
def q_summary_coverage(spark, d):
    from barlake.plans import summary
    return summary.coverage(summary.counts(spark, _silver_summary(spark, d)))


@register("summary_totals", "A05 A07 (kept up to date)", oracle.with_ctes(_LATE_PARTS, """
SELECT source, count(*) AS total_records FROM b_silver GROUP BY source
UNION ALL SELECT 'all', count(*) FROM b_silver"""))
def q_summary_totals(spark, d):
    from barlake.plans import summary
    kept = summary.counts(spark, _silver_summary(spark, d))
    return summary.count_by(kept, "source").unionByName(
        summary.total_rows(kept).select(F.lit("all").alias("source"), F.col("total_rows").alias("total_records")))


@register("summary_distinct_symbols", "A15 (merged sketches, within their stated bound)", oracle.with_ctes(_LATE_PARTS, """
SELECT source, count(DISTINCT symbol) AS symbols, true AS within_bound FROM b_silver GROUP BY source"""))
def q_summary_distinct(spark, d):
    from barlake.plans import summary
    path = _silver_summary(spark, d)
    exact = summary.counts(spark, path).groupBy("source").agg(F.count_distinct("symbol").alias("symbols"))
    miss = F.abs(F.col("symbols_estimate") - F.col("symbols"))
    return exact.join(summary.approx_symbols(spark, path, "source"), "source").select(
        "source", "symbols", (miss <= F.ceil(F.col("symbols") * summary.ERROR_BOUND)).alias("within_bound"))
