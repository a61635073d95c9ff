"""Hand-written bronze rows for the semantic traps (5-10 rows each)."""

from __future__ import annotations

from datetime import datetime, timedelta

from barlake.schema import BRONZE_SCHEMA

T0 = datetime(2024, 1, 1, 0, 0, 0)


def ts(hours: float = 0, days: int = 0) -> datetime:
    return T0 + timedelta(days=days, hours=hours)


def bronze(spark, rows):
    """rows: dicts with any of the bronze columns; defaults fill the rest."""
    out = []
    for i, r in enumerate(rows, start=1):
        d = {"id": i, "timestamp": ts(i), "symbol": "BTC-USD", "open": 10.0, "high": 11.0,
             "low": 9.0, "close": 10.0, "volume": 100.0, "source": "yahoo_finance",
             "ingestion_timestamp": ts(i)}
        d.update(r)
        out.append(tuple(d[f.name] for f in BRONZE_SCHEMA.fields))
    return spark.createDataFrame(out, BRONZE_SCHEMA)
