"""Structured Streaming versions of the load, clean and roll-up jobs."""

from barlake.streaming.jobs import (  # noqa: F401
    dedup_stream, expire_changes, run_bronze_stream, run_daily_bars_stream, run_gold_stream, run_silver_stream,
)
