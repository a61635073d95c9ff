"""Keyed deduplication.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ...) = 1`` is planned by Spark
as a *partial* WindowGroupLimit before the shuffle and a final one after it,
so every map task already keeps only its best row per key: a hot group of
copies (even a third of all rows) shrinks to one row per map task before it
is exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_ingested_order(ingestion_col: str = "ingestion_timestamp",
                          tie_breakers: Sequence[Column] | None = None) -> list[Column]:
    """Last ingestion wins; a NULL ingestion time sorts first (as DESC does in
    the original database).  Ties are broken by source, then id, so the winner is
    deterministic."""
    ties = list(tie_breakers) if tie_breakers is not None else [
        F.col("source").asc_nulls_last(), F.col("id").asc_nulls_last()]
    return [F.col(ingestion_col).desc_nulls_first(), *ties]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under `order`."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_latest(df: DataFrame, keys: Sequence[str] = ("timestamp", "symbol"),
                 order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key, the most recently ingested (W01 + F02)."""
    cols = df.columns
    if order is None:
        ties = [F.col(c).asc_nulls_last() for c in ("source", "id") if c in cols]
        order = latest_ingested_order(tie_breakers=ties)
    return first_per_key(df, keys, order)
