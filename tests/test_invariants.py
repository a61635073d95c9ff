"""Invariants of the layers on the driver's tables."""

import pytest
from pyspark.sql import functions as F

from barlake.catalog import gold, raw, silver
from barlake.operators.dedup import dedup_latest

from conftest import SF_GATE


@pytest.fixture(scope="module")
def layers(spark):
    return raw(spark, SF_GATE), silver(spark, SF_GATE), gold(spark, SF_GATE)


def test_bars_keep_low_open_close_high_order(layers):
    """Where the input obeys it: rows whose open/high/low were all present
    (a missing high is repaired to the close, which may sit below the open)."""
    from barlake.plans.gold import build_gold
    _, s, _ = layers
    complete = s.filter((F.col("flag_missing_open") == 0) & (F.col("flag_missing_high") == 0)
                        & (F.col("flag_missing_low") == 0))
    assert complete.count() > 0.8 * s.count()
    for df in (complete, build_gold(complete)):
        bad = df.filter((F.col("low") > F.col("open")) | (F.col("open") > F.col("high"))
                        | (F.col("low") > F.col("close")) | (F.col("close") > F.col("high")))
        assert bad.count() == 0


def test_daily_points_add_up_to_silver_rows(layers):
    _, s, g = layers
    assert g.agg(F.sum("data_points")).first()[0] == s.count()
    assert g.agg(F.sum("volume")).first()[0] == s.agg(F.sum("volume")).first()[0]


def test_dedup_is_idempotent_and_keys_are_unique(layers):
    r, s, _ = layers
    once = dedup_latest(r)
    assert once.exceptAll(dedup_latest(once)).count() == 0
    assert s.groupBy("timestamp", "symbol").count().filter("count > 1").count() == 0


def test_silver_returns_within_outlier_bound(layers):
    _, s, _ = layers
    assert s.filter(F.abs(F.col("simple_return_pct")) >= 100).count() == 0
    assert s.filter(F.col("simple_return_pct").isNull()).select("symbol").distinct().count() == \
        s.select("symbol").distinct().count()          # exactly the first row of each symbol
