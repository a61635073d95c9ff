"""barlake: a PySpark-native OHLCV bar lake.

Three layers expressed as DataFrame functions:

* bronze  - raw bars, loaded with conflict-ignoring idempotent writes
* silver  - deduplicated, repaired, flagged bars with returns and spreads
* gold    - daily bars per symbol with daily metrics

plus declarative data-quality suites, freshness checks, serving queries and
Structured Streaming versions of the load, clean and roll-up jobs.
"""

__all__ = ["session", "schema"]
