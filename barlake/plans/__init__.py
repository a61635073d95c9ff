"""Composite pipelines: silver (C03), gold (C04), ingest (C01/C02), serving."""
