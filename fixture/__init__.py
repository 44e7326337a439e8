"""Deterministic billing tables derived from the driver's parquet tables (rules in FIXTURES.md)."""
