"""Readers: JSON/Parquet files, snapshot tables, watermark state, views."""
