"""Readers: delimited text, Parquet, JSON payloads, file lists, images, wide tables."""
