"""Readers of the raw sources and the partitioned layer store."""
