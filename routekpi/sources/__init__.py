"""Sources: raw CSV loads, the seed, and adapters over the driver's tables."""

from .csv_raw import csv_reader, empty_raw, read_raw_csv, seed_frame, union_sources

__all__ = ["csv_reader", "empty_raw", "read_raw_csv", "seed_frame", "union_sources"]
