"""Readers: raw CSV, Parquet tables, landing folders, driver tables."""

from tillroll.sources.csv import read_raw_csv  # noqa: F401
from tillroll.sources.parquet import read_table  # noqa: F401
