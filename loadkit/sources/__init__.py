"""Readers and writers."""

from loadkit.sources.inferred import Inferred, read_inferred
from loadkit.sources.readers import (
    read_csv, read_extract, read_query, read_table, read_tagged, read_tsv, register_views, run_sql_file)
from loadkit.sources.writers import publish_csv, write_csv

__all__ = ["Inferred", "publish_csv", "read_csv", "read_extract", "read_inferred", "read_query", "read_table", "read_tagged",
           "read_tsv", "register_views", "run_sql_file", "write_csv"]
