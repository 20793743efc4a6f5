"""Readers, writers and the driver-table adapter."""

from .keyed import finish_pending, is_keyed_table, read_keyed, write_keyed
from .readers import (Ingested, ingest_csv, read_catalog_csv, read_credits_csv, read_csv,
                      read_csv_checked, read_ratings_csv, read_table, read_table_footers)
from .writers import to_store_text, write_csv, write_keyed_table

__all__ = [
    "finish_pending", "is_keyed_table", "read_keyed", "write_keyed", "Ingested", "ingest_csv",
    "read_catalog_csv", "read_credits_csv", "read_csv", "read_csv_checked", "read_ratings_csv",
    "read_table", "read_table_footers", "to_store_text", "write_csv", "write_keyed_table",
]
