"""Readers, schema normalisation, fixture mappings and sinks."""

from weekcast.sources.readers import read_table, table_path
from weekcast.sources.normalize import standardize_columns, canonical_rename, coerce_types, consolidate_schema

__all__ = ["read_table", "table_path", "standardize_columns", "canonical_rename",
           "coerce_types", "consolidate_schema"]
