"""Readers and writers."""

from devfold.sources.tables import (
    load_model,
    read_inferred,
    read_table,
    save_model,
    write_csv,
)

__all__ = ["load_model", "read_inferred", "read_table", "save_model", "write_csv"]
