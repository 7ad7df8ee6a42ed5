"""Sources: parquet scans, literal dimensions, case-table bindings."""

from .bindings import CaseTables, bind
from .layout import bucketed
from .store import read_batches, remove_unused, write_batch
from .tables import append_rows, load, materialise, rows_table

__all__ = ["CaseTables", "bind", "append_rows", "load", "materialise", "rows_table",
           "bucketed", "read_batches", "remove_unused", "write_batch"]
