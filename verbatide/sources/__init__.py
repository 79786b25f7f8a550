"""Reading and writing tables and fitted models."""

from verbatide.sources.readers import read_source
from verbatide.sources.writers import append_once, append_rows, drop_table, load_model, load_term_model, save_csv, save_model, save_term_model

__all__ = [
    "append_once",
    "append_rows",
    "drop_table",
    "load_model",
    "load_term_model",
    "read_source",
    "save_csv",
    "save_model",
    "save_term_model",
]
