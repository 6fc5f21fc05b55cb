from kindred.sources.checks import require_row_counts, row_counts
from kindred.sources.loading import Loaded, load_ratings
from kindred.sources.reports import read_report, write_report
from kindred.sources.text import (
    read_catalog,
    read_personal,
    read_ratings,
    write_catalog,
    write_ratings,
)

__all__ = [
    "Loaded",
    "load_ratings",
    "read_catalog",
    "read_personal",
    "read_ratings",
    "read_report",
    "require_row_counts",
    "row_counts",
    "write_catalog",
    "write_ratings",
    "write_report",
]
