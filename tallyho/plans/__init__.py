"""Query catalog (Spark) and its SQL oracle (DuckDB)."""

from .catalog import QUERIES
from .oracle import SQL

FLAGSHIP = "top_names_per_day"

__all__ = ["FLAGSHIP", "QUERIES", "SQL"]
