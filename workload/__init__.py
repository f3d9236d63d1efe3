"""Every operator as a query over the given tables, with its SQL counterpart where one exists."""

from workload import (  # noqa: F401 - importing a module registers its queries
    aggregates,
    calibration,
    cover,
    inputs,
    joins,
    names_time,
    selection,
    store,
    streams,
)
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
