"""All queries, collected from the modules that register them."""

from checks import (  # noqa: F401
    dead_letters,
    diagnostics,
    event_state,
    jobs,
    kpis,
    metrics,
    scalars,
    sketches,
    streams,
)
from checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
