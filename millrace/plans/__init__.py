"""The operators bound to the input tables, each next to SQL that gives the same rows."""

from millrace.plans import (  # noqa: F401
    aggregating,
    cleaning,
    graphs,
    joining,
    learning,
    roundtrips,
    scalars,
    streams,
)
from millrace.plans.registry import ORACLES, QUERIES  # noqa: F401
