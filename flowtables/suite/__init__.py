"""Checked queries: every operator over the given tables, with an independent SQL twin."""

from flowtables.suite import (  # noqa: F401
    flow,
    hierarchy,
    naming,
    refs,
    rules,
    snapshots,
    sparse,
    streams,
)
from flowtables.suite.registry import QUERIES, SQL  # noqa: F401
