"""The operators applied to the test tables, each beside the SQL for the same result."""

from tracewater.bindings import columns, domain, files, flows, relational, reports  # noqa: F401
from tracewater.bindings.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
