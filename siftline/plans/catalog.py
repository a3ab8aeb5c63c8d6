"""All queries over the driver's tables, and their SQL."""

from __future__ import annotations

from . import domains, pages, records, seeds, stored  # noqa: F401  each module registers its queries
from .registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
