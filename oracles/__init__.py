"""The SQL that each registered query must agree with, for DuckDB."""

from __future__ import annotations

import re

from oracles.reports import SELECTS
from oracles.views import VIEWS


def _mentions(sql: str) -> list[str]:
    words = set(re.findall(r"\w+", sql))
    return [name for name in VIEWS if name in words]


def with_views(select: str) -> str:
    """Prefix a SELECT with the views it needs, in the order of their definition."""
    needed: set[str] = set()
    pending = _mentions(select)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending += _mentions(VIEWS[name])
    views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in needed)
    return f"WITH {views}\n{select.strip()}" if views else select.strip()


ORACLES = {name: with_views(sql) for name, sql in SELECTS.items()}
