"""Rows of a frame in a fixed order."""

from __future__ import annotations

from decimal import Decimal


def rows(df, *columns):
    """Rows as a sorted list of tuples, nulls first."""
    selected = df.select(*columns) if columns else df
    out = [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in selected.collect()]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))
