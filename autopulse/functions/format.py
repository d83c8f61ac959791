"""Record formatting and value bucketing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from autopulse.functions._cols import to_col


def format_record(*names: str, cols: dict | None = None) -> Column:
    """`name1=value1<TAB>name2=value2...`; NULL values render as `null` like JVM interpolation."""
    cols = cols or {}
    parts = [
        F.concat(F.lit(n + "="), F.coalesce(to_col(cols.get(n, n)).cast("string"), F.lit("null")))
        for n in names
    ]
    return F.concat_ws("\t", *parts)


def bucket(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """First label whose upper edge is strictly above the value; else the last label.

    NULL and NaN land in the last label, as with a chain of `when(c < edge)`.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    c = to_col(c)
    expr = None
    for edge, label in zip(edges, labels):
        expr = F.when(c < edge, label) if expr is None else expr.when(c < edge, label)
    return expr.otherwise(labels[-1]) if expr is not None else F.lit(labels[-1])
