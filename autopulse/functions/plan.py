"""Plan-shaping helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, keep, **cols: Column) -> DataFrame:
    """Evaluate costly per-row expressions once.

    Catalyst pushes a filter below the projection that defines its columns by copying
    the defining expressions into the predicate, so a parsed value used by two filters
    and the output would be parsed three times.  Values produced by a one-element
    generator are not copied that way: they are computed once and filters apply above.
    """
    keep = [k for k in keep if k not in cols]
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))
