"""Frame helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, col: Column) -> DataFrame:
    """Add ``col`` as ``name`` through a one-row Generate.

    Catalyst pushes a filter below a projection by substituting the
    projected expression into the predicate, so an expensive column that
    is later filtered on is otherwise evaluated twice (or once per
    reference).  A predicate on a Generate's output cannot be pushed below
    it, so the column is computed exactly once per row."""
    return df.select("*", F.explode(F.array(col)).alias(name))
