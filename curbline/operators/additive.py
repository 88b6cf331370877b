"""Additive tables: sums that can be summed again over any slice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def additive_mart(
    df: DataFrame, dims: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """Group and sum.

    Spark sums map-side first, so a task ships at most one row per group it saw and a
    group that holds a third of the input costs no more to shuffle than any other.
    """
    return df.groupBy(*dims).agg(*[F.sum(m).alias(name) for name, m in measures.items()])


def resum(parts: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Bring partial sums of the same mart together: one row per group again."""
    measures = [c for c in parts.columns if c not in dims]
    return additive_mart(parts, dims, {c: F.col(c) for c in measures})


def merge_additive(stored: DataFrame, delta: DataFrame, dims: Sequence[str]) -> DataFrame:
    """A stored mart plus the sums of newly arrived rows."""
    return resum(stored.unionByName(delta), dims)
