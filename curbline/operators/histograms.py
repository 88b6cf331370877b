"""Quantiles out of additive histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The five quantiles and their column names.
FAN_QUANTILES = {
    "p10_minutes": 0.10,
    "p25_minutes": 0.25,
    "median_minutes": 0.50,
    "p75_minutes": 0.75,
    "p90_minutes": 0.90,
}


def histogram_cdf(
    bins: DataFrame, by: Sequence[str], bin_column: str, weight: str
) -> DataFrame:
    """Running and whole weight of each group next to its bins.

    Expects one row per group and bin, so a window holds as many rows as there are bins,
    never one per counted item.
    """
    group = Window.partitionBy(*by)
    upward = group.orderBy(bin_column).rowsBetween(Window.unboundedPreceding, 0)
    cumulative, total = F.col("cumulative_trips"), F.col("total_trips")
    return bins.withColumns(
        {
            "cumulative_trips": F.sum(weight).over(upward),
            "total_trips": F.sum(weight).over(group),
        }
    ).withColumn("cumulative_share", cumulative / total)


def histogram_quantiles(
    bins: DataFrame,
    by: Sequence[str],
    bin_column: str,
    weight: str,
    quantiles: Mapping[str, float] = FAN_QUANTILES,
) -> DataFrame:
    """The lower edge of the first bin whose cumulative share reaches each quantile."""
    reached = {
        name: F.min(F.when(F.col("cumulative_share") >= q, F.col(bin_column)))
        for name, q in quantiles.items()
    }
    return (
        histogram_cdf(bins, by, bin_column, weight)
        .groupBy(*by)
        .agg(
            *[column.alias(name) for name, column in reached.items()],
            F.max("total_trips").alias("trip_count"),
        )
    )
