"""Joins with the zone dimension and with ranked subsets of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def broadcast_bounded(df: DataFrame) -> DataFrame:
    """Hint a broadcast for a frame whose rows are bounded by construction.

    Such a bound comes from a rank limit times a fixed list of groups, which Spark's own
    estimate cannot see. Callers state it; all other joins are left to Spark's size check.
    """
    return F.broadcast(df)


def with_zone(
    trips: DataFrame, zones: DataFrame, zone_id: str, columns: dict[str, str]
) -> DataFrame:
    """Inner join of trips with the dimension on one of the two zone ids.

    ``columns`` maps dimension columns to output names, so the dimension can be joined
    once as pickup and once as dropoff. The dimension carries file or range statistics,
    which let Spark check its size before it broadcasts it.
    """
    key = f"__{zone_id}"
    side = zones.select(
        F.col("location_id").alias(key), *[F.col(c).alias(name) for c, name in columns.items()]
    )
    return trips.join(side, F.col(zone_id) == F.col(key)).drop(key)


def in_selected_zones(
    trips: DataFrame, selected: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Trips whose pickup zone is in a ranked subset, with the subset's labels.

    The subset has at most its rank limit of zones for each borough of a fixed list.
    """
    side = selected.select(F.col("location_id").alias("__selected"), *columns)
    return trips.join(
        broadcast_bounded(side), F.col("PULocationID") == F.col("__selected")
    ).drop("__selected")


def in_selected_pairs(
    trips: DataFrame, pairs: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Trips on a selected (origin, destination) pair, with the pair's labels.

    The pairs are at most as many as their rank limit.
    """
    side = pairs.select("origin_id", "destination_id", *columns)
    return trips.join(
        broadcast_bounded(side),
        (F.col("PULocationID") == F.col("origin_id"))
        & (F.col("DOLocationID") == F.col("destination_id")),
    ).drop("origin_id", "destination_id")


def is_round_trip() -> Column:
    return F.col("PULocationID") == F.col("DOLocationID")
