"""Ratios of operating measures, folded to axes and scaled for parallel coordinates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions import text
from curbline.operators.joins import broadcast_bounded

# Axis order and the smallest span that is divided by.
AXES = ("trip_count", "mean_duration_min", "mean_fare_per_mile", "card_tip_rate", "airport_share")
SMALLEST_SPAN = 0.000001


def profile_ratios(totals: DataFrame) -> DataFrame:
    """Ratios are taken after summing; counts that may be zero are divided as one."""
    trips = F.col("trip_count")
    return totals.select(
        F.col("pickup_zone").alias("profile_id"),
        "pickup_zone",
        "pickup_borough",
        "trip_count",
        (F.col("duration_total") / trips).alias("mean_duration_min"),
        _ratio("fare_per_mile_total", "fare_per_mile_count").alias("mean_fare_per_mile"),
        _ratio("tipped_card_count", "card_trip_count").alias("card_tip_rate"),
        (F.col("airport_trip_count") / trips).alias("airport_share"),
    )


def _ratio(total: str, count: str) -> Column:
    return F.col(total) / F.greatest(F.lit(1), F.col(count))


def fold_axes(profiles: DataFrame, axes: Sequence[str] = AXES) -> DataFrame:
    """One row per profile and axis; the axis position follows the given order."""
    kept = [c for c in profiles.columns if c not in axes]
    folded = profiles.select(
        *kept, *[F.col(a).cast("double").alias(a) for a in axes]
    ).unpivot(kept, list(axes), "key", "value")
    position = F.array_position(F.array(*[F.lit(a) for a in axes]), F.col("key")) - 1
    return folded.withColumn("axis_order", position.cast("int"))


def with_axis_range(folded: DataFrame) -> DataFrame:
    """Smallest and largest value of each axis next to its rows.

    With so few axes a window would pull a large share of all rows into one task. The
    ranges are summed up map-side instead and come back as one broadcast row per axis.
    """
    ranges = folded.groupBy("key").agg(
        F.min("value").alias("axis_min"), F.max("value").alias("axis_max")
    )
    return folded.join(broadcast_bounded(ranges), "key")


def normalized(ranged: DataFrame) -> DataFrame:
    span = F.greatest(F.lit(SMALLEST_SPAN), F.col("axis_max") - F.col("axis_min"))
    return ranged.withColumn("norm_value", (F.col("value") - F.col("axis_min")) / span)


def with_axis_labels(ranged: DataFrame) -> DataFrame:
    return ranged.withColumns(
        {f"{end}_label": _axis_label(F.col("key"), F.col(end)) for end in ("axis_min", "axis_max")}
    )


def _axis_label(key: Column, value: Column) -> Column:
    return (
        F.when(key == "trip_count", text.si_text(value))
        .when(
            key == "mean_duration_min",
            F.concat(text.patterned(value, "0.0"), F.lit(" min")),
        )
        .when(
            key == "mean_fare_per_mile",
            F.concat(F.lit("$"), text.patterned(value, "0.00")),
        )
        .otherwise(F.concat(text.patterned(value * 100, "0"), F.lit("%")))
    )
