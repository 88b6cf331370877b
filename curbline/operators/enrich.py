"""Derived trip columns and the accepted-trip layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions import trip
from curbline.operators import quality

# Column order of accepted trips.
ACCEPTED_COLUMNS = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_date",
    "pickup_month",
    "pickup_hour",
    "pickup_day_of_week",
    "day_type",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "trip_distance",
    "duration_min",
    "speed_mph",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "payment_type",
    "RatecodeID",
    "VendorID",
    "Airport_fee",
    "cbd_congestion_fee",
)


def with_trip_columns(df: DataFrame) -> DataFrame:
    """Calendar parts of the pickup, minutes on the way and mean speed."""
    pickup = F.col("tpep_pickup_datetime")
    seconds = trip.elapsed_seconds(pickup, F.col("tpep_dropoff_datetime"))
    return df.withColumns(
        {
            "trip_date": F.to_date(pickup),
            "pickup_month": F.month(pickup),
            "pickup_hour": F.hour(pickup),
            "pickup_day_of_week": F.dayofweek(pickup),
            "day_type": trip.day_type(pickup),
            "duration_min": trip.minutes(seconds),
            "speed_mph": trip.miles_per_hour(F.col("trip_distance"), seconds),
        }
    )


def accepted_trips(raw: DataFrame, rules: Sequence[quality.Rule]) -> DataFrame:
    return with_trip_columns(quality.accepted(raw, rules)).select(*ACCEPTED_COLUMNS)


def quarantined_trips(raw: DataFrame, rules: Sequence[quality.Rule]) -> DataFrame:
    return with_trip_columns(quality.quarantined(raw, rules))
