"""Datasets over the marts, and the grouped query behind each chart."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from curbline.operators.slicing import Slice, widget_query

FILTER_FIELDS = ("pickup_hour", "trip_date", "pickup_borough", "airport_flag")

# The dimensions and measures of each dataset's chart.
WIDGET_DIMS: dict[str, tuple[str, ...]] = {
    "airport_quantile": ("airport", "pickup_hour", "duration_bin_minutes"),
    "directional_flow": ("pickup_zone", "pickup_borough", "longitude", "latitude"),
    "od_connection": (
        "pickup_borough",
        "origin_zone",
        "destination_zone",
        "origin_longitude",
        "origin_latitude",
        "destination_longitude",
        "destination_latitude",
    ),
    "parallel_coordinates": ("pickup_zone", "pickup_borough"),
    "horizon": ("trip_date", "pickup_zone", "pickup_borough"),
    "fare_ternary": ("pickup_borough", "payment_category", "airport_flag"),
}
WIDGET_SUMS: dict[str, tuple[str, ...]] = {
    "airport_quantile": ("bin_trip_count",),
    "directional_flow": ("trip_count", "distance_total", "dx_total", "dy_total"),
    "od_connection": ("trip_count", "duration_total"),
    "parallel_coordinates": (
        "trip_count",
        "duration_total",
        "fare_per_mile_total",
        "fare_per_mile_count",
        "card_trip_count",
        "tipped_card_count",
        "airport_trip_count",
    ),
    "horizon": ("trip_count", "expected_trip_count"),
    "fare_ternary": ("trip_count", "fare_total", "tip_total", "extras_total"),
}

# The scenario under which every dataset must still return rows.
SCENARIO = Slice(
    hours=(8, 9),
    boroughs=("Queens",),
    airport_flags=("Airport",),
    first_date="2025-10-01",
    last_date="2025-12-31",
)


def dataset_fields(name: str) -> list[str]:
    fields = [*FILTER_FIELDS, *WIDGET_DIMS[name], *WIDGET_SUMS[name]]
    return list(dict.fromkeys(fields))


def widget(dataset: DataFrame, name: str, where: Slice = Slice()) -> DataFrame:
    sums: Mapping[str, tuple[str, str]] = {c: ("sum", c) for c in WIDGET_SUMS[name]}
    return widget_query(dataset, WIDGET_DIMS[name], sums, where)
