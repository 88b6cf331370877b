"""The six additive marts over accepted trips and the zone dimension.

Every mart reads the trips once for its own grain. Marts that show only the busiest zones
read them a second time for the ranking, but that pass needs two integer columns and ships
at most one row per zone (or zone pair) and task. The chosen zones are few by construction
(rank limit x listed boroughs), so they are broadcast and the second read drops all other
trips before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.functions import trip
from curbline.operators.additive import additive_mart
from curbline.operators.joins import (
    in_selected_pairs,
    in_selected_zones,
    is_round_trip,
    with_zone,
)
from curbline.operators.ranking import top_k



# How many zones or destinations the marts keep.
FLOW_ZONES_PER_BOROUGH = 20
PROFILE_ZONES_PER_BOROUGH = 5
DEMAND_ZONES_PER_BOROUGH = 2
ORIGINS_PER_BOROUGH = 3
PINNED_ORIGIN = 161
DESTINATIONS_PER_ORIGIN = 12

PLACE = {"zone": "pickup_zone", "borough": "pickup_borough"}
POINT = {"longitude": "longitude", "latitude": "latitude"}


def _flag():
    return trip.airport_flag(F.col("PULocationID"), F.col("DOLocationID")).alias("airport_flag")


def airport_histogram(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Weekday rides to an airport, counted in two-minute bins."""
    rides = trips.where(
        F.col("pickup_day_of_week").between(2, 6)
        & F.col("DOLocationID").isin(*trip.AIRPORT_ZONE_IDS)
        & F.col("duration_min").between(5.0, 180.0)
    )
    listed = zones.where(F.col("borough").isin(*trip.ALL_BOROUGHS))
    return additive_mart(
        with_zone(rides, listed, "PULocationID", {"borough": "pickup_borough"}).select(
            "trip_date",
            "pickup_hour",
            "pickup_borough",
            trip.airport_code(F.col("DOLocationID")).alias("airport"),
            F.lit(trip.AIRPORT_TRIP).alias("airport_flag"),
            trip.lower_bin_edge(F.col("duration_min"), 2).alias("duration_bin_minutes"),
        ),
        [
            "trip_date",
            "pickup_hour",
            "pickup_borough",
            "airport",
            "airport_flag",
            "duration_bin_minutes",
        ],
        {"bin_trip_count": F.lit(1)},
    )


def weight_of(rides: DataFrame) -> Column:
    """How many rides a row stands for: itself, or the rides of its pair."""
    return F.col("pair_trips") if "pair_trips" in rides.columns else F.lit(1)


def zone_totals(
    trips: DataFrame, zones: DataFrame, columns: dict[str, str], total: str
) -> DataFrame:
    """Trips per pickup zone, from trips or from ``all_pair_totals``; labels join after the
    count, on at most one row per zone."""
    counted = trips.groupBy("PULocationID").agg(F.sum(weight_of(trips)).alias(total))
    return with_zone(
        counted, zones, "PULocationID", {"location_id": "location_id", **columns}
    ).drop("PULocationID")


def city_zones(zones: DataFrame) -> DataFrame:
    """Zones of the five boroughs that are not airports."""
    return zones.where(
        F.col("borough").isin(*trip.CITY_BOROUGHS)
        & ~F.col("location_id").isin(*trip.AIRPORT_ZONE_IDS)
    )


def busiest_flow_zones(trips: DataFrame, zones: DataFrame, k: int = FLOW_ZONES_PER_BOROUGH):
    listed = zones.where(F.col("borough").isin(*trip.ALL_BOROUGHS))
    totals = zone_totals(
        trips.where(~is_round_trip()), listed, {**PLACE, **POINT}, "annual_trip_count"
    )
    return top_k(
        totals, ["pickup_borough"], "annual_trip_count", k, ["location_id"], rank_name="borough_rank"
    )


def busiest_city_zones(trips: DataFrame, zones: DataFrame, k: int) -> DataFrame:
    """As above, but rides that end in their own zone count as well."""
    totals = zone_totals(trips, city_zones(zones), PLACE, "annual_trip_count")
    return top_k(
        totals, ["pickup_borough"], "annual_trip_count", k, ["location_id"], rank_name="borough_rank"
    )


def directional_flow(
    trips: DataFrame, zones: DataFrame, k: int = FLOW_ZONES_PER_BOROUGH
) -> DataFrame:
    """Summed displacement of the rides that leave each of the busiest zones."""
    moving = trips.where(~is_round_trip()).select(
        "trip_date", "pickup_hour", "PULocationID", "DOLocationID", "trip_distance"
    )
    chosen = busiest_flow_zones(trips, zones, k)
    leaving = in_selected_zones(
        moving,
        chosen,
        ["pickup_zone", "pickup_borough", "longitude", "latitude"],
    )
    ends = {"longitude": "end_longitude", "latitude": "end_latitude"}
    return additive_mart(
        with_zone(leaving, zones, "DOLocationID", ends).withColumn("airport_flag", _flag()),
        [
            "trip_date",
            "pickup_hour",
            "pickup_zone",
            "pickup_borough",
            "airport_flag",
            "longitude",
            "latitude",
        ],
        {
            "trip_count": F.lit(1),
            "distance_total": F.col("trip_distance"),
            "dx_total": F.col("end_longitude") - F.col("longitude"),
            "dy_total": F.col("end_latitude") - F.col("latitude"),
        },
    )


def pair_totals(trips: DataFrame) -> DataFrame:
    """Trips per (origin, destination) between different zones: the only full pass that
    the choice of origins and of destinations needs."""
    return all_pair_totals(trips.where(~is_round_trip()))


def all_pair_totals(trips: DataFrame) -> DataFrame:
    """Trips per (origin, destination), round trips included."""
    return trips.groupBy("PULocationID", "DOLocationID").agg(F.sum(weight_of(trips)).alias("pair_trips"))


def selected_origins(
    pairs: DataFrame, zones: DataFrame, k: int = ORIGINS_PER_BOROUGH, pinned: int = PINNED_ORIGIN
) -> DataFrame:
    """The busiest origins of each borough and one pinned origin whatever its rank."""
    totals = pairs.groupBy("PULocationID").agg(F.sum("pair_trips").alias("origin_trip_count"))
    labelled = with_zone(
        totals,
        city_zones(zones),
        "PULocationID",
        {
            "location_id": "location_id",
            "zone": "origin_zone",
            "borough": "pickup_borough",
            "longitude": "origin_longitude",
            "latitude": "origin_latitude",
        },
    ).drop("PULocationID")
    return top_k(
        labelled,
        ["pickup_borough"],
        "origin_trip_count",
        k,
        ["location_id"],
        pinned=F.col("location_id") == pinned,
        rank_name="borough_rank",
    )


def selected_pairs(
    trips: DataFrame, zones: DataFrame, k: int = DESTINATIONS_PER_ORIGIN
) -> DataFrame:
    """The most frequent destinations of each selected origin over the whole period."""
    pairs = pair_totals(trips)
    origins = selected_origins(pairs, zones)
    columns = ["origin_zone", "pickup_borough", "origin_longitude", "origin_latitude"]
    from_origins = in_selected_zones(pairs, origins, columns)
    labelled = with_zone(
        from_origins,
        zones,
        "DOLocationID",
        {
            "zone": "destination_zone",
            "longitude": "destination_longitude",
            "latitude": "destination_latitude",
        },
    ).withColumnsRenamed(
        {
            "PULocationID": "origin_id",
            "DOLocationID": "destination_id",
            "pair_trips": "annual_trip_count",
        }
    )
    return top_k(
        labelled,
        ["origin_id"],
        "annual_trip_count",
        k,
        ["destination_id"],
        rank_name="destination_rank",
    )


PAIR_LABELS = [
    "pickup_borough",
    "origin_zone",
    "destination_zone",
    "origin_longitude",
    "origin_latitude",
    "destination_longitude",
    "destination_latitude",
]


def od_connections(
    trips: DataFrame, zones: DataFrame, k: int = DESTINATIONS_PER_ORIGIN
) -> DataFrame:
    """Rides and minutes on the selected pairs."""
    rides = trips.select(
        "trip_date", "pickup_hour", "PULocationID", "DOLocationID", "duration_min"
    )
    on_pairs = in_selected_pairs(rides, selected_pairs(trips, zones, k), PAIR_LABELS)
    return additive_mart(
        on_pairs.withColumn("airport_flag", _flag()),
        ["trip_date", "pickup_hour", "airport_flag", *PAIR_LABELS],
        {"trip_count": F.lit(1), "duration_total": F.col("duration_min")},
    )


def operating_profile(
    trips: DataFrame, zones: DataFrame, k: int = PROFILE_ZONES_PER_BOROUGH
) -> DataFrame:
    """Seven additive measures of the busiest zones."""
    card = F.col("payment_type") == 1
    long_enough = F.col("trip_distance") >= 0.5
    chosen = busiest_city_zones(trips, zones, k)
    rides = in_selected_zones(
        trips, chosen, ["pickup_zone", "pickup_borough"]
    )
    at_airport = trip.touches_airport(F.col("PULocationID"), F.col("DOLocationID"))
    return additive_mart(
        rides.withColumn("airport_flag", _flag()),
        ["trip_date", "pickup_hour", "pickup_zone", "pickup_borough", "airport_flag"],
        {
            "trip_count": F.lit(1),
            "duration_total": F.col("duration_min"),
            # an unknown fare adds nothing here but its ride is counted below
            "fare_per_mile_total": F.when(
                long_enough, F.col("fare_amount") / F.col("trip_distance")
            ).otherwise(0.0),
            "fare_per_mile_count": F.when(long_enough, 1).otherwise(0),
            "card_trip_count": F.when(card, 1).otherwise(0),
            "tipped_card_count": F.when(card & (F.col("tip_amount") > 0), 1).otherwise(0),
            "airport_trip_count": F.when(at_airport, 1).otherwise(0),
        },
    )


def demand_horizon(
    trips: DataFrame, zones: DataFrame, k: int = DEMAND_ZONES_PER_BOROUGH
) -> DataFrame:
    """Daily rides of the busiest zones next to the mean of the same weekday and hour."""
    chosen = busiest_city_zones(trips, zones, k)
    rides = in_selected_zones(
        trips, chosen, ["pickup_zone", "pickup_borough"]
    )
    daily = additive_mart(
        rides.withColumn("airport_flag", _flag()),
        [
            "trip_date",
            "pickup_day_of_week",
            "pickup_hour",
            "pickup_zone",
            "pickup_borough",
            "airport_flag",
        ],
        {"trip_count": F.lit(1)},
    )
    return with_seasonal_baseline(daily).drop("pickup_day_of_week")


def with_seasonal_baseline(daily: DataFrame) -> DataFrame:
    """Mean over the days that had rides; days without any are not filled in with zero.

    A window partition holds one row per matching date and borough, not one per ride.
    """
    season = Window.partitionBy("pickup_zone", "pickup_day_of_week", "pickup_hour", "airport_flag")
    return daily.withColumn("expected_trip_count", F.avg("trip_count").over(season))


# One row for each pair of zones, date and hour: four of the marts follow from it.
PAIR_DIMS = ["trip_date", "pickup_hour", "PULocationID", "DOLocationID"]


def pair_hours(trips: DataFrame) -> DataFrame:
    """Additive measures of each pair of zones, date and hour."""
    card, long_enough = F.col("payment_type") == 1, F.col("trip_distance") >= 0.5
    return additive_mart(
        trips,
        PAIR_DIMS,
        {
            "pair_trips": F.lit(1),
            "duration_total": F.col("duration_min"),
            "distance_total": F.col("trip_distance"),
            "fare_per_mile_total": F.when(long_enough, F.col("fare_amount") / F.col("trip_distance")).otherwise(0.0),
            "fare_per_mile_count": F.when(long_enough, 1).otherwise(0),
            "card_trip_count": F.when(card, 1).otherwise(0),
            "tipped_card_count": F.when(card & (F.col("tip_amount") > 0), 1).otherwise(0),
        },
    )


def flow_of_pairs(rows: DataFrame, chosen: DataFrame, zones: DataFrame) -> DataFrame:
    """``directional_flow`` from pair hours and its chosen zones."""
    labels = ["pickup_zone", "pickup_borough", "longitude", "latitude"]
    leaving = in_selected_zones(rows.where(~is_round_trip()), chosen, labels)
    ends = {"longitude": "end_longitude", "latitude": "end_latitude"}
    trips = F.col("pair_trips")
    return additive_mart(
        with_zone(leaving, zones, "DOLocationID", ends).withColumn("airport_flag", _flag()),
        ["trip_date", "pickup_hour", "pickup_zone", "pickup_borough", "airport_flag", "longitude", "latitude"],
        {
            "trip_count": trips,
            "distance_total": F.col("distance_total"),
            "dx_total": trips * (F.col("end_longitude") - F.col("longitude")),
            "dy_total": trips * (F.col("end_latitude") - F.col("latitude")),
        },
    )


def od_of_pairs(rows: DataFrame, chosen: DataFrame, zones: DataFrame) -> DataFrame:
    """``od_connections`` from pair hours and its chosen pairs."""
    on_pairs = in_selected_pairs(rows, chosen, PAIR_LABELS)
    return additive_mart(
        on_pairs.withColumn("airport_flag", _flag()),
        ["trip_date", "pickup_hour", "airport_flag", *PAIR_LABELS],
        {"trip_count": F.col("pair_trips"), "duration_total": F.col("duration_total")},
    )


def profile_of_pairs(rows: DataFrame, chosen: DataFrame, zones: DataFrame) -> DataFrame:
    """``operating_profile`` from pair hours and its chosen zones."""
    rides = in_selected_zones(rows, chosen, ["pickup_zone", "pickup_borough"])
    at_airport = trip.touches_airport(F.col("PULocationID"), F.col("DOLocationID"))
    sums = ("duration_total", "fare_per_mile_total", "fare_per_mile_count", "card_trip_count", "tipped_card_count")
    return additive_mart(
        rides.withColumn("airport_flag", _flag()),
        ["trip_date", "pickup_hour", "pickup_zone", "pickup_borough", "airport_flag"],
        {
            "trip_count": F.col("pair_trips"),
            **{name: F.col(name) for name in sums},
            "airport_trip_count": F.when(at_airport, F.col("pair_trips")).otherwise(0),
        },
    )


def horizon_of_pairs(rows: DataFrame, chosen: DataFrame, zones: DataFrame) -> DataFrame:
    """``demand_horizon`` from pair hours and its chosen zones."""
    rides = in_selected_zones(rows, chosen, ["pickup_zone", "pickup_borough"]).withColumns(
        {"airport_flag": _flag(), "pickup_day_of_week": F.dayofweek("trip_date")}
    )
    dims = ["trip_date", "pickup_day_of_week", "pickup_hour", "pickup_zone", "pickup_borough", "airport_flag"]
    daily = additive_mart(rides, dims, {"trip_count": F.col("pair_trips")})
    return with_seasonal_baseline(daily).drop("pickup_day_of_week")


@dataclass(frozen=True)
class ChosenMart:
    """A mart over the pairs, or over all pairs of the origins, that are chosen by totals over the whole period."""

    keys: tuple[str, ...]
    choose: Callable[[DataFrame, DataFrame], DataFrame]
    build: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]


#: Columns of the chosen rows, by the columns of the pair hours that they select.
CHOSEN_KEYS = {"PULocationID": ("location_id", "origin_id"), "DOLocationID": ("destination_id",)}

CHOSEN_MARTS = {
    "directional_flow": ChosenMart(("PULocationID",), lambda pairs, zones: busiest_flow_zones(pairs, zones), flow_of_pairs),
    "od_connection": ChosenMart(("PULocationID", "DOLocationID"), lambda pairs, zones: selected_pairs(pairs, zones), od_of_pairs),
    "parallel_coordinates": ChosenMart(
        ("PULocationID",), lambda pairs, zones: busiest_city_zones(pairs, zones, PROFILE_ZONES_PER_BOROUGH), profile_of_pairs
    ),
    "horizon": ChosenMart(
        ("PULocationID",), lambda pairs, zones: busiest_city_zones(pairs, zones, DEMAND_ZONES_PER_BOROUGH), horizon_of_pairs
    ),
}

FARE_DIMS = ["trip_date", "pickup_hour", "pickup_borough", "payment_category", "airport_flag"]


def fare_composition(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Receipt totals split into fare, tip and the rest, none of them below zero."""
    fare = trip.at_least_zero(F.col("fare_amount"))
    tip = trip.at_least_zero(F.col("tip_amount"))
    listed = zones.where(F.col("borough").isin(*trip.ALL_BOROUGHS))
    paid = with_zone(
        trips.where(F.col("total_amount") > 0),
        listed,
        "PULocationID",
        {"borough": "pickup_borough"},
    )
    return additive_mart(
        paid.withColumns(
            {
                "payment_category": trip.payment_category(F.col("payment_type")),
                "airport_flag": _flag(),
            }
        ),
        FARE_DIMS,
        {
            "trip_count": F.lit(1),
            "fare_total": fare,
            "tip_total": tip,
            "extras_total": trip.at_least_zero(F.col("total_amount") - fare - tip),
        },
    )


MARTS = {
    "airport_quantile": airport_histogram,
    "directional_flow": directional_flow,
    "od_connection": od_connections,
    "parallel_coordinates": operating_profile,
    "horizon": demand_horizon,
    "fare_ternary": fare_composition,
}
