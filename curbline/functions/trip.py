"""Column expressions over one trip record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone ids of the three airports and the borough lists.
AIRPORT_ZONE_IDS = (1, 132, 138)
AIRPORT_CODES = {132: "JFK", 138: "LGA", 1: "EWR"}
CITY_BOROUGHS = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island")
ALL_BOROUGHS = CITY_BOROUGHS + ("EWR",)

# Labels.
AIRPORT_TRIP, OTHER_TRIP = "Airport", "Non-airport"
PAYMENT_LABELS = {1: "Credit card", 2: "Cash"}
PAYMENT_REST = "Other"


def touches_airport(pickup: Column, dropoff: Column) -> Column:
    return pickup.isin(*AIRPORT_ZONE_IDS) | dropoff.isin(*AIRPORT_ZONE_IDS)


def airport_flag(pickup: Column, dropoff: Column) -> Column:
    """``Airport`` when either end is an airport zone; unknown ends count as not."""
    return F.when(touches_airport(pickup, dropoff), AIRPORT_TRIP).otherwise(OTHER_TRIP)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from start to end; fractions of both ends are dropped first."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minutes(seconds: Column) -> Column:
    return seconds.cast("double") / 60.0


def miles_per_hour(miles: Column, seconds: Column) -> Column:
    """NULL for a trip of zero seconds, which plain ``/`` would reject in ANSI mode."""
    return F.try_divide(miles, seconds.cast("double") / 3600.0)


def day_type(timestamp: Column) -> Column:
    """Day numbers run from Sunday = 1 to Saturday = 7."""
    return F.when(F.dayofweek(timestamp).isin(1, 7), "Weekend").otherwise("Weekday")


def labelled(value: Column, labels: Mapping) -> Column:
    """The label of a value; NULL for values without one."""
    return F.coalesce(*[F.when(value == key, label) for key, label in labels.items()])


def airport_code(zone_id: Column) -> Column:
    return labelled(zone_id, AIRPORT_CODES)


def lower_bin_edge(value: Column, width: int) -> Column:
    return (F.floor(value / float(width)) * width).cast("int")


def payment_category(payment_type: Column) -> Column:
    return F.coalesce(labelled(payment_type, PAYMENT_LABELS), F.lit(PAYMENT_REST))


def at_least_zero(value: Column) -> Column:
    """``greatest`` ignores NULL, so an unknown amount becomes zero."""
    return F.greatest(value, F.lit(0.0))


def hour_label(hour: Column) -> Column:
    return F.format_string("%02d:00", hour)


def hour_axis_label(hour: Column) -> Column:
    """12a, 4a, 12p, 8p."""
    return (
        F.when(hour == 0, "12a")
        .when(hour < 12, F.concat(hour.cast("string"), F.lit("a")))
        .when(hour == 12, "12p")
        .otherwise(F.concat((hour - 12).cast("string"), F.lit("p")))
    )


def bearing_degrees(dx: Column, dy: Column) -> Column:
    """Mathematical angle (0 = east, counter-clockwise) in [0, 360)."""
    return (F.atan2(dy, dx) * 180.0 / F.pi() + 360.0) % 360.0
