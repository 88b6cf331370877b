"""Row-wise chart analytics over re-aggregated marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions import trip
from curbline.operators.ranking import top_k

# Score limit, number of colour bands, height of the unit triangle, separator.
SCORE_LIMIT = 3.0
BANDS = (0, 1, 2)
TRIANGLE_HEIGHT = 0.8660254
SEGMENT_SEPARATOR = " · "


def flow_vectors(flows: DataFrame) -> DataFrame:
    """Bearing of the summed displacement and mean distance."""
    return flows.withColumns(
        {
            "bearing_degrees": trip.bearing_degrees(F.col("dx_total"), F.col("dy_total")),
            "mean_distance": F.col("distance_total") / F.col("trip_count"),
        }
    )


def busiest_links(links: DataFrame, k: int = 6) -> DataFrame:
    """The ``k`` largest links of each origin, ties kept, with their mean minutes.

    The input is a re-aggregated slice of candidate pairs, a dozen rows per origin.
    """
    timed = links.withColumn("mean_duration_min", F.col("duration_total") / F.col("trip_count"))
    return top_k(
        timed, ["origin_zone"], "trip_count", k, keep_ties=True, rank_name="destination_rank"
    )


def origin_totals(links: DataFrame, dims: Sequence[str]) -> DataFrame:
    return links.groupBy(*dims).agg(F.sum("trip_count").alias("origin_trip_count"))


def demand_deviation(demand: DataFrame) -> DataFrame:
    """Relative deviation from the expectation, tripled and clamped, split by its sign."""
    count, expected = F.col("trip_count"), F.col("expected_trip_count")
    score = F.col("deviation_score")
    zero = F.lit(0.0)
    return (
        demand.withColumn(
            "deviation_ratio", F.when(expected > 0, (count - expected) / expected).otherwise(0.0)
        )
        .withColumn(
            "deviation_score",
            F.greatest(
                F.lit(-SCORE_LIMIT),
                F.least(F.lit(SCORE_LIMIT), F.col("deviation_ratio") * SCORE_LIMIT),
            ),
        )
        .withColumns(
            {"positive_score": F.greatest(score, zero), "negative_score": F.greatest(-score, zero)}
        )
    )


def horizon_bands(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, side and band: how much of the band the score fills, 0 to 1."""
    sides = scored.select(
        *keys, F.col("positive_score").alias("positive"), F.col("negative_score").alias("negative")
    ).unpivot(list(keys), ["positive", "negative"], "side", "score")
    bands = sides.withColumn("band", F.explode(F.array(*[F.lit(b) for b in BANDS])))
    filled = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score") - F.col("band")))
    return bands.withColumn("band_value", filled)


def fare_shares(receipts: DataFrame) -> DataFrame:
    """Shares of fare, tip and the rest; segments that add up to nothing are dropped."""
    parts = ("fare", "tip", "extras")
    total = F.col("component_total")
    return (
        receipts.withColumn(
            "component_total", F.col("fare_total") + F.col("tip_total") + F.col("extras_total")
        )
        .where(total > 0)
        .withColumns({f"{part}_share": F.col(f"{part}_total") / total for part in parts})
        .withColumn(
            "segment_id",
            F.concat_ws(SEGMENT_SEPARATOR, "pickup_borough", "payment_category", "airport_flag"),
        )
    )


def ternary_coordinates(shares: DataFrame) -> DataFrame:
    """Position in a triangle whose corners are fare, tip and the rest.

    Square roots spread the points that crowd at the fare corner; they are scaled to sum
    to one again.
    """
    roots = {part: F.sqrt(F.col(f"{part}_share")) for part in ("fare", "tip", "extras")}
    whole = roots["fare"] + roots["tip"] + roots["extras"]
    tip, extras = F.col("display_tip_share"), F.col("display_extras_share")
    return shares.withColumns(
        {"display_tip_share": roots["tip"] / whole, "display_extras_share": roots["extras"] / whole}
    ).withColumns(
        {"display_x": extras + tip / 2.0, "display_y": tip * TRIANGLE_HEIGHT}
    )
