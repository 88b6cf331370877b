"""Named row rules: rejection reasons, accept/quarantine split, reports and guards.

One registry holds, for each rule, the name written on a rejected row, the name of the
matching expectation and one SQL predicate. A predicate that is NULL counts as broken.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    reason: str
    expectation: str
    predicate: str

    @property
    def holds(self) -> Column:
        """TRUE or FALSE, never NULL."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))


class ExpectationFailed(RuntimeError):
    """A must-hold rule was broken; nothing may be published."""


# Rule names and bounds of the trip quality contract.
def trip_rules(expected_year: int = 2025) -> tuple[Rule, ...]:
    seconds = "unix_timestamp(tpep_dropoff_datetime) - unix_timestamp(tpep_pickup_datetime)"
    return (
        Rule(
            "pickup_year_not_expected",
            "pickup_year_is_expected",
            f"year(tpep_pickup_datetime) = {expected_year}",
        ),
        Rule(
            "dropoff_not_after_pickup",
            "dropoff_after_pickup",
            "tpep_dropoff_datetime > tpep_pickup_datetime",
        ),
        Rule(
            "duration_out_of_range",
            "duration_between_1_and_180_minutes",
            f"{seconds} BETWEEN 60 AND 10800",
        ),
        Rule(
            "distance_out_of_range",
            "distance_between_point_1_and_100_miles",
            "trip_distance BETWEEN 0.1D AND 100D",
        ),
        Rule(
            "total_amount_out_of_range",
            "total_amount_between_0_and_1000",
            "total_amount BETWEEN 0D AND 1000D",
        ),
        Rule(
            "location_id_out_of_range",
            "pickup_and_dropoff_locations_are_valid",
            "PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263",
        ),
    )


# Warn-only rules of the raw trips and of the zone dimension, and the
# must-hold contract of the one-row zone summary.
def raw_trip_rules(expected_year: int = 2025) -> tuple[Rule, ...]:
    return (
        Rule("rescued_data_present", "no_rescued_data", "_rescued_data IS NULL"),
        Rule(
            "source_year_not_expected",
            "expected_source_year",
            "regexp_extract(_source_file, 'yellow_tripdata_([0-9]{4})-', 1)"
            f" = '{expected_year}'",
        ),
    )


ZONE_RULES = (
    Rule("location_id_not_valid", "valid_location_id", "location_id BETWEEN 1 AND 263"),
    Rule("label_missing", "non_null_labels", "borough IS NOT NULL AND zone IS NOT NULL"),
    Rule(
        "coordinates_out_of_bounds",
        "coordinates_in_nyc_bounds",
        "longitude BETWEEN -75D AND -72D AND latitude BETWEEN 39D AND 42D",
    ),
)

ZONE_CONTRACT = (
    Rule(
        "zone_contract_broken",
        "exact_taxi_zone_contract",
        "row_count = 263 AND distinct_location_ids = 263 AND minimum_location_id = 1"
        " AND maximum_location_id = 263 AND null_required_fields = 0",
    ),
)

DRILL_RULES = (
    Rule("drill_requested", "demo_expectation_must_pass", "failure_mode <> 'expectation'"),
)


def with_rejections(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``rejection_reasons``: every broken rule, in registry order."""
    broken = [F.when(~rule.holds, rule.reason) for rule in rules]
    return df.withColumn("rejection_reasons", F.array_compact(F.array(*broken)))


def accepted(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that keep every rule.

    A plain conjunction rather than ``size(rejection_reasons) = 0``: the result is the
    same, no array is built per row, and Catalyst can push each bound into the scan.
    """
    for rule in rules:
        df = df.where(F.expr(rule.predicate))
    return df


def quarantined(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break at least one rule, with all of the broken ones listed."""
    return with_rejections(df, rules).where(F.size("rejection_reasons") > 0)


def quality_totals(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row; the two sums are NULL, not 0, when there is no input row."""
    keeps_all = _all_hold(rules)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.when(keeps_all, 1).otherwise(0)).alias("accepted_rows"),
        F.sum(F.when(keeps_all, 0).otherwise(1)).alias("quarantined_rows"),
    )


def failures_by_rule(rejected: DataFrame) -> DataFrame:
    """Counts per listed reason; a row that breaks several rules counts in each."""
    return (
        rejected.select(F.explode("rejection_reasons").alias("rule_name"))
        .groupBy("rule_name")
        .agg(F.count(F.lit(1)).alias("failed_rows"))
    )


def rule_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule, also for rules that nothing broke.

    All counters come from a single pass with map-side partial sums and one row per task in
    the shuffle; turning the one result row into a row per rule takes the place of the
    exploded count, its left join to the rule list and the cross join with the totals.
    """
    keeps_all = _all_hold(rules)
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.when(keeps_all, 1).otherwise(0)).alias("accepted_rows"),
        F.sum(F.when(keeps_all, 0).otherwise(1)).alias("quarantined_rows"),
        *[F.count_if(~rule.holds).alias(rule.reason) for rule in rules],
    )
    return counted.unpivot(
        ["total_rows", "accepted_rows", "quarantined_rows"],
        [rule.reason for rule in rules],
        "rule_name",
        "failed_rows",
    ).select(
        "rule_name",
        "failed_rows",
        F.try_divide(F.col("failed_rows").cast("double"), F.col("total_rows")).alias("failure_rate"),
        "total_rows",
        "accepted_rows",
        "quarantined_rows",
    )


def expectation_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Passed and failed records per expectation, from one pass; drops no row of ``df``."""
    counted = df.agg(
        F.count(F.lit(1)).alias("records"),
        *[F.count_if(~rule.holds).alias(rule.expectation) for rule in rules],
    )
    failed, records = F.col("failed_records"), F.col("records")
    return counted.unpivot(
        ["records"], [rule.expectation for rule in rules], "expectation", "failed_records"
    ).select(
        "expectation",
        (records - failed).alias("passed_records"),
        "failed_records",
        F.try_divide(failed.cast("double"), records).alias("failure_ratio"),
    )


def breaches(report: DataFrame, ratio: float = 0.01, minimum_records: int = 1000) -> DataFrame:
    """Report rows that fail too often and rest on enough records."""
    return report.where(
        (F.col("passed_records") + F.col("failed_records") >= minimum_records)
        & (F.col("failure_ratio") >= ratio)
    )


def counted(df: DataFrame, rules: Sequence[Rule], into: Observation) -> DataFrame:
    """Let Spark count rows, accepted rows and broken rules, by reason, while ``df`` is written."""
    return df.observe(
        into,
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(_all_hold(rules)).alias("accepted_rows"),
        *[F.count_if(~rule.holds).alias(rule.reason) for rule in rules],
    )


def counted_metrics(spark: SparkSession, counts: dict[str, int], rules: Sequence[Rule]) -> DataFrame:
    """The rows of ``rule_metrics`` from what ``counted`` has seen, with the time of counting."""
    total, kept = counts["total_rows"], counts["accepted_rows"]
    rows = [
        (rule.reason, counts[rule.reason], counts[rule.reason] / total if total else None, total, kept, total - kept)
        for rule in rules
    ]
    columns = "rule_name string, failed_rows bigint, failure_rate double, total_rows bigint, accepted_rows bigint, quarantined_rows bigint"
    return spark.createDataFrame(rows, columns).withColumn("computed_at", F.current_timestamp())


def observed(df: DataFrame, rules: Sequence[Rule], name: str) -> DataFrame:
    """Let Spark count broken rules while ``df`` flows past, in batch or in a stream."""
    return df.observe(
        name,
        F.count(F.lit(1)).alias("records"),
        *[F.count_if(~rule.holds).alias(rule.expectation) for rule in rules],
    )


def guarded(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` unchanged, but any job over it fails at the first row that breaks a rule."""
    for rule in rules:
        message = F.lit(f"expectation failed: {rule.expectation}")
        df = df.where(F.when(rule.holds, True).otherwise(F.raise_error(message).cast("boolean")))
    return df


def require(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Count first and raise before anything is published. Runs one small job."""
    broken = [
        f"{row.expectation} ({row.failed_records})"
        for row in expectation_report(df, rules).where("failed_records > 0").collect()
    ]
    if broken:
        raise ExpectationFailed(", ".join(sorted(broken)))
    return df


def drill(updates: DataFrame, failure_mode: str = "none") -> DataFrame:
    """One guarded row per update; mode ``expectation`` makes the run fail on purpose."""
    rows = updates.select(
        F.col("update_id").alias("test_run_id"),
        F.lit(failure_mode).alias("failure_mode"),
        F.current_timestamp().alias("evaluated_at"),
    )
    return guarded(rows, DRILL_RULES)


def _all_hold(rules: Sequence[Rule]) -> Column:
    combined = F.lit(True)
    for rule in rules:
        combined = combined & rule.holds
    return combined
