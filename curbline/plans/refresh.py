"""The full refresh: trips, quarantine, metrics and marts, checked first and published as one version."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curbline.operators import contracts, enrich, quality
from curbline.operators.layout import clustered, register_table
from curbline.plans import marts
from curbline.plans.marts import MARTS
from curbline.session import new_work_dir
from curbline.sources.lake import Lake

# Clustering keys of the published tables.
TRIP_KEYS = ("trip_date", "PULocationID", "DOLocationID")
REJECTED_KEYS = ("_source_file", "PULocationID", "DOLocationID")
MART_KEYS = {"airport_quantile": ("trip_date", "pickup_borough", "airport")}
DEFAULT_MART_KEYS = ("trip_date", "pickup_borough", "airport_flag")


# Purpose and layer of each published table.
TABLES = {
    "accepted": ("silver", "Trips that keep every rule"),
    "quarantine": ("silver", "Trips that break a rule, with the reasons"),
    "quality_metrics": ("silver", "Rows that break each rule"),
    **{name: ("gold", f"Additive mart: {name.replace('_', ' ')}") for name in MARTS},
}


def refresh(
    spark: SparkSession,
    raw: DataFrame,
    zones: DataFrame,
    out: str,
    expected_year: int = 2025,
    database: str | None = None,
) -> Lake:
    """Write every table and publish all of them as the next version of the lake at ``out``.

    Readers of the lake see the version before until then, and for good if anything fails.
    The dimension is checked before anything is written, and the numbers of rows before the version is published. Raw trips are
    read once: their derived columns and broken rules are written with one pass, which also
    counts for the metrics. Four marts come from one table of pair hours. With
    ``database``, the tables are registered there, with layer and comment.
    """
    quality.require(contracts.zone_summary(zones), quality.ZONE_CONTRACT)
    rules = quality.trip_rules(expected_year)
    lake = Lake(spark, out)
    change = lake.change()

    def put(df: DataFrame, name: str) -> DataFrame:
        change.replace(name, df, *TABLES[name])
        return change.read(name)

    graded, counts = new_work_dir(spark, "graded-trips"), Observation("trip_quality")
    watched = quality.counted(raw, rules, counts)
    quality.with_rejections(enrich.with_trip_columns(watched), rules).write.parquet(graded)
    trips = spark.read.parquet(graded)
    kept = trips.where(F.size("rejection_reasons") == 0).select(*enrich.ACCEPTED_COLUMNS)
    accepted = put(clustered(kept, TRIP_KEYS, ["tpep_pickup_datetime"]), "accepted")
    keys = [k for k in REJECTED_KEYS if k in trips.columns]
    rejected = trips.where(F.size("rejection_reasons") > 0)
    quarantine = put(clustered(rejected, keys, ["tpep_pickup_datetime"]), "quarantine")
    found = counts.get
    put(quality.counted_metrics(spark, found, rules), "quality_metrics")
    written = {"accepted_rows": accepted.count(), "quarantined_rows": quarantine.count()}
    seen = {"accepted_rows": found["accepted_rows"], "quarantined_rows": found["total_rows"] - found["accepted_rows"]}
    if written != seen:
        raise quality.ExpectationFailed(f"rows written {written}, rows counted {seen}")
    hours = new_work_dir(spark, "pair-hours")
    marts.pair_hours(accepted).write.parquet(hours)
    pairs = spark.read.parquet(hours)
    totals = marts.all_pair_totals(pairs)
    for name, build in MARTS.items():
        if name in marts.CHOSEN_MARTS:
            own = marts.CHOSEN_MARTS[name]
            mart = own.build(pairs, own.choose(totals, zones), zones)
        else:
            mart = build(accepted, zones)
        put(clustered(mart, MART_KEYS.get(name, DEFAULT_MART_KEYS)), name)
    state = change.publish()
    if database is not None:
        for name in TABLES:
            table = state.tables[name]
            register_table(spark, f"{database}.{name}", f"{out}/{table.shares[0].folder}", table.layer, table.comment)
    return lake
