"""Every registered query: (session, folder of the given tables) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.functions import text, trip
from curbline.operators import charts, contracts, cuboids, enrich, histograms, joins, profiles, quality
from curbline.operators.flow_timings import with_output_rate
from curbline.operators.layout import write_z_ordered
from curbline.operators import slicing
from curbline.operators.slicing import Slice, widget_query
from curbline.plans import alerts, marts, refresh, tables, upkeep, widgets
from curbline.plans.refresh import TRIP_KEYS
from curbline.session import new_work_dir
from curbline.sources import derived, landing, rescue, storage
from curbline.sources.lake import Lake
from curbline.sources.lake import named as lake_tables
from curbline.sources import trips as trip_files
from curbline.streaming import flow_clock, ingest, refine

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RULES = quality.trip_rules(2025)
SETTINGS = alerts.AlertSettings(
    environment="integration",
    workspace_url="workspace.example",
    emit_flow_metrics=True,
    expected_writers=("trips_raw", "yellow_trips_2025", "taxi_zones", "mart_od"),
    streaming_flows=("trips_raw", "yellow_trips_2025"),
)
CLICKED_ORIGINS = ("Zone 161", "Zone 103")
CLICKED_SEGMENTS = ("Queens · Cash · Airport", "Bronx · Other · Non-airport")


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Values in a form that two engines print alike: doubles rounded (sums depend on the
    order of addition), dates and times as ISO text, lists joined."""

    def shown(field: T.StructField):
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, T.DoubleType):
            column = F.round(column, digits) + F.lit(0.0)
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, "|")
        return column.alias(field.name)

    return df.select(*[shown(field) for field in df.schema])


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


def raw(spark: SparkSession, d: str) -> DataFrame:
    return tables.raw_trips(spark, d)


def good(spark: SparkSession, d: str) -> DataFrame:
    return tables.accepted_trips(spark, d)


def zones(spark: SparkSession) -> DataFrame:
    return derived.zones(spark)


def dataset(spark: SparkSession, d: str, name: str) -> DataFrame:
    return tables.mart(spark, d, name).select(*widgets.dataset_fields(name))


def widget(spark: SparkSession, d: str, name: str, where: Slice = Slice()) -> DataFrame:
    return widgets.widget(dataset(spark, d, name), name, where)


# --- sources and sinks -------------------------------------------------------------------


@query
def stream_ingest_trips(spark, d):
    base = new_work_dir(spark, "ingest")
    trip_files.land_trips(raw(spark, d), f"{base}/landing")
    ingest.ingest_trips(spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/bronze").select(*trip_files.TRIP_SCHEMA.names)


def _evolved(spark, d):
    """Month by month in turn: plain files, files with a new column, files with text."""
    base = new_work_dir(spark, "evolve")
    trips = raw(spark, d)
    turn = F.month("tpep_pickup_datetime") % 3
    text_miles = F.when(F.col("trip_distance") == 0, "n/a").otherwise(
        F.col("trip_distance").cast("string")
    )
    layouts = (
        trips,
        trips.withColumn("surge_zone", F.concat(F.lit("s"), F.col("PULocationID").cast("string"))),
        trips.withColumn("trip_distance", text_miles),
    )
    for number, layout in enumerate(layouts):
        trip_files.land_trips(layout.where(turn == number), f"{base}/landing/layout_{number}")
    ingest.ingest_evolving(
        spark, f"{base}/landing", f"{base}/bronze", f"{base}/schemas", f"{base}/checkpoint"
    )
    return ingest.read_evolved(spark, f"{base}/bronze", f"{base}/schemas")


def _evolved_table(spark, d):
    return tables.stored(spark, d, "evolved_trips", lambda: _evolved(spark, d))


@query
def ingest_schema_evolution(spark, d):
    return (
        _evolved_table(spark, d)
        .groupBy(F.month("tpep_pickup_datetime").alias("pickup_month"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count("surge_zone").alias("rows_with_new_column"),
            F.count(rescue.RESCUED).alias("rows_with_rescued_values"),
        )
    )


@query
def rescue_misfit_columns(spark, d):
    return _evolved_table(spark, d).select(
        "tpep_pickup_datetime", "PULocationID", "DOLocationID", "trip_distance", "surge_zone",
        rescue.RESCUED,
    )


def _landed(spark, d):
    path = f"{new_work_dir(spark, 'landing')}/landing"
    trip_files.land_trips(raw(spark, d), path)
    return path


@query
def ingest_lineage(spark, d):
    read = trip_files.read_trips(spark, _landed(spark, d))
    return read.groupBy(
        F.regexp_extract("_source_file", "yellow_tripdata_([0-9]{4}-[0-9]{2})", 1).alias("file_month")
    ).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("_source_file_modification_time").alias("rows_with_file_time"),
        F.count("_ingested_at").alias("rows_with_ingestion_time"),
    )


@query
def source_year_expectation(spark, d):
    """Both rules over all files, some of which hold text that was rescued or trips of another year."""
    return quality.expectation_report(_evolved_table(spark, d), quality.raw_trip_rules(2025))


#: Files below this are short; sources differ in size by the given tables.
SHORT = 24 * 20


def _landing_zone(spark, d):
    root = tables.written(spark, d, "landing-zone", lambda path: derived.land_files(derived.landing_zone(raw(spark, d)), path))
    source = F.regexp_extract("path", "source=([0-9]+)", 1).cast("int")
    return tables.stored(spark, d, "landing_listing", lambda: landing.landed_files(spark, root)).withColumn("source", source)


def _audited(spark, d):
    files = _landing_zone(spark, d)
    audit = tables.stored(spark, d, "landing_audit", lambda: landing.audit_files(files, minimum_bytes=SHORT))
    return audit.withColumns(
        {"source": F.regexp_extract("path", "source=([0-9]+)", 1).cast("int"), "file_month": landing.file_month(F.col("path"))}
    )


@query
def landing_file_audit(spark, d):
    return _audited(spark, d).select("source", "file_month", "bytes", "has_marks", "is_large_enough", "status")


@query
def landing_summary(spark, d):
    return landing.landing_summary(_audited(spark, d), ["source"])


@query
def landing_missing_months(spark, d):
    """Months of the year without a file, by the names of the landed files."""
    return landing.missing_files(_landing_zone(spark, d), 2025, 12, by=["source"])


@query
def landing_changes(spark, d):
    """What a second look at the landing zone finds: files that are new, changed, gone and the same."""
    base = new_work_dir(spark, "landing-changes")
    lake, zone = Lake(spark, f"{base}/lake"), derived.landing_zone(raw(spark, d))
    # Faulty files come again, files of the last months come later, and one source is taken back.
    derived.land_files(zone.where("file_month < '2025-10'"), f"{base}/zone")
    landing.take_listing(lake, f"{base}/zone")
    again = zone.where("file_month >= '2025-10' OR fault <> 'none'")
    derived.land_files(again.withColumn("fault", F.lit("none")).withColumn("trips", F.col("trips") + 1), f"{base}/zone")
    storage.remove(spark, f"{base}/zone/source=5")
    found = landing.take_listing(lake, f"{base}/zone")
    return found.select(
        F.regexp_extract("path", "source=([0-9]+)", 1).cast("int").alias("source"),
        landing.file_month(F.col("path")).alias("file_month"), "bytes", "change",
    )


@query
def zones_dimension(spark, d):
    path = f"{new_work_dir(spark, 'zones')}/zones"
    used = derived.zones_in_use(raw(spark, d))
    names = {"location_id": "LocationID", "borough": "Borough", "zone": "Zone"}
    used.withColumnsRenamed(names).write.option("header", "true").csv(path)
    return trip_files.read_zones(spark, path)


@query
def stream_accept_quarantine_split(spark, d):
    base = new_work_dir(spark, "split")
    trip_files.land_trips(raw(spark, d), f"{base}/landing")
    lake = Lake(spark, f"{base}/lake")
    refine.split_stream(spark, f"{base}/landing", trip_files.TRIP_SCHEMA, lake, f"{base}/checkpoint", RULES)
    columns = ["tpep_pickup_datetime", "PULocationID", "DOLocationID", "duration_min"]
    kept = refine.read_accepted(lake).select(F.lit("accepted").alias("verdict"), *columns, F.lit("").alias("rejection_reasons"))
    rejected = refine.read_quarantined(lake).select(
        F.lit("quarantined").alias("verdict"),
        *columns,
        F.array_join("rejection_reasons", "|").alias("rejection_reasons"),
    )
    return kept.unionByName(rejected)


@query
def stream_expectation_ledger(spark, d):
    """What each expectation failed over several runs of the stream, from its ledger."""
    base = new_work_dir(spark, "ledger")
    lake, trips = Lake(spark, f"{base}/lake"), raw(spark, d)
    for number in range(3):
        part = trips.where(F.month("tpep_pickup_datetime") % 3 == number)
        trip_files.land_trips(part, f"{base}/landing/part_{number}")
        refine.split_stream(spark, f"{base}/landing", trip_files.TRIP_SCHEMA, lake, f"{base}/checkpoint", RULES, 8)
    return refine.read_expectations(lake)


@query
def clustered_write(spark, d):
    """Trips and amounts of each day and destination, from a table that is ordered by date, origin and destination at once."""
    path = f"{new_work_dir(spark, 'clustered')}/accepted"
    write_z_ordered(good(spark, d), path, TRIP_KEYS, spread=["tpep_pickup_datetime"])
    return (
        spark.read.parquet(path)
        .groupBy("trip_date", "DOLocationID")
        .agg(F.count(F.lit(1)).alias("trip_count"), F.sum("total_amount").alias("amount"))
    )


@query
def refresh_tables(spark, d):
    """Rows of each table that a full refresh publishes, as the published version describes them."""
    lake = refresh.refresh(spark, raw(spark, d), zones(spark), f"{new_work_dir(spark, 'lake')}/tables")
    published = lake.tables()
    counted = [
        lake.frame(table).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in published.items()
    ]
    told = lake_tables(sorted(published.items()), spark).drop("shares")
    return told.join(reduce(DataFrame.unionByName, counted), "table_name")


def _in_parts(spark, d, base, parts, bring):
    """Raw trips land in parts, month by month in turn; ``bring`` is called after each."""
    trips = raw(spark, d)
    turn = F.pmod(F.month("tpep_pickup_datetime") * 7 + F.hour("tpep_pickup_datetime"), F.lit(parts))
    for number in range(parts):
        trip_files.land_trips(trips.where(turn == number), f"{base}/landing/part_{number}")
        bring(number)


@query
def incremental_mart_fare(spark, d):
    """The fare mart after twelve micro-batches, whose shares have grown into generations."""
    base, dims = new_work_dir(spark, "incremental"), marts.FARE_DIMS
    lake = Lake(spark, f"{base}/lake")

    def bring(number):
        reader = spark.readStream.schema(trip_files.TRIP_SCHEMA)
        stream = reader.option("recursiveFileLookup", "true").parquet(f"{base}/landing")
        refine.keep_mart_current(
            stream,
            lambda batch: marts.fare_composition(
                enrich.accepted_trips(batch, RULES), zones(batch.sparkSession)
            ),
            lake, "fare_ternary", dims, f"{base}/checkpoint",
        )

    _in_parts(spark, d, base, 12, bring)
    return refine.read_mart(lake, "fare_ternary", dims)


@query
def incremental_mart_od(spark, d):
    """The connection mart after ten micro-batches, each of which may change the chosen pairs."""
    base, which = new_work_dir(spark, "chosen"), {"od_connection": marts.CHOSEN_MARTS["od_connection"]}
    lake = Lake(spark, f"{base}/lake")

    def bring(number):
        read = trip_files.read_trips(spark, f"{base}/landing/part_{number}")
        upkeep.add_trips(lake, enrich.accepted_trips(read, RULES), zones(spark), "landing", number, which)

    _in_parts(spark, d, base, 10, bring)
    return upkeep.read_mart(lake, "od_connection", zones(spark))


# --- scalar columns and predicates -------------------------------------------------------

ENDS = ["tpep_pickup_datetime", "PULocationID", "DOLocationID"]


@query
def airport_flag(spark, d):
    return raw(spark, d).select(
        *ENDS, trip.airport_flag(F.col("PULocationID"), F.col("DOLocationID")).alias("airport_flag")
    )


@query
def trip_durations(spark, d):
    seconds = trip.elapsed_seconds(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))
    return raw(spark, d).select(
        *ENDS,
        seconds.alias("duration_seconds"),
        trip.minutes(seconds).alias("duration_min"),
    )


@query
def trip_speed(spark, d):
    return enrich.with_trip_columns(raw(spark, d)).select(*ENDS, "trip_distance", "speed_mph")


@query
def trip_calendar(spark, d):
    return enrich.with_trip_columns(raw(spark, d)).select(
        *ENDS, "trip_date", "pickup_month", "pickup_hour", "pickup_day_of_week", "day_type"
    )


@query
def rejection_reasons(spark, d):
    return quality.with_rejections(raw(spark, d), RULES).select(*ENDS, "rejection_reasons")


@query
def accepted_trips(spark, d):
    return enrich.accepted_trips(raw(spark, d), RULES)


@query
def quarantined_trips(spark, d):
    return enrich.quarantined_trips(raw(spark, d), RULES)


@query
def duration_histogram(spark, d):
    edge = trip.lower_bin_edge(F.col("duration_min"), 2)
    return (
        good(spark, d)
        .groupBy(edge.alias("duration_bin_minutes"))
        .agg(F.count(F.lit(1)).alias("bin_trip_count"))
    )


@query
def coerce_to_schema(spark, d):
    """Raw trips as untyped text, some of it unreadable, back to declared types."""
    trips = raw(spark, d)
    is_bad = F.col("trip_distance") == 0
    untyped = trips.select(
        F.col("PULocationID").cast("string").alias("pu"),
        F.when(is_bad, "n/a").otherwise(F.col("trip_distance").cast("string")).alias("miles"),
        F.col("payment_type").cast("string").alias("payment"),
        F.when(F.col("tip_amount") > 0, "TRUE").when(is_bad, "maybe").otherwise("false").alias("tipped"),
        F.to_date("tpep_pickup_datetime").cast("string").alias("day"),
    )
    target = T.StructType.fromDDL("pu int, miles double, payment bigint, tipped boolean, day date")
    return contracts.coerce_to_schema(untyped, target)


# --- quality -----------------------------------------------------------------------------


@query
def dq_metrics(spark, d):
    return quality.rule_metrics(raw(spark, d), RULES)


@query
def quality_totals(spark, d):
    return quality.quality_totals(raw(spark, d), RULES)


@query
def failed_by_rule(spark, d):
    return quality.failures_by_rule(quality.quarantined(raw(spark, d), RULES))


@query
def zone_contract(spark, d):
    return contracts.zone_summary(derived.zones_mentioned(raw(spark, d)))


@query
def expectation_report(spark, d):
    return quality.expectation_report(derived.zones_mentioned(raw(spark, d)), quality.ZONE_RULES)


@query
def expect_all_report(spark, d):
    return quality.expectation_report(raw(spark, d), RULES)


@query
def expect_or_fail_pass(spark, d):
    kept = quality.guarded(good(spark, d), RULES)
    return kept.groupBy("pickup_month").agg(F.count(F.lit(1)).alias("guarded_rows"))


@query
def expectation_breaches(spark, d):
    return quality.breaches(quality.expectation_report(raw(spark, d), RULES), 0.014, 1000)


@query
def failure_drill(spark, d):
    updates = tables.events(spark, d).select("update_id").distinct()
    return quality.drill(updates).drop("evaluated_at")


@query
def conditional_counts(spark, d):
    card = F.col("payment_type") == 1
    return good(spark, d).groupBy("pickup_hour").agg(
        F.count_if(F.col("trip_distance") >= 0.5).alias("fare_per_mile_count"),
        F.count_if(card).alias("card_trip_count"),
        F.count_if(card & (F.col("tip_amount") > 0)).alias("tipped_card_count"),
        F.sum(
            F.when(F.col("trip_distance") >= 0.5, F.col("fare_amount") / F.col("trip_distance"))
            .otherwise(0.0)
        ).alias("fare_per_mile_total"),
    )


# --- joins and rankings ------------------------------------------------------------------


@query
def join_pickup_zone(spark, d):
    joined = joins.with_zone(good(spark, d), zones(spark), "PULocationID", marts.PLACE)
    return joined.select(*ENDS, "pickup_zone", "pickup_borough")


@query
def join_selected_zones(spark, d):
    trips = good(spark, d)
    chosen = marts.busiest_city_zones(trips, zones(spark), 5)
    columns = ["pickup_zone", "pickup_borough", "borough_rank"]
    return joins.in_selected_zones(trips, chosen, columns).select(*ENDS, *columns)


@query
def join_od_zones(spark, d):
    here = joins.with_zone(good(spark, d), zones(spark), "PULocationID", marts.PLACE)
    ends = {"zone": "dropoff_zone", "borough": "dropoff_borough"}
    both = joins.with_zone(here, zones(spark), "DOLocationID", ends)
    return both.where(~joins.is_round_trip()).select(*ENDS, *marts.PLACE.values(), *ends.values())


@query
def join_od_candidates(spark, d):
    trips = good(spark, d)
    pairs = marts.selected_pairs(trips, zones(spark))
    columns = ["origin_zone", "destination_zone", "destination_rank"]
    return joins.in_selected_pairs(trips, pairs, columns).select(*ENDS, *columns)


@query
def top_zones_by_borough(spark, d):
    return marts.busiest_flow_zones(good(spark, d), zones(spark))


@query
def top5_zones(spark, d):
    return marts.busiest_city_zones(good(spark, d), zones(spark), 5)


@query
def top2_zones(spark, d):
    return marts.busiest_city_zones(good(spark, d), zones(spark), 2)


@query
def top3_or_pinned(spark, d):
    return marts.selected_origins(marts.pair_totals(good(spark, d)), zones(spark))


@query
def top12_destinations(spark, d):
    return marts.selected_pairs(good(spark, d), zones(spark))


@query
def seasonal_baseline(spark, d):
    """The baseline over all city zones rather than the busiest ones."""
    places = joins.with_zone(
        good(spark, d), marts.city_zones(zones(spark)), "PULocationID", marts.PLACE
    ).withColumn("airport_flag", trip.airport_flag(F.col("PULocationID"), F.col("DOLocationID")))
    dims = ["trip_date", "pickup_day_of_week", "pickup_hour", "pickup_zone", "pickup_borough"]
    daily = places.groupBy(*dims, "airport_flag").agg(F.count(F.lit(1)).alias("trip_count"))
    return marts.with_seasonal_baseline(daily)


# --- marts, datasets and widgets ---------------------------------------------------------

MART_KEYS = {
    "mart_quantile_fan": "airport_quantile",
    "mart_directional_flow": "directional_flow",
    "mart_od_connections": "od_connection",
    "mart_operating_profile": "parallel_coordinates",
    "mart_demand_horizon": "horizon",
    "mart_fare_composition": "fare_ternary",
}
WIDGET_KEYS = {
    "widget_fan": "airport_quantile",
    "widget_flow": "directional_flow",
    "widget_od": "od_connection",
    "widget_profile": "parallel_coordinates",
    "widget_horizon": "horizon",
    "widget_fare": "fare_ternary",
}
SLICES = {
    "slice_hours": Slice(hours=(8, 9)),
    "slice_dates": Slice(first_date="2025-10-01", last_date="2025-12-31"),
    "slice_boroughs": Slice(boroughs=("Queens", "Bronx")),
    "slice_airport": Slice(airport_flags=("Airport",)),
    "slice_combined": widgets.SCENARIO,
}


def slices(spark: SparkSession, d: str, where: Slice) -> DataFrame:
    """What all six charts show under a slice, each from the smallest cuboid that can tell."""
    found = {
        name: cuboids.sliced(spark, tables.cube(spark, d, name), widgets.WIDGET_DIMS[name], widgets.WIDGET_SUMS[name], where)
        for name in marts.MARTS
    }
    return cuboids.stacked_measures(found, widgets.WIDGET_DIMS, widgets.WIDGET_SUMS)


def _register_mart_queries() -> None:
    def keyed(key: str, build: Query) -> None:
        build.__name__ = key
        query(build)

    for key, name in MART_KEYS.items():
        keyed(key, lambda s, d, name=name: marts.MARTS[name](good(s, d), zones(s)))
    for key, name in WIDGET_KEYS.items():
        keyed(key, lambda s, d, name=name: widget(s, d, name))
    for key, where in SLICES.items():
        keyed(key, lambda s, d, where=where: slices(s, d, where))


_register_mart_queries()


@query
def widget_all_aggs(spark, d):
    measures = {
        "trip_sum": ("sum", "trip_count"),
        "trip_avg": ("avg", "trip_count"),
        "row_count": ("count", "trip_count"),
        "fare_min": ("min", "fare_total"),
        "fare_max": ("max", "fare_total"),
    }
    return widget_query(
        dataset(spark, d, "fare_ternary"), ["pickup_borough", "airport_flag"], measures
    )


def all_datasets(spark, d):
    return {name: dataset(spark, d, name) for name in marts.MARTS}


@query
def filter_options(spark, d):
    return slicing.filter_options(all_datasets(spark, d), widgets.FILTER_FIELDS)


@query
def field_contract(spark, d):
    """Each mart's own columns against those that its dataset promises, and a mart that deviates."""
    own = {name: tables.mart(spark, d, name) for name in marts.MARTS}
    own["deviating"] = own["fare_ternary"].drop("tip_total").withColumn("surcharge", F.lit(0.0))
    expected = {name: widgets.dataset_fields(name) for name in marts.MARTS}
    expected["deviating"] = expected["fare_ternary"]
    return contracts.field_contract(own, expected)


@query
def type_contract(spark, d):
    return contracts.type_contract(all_datasets(spark, d))


@query
def dataset_evidence(spark, d):
    return contracts.dataset_evidence(
        all_datasets(spark, d), widgets.WIDGET_DIMS, widgets.SCENARIO
    )


# --- chart analytics ---------------------------------------------------------------------

FAN = ["airport", "pickup_hour"]


@query
def histogram_cdf(spark, d):
    bins = widget(spark, d, "airport_quantile")
    return histograms.histogram_cdf(bins, FAN, "duration_bin_minutes", "bin_trip_count")


@query
def histogram_quantiles(spark, d):
    bins = widget(spark, d, "airport_quantile")
    return histograms.histogram_quantiles(bins, FAN, "duration_bin_minutes", "bin_trip_count")


@query
def custom_category_order(spark, d):
    bins = widget(spark, d, "airport_quantile")
    per_airport = bins.groupBy("airport").agg(F.sum("bin_trip_count").alias("trip_count"))
    return slicing.with_category_order(per_airport, "airport", ("JFK", "LGA", "EWR"))


def _trips_by_hour(spark, d):
    return widget_query(
        dataset(spark, d, "fare_ternary"), ["pickup_hour"], {"trip_count": ("sum", "trip_count")}
    )


@query
def hour_label(spark, d):
    hours = _trips_by_hour(spark, d)
    return hours.withColumn("hour_label", trip.hour_label(F.col("pickup_hour")))


@query
def hour_axis_label(spark, d):
    hours = _trips_by_hour(spark, d)
    return hours.withColumn("axis_label", trip.hour_axis_label(F.col("pickup_hour")))


@query
def flow_bearing(spark, d):
    return charts.flow_vectors(widget(spark, d, "directional_flow"))


@query
def slice_top6_destinations(spark, d):
    return charts.busiest_links(widget(spark, d, "od_connection", Slice(hours=(8, 9, 17, 18))))


@query
def od_origin_totals(spark, d):
    links = charts.busiest_links(widget(spark, d, "od_connection"))
    dims = ["origin_zone", "pickup_borough", "origin_longitude", "origin_latitude"]
    return charts.origin_totals(links, dims)


@query
def selection_filter(spark, d):
    links = charts.busiest_links(widget(spark, d, "od_connection"))
    return slicing.select_clicked(links, "origin_zone", CLICKED_ORIGINS)


@query
def selection_highlight(spark, d):
    shares = charts.fare_shares(widget(spark, d, "fare_ternary"))
    marked = slicing.highlight_clicked(shares, "segment_id", CLICKED_SEGMENTS)
    return marked.select("segment_id", "trip_count", "is_selected")


def _folded(spark, d):
    return profiles.fold_axes(profiles.profile_ratios(widget(spark, d, "parallel_coordinates")))


@query
def profile_ratios(spark, d):
    return profiles.profile_ratios(widget(spark, d, "parallel_coordinates"))


@query
def profile_fold(spark, d):
    return _folded(spark, d)


@query
def axis_min_max(spark, d):
    return profiles.with_axis_range(_folded(spark, d))


@query
def profile_normalized(spark, d):
    return profiles.normalized(profiles.with_axis_range(_folded(spark, d)))


@query
def axis_labels(spark, d):
    labelled = profiles.with_axis_labels(profiles.with_axis_range(_folded(spark, d)))
    return labelled.select("profile_id", "key", "axis_order", "axis_min_label", "axis_max_label")


@query
def demand_deviation(spark, d):
    return charts.demand_deviation(widget(spark, d, "horizon"))


@query
def horizon_bands(spark, d):
    scored = charts.demand_deviation(widget(spark, d, "horizon"))
    return charts.horizon_bands(scored, ["trip_date", "pickup_zone", "pickup_borough"])


@query
def fare_shares(spark, d):
    return charts.fare_shares(widget(spark, d, "fare_ternary"))


@query
def ternary_coordinates(spark, d):
    return charts.ternary_coordinates(charts.fare_shares(widget(spark, d, "fare_ternary"))).select(
        "segment_id", "trip_count", "display_tip_share", "display_extras_share",
        "display_x", "display_y",
    )


# --- event log ---------------------------------------------------------------------------


def events(spark, d):
    return tables.events(spark, d)


def timed(spark, d):
    return tables.timed_events(spark, d)


@query
def event_parse(spark, d):
    return events(spark, d).select(
        "event_id", "event_type", "pipeline_id", "pipeline_name", "update_id", "flow_name"
    )


@query
def event_text_clean(spark, d):
    return tables.event_log(spark, d).select(
        "id", text.squeezed(F.col("message"), 60).alias("message_60")
    )


@query
def flow_layer(spark, d):
    return events(spark, d).groupBy("flow_name", "flow_key", "layer").agg(
        F.count(F.lit(1)).alias("event_count")
    )


@query
def event_time_parse(spark, d):
    return events(spark, d).select("event_id", F.unix_micros("event_time").alias("event_time_us"))


@query
def event_state(spark, d):
    return events(spark, d).select("event_id", "event_type", "state")


@query
def event_metrics(spark, d):
    keys = alerts.ev.METRIC_KEYS
    found = F.coalesce(*[F.col(k) for k in keys]).isNotNull()
    return events(spark, d).where(found).select("event_id", *keys)


@query
def event_expectations(spark, d):
    return alerts.expectation_rows(events(spark, d))


TIMING = ["event_id", "state", "num_output_rows", *alerts.OBSERVED]


@query
def flow_timings(spark, d):
    ended = F.col("state").isin(*alerts.ev.TERMINAL_STATES)
    return timed(spark, d).where(ended).select(*TIMING)


def _watch(spark, d, base):
    """The log lands in three parts, in order of time; each part triggers one stream run."""
    log = tables.event_log(spark, d).withColumn(
        "__at", F.coalesce(alerts.ev.event_instant(F.col("timestamp")), F.lit(0).cast("timestamp"))
    )
    cuts = [F.lit(day).cast("timestamp") for day in ("2024-01-11", "2024-01-21")]
    at = F.col("__at")
    parts = (at < cuts[0], (at >= cuts[0]) & (at < cuts[1]), at >= cuts[1])
    for number, part in enumerate(parts):
        log.where(part).drop("__at").write.mode("overwrite").parquet(f"{base}/log/part={number}")
        flow_clock.watch_events(
            spark, f"{base}/log", f"{base}/out", f"{base}/checkpoint", SETTINGS
        )


def _watched(spark, d, table):
    base = tables.written(spark, d, "watched", lambda path: _watch(spark, d, path))
    return f"{base}/out/{table}".rstrip("/")


@query
def flow_timings_stream(spark, d):
    return with_output_rate(flow_clock.read_timings(spark, _watched(spark, d, ""))).select(*TIMING)


@query
def alerts_stream(spark, d):
    return flow_clock.read_alerts(spark, _watched(spark, d, "")).select(*PAYLOAD)


@query
def alert_severity(spark, d):
    graded = alerts.graded(events(spark, d), SETTINGS)
    return graded.select("event_id", "severity", "condition", "reasons")


@query
def zero_output_alerts(spark, d):
    graded = alerts.graded(events(spark, d), SETTINGS)
    return graded.where(F.col("condition") == "unexpected_zero_output").select(
        "event_id", "flow_key", "severity", "reasons", "num_output_rows"
    )


PAYLOAD = [
    "schema_version", "source", "event_id", "idempotency_key", "destination_key", "environment",
    "pipeline_id", "pipeline_name", "update_id", "flow_name", "flow_key", "layer", "event_type",
    "state", "severity", "condition", "event_time_text", "message", "monitor_key",
    "diagnostic_url", "num_output_rows", *alerts.OBSERVED,
]


@query
def alert_payloads(spark, d):
    return tables.found_alerts(spark, d, SETTINGS).select(*PAYLOAD)


@query
def metric_formatting(spark, d):
    reported = timed(spark, d).where(F.col("num_output_rows").isNotNull())
    return reported.select(
        "event_id",
        text.number_text(F.col("num_output_rows")).alias("rows_text"),
        text.number_text(F.col("processed_rows_per_second")).alias("rate_text"),
        text.bytes_text(F.col("num_output_bytes")).alias("bytes_text"),
        text.duration_text(F.col("observed_duration_seconds")).alias("duration_text"),
    )


def _messages(spark, d):
    return alerts.with_message_texts(tables.found_alerts(spark, d, SETTINGS), SETTINGS)


@query
def throughput_text(spark, d):
    return _messages(spark, d).select("event_id", "throughput_text")


@query
def backlog_text(spark, d):
    return _messages(spark, d).select("event_id", "backlog_text")


@query
def alert_message(spark, d):
    return _messages(spark, d).select(
        "event_id", "summary", "quality_text", text.escaped(F.col("message")).alias("message_escaped")
    )


@query
def alert_body_json(spark, d):
    return alerts.message_body(_messages(spark, d)).select("event_id", "body")
