"""Trip, zone and event-log frames derived row by row from the given tables.

The expressions are plain arithmetic on the columns of one input row, so the derived
frames grow with the tables, need no shuffle, and can be restated in any SQL dialect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


ZONE_COUNT = 263


#: Order of the trips by pickup, in terms of the rows that they are made from.
TRIP_ORDER = ("pickup",)


def trips(
    spark: SparkSession, sf_dir: str, arranged: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """One raw trip per ``lineitem`` row, some of them bad on purpose.

    ``arranged`` may order the rows by ``TRIP_ORDER`` before their columns are made, so that a shuffle carries a few numbers.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )
    hashed = lines.select(
        "l_quantity",
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.expr(
            "l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 1299709"
            " + cast(l_linenumber AS bigint) * 15485863 + cast(l_quantity AS bigint) * 32452843"
        ).alias("h"),
    )
    pickup = (
        "timestampadd(SECOND, h % 31536000 - CASE WHEN h % 53 = 0 THEN 31622400 ELSE 0 END,"
        " TIMESTAMP_NTZ '2025-01-01 00:00:00')"
    )
    seconds = (
        "CASE WHEN h % 97 = 0 THEN 0 WHEN h % 83 = 0 THEN 12000 WHEN h % 79 = 0 THEN -30"
        " ELSE 60 + h % 5400 END"
    )
    hashed = arranged(hashed.withColumn("pickup", F.expr(pickup)))
    pickup = "pickup"
    columns = {
        "VendorID": "cast(1 + h % 2 AS int)",
        "tpep_pickup_datetime": pickup,
        "tpep_dropoff_datetime": (
            f"CASE WHEN h % 89 <> 0 THEN timestampadd(SECOND, {seconds}, {pickup}) END"
        ),
        "passenger_count": "1 + h % 6",
        "trip_distance": "CASE WHEN h % 71 = 0 THEN 0D ELSE l_quantity * 0.125D END",
        "RatecodeID": "1 + h % 5",
        "PULocationID": (
            "cast(CASE WHEN h % 11 >= 3 THEN 1 + (l_partkey * 31 + l_suppkey * 7) % 265"
            " WHEN h % 3 = 0 THEN 132 WHEN h % 3 = 1 THEN 138"
            " WHEN h % 2 = 0 THEN 104 ELSE 105 END AS int)"
        ),
        "DOLocationID": (
            "cast(CASE WHEN h % 13 >= 4 THEN 1 + (l_suppkey * 53 + l_orderkey * 17) % 265"
            " WHEN h % 3 = 0 THEN 1 WHEN h % 3 = 1 THEN 132 ELSE 138 END AS int)"
        ),
        "payment_type": "1 + h % 4",
        "fare_amount": (
            "CASE WHEN h % 61 = 0 THEN -5D WHEN h % 59 = 0 THEN NULL"
            " ELSE 3D + l_quantity * 1.25D END"
        ),
        "tip_amount": (
            "CASE WHEN h % 4 = 0 AND h % 5 < 4 THEN l_quantity * 0.25D"
            " WHEN h % 73 = 0 THEN NULL ELSE 0D END"
        ),
        "tolls_amount": "CASE WHEN h % 10 = 0 THEN 6.5D ELSE 0D END",
        "total_amount": "CASE WHEN h % 67 = 0 THEN 1500D ELSE 5.5D + l_quantity * 1.5D END",
        "Airport_fee": "CASE WHEN h % 8 = 0 THEN 1.75D ELSE 0D END",
        "cbd_congestion_fee": "CASE WHEN h % 3 = 0 THEN 0.75D ELSE 0D END",
    }
    return hashed.select(*[F.expr(e).alias(name) for name, e in columns.items()])


def with_zone_attributes(ids: DataFrame, zone_id: str) -> DataFrame:
    """The dimension row that belongs to each id."""
    attributes = {
        "location_id": f"cast({zone_id} AS int)",
        "borough": (
            f"CASE WHEN {zone_id} = 1 THEN 'EWR'"
            f" WHEN {zone_id} IN (56, 57, 132, 138) THEN 'Queens'"
            f" WHEN {zone_id} IN (103, 104, 105, 161) THEN 'Manhattan'"
            f" ELSE element_at(array('Manhattan', 'Brooklyn', 'Queens', 'Bronx',"
            f" 'Staten Island'), cast({zone_id} % 5 + 1 AS int)) END"
        ),
        "zone": (
            f"concat('Zone ', CASE WHEN {zone_id} = 57 THEN 56"
            f" WHEN {zone_id} IN (104, 105) THEN 103 ELSE {zone_id} END)"
        ),
        "service_zone": (
            f"CASE WHEN {zone_id} = 1 THEN 'EWR' WHEN {zone_id} IN (132, 138) THEN 'Airports'"
            f" WHEN {zone_id} % 4 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END"
        ),
        "longitude": f"-74.25D + ({zone_id} * 37 % 263) / 512D",
        "latitude": f"40.5D + ({zone_id} * 101 % 263) / 1024D",
    }
    return ids.select(*[F.expr(e).alias(name) for name, e in attributes.items()])


def zones(spark: SparkSession) -> DataFrame:
    """The whole dimension; some zone names repeat."""
    return with_zone_attributes(spark.range(1, ZONE_COUNT + 1), "id")


def zones_in_use(raw_trips: DataFrame) -> DataFrame:
    """Dimension rows of the valid zone ids that the trips mention at either end."""
    ids = raw_trips.select(F.explode(F.array("PULocationID", "DOLocationID")).alias("id"))
    return with_zone_attributes(ids.where(F.col("id").between(1, ZONE_COUNT)).distinct(), "id")


def zones_mentioned(raw_trips: DataFrame) -> DataFrame:
    """A dimension row for every zone id that the trips mention, valid or not.

    Ids beyond the dimension come without labels, and the last one off the map, so each
    rule over the dimension meets rows that break it.
    """
    ids = raw_trips.select(F.explode(F.array("PULocationID", "DOLocationID")).alias("id"))
    beyond = F.col("location_id") > ZONE_COUNT
    named = {c: F.when(~beyond, F.col(c)) for c in ("borough", "zone")}
    off = F.when(F.col("location_id") > ZONE_COUNT + 1, F.lit(0.0)).otherwise(F.col("longitude"))
    known = ids.where("id IS NOT NULL").distinct()
    return with_zone_attributes(known, "id").withColumns({**named, "longitude": off})


#: The landing zone has one source for each remainder of the pickup zone.
LANDING_SOURCES = 16
#: Bytes that a landed file has for each of its trips, and the bytes of its two marks.
BYTES_PER_TRIP, MARK_BYTES = 24, 8


def landing_zone(raw_trips: DataFrame) -> DataFrame:
    """One landed file for each source and month in which the source has enough trips to a bad end, with its fault.

    ``trips`` decides size and fault: files of too few trips are short, and every fifth,
    seventh and eleventh number of trips has a damaged head, a damaged tail or no content.
    """
    counted = raw_trips.where("PULocationID % 3 <> month(tpep_pickup_datetime) % 3").groupBy(
        F.pmod("PULocationID", F.lit(LANDING_SOURCES)).alias("source"),
        F.date_format("tpep_pickup_datetime", "yyyy-MM").alias("file_month"),
    ).agg(F.count(F.lit(1)).alias("trips"))
    fault = F.expr("CASE WHEN trips % 11 = 0 THEN 'empty' WHEN trips % 5 = 0 THEN 'head' WHEN trips % 7 = 0 THEN 'tail' ELSE 'none' END")
    return counted.where("source % 4 <> 3 OR right(file_month, 2) NOT IN ('02', '09')").withColumn("fault", fault)


def land_files(files: DataFrame, root: str) -> None:
    """Write the files of ``landing_zone`` below ``root``, one folder for each source; tasks write them."""
    from curbline.sources.files import open_fs

    def write(batches):
        for batch in batches:
            for source, month, trips, fault in batch[["source", "file_month", "trips", "fault"]].itertuples(index=False):
                store, inner = open_fs(f"{root}/source={source}")
                store.create_dir(inner, recursive=True)
                head, tail = (b"DAMG" if fault == end else b"PAR1" for end in ("head", "tail"))
                with store.open_output_stream(f"{inner}/yellow_tripdata_{month}.parquet") as out:
                    out.write(b"" if fault == "empty" else head + bytes(BYTES_PER_TRIP * trips) + tail)
            yield batch[["source"]]

    files.mapInPandas(write, "source int").write.format("noop").mode("overwrite").save()


# The seven flow names of the derived event log.
FLOW_NAMES = (
    "trips_raw",
    "mart_fare",
    "mart_od",
    "taxi_zones",
    "yellow_trips_2025",
    "yellow_trips_2025_dq_metrics",
    "helper",
)


#: Order of the log by the text of its times, in terms of the rows that it is made from.
LOG_ORDER = ("untimed", "ts", "n")


def event_log(
    spark: SparkSession, sf_dir: str, arranged: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """One pipeline event per ``events`` row, with ``origin`` and ``details`` as JSON text.

    Covers the odd cases: names under other keys or missing, state under another key or in
    lower case, keys that repeat, text encoded twice, cut-off text, unreadable and zone-less times.
    ``arranged`` may order the rows by ``LOG_ORDER`` before their text is made, so that no shuffle carries text.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("n"),
        "ts",
        F.col("user_id").alias("u"),
        F.col("event_type").alias("kind"),
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    ).withColumn("untimed", F.col("n") % 47 == 0)
    events = arranged(events)
    flow = F.concat(
        F.lit("main.ops."),
        F.element_at(F.array(*map(F.lit, FLOW_NAMES)), (F.col("u") % 7 + 1).cast("int")),
    )
    event_type = F.expr(
        "CASE WHEN n % 19 = 0 THEN 'other' WHEN n % 17 = 0 THEN 'update_progress'"
        " ELSE 'flow_progress' END"
    )
    state = F.expr(
        "CASE kind WHEN 'signup' THEN 'QUEUED' WHEN 'view' THEN 'STARTING'"
        " WHEN 'click' THEN 'RUNNING' WHEN 'purchase' THEN 'COMPLETED'"
        " ELSE CASE WHEN n % 4 = 0 THEN 'SKIPPED' ELSE 'FAILED' END END"
    )
    base = events.withColumns({"flow": flow, "etype": event_type, "state": state})
    origin = _json_object(
        {
            "pipeline_id": F.when(F.col("n") % 37 != 0, _quoted(F.expr("concat('p', u % 3)"))),
            "pipeline_name": _quoted(F.expr("concat('Trips  p', u % 3)")),
            "update_id": _quoted(F.expr("concat('u', u % 5)")),
            "flow_name": F.expr("CASE WHEN n % 31 <> 0 AND n % 29 <> 0 THEN concat('\"', flow, '\"') END"),
            "dataset_name": F.expr("CASE WHEN n % 31 <> 0 AND n % 29 = 0 THEN concat('\"', flow, '\"') END"),
        }
    )
    details = F.concat(F.lit('{"'), F.col("etype"), F.lit('":'), _progress(), F.lit("}"))
    encoded = F.concat(
        F.lit('"'),
        F.replace(F.replace(details, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')),
        F.lit('"'),
    )
    n = F.col("n")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return base.select(
        n.cast("string").alias("id"),
        F.col("etype").alias("event_type"),
        F.when(F.col("untimed"), "not a time")
        .when(n % 3 == 0, F.concat(iso, F.lit("Z")))
        .when(n % 3 == 1, iso)
        .otherwise(F.concat(iso, F.lit("+00:00")))
        .alias("timestamp"),
        F.when(n % 41 == 0, F.rpad(F.concat(F.lit("Flow  <"), "flow", F.lit("> ")), 600, "x"))
        .otherwise(F.concat(F.lit(" Flow  <"), "flow", F.lit("> & state\tis "), "state"))
        .alias("message"),
        origin.alias("origin"),
        F.when(n % 43 == 0, F.substring(details, 1, 25))
        .when(n % 23 == 0, encoded)
        .otherwise(details)
        .alias("details"),
    )


def _progress() -> Column:
    n = F.col("n")
    metrics = _json_object(
        {
            "num_output_rows": F.expr(
                "cast(CASE WHEN n % 9 = 0 THEN 0 ELSE floor(value * 1000) END AS string)"
            ),
            "num_input_rows": F.expr("cast(floor(value * 2000) AS string)"),
            "num_output_bytes": F.expr("CASE WHEN n % 3 = 0 THEN cast(n * n * 1000 AS string) END"),
            "backlog_records": F.expr("CASE WHEN n % 5 = 0 THEN cast(n % 4000 AS string) END"),
            "processed_rows_per_second": F.expr("CASE WHEN n % 7 = 0 THEN cast(value * 1.5D AS string) END"),
            "input_rows_per_second": F.expr("CASE WHEN n % 11 = 0 THEN cast(value * 8D AS string) END"),
        }
    )
    rules = F.concat(
        F.lit("["),
        F.concat_ws(
            ",",
            F.expr(
                """concat('{"name":"distance  in range","dataset":"main.ops.d', u % 7,
                '","passed_records":', CASE WHEN k % 10 = 0 THEN k ELSE 1000 + 10 * k END,
                ',"failed_records":', k, '}')"""
            ),
            F.expr(
                """CASE WHEN k % 3 = 0 THEN
                '{"name":"total <known>","dataset":"d","passed_records":500,"failed_records":1.5}' END"""
            ),
            F.expr(
                """CASE WHEN k % 7 = 0 THEN
                '{"name":"broken","dataset":"d","passed_records":"n/a","failed_records":1}' END"""
            ),
        ),
        F.lit("]"),
    )
    return _json_object(
        {
            "name": F.when(n % 31 == 0, _quoted(F.col("flow"))),
            "state": F.when(n % 2 == 0, _quoted(F.col("state"))).otherwise('""'),
            "status": F.when(n % 2 == 1, _quoted(F.lower("state"))),
            "planned": F.when(n % 13 == 0, F.lit('{"num_output_rows":null}')),
            # A key that repeats: no variant holds it, the reading of text does.
            "note": F.when(n % 10 == 0, F.lit('"first","note":"second"')),
            "metrics": F.when(F.col("kind") == "purchase", metrics),
            "totals": F.when(
                (F.col("kind") == "purchase") & (n % 6 == 0), F.lit('[{"num_output_rows":999}]')
            ),
            "data_quality": F.concat(F.lit('{"expectations":'), rules, F.lit("}")),
        }
    )


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _json_object(members: dict[str, Column]) -> Column:
    """JSON text of the members whose value is not NULL, in the given order."""
    parts = [F.concat(F.lit(f'"{key}":'), value) for key, value in members.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
