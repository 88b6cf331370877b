"""The same results in plain SQL for DuckDB, one statement per registered query.

Shared steps are named CTEs; ``_sql`` puts the needed ones in front of a final SELECT.
Doubles are rounded and dates shown as text exactly as the registered queries do.
"""

from __future__ import annotations

import re


def r(expression: str) -> str:
    return f"round({expression}, 6) + 0.0"


AIRPORTS = "(1, 132, 138)"
ALL = "('Manhattan', 'Brooklyn', 'Queens', 'Bronx', 'Staten Island', 'EWR')"
CITY = "('Manhattan', 'Brooklyn', 'Queens', 'Bronx', 'Staten Island')"
FLAG = (
    f"CASE WHEN PULocationID IN {AIRPORTS} OR DOLocationID IN {AIRPORTS}"
    " THEN 'Airport' ELSE 'Non-airport' END"
)
REASONS = (
    "pickup_year_not_expected",
    "dropoff_not_after_pickup",
    "duration_out_of_range",
    "distance_out_of_range",
    "total_amount_out_of_range",
    "location_id_out_of_range",
)
EXPECTATIONS = (
    "pickup_year_is_expected",
    "dropoff_after_pickup",
    "duration_between_1_and_180_minutes",
    "distance_between_point_1_and_100_miles",
    "total_amount_between_0_and_1000",
    "pickup_and_dropoff_locations_are_valid",
)
TERMINAL = "('FAILED', 'ERROR', 'CANCELED', 'CANCELLED', 'STOPPED', 'SKIPPED', 'EXCLUDED', 'COMPLETED', 'SUCCEEDED')"
WRITERS = "('trips_raw', 'yellow_trips_2025', 'taxi_zones', 'mart_od')"
STREAMS = "('trips_raw', 'yellow_trips_2025')"


def _zone_attributes(zone_id: str) -> str:
    return f"""
        {zone_id}::INTEGER AS location_id,
        CASE WHEN {zone_id} = 1 THEN 'EWR' WHEN {zone_id} IN (56, 57, 132, 138) THEN 'Queens'
             WHEN {zone_id} IN (103, 104, 105, 161) THEN 'Manhattan'
             WHEN {zone_id} % 5 = 0 THEN 'Manhattan' WHEN {zone_id} % 5 = 1 THEN 'Brooklyn'
             WHEN {zone_id} % 5 = 2 THEN 'Queens' WHEN {zone_id} % 5 = 3 THEN 'Bronx'
             ELSE 'Staten Island' END AS borough,
        'Zone ' || CASE WHEN {zone_id} = 57 THEN 56 WHEN {zone_id} IN (104, 105) THEN 103
                        ELSE {zone_id} END AS zone,
        CASE WHEN {zone_id} = 1 THEN 'EWR' WHEN {zone_id} IN (132, 138) THEN 'Airports'
             WHEN {zone_id} % 4 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone,
        -74.25::DOUBLE + (({zone_id} * 37) % 263)::DOUBLE / 512 AS longitude,
        40.5::DOUBLE + (({zone_id} * 101) % 263)::DOUBLE / 1024 AS latitude"""


CTES: dict[str, str] = {}

CTES["hashed"] = """
    SELECT *, l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 1299709
           + l_linenumber::BIGINT * 15485863 + l_quantity::BIGINT * 32452843 AS h
    FROM lineitem"""
CTES["picked"] = """
    SELECT *, TIMESTAMP '2025-01-01 00:00:00'
           + to_seconds((h % 31536000) - CASE WHEN h % 53 = 0 THEN 31622400 ELSE 0 END) AS pickup,
           CASE WHEN h % 97 = 0 THEN 0 WHEN h % 83 = 0 THEN 12000 WHEN h % 79 = 0 THEN -30
                ELSE 60 + h % 5400 END AS secs
    FROM hashed"""
CTES["trips"] = """
    SELECT (1 + h % 2)::INTEGER AS VendorID,
           pickup AS tpep_pickup_datetime,
           CASE WHEN h % 89 <> 0 THEN pickup + to_seconds(secs) END AS tpep_dropoff_datetime,
           1 + h % 6 AS passenger_count,
           CASE WHEN h % 71 = 0 THEN 0::DOUBLE ELSE l_quantity * 0.125::DOUBLE END AS trip_distance,
           1 + h % 5 AS RatecodeID,
           (CASE WHEN h % 11 >= 3 THEN 1 + (l_partkey * 31 + l_suppkey * 7) % 265
                 WHEN h % 3 = 0 THEN 132 WHEN h % 3 = 1 THEN 138
                 WHEN h % 2 = 0 THEN 104 ELSE 105 END)::INTEGER AS PULocationID,
           (CASE WHEN h % 13 >= 4 THEN 1 + (l_suppkey * 53 + l_orderkey * 17) % 265
                 WHEN h % 3 = 0 THEN 1 WHEN h % 3 = 1 THEN 132 ELSE 138 END)::INTEGER AS DOLocationID,
           1 + h % 4 AS payment_type,
           CASE WHEN h % 61 = 0 THEN -5::DOUBLE WHEN h % 59 = 0 THEN NULL
                ELSE 3::DOUBLE + l_quantity * 1.25::DOUBLE END AS fare_amount,
           CASE WHEN h % 4 = 0 AND h % 5 < 4 THEN l_quantity * 0.25::DOUBLE
                WHEN h % 73 = 0 THEN NULL ELSE 0::DOUBLE END AS tip_amount,
           CASE WHEN h % 10 = 0 THEN 6.5::DOUBLE ELSE 0::DOUBLE END AS tolls_amount,
           CASE WHEN h % 67 = 0 THEN 1500::DOUBLE
                ELSE 5.5::DOUBLE + l_quantity * 1.5::DOUBLE END AS total_amount,
           CASE WHEN h % 8 = 0 THEN 1.75::DOUBLE ELSE 0::DOUBLE END AS Airport_fee,
           CASE WHEN h % 3 = 0 THEN 0.75::DOUBLE ELSE 0::DOUBLE END AS cbd_congestion_fee
    FROM picked"""
CTES["zones"] = f"SELECT {_zone_attributes('id')} FROM range(1, 264) AS t(id)"
CTES["used_zones"] = f"""
    SELECT {_zone_attributes('id')} FROM (
        SELECT PULocationID AS id FROM trips UNION SELECT DOLocationID FROM trips)
    WHERE id BETWEEN 1 AND 263"""
CTES["mentioned_zones"] = f"""
    SELECT * REPLACE (CASE WHEN location_id <= 263 THEN borough END AS borough,
                      CASE WHEN location_id <= 263 THEN zone END AS zone,
                      CASE WHEN location_id > 264 THEN 0::DOUBLE ELSE longitude END AS longitude)
    FROM (SELECT {_zone_attributes('id')} FROM (
        SELECT PULocationID AS id FROM trips UNION SELECT DOLocationID FROM trips) WHERE id IS NOT NULL)"""
CTES["timed"] = f"""
    SELECT *, tpep_pickup_datetime::DATE AS trip_date,
           month(tpep_pickup_datetime)::INTEGER AS pickup_month,
           hour(tpep_pickup_datetime)::INTEGER AS pickup_hour,
           (dayofweek(tpep_pickup_datetime) + 1)::INTEGER AS pickup_day_of_week,
           CASE WHEN dayofweek(tpep_pickup_datetime) IN (0, 6) THEN 'Weekend'
                ELSE 'Weekday' END AS day_type,
           date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS seconds,
           {FLAG} AS airport_flag
    FROM trips"""
CTES["enriched"] = """
    SELECT *, seconds::DOUBLE / 60 AS duration_min,
           trip_distance / nullif(seconds::DOUBLE / 3600, 0) AS speed_mph,
           coalesce(year(tpep_pickup_datetime) = 2025, false) AS ok1,
           coalesce(tpep_dropoff_datetime > tpep_pickup_datetime, false) AS ok2,
           coalesce(seconds BETWEEN 60 AND 10800, false) AS ok3,
           coalesce(trip_distance BETWEEN 0.1::DOUBLE AND 100::DOUBLE, false) AS ok4,
           coalesce(total_amount BETWEEN 0 AND 1000, false) AS ok5,
           coalesce(PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263, false) AS ok6
    FROM timed"""
CTES["judged"] = (
    "SELECT *, ok1 AND ok2 AND ok3 AND ok4 AND ok5 AND ok6 AS ok, concat_ws('|', "
    + ", ".join(f"CASE WHEN NOT ok{i} THEN '{n}' END" for i, n in enumerate(REASONS, 1))
    + ") AS reasons FROM enriched"
)
CTES["good"] = "SELECT * FROM judged WHERE ok"
CTES["m_fan"] = f"""
    SELECT trip_date, pickup_hour, borough AS pickup_borough,
           CASE DOLocationID WHEN 132 THEN 'JFK' WHEN 138 THEN 'LGA' ELSE 'EWR' END AS airport,
           'Airport' AS airport_flag,
           (floor(duration_min / 2) * 2)::INTEGER AS duration_bin_minutes,
           count(*) AS bin_trip_count
    FROM good JOIN zones ON PULocationID = location_id
    WHERE pickup_day_of_week BETWEEN 2 AND 6 AND DOLocationID IN {AIRPORTS}
      AND duration_min BETWEEN 5 AND 180 AND borough IN {ALL}
    GROUP BY ALL"""
CTES["flow_zones"] = f"""
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY pickup_borough
                                     ORDER BY annual_trip_count DESC, location_id)::INTEGER AS borough_rank
        FROM (SELECT location_id, zone AS pickup_zone, borough AS pickup_borough, longitude, latitude,
                     count(*) AS annual_trip_count
              FROM good JOIN zones ON PULocationID = location_id
              WHERE PULocationID <> DOLocationID AND borough IN {ALL} GROUP BY ALL))
    WHERE borough_rank <= 20"""
CTES["m_flow"] = """
    SELECT trip_date, pickup_hour, pickup_zone, pickup_borough, airport_flag,
           z.longitude, z.latitude, count(*) AS trip_count, sum(trip_distance) AS distance_total,
           sum(e.longitude - z.longitude) AS dx_total, sum(e.latitude - z.latitude) AS dy_total
    FROM good JOIN flow_zones z ON PULocationID = z.location_id
    JOIN zones e ON DOLocationID = e.location_id
    WHERE PULocationID <> DOLocationID GROUP BY ALL"""
CTES["city_ranks"] = f"""
    SELECT *, row_number() OVER (PARTITION BY pickup_borough
                                 ORDER BY annual_trip_count DESC, location_id)::INTEGER AS borough_rank
    FROM (SELECT location_id, zone AS pickup_zone, borough AS pickup_borough,
                 count(*) AS annual_trip_count
          FROM good JOIN zones ON PULocationID = location_id
          WHERE borough IN {CITY} AND location_id NOT IN {AIRPORTS} GROUP BY ALL)"""
CTES["origins"] = f"""
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY pickup_borough
                                     ORDER BY origin_trip_count DESC, location_id)::INTEGER AS borough_rank
        FROM (SELECT location_id, zone AS origin_zone, borough AS pickup_borough,
                     longitude AS origin_longitude, latitude AS origin_latitude,
                     count(*) AS origin_trip_count
              FROM good JOIN zones ON PULocationID = location_id
              WHERE PULocationID <> DOLocationID AND borough IN {CITY}
                AND location_id NOT IN {AIRPORTS} GROUP BY ALL))
    WHERE borough_rank <= 3 OR location_id = 161"""
CTES["pairs"] = """
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY origin_id
                                     ORDER BY annual_trip_count DESC, destination_id)::INTEGER AS destination_rank
        FROM (SELECT o.location_id AS origin_id, origin_zone, pickup_borough, origin_longitude,
                     origin_latitude, e.location_id AS destination_id, e.zone AS destination_zone,
                     e.longitude AS destination_longitude, e.latitude AS destination_latitude,
                     count(*) AS annual_trip_count
              FROM good JOIN origins o ON PULocationID = o.location_id
              JOIN zones e ON DOLocationID = e.location_id
              WHERE PULocationID <> DOLocationID GROUP BY ALL))
    WHERE destination_rank <= 12"""
CTES["m_od"] = """
    SELECT trip_date, pickup_hour, pickup_borough, airport_flag, origin_zone, destination_zone,
           origin_longitude, origin_latitude, destination_longitude, destination_latitude,
           count(*) AS trip_count, sum(duration_min) AS duration_total
    FROM good JOIN pairs ON PULocationID = origin_id AND DOLocationID = destination_id
    GROUP BY ALL"""
CTES["m_profile"] = f"""
    SELECT trip_date, pickup_hour, pickup_zone, pickup_borough, airport_flag,
           count(*) AS trip_count, sum(duration_min) AS duration_total,
           sum(CASE WHEN trip_distance >= 0.5 THEN fare_amount / trip_distance ELSE 0 END) AS fare_per_mile_total,
           count(*) FILTER (trip_distance >= 0.5) AS fare_per_mile_count,
           count(*) FILTER (payment_type = 1) AS card_trip_count,
           count(*) FILTER (payment_type = 1 AND tip_amount > 0) AS tipped_card_count,
           count(*) FILTER (PULocationID IN {AIRPORTS} OR DOLocationID IN {AIRPORTS}) AS airport_trip_count
    FROM good JOIN city_ranks ON PULocationID = location_id WHERE borough_rank <= 5 GROUP BY ALL"""
CTES["m_horizon"] = """
    SELECT trip_date, pickup_hour, pickup_zone, pickup_borough, airport_flag, trip_count,
           avg(trip_count) OVER (PARTITION BY pickup_zone, pickup_day_of_week, pickup_hour,
                                 airport_flag) AS expected_trip_count
    FROM (SELECT trip_date, pickup_day_of_week, pickup_hour, pickup_zone, pickup_borough,
                 airport_flag, count(*) AS trip_count
          FROM good JOIN city_ranks ON PULocationID = location_id WHERE borough_rank <= 2
          GROUP BY ALL)"""
CTES["m_fare"] = f"""
    SELECT trip_date, pickup_hour, borough AS pickup_borough,
           CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' ELSE 'Other' END AS payment_category,
           airport_flag, count(*) AS trip_count, sum(greatest(fare_amount, 0)) AS fare_total,
           sum(greatest(tip_amount, 0)) AS tip_total,
           sum(greatest(total_amount - greatest(fare_amount, 0) - greatest(tip_amount, 0), 0)) AS extras_total
    FROM good JOIN zones ON PULocationID = location_id
    WHERE total_amount > 0 AND borough IN {ALL} GROUP BY ALL"""
CTES["w_fan"] = """
    SELECT airport, pickup_hour, duration_bin_minutes, sum(bin_trip_count)::BIGINT AS bin_trip_count
    FROM m_fan GROUP BY ALL"""
CTES["w_flow"] = """
    SELECT pickup_zone, pickup_borough, longitude, latitude, sum(trip_count)::BIGINT AS trip_count,
           sum(distance_total) AS distance_total, sum(dx_total) AS dx_total, sum(dy_total) AS dy_total
    FROM m_flow GROUP BY ALL"""
OD_DIMS = (
    "pickup_borough, origin_zone, destination_zone, origin_longitude, origin_latitude,"
    " destination_longitude, destination_latitude"
)
for _name, _where in (("w_od", ""), ("w_od_rush", "WHERE pickup_hour IN (8, 9, 17, 18)")):
    CTES[_name] = f"""
        SELECT {OD_DIMS}, sum(trip_count)::BIGINT AS trip_count, sum(duration_total) AS duration_total
        FROM m_od {_where} GROUP BY ALL"""
    CTES[_name.replace("w_od", "links")] = f"""
        SELECT * FROM (
            SELECT *, duration_total / trip_count AS mean_duration_min,
                   rank() OVER (PARTITION BY origin_zone ORDER BY trip_count DESC)::INTEGER AS destination_rank
            FROM {_name}) WHERE destination_rank <= 6"""
PROFILE_SUMS = (
    "trip_count", "duration_total", "fare_per_mile_total", "fare_per_mile_count",
    "card_trip_count", "tipped_card_count", "airport_trip_count",
)
CTES["w_profile"] = (
    "SELECT pickup_zone, pickup_borough, "
    + ", ".join(
        f"sum({c}){'' if c in ('duration_total', 'fare_per_mile_total') else '::BIGINT'} AS {c}"
        for c in PROFILE_SUMS
    )
    + " FROM m_profile GROUP BY ALL"
)
CTES["w_horizon"] = """
    SELECT trip_date, pickup_zone, pickup_borough, sum(trip_count)::BIGINT AS trip_count,
           sum(expected_trip_count) AS expected_trip_count
    FROM m_horizon GROUP BY ALL"""
CTES["w_fare"] = """
    SELECT pickup_borough, payment_category, airport_flag, sum(trip_count)::BIGINT AS trip_count,
           sum(fare_total) AS fare_total, sum(tip_total) AS tip_total, sum(extras_total) AS extras_total
    FROM m_fare GROUP BY ALL"""
CTES["cdf"] = """
    SELECT *, sum(bin_trip_count) OVER (PARTITION BY airport, pickup_hour ORDER BY duration_bin_minutes
               ROWS UNBOUNDED PRECEDING)::BIGINT AS cumulative_trips,
           sum(bin_trip_count) OVER (PARTITION BY airport, pickup_hour)::BIGINT AS total_trips
    FROM w_fan"""
CTES["shares_of_bins"] = "SELECT *, cumulative_trips::DOUBLE / total_trips AS cumulative_share FROM cdf"
CTES["ratios"] = """
    SELECT pickup_zone AS profile_id, pickup_zone, pickup_borough, trip_count,
           duration_total / trip_count AS mean_duration_min,
           fare_per_mile_total / greatest(1, fare_per_mile_count) AS mean_fare_per_mile,
           tipped_card_count::DOUBLE / greatest(1, card_trip_count) AS card_tip_rate,
           airport_trip_count::DOUBLE / trip_count AS airport_share
    FROM w_profile"""
CTES["folded"] = " UNION ALL ".join(
    f"SELECT profile_id, pickup_zone, pickup_borough, '{axis}' AS key, {axis}::DOUBLE AS value,"
    f" {i}::INTEGER AS axis_order FROM ratios"
    for i, axis in enumerate(
        ("trip_count", "mean_duration_min", "mean_fare_per_mile", "card_tip_rate", "airport_share")
    )
)
CTES["ranged"] = """
    SELECT *, min(value) OVER (PARTITION BY key) AS axis_min,
           max(value) OVER (PARTITION BY key) AS axis_max FROM folded"""
CTES["deviated"] = """
    SELECT *, CASE WHEN expected_trip_count > 0
                   THEN (trip_count - expected_trip_count) / expected_trip_count
                   ELSE 0 END AS deviation_ratio FROM w_horizon"""
CTES["scored"] = """
    SELECT *, greatest(deviation_score, 0) AS positive_score, greatest(-deviation_score, 0) AS negative_score
    FROM (SELECT *, greatest(-3, least(3, deviation_ratio * 3)) AS deviation_score FROM deviated)"""
CTES["shares"] = """
    SELECT *, fare_total / component_total AS fare_share, tip_total / component_total AS tip_share,
           extras_total / component_total AS extras_share,
           pickup_borough || ' · ' || payment_category || ' · ' || airport_flag AS segment_id
    FROM (SELECT *, fare_total + tip_total + extras_total AS component_total FROM w_fare)
    WHERE component_total > 0"""

# The event log: expected results straight from the columns, without the JSON in between.
CTES["ev0"] = """
    SELECT event_id AS n, ts, user_id AS u, event_type AS kind, value,
           regexp_extract(props, '[0-9]+')::BIGINT AS k,
           'main.ops.' || (CASE user_id % 7 WHEN 0 THEN 'trips_raw' WHEN 1 THEN 'mart_fare'
               WHEN 2 THEN 'mart_od' WHEN 3 THEN 'taxi_zones' WHEN 4 THEN 'yellow_trips_2025'
               WHEN 5 THEN 'yellow_trips_2025_dq_metrics' ELSE 'helper' END) AS flow,
           CASE WHEN event_id % 19 = 0 THEN 'other' WHEN event_id % 17 = 0 THEN 'update_progress'
                ELSE 'flow_progress' END AS event_type,
           CASE event_type WHEN 'signup' THEN 'QUEUED' WHEN 'view' THEN 'STARTING'
               WHEN 'click' THEN 'RUNNING' WHEN 'purchase' THEN 'COMPLETED'
               ELSE CASE WHEN event_id % 4 = 0 THEN 'SKIPPED' ELSE 'FAILED' END END AS true_state,
           event_id % 43 = 0 AS cut_off
    FROM events"""
CTES["log"] = r"""
    SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad((epoch_us(ts) % 1000000)::VARCHAR, 6, '0') AS iso,
           CASE WHEN n % 41 = 0 THEN rpad('Flow <' || flow || '> ', 599, 'x')
                ELSE 'Flow <' || flow || '> & state is ' || true_state END AS clean_message
    FROM ev0"""
CTES["ev"] = """
    SELECT n, u, kind, value, k, cut_off, event_type, ts,
           n::VARCHAR AS event_id,
           CASE WHEN n % 37 <> 0 THEN 'p' || (u % 3) ELSE '' END AS pipeline_id,
           'Trips p' || (u % 3) AS pipeline_name, 'u' || (u % 5) AS update_id,
           CASE WHEN n % 31 <> 0 OR (event_type = 'flow_progress' AND NOT cut_off)
                THEN flow ELSE '' END AS flow_name,
           CASE WHEN cut_off THEN '' ELSE true_state END AS state,
           CASE WHEN n % 47 <> 0 THEN ts END AS event_time,
           CASE WHEN n % 47 = 0 THEN 'not a time' WHEN n % 3 = 0 THEN iso || 'Z'
                WHEN n % 3 = 1 THEN iso ELSE iso || '+00:00' END AS event_time_text,
           left(clean_message, 500) AS event_message,
           kind = 'purchase' AND NOT cut_off AS has_metrics,
           event_type = 'flow_progress' AND NOT cut_off AS has_expectations
    FROM log WHERE event_type <> 'other'"""
CTES["evm"] = """
    SELECT *, split_part(flow_name, '.', -1) AS flow_key,
           CASE WHEN has_metrics THEN CASE WHEN n % 9 = 0 THEN 0::DOUBLE ELSE floor(value * 1000) END END AS num_output_rows,
           CASE WHEN has_metrics THEN floor(value * 2000) END AS num_input_rows,
           CASE WHEN has_metrics AND n % 3 = 0 THEN (n * n * 1000)::DOUBLE END AS num_output_bytes,
           CASE WHEN has_metrics AND n % 5 = 0 THEN (n % 4000)::DOUBLE END AS backlog_records,
           CASE WHEN has_metrics AND n % 7 = 0 THEN value * 1.5::DOUBLE END AS processed_rows_per_second,
           CASE WHEN has_metrics AND n % 11 = 0 THEN value * 8::DOUBLE END AS input_rows_per_second,
           CASE WHEN has_expectations AND k % 10 <> 0 AND k::DOUBLE / (1000 + 11 * k) >= 0.01
                THEN 1 ELSE 0 END AS breach_count
    FROM ev"""
CTES["evl"] = """
    SELECT *, CASE WHEN flow_key LIKE '%\\_raw' ESCAPE '\\' THEN 'Bronze'
                   WHEN flow_key LIKE 'mart\\_%' ESCAPE '\\' THEN 'Gold'
                   WHEN flow_key IN ('trips_enriched_with_rejection_reasons', 'yellow_trips_2025_dq_metrics', 'taxi_zones_contract') THEN 'Silver / DQ'
                   WHEN flow_key IN ('yellow_trips_2025', 'yellow_trips_2025_quarantine', 'taxi_zones') THEN 'Silver'
                   ELSE 'Pipeline' END AS layer
    FROM evm"""
CTES["expectation_items"] = """
    SELECT event_id, 'distance in range' AS name, 'main.ops.d' || (u % 7) AS dataset,
           (CASE WHEN k % 10 = 0 THEN k ELSE 1000 + 10 * k END)::DOUBLE AS passed_records,
           k::DOUBLE AS failed_records
    FROM ev WHERE has_expectations
    UNION ALL
    SELECT event_id, 'total <known>', 'd', 500::DOUBLE, 1.5::DOUBLE
    FROM ev WHERE has_expectations AND k % 3 = 0"""
CTES["clocked"] = f"""
    SELECT *, pipeline_id <> '' AND update_id <> '' AND flow_name <> '' AND event_time IS NOT NULL AS keyed,
           state IN {TERMINAL} AS terminal FROM evl"""
CTES["runs"] = """
    SELECT *, coalesce(count(*) FILTER (terminal) OVER (
               PARTITION BY keyed, pipeline_id, update_id, flow_name ORDER BY event_time, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM clocked"""
CTES["clocks"] = """
    SELECT *, coalesce(started, queued) AS begun FROM (
        SELECT *, min(event_time) FILTER (state = 'QUEUED') OVER w AS queued,
               min(event_time) FILTER (state IN ('STARTING', 'RUNNING')) OVER w AS started
        FROM runs WINDOW w AS (PARTITION BY keyed, pipeline_id, update_id, flow_name, run))"""
CTES["observed"] = """
    SELECT *, num_output_rows / observed_duration_seconds AS avg_output_rows_per_second FROM (
        SELECT *, CASE WHEN keyed AND terminal AND begun IS NOT NULL
                 THEN greatest((epoch_us(event_time) - epoch_us(begun))::DOUBLE / 1000000, 0.001) END AS observed_duration_seconds,
               CASE WHEN keyed AND terminal AND queued IS NOT NULL
                 THEN greatest((epoch_us(begun) - epoch_us(queued))::DOUBLE / 1000000, 0) END AS observed_queue_seconds
        FROM clocks)"""
CTES["graded"] = f"""
    SELECT *, CASE WHEN failed THEN 'critical' WHEN odd_end OR breached OR wrote_nothing THEN 'warning'
                   ELSE 'info' END AS severity,
           CASE WHEN failed THEN event_type || '_failed' WHEN breached THEN 'expectation_failure_ratio'
                WHEN odd_end THEN event_type || '_unexpected_terminal_state'
                WHEN wrote_nothing THEN 'unexpected_zero_output'
                WHEN event_type = 'flow_progress' THEN 'flow_metrics' ELSE 'update_state' END AS condition,
           list_filter([CASE WHEN failed OR odd_end THEN 'state=' || state END,
               CASE WHEN breached THEN breach_count || ' expectation(s) exceeded 1.00%' END,
               CASE WHEN wrote_nothing THEN 'num_output_rows=0' END], lambda x: x IS NOT NULL) AS reason_list
    FROM (SELECT *, NOT failed AND NOT odd_end AND NOT breached AND event_type = 'flow_progress'
                 AND flow_key IN {WRITERS} AND terminal AND coalesce(num_output_rows = 0, false) AS wrote_nothing
          FROM (SELECT *, state = 'FAILED' AS failed, state = 'SKIPPED' AS odd_end,
                       state <> 'FAILED' AND breach_count > 0 AS breached FROM observed))"""
CTES["payloads"] = f"""
    SELECT *, CASE WHEN len(reason_list) > 0
                   THEN left(array_to_string(reason_list, '; ') || '. ' || event_message, 500)
                   ELSE event_message END AS message,
           concat_ws(':', coalesce(nullif(pipeline_id, ''), pipeline_name), nullif(flow_name, ''), condition) AS monitor_key,
           CASE WHEN pipeline_id <> '' THEN 'https://workspace.example/pipelines/' || pipeline_id
                || '/updates/' || update_id ELSE '' END AS diagnostic_url
    FROM graded
    WHERE severity <> 'info' OR (event_type = 'flow_progress' AND terminal AND flow_key IN {WRITERS})"""


def number_text(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN 'Not reported' WHEN {x} = floor({x})"
        f" THEN format('{{:,}}', {x}::BIGINT) ELSE format('{{:,.2f}}', {x}) END"
    )


def bytes_text(x: str) -> str:
    branches = " ".join(
        f"WHEN {x} / {1024**i}::DOUBLE < 1024 THEN format('{{:,.1f}}', {x} / {1024**i}::DOUBLE) || ' {unit}'"
        for i, unit in enumerate(("B", "KiB", "MiB", "GiB"))
    )
    return f"CASE WHEN {x} IS NULL THEN 'Not reported' {branches} ELSE format('{{:,.1f}}', {x} / {1024**4}::DOUBLE) || ' TiB' END"


def duration_text(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN 'Not reported' WHEN {x} < 60 THEN format('{{:,.1f}}', {x}) || ' s'"
        f" ELSE format('{{:,}}', floor({x} / 60)::BIGINT) || 'm ' || format('{{:,.1f}}', {x} % 60) || 's' END"
    )


def escaped(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _needed(text: str) -> list[str]:
    """Names of the CTEs a statement reads, each after those that it reads itself."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(text)
    return order


def _sql(final: str) -> str:
    steps = ",\n".join(f"{name} AS ({CTES[name]})" for name in _needed(final))
    return f"WITH {steps}\n{final}" if steps else final


FINALS: dict[str, str] = {}
TS = "strftime({}, '%Y-%m-%d %H:%M:%S') || '.000000'"
PICKUP = TS.format("tpep_pickup_datetime") + " AS tpep_pickup_datetime"
ENDS = f"{PICKUP}, PULocationID, DOLocationID"
RAW_REST = (
    "passenger_count, trip_distance, RatecodeID, PULocationID, DOLocationID, payment_type,"
    " fare_amount, tip_amount, tolls_amount, total_amount, Airport_fee, cbd_congestion_fee, VendorID"
)
DROPOFF = TS.format("tpep_dropoff_datetime") + " AS tpep_dropoff_datetime"
DERIVED = (
    "trip_date::VARCHAR AS trip_date, pickup_month, pickup_hour, pickup_day_of_week, day_type, "
    f"{r('duration_min')} AS duration_min, {r('speed_mph')} AS speed_mph"
)
MONTH = "strftime(tpep_pickup_datetime, '%Y-%m')"

FINALS["stream_ingest_trips"] = f"SELECT {PICKUP}, {DROPOFF}, {RAW_REST} FROM trips"
FINALS["ingest_schema_evolution"] = """
    SELECT pickup_month, count(*) AS row_count,
           count(*) FILTER (pickup_month % 3 = 1) AS rows_with_new_column,
           count(*) FILTER (pickup_month % 3 = 2 AND trip_distance = 0) AS rows_with_rescued_values
    FROM timed GROUP BY ALL"""
FINALS["rescue_misfit_columns"] = f"""
    SELECT {ENDS},
           CASE WHEN pickup_month % 3 = 2 AND trip_distance = 0 THEN NULL ELSE trip_distance END AS trip_distance,
           CASE WHEN pickup_month % 3 = 1 THEN 's' || PULocationID END AS surge_zone,
           CASE WHEN pickup_month % 3 = 2 AND trip_distance = 0 THEN '{{"trip_distance":"n/a"}}' END AS _rescued_data
    FROM timed"""
FINALS["ingest_lineage"] = f"""
    SELECT {MONTH} AS file_month, count(*) AS row_count, count(*) AS rows_with_file_time,
           count(*) AS rows_with_ingestion_time FROM trips GROUP BY ALL"""
FINALS["source_year_expectation"] = """
    WITH counted AS (
        SELECT count(*) AS n, count(*) FILTER (pickup_month % 3 = 2 AND trip_distance = 0) AS rescued,
               count(*) FILTER (year(tpep_pickup_datetime) <> 2025) AS bad FROM timed)
    SELECT 'no_rescued_data' AS expectation, n - rescued AS passed_records, rescued AS failed_records,
           round(rescued::DOUBLE / n, 6) + 0.0 AS failure_ratio FROM counted
    UNION ALL SELECT 'expected_source_year', n - bad, bad, round(bad::DOUBLE / n, 6) FROM counted"""
CTES["landing"] = f"""
    SELECT source, file_month, trips, fault, CASE WHEN fault = 'empty' THEN 0 ELSE 8 + 24 * trips END AS bytes
    FROM (SELECT *, CASE WHEN trips % 11 = 0 THEN 'empty' WHEN trips % 5 = 0 THEN 'head' WHEN trips % 7 = 0 THEN 'tail' ELSE 'none' END AS fault
          FROM (SELECT (PULocationID % 16)::INTEGER AS source, {MONTH} AS file_month, count(*) AS trips
                FROM timed WHERE PULocationID % 3 <> pickup_month % 3 GROUP BY ALL)
          WHERE source % 4 <> 3 OR right(file_month, 2) NOT IN ('02', '09'))"""
CTES["audited"] = """
    SELECT source, file_month, bytes, fault = 'none' AS has_marks, bytes >= 480 AS is_large_enough,
           CASE WHEN fault = 'none' AND bytes >= 480 THEN 'valid' ELSE 'invalid' END AS status FROM landing"""
FINALS["landing_file_audit"] = "SELECT * FROM audited"
FINALS["landing_summary"] = """
    SELECT source, status, count(*) AS file_count, sum(bytes)::BIGINT AS total_bytes FROM audited GROUP BY ALL"""
FINALS["landing_missing_months"] = """
    SELECT source, m::INTEGER AS month FROM (SELECT DISTINCT source FROM landing), range(1, 13) AS t(m)
    WHERE (source, '2025-' || lpad(m::VARCHAR, 2, '0')) NOT IN (SELECT (source, file_month) FROM landing)"""
FINALS["landing_changes"] = """
    SELECT source, file_month, CASE WHEN NOT later OR source = 5 THEN bytes ELSE 8 + 24 * (trips + 1) END AS bytes,
           CASE WHEN source = 5 THEN 'gone' WHEN file_month >= '2025-10' THEN 'new' WHEN later THEN 'changed' ELSE 'same' END AS change
    FROM (SELECT *, file_month >= '2025-10' OR fault <> 'none' AS later FROM landing)
    WHERE source <> 5 OR file_month < '2025-10'"""
FINALS["zones_dimension"] = "SELECT * REPLACE (round(longitude, 6) AS longitude, round(latitude, 6) AS latitude) FROM used_zones"
FINALS["stream_accept_quarantine_split"] = f"""
    SELECT CASE WHEN ok THEN 'accepted' ELSE 'quarantined' END AS verdict, {ENDS},
           {r('duration_min')} AS duration_min, reasons AS rejection_reasons FROM judged"""
FINALS["clustered_write"] = f"""
    SELECT trip_date::VARCHAR AS trip_date, DOLocationID, count(*) AS trip_count, {r('sum(total_amount)')} AS amount
    FROM good GROUP BY trip_date, DOLocationID"""
FINALS["airport_flag"] = f"SELECT {ENDS}, airport_flag FROM timed"
FINALS["trip_durations"] = f"""
    SELECT {ENDS}, seconds AS duration_seconds, {r('seconds::DOUBLE / 60')} AS duration_min FROM timed"""
FINALS["trip_speed"] = f"SELECT {ENDS}, {r('trip_distance')} AS trip_distance, {r('speed_mph')} AS speed_mph FROM enriched"
FINALS["trip_calendar"] = f"""
    SELECT {ENDS}, trip_date::VARCHAR AS trip_date, pickup_month, pickup_hour, pickup_day_of_week, day_type FROM timed"""
FINALS["rejection_reasons"] = f"SELECT {ENDS}, reasons AS rejection_reasons FROM judged"
FINALS["accepted_trips"] = f"SELECT {PICKUP}, {DROPOFF}, {DERIVED}, {RAW_REST} FROM good"
FINALS["quarantined_trips"] = f"""
    SELECT {PICKUP}, {DROPOFF}, {DERIVED}, {RAW_REST}, reasons AS rejection_reasons FROM judged WHERE NOT ok"""
FINALS["duration_histogram"] = """
    SELECT (floor(duration_min / 2) * 2)::INTEGER AS duration_bin_minutes, count(*) AS bin_trip_count
    FROM good GROUP BY ALL"""
FINALS["coerce_to_schema"] = """
    SELECT PULocationID AS pu, CASE WHEN trip_distance <> 0 THEN trip_distance END AS miles,
           payment_type AS payment, coalesce(tip_amount > 0, false) AS tipped, trip_date::VARCHAR AS day
    FROM timed"""
FINALS["dq_metrics"] = " UNION ALL ".join(
    f"SELECT '{name}' AS rule_name, count(*) FILTER (NOT ok{i}) AS failed_rows,"
    f" {r(f'count(*) FILTER (NOT ok{i})::DOUBLE / count(*)')} AS failure_rate, count(*) AS total_rows,"
    " count(*) FILTER (ok) AS accepted_rows, count(*) FILTER (NOT ok) AS quarantined_rows FROM judged"
    for i, name in enumerate(REASONS, 1)
)
FINALS["quality_totals"] = """
    SELECT count(*) AS total_rows, count(*) FILTER (ok) AS accepted_rows,
           count(*) FILTER (NOT ok) AS quarantined_rows FROM judged"""
FINALS["failed_by_rule"] = " UNION ALL ".join(
    f"SELECT '{name}' AS rule_name, count(*) AS failed_rows FROM judged WHERE NOT ok{i} HAVING count(*) > 0"
    for i, name in enumerate(REASONS, 1)
)
FINALS["zone_contract"] = """
    SELECT count(*) AS row_count, count(DISTINCT location_id) AS distinct_location_ids,
           min(location_id) AS minimum_location_id, max(location_id) AS maximum_location_id,
           count(*) FILTER (borough IS NULL OR zone IS NULL OR longitude IS NULL OR latitude IS NULL) AS null_required_fields
    FROM mentioned_zones"""
FINALS["expectation_report"] = " UNION ALL ".join(
    f"SELECT '{name}' AS expectation, count(*) FILTER ({p}) AS passed_records,"
    f" count(*) FILTER (NOT ({p})) AS failed_records,"
    f" {r(f'count(*) FILTER (NOT ({p}))::DOUBLE / count(*)')} AS failure_ratio FROM mentioned_zones"
    for name, p in (
        ("valid_location_id", "location_id BETWEEN 1 AND 263"),
        ("non_null_labels", "borough IS NOT NULL AND zone IS NOT NULL"),
        (
            "coordinates_in_nyc_bounds",
            "longitude BETWEEN -75 AND -72 AND latitude BETWEEN 39 AND 42",
        ),
    )
)
_EXPECT_ALL = " UNION ALL ".join(
    f"SELECT '{name}' AS expectation, count(*) FILTER (ok{i}) AS passed_records,"
    f" count(*) FILTER (NOT ok{i}) AS failed_records,"
    f" count(*) FILTER (NOT ok{i})::DOUBLE / count(*) AS failure_ratio FROM judged"
    for i, name in enumerate(EXPECTATIONS, 1)
)
FINALS["expect_all_report"] = f"SELECT * REPLACE ({r('failure_ratio')} AS failure_ratio) FROM ({_EXPECT_ALL})"
FINALS["stream_expectation_ledger"] = FINALS["expect_all_report"]
FINALS["expect_or_fail_pass"] = "SELECT pickup_month, count(*) AS guarded_rows FROM good GROUP BY ALL"
FINALS["expectation_breaches"] = (
    f"SELECT * REPLACE ({r('failure_ratio')} AS failure_ratio) FROM ({_EXPECT_ALL})"
    " WHERE passed_records + failed_records >= 1000 AND failure_ratio >= 0.014"
)
FINALS["failure_drill"] = "SELECT DISTINCT update_id AS test_run_id, 'none' AS failure_mode FROM ev"
FINALS["conditional_counts"] = f"""
    SELECT pickup_hour, count(*) FILTER (trip_distance >= 0.5) AS fare_per_mile_count,
           count(*) FILTER (payment_type = 1) AS card_trip_count,
           count(*) FILTER (payment_type = 1 AND tip_amount > 0) AS tipped_card_count,
           {r('sum(CASE WHEN trip_distance >= 0.5 THEN fare_amount / trip_distance ELSE 0 END)')} AS fare_per_mile_total
    FROM good GROUP BY ALL"""
FINALS["join_pickup_zone"] = f"""
    SELECT {ENDS}, zone AS pickup_zone, borough AS pickup_borough
    FROM good JOIN zones ON PULocationID = location_id"""
FINALS["join_selected_zones"] = f"""
    SELECT {ENDS}, pickup_zone, pickup_borough, borough_rank
    FROM good JOIN city_ranks ON PULocationID = location_id WHERE borough_rank <= 5"""
FINALS["join_od_zones"] = f"""
    SELECT {ENDS}, p.zone AS pickup_zone, p.borough AS pickup_borough, e.zone AS dropoff_zone,
           e.borough AS dropoff_borough
    FROM good JOIN zones p ON PULocationID = p.location_id JOIN zones e ON DOLocationID = e.location_id
    WHERE PULocationID <> DOLocationID"""
FINALS["join_od_candidates"] = f"""
    SELECT {ENDS}, origin_zone, destination_zone, destination_rank
    FROM good JOIN pairs ON PULocationID = origin_id AND DOLocationID = destination_id"""
FINALS["top_zones_by_borough"] = """
    SELECT * REPLACE (round(longitude, 6) AS longitude, round(latitude, 6) AS latitude) FROM flow_zones"""
FINALS["top5_zones"] = "SELECT * FROM city_ranks WHERE borough_rank <= 5"
FINALS["top2_zones"] = "SELECT * FROM city_ranks WHERE borough_rank <= 2"
FINALS["top3_or_pinned"] = """
    SELECT * REPLACE (round(origin_longitude, 6) AS origin_longitude,
                      round(origin_latitude, 6) AS origin_latitude) FROM origins"""
_POINTS = ", ".join(
    f"round({c}, 6) AS {c}"
    for c in ("origin_longitude", "origin_latitude", "destination_longitude", "destination_latitude")
)
FINALS["top12_destinations"] = f"SELECT * REPLACE ({_POINTS}) FROM pairs"
FINALS["seasonal_baseline"] = f"""
    SELECT trip_date::VARCHAR AS trip_date, pickup_day_of_week, pickup_hour, pickup_zone, pickup_borough,
           airport_flag, trip_count,
           {r('avg(trip_count) OVER (PARTITION BY pickup_zone, pickup_day_of_week, pickup_hour, airport_flag)')} AS expected_trip_count
    FROM (SELECT trip_date, pickup_day_of_week, pickup_hour, zone AS pickup_zone, borough AS pickup_borough,
                 airport_flag, count(*) AS trip_count
          FROM good JOIN zones ON PULocationID = location_id
          WHERE borough IN {CITY} AND location_id NOT IN {AIRPORTS} GROUP BY ALL)"""

_DATE = "trip_date::VARCHAR AS trip_date"


def _rounded(*columns: str) -> str:
    return ", ".join(f"{r(c)} AS {c}" for c in columns)


FINALS["mart_quantile_fan"] = f"SELECT * REPLACE ({_DATE}) FROM m_fan"
FLOW_DOUBLES = _rounded("longitude", "latitude", "distance_total", "dx_total", "dy_total")
FINALS["mart_directional_flow"] = f"SELECT * REPLACE ({_DATE}, {FLOW_DOUBLES}) FROM m_flow"
OD_DOUBLES = _POINTS + ", " + _rounded("duration_total")
FINALS["mart_od_connections"] = f"SELECT * REPLACE ({_DATE}, {OD_DOUBLES}) FROM m_od"
PROFILE_DOUBLES = _rounded("duration_total", "fare_per_mile_total")
FINALS["mart_operating_profile"] = f"SELECT * REPLACE ({_DATE}, {PROFILE_DOUBLES}) FROM m_profile"
HORIZON_DOUBLES = _rounded("expected_trip_count")
FINALS["mart_demand_horizon"] = f"SELECT * REPLACE ({_DATE}, {HORIZON_DOUBLES}) FROM m_horizon"
FARE_DOUBLES = _rounded("fare_total", "tip_total", "extras_total")
FINALS["mart_fare_composition"] = f"SELECT * REPLACE ({_DATE}, {FARE_DOUBLES}) FROM m_fare"
FINALS["incremental_mart_fare"] = FINALS["mart_fare_composition"]
FINALS["incremental_mart_od"] = FINALS["mart_od_connections"]
FINALS["widget_fan"] = "SELECT * FROM w_fan"
FINALS["widget_flow"] = f"SELECT * REPLACE ({FLOW_DOUBLES}) FROM w_flow"
FINALS["widget_od"] = f"SELECT * REPLACE ({OD_DOUBLES}) FROM w_od"
FINALS["widget_profile"] = f"SELECT * REPLACE ({PROFILE_DOUBLES}) FROM w_profile"
FINALS["widget_horizon"] = f"SELECT * REPLACE ({_DATE}, {HORIZON_DOUBLES}) FROM w_horizon"
FINALS["widget_fare"] = f"SELECT * REPLACE ({FARE_DOUBLES}) FROM w_fare"
SCENARIO = (
    "pickup_hour IN (8, 9) AND trip_date BETWEEN DATE '2025-10-01' AND DATE '2025-12-31'"
    " AND pickup_borough = 'Queens' AND airport_flag = 'Airport'"
)
SLICES: dict[str, str] = {}
for _key, _where in (
    ("slice_hours", "pickup_hour IN (8, 9)"),
    ("slice_dates", "trip_date BETWEEN DATE '2025-10-01' AND DATE '2025-12-31'"),
    ("slice_boroughs", "pickup_borough IN ('Queens', 'Bronx')"),
    ("slice_airport", "airport_flag = 'Airport'"),
    ("slice_combined", SCENARIO),
):
    SLICES[_key] = _where
FINALS["widget_all_aggs"] = f"""
    SELECT pickup_borough, airport_flag, sum(trip_count)::BIGINT AS trip_sum, {r('avg(trip_count)')} AS trip_avg,
           count(trip_count) AS row_count, {r('min(fare_total)')} AS fare_min, {r('max(fare_total)')} AS fare_max
    FROM m_fare GROUP BY ALL"""

# Name, mart, its fields and its widget's grouping columns.
DATASETS = (
    ("airport_quantile", "m_fan", "airport, duration_bin_minutes, bin_trip_count", "airport, pickup_hour, duration_bin_minutes"),
    ("directional_flow", "m_flow", "pickup_zone, longitude, latitude, trip_count, distance_total, dx_total, dy_total", "pickup_zone, pickup_borough, longitude, latitude"),
    ("od_connection", "m_od", "origin_zone, destination_zone, origin_longitude, origin_latitude, destination_longitude, destination_latitude, trip_count, duration_total", OD_DIMS),
    ("parallel_coordinates", "m_profile", "pickup_zone, " + ", ".join(PROFILE_SUMS), "pickup_zone, pickup_borough"),
    ("horizon", "m_horizon", "pickup_zone, trip_count, expected_trip_count", "trip_date, pickup_zone, pickup_borough"),
    ("fare_ternary", "m_fare", "payment_category, trip_count, fare_total, tip_total, extras_total", "pickup_borough, payment_category, airport_flag"),
)
FILTERS = "pickup_hour, trip_date, pickup_borough, airport_flag"
FINALS["filter_options"] = " UNION ALL ".join(
    f"SELECT DISTINCT '{name}' AS dataset, '{field.strip()}' AS field, {field}::VARCHAR AS option FROM {mart}"
    for name, mart, _, _ in DATASETS
    for field in FILTERS.split(",")
)
def _listed(names: str) -> list[str]:
    return [n.strip() for n in names.split(",")]


for _key, _where in SLICES.items():
    FINALS[_key] = " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, concat_ws('|', {', '.join(f'{d}::VARCHAR' for d in _listed(dims))}) AS dimensions,"
        f" '{measure}' AS measure, {r(f'sum({measure})::DOUBLE')} AS value FROM {mart} WHERE {_where} GROUP BY {dims}"
        for name, mart, fields, dims in DATASETS
        for measure in _listed(fields)
        if measure not in _listed(dims) and measure not in _listed(FILTERS)
    )
FINALS["field_contract"] = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, '{','.join(sorted(f'{FILTERS}, {fields}'.replace(' ', '').split(',')))}' AS fields,"
    " '' AS missing_fields, '' AS unexpected_fields, true AS fields_match,"
    f" count(*) AS row_count FROM {mart}"
    for name, mart, fields, _ in DATASETS
) + """
    UNION ALL SELECT 'deviating', 'airport_flag,extras_total,fare_total,payment_category,pickup_borough,pickup_hour,surcharge,trip_count,trip_date',
        'tip_total', 'surcharge', false, count(*) FROM m_fare"""
FINALS["type_contract"] = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, true AS trip_date_is_date, true AS pickup_hour_is_integral,"
    " min(trip_date)::VARCHAR AS first_date, max(trip_date)::VARCHAR AS last_date,"
    f" min(pickup_hour) AS first_hour, max(pickup_hour) AS last_hour FROM {mart}"
    for name, mart, _, _ in DATASETS
)
FINALS["dataset_evidence"] = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, count(*) AS runtime_rows, count(*) FILTER (hit) AS filtered_rows,"
    " count(*) FILTER (hit) > 0 AS slice_is_not_empty FROM"
    f" (SELECT bool_or({SCENARIO}) AS hit FROM {mart} GROUP BY {dims})"
    for name, mart, _, dims in DATASETS
)

FINALS["histogram_cdf"] = f"SELECT * REPLACE ({_rounded('cumulative_share')}) FROM shares_of_bins"
FINALS["histogram_quantiles"] = """
    SELECT airport, pickup_hour, min(duration_bin_minutes) FILTER (cumulative_share >= 0.10) AS p10_minutes,
           min(duration_bin_minutes) FILTER (cumulative_share >= 0.25) AS p25_minutes,
           min(duration_bin_minutes) FILTER (cumulative_share >= 0.50) AS median_minutes,
           min(duration_bin_minutes) FILTER (cumulative_share >= 0.75) AS p75_minutes,
           min(duration_bin_minutes) FILTER (cumulative_share >= 0.90) AS p90_minutes,
           max(total_trips) AS trip_count
    FROM shares_of_bins GROUP BY ALL"""
FINALS["custom_category_order"] = """
    SELECT airport, sum(bin_trip_count)::BIGINT AS trip_count,
           (CASE airport WHEN 'JFK' THEN 0 WHEN 'LGA' THEN 1 WHEN 'EWR' THEN 2 END)::INTEGER AS category_order
    FROM w_fan GROUP BY airport"""
FINALS["hour_label"] = """
    SELECT pickup_hour, sum(trip_count)::BIGINT AS trip_count,
           lpad(pickup_hour::VARCHAR, 2, '0') || ':00' AS hour_label FROM m_fare GROUP BY pickup_hour"""
FINALS["hour_axis_label"] = """
    SELECT pickup_hour, sum(trip_count)::BIGINT AS trip_count,
           CASE WHEN pickup_hour = 0 THEN '12a' WHEN pickup_hour < 12 THEN pickup_hour || 'a'
                WHEN pickup_hour = 12 THEN '12p' ELSE (pickup_hour - 12) || 'p' END AS axis_label
    FROM m_fare GROUP BY pickup_hour"""
FINALS["flow_bearing"] = f"""
    SELECT * REPLACE ({FLOW_DOUBLES}), {r('(atan2(dy_total, dx_total) * 180 / pi() + 360) % 360')} AS bearing_degrees,
           {r('distance_total / trip_count')} AS mean_distance FROM w_flow"""
LINK_DOUBLES = OD_DOUBLES + ", " + _rounded("mean_duration_min")
FINALS["slice_top6_destinations"] = f"SELECT * REPLACE ({LINK_DOUBLES}) FROM links_rush"
FINALS["od_origin_totals"] = """
    SELECT origin_zone, pickup_borough, round(origin_longitude, 6) AS origin_longitude,
           round(origin_latitude, 6) AS origin_latitude, sum(trip_count)::BIGINT AS origin_trip_count
    FROM links GROUP BY ALL"""
FINALS["selection_filter"] = (
    f"SELECT * REPLACE ({LINK_DOUBLES}) FROM (SELECT * FROM links WHERE origin_zone IN ('Zone 161', 'Zone 103'))"
)
FINALS["selection_highlight"] = """
    SELECT segment_id, trip_count,
           segment_id IN ('Queens · Cash · Airport', 'Bronx · Other · Non-airport') AS is_selected FROM shares"""
FINALS["profile_ratios"] = (
    "SELECT * REPLACE ("
    + _rounded("mean_duration_min", "mean_fare_per_mile", "card_tip_rate", "airport_share")
    + ") FROM ratios"
)
FINALS["profile_fold"] = f"SELECT * REPLACE ({_rounded('value')}) FROM folded"
FINALS["axis_min_max"] = f"SELECT * REPLACE ({_rounded('value', 'axis_min', 'axis_max')}) FROM ranged"
FINALS["profile_normalized"] = f"""
    SELECT * REPLACE ({_rounded('value', 'axis_min', 'axis_max')}),
           {r('(value - axis_min) / greatest(0.000001, axis_max - axis_min)')} AS norm_value FROM ranged"""


def _label(x: str) -> str:
    trimmed = "regexp_replace(format('{{:.5f}}', {}), '\\.?0+$', '')"
    return (
        f"CASE key WHEN 'trip_count' THEN CASE WHEN {x} >= 1000 THEN {trimmed.format(f'{x} / 1000')} || 'k'"
        f" ELSE {trimmed.format(x)} END"
        f" WHEN 'mean_duration_min' THEN format('{{:.1f}}', {x}) || ' min'"
        f" WHEN 'mean_fare_per_mile' THEN '$' || format('{{:.2f}}', {x})"
        f" ELSE format('{{:.0f}}', {x} * 100) || '%' END"
    )


FINALS["axis_labels"] = f"""
    SELECT profile_id, key, axis_order, {_label('axis_min')} AS axis_min_label,
           {_label('axis_max')} AS axis_max_label FROM ranged"""
FINALS["demand_deviation"] = (
    f"SELECT * REPLACE ({_DATE}, "
    + _rounded(
        "expected_trip_count", "deviation_ratio", "deviation_score", "positive_score", "negative_score"
    )
    + ") FROM scored"
)
FINALS["horizon_bands"] = " UNION ALL ".join(
    f"SELECT {_DATE}, pickup_zone, pickup_borough, '{side}' AS side, {r(f'{side}_score')} AS score,"
    f" {band}::INTEGER AS band, {r(f'greatest(0, least(1, {side}_score - {band}))')} AS band_value FROM scored"
    for side in ("positive", "negative")
    for band in (0, 1, 2)
)
FINALS["fare_shares"] = (
    f"SELECT * REPLACE ({FARE_DOUBLES}, "
    + _rounded("component_total", "fare_share", "tip_share", "extras_share")
    + ") FROM shares"
)
FINALS["ternary_coordinates"] = (
    "SELECT segment_id, trip_count, "
    + _rounded("display_tip_share", "display_extras_share")
    + f", {r('0.5 * (2 * display_extras_share + display_tip_share)')} AS display_x,"
    + f" {r('0.8660254 * display_tip_share')} AS display_y FROM ("
    + "SELECT *, sqrt(tip_share) / root_total AS display_tip_share,"
    + " sqrt(extras_share) / root_total AS display_extras_share FROM ("
    + "SELECT *, sqrt(fare_share) + sqrt(tip_share) + sqrt(extras_share) AS root_total FROM shares))"
)

FINALS["event_parse"] = "SELECT event_id, event_type, pipeline_id, pipeline_name, update_id, flow_name FROM ev"
FINALS["event_text_clean"] = "SELECT n::VARCHAR AS id, left(clean_message, 60) AS message_60 FROM log"
FINALS["flow_layer"] = "SELECT flow_name, flow_key, layer, count(*) AS event_count FROM evl GROUP BY ALL"
FINALS["event_time_parse"] = "SELECT event_id, epoch_us(event_time) AS event_time_us FROM ev"
FINALS["event_state"] = "SELECT event_id, event_type, state FROM ev"
FINALS["event_metrics"] = f"""
    SELECT event_id, num_input_rows, num_output_rows, num_output_bytes, NULL::DOUBLE AS num_upserted_rows,
           NULL::DOUBLE AS num_deleted_rows, backlog_records, NULL::DOUBLE AS backlog_bytes,
           NULL::DOUBLE AS backlog_files, {r('input_rows_per_second')} AS input_rows_per_second,
           {r('processed_rows_per_second')} AS processed_rows_per_second
    FROM evm WHERE has_metrics"""
FINALS["event_expectations"] = f"""
    SELECT *, {r('failed_records / nullif(passed_records + failed_records, 0)')} AS failure_ratio
    FROM expectation_items"""
OBSERVED = _rounded("observed_duration_seconds", "observed_queue_seconds", "avg_output_rows_per_second")
FINALS["flow_timings"] = f"SELECT event_id, state, num_output_rows, {OBSERVED} FROM observed WHERE terminal"
FINALS["flow_timings_stream"] = FINALS["flow_timings"]
FINALS["alert_severity"] = """
    SELECT event_id, severity, condition, array_to_string(reason_list, '|') AS reasons FROM graded"""
FINALS["zero_output_alerts"] = """
    SELECT event_id, flow_key, severity, array_to_string(reason_list, '|') AS reasons, num_output_rows
    FROM graded WHERE condition = 'unexpected_zero_output'"""
FINALS["alert_payloads"] = f"""
    SELECT '1.0' AS schema_version, 'sdp_event_hook' AS source, event_id, event_id || ':slack' AS idempotency_key,
           'slack' AS destination_key, 'integration' AS environment, pipeline_id, pipeline_name, update_id,
           flow_name, flow_key, layer, event_type, state, severity, condition, event_time_text, message,
           monitor_key, diagnostic_url, num_output_rows, {OBSERVED} FROM payloads"""
FINALS["alerts_stream"] = FINALS["alert_payloads"]
FINALS["metric_formatting"] = f"""
    SELECT event_id, {number_text('num_output_rows')} AS rows_text,
           {number_text('processed_rows_per_second')} AS rate_text,
           {bytes_text('num_output_bytes')} AS bytes_text,
           {duration_text('observed_duration_seconds')} AS duration_text
    FROM observed WHERE num_output_rows IS NOT NULL"""
CTES["quality_sums"] = """
    SELECT event_id, sum(passed_records) AS passed, sum(failed_records) AS failed_sum,
           string_agg(name, ', ' ORDER BY name) FILTER (failed_records > 0) AS failing
    FROM expectation_items GROUP BY event_id"""
CTES["messages"] = f"""
    SELECT p.*, CASE severity WHEN 'critical' THEN '🚨' WHEN 'warning' THEN '⚠️' ELSE '✅' END AS mark,
           coalesce(nullif(flow_key, ''), pipeline_name) AS shown_flow,
           coalesce(nullif(state, ''), 'METRICS') AS shown_state,
           CASE WHEN processed_rows_per_second IS NOT NULL
                THEN '`' || {number_text('processed_rows_per_second')} || ' rows/s` processed (native)'
                WHEN input_rows_per_second IS NOT NULL
                THEN '`' || {number_text('input_rows_per_second')} || ' rows/s` input (native)'
                WHEN avg_output_rows_per_second IS NOT NULL
                THEN '`' || {number_text('avg_output_rows_per_second')} || ' rows/s` average output (derived)'
                ELSE 'Row rate unavailable; SDP emitted no row count' END
           || CASE WHEN observed_duration_seconds IS NOT NULL
                   THEN chr(10) || 'Observed runtime: `' || {duration_text('observed_duration_seconds')} || '`'
                   ELSE '' END AS throughput_text,
           CASE WHEN backlog_records IS NOT NULL
                THEN 'Records: `' || {number_text('backlog_records')} || '`' || chr(10)
                     || 'Files: `Not reported`' || chr(10) || 'Bytes: `Not reported` (native)'
                WHEN flow_key IN {STREAMS} AND state = 'COMPLETED'
                THEN '`Drained` for this triggered update; native pending count not emitted'
                WHEN flow_key IN {STREAMS} THEN 'Streaming flow; native pending count not emitted'
                ELSE '`N/A` — bounded refresh, not a streaming source' END AS backlog_text,
           CASE WHEN passed IS NULL THEN 'No expectations attached or reported for this flow event'
                ELSE 'Passed: `' || {number_text('passed')} || '` • Failed: `' || {number_text('failed_sum')} || '`'
                     || CASE WHEN failing IS NOT NULL
                             THEN chr(10) || 'Failing rules: `' || {escaped('failing')} || '`' ELSE '' END
                END AS quality_text
    FROM payloads p LEFT JOIN quality_sums q ON p.event_id = q.event_id"""
CTES["summed_up"] = f"""
    SELECT *, mark || ' [integration] ' || layer || ' / ' || shown_flow || ': ' || shown_state
           || CASE WHEN num_output_rows IS NOT NULL
                   THEN ' — ' || {number_text('num_output_rows')} || ' output rows' ELSE '' END AS summary
    FROM messages"""
FINALS["throughput_text"] = "SELECT event_id, throughput_text FROM messages"
FINALS["backlog_text"] = "SELECT event_id, backlog_text FROM messages"
FINALS["alert_message"] = f"""
    SELECT event_id, summary, quality_text, {escaped('message')} AS message_escaped FROM summed_up"""


def _json_text(x: str) -> str:
    """A JSON string literal; the texts hold quotes, backslashes and line breaks at most."""
    quoted = f"replace(replace({x}, chr(92), chr(92) || chr(92)), chr(34), chr(92) || chr(34))"
    return f"chr(34) || replace({quoted}, chr(10), chr(92) || 'n') || chr(34)"


def _field(title: str, x: str, tick: str = "`") -> str:
    shown = f"'*{title}*' || chr(10) || '{tick}' || {x} || '{tick}'"
    return f"""'{{"type":"mrkdwn","text":' || {_json_text(shown)} || '}}'"""


def _listed(*fields: str) -> str:
    return " || ',' || ".join(fields)


FINALS["alert_body_json"] = f"""
    SELECT event_id, '{{"text":' || {_json_text('summary')} || ',"blocks":['
        || '{{"type":"header","text":{{"type":"plain_text","text":'
        || {_json_text("mark || ' ' || layer || ' flow ' || lower(shown_state)")} || ',"emoji":true}}}},'
        || '{{"type":"section","fields":['
        || {_listed(
            _field("Flow", escaped("shown_flow")),
            _field("Environment", "'integration'"),
            _field("State", escaped("shown_state")),
            _field("Severity", "upper(severity)"),
        )} || ']}},{{"type":"section","fields":['
        || {_listed(
            _field("Input rows", f"({number_text('num_input_rows')})"),
            _field("Output rows", f"({number_text('num_output_rows')})"),
            _field("Output bytes", f"({bytes_text('num_output_bytes')})"),
            _field("Throughput", "throughput_text", ""),
            _field("Backlog status", "backlog_text", ""),
            _field("Data quality", "quality_text", ""),
        )} || ']}},{{"type":"context","elements":[{{"type":"mrkdwn","text":'
        || {_json_text("'Update `' || update_id || '` • Event `' || event_time_text || '`'")} || '}}]}}'
        || CASE WHEN diagnostic_url <> '' THEN ',{{"type":"actions","elements":[{{"type":"button",'
             || '"text":{{"type":"plain_text","text":"Open pipeline update"}},"url":'
             || {_json_text('diagnostic_url')} || '}}]}}' ELSE '' END
        || '],"unfurl_links":false,"unfurl_media":false}}' AS body
    FROM summed_up"""

ORACLES: dict[str, str] = {}
for _key, _final in FINALS.items():
    if _final.lstrip().startswith("WITH counted"):
        _steps = ",\n".join(f"{n} AS ({CTES[n]})" for n in _needed(_final))
        ORACLES[_key] = f"WITH {_steps},\n" + _final.lstrip()[len("WITH ") :]
    else:
        ORACLES[_key] = _sql(_final)

# The rows of every published table, from the statements of the tables themselves.
_PUBLISHED = {
    "accepted": ("silver", "accepted_trips", "Trips that keep every rule"),
    "quarantine": ("silver", "quarantined_trips", "Trips that break a rule, with the reasons"),
    "quality_metrics": ("silver", "dq_metrics", "Rows that break each rule"),
    "airport_quantile": ("gold", "mart_quantile_fan", "Additive mart: airport quantile"),
    "directional_flow": ("gold", "mart_directional_flow", "Additive mart: directional flow"),
    "od_connection": ("gold", "mart_od_connections", "Additive mart: od connection"),
    "parallel_coordinates": ("gold", "mart_operating_profile", "Additive mart: parallel coordinates"),
    "horizon": ("gold", "mart_demand_horizon", "Additive mart: horizon"),
    "fare_ternary": ("gold", "mart_fare_composition", "Additive mart: fare ternary"),
}
ORACLES["refresh_tables"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{layer}' AS layer, '{comment}' AS comment, count(*) AS row_count FROM ({ORACLES[key]})"
    for table, (layer, key, comment) in _PUBLISHED.items()
)
