"""Written tables between the layers: raw trips, accepted trips, marts, event log, events.

Each layer is computed once per application and folder of given tables, then read like any
other parquet table: later queries prune its columns, push their bounds into its scan, and
never repeat the parsing or the rules of the layer below. A lost executor costs the tasks
it ran, not the lineage. The tables live below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from curbline.operators import enrich, quality
from curbline.operators.cuboids import write_cuboids
from curbline.operators.layout import clustered
from curbline.operators.flow_timings import with_flow_timings, with_output_rate
from curbline.plans import alerts, marts, widgets
from curbline.session import new_work_dir
from curbline.sources import derived

_PATHS: dict[tuple[str, str, str], str] = {}
_LOCKS: dict[tuple[str, str, str], threading.RLock] = {}
_LOCK = threading.Lock()


def written(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]) -> str:
    """The folder ``name``, filled by ``write`` when it is first asked for."""
    key = (spark.conf.get("spark.app.id"), sf_dir, name)
    with _LOCK:
        own = _LOCKS.setdefault(key, threading.RLock())
    with own:  # tables wait only for those that they are built from
        if key not in _PATHS:
            path = new_work_dir(spark, "".join(c if c.isalnum() else "-" for c in name)[:40])
            write(path)
            _PATHS[key] = path
    return _PATHS[key]


def stored(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """The table ``name``, built when it is first asked for."""
    return spark.read.parquet(
        written(spark, sf_dir, name, lambda path: build().write.parquet(path))
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(
        spark, sf_dir, "raw_trips", lambda: derived.trips(spark, sf_dir, lambda rows: clustered(rows, derived.TRIP_ORDER))
    )


def accepted_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality.trip_rules(2025)
    return stored(
        spark,
        sf_dir,
        "accepted_trips",
        # Raw trips are in order of pickup already, so each file covers some days.
        lambda: enrich.accepted_trips(raw_trips(spark, sf_dir), rules),
    )


def mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    def build() -> DataFrame:
        return marts.MARTS[name](accepted_trips(spark, sf_dir), derived.zones(spark))

    return stored(spark, sf_dir, f"mart_{name}", build)


def cube(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The folder with a dataset's cuboids."""

    def write(path: str) -> None:
        fields = widgets.dataset_fields(name)
        source = mart(spark, sf_dir, name).select(*fields)
        write_cuboids(source, path, widgets.WIDGET_DIMS[name], widgets.FILTER_FIELDS, widgets.WIDGET_SUMS[name])

    return written(spark, sf_dir, f"cube_{name}", write)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    # In order of the text of their time: files of equal volume, whose parsing is as many tasks.
    return stored(
        spark, sf_dir, "event_log", lambda: derived.event_log(spark, sf_dir, lambda rows: clustered(rows, derived.LOG_ORDER))
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with its JSON parsed once, as typed columns."""
    return stored(
        spark, sf_dir, "events", lambda: alerts.normalized_events(event_log(spark, sf_dir))
    )


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed events with the timings of their flows."""
    return stored(spark, sf_dir, "timed_events", lambda: with_output_rate(with_flow_timings(events(spark, sf_dir))))


def found_alerts(spark: SparkSession, sf_dir: str, settings: alerts.AlertSettings) -> DataFrame:
    """The alerts under one set of settings, in rows that messages are made from."""
    return stored(
        spark, sf_dir, f"alerts-{settings}", lambda: alerts.timed_alerts(timed_events(spark, sf_dir), settings)
    )
