"""Runtime and queue time of pipeline flows, taken from the order of their events.

A flow is (pipeline, update, flow name). Its first QUEUED and its first STARTING or RUNNING
event since the last terminal event start the clock; a terminal event stops and clears it.

That is a fold over each flow's events, and one flow may own a large share of the log, even
within one minute. So the fold is a segmented prefix scan over ranges of equal volume:

1. events that move a clock are cut into ranges by (flow, time, id); Spark samples the cuts.
   One pass over each sorted range numbers its runs (from one terminal event to the next)
   and keeps their first times. The folded ranges are a written table, so the cuts stay;
2. each flow leaves one summary row in each range it has events in: whether a clock was
   stopped there, and which ones were still running at its end. A window over a flow's
   summaries gives what every range starts with;
3. only the first run of a flow in a range can depend on that: its one terminal event is
   joined with what was carried in. All other rows are finished by the first step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.functions.events import QUEUED_STATES, STARTED_STATES, TERMINAL_STATES
from curbline.session import new_work_dir

FLOW_KEY = ["pipeline_id", "update_id", "flow_name"]
SHORTEST_RUN = 0.001
STATE_DDL = (
    "pipeline_id string, update_id string, flow_name string,"
    " queued_at timestamp, started_at timestamp"
)
OBSERVED = ("observed_duration_seconds", "observed_queue_seconds")

#: Columns of a folded range: its number, the run of the flow in it, whether the event stops the clock,
#: the run's first times, and the event's place in the range.
FOLD_FIELDS = T.StructType(
    [
        T.StructField("__range", T.IntegerType()), T.StructField("__run", T.IntegerType()), T.StructField("__stop", T.BooleanType()),
        T.StructField("__queued", T.TimestampType()), T.StructField("__started", T.TimestampType()), T.StructField("__place", T.LongType()),
    ]
)
_NEVER = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Folded:
    """Events after the first step: ``ranges`` move a clock, ``others`` don't."""

    ranges: DataFrame
    others: DataFrame
    columns: list[str]


def fold(events: DataFrame, ranges: int | None = None, path: str | None = None) -> Folded:
    """The first step. ``ranges`` fixes their number; else their volume decides.

    Needs FLOW_KEY, ``state``, ``event_time`` and ``event_id``; all other columns pass through.
    """
    path = path or new_work_dir(events.sparkSession, "folded-events")
    order = [*FLOW_KEY, "event_time", "event_id"]
    own = events.where(moves_a_clock())
    cut = own.repartitionByRange(ranges, *order) if ranges else own.repartitionByRange(*order)
    schema = T.StructType([*events.schema.fields, *FOLD_FIELDS.fields])
    cut.sortWithinPartitions(*order).mapInArrow(fold_task, schema).write.mode("overwrite").parquet(path)
    return read_folded(events, path)


def read_folded(events: DataFrame, *paths: str) -> Folded:
    """What ``fold`` wrote for these events."""
    schema = T.StructType([*events.schema.fields, *FOLD_FIELDS.fields])
    ranges = events.sparkSession.read.schema(schema).parquet(*paths)
    return Folded(ranges, events.where(~moves_a_clock()), events.columns)


def fold_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the runs of a sorted range; the last run goes on in the next batch."""
    number, place = TaskContext.get().partitionId(), 0
    last_flow, run, stopped, queued, started = None, 0, False, _NEVER, _NEVER
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        flow, at = [batch.column(c) for c in FLOW_KEY], batch.column("event_time").cast(pa.int64()).to_numpy()
        first = np.zeros(rows, bool)
        for column in flow:
            codes = column.dictionary_encode().indices.to_numpy()
            first[1:] |= codes[1:] != codes[:-1]
        first[0] = tuple(c[0].as_py() for c in flow) != last_flow
        state = batch.column("state")
        stops, queues, starts = (
            pc.is_in(state, value_set=pa.array(s)).to_numpy(zero_copy_only=False) for s in (TERMINAL_STATES, QUEUED_STATES, STARTED_STATES)
        )
        opens = first.copy()
        opens[1:] |= stops[:-1]
        opens[0] |= stopped
        goes_on = not opens[0]
        opens[0] = True
        begins, runs = np.flatnonzero(opens), np.cumsum(opens) - 1
        first_queued = np.minimum.reduceat(np.where(queues, at, _NEVER), begins)
        first_started = np.minimum.reduceat(np.where(starts, at, _NEVER), begins)
        if goes_on:
            first_queued[0], first_started[0] = min(first_queued[0], queued), min(first_started[0], started)
        # Runs count from 0 in each flow; the first flow of the batch may have begun before it.
        base = np.maximum.accumulate(np.where(first, runs, -1))
        ahead = 0 if first[0] else run + (not goes_on)
        own = np.where(base >= 0, runs - np.maximum(base, 0), runs + ahead)
        times = [pa.array(t[runs], pa.timestamp("us", "UTC"), mask=t[runs] == _NEVER) for t in (first_queued, first_started)]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns, pa.array(np.full(rows, number, np.int32)), pa.array(own.astype(np.int32)), pa.array(stops), *times,
                pa.array(np.arange(place, place + rows)),
            ],
            names=[*batch.schema.names, *FOLD_FIELDS.names],
        )
        place += rows
        last_flow, run, stopped = tuple(c[-1].as_py() for c in flow), int(own[-1]), bool(stops[-1])
        queued, started = int(first_queued[-1]), int(first_started[-1])


def summaries(folded: Folded) -> DataFrame:
    """One row for each flow and range: whether a clock was stopped, which ones run on, and the last event's time."""
    last = F.max_by(F.struct("__stop", "__queued", "__started"), "__place")
    ended = folded.ranges.groupBy(*FLOW_KEY, "__range").agg(
        F.max("__stop").alias("__stopped"), last.alias("__last"), F.max("event_time").alias("__until")
    )
    runs_on = ~F.col("__last.__stop")
    return ended.select(
        *FLOW_KEY, "__range", "__stopped", "__until", F.when(runs_on, F.col("__last.__queued")).alias("__tail_queued"),
        F.when(runs_on, F.col("__last.__started")).alias("__tail_started"),
    )


def _with_clocks(ends: DataFrame, carried: DataFrame | None) -> DataFrame:
    """The clocks running at the end of each range, earlier ranges included.

    A window holds one row for each range that a flow has events in, however many events.
    """
    if carried is not None:
        before_all = carried.select(
            *FLOW_KEY, F.lit(-1).alias("__range"), F.lit(False).alias("__stopped"), F.lit(None).cast("timestamp").alias("__until"),
            F.col("queued_at").alias("__tail_queued"), F.col("started_at").alias("__tail_started"),
        )
        ends = ends.unionByName(before_all)
    upto = Window.partitionBy(*FLOW_KEY).orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)
    since_stop = Window.partitionBy(*FLOW_KEY, "__stops").orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)
    return ends.withColumn("__stops", F.sum(F.col("__stopped").cast("int")).over(upto)).withColumns(
        {"__open_queued": F.min("__tail_queued").over(since_stop), "__open_started": F.min("__tail_started").over(since_stop)}
    )


def carried_into(ends: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """What each flow's range starts with: ``__carried_queued`` and ``__carried_started``."""
    before = Window.partitionBy(*FLOW_KEY).orderBy("__range")
    return _with_clocks(ends, carried).select(
        *FLOW_KEY, "__range", F.lag("__open_queued").over(before).alias("__carried_queued"),
        F.lag("__open_started").over(before).alias("__carried_started"),
    )


def finished(folded: Folded, starts: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """The events with their timings. ``starts`` has what ranges start with, told apart by ``also`` too."""
    needs = (F.col("__run") == 0) & F.col("__stop")
    some = starts.where("__carried_queued IS NOT NULL OR __carried_started IS NOT NULL")
    joined = folded.ranges.where(needs).join(some, [*FLOW_KEY, "__range", *also], "left")
    nothing = F.lit(None).cast("timestamp")
    whole = folded.ranges.where(~needs).withColumns({"__carried_queued": nothing, "__carried_started": nothing})
    queued = F.least("__carried_queued", "__queued")
    started = F.coalesce(F.least("__carried_started", "__started"), queued)
    timings = {
        OBSERVED[0]: F.when(
            F.col("__stop") & started.isNotNull(), F.greatest(_seconds(started, F.col("event_time")), F.lit(SHORTEST_RUN))
        ),
        OBSERVED[1]: F.when(F.col("__stop") & queued.isNotNull(), F.greatest(_seconds(queued, started), F.lit(0.0))),
    }
    empty = F.lit(None).cast("double")
    others = folded.others.withColumns({name: empty for name in OBSERVED})
    timed = joined.unionByName(whole).withColumns(timings).select(*folded.columns, *OBSERVED)
    return timed.unionByName(others)


def with_flow_timings(events: DataFrame, carried: DataFrame | None = None, ranges: int | None = None) -> DataFrame:
    """``events`` with ``observed_duration_seconds`` and ``observed_queue_seconds``.

    ``carried`` holds the clocks that were running before these events. Events that move no
    clock take no part in the shuffles. The folded ranges are written when this is called.
    """
    folded = fold(events, ranges)
    return finished(folded, carried_into(summaries(folded), carried))


def running_clocks(events: DataFrame, carried: DataFrame | None = None, ranges: int | None = None) -> DataFrame:
    """The clocks still running after these events: one row per unfinished flow."""
    ends = _with_clocks(summaries(fold(events, ranges)), carried)
    last = F.max_by(F.struct("__open_queued", "__open_started"), "__range").alias("__open")
    return (
        ends.groupBy(*FLOW_KEY).agg(last)
        .select(*FLOW_KEY, F.col("__open.__open_queued").alias("queued_at"), F.col("__open.__open_started").alias("started_at"))
        .where("queued_at IS NOT NULL OR started_at IS NOT NULL")
    )


def with_output_rate(timed: DataFrame) -> DataFrame:
    """Output rows per second of observed runtime."""
    return timed.withColumn(
        "avg_output_rows_per_second",
        F.col("num_output_rows") / F.col("observed_duration_seconds"),
    )


def moves_a_clock() -> Column:
    """Whether an event belongs to a flow, has a time and starts or stops a clock; never NULL."""
    parts = [F.coalesce(F.col(c), F.lit("")) != "" for c in FLOW_KEY]
    keyed = parts[0] & parts[1] & parts[2] & F.col("event_time").isNotNull()
    return F.coalesce(keyed & F.col("state").isin(*TERMINAL_STATES, *QUEUED_STATES, *STARTED_STATES), F.lit(False))


def _seconds(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / 1e6
