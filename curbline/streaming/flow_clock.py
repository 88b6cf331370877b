"""Alerts and flow timings over an event stream; running clocks are kept as keyed state.

Two streams run one after another. The first parses each micro-batch of the log, folds it by
ranges of equal volume (``operators.flow_timings``) and leaves one summary row for each flow
and range. The second reads these summaries, keeps each flow's running clocks in
a RocksDB state store (``transformWithState``) and answers with what each range starts
with; then the events of the batches that it has answered are finished and graded. So the keyed state sees a
row for each flow and range: a flow that owns a third of the log brings it some rows and not its events.

All output is written under the number of the batch that brought the events, so whatever
is run again replaces itself. A batch leaves a mark among its summaries, and is finished when
the second stream has answered the mark.

A clock that has run for ``keep`` of event time without any event of its flow is dropped by a timer, so
flows that never end don't stay in the state. Events that come ``keep`` behind the newest
one find no clock. An event is judged by the clocks of the batch in which it arrives.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from curbline.functions.events import TERMINAL_STATES
from curbline.operators.flow_timings import FLOW_KEY, finished, fold, read_folded, summaries, with_output_rate
from curbline.plans.alerts import AlertSettings, normalized_events, one_per_event, timed_alerts
from curbline.streaming.ingest import FILES_PER_BATCH, finish

LOG_DDL = (
    "id string, event_type string, timestamp string, message string, origin string, details string"
)
SUMMARY_DDL = (
    "pipeline_id string, update_id string, flow_name string, range_no int, stopped boolean, until timestamp,"
    " tail_queued timestamp, tail_started timestamp, batch_no long"
)
STARTS_DDL = (
    "pipeline_id string, update_id string, flow_name string, range_no int, batch_no long,"
    " carried_queued timestamp, carried_started timestamp"
)
ANSWER = [*FLOW_KEY, "range_no", "batch_no", "carried_queued", "carried_started"]
#: The names that the keyed state sees: those with a leading underscore would not reach it.
PLAIN = {
    "__range": "range_no", "__stopped": "stopped", "__until": "until", "__tail_queued": "tail_queued", "__tail_started": "tail_started",
    "__carried_queued": "carried_queued", "__carried_started": "carried_started",
}
IS_MARK = "flow_name = ''"
#: How long a clock runs without news of its flow.
KEEP = timedelta(days=366)
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


class FlowClock(StatefulProcessor):
    """The running clocks of one flow: since when it is queued and since when it runs."""

    def __init__(self, keep: timedelta):
        self.keep_ms = int(keep.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", "queued timestamp, started timestamp, until_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        news = pd.concat(list(rows)).sort_values(["batch_no", "range_no"])
        queued, started, until = self.clock.get() if self.clock.exists() else (None, None, 0)
        answers = []
        for row in news.to_dict("records"):
            answers.append((*key, row["range_no"], row["batch_no"], queued, started))
            if row["stopped"]:
                queued = started = None
            queued = _earliest(queued, row["tail_queued"])
            started = _earliest(started, row["tail_started"])
            if not pd.isna(row["until"]):
                until = max(until, int(row["until"].timestamp() * 1000))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if queued is None and started is None:
            self.clock.clear()
        else:
            self.clock.update((queued, started, until))
            self.handle.registerTimer(until + self.keep_ms)
        yield pd.DataFrame(answers, columns=ANSWER)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.clock.clear()
        yield pd.DataFrame()

    def close(self) -> None:
        pass


def _earliest(*times):
    return min((pd.Timestamp(t).to_pydatetime() for t in times if not pd.isna(t)), default=None)


def watch_events(
    spark: SparkSession,
    log_path: str,
    out: str,
    checkpoint: str,
    settings: AlertSettings,
    max_files_per_trigger: int = FILES_PER_BATCH,
    seconds: float | None = None,
    keep: timedelta = KEEP,
) -> StreamingQuery:
    """Append parsed events, their timings and alerts below ``out``; returns the second stream's query.

    ``keep`` must stay the same for a checkpoint.
    """
    reader = spark.readStream.schema(LOG_DDL).option("maxFilesPerTrigger", max_files_per_trigger)

    def take(batch: DataFrame, batch_id: int) -> None:
        session, here = batch.sparkSession, f"batch={batch_id}"
        normalized_events(batch).write.mode("overwrite").parquet(f"{out}/events/{here}")
        events = session.read.parquet(f"{out}/events/{here}")
        folded = fold(events, path=f"{out}/folded/{here}")
        # A flow's rows lie in one file, so that no later run finds them out of order.
        told = summaries(folded).withColumnsRenamed(PLAIN).unionByName(_mark(session)).withColumn("batch_no", F.lit(batch_id).cast("long"))
        told = told.repartition(*FLOW_KEY)
        told.write.mode("overwrite").parquet(f"{out}/summaries/{here}")

    taken = _started(reader.parquet(log_path), take, f"{checkpoint}/events")
    finish(taken, seconds=seconds)

    # Its own session, for the state store; the caller's settings stay as they are.
    session = spark.newSession()
    for key, value in STORE.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    news = session.readStream.schema(SUMMARY_DDL).option("recursiveFileLookup", "true").parquet(f"{out}/summaries")
    starts = (
        news.withWatermark("until", f"{int(keep.total_seconds())} seconds")
        .groupBy(*FLOW_KEY)
        .transformWithStateInPandas(FlowClock(keep), STARTS_DDL, "Append", "EventTime")
    )

    def answer(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/starts/answer={batch_id}")
        own = batch.sparkSession
        known = own.read.schema(STARTS_DDL).parquet(f"{out}/starts/answer={batch_id}")
        for number in sorted(r.batch_no for r in known.where(IS_MARK).select("batch_no").collect()):
            publish(own, out, number, known, settings)

    query = _started(starts, answer, f"{checkpoint}/clocks")
    finish(query, seconds=seconds)
    return query


def publish(spark: SparkSession, out: str, number: int, starts: DataFrame, settings: AlertSettings) -> None:
    """Timings and alerts of one batch of events, given what its ranges start with."""
    here = f"batch={number}"
    events = spark.read.parquet(f"{out}/events/{here}")
    folded = read_folded(events, f"{out}/folded/{here}")
    own = starts.where(F.col("batch_no") == number).drop("batch_no").withColumnsRenamed({v: k for k, v in PLAIN.items()})
    with_output_rate(finished(folded, own)).write.mode("overwrite").parquet(f"{out}/timed/{here}")
    timed = spark.read.parquet(f"{out}/timed/{here}")
    timed_alerts(timed, settings).write.mode("overwrite").parquet(f"{out}/alerts/{here}")


def _started(stream: DataFrame, sink, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _mark(spark: SparkSession) -> DataFrame:
    """The row that every batch leaves, whatever its events: it belongs to no flow and is never late."""
    row = ("", "", "", -1, False, None, None, None)
    return spark.createDataFrame([row], SUMMARY_DDL.removesuffix(", batch_no long"))


def read_timings(spark: SparkSession, out: str) -> DataFrame:
    """The terminal events of all batches with their timings."""
    timed = spark.read.parquet(f"{out}/timed").drop("batch")
    return timed.where(F.col("state").isin(*TERMINAL_STATES)).drop("avg_output_rows_per_second")


def read_alerts(spark: SparkSession, out: str) -> DataFrame:
    """One row per alert, also when an event was delivered more than once: the earliest batch's."""
    return one_per_event(spark.read.parquet(f"{out}/alerts"), "batch").drop("batch")
