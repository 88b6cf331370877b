"""Incremental file ingestion, with lineage, schema evolution and rescued values."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from curbline.sources import rescue
from curbline.sources.trips import TRIP_SCHEMA, with_lineage

#: Files in a micro-batch unless a caller says otherwise.
FILES_PER_BATCH = 1000


def finish(*queries: StreamingQuery, seconds: float | None = None, seen: Callable[[], object] = lambda: None) -> None:
    """Wait for ``availableNow`` runs to end, for as long as they take unless ``seconds`` are given.

    When one fails or time runs out, the others are stopped too. ``seen`` is called every
    now and then and once at the end.
    """
    late = None if seconds is None else time.monotonic() + seconds
    try:
        while running := [q for q in queries if q.isActive]:
            running[0].awaitTermination(0.2)
            seen()
            if late is not None and time.monotonic() > late:
                raise TimeoutError(f"streams still running after {seconds} s: {[str(q.id) for q in running]}")
        for query in queries:
            query.awaitTermination()  # raises what ended it
        seen()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def ingest_trips(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    schema: T.StructType = TRIP_SCHEMA,
    max_files_per_trigger: int = FILES_PER_BATCH,
    seconds: float | None = None,
) -> StreamingQuery:
    """Append files that landed since the last run to the bronze table, each exactly once."""
    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(landing)
    )
    query = (
        with_lineage(stream)
        .writeStream.format("parquet")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    finish(query, seconds=seconds)
    return query


def ingest_evolving(
    spark: SparkSession,
    landing: str,
    bronze: str,
    schema_location: str,
    checkpoint: str,
    declared: T.StructType = TRIP_SCHEMA,
    max_files_per_trigger: int = FILES_PER_BATCH,
    seconds: float | None = None,
) -> StreamingQuery:
    """As ``ingest_trips``, for files whose columns may differ from the declared ones.

    The stream carries file names only (the content column is never read), so a new column
    does not end it. Each micro-batch reads its files with their own types, adds columns it
    has not seen to the saved schema, casts, and keeps misfits in ``_rescued_data``. A batch,
    and a schema that it changes, are stored under its number: a batch that is run again
    after a failure starts from the same schema and replaces its own output.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(landing)
        .select("path")
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        frames = [with_lineage(df) for df in rescue.read_by_layout(session, batch)]
        if not frames:
            return
        saved = rescue.latest_schema(session, schema_location, before=batch_id)
        known = saved or declared
        lineage = ["_source_file", "_source_file_modification_time", "_ingested_at"]
        target = rescue.evolve(known, frames, ignore=lineage)
        if target != saved:
            rescue.save_schema(session, schema_location, batch_id, target)
        rescue.rescued_union(frames, target, lineage).write.mode("overwrite").parquet(
            f"{bronze}/ingest_batch={batch_id}"
        )

    query = (
        names.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    finish(query, seconds=seconds)
    return query


def read_evolved(spark: SparkSession, bronze: str, schema_location: str) -> DataFrame:
    """The bronze table under the newest schema; older batches show NULL in newer columns."""
    newest = rescue.latest_schema(spark, schema_location)
    full = T.StructType(
        [
            *newest.fields,
            T.StructField(rescue.RESCUED, T.StringType()),
            T.StructField("_source_file", T.StringType()),
            T.StructField("_source_file_modification_time", T.TimestampType()),
            T.StructField("_ingested_at", T.TimestampType()),
        ]
    )
    return spark.read.schema(full).parquet(bronze).drop("ingest_batch")
