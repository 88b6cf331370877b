"""Bronze to accepted and quarantined trips, and marts kept up to date by increments."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from curbline.operators import enrich, quality
from curbline.operators.additive import resum
from curbline.sources.lake import FAN, Lake
from curbline.streaming.ingest import FILES_PER_BATCH, finish

#: The table of graded trips, and the ledger of what each micro-batch broke.
TRIPS, LEDGER = "graded_trips", "expectation_ledger"
ACCEPTED, QUARANTINED = "accepted", "quarantined"


def split_stream(
    spark: SparkSession,
    bronze: str,
    schema: T.StructType,
    lake: Lake,
    checkpoint: str,
    rules: Sequence[quality.Rule],
    max_files_per_trigger: int = FILES_PER_BATCH,
    seconds: float | None = None,
    stream: str = TRIPS,
) -> StreamingQuery:
    """Grade each micro-batch once: both sides and the counts of every rule, in one change of the lake.

    The source is read once. A row is written once, below ``verdict=accepted`` or
    ``verdict=quarantined``, and Spark counts rows and broken rules while it writes. Rows, counts and the
    number of the batch are published together, so tables and ledger never disagree, and a batch that is run again
    after it was published is left out.
    """

    def grade(batch: DataFrame, number: int) -> None:
        change = lake.change()
        if change.last_batch(stream) >= number:
            return
        seen = Observation(f"{stream}-{number}")
        graded = quality.with_rejections(enrich.with_trip_columns(quality.counted(batch, rules, seen)), rules)
        verdict = F.when(F.size("rejection_reasons") == 0, ACCEPTED).otherwise(QUARANTINED)
        folder = change.folder_of(TRIPS)
        whole = graded.withColumn("verdict", verdict)
        whole.write.partitionBy("verdict").parquet(f"{lake.root}/{folder}")
        change.adopt(TRIPS, folder, whole.schema, "silver", "Trips by verdict, with the rules that they break")
        counts = seen.get
        rows = [(number, rule.reason, rule.expectation, counts[rule.reason], counts["total_rows"], counts["accepted_rows"]) for rule in rules]
        ledger = "batch long, reason string, expectation string, failed_records long, total_rows long, accepted_rows long"
        change.append(LEDGER, batch.sparkSession.createDataFrame(rows, ledger).coalesce(1), "silver", "Rows that broke each rule, by micro-batch")
        # Counts of old batches are told apart by their number still, in fewer folders.
        change.combine(LEDGER, lambda parts: parts.coalesce(1))
        change.brings(stream, number)
        change.publish()

    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    source = reader.option("recursiveFileLookup", "true").parquet(bronze)
    query = source.writeStream.foreachBatch(grade).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finish(query, seconds=seconds)
    return query


def read_accepted(lake: Lake) -> DataFrame:
    return lake.read(TRIPS).where(F.col("verdict") == ACCEPTED).select(*enrich.ACCEPTED_COLUMNS)


def read_quarantined(lake: Lake) -> DataFrame:
    return lake.read(TRIPS).where(F.col("verdict") == QUARANTINED).drop("verdict")


def read_expectations(lake: Lake) -> DataFrame:
    """What ``quality.expectation_report`` says of all rows that the stream has brought, from the ledger."""
    failed, records = F.col("failed_records"), F.col("records")
    summed = lake.read(LEDGER).groupBy("expectation").agg(F.sum("failed_records").alias("failed_records"), F.sum("total_rows").alias("records"))
    return summed.select(
        "expectation", (records - failed).alias("passed_records"), "failed_records",
        F.try_divide(failed.cast("double"), records).alias("failure_ratio"),
    )


def keep_mart_current(
    stream: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    lake: Lake,
    name: str,
    dims: Sequence[str],
    checkpoint: str,
    seconds: float | None = None,
    fan: int = FAN,
) -> StreamingQuery:
    """Store each micro-batch's share of an additive mart; shares of a generation are summed up into one of the next.

    The number of folders grows with the logarithm of the number of batches. A batch that
    is run again after it was published is left out. Readers sum the shares up (``read_mart``).
    Right for marts without a global choice of rows; ``plans.upkeep`` has the others. How
    large a micro-batch is, the stream's reader says.
    """

    def add(batch: DataFrame, number: int) -> None:
        change = lake.change()
        if change.last_batch(name) >= number:
            return
        change.append(name, resum(build(batch), dims))
        change.combine(name, lambda parts: resum(parts, dims), fan)
        change.brings(name, number)
        change.publish()

    query = (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    finish(query, seconds=seconds)
    return query


def read_mart(lake: Lake, name: str, dims: Sequence[str]) -> DataFrame:
    return resum(lake.read(name), dims)
