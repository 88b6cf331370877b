import pytest
from pyspark.sql import functions as F

from curbline.operators import enrich, quality
from curbline.plans import alerts, marts, tables
from curbline.plans.alerts import AlertSettings
from curbline.session import new_work_dir
from curbline.sources import derived
from curbline.sources import trips as trip_files
from curbline.sources.lake import Lake
from curbline.streaming import flow_clock, ingest, refine

RULES = quality.trip_rules(2025)


@pytest.fixture
def base(spark):
    return new_work_dir(spark, "stream-test")


@pytest.fixture
def raw(spark, sf_dir):
    return tables.raw_trips(spark, sf_dir)


def test_ingestion_resumes_and_reads_each_file_once(spark, raw, base):
    early = F.month("tpep_pickup_datetime") <= 5
    for part in (early, ~early):
        raw.where(part).write.mode("append").parquet(f"{base}/landing")
        ingest.ingest_trips(spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp")
    ingest.ingest_trips(spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp")
    bronze = spark.read.parquet(f"{base}/bronze")
    assert bronze.select(*raw.columns).exceptAll(raw).count() == 0
    assert bronze.count() == raw.count()
    assert bronze.where("_source_file IS NULL OR _ingested_at IS NULL").count() == 0


@pytest.mark.parametrize("files, files_per_batch", [(1, 1000), (12, 1)])
def test_split_equals_batch_and_counts_rules(spark, raw, base, files, files_per_batch):
    """Also over many micro-batches, whose counts come from the ledger."""
    raw.repartition(files).write.parquet(f"{base}/bronze")
    lake = Lake(spark, f"{base}/lake")
    refine.split_stream(spark, f"{base}/bronze", trip_files.TRIP_SCHEMA, lake, f"{base}/cp", RULES, files_per_batch)
    accepted, quarantined = refine.read_accepted(lake), refine.read_quarantined(lake)
    assert accepted.exceptAll(enrich.accepted_trips(raw, RULES)).count() == 0
    expected = enrich.quarantined_trips(raw, RULES)
    assert quarantined.select(*expected.columns).exceptAll(expected).count() == 0
    assert accepted.count() + quarantined.count() == raw.count()
    assert lake.read(refine.LEDGER).select("batch").distinct().count() == -(-files // files_per_batch)
    assert refine.read_expectations(lake).exceptAll(quality.expectation_report(raw, RULES)).isEmpty()


def test_the_source_of_a_split_is_read_once(spark, raw, base):
    raw.coalesce(1).write.parquet(f"{base}/bronze")
    lake = Lake(spark, f"{base}/lake")
    query = refine.split_stream(spark, f"{base}/bronze", trip_files.TRIP_SCHEMA, lake, f"{base}/cp", RULES)
    assert sum(p["numInputRows"] for p in query.recentProgress) == raw.count()


def test_tables_and_ledger_agree_over_a_failure_and_a_restart(spark, raw, base, monkeypatch):
    """The change fails after the rows are written and before it is published; the next run brings them once."""
    lake = Lake(spark, f"{base}/lake")

    def run():
        refine.split_stream(spark, f"{base}/bronze", trip_files.TRIP_SCHEMA, lake, f"{base}/cp", RULES)

    raw.where("passenger_count < 3").write.parquet(f"{base}/bronze/one")
    run()
    before = (refine.read_accepted(lake).count(), refine.read_expectations(lake).collect())
    raw.where("passenger_count >= 3").write.parquet(f"{base}/bronze/two")

    def fail(change):
        raise ValueError("broken on purpose")

    monkeypatch.setattr("curbline.sources.lake.Change.publish", fail)
    with pytest.raises(Exception, match="broken on purpose"):
        run()
    assert (refine.read_accepted(lake).count(), refine.read_expectations(lake).collect()) == before
    monkeypatch.undo()
    run()
    run()
    assert refine.read_expectations(lake).exceptAll(quality.expectation_report(raw, RULES)).isEmpty()
    assert refine.read_accepted(lake).count() == enrich.accepted_trips(raw, RULES).count()


def test_a_batch_run_again_is_left_out(spark, sf_dir, raw, base):
    zones = derived.zones(spark)
    raw.write.parquet(f"{base}/raw")
    lake = Lake(spark, f"{base}/lake")

    def build(batch):
        return marts.fare_composition(enrich.accepted_trips(batch, RULES), zones)

    for run in ("first", "again"):  # a new checkpoint numbers its batches from 0 again
        stream = spark.readStream.schema(trip_files.TRIP_SCHEMA).parquet(f"{base}/raw")
        refine.keep_mart_current(stream, build, lake, "fares", marts.FARE_DIMS, f"{base}/cp-{run}")
    current = refine.read_mart(lake, "fares", marts.FARE_DIMS)
    assert current.exceptAll(build(raw)).count() == 0
    assert current.count() == build(raw).count()


def test_evolving_files_in_later_runs(spark, raw, base):
    def run():
        ingest.ingest_evolving(
            spark, f"{base}/landing", f"{base}/bronze", f"{base}/schemas", f"{base}/cp"
        )
        return ingest.read_evolved(spark, f"{base}/bronze", f"{base}/schemas")

    raw.limit(50).write.parquet(f"{base}/landing/one")
    assert "surge" not in run().columns
    raw.limit(20).withColumn("surge", F.lit(1.5)).write.parquet(f"{base}/landing/two")
    raw.limit(10).withColumn("total_amount", F.lit("a lot")).write.parquet(f"{base}/landing/three")
    table = run()
    assert table.count() == 80
    assert table.where("surge = 1.5").count() == 20
    rescued = table.where("_rescued_data IS NOT NULL")
    assert {r._rescued_data for r in rescued.collect()} == {'{"total_amount":"a lot"}'}
    assert rescued.count() == 10 and rescued.where("total_amount IS NOT NULL").count() == 0


def test_clocks_survive_between_runs(spark, base):
    def flow(id, state, at):
        origin = '{"pipeline_id":"p","update_id":"u","flow_name":"a.b.f"}'
        details = f'{{"flow_progress":{{"state":"{state}"}}}}'
        return (id, "flow_progress", at, "", origin, details)

    runs = [
        [flow("1", "QUEUED", "2026-01-01T00:00:00Z")],
        [flow("2", "RUNNING", "2026-01-01T00:00:30Z")],
        [flow("3", "COMPLETED", "2026-01-01T00:02:00Z"), flow("4", "FAILED", "2026-01-01T00:03:00Z")],
    ]
    for rows in runs:
        spark.createDataFrame(rows, flow_clock.LOG_DDL).coalesce(1).write.mode("append").parquet(f"{base}/log")
        flow_clock.watch_events(
            spark, f"{base}/log", f"{base}/out", f"{base}/cp", AlertSettings(environment="test")
        )
    timed = {
        r.event_id: (r.observed_duration_seconds, r.observed_queue_seconds)
        for r in flow_clock.read_timings(spark, f"{base}/out").collect()
    }
    assert timed == {"3": (90.0, 30.0), "4": (None, None)}
    found = flow_clock.read_alerts(spark, f"{base}/out").collect()
    assert [(a.event_id, a.severity) for a in found] == [("4", "critical")]


def test_an_event_delivered_twice_raises_one_alert(spark, base):
    event = ("7", "flow_progress", "2026-01-01T00:00:00Z", "", '{"flow_name":"f"}',
             '{"flow_progress":{"state":"FAILED"}}')
    for _ in range(2):
        spark.createDataFrame([event, event], flow_clock.LOG_DDL).write.mode("append").parquet(f"{base}/log")
        flow_clock.watch_events(spark, f"{base}/log", f"{base}/out", f"{base}/cp", AlertSettings())
    assert [a.idempotency_key for a in flow_clock.read_alerts(spark, f"{base}/out").collect()] == ["7:slack"]


def failed(id, at="2026-01-01T00:00:00Z", flow="f"):
    return (id, "flow_progress", at, "", f'{{"flow_name":"{flow}"}}', '{"flow_progress":{"state":"FAILED"}}')


def test_distinct_events_keep_their_alerts(spark, base):
    """Blank ids and ids that share their first letters are different events."""
    long = "x" * 150
    rows = [failed(i, flow=f"f{n}") for n, i in enumerate([None, "", "  ", f"{long}1", f"{long}2", f"{long}3"])]
    spark.createDataFrame(rows + rows, flow_clock.LOG_DDL).coalesce(1).write.parquet(f"{base}/log")
    flow_clock.watch_events(spark, f"{base}/log", f"{base}/out", f"{base}/cp", AlertSettings())
    assert flow_clock.read_alerts(spark, f"{base}/out").count() == 6
    events = alerts.normalized_events(spark.read.parquet(f"{base}/log"))
    assert alerts.alerts(events, AlertSettings()).count() == 6


def test_the_first_delivery_keeps_its_duration(spark, base):
    def state(id, name, at):
        origin = '{"pipeline_id":"p","update_id":"u","flow_name":"a.b.f"}'
        return (id, "flow_progress", at, "", origin, f'{{"flow_progress":{{"state":"{name}"}}}}')

    begun, ended = state("1", "RUNNING", "2026-01-01T00:00:00Z"), state("2", "FAILED", "2026-01-01T00:01:00Z")
    for rows in ([begun], [ended], [ended]):
        spark.createDataFrame(rows, flow_clock.LOG_DDL).coalesce(1).write.mode("append").parquet(f"{base}/log")
        flow_clock.watch_events(spark, f"{base}/log", f"{base}/out", f"{base}/cp", AlertSettings())
    found = flow_clock.read_alerts(spark, f"{base}/out").collect()
    assert [(a.event_id, a.observed_duration_seconds) for a in found] == [("2", 60.0)]


def test_a_failing_stream_stops_the_other(spark, raw, base):
    raw.limit(10).write.parquet(f"{base}/in")
    source = spark.readStream.schema(trip_files.TRIP_SCHEMA).parquet(f"{base}/in")

    def fail(batch, number):
        raise ValueError("broken on purpose")

    steady = source.writeStream.format("noop").option("checkpointLocation", f"{base}/a").start()
    broken = source.writeStream.foreachBatch(fail).option("checkpointLocation", f"{base}/b").trigger(availableNow=True).start()
    with pytest.raises(Exception, match="broken on purpose"):
        ingest.finish(broken, steady)
    assert not steady.isActive and not broken.isActive


def test_a_time_limit_is_the_callers(spark, raw, base):
    raw.limit(10).write.parquet(f"{base}/in")
    query = spark.readStream.schema(trip_files.TRIP_SCHEMA).parquet(f"{base}/in").writeStream.format("noop").option(
        "checkpointLocation", f"{base}/a"
    ).start()
    with pytest.raises(TimeoutError):
        ingest.finish(query, seconds=1)
    assert not query.isActive


def test_evolving_files_that_differ_in_case_or_shape(spark, raw, base):
    one = raw.limit(20).withColumnRenamed("Airport_fee", "airport_FEE") if "Airport_fee" in raw.columns else raw.limit(20).withColumnRenamed("total_amount", "TOTAL_amount")
    nested = raw.limit(5).withColumn("passenger_count", F.struct(F.lit(1).alias("n")))
    one.write.parquet(f"{base}/landing/one")
    nested.write.parquet(f"{base}/landing/two")
    ingest.ingest_evolving(spark, f"{base}/landing", f"{base}/bronze", f"{base}/schemas", f"{base}/cp")
    table = ingest.read_evolved(spark, f"{base}/bronze", f"{base}/schemas")
    assert table.count() == 25 and set(raw.columns) <= set(table.columns)
    assert len({c.lower() for c in table.columns}) == len(table.columns)
    rescued = table.where("_rescued_data IS NOT NULL").collect()
    assert len(rescued) == 5 and all("passenger_count" in r._rescued_data for r in rescued)
    before = spark.read.json(f"{base}/schemas").count()
    raw.limit(3).write.parquet(f"{base}/landing/three")
    ingest.ingest_evolving(spark, f"{base}/landing", f"{base}/bronze", f"{base}/schemas", f"{base}/cp")
    assert spark.read.json(f"{base}/schemas").count() == before == 1


def flow_event(id, state, at, flow="f"):
    origin = f'{{"pipeline_id":"p","update_id":"u","flow_name":"a.b.{flow}"}}'
    return (id, "flow_progress", at, "", origin, f'{{"flow_progress":{{"state":"{state}"}}}}')


def land(spark, base, *rows):
    spark.createDataFrame(list(rows), flow_clock.LOG_DDL).coalesce(1).write.mode("append").parquet(f"{base}/log")


def watch(spark, base, **more):
    flow_clock.watch_events(spark, f"{base}/log", f"{base}/out", f"{base}/cp", AlertSettings(), **more)
    return {r.event_id: (r.observed_duration_seconds, r.observed_queue_seconds) for r in flow_clock.read_timings(spark, f"{base}/out").collect()}


def test_a_failed_run_is_taken_up_again(spark, base, monkeypatch):
    """The second stream fails after the state was read; the next run publishes the same."""
    land(spark, base, flow_event("1", "QUEUED", "2026-01-01T00:00:00Z"))
    watch(spark, base)
    land(spark, base, flow_event("2", "RUNNING", "2026-01-01T00:00:30Z"))
    whole = flow_clock.publish

    def fail(*args):
        raise ValueError("broken on purpose")

    monkeypatch.setattr(flow_clock, "publish", fail)
    with pytest.raises(Exception, match="broken on purpose"):
        watch(spark, base)
    monkeypatch.setattr(flow_clock, "publish", whole)
    land(spark, base, flow_event("3", "COMPLETED", "2026-01-01T00:02:00Z"))
    assert watch(spark, base) == {"3": (90.0, 30.0)}
    assert watch(spark, base) == {"3": (90.0, 30.0)}
    assert spark.read.parquet(f"{base}/out/timed").count() == 3


def test_clocks_without_news_are_dropped(spark, base):
    """A clock of a flow that never ends goes after the stated time, others stay."""
    from datetime import timedelta

    keep = timedelta(days=2)
    land(spark, base, flow_event("1", "RUNNING", "2026-01-01T00:00:00Z", "lost"), flow_event("2", "RUNNING", "2026-01-08T00:00:00Z", "kept"))
    watch(spark, base, keep=keep)
    land(spark, base, flow_event("3", "RUNNING", "2026-01-09T00:00:00Z", "other"))
    watch(spark, base, keep=keep)
    land(spark, base, flow_event("4", "FAILED", "2026-01-09T00:01:00Z", "lost"), flow_event("5", "FAILED", "2026-01-09T00:01:00Z", "kept"))
    assert watch(spark, base, keep=keep) == {"4": (None, None), "5": (86460.0, None)}


def test_batches_without_clock_events_are_published(spark, base):
    land(spark, base, failed("1", flow="no update"))
    assert watch(spark, base) == {"1": (None, None)}
    assert flow_clock.read_alerts(spark, f"{base}/out").count() == 1
