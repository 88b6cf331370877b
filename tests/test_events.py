import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from curbline.functions import events as ev
from curbline.functions import text
from curbline.operators.flow_timings import STATE_DDL, fold, running_clocks, with_flow_timings
from curbline.plans import alerts
from curbline.sources import derived

LOG = "id string, event_type string, timestamp string, message string, origin string, details string"
SETTINGS = alerts.AlertSettings(
    environment="integration",
    workspace_url="workspace.example",
    emit_flow_metrics=True,
    expected_writers=("trips_raw", "yellow_trips_2025", "taxi_zones", "mart_od"),
    streaming_flows=("trips_raw", "yellow_trips_2025"),
)


def event(flow, metrics=None, status="COMPLETED", at="2026-08-14T22:20:14.431Z", id="event-123", **progress):
    progress["status"] = status
    if metrics is not None:
        progress["metrics"] = metrics
    origin = {
        "pipeline_id": "pipeline-123",
        "pipeline_name": "Trip refresh",
        "update_id": "update-123",
        "flow_name": f"catalog.schema.{flow}",
    }
    message = f"Flow '{flow}' is {status}."
    return (id, "flow_progress", at, message, json.dumps(origin), json.dumps({"flow_progress": progress}))


def bodies(spark, *log):
    events = alerts.normalized_events(spark.createDataFrame(list(log), LOG))
    found = alerts.alerts(events, SETTINGS)
    return alerts.message_body(alerts.with_message_texts(found, SETTINGS)).collect()


def test_summary_uses_short_flow_and_metrics(spark):
    (alert,) = bodies(spark, event("mart_od", {"num_output_rows": 388_844}))
    assert (alert.layer, alert.flow_key) == ("Gold", "mart_od")
    assert alert.diagnostic_url == (
        "https://workspace.example/pipelines/pipeline-123/updates/update-123"
    )
    body = json.loads(alert.body)
    assert body["text"] == "✅ [integration] Gold / mart_od: COMPLETED — 388,844 output rows"
    assert [b["type"] for b in body["blocks"]] == ["header", "section", "section", "context", "actions"]
    assert body["blocks"][4]["elements"][0]["url"] == alert.diagnostic_url
    assert "bounded refresh" in alert.body and "schema_version" not in alert.body


def test_monitored_flow_without_metrics(spark):
    (alert,) = bodies(spark, event("taxi_zones"))
    assert "Not reported" in alert.body


def test_runtime_and_derived_rate(spark):
    (alert,) = bodies(
        spark,
        event("mart_od", status="STARTING", at="2026-08-14T22:20:00.000Z", id="a"),
        event("mart_od", {"num_output_rows": 388_844}, at="2026-08-14T22:20:10.000Z", id="b"),
    )
    assert alert.observed_duration_seconds == 10.0
    assert alert.avg_output_rows_per_second == 38_884.4
    assert "38,884.40 rows/s` average output (derived)" in alert.throughput_text
    assert "Observed runtime: `10.0 s`" in alert.throughput_text


def test_finished_stream_is_drained(spark):
    (alert,) = bodies(spark, event("yellow_trips_2025", {"num_output_rows": 1000}))
    assert "Drained" in alert.body and "native pending count not emitted" in alert.body


def test_zero_output_is_a_warning(spark):
    (alert,) = bodies(spark, event("yellow_trips_2025", {"num_output_rows": 0}))
    assert (alert.severity, alert.condition) == ("warning", "unexpected_zero_output")


def test_unmonitored_flow_is_silent(spark):
    assert bodies(spark, event("internal_helper")) == []


def test_severity_precedence(spark):
    broken = {"data_quality": {"expectations": [
        {"name": "r", "dataset": "d", "passed_records": 900, "failed_records": 100}]}}
    found = bodies(
        spark,
        event("helper", status="FAILED", id="failed", **broken),
        event("helper", status="SKIPPED", id="skipped", **broken),
        event("yellow_trips_2025", {"num_output_rows": 0}, id="zero", **broken),
    )
    conditions = {a.event_id: (a.severity, a.condition, a.reasons) for a in found}
    exceeded = "1 expectation(s) exceeded 1.00%"
    assert conditions == {
        "failed": ("critical", "flow_progress_failed", ["state=FAILED"]),
        "skipped": ("warning", "expectation_failure_ratio", ["state=SKIPPED", exceeded]),
        "zero": ("warning", "expectation_failure_ratio", [exceeded]),
    }


def test_first_five_failing_rules_are_named(spark):
    items = [{"name": f"r<{i}>", "dataset": "d", "passed_records": 1, "failed_records": i} for i in range(8)]
    (alert,) = bodies(spark, event("taxi_zones", data_quality={"expectations": items}))
    assert alert.quality_text == (
        "Passed: `8` • Failed: `28`\nFailing rules: `r&lt;1&gt;, r&lt;2&gt;, r&lt;3&gt;, r&lt;4&gt;, r&lt;5&gt;`"
    )


def test_values_at_any_depth_in_document_order(spark):
    details = {
        "flow_progress": {
            "note": 'say "num_output_rows": 7',
            "plan": {"num_output_rows": None, "steps": [{"num_output_rows": 3}]},
            "metrics": {"num_output_rows": 5, "backlog_bytes": 1.5e3, "num_input_rows": "9"},
        }
    }
    plain = ("1", "flow_progress", "", "", "{}", json.dumps(details))
    twice = ("2", "flow_progress", "", "", "{}", json.dumps(json.dumps(details)))
    cut = ("3", "flow_progress", "", "", "{}", json.dumps(details)[:-9])
    inner = ("4", "flow_progress", "", "", "{}", json.dumps({"flow_progress": json.dumps({"state": "queued"})}))
    listed = ("5", "flow_progress", "", "", "{}", json.dumps([details]))
    rows = {
        r.event_id: (r.num_output_rows, r.backlog_bytes, r.num_input_rows, r.state)
        for r in alerts.normalized_events(
            spark.createDataFrame([plain, twice, cut, inner, listed], LOG)
        ).collect()
    }
    assert rows["1"] == rows["2"] == (3.0, 1500.0, None, "")
    assert rows["3"] == rows["5"] == (None, None, None, "")
    assert rows["4"] == (None, None, None, "QUEUED")


def test_expectation_entries_without_numbers_are_skipped(spark):
    items = [
        {"name": "ok", "dataset": "d", "passed_records": 0, "failed_records": 0},
        {"name": "text", "passed_records": "n/a", "failed_records": 1},
        {"name": "half", "passed_records": 3},
        json.dumps({"name": "encoded", "passed_records": 3, "failed_records": 1}),
        17,
    ]
    log = spark.createDataFrame([event("x", data_quality={"expectations": items})], LOG)
    rows = alerts.expectation_rows(alerts.normalized_events(log)).collect()
    assert [(r.name, r.failure_ratio) for r in rows] == [("ok", None), ("encoded", 0.25)]


@pytest.mark.parametrize(
    "written, micros",
    [
        ("2026-08-14T22:20:10.5Z", 1786746010500000),
        ("2026-08-14T22:20:10.5", 1786746010500000),
        ("2026-08-15T00:20:10.5+02:00", 1786746010500000),
        ("2026-08-14", 1786665600000000),
        ("", None),
        ("soon", None),
    ],
)
def test_event_instant(spark, written, micros):
    frame = spark.createDataFrame([(written,)], "t string")
    assert frame.select(F.unix_micros(ev.event_instant(F.col("t")))).collect()[0][0] == micros


@pytest.mark.parametrize("value", [0.0, 5.0, 1234567.0, 0.125, 38884.4, 1023.99, -0.5, 1e12])
def test_numbers_and_bytes_read_like_python_formats(spark, value):
    frame = spark.createDataFrame([(value,)], "v double")
    number, size = frame.select(text.number_text(F.col("v")), text.bytes_text(F.col("v"))).collect()[0]
    assert number == (f"{int(value):,}" if value.is_integer() else f"{value:,.2f}")
    power = next(i for i in range(5) if abs(value) / 1024**i < 1024 or i == 4)
    assert size == f"{value / 1024**power:,.1f} {text.BYTE_UNITS[power]}"


@pytest.mark.parametrize("value, shown", [(5.04, "5.0 s"), (60.0, "1m 0.0s"), (3725.5, "62m 5.5s")])
def test_duration_text(spark, value, shown):
    frame = spark.createDataFrame([(value,)], "v double")
    assert frame.select(text.duration_text(F.col("v"))).collect()[0][0] == shown


# --- flow clocks against a plain fold over each flow's events ----------------------------

EVENTS = "pipeline_id string, update_id string, flow_name string, state string, event_time timestamp, event_id string"


def random_events(count, seed):
    """One flow owns a third of all events; quiet gaps leave many buckets empty."""
    rng = random.Random(seed)
    at = datetime(2026, 1, 1, tzinfo=timezone.utc)
    states = ["QUEUED", "STARTING", "RUNNING", "COMPLETED", "FAILED", "SKIPPED", "WAITING", ""]
    rows = []
    for i in range(count):
        at += timedelta(seconds=rng.choice([1, 30, 900, 20000]), microseconds=rng.randrange(10**6))
        flow = "hot" if rng.random() < 0.34 else f"f{rng.randrange(6)}"
        rows.append((
            rng.choice(["p", "p", "p", ""]), "u", flow, rng.choice(states),
            at if rng.random() < 0.95 else None, f"{i:06d}",
        ))
    return rows


def folded(rows):
    clocks, result = {}, {}
    for pipeline, update, flow, state, at, event_id in rows:
        if not (pipeline and update and flow) or at is None:
            continue
        clock = clocks.setdefault((pipeline, update, flow), {})
        if state == "QUEUED":
            clock.setdefault("queued", at)
        elif state in ("STARTING", "RUNNING"):
            clock.setdefault("started", at)
        elif state in ev.TERMINAL_STATES:
            clocks.pop((pipeline, update, flow))
            queued = clock.get("queued")
            started = clock.get("started") or queued
            result[event_id] = (
                max((at - started).total_seconds(), 0.001) if started else None,
                max((started - queued).total_seconds(), 0.0) if queued else None,
            )
    return result, clocks


@pytest.mark.parametrize("ranges", [1, 7, 60, None])
def test_timings_equal_a_plain_fold(spark, ranges):
    rows = random_events(600, ranges or 0)
    expected, _ = folded(rows)
    timed = with_flow_timings(spark.createDataFrame(rows, EVENTS), ranges=ranges)
    got = timed.collect()
    assert len(got) == len(rows)
    for row in got:
        assert (row.observed_duration_seconds, row.observed_queue_seconds) == pytest.approx(
            expected.get(row.event_id, (None, None))
        ), row


def test_clocks_carry_over(spark):
    rows = random_events(400, 7)
    expected, open_clocks = folded(rows)
    carried, got = spark.createDataFrame([], STATE_DDL), {}
    for part in (rows[:150], rows[150:151], rows[151:300], rows[300:]):
        frame = spark.createDataFrame(part, EVENTS)
        for row in with_flow_timings(frame, carried).collect():
            if row.event_id in expected:
                got[row.event_id] = (row.observed_duration_seconds, row.observed_queue_seconds)
        after = running_clocks(frame, carried).collect()
        carried = spark.createDataFrame(after, STATE_DDL)
    assert {k: pytest.approx(v) for k, v in expected.items()} == got
    still_open = {(c.pipeline_id, c.update_id, c.flow_name) for c in carried.collect()}
    assert still_open == {key for key, clock in open_clocks.items() if clock}


def test_small_arrow_batches_give_the_same_runs(spark):
    rows = random_events(500, 11)
    expected, _ = folded(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = with_flow_timings(spark.createDataFrame(rows, EVENTS), ranges=4).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for row in got:
        assert (row.observed_duration_seconds, row.observed_queue_seconds) == pytest.approx(expected.get(row.event_id, (None, None)))


def test_one_hot_hour_of_one_flow_is_spread(spark):
    """All events of one flow lie in one hour; no range has more than twice the median of the rows."""
    at = datetime(2026, 1, 1, tzinfo=timezone.utc)
    states = ["QUEUED", "RUNNING", "RUNNING", "COMPLETED", "RUNNING", "FAILED", "QUEUED"]
    rows = [("p", "u", "hot", states[i % 7], at + timedelta(milliseconds=i * 150), f"{i:06d}") for i in range(20_000)]
    rows += [("p", "u", f"f{i % 50}", "RUNNING", at + timedelta(seconds=i), f"x{i}") for i in range(500)]
    frame = spark.createDataFrame(rows, EVENTS)
    sizes = sorted(r["count"] for r in fold(frame, ranges=8).ranges.groupBy("__range").count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
    expected, _ = folded(rows)
    got = {r.event_id: r.observed_duration_seconds for r in with_flow_timings(frame, ranges=8).collect() if r.observed_duration_seconds}
    assert got == pytest.approx({k: d for k, (d, _) in expected.items() if d})


# --- documents read as variants equal those read as text ---------------------------------


def odd_documents(seed, count):
    rng = random.Random(seed)
    words = ["a", "", " b  c", "{x", "[", "\\", '"', "é", "null", "5", "-1.5", None, True, False, 5, -0.5, 1e3, 12345678901234567890]
    value = lambda: rng.choice(words) if rng.random() < 0.15 else rng.choice(["a", "", "Running", " b  c", None])

    def entry():
        own = {k: value() for k in ("name", "dataset", "passed_records", "failed_records") if rng.random() < 0.9}
        if rng.random() < 0.5:
            own |= {"passed_records": rng.randrange(9), "failed_records": rng.random()}
        return rng.choice([own, own, own, json.dumps(own), value(), [own]])

    def progress():
        own = {k: value() for k in ("name", "state", "status", "other") if rng.random() < 0.7}
        own["data_quality"] = rng.choice([{"expectations": [entry() for _ in range(rng.randrange(4))]}, value(), {"expectations": value()}])
        if rng.random() < 0.2:
            own["data_quality"] = json.dumps(own["data_quality"])
        return rng.choice([own, own, own, json.dumps(own), value()])

    def twice(text):
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2, 3])):
            text = json.dumps(text)
        return text if rng.random() < 0.95 else text[: rng.randrange(len(text) + 1)]

    rows = []
    for number in range(count):
        origin = {k: value() for k in alerts.ORIGIN_FIELDS if rng.random() < 0.7}
        details = {"flow_progress": progress(), "update_progress": progress(), "x": {"num_output_rows": value()}}
        own, other = json.dumps(origin), json.dumps(details, ensure_ascii=rng.random() < 0.5)
        if rng.random() < 0.2:
            other = other[:-1] + ',"x":{"num_output_rows":3},"update_progress":{"state":"again"}}'
        rows.append((str(number), rng.choice(alerts.EVENT_TYPES), "2026-01-01", "m", twice(own), twice(other)))
    return rows + [("n", "flow_progress", None, None, None, None), ("e", "flow_progress", "", "", "", " ")]


def test_variants_read_what_text_reads(spark, monkeypatch):
    log = spark.createDataFrame(odd_documents(1, 600), LOG)
    by_variant = alerts.normalized_events(log).collect()
    plain = alerts.parsed_documents(log).agg(F.count_if("__plain"), F.count_if("__plain_origin"), F.count("*")).first()
    assert 50 < plain[0] < plain[2] and 50 < plain[1] < plain[2]
    monkeypatch.setattr(ev, "is_plain", lambda text, parsed: F.lit(False))
    by_text = alerts.normalized_events(log).collect()
    for one, other in zip(sorted(by_variant, key=lambda r: r.event_id), sorted(by_text, key=lambda r: r.event_id)):
        assert one == other


def test_repeated_keys_are_read_as_text(spark):
    details = '{"flow_progress":{"state":"QUEUED","note":1,"note":2,"metrics":{"num_output_rows":4}}}'
    log = spark.createDataFrame([("1", "flow_progress", "", "", '{"flow_name":"a.f","flow_name":"a.g"}', details)], LOG)
    (row,) = alerts.normalized_events(log).collect()
    assert (row.state, row.num_output_rows) == ("QUEUED", 4.0) and row.flow_name in ("a.f", "a.g")


def test_documents_with_numbers_for_text_are_read_in_one_go(spark):
    entry = {"name": 7, "passed_records": "NaN", "failed_records": 1}
    details = {"flow_progress": {"state": 5, "data_quality": {"expectations": [entry, {**entry, "passed_records": 3}]}}}
    texts = [json.dumps(details), json.dumps(json.dumps(details)), json.dumps({"flow_progress": json.dumps(details["flow_progress"])})]
    log = spark.createDataFrame([(str(n), "flow_progress", "", "", '{"flow_name":8}', t) for n, t in enumerate(texts)], LOG)
    assert [r["__plain"] for r in alerts.parsed_documents(log).orderBy("id").collect()] == [True, True, False]
    for row in alerts.normalized_events(log).collect():
        assert (row.flow_name, row.state) == ("8", "5")
        assert [(e.name, e.failure_ratio) for e in row.expectations] == [("7", 0.25)]


def test_the_log_is_ordered_before_its_text_is_made(spark, sf_dir):
    seen = []

    def arranged(rows):
        seen.extend(rows.columns)
        return rows.repartitionByRange(3, *derived.LOG_ORDER)

    ordered = derived.event_log(spark, sf_dir, arranged)
    assert not {"origin", "details", "message", "timestamp"} & set(seen)
    plain = derived.event_log(spark, sf_dir)
    assert ordered.exceptAll(plain).isEmpty() and plain.exceptAll(ordered).isEmpty()
