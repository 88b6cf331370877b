"""Pipeline event log to graded alerts and their message bodies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.functions import events as ev
from curbline.functions import text
from curbline.functions.trip import labelled
from curbline.operators.flow_timings import FLOW_KEY, with_flow_timings, with_output_rate

EVENT_TYPES = ("update_progress", "flow_progress")
OBSERVED = ("observed_duration_seconds", "observed_queue_seconds", "avg_output_rows_per_second")

# Marks of the three severities.
SEVERITY_MARKS = {"critical": "🚨", "warning": "⚠️", "info": "✅"}


@dataclass(frozen=True)
class AlertSettings:
    environment: str = "unknown"
    destination: str = "slack"
    workspace_url: str = ""
    emit_flow_metrics: bool = False
    failure_ratio: float = 0.01
    minimum_records: int = 1000
    expected_writers: tuple[str, ...] = ()
    streaming_flows: tuple[str, ...] = ()

    @property
    def base_url(self) -> str:
        url = self.workspace_url.strip()
        if url and not url.startswith(("http://", "https://")):
            url = f"https://{url}"
        return url.rstrip("/")


# Members read at each level. Text members come decoded when they were strings and as JSON
# when they were objects, so a level that was encoded a second time reads like any other.
ORIGIN = "pipeline_id string, pipeline_name string, update_id string, flow_name string, dataset_name string"
DETAILS = "flow_progress string, update_progress string"
PROGRESS = "name string, state string, status string, data_quality string"
QUALITY = "expectations array<string>"
ENTRY = "name string, dataset string, passed_records double, failed_records double"
# The same levels at once, for a document in which none was encoded a second time.
WHOLE = (
    "flow_progress struct<name: string, state: string, status: string, data_quality: struct<expectations: array<string>>>,"
    " update_progress struct<name: string, state: string, status: string>"
)


#: The flow's name in the details; the origin's is ``__flow_name``.
NAME_IN_DETAILS = "__named_in_details"
ORIGIN_FIELDS = ("pipeline_id", "pipeline_name", "update_id", "flow_name", "dataset_name")


def parsed_documents(log: DataFrame) -> DataFrame:
    """The two documents of an event, each parsed once, as columns of the fields that are read.

    A document that is a plain object is read level below level in one go. A document with a repeated key, or with a member that
    was encoded a second time, is read as text, level by level; those rows alone are parsed that way. Both go by
    the same rules, so a document gives the same fields either way. Metrics are the first in the order of
    the document, so they are found in its text.
    """
    plain, both = F.col("__plain"), F.col("__plain_origin")
    decoded = log.withColumns(
        {"__o_text": ev.decoded_text(F.col("origin")), "__d_text": ev.decoded_text(ev.decoded_text(F.col("details")))}
    )
    parsed = decoded.withColumns(
        {
            "__plain_origin": ev.is_plain(F.col("__o_text"), F.try_parse_json("__o_text")),
            "__plain": ev.is_plain(F.col("__d_text"), F.try_parse_json("__d_text")),
        }
    )
    # The reading of text sees the other rows only. Inputs are named as seldom as can be: over a plain view, Catalyst
    # multiplies them when it pushes filters through.
    read = parsed.withColumns(
        {
            "__origin": F.from_json(F.when(both, F.col("__o_text")).otherwise(ev.value_text(F.col("origin"))), ORIGIN),
            "__whole": F.from_json("__d_text", WHOLE),
            "__object": ev.object_text(F.when(~plain, F.col("details"))),
        }
    ).withColumns(
        {"__details": F.from_json("__object", DETAILS), "__text": F.when(plain, F.col("__d_text")).otherwise(F.col("__object"))}
    )
    levels = read.withColumns(
        {
            "__flow": F.from_json("__details.flow_progress", PROGRESS),
            "__update": F.from_json("__details.update_progress", PROGRESS),
            "__metric_keys": ev.metric_matches(F.col("__text"), 1),
            "__metric_values": ev.metric_matches(F.col("__text"), 2),
        }
    )
    fields = {f"__{name}": F.col(f"__origin.{name}") for name in ORIGIN_FIELDS}
    for part in ("flow", "update"):
        for name in ("name", "state", "status"):
            found = F.when(plain, F.col(f"__whole.{part}_progress.{name}")).otherwise(F.col(f"__{part}.{name}"))
            fields[NAME_IN_DETAILS if (part, name) == ("flow", "name") else f"__{part}_{name}"] = found
    quality = F.from_json("__flow.data_quality", QUALITY)["expectations"]
    fields["__entries"] = F.when(plain, F.col("__whole.flow_progress.data_quality.expectations")).otherwise(quality)
    return levels.withColumns(fields)


def normalized_events(log: DataFrame) -> DataFrame:
    """Parsed and cleaned columns of the two event types that matter, one row per event.

    Each document is parsed once, see ``parsed_documents``.
    """
    listed = log.withColumn("event_type", text.squeezed(F.col("event_type"), 80)).where(F.col("event_type").isin(*EVENT_TYPES))
    parsed = parsed_documents(listed)
    flow_name = _first_text(F.col("__flow_name"), F.col("__dataset_name"), F.col(NAME_IN_DETAILS))
    states = [_first_text(F.col(f"__{part}_state"), F.col(f"__{part}_status")) for part in ("flow", "update")]
    state = F.when(F.col("event_type") == "flow_progress", states[0]).otherwise(states[1])
    keys, values = F.col("__metric_keys"), F.col("__metric_values")
    return (
        parsed.select(
            delivery_key().alias("delivery_key"),
            text.squeezed(F.col("id"), 120).alias("event_id"),
            "event_type",
            text.squeezed(F.col("__pipeline_id"), 100).alias("pipeline_id"),
            text.squeezed(F.col("__pipeline_name"), 160).alias("pipeline_name"),
            text.squeezed(F.col("__update_id"), 100).alias("update_id"),
            text.squeezed(flow_name, 160).alias("flow_name"),
            F.upper(text.squeezed(state, 50)).alias("state"),
            ev.event_instant(F.col("timestamp")).alias("event_time"),
            text.squeezed(F.col("timestamp"), 80).alias("event_time_text"),
            text.squeezed(F.col("message"), 500).alias("event_message"),
            *[ev.first_metric(keys, values, key).alias(key) for key in ev.METRIC_KEYS],
            _with_ratios(F.col("__entries")).alias("expectations"),
        )
        .withColumn("flow_key", ev.short_flow_name(F.col("flow_name")))
        .withColumn("layer", ev.flow_layer(F.col("flow_key")))
    )


def delivery_key() -> Column:
    """What tells events apart: the whole id, or all of the event where the id is blank."""
    whole = F.to_json(F.struct("event_type", "timestamp", "message", "origin", "details"))
    own = text.blank_to_null(F.col("id"))
    return F.when(own.isNull(), F.concat(F.lit("event:"), F.sha2(whole, 256))).otherwise(
        F.concat(F.lit("id:"), F.sha2(own, 256))
    )


def one_per_event(found: DataFrame, *earliest: str) -> DataFrame:
    """One row for each event: the first by ``earliest``, then one whose clock was still known."""
    known = F.col("observed_duration_seconds").desc_nulls_last()
    queued = F.col("observed_queue_seconds").desc_nulls_last()
    place = Window.partitionBy("delivery_key").orderBy(*earliest, known, queued)
    return found.withColumn("__place", F.row_number().over(place)).where("__place = 1").drop("__place")


def _first_text(*candidates: Column) -> Column:
    return F.coalesce(*[text.blank_to_null(c) for c in candidates])


def _with_ratios(entries: Column) -> Column:
    """Expectation counts of JSON entries as an array of structs; entries without numbers are left out.

    Text that spells a number, or none such as NaN, is no number.
    """
    none = F.array().cast("array<string>")
    read = F.transform(F.coalesce(entries, none), lambda item: F.from_json(item, ENTRY, {"allowNonNumericNumbers": "false"}))
    numbered = F.filter(read, lambda e: e["passed_records"].isNotNull() & e["failed_records"].isNotNull())
    return F.transform(
        numbered,
        lambda e: F.struct(
            text.squeezed(e["name"], 120).alias("name"),
            text.squeezed(e["dataset"], 120).alias("dataset"),
            e["passed_records"].alias("passed_records"),
            e["failed_records"].alias("failed_records"),
            F.try_divide(e["failed_records"], e["passed_records"] + e["failed_records"]).alias("failure_ratio"),
        ),
    )


def expectation_rows(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.explode("expectations").alias("e")).select("event_id", "e.*")


def graded(events: DataFrame, settings: AlertSettings) -> DataFrame:
    """Severity, condition and reasons. Failed states come first; too many broken records
    replace the condition of a warning state; missing output only counts when all is well."""
    state, kind = F.col("state"), F.col("event_type")
    too_many = F.filter(
        "expectations",
        lambda e: (e.passed_records + e.failed_records >= settings.minimum_records)
        & (e.failure_ratio >= settings.failure_ratio),
    )
    flags = events.withColumns(
        {
            "__failed": state.isin(*ev.FAILURE_STATES),
            "__odd_end": state.isin(*ev.WARNING_STATES),
            "__breaches": F.size(too_many),
            "is_monitored": F.col("flow_key").isin(*settings.expected_writers),
        }
    )
    failed, odd_end = F.col("__failed"), F.col("__odd_end")
    breached = ~failed & (F.col("__breaches") > 0)
    wrote_nothing = (
        ~failed
        & ~odd_end
        & ~breached
        & (kind == "flow_progress")
        & F.col("is_monitored")
        & state.isin(*ev.TERMINAL_STATES)
        & F.coalesce(F.col("num_output_rows") == 0, F.lit(False))
    )
    reasons = F.array_compact(
        F.array(
            F.when(failed | odd_end, F.concat(F.lit("state="), state)),
            F.when(
                breached,
                F.concat(
                    F.col("__breaches").cast("string"),
                    F.lit(f" expectation(s) exceeded {settings.failure_ratio:.2%}"),
                ),
            ),
            F.when(wrote_nothing, "num_output_rows=0"),
        )
    )
    return flags.withColumns(
        {
            "severity": F.when(failed, "critical")
            .when(odd_end | breached | wrote_nothing, "warning")
            .otherwise("info"),
            "condition": F.when(failed, F.concat(kind, F.lit("_failed")))
            .when(breached, "expectation_failure_ratio")
            .when(odd_end, F.concat(kind, F.lit("_unexpected_terminal_state")))
            .when(wrote_nothing, "unexpected_zero_output")
            .when(kind == "flow_progress", "flow_metrics")
            .otherwise("update_state"),
            "reasons": reasons,
        }
    ).drop("__failed", "__odd_end", "__breaches")


def is_emitted(settings: AlertSettings) -> Column:
    """Everything that is not ``info``, and the final metrics of monitored flows."""
    final_metrics = (
        F.lit(settings.emit_flow_metrics)
        & (F.col("event_type") == "flow_progress")
        & F.col("state").isin(*ev.TERMINAL_STATES)
        & F.col("is_monitored")
    )
    return (F.col("severity") != "info") | final_metrics


def with_payload(events: DataFrame, settings: AlertSettings) -> DataFrame:
    """Keys, links and the final message of each alert."""
    has_reason = F.size("reasons") > 0
    reasoned = F.concat(F.array_join("reasons", "; "), F.lit(". "), F.col("event_message"))
    link = F.concat(
        F.lit(f"{settings.base_url}/pipelines/"),
        F.col("pipeline_id"),
        F.when(F.col("update_id") != "", F.concat(F.lit("/updates/"), F.col("update_id"))).otherwise(""),
    )
    linked = F.lit(bool(settings.base_url)) & (F.col("pipeline_id") != "")
    owner = _first_text(F.col("pipeline_id"), F.col("pipeline_name"))
    return events.withColumns(
        {
            "schema_version": F.lit("1.0"),
            "source": F.lit("sdp_event_hook"),
            "destination_key": F.lit(settings.destination),
            "environment": F.lit(settings.environment),
            "idempotency_key": F.concat(F.col("event_id"), F.lit(f":{settings.destination}")),
            "message": F.when(has_reason, text.squeezed(reasoned, 500)).otherwise(
                F.col("event_message")
            ),
            "monitor_key": F.concat_ws(
                ":", owner, text.blank_to_null(F.col("flow_name")), F.col("condition")
            ),
            "diagnostic_url": F.when(linked, link).otherwise(""),
        }
    )


# What an event needs to advance a clock.
CLOCK_COLUMNS = (*FLOW_KEY, "state", "event_time", "event_id")
CLOCK_STATES = (*ev.QUEUED_STATES, *ev.STARTED_STATES, *ev.TERMINAL_STATES)


def alerts(
    events: DataFrame, settings: AlertSettings, carried: DataFrame | None = None
) -> DataFrame:
    """From normalized events to alert rows; every event advances the flow clocks.

    Grading does not depend on the clocks, so it comes first: events that neither raise an
    alert nor move a clock are gone before the timing shuffle, and those that only move a
    clock go through it without their message, metrics and expectations.

    Best given a written table of normalized events: parsing is the costly part, and over a
    plain view Catalyst would repeat it for each pushed filter and each side of a join.
    """
    judged = graded(events, settings).withColumn("__emit", is_emitted(settings))
    emit = F.col("__emit")
    slim = judged.where(emit | F.col("state").isin(*CLOCK_STATES)).select(
        *[
            F.col(c) if c in CLOCK_COLUMNS else F.when(emit, F.col(c)).alias(c)
            for c in judged.columns
        ]
    )
    timed = with_output_rate(with_flow_timings(slim, carried))
    return with_payload(one_per_event(timed.where(emit).drop("__emit")), settings).withColumn(
        "observed_time", F.current_timestamp()
    )


def timed_alerts(timed: DataFrame, settings: AlertSettings) -> DataFrame:
    """As ``alerts``, from events that have their timings and output rate already."""
    found = graded(timed, settings).where(is_emitted(settings))
    return with_payload(one_per_event(found), settings).withColumn("observed_time", F.current_timestamp())


def throughput_text() -> Column:
    """Native processed rate, else native input rate, else the derived output rate."""

    def rate(column: str, label: str) -> Column:
        shown = F.concat(F.lit("`"), text.number_text(F.col(column)), F.lit(f" rows/s` {label}"))
        return F.when(F.col(column).isNotNull(), shown)

    runtime = F.concat(
        F.lit("\nObserved runtime: `"),
        text.duration_text(F.col("observed_duration_seconds")),
        F.lit("`"),
    )
    return F.concat(
        F.coalesce(
            rate("processed_rows_per_second", "processed (native)"),
            rate("input_rows_per_second", "input (native)"),
            rate("avg_output_rows_per_second", "average output (derived)"),
            F.lit("Row rate unavailable; SDP emitted no row count"),
        ),
        F.when(F.col("observed_duration_seconds").isNotNull(), runtime).otherwise(""),
    )


def backlog_text(settings: AlertSettings) -> Column:
    records, files, size = (F.col(f"backlog_{c}") for c in ("records", "files", "bytes"))
    native = F.concat(
        F.lit("Records: `"),
        text.number_text(records),
        F.lit("`\nFiles: `"),
        text.number_text(files),
        F.lit("`\nBytes: `"),
        text.bytes_text(size),
        F.lit("` (native)"),
    )
    streams = F.col("flow_key").isin(*settings.streaming_flows)
    return (
        F.when(F.coalesce(records, files, size).isNotNull(), native)
        .when(
            streams & F.col("state").isin(*ev.SUCCESS_STATES),
            "`Drained` for this triggered update; native pending count not emitted",
        )
        .when(streams, "Streaming flow; native pending count not emitted")
        .otherwise("`N/A` — bounded refresh, not a streaming source")
    )


def quality_text() -> Column:
    """Totals over all expectations and the first five that failed."""
    zero = F.lit(0.0)
    passed = F.aggregate("expectations", zero, lambda total, e: total + e.passed_records)
    failed = F.aggregate("expectations", zero, lambda total, e: total + e.failed_records)
    failing = F.transform(
        F.filter("expectations", lambda e: e.failed_records > 0), lambda e: e["name"]
    )
    names = text.escaped(F.array_join(F.slice(failing, 1, 5), ", "))
    counts = F.concat(
        F.lit("Passed: `"),
        text.number_text(passed),
        F.lit("` • Failed: `"),
        text.number_text(failed),
        F.lit("`"),
    )
    rules = F.when(
        F.size(failing) > 0, F.concat(F.lit("\nFailing rules: `"), names, F.lit("`"))
    ).otherwise("")
    return F.when(F.size("expectations") > 0, F.concat(counts, rules)).otherwise(
        "No expectations attached or reported for this flow event"
    )


def with_message_texts(payloads: DataFrame, settings: AlertSettings) -> DataFrame:
    mark = labelled(F.col("severity"), SEVERITY_MARKS)
    shown_flow = F.coalesce(
        text.blank_to_null(F.col("flow_key")),
        text.blank_to_null(F.col("pipeline_name")),
        F.lit("SDP pipeline"),
    )
    shown_state = F.coalesce(text.blank_to_null(F.col("state")), F.lit("METRICS"))
    rows = F.when(
        F.col("num_output_rows").isNotNull(),
        F.concat(F.lit(" — "), text.number_text(F.col("num_output_rows")), F.lit(" output rows")),
    ).otherwise("")
    named = payloads.withColumns(
        {"severity_mark": mark, "shown_flow": shown_flow, "shown_state": shown_state}
    )
    return named.withColumns(
        {
            "summary": F.concat(
                F.col("severity_mark"),
                F.lit(" ["),
                F.col("environment"),
                F.lit("] "),
                F.col("layer"),
                F.lit(" / "),
                F.col("shown_flow"),
                F.lit(": "),
                F.col("shown_state"),
                rows,
            ),
            "throughput_text": throughput_text(),
            "backlog_text": backlog_text(settings),
            "quality_text": quality_text(),
        }
    )


def message_body(messages: DataFrame) -> DataFrame:
    """The structured message as JSON text: header, two field groups, context, link."""

    def marked(content: Column) -> Column:
        return F.struct(F.lit("mrkdwn").alias("type"), content.alias("text"))

    def field(title: str, content: Column, quoted: bool = True) -> Column:
        tick = "`" if quoted else ""
        return marked(F.concat(F.lit(f"*{title}*\n{tick}"), content, F.lit(tick)))

    def block(kind: str, **parts: Column) -> Column:
        return F.to_json(F.struct(F.lit(kind).alias("type"), *[c.alias(n) for n, c in parts.items()]))

    header = F.struct(
        F.lit("plain_text").alias("type"),
        F.concat(
            F.col("severity_mark"),
            F.lit(" "),
            F.col("layer"),
            F.lit(" flow "),
            F.lower("shown_state"),
        ).alias("text"),
        F.lit(True).alias("emoji"),
    )
    identity = F.array(
        field("Flow", text.escaped(F.col("shown_flow"))),
        field("Environment", text.escaped(F.col("environment"))),
        field("State", text.escaped(F.col("shown_state"))),
        field("Severity", text.escaped(F.upper("severity"))),
    )
    figures = F.array(
        field("Input rows", text.number_text(F.col("num_input_rows"))),
        field("Output rows", text.number_text(F.col("num_output_rows"))),
        field("Output bytes", text.bytes_text(F.col("num_output_bytes"))),
        field("Throughput", F.col("throughput_text"), quoted=False),
        field("Backlog status", F.col("backlog_text"), quoted=False),
        field("Data quality", F.col("quality_text"), quoted=False),
    )
    context = F.array(
        marked(
            F.concat(
                F.lit("Update `"),
                text.escaped(F.col("update_id")),
                F.lit("` • Event `"),
                text.escaped(F.col("event_time_text")),
                F.lit("`"),
            )
        )
    )
    button = F.array(
        F.struct(
            F.lit("button").alias("type"),
            F.struct(
                F.lit("plain_text").alias("type"), F.lit("Open pipeline update").alias("text")
            ).alias("text"),
            F.col("diagnostic_url").alias("url"),
        )
    )
    blocks = F.concat_ws(
        ",",
        block("header", text=header),
        block("section", fields=identity),
        block("section", fields=figures),
        block("context", elements=context),
        F.when(F.col("diagnostic_url").startswith("https://"), block("actions", elements=button)),
    )
    summary = F.to_json(F.struct(F.col("summary").alias("text")))
    opened = F.expr("substring(summary_json, 1, length(summary_json) - 1)")
    return (
        messages.withColumns({"summary_json": summary, "blocks_json": blocks})
        .withColumn(
            "body",
            F.concat(
                opened,
                F.lit(',"blocks":['),
                F.col("blocks_json"),
                F.lit('],"unfurl_links":false,"unfurl_media":false}'),
            ),
        )
        .drop("summary_json", "blocks_json")
    )
