"""Column expressions over pipeline events that are kept as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lifecycle states.
FAILURE_STATES = ("FAILED", "ERROR", "CANCELED", "CANCELLED", "STOPPED")
WARNING_STATES = ("SKIPPED", "EXCLUDED")
SUCCESS_STATES = ("COMPLETED", "SUCCEEDED")
TERMINAL_STATES = FAILURE_STATES + WARNING_STATES + SUCCESS_STATES
QUEUED_STATES = ("QUEUED",)
STARTED_STATES = ("STARTING", "RUNNING")

# The metrics looked for at any depth of an event.
METRIC_KEYS = (
    "num_input_rows",
    "num_output_rows",
    "num_output_bytes",
    "num_upserted_rows",
    "num_deleted_rows",
    "backlog_records",
    "backlog_bytes",
    "backlog_files",
    "input_rows_per_second",
    "processed_rows_per_second",
)

# Flow names that map to a layer by themselves.
CHECK_FLOWS = (
    "trips_enriched_with_rejection_reasons",
    "yellow_trips_2025_dq_metrics",
    "taxi_zones_contract",
)
CONFORMED_FLOWS = ("yellow_trips_2025", "yellow_trips_2025_quarantine", "taxi_zones")


def object_text(json: Column) -> Column:
    """The text of a JSON object, also when it was encoded a second time as a string.

    Anything that is not an object (broken text, arrays, numbers) gives ''. Reading the text
    back as a member parses it as a whole and decodes a string; the second reading does the
    same for what was inside. The input is named once only, so that Catalyst can push
    filters through a chain of these without multiplying it.
    """
    return F.regexp_extract(value_text(value_text(json)), r"^(\{[\s\S]*)$", 1)


def value_text(json: Column) -> Column:
    """Any JSON value as text: strings are decoded, objects and arrays stay JSON."""
    return F.get_json_object(F.concat(F.lit('{"v":'), json, F.lit("}")), "$.v")


def decoded_text(json: Column) -> Column:
    """The text of a JSON value; a string that holds JSON text is replaced by that text."""
    own = F.try_variant_get(F.try_parse_json(F.when(F.ltrim(json).startswith('"'), json)), "$", "string")
    return F.when(F.ltrim(json).startswith('"'), own).otherwise(json)


def is_plain(json_object: Column, parsed: Column) -> Column:
    """Whether a document is an object that was parsed and has no member that was encoded a second time.

    ``parsed`` is its variant, which there is none of for broken text and repeated keys; such documents, and encoded members, are
    left to the reading of text.
    """
    whole = parsed.isNotNull() & F.ltrim(json_object).startswith("{")
    return F.coalesce(whole & ~json_object.rlike(r'"\s*[\[{]'), F.lit(False))


NUMBER = r"(-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false)"


def metric_matches(json_object: Column, group: int) -> Column:
    """All numeric metrics of a document, at any depth and in document order: their keys
    (group 1) or their values as text (group 2), found in one scan.

    Quotes inside encoded strings are preceded by a backslash, so nested text cannot match.
    """
    # Most keys end at the first letter.
    initials = "".join(sorted({key[0] for key in METRIC_KEYS}))
    pattern = rf'"(?=[{initials}])({"|".join(METRIC_KEYS)})"\s*:\s*{NUMBER}'
    return F.regexp_extract_all(json_object, F.lit(pattern), F.lit(group))


def first_metric(keys: Column, values: Column, key: str) -> Column:
    """The first value of ``key``, NULL when it is not there."""
    text = F.get(values, (F.array_position(keys, F.lit(key)) - 1).cast("int"))
    for word, digit in (("true", "1"), ("false", "0")):
        text = F.replace(text, F.lit(word), F.lit(digit))
    return text.try_cast("double")


def event_instant(text: Column) -> Column:
    """ISO text to an instant: no zone means UTC, unreadable text means NULL."""
    full = F.regexp_replace(F.trim(text), r"^(\d{4}-\d{2}-\d{2})$", "$1T00:00:00")
    zoned = F.regexp_replace(full, r"(?<!Z)(?<![+-]\d{2}:\d{2})(?<![+-]\d{4})$", "Z")
    return F.try_to_timestamp(F.regexp_extract(zoned, r"^(\d{4}-\d{2}-\d{2}T?.*)$", 1))


def short_flow_name(flow_name: Column) -> Column:
    return F.substring_index(flow_name, ".", -1)


def flow_layer(flow_key: Column) -> Column:
    return (
        F.when(flow_key.endswith("_raw"), "Bronze")
        .when(flow_key.startswith("mart_"), "Gold")
        .when(flow_key.isin(*CHECK_FLOWS), "Silver / DQ")
        .when(flow_key.isin(*CONFORMED_FLOWS), "Silver")
        .otherwise("Pipeline")
    )
