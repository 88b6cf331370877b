"""Cleaning and display formatting of text and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_REPORTED = "Not reported"
BYTE_UNITS = ("B", "KiB", "MiB", "GiB", "TiB")


def squeezed(text: Column, limit: int) -> Column:
    """Single spaces, no outer blanks, at most ``limit`` characters; NULL gives ''."""
    return F.left(
        F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")), F.lit(limit)
    )


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def escaped(text: Column) -> Column:
    result = F.coalesce(text, F.lit(""))
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        result = F.replace(result, F.lit(raw), F.lit(entity))
    return result


def number_text(value: Column) -> Column:
    """Thousands separators; two decimals only when the value is not whole."""
    return (
        F.when(value.isNull(), NOT_REPORTED)
        .when(value == F.floor(value), F.format_number(value, 0))
        .otherwise(F.format_number(value, 2))
    )


def bytes_text(value: Column) -> Column:
    text = F.when(value.isNull(), NOT_REPORTED)
    last = len(BYTE_UNITS) - 1
    for power, unit in enumerate(BYTE_UNITS):
        scaled = value / float(1024**power)
        shown = F.concat(F.format_number(scaled, 1), F.lit(f" {unit}"))
        text = text.otherwise(shown) if power == last else text.when(F.abs(scaled) < 1024, shown)
    return text


def duration_text(seconds: Column) -> Column:
    rest = seconds % 60.0
    return (
        F.when(seconds.isNull(), NOT_REPORTED)
        .when(seconds < 60, F.concat(F.format_number(seconds, 1), F.lit(" s")))
        .otherwise(
            F.concat(
                F.format_number((seconds - rest) / 60.0, 0),
                F.lit("m "),
                F.format_number(rest, 1),
                F.lit("s"),
            )
        )
    )


def si_text(value: Column) -> Column:
    """A non-negative count in k, M, G or T with up to six significant digits."""
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.greatest(value, F.lit(1.0)))) - 5)
    kept = F.when(value < 1e6, value).otherwise(F.round(value / unit) * unit)
    scaled = [
        F.when(kept >= floor_value, _trimmed(kept / floor_value, suffix))
        for floor_value, suffix in ((1e12, "T"), (1e9, "G"), (1e6, "M"), (1e3, "k"))
    ]
    return F.coalesce(*scaled, _trimmed(kept, ""))


def patterned(value: Column, pattern: str) -> Column:
    """``format_number`` with a decimal pattern, without thousands separators."""
    return F.call_function("format_number", value, F.lit(pattern))


def _trimmed(scaled: Column, suffix: str) -> Column:
    return F.concat(patterned(scaled, "0.#####"), F.lit(suffix))
