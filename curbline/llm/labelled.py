"""Labelled rows for fitting: the bounded sample, and which rows are never learned from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.frames import field, narrowed

#: Labelled documents that a classifier is fitted on, at most: those of the smallest hash values.
FIT_ROWS = 20_000


def remainder(doc_id: str, of: int) -> Column:
    return F.pmod(F.crc32(field(doc_id).cast("string").cast("binary")), F.lit(of))


def held_out(doc_id: str, of: int, rest: int) -> Column:
    """Whether a row is kept for testing; false without ``doc_id``."""
    return F.coalesce(remainder(doc_id, of) == rest, F.lit(False))


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, of: int, rest: int, rows: int = FIT_ROWS) -> DataFrame:
    """``text`` and ``label`` (0 or 1) of at most ``rows`` labelled documents that aren't held out.

    Labels that are null are none; of several for one document the largest counts. Only
    labels of rows that ``docs`` has are chosen from. The chosen ids are few, by the bound,
    so they are broadcast; ids are shuffled, and no text is.
    """
    known = narrowed(labels, doc_id="doc_id", label=label).where("label is not null and doc_id is not null")
    known = known.where(~held_out("doc_id", of, rest)).groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    there = narrowed(docs, doc_id="doc_id").distinct()
    chosen = known.join(there, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return narrowed(docs, doc_id="doc_id", text="text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
