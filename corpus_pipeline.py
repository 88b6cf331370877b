"""The corpus pipeline: toxic and poor documents go, one of each group of near-duplicates stays, the rest is packed.

A stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept.
Its result is written as Parquet and read again as the next one's ``docs``. All but the
last return the columns of ``docs`` as they are. Columns other than ``doc_id`` and
``text`` may have any names. Documents without ``doc_id`` are judged by their text
like others, but are no one's duplicate. An empty table stays empty. Where the labels
tell no document from another (none of ``docs``, one kind only, too few), all rows
stay in the quality stage; the toxicity stage then drops what its fixed lists alone find.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbline.llm import packing, quality, setsketch, toxicity
from curbline.llm.frames import field, parted_by_ids, stored, table

#: A document with at least this score of being toxic goes, and so does one with less than this of being good.
TOXIC, GOOD = 0.7, 0.7
#: Least similarity of near-duplicates, in hundredths.
SIMILAR = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    grammar = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(field("text"), grammar) < TOXIC)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    if not model.tells:
        return docs
    return docs.where(quality.score(field("text"), model) >= GOOD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest ``doc_id`` of each group stays; of rows that repeat it, the one with the smallest text."""
    found = stored(setsketch.near_duplicates(docs, percent=SIMILAR), "near-duplicates").where("doc_id is not null")
    names = [*map(field, docs.columns)]

    def others(rows: DataFrame, ids: DataFrame) -> DataFrame:
        few, rest = parted_by_ids(rows, "doc_id", ids)
        return rest.select(*names).unionByName(few.join(ids, "doc_id", "left_anti").select(*names))

    left = others(docs, found.where("not kept").select("doc_id").distinct())
    again = stored(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if again.isEmpty():
        return left
    # As a struct, so that no column of ``docs`` meets one of these names.
    whole = parted_by_ids(left, "doc_id", again)[0].join(again, "doc_id", "left_semi").select(
        F.struct(*names).alias("row"), field("doc_id").alias("id"), field("text").alias("text")
    )
    first = F.row_number().over(Window.partitionBy("id").orderBy("text"))
    one = whole.withColumn("place", first).where("place = 1").select("row.*")
    return others(left, again).unionByName(one)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.lengths(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_duplicates),
    ("best_fit_packing", pack),
]

#: SQL can't express the fitted models, so the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
