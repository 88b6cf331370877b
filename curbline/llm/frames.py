"""What the operators share: reading their columns, work folders, file systems of tasks."""

from __future__ import annotations

import posixpath
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.session import new_work_dir
from curbline.sources.files import open_fs as open_fs


#: Bits of the mark of a set of ids: 64 to a row, so its table is bounded and may be broadcast.
ID_BITS = 1 << 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def field(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def narrowed(frame: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names that an operator uses within.

    Whatever else the frame has, and however that is called, stays out.
    """
    return frame.select(*[field(theirs).alias(ours) for ours, theirs in columns.items()])


def stored(frame: DataFrame, purpose: str, **options: str) -> DataFrame:
    """The frame written below the shared folder and read again; later steps start there."""
    path = new_work_dir(frame.sparkSession, purpose)
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def a_task_each(files: DataFrame) -> DataFrame:
    """A table of files, dealt so that each is a task's own; left alone, so few rows would be one task's."""
    return files.repartitionByRange(max(1, files.count()), "file")


def put_in_place(filesystem, written: str, path: str) -> None:
    """Name a finished file. An attempt that comes later puts the same bytes there."""
    filesystem.move(written, path)


def attempt_path(folder: str, name: str) -> str:
    """A path for an unfinished file that no other attempt of any task uses."""
    import uuid

    return posixpath.join(folder, f".{name}.{uuid.uuid4().hex}")


def parted_by_ids(frame: DataFrame, column: str, ids: DataFrame, bits: int = ID_BITS) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``column`` may be among the one column of ``ids``, and those whose surely isn't.

    Each id sets the bit of its hash value, and the bits travel to the rows, so what is
    joined exactly afterwards is little more than the rows that are meant: wide rows
    needn't be shuffled for the few that a join is about. With more ids than bits all
    rows may be meant, and it is a plain join again. ``frame`` is read twice.
    """

    def place(key: Column) -> tuple[Column, Column]:
        at = F.pmod(F.xxhash64(key.cast("long")), F.lit(bits))
        return F.shiftright(at, 6), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))

    word, bit = place(field(ids.columns[0]))
    marks = F.broadcast(ids.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("mark")))
    word, bit = place(frame["`" + column.replace("`", "``") + "`"])
    met = (word == marks["word"]) & (bit.bitwiseAND(marks["mark"]) != 0)
    return frame.join(marks, met, "left_semi"), frame.join(marks, met, "left_anti")


def merged(parts: Iterable[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
