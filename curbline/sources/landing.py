"""Checks over landed files: what is there, what changed, magic bytes, size, months and a summary.

The landing zone is listed by tasks, folder by folder, into a table of files. No
list of files is made on the driver, and each listing is kept, so the next one tells what is new.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.session import new_work_dir
from curbline.sources import storage
from curbline.sources.files import open_fs
from curbline.sources.lake import Lake

# Smallest plausible trip file and the marker at both of its ends.
MINIMUM_BYTES = 10_000_000
PARQUET_MARK = b"PAR1"

#: The kept listing in a lake.
LISTING = "landed_files"
FOLDER_DDL = "path string, is_folder boolean, bytes long, modified timestamp"


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies right below each folder."""
    from pyarrow import fs

    for batch in batches:
        for folder in batch.column("path").to_pylist():
            store, inner = open_fs(folder)
            found = store.get_file_info(fs.FileSelector(inner, allow_not_found=True))
            prefix = folder.rstrip("/")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{prefix}/{f.base_name}" for f in found], pa.string()),
                    pa.array([f.type == fs.FileType.Directory for f in found], pa.bool_()),
                    pa.array([f.size if f.type == fs.FileType.File else None for f in found], pa.int64()),
                    pa.array([f.mtime for f in found], pa.timestamp("us", "UTC")),
                ],
                names=["path", "is_folder", "bytes", "modified"],
            )


def landed_files(spark: SparkSession, root: str, ending: str = ".parquet") -> DataFrame:
    """``path``, ``bytes`` and ``modified`` of each file below ``root``, empty ones included.

    Tasks list the folders of one level after another; the driver learns only whether
    there is another level. Hidden names (``_`` and ``.`` in front) are left out, as Spark does. No content is read.
    """
    base = new_work_dir(spark, "listing")
    level = spark.createDataFrame([(storage.qualified(spark, root),)], "path string")
    depth = 0
    while True:
        below = level.repartition("path").mapInArrow(_children, FOLDER_DDL)
        name = F.substring_index("path", "/", -1)
        below.where(~name.startswith("_") & ~name.startswith(".")).write.parquet(f"{base}/depth={depth}")
        found = spark.read.schema(FOLDER_DDL).parquet(f"{base}/depth={depth}")
        level, depth = found.where("is_folder").select("path"), depth + 1
        if level.isEmpty():
            break
    files = spark.read.schema(FOLDER_DDL).parquet(base).where(~F.col("is_folder"))
    return files.where(F.col("path").endswith(ending)).select("path", "bytes", "modified")


def take_listing(lake: Lake, root: str, ending: str = ".parquet") -> DataFrame:
    """List ``root`` again, keep the listing in the lake, and tell what changed since the last one.

    ``change`` is ``new``, ``changed`` (size or time differ), ``same`` or ``gone``.
    """
    change = lake.change()
    before = change.read(LISTING) if change.has(LISTING) else None
    change.replace(LISTING, landed_files(lake.spark, root, ending), "bronze", "Files of the landing zone at the last look")
    now = change.read(LISTING)
    change.publish()
    if before is None:
        return now.withColumn("change", F.lit("new"))
    old = before.select("path", F.col("bytes").alias("old_bytes"), F.col("modified").alias("old_modified"))
    both = now.join(old, "path", "full")
    return both.select(
        "path",
        F.coalesce("bytes", "old_bytes").alias("bytes"),
        F.coalesce("modified", "old_modified").alias("modified"),
        F.when(F.col("old_modified").isNull(), "new")
        .when(F.col("modified").isNull(), "gone")
        .when((F.col("bytes") == F.col("old_bytes")) & (F.col("modified") == F.col("old_modified")), "same")
        .otherwise("changed")
        .alias("change"),
    )


def file_month(path: Column) -> Column:
    """The month in a landed file's name or folder, as yyyy-MM; '' when there is none."""
    return F.regexp_extract(path, "yellow_tripdata_([0-9]{4}-[0-9]{2})", 1)


def audit_files(files: DataFrame, minimum_bytes: int = MINIMUM_BYTES) -> DataFrame:
    """Whether each file is large enough and starts and ends with the parquet marker.

    Each task opens its own share of the files and seeks to both ends: eight bytes are read
    per file, whatever its size.
    """

    def both_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, marked = [], []
            for path in batch["path"]:
                store, inner = open_fs(path)
                with store.open_input_file(inner) as handle:
                    size = handle.size()
                    ends = (handle.read_at(4, 0), handle.read_at(4, size - 4)) if size >= 8 else ()
                sizes.append(size)
                marked.append(ends == (PARQUET_MARK, PARQUET_MARK))
            yield pd.DataFrame({"path": batch["path"], "bytes": sizes, "has_marks": marked})

    ends = files.select("path").mapInPandas(both_ends, "path string, bytes bigint, has_marks boolean")
    large = F.col("bytes") >= minimum_bytes
    return ends.withColumn("is_large_enough", large).withColumn(
        "status", F.when(F.col("has_marks") & large, "valid").otherwise("invalid")
    )


def landing_summary(audit: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return audit.groupBy(*by, "status").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("bytes").alias("total_bytes")
    )


def missing_months(
    landed: DataFrame, month: str, month_count: int = 12, by: Sequence[str] = ()
) -> DataFrame:
    """Months from 1 to ``month_count`` without any landed row, for each source in ``by``.

    The months seen by a source form a bit mask, which is put together map-side, so the
    shuffle carries one row per source and task and no anti join is needed afterwards.
    """
    if not 1 <= month_count <= 12:
        raise ValueError("month_count must be between 1 and 12")
    seen = landed.groupBy(*by).agg(
        F.expr(f"coalesce(bit_or(shiftleft(1, {month})), 0)").alias("seen_months")
    )
    expected = seen.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(month_count))))
    return expected.where(F.getbit("seen_months", F.col("month")) == 0).select(*by, "month")


def missing_files(files: DataFrame, year: int, month_count: int = 12, by: Sequence[str] = ()) -> DataFrame:
    """Months of a year for which no file has landed, by the files' names; ``by`` columns tell sources apart."""
    month = file_month(F.col("path"))
    own = files.where(month.startswith(f"{year}-")).withColumn("__month", F.right(month, F.lit(2)).cast("int"))
    # A source whose files are all of other years misses every month.
    every = files.select(*by).distinct().withColumn("__month", F.lit(0)) if by else files.limit(1).select(F.lit(0).alias("__month"))
    return missing_months(own.select(*by, "__month").unionByName(every), "__month", month_count, by)
