"""Clustered table writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clustered(
    df: DataFrame, keys: Sequence[str], spread: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Ordered so that each written file covers a narrow range of ``keys``; readers that filter
    on a leading key then skip most row groups by their statistics.

    Ranges are cut by sampled volume. ``spread`` columns continue the sort order below the
    keys, so one very frequent key combination can still be cut over several files.
    """
    order = [*keys, *spread]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def z_ordered(
    df: DataFrame, keys: Sequence[str], bits: int = 6, spread: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Ordered so that each written file covers a narrow range of every one of ``keys``, not of the
    first only: readers that filter on any of them skip most row groups.

    A key's value becomes its rank among ``2 ** bits`` parts of equal volume; the bits of the
    ranks, taken in turn, give a place on a Z-shaped curve through all of them, and ranges of the
    curve become files. The ranks' limits come from one pass of approximate quantiles; they are
    ``2 ** bits - 1`` values a key, whatever the size of ``df``, so ``df`` should be a written table. Nulls rank first.
    """
    return df.transform(_along_curve, keys, bits, spread, partitions)


def _along_curve(df: DataFrame, keys: Sequence[str], bits: int, spread: Sequence[str], partitions: int | None) -> DataFrame:
    shares = [i / 2**bits for i in range(1, 2**bits)]
    # Only the order counts, so dates and times become numbers for the quantiles.
    limits = df.agg(*[F.percentile_approx(_number(df, k), shares, 10_000).alias(f"limits_{i}") for i, k in enumerate(keys)]).first()
    place = F.lit(0).cast("long")
    for number, key in enumerate(keys):
        rank = _rank(_number(df, key), sorted(set(limits[number] or ())))
        for bit in range(bits):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            place = place + F.shiftleft(one, bit * len(keys) + number)
    order = ["__place", *spread]
    placed = df.withColumn("__place", place)
    ranged = placed.repartitionByRange(partitions, *order) if partitions else placed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).drop("__place")


def _number(df: DataFrame, key: str) -> Column:
    kind = df.schema[key].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(key)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(key).cast("timestamp"))
    if isinstance(kind, T.NumericType):
        return F.col(key)
    raise ValueError(f"{key} is no number, date or time")


def _rank(value: Column, limits: Sequence) -> Column:
    """How many of the sorted limits lie at or below a value: a search by halves, as nested conditions."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(limits[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return F.when(value.isNull(), F.lit(0)).otherwise(search(0, len(limits))).cast("int")


def write_z_ordered(
    df: DataFrame, path: str, keys: Sequence[str], bits: int = 6, spread: Sequence[str] = (), partitions: int | None = None
) -> None:
    z_ordered(df, keys, bits, spread, partitions).write.mode("overwrite").parquet(path)


def write_clustered(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    spread: Sequence[str] = (),
    partitions: int | None = None,
) -> None:
    clustered(df, keys, spread, partitions).write.mode("overwrite").parquet(path)


def publish_table(df: DataFrame, name: str, path: str, layer: str, comment: str) -> None:
    """Register ``df`` as a catalog table with its layer and purpose as metadata."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    _describe(df.sparkSession, name, layer, comment)


def register_table(spark: SparkSession, name: str, path: str, layer: str, comment: str) -> None:
    """Let a catalog table, new or known, show the parquet files at ``path``."""
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path, "parquet")
    _describe(spark, name, layer, comment)


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _describe(spark: SparkSession, name: str, layer: str, comment: str) -> None:
    spark.sql(f"ALTER TABLE {_quoted(name)} SET TBLPROPERTIES ('quality' = :layer)", {"layer": layer})
    spark.sql(f"COMMENT ON TABLE {_quoted(name)} IS :comment", {"comment": comment})
