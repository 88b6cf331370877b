"""Slices from aggregates that are small already: a lattice of cuboids over the filter fields.

A chart groups by its own dimensions; a page filter needs its field besides. So a dataset is summed
up to the chart's dimensions alone, to those with each filter field, and to those with all
of them, in one pass with grouping sets. Sums of sums are sums, so any slice has the same result from each
cuboid that has its fields, and the one with the fewest rows answers it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.operators.slicing import Slice, widget_query


@dataclass(frozen=True)
class Cuboid:
    """Fields beyond the chart's dimensions, and the number of rows."""

    label: str
    fields: tuple[str, ...]
    rows: int


def lattice(free: Sequence[str]) -> list[tuple[str, ...]]:
    """No field, each field alone, and all of them."""
    sets = [(), *[(f,) for f in free], tuple(free)]
    return list(dict.fromkeys(sets))


def label_of(fields: Sequence[str]) -> str:
    return "+".join(fields) or "none"


def cuboids(df: DataFrame, dims: Sequence[str], filters: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """The rows of all cuboids, told apart by ``cuboid``."""
    free = [f for f in filters if f not in dims]
    columns = [*dims, *free]
    sets = lattice(free)
    name = F.lit(None).cast("string")
    for own in sets:
        left_out = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c in free and c not in own)
        name = F.when(F.col("__set") == left_out, label_of(own)).otherwise(name)
    grouped = df.groupingSets([[*dims, *own] for own in sets], *columns).agg(
        *[F.sum(m).alias(m) for m in sums], F.grouping_id().alias("__set")
    )
    return grouped.withColumn("cuboid", name).drop("__set")


def write_cuboids(df: DataFrame, path: str, dims: Sequence[str], filters: Sequence[str], sums: Sequence[str]) -> None:
    """A folder for each cuboid, and a small table of their numbers of rows."""
    cuboids(df, dims, filters, sums).write.mode("overwrite").partitionBy("cuboid").parquet(f"{path}/rows")
    written = df.sparkSession.read.parquet(f"{path}/rows")
    written.groupBy("cuboid").agg(F.count(F.lit(1)).alias("rows")).coalesce(1).write.mode("overwrite").parquet(f"{path}/sizes")


def read_sizes(spark: SparkSession, path: str) -> list[Cuboid]:
    """What cuboids there are; as many as the lattice has."""
    rows = spark.read.parquet(f"{path}/sizes").collect()
    return [Cuboid(r.cuboid, tuple(f for f in r.cuboid.split("+") if f != "none"), r.rows) for r in rows]


def smallest(known: Sequence[Cuboid], dims: Sequence[str], where: Slice) -> Cuboid:
    """The cuboid with the fewest rows that has all fields of a slice."""
    needed = set(where.fields()) - set(dims)
    return min((c for c in known if needed <= set(c.fields)), key=lambda c: (c.rows, len(c.fields)))


def sliced(spark: SparkSession, path: str, dims: Sequence[str], sums: Sequence[str], where: Slice = Slice()) -> DataFrame:
    """The chart's groups and sums under a slice, from the smallest cuboid that can tell them."""
    known = read_sizes(spark, path)
    if not known:
        return widget_query(spark.read.parquet(f"{path}/rows"), dims, _sums(sums), where)
    own = smallest(known, dims, where)
    rows = spark.read.parquet(f"{path}/rows").where(F.col("cuboid") == own.label)
    return widget_query(rows, dims, _sums(sums), where)


def _sums(columns: Sequence[str]) -> Mapping[str, tuple[str, str]]:
    return {c: ("sum", c) for c in columns}


def stacked_measures(results: Mapping[str, DataFrame], dims: Mapping[str, Sequence[str]], sums: Mapping[str, Sequence[str]]) -> DataFrame:
    """Results of several datasets in one table: ``dataset``, its ``dimensions`` as text, ``measure`` and ``value``."""
    parts = None
    for name, df in results.items():
        text = F.concat_ws("|", *[F.coalesce(F.col(d).cast("string"), F.lit("")) for d in dims[name]])
        part = df.select(
            F.lit(name).alias("dataset"), text.alias("dimensions"), *[F.col(m).cast("double").alias(m) for m in sums[name]]
        ).unpivot(["dataset", "dimensions"], list(sums[name]), "measure", "value")
        parts = part if parts is None else parts.unionByName(part)
    return parts
