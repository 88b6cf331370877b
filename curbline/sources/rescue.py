"""Files whose columns differ from the declared ones: evolve, cast, keep the misfits."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.sources.files import open_fs

RESCUED = "_rescued_data"


def rescue(df: DataFrame, target: T.StructType, passthrough: Sequence[str] = ()) -> DataFrame:
    """Cast ``df`` to ``target``; what does not fit is kept as JSON in ``_rescued_data``.

    Names are matched without case. Columns that ``df`` lacks become NULL. Columns that ``target`` lacks are rescued too.
    ``passthrough`` columns are neither cast nor rescued.
    """
    present = {c.lower(): c for c in reversed(df.columns)}
    known = {f.name.lower() for f in target}
    casts = {f.name: _cast(df, present[f.name.lower()], f.dataType) for f in target if f.name.lower() in present}
    taken = {present[name] for name in known if name in present}
    misfits = [
        F.when(~fits, F.col(_quoted(present[name.lower()]))).alias(present[name.lower()])
        for name, (_, fits) in casts.items()
    ]
    misfits += [F.col(_quoted(c)) for c in df.columns if c not in taken and c not in passthrough]
    return df.select(
        *[
            (casts[f.name][0] if f.name in casts else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target
        ],
        _json_or_null(misfits).alias(RESCUED),
        *passthrough,
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _cast(df: DataFrame, name: str, wanted: T.DataType) -> tuple[Column, Column]:
    """The value as ``wanted``, and whether nothing is lost by that.

    A value fits if casting it back gives the same value; text fits if it can be read, also if
    the value would be written otherwise ("007" is read as 7).
    Types between which Spark knows no cast never fit.
    """
    own, kind = F.col(_quoted(name)), df.schema[name].dataType
    if kind == wanted:
        return own, F.lit(True)
    cast = own.try_cast(wanted)
    try:
        df.select(cast)
    except AnalysisException:
        return F.lit(None).cast(wanted), own.isNull()
    fits = own.isNull() | cast.isNotNull()
    if not isinstance(kind, T.StringType):
        back = cast.try_cast(kind)
        try:
            df.select(back.eqNullSafe(own))
            fits = back.eqNullSafe(own)
        except AnalysisException:
            pass
    return F.when(fits, cast), fits


def _json_or_null(columns: list[Column]) -> Column:
    if not columns:
        return F.lit(None).cast("string")
    return F.nullif(F.to_json(F.struct(*columns)), F.lit("{}"))


def file_schemas(paths: DataFrame) -> DataFrame:
    """The column names and types of each file as text, read from the footers by the tasks."""

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            found = []
            for path in batch["path"]:
                store, inner = open_fs(path)
                with store.open_input_file(inner) as handle:
                    schema = pq.read_schema(handle)
                found.append(json.dumps([[f.name, str(f.type)] for f in schema]))
            yield pd.DataFrame({"path": batch["path"], "layout": found})

    return paths.select("path").mapInPandas(footers, "path string, layout string")


def read_by_layout(spark: SparkSession, paths: DataFrame) -> list[DataFrame]:
    """One frame per distinct file layout, each read with its files' own types.

    Only file names come to the driver, which lists the files of any scan anyway. Folder
    names are not taken as columns.
    """
    by_layout: dict[str, list[str]] = {}
    for row in file_schemas(paths).toLocalIterator():
        by_layout.setdefault(row.layout, []).append(row.path)
    return [
        spark.read.option("recursiveFileLookup", "true").parquet(*sorted(files))
        for _, files in sorted(by_layout.items())
    ]


def evolve(known: T.StructType, frames: Sequence[DataFrame], ignore: Sequence[str] = ()) -> T.StructType:
    """``known`` plus the columns that are new in ``frames``, as nullable columns at the end.

    A known column keeps its type, and names that differ in case only are one column. A new
    column that comes with several types becomes text.
    """
    names = {name.lower() for name in [*known.names, *ignore]}
    fresh: dict[str, tuple[set[str], set[str]]] = {}
    for df in frames:
        for f in df.schema:
            if f.name.lower() not in names:
                spellings, kinds = fresh.setdefault(f.name.lower(), (set(), set()))
                spellings.add(f.name)
                kinds.add(f.dataType.simpleString())
    added = [
        T.StructField(min(spellings), T.StringType() if len(kinds) > 1 else _parsed(kinds.pop()), True)
        for _, (spellings, kinds) in sorted(fresh.items())
    ]
    return T.StructType([*known.fields, *added])


def _parsed(simple: str) -> T.DataType:
    return T.StructType.fromDDL(f"c {simple}")["c"].dataType


def rescued_union(
    frames: Sequence[DataFrame], target: T.StructType, passthrough: Sequence[str] = ()
) -> DataFrame:
    return reduce(DataFrame.unionByName, [rescue(df, target, passthrough) for df in frames])


def save_schema(spark: SparkSession, location: str, version: int, schema: T.StructType) -> None:
    """Keep a schema version; writing the same version again replaces it."""
    row = spark.createDataFrame([(version, schema.json())], "version bigint, schema_json string")
    row.write.mode("overwrite").json(f"{location}/v={version}")


def latest_schema(spark: SparkSession, location: str, before: int | None = None):
    """The newest saved schema below version ``before``, or NULL when there is none."""
    try:
        saved = spark.read.schema("version bigint, schema_json string").json(location)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if before is not None:
        saved = saved.where(F.col("version") < before)
    newest = saved.orderBy(F.col("version").desc()).limit(1).collect()
    return T.StructType.fromJson(json.loads(newest[0].schema_json)) if newest else None
