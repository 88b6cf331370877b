"""Page filters, re-aggregation after filtering, and click selections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AGGREGATES = {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Slice:
    """The four page filters. An empty selection or an open end keeps everything."""

    hours: Sequence[int] = ()
    boroughs: Sequence[str] = ()
    airport_flags: Sequence[str] = ()
    first_date: str | None = None
    last_date: str | None = None

    def condition(self) -> Column:
        parts = [
            F.col(name).isin(*chosen)
            for name, chosen in (
                ("pickup_hour", self.hours),
                ("pickup_borough", self.boroughs),
                ("airport_flag", self.airport_flags),
            )
            if chosen
        ]
        if self.first_date:
            parts.append(F.col("trip_date") >= F.lit(self.first_date).cast("date"))
        if self.last_date:
            parts.append(F.col("trip_date") <= F.lit(self.last_date).cast("date"))
        return reduce(lambda a, b: a & b, parts, F.lit(True))

    def fields(self) -> tuple[str, ...]:
        """The columns that the slice looks at."""
        used = {
            "pickup_hour": self.hours, "pickup_borough": self.boroughs, "airport_flag": self.airport_flags,
            "trip_date": (self.first_date, self.last_date) != (None, None),
        }
        return tuple(name for name, chosen in used.items() if chosen)

    def of(self, df: DataFrame) -> DataFrame:
        return df.where(self.condition())


def widget_query(
    df: DataFrame,
    dims: Sequence[str],
    measures: Mapping[str, tuple[str, str]],
    where: Slice = Slice(),
) -> DataFrame:
    """Filter, then group by ``dims``, then aggregate.

    ``measures`` maps an output name to (aggregate, input column).
    """
    aggregates = [AGGREGATES[how](column).alias(name) for name, (how, column) in measures.items()]
    return where.of(df).groupBy(*dims).agg(*aggregates)


def filter_options(datasets: Mapping[str, DataFrame], fields: Sequence[str]) -> DataFrame:
    """The distinct values each filter offers, per dataset.

    All fields of a dataset are unfolded in one read, and duplicates vanish map-side.
    """
    options = [
        df.select(*[F.col(f).cast("string").alias(f) for f in fields])
        .unpivot([], list(fields), "field", "option")
        .distinct()
        .select(F.lit(name).alias("dataset"), "field", "option")
        for name, df in datasets.items()
    ]
    return reduce(DataFrame.unionByName, options)


def select_clicked(df: DataFrame, column: str, chosen: Sequence) -> DataFrame:
    """Rows of the clicked items; with nothing clicked there are none."""
    return df.where(F.col(column).isin(*chosen) if chosen else F.lit(False))


def highlight_clicked(df: DataFrame, column: str, chosen: Sequence) -> DataFrame:
    """Every row, with a mark on those of the clicked items."""
    clicked = F.coalesce(F.col(column).isin(*chosen), F.lit(False)) if chosen else F.lit(False)
    return df.withColumn("is_selected", clicked)


def with_category_order(
    df: DataFrame, column: str, order: Sequence[str], name: str = "category_order"
) -> DataFrame:
    """The position of a label in a given order, from 0; labels outside it get NULL."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column))
    return df.withColumn(name, (F.nullif(place, F.lit(0)) - 1).cast("int"))
