"""Marts that are kept up to date by what arrives, with their state in a ``Lake``.

Additive marts need their shares only (``streaming.refine.keep_mart_current``). The marts of ``marts.CHOSEN_MARTS`` show
the zones or pairs with the highest totals over the whole period, and a batch may change
that choice. Their state is

- ``pair_hours``: shares of the pair-by-hour sums, the base of all of them;
- ``pair_totals``: rides of each pair, one row a pair, replaced by every batch;
- ``<mart>_chosen``: the chosen rows with their labels, and the version since which each is chosen;
- ``<mart>_rows``: shares of the pair hours of chosen keys, with the version that wrote them.

A batch adds its own pair hours. For keys that stay chosen these are all that is new. A key
that enters the choice is rebuilt from the base, which is clustered by pair, so that few row groups are read. A key that leaves only goes
from ``chosen``: readers take rows of chosen keys written since the key's version, so its old rows
count no more, also not if it enters again. They are dropped when shares are combined.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.operators.additive import resum
from curbline.operators.joins import broadcast_bounded
from curbline.operators.layout import clustered
from curbline.plans.marts import CHOSEN_KEYS, CHOSEN_MARTS, PAIR_DIMS, ChosenMart, all_pair_totals, pair_hours
from curbline.sources.lake import FAN, Change, Lake

BASE_KEYS = ("PULocationID", "DOLocationID", "trip_date")


def add_trips(
    lake: Lake, trips: DataFrame, zones: DataFrame, stream: str, batch: int, which: Mapping[str, ChosenMart] = CHOSEN_MARTS, fan: int = FAN
) -> bool:
    """Bring a batch of accepted trips into all marts of ``which``, in one change; False if it was there already."""
    change = lake.change()
    if change.last_batch(stream) >= batch:
        return False
    change.append("pair_hours", clustered(pair_hours(trips), BASE_KEYS))
    delta = lake.spark.read.schema(change.read("pair_hours").schema).parquet(
        f"{lake.root}/{change.state.tables['pair_hours'].shares[-1].folder}"
    )
    totals = all_pair_totals(delta)
    if change.has("pair_totals"):
        totals = all_pair_totals(change.read("pair_totals").unionByName(totals))
    change.replace("pair_totals", totals)
    for name, mart in which.items():
        _choose_again(change, name, mart, delta, zones, fan)
    change.combine("pair_hours", lambda parts: clustered(resum(parts, PAIR_DIMS), BASE_KEYS), fan)
    change.brings(stream, batch)
    change.publish()
    return True


def _keys_of(mart: ChosenMart, chosen: DataFrame) -> dict[str, str]:
    """The columns of ``chosen`` that hold the mart's keys."""
    return {k: next(c for c in CHOSEN_KEYS[k] if c in chosen.columns) for k in mart.keys}


def _only(rows: DataFrame, chosen: DataFrame, mart: ChosenMart, *columns: str) -> DataFrame:
    """Rows of chosen keys, with columns of the choice. The choice is bounded by its rank limits."""
    side = chosen.select(*[F.col(c).alias(k) for k, c in _keys_of(mart, chosen).items()], *columns)
    return rows.join(broadcast_bounded(side), list(mart.keys))


def _choose_again(change: Change, name: str, mart: ChosenMart, delta: DataFrame, zones: DataFrame, fan: int) -> None:
    version = F.lit(change.base + 1).cast("long")
    now = mart.choose(change.read("pair_totals"), zones)
    keys = list(_keys_of(mart, now).values())
    if change.has(f"{name}_chosen"):
        before = change.read(f"{name}_chosen").select(*keys, "since")
        now = now.join(broadcast_bounded(before), keys, "left").withColumn("since", F.coalesce("since", version))
    else:
        now = now.withColumn("since", version)
    change.replace(f"{name}_chosen", now)
    chosen = change.read(f"{name}_chosen")
    stays, enters = chosen.where(F.col("since") < version), chosen.where(F.col("since") == version)
    rows = _only(delta, stays, mart)
    if not enters.isEmpty():
        rows = rows.unionByName(_only(change.read("pair_hours"), enters, mart))
    change.append(f"{name}_rows", resum(rows, PAIR_DIMS).withColumn("version", version))
    change.combine(f"{name}_rows", lambda parts: _together(parts, chosen, mart), fan)


def _together(parts: DataFrame, chosen: DataFrame, mart: ChosenMart) -> DataFrame:
    """Rows that still count, one for each pair and hour, under the version since which their key is chosen."""
    counting = _only(parts, chosen, mart, "since").where(F.col("version") >= F.col("since"))
    columns = [c for c in parts.columns if c != "version"]
    summed = resum(counting.select(*columns, "since"), [*PAIR_DIMS, "since"])
    return summed.select(*columns, F.col("since").alias("version"))


def read_mart(lake: Lake, name: str, zones: DataFrame) -> DataFrame:
    """The mart as the newest version has it."""
    mart, state = CHOSEN_MARTS[name], lake.state()
    chosen = lake.frame(state.tables[f"{name}_chosen"])
    rows = _only(lake.frame(state.tables[f"{name}_rows"]), chosen, mart, "since").where(F.col("version") >= F.col("since"))
    return mart.build(rows.drop("version", "since"), chosen.drop("since"), zones)
