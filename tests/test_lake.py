"""Versions of tables, shares and their generations, and marts kept up to date."""

import json

import pytest
from pyspark.sql import functions as F

from curbline.operators import quality
from curbline.operators.additive import resum
from curbline.plans import marts, refresh, tables, upkeep
from curbline.session import new_work_dir
from curbline.sources import derived, storage
from curbline.sources.lake import ConcurrentChange, Lake

RULES = quality.trip_rules(2025)


@pytest.fixture
def lake(spark):
    return Lake(spark, f"{new_work_dir(spark, 'lake-test')}/tables")


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def held(frame):
    return sorted(r.n for r in frame.collect())


def test_a_change_is_seen_whole_or_not_at_all(spark, lake):
    first = lake.change()
    first.replace("a", numbers(spark, 1), "silver", "first")
    first.replace("b", numbers(spark, 2))
    assert lake.tables() == {}
    first.publish()
    second = lake.change()
    second.replace("a", numbers(spark, 10))
    reading = lake.read("a")
    assert (held(lake.read("a")), held(second.read("a"))) == ([1], [10])
    second.replace("b", numbers(spark, 20))
    second.publish()
    assert (held(lake.read("a")), held(lake.read("b")), held(lake.read("a", version=1)), held(reading)) == ([10], [20], [1], [1])
    assert lake.tables()["a"].comment == "" and lake.state(1).tables["a"].layer == "silver"


def test_of_two_changes_from_one_state_the_later_fails(spark, lake):
    one, other = lake.change(), lake.change()
    one.replace("a", numbers(spark, 1))
    other.replace("a", numbers(spark, 2))
    one.publish()
    with pytest.raises(ConcurrentChange):
        other.publish()
    assert held(lake.read("a")) == [1]


def test_a_manifest_that_was_cut_off_counts_as_none(spark, lake):
    change = lake.change()
    change.replace("a", numbers(spark, 1))
    change.publish()
    storage.create(spark, f"{lake.root}/_manifests/0000000002.json", '{"version": 2, "tab')
    assert held(lake.read("a")) == [1]


def test_old_versions_are_removed_later(spark, lake):
    for value in range(5):
        change = lake.change()
        change.replace("a", numbers(spark, value))
        if value == 0:
            change.replace("kept", numbers(spark, 7))
        change.publish()
    lake.expire(keep=2)
    assert lake.versions() == [4, 5] and len(storage.names(spark, f"{lake.root}/a")) == 2
    assert (held(lake.read("a")), held(lake.read("a", 4)), held(lake.read("kept"))) == ([4], [3], [7])


@pytest.mark.parametrize("fan", [2, 4])
def test_shares_grow_into_generations(spark, lake, fan):
    for batch in range(21):
        change = lake.change()
        change.append("sums", spark.createDataFrame([("x", batch), (str(batch), 1)], "k string, n long"))
        change.combine("sums", lambda parts: resum(parts, ["k"]), fan)
        change.publish()
        shares = lake.tables()["sums"].shares
        per = [sum(s.generation == g for s in shares) for g in range(6)]
        assert max(per) < fan
        assert sum(n * fan**g for g, n in enumerate(per)) == batch + 1
    rows = {r.k: r.n for r in resum(lake.read("sums"), ["k"]).collect()}
    assert rows == {"x": sum(range(21)), **{str(b): 1 for b in range(21)}}


def test_shares_of_other_columns_are_refused(spark, lake):
    change = lake.change()
    change.append("a", numbers(spark, 1))
    with pytest.raises(ValueError):
        change.append("a", spark.createDataFrame([("x",)], "n string"))


def test_a_refresh_that_fails_between_tables_changes_nothing(spark, sf_dir, lake, monkeypatch):
    raw, zones = tables.raw_trips(spark, sf_dir), derived.zones(spark)
    refresh.refresh(spark, raw.limit(2000), zones, lake.root)
    before = {name: lake.read(name).count() for name in lake.tables()}

    def fail(*args):
        raise ValueError("broken on purpose")

    monkeypatch.setitem(refresh.MARTS, "fare_ternary", fail)
    with pytest.raises(ValueError, match="broken on purpose"):
        refresh.refresh(spark, raw, zones, lake.root)
    assert lake.versions() == [1] and {name: lake.read(name).count() for name in lake.tables()} == before
    monkeypatch.undo()
    refresh.refresh(spark, raw, zones, lake.root)
    assert lake.state().version == 2 and lake.read("accepted").count() > before["accepted"]


# --- marts of the busiest zones and pairs -------------------------------------------------


def batches(spark, sf_dir, count=10):
    """Trips whose busy zones move from batch to batch."""
    trips = tables.accepted_trips(spark, sf_dir)
    number = F.pmod(F.xxhash64("tpep_pickup_datetime", "total_amount"), F.lit(count))
    moved = F.when(F.col("DOLocationID") % 2 == 0, F.pmod(F.col("PULocationID") * (number + 3).cast("int"), F.lit(263)) + 1).otherwise(F.col("PULocationID"))
    moving = trips.withColumn("part", number).withColumn("PULocationID", moved.cast("int"))
    path = f"{new_work_dir(spark, 'batches')}/trips"
    moving.write.partitionBy("part").parquet(path)
    return [spark.read.parquet(f"{path}/part={n}").select(*trips.columns) for n in range(count)]


def rounded(frame):
    shown = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in frame.dtypes]
    return frame.select(*sorted(frame.columns)).select(*[s for _, s in sorted(zip(frame.columns, shown), key=lambda p: p[0])])


def test_chosen_marts_equal_a_rebuild(spark, sf_dir, lake):
    zones, so_far, chosen = derived.zones(spark), None, set()
    for number, batch in enumerate(batches(spark, sf_dir)):
        assert upkeep.add_trips(lake, batch, zones, "trips", number)
        so_far = batch if so_far is None else so_far.unionByName(batch)
        chosen.add(tuple(sorted((r.origin_id, r.destination_id) for r in lake.read("od_connection_chosen").collect())))
        if number in (4, 9):
            for name in marts.CHOSEN_MARTS:
                expected, got = rounded(marts.MARTS[name](so_far, zones)), rounded(upkeep.read_mart(lake, name, zones))
                assert expected.exceptAll(got).isEmpty() and got.exceptAll(expected).isEmpty(), name
    assert len(chosen) > 5  # the choice has changed again and again
    assert all(len(t.shares) <= 6 for t in lake.tables().values())


def test_a_batch_brought_twice_counts_once(spark, sf_dir, lake):
    zones, (one, two, *_) = derived.zones(spark), batches(spark, sf_dir)
    only = {"horizon": marts.CHOSEN_MARTS["horizon"]}
    assert upkeep.add_trips(lake, one, zones, "trips", 0, only)
    assert upkeep.add_trips(lake, two, zones, "trips", 1, only)
    assert not upkeep.add_trips(lake, two, zones, "trips", 1, only)
    assert lake.read("pair_totals").agg(F.sum("pair_trips")).first()[0] == one.count() + two.count()
    assert json.loads(lake.state().text())["batches"] == {"trips": 1}
