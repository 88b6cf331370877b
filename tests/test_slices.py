"""Cuboids, and files that readers skip."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from curbline.operators import cuboids
from curbline.operators.layout import write_clustered, write_z_ordered
from curbline.operators.slicing import Slice
from curbline.plans import catalog, marts, tables, widgets
from curbline.plans.refresh import TRIP_KEYS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, where, label",
    [
        ("fare_ternary", Slice(), "none"),
        ("fare_ternary", Slice(hours=(8,)), "pickup_hour"),
        ("fare_ternary", Slice(boroughs=("Queens",)), "none"),
        ("fare_ternary", Slice(first_date="2025-10-01"), "trip_date"),
        ("fare_ternary", Slice(hours=(8,), last_date="2025-10-01"), "pickup_hour+trip_date"),
        ("airport_quantile", Slice(hours=(8,)), "none"),
        ("directional_flow", Slice(airport_flags=("Airport",)), "airport_flag"),
        ("horizon", widgets.SCENARIO, "pickup_hour+airport_flag"),
    ],
)
def test_a_slice_reads_the_smallest_cuboid_with_its_fields(spark, sf_dir, name, where, label):
    path, dims, sums = tables.cube(spark, sf_dir, name), widgets.WIDGET_DIMS[name], widgets.WIDGET_SUMS[name]
    found = cuboids.sliced(spark, path, dims, sums, where)
    assert f"(cuboid#" in plan(found) and f" = {label})" in plan(found)
    sizes = {c.label: c.rows for c in cuboids.read_sizes(spark, path)}
    full = max(sizes, key=lambda c: len(c.split("+")) if c != "none" else 0)
    assert sizes[label] <= sizes[full]
    expected = widgets.widget(catalog.dataset(spark, sf_dir, name), name, where)
    rounded = [[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes] for df in (found, expected)]
    one, other = found.select(*rounded[0]), expected.select(*rounded[1])
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_all_datasets_have_a_lattice(spark, sf_dir):
    for name in marts.MARTS:
        free = [f for f in widgets.FILTER_FIELDS if f not in widgets.WIDGET_DIMS[name]]
        labels = {c.label for c in cuboids.read_sizes(spark, tables.cube(spark, sf_dir, name))}
        assert labels == {cuboids.label_of(s) for s in cuboids.lattice(free)}


def row_groups(path, column, value):
    """Row groups whose statistics admit a value, and all of them."""
    hit = every = 0
    for file in glob.glob(f"{path}/*.parquet"):
        about = pq.ParquetFile(file).metadata
        at = about.schema.names.index(column)
        for group in range(about.num_row_groups):
            known = about.row_group(group).column(at).statistics
            every += 1
            hit += known.min <= value <= known.max
    return hit, every


def test_a_filter_on_any_key_skips_most_row_groups(spark, sf_dir, tmp_path):
    trips = tables.accepted_trips(spark, sf_dir)
    trips = trips.withColumn("DOLocationID", F.pmod(F.xxhash64("tpep_pickup_datetime"), F.lit(263)).cast("int"))
    trips.write.parquet(str(tmp_path / "trips"))
    trips = spark.read.parquet(str(tmp_path / "trips"))
    by_date, curve = str(tmp_path / "by-date"), str(tmp_path / "curve")
    write_clustered(trips, by_date, TRIP_KEYS, partitions=250)
    write_z_ordered(trips, curve, TRIP_KEYS, partitions=250)
    before, after = (sum(row_groups(p, "DOLocationID", v)[0] for v in range(0, 263, 13)) for p in (by_date, curve))
    assert after < before / 4
    dates = [row_groups(curve, "PULocationID", v) for v in (20, 132, 200)]
    assert all(hit < every / 2 for hit, every in dates)
    assert spark.read.parquet(curve).exceptAll(trips).isEmpty() and spark.read.parquet(curve).count() == trips.count()


def test_odd_values_have_a_place_on_the_curve(spark, tmp_path):
    rows = spark.sql(
        "SELECT * FROM VALUES (1, date'2025-01-01', 1.5D), (NULL, NULL, NULL), (1, date'2025-01-01', 1.5D), (7, date'1960-01-01', -2D) AS t(a, b, c)"
    )
    write_z_ordered(rows, str(tmp_path / "odd"), ["a", "b", "c"])
    assert spark.read.parquet(str(tmp_path / "odd")).exceptAll(rows).isEmpty()
    write_z_ordered(rows.where("a > 100"), str(tmp_path / "none"), ["a", "b"])
    assert spark.read.parquet(str(tmp_path / "none")).isEmpty()
    with pytest.raises(ValueError):
        write_z_ordered(rows.withColumn("d", F.lit("x")), str(tmp_path / "text"), ["d"])
