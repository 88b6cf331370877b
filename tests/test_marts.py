import pytest
from pyspark.sql import functions as F

from curbline.functions import text, trip
from curbline.operators import charts, histograms, profiles, quality, slicing
from curbline.operators.additive import merge_additive
from curbline.operators.ranking import top_k
from curbline.plans import marts, refresh, tables, widgets
from curbline.sources import derived


def same(a, b, digits=6):
    def rounded(df):
        kinds = dict(df.dtypes)
        return df.select(
            *[F.round(c, digits).alias(c) if kinds[c] == "double" else c for c in sorted(kinds)]
        )

    return rounded(a).exceptAll(rounded(b)).count() == rounded(b).exceptAll(rounded(a)).count() == 0


@pytest.fixture(scope="module")
def trips(spark, sf_dir):
    return tables.accepted_trips(spark, sf_dir)


@pytest.fixture(scope="module")
def zones(spark):
    return derived.zones(spark)


@pytest.mark.parametrize("build", [marts.fare_composition, marts.airport_histogram])
def test_marts_of_two_periods_add_up(trips, zones, build):
    cut = F.col("trip_date") < F.lit("2025-05-05").cast("date")
    whole = build(trips, zones)
    dims = [c for c in whole.columns if not c.endswith(("total", "count"))]
    parts = merge_additive(build(trips.where(cut), zones), build(trips.where(~cut), zones), dims)
    assert same(whole, parts)


@pytest.mark.parametrize("name", sorted(marts.MARTS))
def test_slicing_a_mart_equals_slicing_by_parts(spark, sf_dir, name):
    data = tables.mart(spark, sf_dir, name)
    by_hour = [widgets.widget(data, name, slicing.Slice(hours=(h,))) for h in (8, 9)]
    both = widgets.widget(data, name, slicing.Slice(hours=(8, 9)))
    merged = merge_additive(*by_hour, list(widgets.WIDGET_DIMS[name]))
    assert same(both, merged)


def test_empty_selection_keeps_everything(spark, sf_dir):
    data = tables.mart(spark, sf_dir, "fare_ternary")
    assert slicing.Slice().of(data).count() == data.count()


def test_quantiles_are_ordered_and_exact(spark, sf_dir):
    bins = widgets.widget(tables.mart(spark, sf_dir, "airport_quantile"), "airport_quantile")
    by = ["airport", "pickup_hour"]
    fans = histograms.histogram_quantiles(bins, by, "duration_bin_minutes", "bin_trip_count")
    expected = {}
    for row in bins.collect():
        expected.setdefault((row.airport, row.pickup_hour), []).extend(
            [row.duration_bin_minutes] * row.bin_trip_count
        )
    for fan in fans.collect():
        assert fan.p10_minutes <= fan.p25_minutes <= fan.median_minutes <= fan.p75_minutes <= fan.p90_minutes
        values = sorted(expected[fan.airport, fan.pickup_hour])
        middle = next(v for i, v in enumerate(values, 1) if i / len(values) >= 0.5)
        assert (fan.median_minutes, fan.trip_count) == (middle, len(values))


def test_bin_edges(spark):
    frame = spark.createDataFrame([(5.0,), (6.0,), (180.0,), (5.999,)], "m double")
    edges = frame.select(trip.lower_bin_edge(F.col("m"), 2)).collect()
    assert [e[0] for e in edges] == [4, 6, 180, 4]


def test_shares_and_triangle(spark, sf_dir):
    shares = charts.fare_shares(
        widgets.widget(tables.mart(spark, sf_dir, "fare_ternary"), "fare_ternary")
    )
    for p in charts.ternary_coordinates(shares).collect():
        assert abs(p.fare_share + p.tip_share + p.extras_share - 1) < 1e-9
        assert 0 <= p.display_y <= 0.8660255 and 0 <= p.display_x <= 1
        assert p.display_y <= 2 * 0.8660255 * min(p.display_x, 1 - p.display_x) + 1e-6


def test_horizon_bands_rebuild_the_score(spark, sf_dir):
    scored = charts.demand_deviation(
        widgets.widget(tables.mart(spark, sf_dir, "horizon"), "horizon")
    )
    bands = charts.horizon_bands(scored, ["trip_date", "pickup_zone", "pickup_borough"])
    sums = bands.groupBy("trip_date", "pickup_zone", "pickup_borough", "side").agg(
        F.sum("band_value").alias("filled"), F.max("score").alias("score")
    )
    assert sums.where(F.abs(F.col("filled") - F.col("score")) > 1e-9).count() == 0


def test_no_expectation_means_no_deviation(spark):
    row = spark.createDataFrame([(5, 0.0), (9, 1.0)], "trip_count bigint, expected_trip_count double")
    scored = charts.demand_deviation(row).collect()
    assert [r.deviation_score for r in scored] == [0.0, 3.0]


def test_normalized_profile_range(spark, sf_dir):
    ratios = profiles.profile_ratios(
        widgets.widget(tables.mart(spark, sf_dir, "parallel_coordinates"), "parallel_coordinates")
    )
    scaled = profiles.normalized(profiles.with_axis_range(profiles.fold_axes(ratios)))
    low, high = scaled.agg(F.min("norm_value"), F.max("norm_value")).collect()[0]
    assert (low, high) == (0.0, 1.0)


def test_top_k_ties_and_pins(spark):
    rows = spark.createDataFrame(
        [("a", i, score) for i, score in enumerate([5, 5, 5, 3, 1])], "g string, id int, n int"
    )
    picked = top_k(rows, ["g"], "n", 2, ["id"])
    assert sorted(r.id for r in picked.collect()) == [0, 1]
    tied = top_k(rows, ["g"], "n", 2, keep_ties=True)
    assert sorted(r.id for r in tied.collect()) == [0, 1, 2]
    pinned = top_k(rows, ["g"], "n", 1, ["id"], pinned=F.col("id") == 4)
    assert sorted(r.id for r in pinned.collect()) == [0, 4]


def test_unclicked_selection_is_empty_but_highlights_nothing(spark):
    rows = spark.createDataFrame([("x",), ("y",)], "name string")
    assert slicing.select_clicked(rows, "name", []).count() == 0
    assert slicing.highlight_clicked(rows, "name", []).where("is_selected").count() == 0
    assert slicing.highlight_clicked(rows, "name", ["x"]).count() == 2


@pytest.mark.parametrize(
    "value, shown",
    [(0, "0"), (532, "532"), (12345, "12.345k"), (1000, "1k"), (1234567, "1.23457M"),
     (999999600, "1G"), (999999, "999.999k"), (2.5e12, "2.5T")],
)
def test_si_text(spark, value, shown):
    frame = spark.createDataFrame([(float(value),)], "v double")
    assert frame.select(text.si_text(F.col("v"))).collect()[0][0] == shown


@pytest.mark.parametrize("hour, shown", [(0, "12a"), (4, "4a"), (12, "12p"), (20, "8p")])
def test_hour_axis_label(spark, hour, shown):
    frame = spark.createDataFrame([(hour,)], "h int")
    assert frame.select(trip.hour_axis_label(F.col("h"))).collect()[0][0] == shown


def test_one_zone_with_a_third_of_all_trips(spark, sf_dir, trips, zones):
    """A hot pickup zone changes no plan and no total."""
    hot = trips.withColumn(
        "PULocationID",
        F.when(F.xxhash64("tpep_pickup_datetime", "trip_distance") % 3 == 0, 105).otherwise(
            F.col("PULocationID")
        ),
    )
    mart = marts.demand_horizon(hot, zones)
    zone = mart.where("pickup_zone = 'Zone 103'").agg(F.sum("trip_count")).collect()[0][0]
    ids = [r.location_id for r in marts.busiest_city_zones(hot, zones, 2).collect()]
    expected = hot.where(F.col("PULocationID").isin([i for i in ids if i in (103, 104, 105)]))
    assert zone == expected.count()


def test_refresh_publishes_all_tables(spark, sf_dir, tmp_path):
    raw = tables.raw_trips(spark, sf_dir)
    lake = refresh.refresh(spark, raw, derived.zones(spark), str(tmp_path / "lake"))
    counts = {name: lake.read(name).count() for name in lake.tables()}
    assert {name: (t.layer, t.comment) for name, t in lake.tables().items()} == refresh.TABLES
    assert counts["accepted"] + counts["quarantine"] == raw.count()
    assert counts["quality_metrics"] == 6
    metrics = lake.read("quality_metrics")
    assert metrics.where("computed_at IS NOT NULL").drop("computed_at").exceptAll(
        quality.rule_metrics(raw, refresh.quality.trip_rules(2025))
    ).isEmpty()
    for name in marts.MARTS:
        assert same(lake.read(name), tables.mart(spark, sf_dir, name)), name


def test_refresh_reads_raw_trips_once(spark, sf_dir, tmp_path):
    raw, read = tables.raw_trips(spark, sf_dir), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    refresh.refresh(spark, raw.mapInArrow(count, raw.schema), derived.zones(spark), str(tmp_path / "lake"))
    assert read.value == raw.count()


def test_refresh_registers_its_tables(spark, sf_dir, tmp_path):
    raw = tables.raw_trips(spark, sf_dir).limit(500)
    spark.sql("CREATE DATABASE lake_test")
    try:
        refresh.refresh(spark, raw, derived.zones(spark), str(tmp_path / "lake"), database="lake_test")
        for name, (layer, comment) in refresh.TABLES.items():
            described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED lake_test.{name}").collect()}
            assert f"quality={layer}" in described["Table Properties"] and described["Comment"] == comment
        lake = refresh.refresh(spark, raw.limit(100), derived.zones(spark), str(tmp_path / "lake"), database="lake_test")
        assert spark.table("lake_test.accepted").count() == lake.read("accepted").count()
    finally:
        spark.sql("DROP DATABASE lake_test CASCADE")


def test_refresh_publishes_nothing_with_a_broken_dimension(spark, sf_dir, tmp_path):
    raw = tables.raw_trips(spark, sf_dir)
    with pytest.raises(RuntimeError):
        refresh.refresh(
            spark, raw, derived.zones(spark).where("location_id > 1"), str(tmp_path / "lake")
        )
    assert not (tmp_path / "lake").exists()
