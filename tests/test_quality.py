import pytest
from pyspark.sql import functions as F

from curbline.operators import contracts, enrich, quality
from curbline.plans import tables
from curbline.sources import derived

RULES = quality.trip_rules(2025)


def test_each_row_goes_to_exactly_one_side(spark, sf_dir):
    raw = tables.raw_trips(spark, sf_dir)
    kept, rejected = quality.accepted(raw, RULES), quality.quarantined(raw, RULES)
    assert kept.count() + rejected.count() == raw.count()
    assert kept.exceptAll(quality.with_rejections(raw, RULES)
                          .where(F.size("rejection_reasons") == 0)
                          .drop("rejection_reasons")).count() == 0


def test_unknown_counts_as_broken(spark):
    row = spark.createDataFrame([(None,), (5,)], "x int")
    rule = quality.Rule("x_bad", "x_good", "x > 1")
    listed = quality.with_rejections(row, [rule]).collect()
    assert [r.rejection_reasons for r in listed] == [["x_bad"], []]
    report = quality.expectation_report(row, [rule]).collect()[0]
    assert (report.passed_records, report.failed_records, report.failure_ratio) == (1, 1, 0.5)


def test_no_input_gives_null_sums(spark, sf_dir):
    none = tables.raw_trips(spark, sf_dir).where("false")
    totals = quality.quality_totals(none, RULES).collect()[0]
    assert (totals.total_rows, totals.accepted_rows, totals.quarantined_rows) == (0, None, None)
    metrics = quality.rule_metrics(none, RULES).collect()
    assert len(metrics) == 6
    assert all(m.failed_rows == 0 and m.failure_rate is None for m in metrics)


def test_single_pass_metrics_equal_exploded_counts(spark, sf_dir):
    raw = tables.raw_trips(spark, sf_dir)
    counts = quality.failures_by_rule(quality.quarantined(raw, RULES))
    exploded = {r.rule_name: r.failed_rows for r in counts.collect()}
    metrics = {r.rule_name: r.failed_rows for r in quality.rule_metrics(raw, RULES).collect()}
    assert {k: v for k, v in metrics.items() if v} == exploded


def test_year_is_a_parameter(spark, sf_dir):
    raw = tables.raw_trips(spark, sf_dir)
    other = enrich.accepted_trips(raw, quality.trip_rules(2024))
    years = {r[0] for r in other.select(F.year("trip_date")).distinct().collect()}
    assert years == {2024}


def test_zone_contract_holds_and_breaks(spark):
    zones = derived.zones(spark)
    quality.require(contracts.zone_summary(zones), quality.ZONE_CONTRACT)
    short = contracts.zone_summary(zones.where("location_id <> 7"))
    with pytest.raises(quality.ExpectationFailed):
        quality.require(short, quality.ZONE_CONTRACT)
    unlabelled = zones.withColumn("zone", F.when(F.col("location_id") != 9, F.col("zone")))
    with pytest.raises(quality.ExpectationFailed):
        quality.require(contracts.zone_summary(unlabelled), quality.ZONE_CONTRACT)


def test_guard_stops_the_job(spark, sf_dir):
    raw = tables.raw_trips(spark, sf_dir)
    with pytest.raises(Exception, match="expectation failed"):
        quality.guarded(raw, RULES).agg(F.count(F.lit(1))).collect()


def test_drill_fails_only_on_request(spark):
    updates = spark.createDataFrame([("u1",), ("u2",)], "update_id string")
    assert quality.drill(updates).count() == 2
    with pytest.raises(Exception, match="demo_expectation_must_pass"):
        quality.drill(updates, "expectation").collect()


def test_breach_needs_enough_records(spark):
    report = spark.createDataFrame(
        [("a", 990, 10, 0.01), ("b", 991, 9, 0.009), ("c", 499, 500, 0.5)],
        "expectation string, passed_records bigint, failed_records bigint, failure_ratio double",
    )
    assert [r.expectation for r in quality.breaches(report).collect()] == ["a"]
