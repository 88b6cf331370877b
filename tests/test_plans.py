"""Properties of physical plans that matter at scale."""

import re

import pytest

from curbline.operators import enrich, quality
from curbline.operators.flow_timings import with_flow_timings
from curbline.plans import catalog, marts, tables
from curbline.sources import derived


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def trips(spark, sf_dir):
    return tables.accepted_trips(spark, sf_dir)


@pytest.mark.parametrize("name", sorted(marts.MARTS))
def test_marts_never_shuffle_or_pair_up_raw_trips(spark, trips, name):
    shown = plan(marts.MARTS[name](trips, derived.zones(spark)))
    assert "Cartesian" not in shown and "NestedLoop" not in shown
    assert "SortMergeJoin" not in shown
    assert "partial_" in shown


@pytest.mark.parametrize(
    "build, limit", [(marts.directional_flow, 20), (marts.operating_profile, 5), (marts.demand_horizon, 2)]
)
def test_rankings_prune_before_the_shuffle(spark, trips, build, limit):
    assert re.search(rf"WindowGroupLimit .* {limit}, Partial", plan(build(trips, derived.zones(spark))))


def test_scans_read_only_needed_columns(spark, trips):
    shown = plan(marts.demand_horizon(trips, derived.zones(spark)))
    columns = set(re.findall(r"ReadSchema: struct<([^>]*)>", shown))
    assert columns and all("fare_amount" not in c and "tip_amount" not in c for c in columns)


def test_rule_bounds_reach_the_scan(spark, sf_dir):
    raw = tables.raw_trips(spark, sf_dir)
    accepted = enrich.accepted_trips(raw, quality.trip_rules(2025))
    execution = accepted._jdf.queryExecution()
    shown = spark._jvm.PythonSQLUtils.explainString(execution, "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", shown).group(1)
    for bound in ("GreaterThanOrEqual(trip_distance", "LessThanOrEqual(total_amount", "PULocationID"):
        assert bound in pushed


def test_flow_events_are_finished_without_a_shuffle_of_their_own(spark, sf_dir):
    """Only first runs meet the carried clocks; the rest of a folded range is read as it is."""
    shown = plan(with_flow_timings(tables.events(spark, sf_dir)).select("event_id", "observed_duration_seconds"))
    by_flow_only = re.findall(r"hashpartitioning\(pipeline_id#\d+, update_id#\d+, flow_name#\d+, \d+\)", shown)
    assert len(by_flow_only) <= 1 and "rangepartitioning" not in shown
    assert re.search(r"Filter .*NOT .*__run#\d+", shown)


@pytest.mark.parametrize("key", ["dq_metrics", "expect_all_report", "quality_totals"])
def test_reports_take_one_pass(spark, sf_dir, key):
    assert plan(catalog.QUERIES[key](spark, sf_dir)).count("FileScan") == 1
