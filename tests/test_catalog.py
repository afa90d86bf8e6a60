"""Every registered query against its oracle, and the shape of its plan."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from plumeline import catalog
from plumeline.plans import serving
from tests.oracle import connect, mismatch

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.queries(), catalog.oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    assert mismatch(QUERIES[name](spark, SF), duck, ORACLES[name]) is None


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_the_entry_registers_the_catalog():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_or_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in text


@pytest.mark.parametrize(
    "name", ["latest_station", "api_map_latest", "batch_winner", "rebuild_current", "staging_union_dedupe", "manifest_upsert"]
)
def test_ranking_prunes_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(QUERIES["station_totals"](spark, SF))
    lineitem = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    schema = lineitem.split("ReadSchema: ")[1]
    assert "l_quantity" not in schema and "l_orderkey" not in schema
    assert "l_returnflag" in lineitem.split("DataFilters: ")[1].split("]")[0]


def test_coverage_reads_the_fact_once(spark):
    df = QUERIES["region_coverage"](spark, SF)
    df.collect()
    text = plan(df)
    final = text.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("lineitem.parquet") <= 1


def test_page_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["api_latest"](spark, SF))


def test_a_page_has_an_envelope(spark):
    items = QUERIES["api_latest"](spark, SF)
    row = serving.envelope(items, 100, 0).first()
    assert (row["limit"], row["offset"], row["count"]) == (100, 0, items.count())
    assert [r.natural_key for r in row["items"]] == [r.natural_key for r in items.collect()]
    assert serving.envelope(items.limit(0), 100, 5).first()["count"] == 0


@pytest.mark.parametrize("name", ["region_day_average", "anomaly_spikes"])
def test_regions_join_after_the_first_grouping(spark, name):
    # read from the scan upwards: the fact is grouped before it meets the locations
    logical = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    fact = next(i for i, line in enumerate(logical) if "l_quantity" in line and "Relation" in line)
    joins = [i for i, line in enumerate(logical[:fact]) if "Join Inner, (location_id" in line]
    groups = [i for i, line in enumerate(logical[:fact]) if "Aggregate [location_id" in line]
    assert groups and max(groups) > min(joins)
