"""Every registered query against its SQL oracle."""

import pytest

duckdb = pytest.importorskip("duckdb")

from tools.check_queries import compare, connect  # noqa: E402
from tripflow.operators import joins  # noqa: E402
from tripflow.plans import catalog, oracle  # noqa: E402


@pytest.fixture(scope="module")
def con(tables):
    return connect(tables)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_agrees(spark, con, tables, name):
    good, note = compare(spark, con, name, tables)
    assert good, note


@pytest.mark.parametrize("name", ["clean_trips", "q1_hotspots", "q4_airports", "kv_top_dropoffs"])
def test_query_agrees_without_broadcast(spark, con, tables, conf, monkeypatch, name):
    monkeypatch.setattr(joins, "MAX_ROWS", 0)
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    good, note = compare(spark, con, name, tables)
    assert good, note


@pytest.mark.parametrize(
    "name", ["enrich_trips", "out_of_month", "demand_by_dow", "stream_hourly_counts"]
)
def test_query_agrees_in_another_session_zone(spark, con, tables, conf, name):
    conf(spark__sql__session__timeZone="America/New_York")
    good, note = compare(spark, con, name, tables)
    assert good, note


@pytest.mark.parametrize("name", ["clean_trips", "q2_revenue_by_borough", "mr_row_quality"])
def test_query_agrees_without_ansi_mode(spark, con, tables, conf, name):
    conf(spark__sql__ansi__enabled="false")
    good, note = compare(spark, con, name, tables)
    assert good, note


def test_entry_runs(spark, tables):
    import __spark_entry__ as entry

    result = entry.entry(spark)
    assert result.columns == ["pickup_hour", "pu_borough", "pu_zone", "trips"]
    assert result.agg({"trips": "sum"}).collect()[0][0] == 3333
