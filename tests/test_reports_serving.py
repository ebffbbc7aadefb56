import json

import pytest
from pyspark.sql import functions as F

from tests.rows import fact, plan, tuples, zones
from tripflow.operators import questions, reports, serving
from tripflow.schema import RESULT_SCHEMAS

# The published revenue table (borough, method, trips, revenue,
# mean fare, mean tip percentage) and payment share table of the first quarter.
REVENUE = [
    ("Manhattan", "Card", 5996818, 1.4647820673e8, 15.33, 26.18),
    ("Queens", "Card", 611861, 4.765344973e7, 55.7, 20.21),
    ("Manhattan", "Cash", 745754, 1.495282101e7, 14.71, 0.0),
    ("Queens", "Cash", 136864, 7205355.95, 45.04, 0.0),
    ("Brooklyn", "Card", 146612, 4994073.75, 31.85, 3.43),
    ("Bronx", "Card", 54812, 2220193.37, 37.99, 0.55),
    ("Manhattan", "Dispute", 48410, 1000005.05, 15.09, 0.0),
    ("Queens", "Dispute", 13433, 790325.82, 50.3, 0.01),
    ("Manhattan", "NoCharge", 19577, 378288.07, 13.87, 0.01),
    ("Unknown", "Card", 9423, 304434.3, 21.4, 25.27),
    ("Queens", "NoCharge", 3692, 192503.63, 44.16, 0.0),
    ("N/A", "Card", 1534, 147212.94, 81.16, 17.58),
    ("Brooklyn", "Cash", 5720, 146456.81, 21.82, 0.01),
    ("Bronx", "Cash", 1636, 41063.71, 22.11, 0.0),
    ("Unknown", "Cash", 1435, 38770.05, 21.52, 0.01),
    ("EWR", "Card", 320, 35147.45, 93.69, 11.2),
    ("N/A", "Cash", 312, 18685.64, 55.26, 0.0),
    ("Brooklyn", "Dispute", 460, 13981.79, 26.7, 0.09),
    ("Brooklyn", "NoCharge", 231, 5821.81, 22.23, 0.0),
    ("Staten Island", "Card", 93, 5746.63, 54.24, 32.69),
    ("N/A", "Dispute", 53, 4131.62, 72.82, 0.0),
    ("Staten Island", "Cash", 165, 3148.59, 6.49, 0.0),
    ("N/A", "NoCharge", 42, 2660.47, 57.86, 0.0),
    ("Unknown", "NoCharge", 96, 2288.68, 18.28, 0.0),
    ("Unknown", "Dispute", 66, 2118.24, 26.38, 0.48),
    ("Bronx", "Dispute", 99, 2053.12, 18.12, 0.0),
    ("EWR", "Cash", 15, 1250.34, 80.92, 0.0),
    ("Bronx", "NoCharge", 61, 996.01, 13.86, 0.6),
    ("EWR", "NoCharge", 1, 145.0, 144.0, 0.0),
    ("Staten Island", "Dispute", 3, 112.2, 34.73, 0.0),
    ("Staten Island", "NoCharge", 2, 95.85, 44.3, 0.0),
]
SHARES = [
    ("Manhattan", 88.05, 10.95, 1.0, 6810559),
    ("Queens", 79.89, 17.87, 2.24, 765850),
    ("Brooklyn", 95.81, 3.74, 0.45, 153023),
    ("Bronx", 96.83, 2.89, 0.28, 56608),
    ("Unknown", 85.51, 13.02, 1.47, 11020),
    ("N/A", 79.03, 16.07, 4.89, 1941),
    ("EWR", 95.24, 4.46, 0.3, 336),
    ("Staten Island", 35.36, 62.74, 1.9, 263),
]


@pytest.fixture(scope="module")
def revenue(spark):
    return spark.createDataFrame(REVENUE, RESULT_SCHEMAS["q2_revenue_by_borough"])


@pytest.fixture(scope="module")
def shares(spark):
    return spark.createDataFrame(SHARES, RESULT_SCHEMAS["q5_payment_share"])


def test_published_headline_figures(revenue):
    row = reports.kpi_summary(revenue).collect()[0]
    assert row.total_trips == 7799600
    assert (row.revenue_usd, row.revenue_musd) == (226641544.36, 226.64)
    assert (row.avg_fare, row.avg_tip_pct) == (40.71, 4.46)
    weighted = sum(r[2] * r[4] for r in REVENUE) / 7799600
    assert row.weighted_avg_fare == round(weighted, 2)


def test_published_tables_agree_with_each_other(revenue, shares):
    by_borough = {r[0]: r[1] for r in tuples(revenue.groupBy("pu_borough").agg(F.sum("trips")))}
    assert by_borough == {r[0]: r[4] for r in SHARES}
    card = {r[0]: r[2] for r in REVENUE if r[1] == "Card"}
    for borough, pct_card, *_, trips in SHARES:
        assert round(card[borough] * 100 / trips, 2) == pct_card


def test_published_shares_rebuilt_from_trips(spark, shares):
    """The share question over as many trips as the smallest published boroughs had."""
    codes = {"Card": 1, "Cash": 2, "NoCharge": 3, "Dispute": 4}
    groups = [(b, codes[m], n) for b, m, n, *_ in REVENUE if b in ("Staten Island", "EWR", "N/A")]
    trips = spark.createDataFrame(groups, "pu_borough string, payment_type int, n int").selectExpr(
        "pu_borough", "payment_type", "explode(sequence(1, n))"
    )
    assert tuples(questions.q5_payment_share(trips)) == [SHARES[5], SHARES[6], SHARES[7]]


def test_shares_become_long(shares):
    tall = reports.payment_share_long(shares)
    assert tall.columns == ["pu_borough", "trips", "method", "pct"]
    got = [r for r in tuples(tall) if r[0] == "EWR"]
    assert sorted(got) == [("EWR", 336, "Card", 95.24), ("EWR", 336, "Cash", 4.46), ("EWR", 336, "Other", 0.3)]
    sums = tall.groupBy("pu_borough").agg(F.sum("pct").alias("s")).collect()
    assert all(abs(r.s - 100) <= 0.011 for r in sums)


def test_revenue_pivot(revenue):
    row = {r.pu_borough: r for r in reports.revenue_pivot(revenue).collect()}["EWR"]
    assert (row.Card, row.Cash, row.NoCharge, row.Dispute, row.Other) == (35147.45, 1250.34, 145.0, None, None)


def test_top_zones_of_each_hour(spark):
    rows = [(h, "B", f"z{i:02d}", 100 - i // 2) for h in (0, 1) for i in range(14)]
    hotspots = spark.createDataFrame(rows, RESULT_SCHEMAS["q1_hotspots"])
    top = reports.hotspots_top_per_hour(hotspots)
    assert top.count() == 20
    assert {r.pu_zone for r in top.collect()} == {f"z{i:02d}" for i in range(10)}
    text = plan(top)
    assert text.count("WindowGroupLimit") >= 2, "groups must be cut before the shuffle"
    assert [r.pu_zone for r in reports.hotspots_at(hotspots, 1, 3).collect()] == ["z00", "z01", "z02"]


def test_congestion_reports(spark):
    rows = [(7, 1, 2, 50, 9.0, 1.0, 10.0), (7, 1, 3, 40, 9.0, 1.0, 5.0), (8, 1, 2, 30, 9.0, 1.0, 10.0)]
    pairs = spark.createDataFrame(rows, RESULT_SCHEMAS["q3_congestion"])
    assert tuples(reports.congestion_by_hour(pairs)) == [(7, 7.5), (8, 10.0)]
    assert [(r.pickup_hour, r.do_loc_id) for r in reports.slowest_pairs(pairs, 2).collect()] == [(7, 2), (8, 2)]


def test_airport_destinations(spark):
    rows = [("JFK", f"z{i:02d}", "B", 50 - i, 1.0, 1.0, 1.0, 1.0) for i in range(20)]
    rows += [("LGA", "z00", "B", 5, 1.0, 1.0, 1.0, 1.0)]
    table = spark.createDataFrame(rows, RESULT_SCHEMAS["q4_airports"])
    top = reports.airport_top_destinations(table).collect()
    assert len([r for r in top if r.airport == "JFK"]) == 15
    assert sum(r.charted for r in top) == 11
    assert [r.destination_zone for r in reports.destinations_from(table, "JFK", 2).collect()] == ["z00", "z01"]


# Serving -----------------------------------------------------------------------


def test_zone_lookup_gets_and_scans(spark):
    table = serving.zone_lookup(zones(spark))
    assert table.schema["info"].dataType.fieldNames() == ["borough", "zone_name", "service_zone"]
    assert tuples(serving.get(table, "132").select("row_key", "info.*")) == [
        ("132", "Queens", "JFK Airport", "Airports")
    ]
    assert tuples(serving.get(table, "999")) == []
    assert tuples(serving.scan_equals(table, "info", "borough", "EWR")) == [("1", "EWR")]
    assert [r.row_key for r in serving.scan_first(table, 4).collect()] == ["1", "132", "264", "265"]


def test_point_get_is_pushed_to_the_file(spark, tmp_path):
    path = str(tmp_path / "zones")
    serving.zone_lookup(zones(spark)).sort("row_key").write.parquet(path)
    assert "PushedFilters: [In(row_key, [1,132])]" in plan(
        serving.get(spark.read.parquet(path), "1", "132")
    )


def test_last_put_wins(spark):
    puts = spark.createDataFrame(
        [("a", 1, "first"), ("a", 3, "last"), ("a", 2, "middle"), ("b", 1, "only"), (None, 9, "no key")],
        "row_key string, seq int, value string",
    )
    got = serving.last_write_wins(puts, ["seq"]).select("row_key", "value")
    assert sorted(tuples(got)) == [("a", "last"), ("b", "only")]


def test_upsert_replaces_even_with_a_smaller_value(spark):
    table = spark.createDataFrame([("a", "z"), ("b", "z")], "row_key string, v string")
    puts = spark.createDataFrame([("a", "a"), ("c", None)], "row_key string, v string")
    got = sorted(tuples(serving.upsert(table, puts)), key=str)
    assert got == [("a", "a"), ("b", "z"), ("c", None)]


def test_a_put_sets_its_cells_and_leaves_the_others(spark):
    cells = "struct<x:string,y:string>"
    table = spark.createDataFrame([("a", ("x", "y")), ("b", ("x", None))], f"row_key string, f {cells}")
    puts = spark.createDataFrame(
        [("a", 2, ("z", None)), ("a", 1, ("w", "v")), ("b", 1, (None, "n")), ("c", 1, None)],
        f"row_key string, seq int, f {cells}",
    )
    got = serving.upsert(table, puts, ["seq"]).selectExpr("row_key", "f.x", "f.y")
    assert sorted(tuples(got)) == [("a", "z", "v"), ("b", "x", "n"), ("c", None, None)]


def test_families_can_be_put_apart(spark):
    one = spark.createDataFrame([("a", (1,))], "row_key string, stats struct<n:int>")
    other = spark.createDataFrame([("a", ("[]",)), ("b", ("[1]",))], "row_key string, top struct<z:string>")
    stored = serving.upsert(one, other).selectExpr("row_key", "stats.n", "top.z")
    assert sorted(tuples(stored)) == [("a", 1, "[]"), ("b", None, "[1]")]
    again = serving.upsert(serving.upsert(other, one), one).selectExpr("row_key", "stats.n", "top.z")
    assert sorted(tuples(again)) == sorted(tuples(stored))


def test_kpis_of_very_large_groups(spark):
    groups = spark.createDataFrame(
        [("A", "Card", 10**10, 1.2e11, 12.0, 20.0), ("B", "Cash", 10**6, 2.0e7, 20.0, None)],
        "pu_borough string, payment_method string, trips long, revenue_usd double, "
        "avg_fare double, avg_tip_pct double",
    )
    row = reports.kpi_summary(groups).first()
    assert (row.total_trips, row.revenue_usd) == (10**10 + 10**6, 120_020_000_000.0)
    assert (row.revenue_musd, row.weighted_avg_fare) == (120_020.0, 12.0)


def test_trip_by_zone_keys_and_collisions(spark):
    rows = [
        (7, "Queens", "JFK Airport", 12),
        (7, "Bronx", "East Side", 9),
        (7, "Queens", "East_Side", 4),
        (17, "Queens", "JFK Airport", 3),
    ]
    hotspots = spark.createDataFrame(rows, RESULT_SCHEMAS["q1_hotspots"])
    got = {r.row_key: tuple(r.stats) for r in serving.trip_by_zone(hotspots).collect()}
    assert got == {
        "JFK_Airport_07": ("12", "Queens", "JFK Airport"),
        "East_Side_07": ("4", "Queens", "East_Side"),
        "JFK_Airport_17": ("3", "Queens", "JFK Airport"),
    }


def test_zone_hour_profile(spark):
    trips = fact(spark, *({"do_loc_id": d} for d in (1, 1, 1, 2, 2, 3, 4, 5, 6)))
    row = serving.zone_hour_profile(trips).collect()[0]
    assert row.row_key == "132_18"
    assert tuple(row.stats) == (9, 20.0, 10.0, 10.0)
    assert json.loads(row.top_do.zones) == [
        {"rank": 1, "do_loc_id": 1, "trips": 3},
        {"rank": 2, "do_loc_id": 2, "trips": 2},
        {"rank": 3, "do_loc_id": 3, "trips": 1},
        {"rank": 4, "do_loc_id": 4, "trips": 1},
        {"rank": 5, "do_loc_id": 5, "trips": 1},
    ]
