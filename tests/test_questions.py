import pytest
from pyspark.sql import functions as F

from tests.rows import fact, plan, tuples, zones
from tripflow.operators import clean, counts, extensions, questions


def test_hotspots_merge_zones_of_one_name(spark):
    trips = fact(
        spark,
        {"pu_loc_id": 56, "pu_zone": "Corona"},
        {"pu_loc_id": 57, "pu_zone": "Corona"},
        {},
        {"pickup_hour": 3},
    )
    assert tuples(questions.q1_hotspots(trips)) == [
        (3, "Queens", "JFK Airport", 1),
        (18, "Queens", "Corona", 2),
        (18, "Queens", "JFK Airport", 1),
    ]


def test_revenue_groups_null_and_unknown_codes_as_other(spark):
    trips = fact(
        spark,
        {"total_amount": 10.004},
        {"total_amount": 10.004, "fare_amount": 21.0},
        {"payment_type": None, "total_amount": 1.0},
        {"payment_type": 6, "total_amount": 2.0},
    )
    assert tuples(questions.q2_revenue_by_borough(trips)) == [
        ("Queens", "Card", 2, 20.01, 20.5, 10.0),
        ("Queens", "Other", 2, 3.0, 20.0, 10.0),
    ]


def test_congestion_filters_threshold_and_mean_of_ratios(spark):
    pair = [{"duration_min": 10.0, "trip_distance": 1.0}, {"duration_min": 10.0, "trip_distance": 4.0}]
    outside = [
        {"duration_min": 0.99}, {"duration_min": 120.01}, {"trip_distance": 0.1}, {"duration_min": None},
    ]
    on_bounds = [{"duration_min": 1.0, "pickup_hour": 5}, {"duration_min": 120.0, "pickup_hour": 5}]
    trips = fact(spark, *pair, *outside, *on_bounds)
    assert tuples(questions.q3_congestion(trips, min_trips=2)) == [
        (5, 132, 7, 2, 60.5, 2.0, 30.25),
        (18, 132, 7, 2, 10.0, 2.5, 6.25),
    ]
    assert tuples(questions.q3_congestion(trips)) == []


def test_congestion_limit_breaks_ties_by_keys(spark):
    trips = fact(spark, *({"pickup_hour": h} for h in (9, 8, 7)))
    top = questions.q3_congestion(trips, min_trips=1, top=2)
    assert [r.pickup_hour for r in top.collect()] == [7, 8]
    assert "TakeOrderedAndProject" in plan(top)
    assert questions.q3_congestion(trips, min_trips=1, top=None).count() == 3


def test_airports_lose_unknown_dropoffs_and_merge_names(spark):
    trips = fact(
        spark,
        {"do_loc_id": 56}, {"do_loc_id": 57, "duration_min": 10.1},
        {"do_loc_id": 999},
        {"pu_loc_id": 1, "do_loc_id": 265},
        {"pu_loc_id": 56},
    )
    assert tuples(questions.q4_airports(trips, zones(spark))) == [
        ("EWR", "Outside of NYC", "N/A", 1, 2.0, 20.0, 10.0, 10.0),
        ("JFK", "Corona", "Queens", 2, 2.0, 20.0, 10.0, 10.1),
    ]


def test_null_payment_counts_as_trip_but_has_no_share(spark):
    trips = fact(spark, {}, {"payment_type": 2}, {"payment_type": 4}, {"payment_type": None})
    assert tuples(questions.q5_payment_share(trips)) == [("Queens", 25.0, 25.0, 25.0, 4)]


def test_busiest_zone_hours(spark):
    trips = fact(spark, {}, {}, {"pickup_hour": 4}, {"pickup_hour": 3})
    got = tuples(questions.busiest_zone_hours(trips, top=2))
    assert got == [(18, "JFK Airport", 2), (3, "JFK Airport", 1)]


def test_sums_agree_across_results(spark):
    trips = fact(spark, *({"payment_type": i % 6, "pickup_hour": i % 24} for i in range(50)))
    per_table = [
        questions.q1_hotspots(trips), questions.q2_revenue_by_borough(trips),
        questions.q5_payment_share(trips), extensions.demand_by_dow(trips),
        extensions.revenue_by_distance(trips), extensions.payment_share_by_zone(trips),
        extensions.monthly_trend(trips),
    ]
    assert [t.agg(F.sum("trips")).collect()[0][0] for t in per_table] == [50] * 7


def test_zone_hours_count_text_rows(spark):
    trips = spark.createDataFrame(
        [
            ("2026-01-01 07:00:00.000000", "132"),
            ("2026-01-02 07:59:00.000000", "132"),
            ("2026-01-02 08:59", "132"),
            ("bad", "132"),
            ("2026-01-02 08:59", "JFK"),
        ],
        "pickup_dt string, pu_loc_id string",
    )
    zone_hours = counts.trips_per_zone_hour(trips)
    assert sorted(tuples(zone_hours)) == [("132", "07", 2), ("132", "08", 1)]
    assert tuples(counts.top_zone_hours(zone_hours, 1)) == [("132", "07", 2)]


def test_zone_hours_from_typed_times_are_the_same(spark):
    text = spark.createDataFrame(
        [("2026-03-08 02:30:00.000000", 1), ("2026-03-08 12:00:00.000000", 1), (None, 1), ("2026-03-08 02:31:00.000000", None)],
        "pickup_dt string, pu_loc_id int",
    )
    typed = text.withColumn("pickup_dt", F.expr("CAST(pickup_dt AS TIMESTAMP_NTZ)"))
    assert sorted(tuples(counts.trips_per_zone_hour(typed))) == [("1", "02", 1), ("1", "12", 1)]
    assert sorted(tuples(counts.trips_per_zone_hour(text))) == [("1", "02", 1), ("1", "12", 1)]
    assert tuples(clean.row_quality(typed)) == tuples(clean.row_quality(text)) == [(2, 2)]


def test_zone_hours_by_name_equal_hotspots(spark, tables):
    from tripflow.plans import catalog
    from tripflow.sources import orderbook

    by_id = catalog.queries()["trips_per_zone_hour"](spark, tables)
    names = orderbook.zones(spark, tables).selectExpr("CAST(location_id AS STRING) AS key", "zone")
    by_name = (
        by_id.join(names, F.expr("key = pu_loc_id"), "left")
        .groupBy(F.expr("CAST(hour AS INT)"), F.expr("coalesce(zone, 'Unknown')"))
        .agg(F.sum("trips"))
    )
    hotspots = catalog.queries()["q1_hotspots"](spark, tables)
    got = hotspots.groupBy("pickup_hour", "pu_zone").agg(F.sum("trips"))
    assert sorted(tuples(by_name)) == sorted(tuples(got))


def test_word_count_takes_whole_texts(spark):
    texts = spark.createDataFrame(
        [("a b\ta\n" + "c " * 20000,), ("  a\r\nb ",), ("",), (None,)], "text string"
    )
    assert sorted(tuples(counts.word_count(texts))) == [("a", 3), ("b", 2), ("c", 20000)]


def test_previews_and_table_counts(spark):
    got = tuples(counts.zone_preview(zones(spark), 2))
    assert [row[0] for row in got] == [1, 7]
    preview = counts.fact_preview(fact(spark, {}, {"pickup_dt": "2020"}), 1)
    assert preview.collect()[0].pickup_dt == "2020"
    n = counts.table_counts({"zones": zones(spark), "it's": zones(spark).limit(2)})
    assert sorted(tuples(n)) == [("it's", 2), ("zones", 7)]


# Extensions ------------------------------------------------------------------


@pytest.mark.parametrize(
    "miles, label",
    [(0.0, "00-01"), (1.0, "01-02"), (4.99, "02-05"), (10.0, "10-20"), (20.0, "20+"), (None, None)],
)
def test_distance_ranges(spark, miles, label):
    frame = spark.createDataFrame([(miles,)], "d double")
    assert tuples(frame.selectExpr(extensions.distance_bucket("d"))) == [(label,)]


def test_out_of_month(spark):
    landed = spark.createDataFrame(
        [("2026-01-31 23:59:59.000000",), ("2026-02-01 00:00:00.000000",), ("junk",)],
        "pickup_dt string",
    ).selectExpr("*", "2026 AS year", "1 AS month")
    assert tuples(extensions.out_of_month(landed)) == [(2026, 1, 3, 2)]
    assert extensions.drop_out_of_month(landed).count() == 1


def test_monthly_trend(spark):
    trips = fact(spark, {}, {}, {"pickup_month": 2}, {"pickup_month": 2}, {"pickup_month": 2})
    got = sorted(tuples(extensions.monthly_trend(trips)))
    assert got == [
        ("Queens", 2026, 1, 2, 50.0, None, None),
        ("Queens", 2026, 2, 3, 75.0, 2, 50.0),
    ]


def test_day_of_week(spark):
    # 5 January 2026 is a Monday.
    assert tuples(extensions.demand_by_dow(fact(spark, {}))) == [(2, 18, 1)]


def test_duplicates_are_reported_not_removed(spark):
    trips = fact(spark, {}, {}, {}, {"pickup_hour": 1}, {"payment_type": None}, {"payment_type": None})
    assert tuples(extensions.duplicate_report(trips)) == [(6, 3, 2, 3)]


def test_the_rollup_gives_the_same_answers(spark, tables):
    from tripflow.functions.exact import Rolled
    from tripflow.operators import enrich, serving
    from tripflow.operators import clean as cleaning
    from tripflow.plans import jobs
    from tripflow.sources import orderbook

    places = orderbook.zones(spark, tables)
    trips = enrich.fact_trips(cleaning.clean_trips(orderbook.raw_trips(spark, tables)), places)
    # Large, wild and missing values keep their ways through the partial sums.
    odd = "CASE WHEN pickup_hour = 3 THEN total_amount * 1.0E10D WHEN pickup_hour = 4 THEN NULL " \
        "WHEN pickup_hour = 5 AND pu_loc_id < 3 THEN DOUBLE('Infinity') ELSE total_amount END"
    trips = trips.withColumn("total_amount", F.expr(odd))
    rolled = questions.rollup(trips)
    airports = orderbook.AIRPORT_ZONES
    plain = jobs.answers(trips, places, airports, 2)
    for name, frame in jobs.answers(rolled, places, airports, 2, Rolled).items():
        want, got = plain[name].collect(), frame.collect()
        assert len(got) == len(want) > 0, name
        if name != "q2_revenue_by_borough":
            assert got == want, name
        for one, other in zip(sorted(got, key=str), sorted(want, key=str)):
            for a, b in zip(one, other):
                assert a == b or a == pytest.approx(b, rel=1e-12), name
    assert sorted(serving.zone_hour_profile(rolled, of=Rolled).collect()) == sorted(
        serving.zone_hour_profile(trips).collect()
    )


# Sort keys of every ordered result: name -> [(column, descending)].
ORDERED = {
    "q1_hotspots": [("pickup_hour", 0), ("trips", 1), ("pu_borough", 0), ("pu_zone", 0)],
    "q2_revenue_by_borough": [("revenue_usd", 1), ("pu_borough", 0), ("payment_method", 0)],
    "q3_congestion": [("trips", 1), ("pickup_hour", 0), ("pu_loc_id", 0), ("do_loc_id", 0)],
    "q4_airports": [("airport", 0), ("trips", 1), ("destination_zone", 0), ("destination_borough", 0)],
    "q5_payment_share": [("trips", 1), ("pu_borough", 0)],
    "q1_preview_hour": [("trips", 1), ("pu_borough", 0), ("pu_zone", 0)],
    "q4_preview_airport": [("trips", 1), ("destination_zone", 0), ("destination_borough", 0)],
    "busiest_zone_hours": [("trips", 1), ("pickup_hour", 0), ("pu_zone", 0)],
    "top20_zone_hours": [("trips", 1), ("pu_loc_id", 0), ("hour", 0)],
    "slowest_pairs": [("min_per_mile", 1), ("pickup_hour", 0), ("pu_loc_id", 0), ("do_loc_id", 0)],
    "congestion_by_hour": [("pickup_hour", 0)],
    "dim_preview": [("location_id", 0)],
    "kv_scan_limit": [("row_key", 0)],
}


def in_order(rows, keys):
    """Whether rows stand in this order; a null comes before every value."""

    def key(row):
        parts = []
        for name, descending in keys:
            value = row[name]
            if isinstance(value, str):
                parts.append((value is not None, value))
            else:
                parts.append((value is not None, -value if descending else value))
        return parts

    return rows == sorted(rows, key=key)


@pytest.mark.parametrize("name", list(ORDERED))
def test_ordered_results_come_in_order(spark, tables, name):
    from tripflow.plans import catalog

    rows = catalog.queries()[name](spark, tables).collect()
    assert len(rows) > 1 and in_order(rows, ORDERED[name])


def test_exported_answers_keep_their_order(spark, tables, tmp_path):
    from tripflow.plans import catalog
    from tripflow.sinks import tables as sinks

    for name in ("q1_hotspots", "q2_revenue_by_borough", "q3_congestion", "q4_airports", "q5_payment_share"):
        result = catalog.queries()[name](spark, tables)
        sinks.export_text(result, str(tmp_path / name), one_file=True)
        (part,) = (tmp_path / name).glob("part-*.csv")
        lines = part.read_text().splitlines()
        assert len(lines) == result.count()
        rows = spark.read.schema(result.schema).option("nullValue", "\\N").csv(str(part)).collect()
        assert in_order(rows, ORDERED[name])
