"""Physical plans over stored tables: what is read, shuffled and broadcast."""

import re

import pytest

from tests.rows import fact, plan, raw, zones
from tripflow.operators import clean, counts, enrich, extensions, questions, reports, serving


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    fact(spark, {}, {"pickup_hour": 3}).write.parquet(f"{root}/fact")
    raw(spark, {}, {"pu_loc_id": 132}).write.parquet(f"{root}/trips")
    zones(spark).coalesce(1).write.parquet(f"{root}/zones")
    return {name: spark.read.parquet(f"{root}/{name}") for name in ("fact", "trips", "zones")}


def shuffles(df) -> list[str]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"(?<!Broadcast)Exchange (\w+)", text)


def read_columns(df) -> list[set[str]]:
    return [
        set(re.findall(r"(\w+):", columns))
        for columns in re.findall(r"ReadSchema: struct<([^\n]*)>", plan(df))
    ]


@pytest.mark.parametrize(
    "build, expected",
    [
        (lambda s: clean.clean_trips(s["trips"]), []),
        (lambda s: enrich.fact_trips(s["trips"], s["zones"]), []),
        (lambda s: clean.quality_by_rule(s["trips"]), ["SinglePartition"]),
        (lambda s: counts.trips_per_zone_hour(s["trips"]), ["hashpartitioning"]),
        (lambda s: questions.hotspots(s["fact"]), ["hashpartitioning"]),
        (lambda s: questions.q1_hotspots(s["fact"]), ["rangepartitioning", "hashpartitioning"]),
        (lambda s: questions.q2_revenue_by_borough(s["fact"]), ["rangepartitioning", "hashpartitioning"]),
        (lambda s: questions.q3_congestion(s["fact"]), ["hashpartitioning"]),
        (lambda s: questions.airport_destinations(s["fact"], s["zones"]), ["hashpartitioning"]),
        (lambda s: questions.payment_share(s["fact"], "pu_borough"), ["hashpartitioning"]),
        (lambda s: questions.busiest_zone_hours(s["fact"]), ["hashpartitioning"]),
        (lambda s: reports.hotspots_at(questions.hotspots(s["fact"])), ["hashpartitioning"]),
        (lambda s: serving.zone_hour_stats(s["fact"]), ["hashpartitioning"]),
        # Pairs are counted by three keys, then ranked by two of them.
        (lambda s: serving.top_dropoffs(s["fact"]), ["hashpartitioning", "hashpartitioning"]),
        (lambda s: extensions.demand_by_dow(s["fact"]), ["hashpartitioning"]),
    ],
)
def test_shuffles(stored, build, expected):
    assert shuffles(build(stored)) == expected


@pytest.mark.parametrize(
    "build, columns",
    [
        (lambda s: questions.q1_hotspots(s["fact"]), {"pickup_hour", "pu_borough", "pu_zone"}),
        (lambda s: questions.q5_payment_share(s["fact"]), {"pu_borough", "payment_type"}),
        (lambda s: counts.trips_per_zone_hour(s["trips"]), {"pickup_dt", "pu_loc_id"}),
        (lambda s: serving.top_dropoffs(s["fact"]), {"pu_loc_id", "pickup_hour", "do_loc_id"}),
        (
            lambda s: questions.q3_congestion(s["fact"]),
            {"pickup_hour", "pu_loc_id", "do_loc_id", "duration_min", "trip_distance"},
        ),
    ],
)
def test_only_needed_columns_are_read(stored, build, columns):
    assert read_columns(build(stored)) == [columns]


def test_filters_reach_the_scan(stored):
    cleaned = plan(clean.clean_trips(stored["trips"]))
    for pushed in ("GreaterThan(trip_distance,0.0)", "LessThan(fare_amount,500.0)", "IsNotNull(vendor_id)"):
        assert pushed in cleaned
    airports = plan(questions.airport_destinations(stored["fact"], stored["zones"]))
    assert re.search(r"In\(pu_loc_id, \[1,132,138\]\)", airports)
    congestion = plan(questions.q3_congestion(stored["fact"]))
    assert "GreaterThanOrEqual(duration_min,1.0)" in congestion
    evening = plan(reports.hotspots_at(questions.hotspots(stored["fact"]), 18))
    assert "EqualTo(pickup_hour,18)" in evening, "the selector must reach the scan"


def test_every_grouping_combines_before_its_shuffle(stored):
    for result in (
        questions.hotspots(stored["fact"]),
        questions.revenue_by_borough(stored["fact"]),
        serving.zone_hour_stats(stored["fact"]),
        extensions.duplicate_report(stored["trips"]),
    ):
        assert "partial_count" in plan(result)


def test_last_write_wins_combines_before_its_shuffle(stored):
    assert "partial_max" in plan(serving.trip_by_zone(questions.hotspots(stored["fact"])))


def test_a_point_get_reaches_the_puts(spark, tables):
    """Only the puts of the wanted keys are combined and shuffled."""
    from tripflow.plans import catalog

    text = plan(serving.get(catalog._lookup(spark, tables), "1", "13", "21"))
    filters = re.findall(r"Condition : ([^\n]*)", text)
    assert any("cast(location_id" in f or "IN (1,13,21)" in f for f in filters)
    assert "partial_max" in text


def test_copies_are_counted_by_hash_first(stored):
    """The first exchange of the duplicate report carries eight bytes a row and a count."""
    text = plan(extensions.duplicate_report(stored["trips"]))
    counted = re.findall(r"Exchange\n(?:Input \[\d+\]: \[([^\]]*)\])", text)
    assert any(re.sub(r"#\d+L?", "", columns) == "_hash, count" for columns in counted)


def test_table_counts_scan_the_fact_once(stored):
    text = plan(counts.answer_counts(stored["fact"], stored["zones"], {1: "EWR"}, 3))
    scans = re.findall(r"ReadSchema: struct<[^\n]*pickup_hour", text)
    assert len(scans) == 1


def test_a_point_get_reads_a_stored_table(spark, tables):
    """Pruned to the buckets of the keys, the keys pushed to their row groups."""
    from tripflow.plans import catalog

    text = plan(catalog.queries()["kv_get"](spark, tables))
    assert re.search(r"PartitionFilters: \[bucket_16#\d+ IN \(", text)
    assert "PushedFilters: [In(row_key, [1,13,21])" in text
    assert "Exchange" not in text
