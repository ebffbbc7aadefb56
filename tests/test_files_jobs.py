import os
import shutil
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.rows import GOOD, fact, plan, raw, tuples
from tripflow.operators import clean, counts, enrich, questions
from tripflow.plans import jobs
from tripflow.schema import (
    FACT_SCHEMA,
    RAW_COLUMNS,
    RAW_TEXT_SCHEMA,
    RESULT_SCHEMAS,
    SOURCE_COLUMNS,
    ContractError,
    conform,
)
from tripflow.sinks import tables as sinks
from tripflow.sources import files, orderbook

ZONE_FILE = '''"LocationID","Borough","Zone","service_zone"
1,"EWR","Newark Airport","EWR"
7,"Queens","Astoria, upper","Boro Zone"
132,"Queens","JFK Airport","Airports"
265,"N/A","Outside of NYC","N/A"
9,"short"
x,"Queens","no key","Boro Zone"
'''


@pytest.fixture
def zone_file(tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(ZONE_FILE)
    return str(path)


def source_file(spark, path, passengers="bigint", extra=True, **changes):
    """A monthly source file with one row per change (or one good row)."""
    rows = raw(spark, *(changes.pop("rows", [{}])))
    texts = {
        "tpep_pickup_datetime": "CAST(pickup_dt AS TIMESTAMP_NTZ)",
        "tpep_dropoff_datetime": "CAST(dropoff_dt AS TIMESTAMP_NTZ)",
        "passenger_count": f"CAST(passenger_count AS {passengers})",
    }
    named = [
        f"{texts.get(source, name)} AS {source}" for source, name in zip(SOURCE_COLUMNS, RAW_COLUMNS)
    ]
    if extra:
        named.append("0.75D AS cbd_congestion_fee")
    rows.selectExpr(*named).coalesce(1).write.parquet(path)
    return path


# Sources -----------------------------------------------------------------------


def test_contract_names_every_missing_column(spark, tmp_path):
    path = source_file(spark, str(tmp_path / "m"))
    short = spark.read.parquet(path).drop("payment_type", "Airport_fee")
    with pytest.raises(ContractError, match="payment_type, Airport_fee"):
        conform(short)


def test_contract_orders_types_and_drops_the_rest(spark, tmp_path):
    path = source_file(spark, str(tmp_path / "m"))
    got = files.read_source_months(spark, [path])
    assert got.columns == RAW_COLUMNS
    assert dict(got.dtypes)["passenger_count"] == "double"
    assert dict(got.dtypes)["pickup_dt"] == "timestamp_ntz"
    assert tuples(enrich.with_text_times(got)) == [tuple(GOOD.values())]


def test_months_of_different_types_line_up(spark, tmp_path):
    paths = [
        source_file(spark, str(tmp_path / "a"), passengers="bigint"),
        source_file(spark, str(tmp_path / "b"), passengers="double", extra=False),
    ]
    assert files.read_source_months(spark, paths).count() == 2


def test_one_bad_month_stops_the_job(spark, tmp_path):
    good = source_file(spark, str(tmp_path / "a"))
    bad = str(tmp_path / "b")
    spark.read.parquet(good).drop("fare_amount").write.parquet(bad)
    with pytest.raises(ContractError, match="fare_amount"):
        files.read_source_months(spark, [good, bad])


def folder_of(spark, tmp_path, **kinds):
    """One folder with a file per kind; returns its path."""
    folder = tmp_path / "trips_2026-01"
    folder.mkdir()
    for name, options in kinds.items():
        drop = options.pop("drop", None)
        path = source_file(spark, str(tmp_path / name), **options)
        if drop:
            short = f"{path}-short"
            spark.read.parquet(path).drop(drop).coalesce(1).write.parquet(short)
            path = short
        (file,) = Path(path).glob("*.parquet")
        shutil.copyfile(file, folder / f"{name}.parquet")
    return str(folder)


def test_every_file_of_a_folder_is_held_to_the_contract(spark, tmp_path):
    path = folder_of(spark, tmp_path, a={}, b={"drop": "fare_amount"})
    with pytest.raises(ContractError, match=r"b\.parquet.*fare_amount"):
        files.read_source_months(spark, [path])
    with pytest.raises(ContractError, match=r"b\.parquet.*fare_amount"):
        sinks.land_months(spark, [path], str(tmp_path / "raw"))
    assert not (tmp_path / "raw").exists()


def test_files_of_one_folder_with_different_types_line_up(spark, tmp_path):
    path = folder_of(spark, tmp_path, a={}, b={"passengers": "double"}, c={"extra": False})
    rows = files.read_source_months(spark, [path])
    assert rows.columns == RAW_COLUMNS
    assert rows.where("passenger_count IS NULL OR fare_amount IS NULL").count() == 0
    assert rows.count() == 3


def test_trip_text_is_tolerant(spark, tmp_path):
    line = '2,2026-01-01 00:54:04.000000,2026-01-01 00:59:37.000000,1,0.97,1,"N",239,238,1,7.2,1,0.5,3.66,0,1,15.86,2.5,0'
    folder = tmp_path / "year=2026" / "month=01"
    folder.mkdir(parents=True)
    bad_fare = line.replace(",7.2,", ",abc,")
    short = ",".join(line.split(",")[:18])
    (folder / "trips.csv").write_text("\n".join([line, bad_fare, short, line + ",99"]) + "\n")
    got = files.read_trips_text(spark, str(tmp_path / "*" / "*"))
    assert got.schema == RAW_TEXT_SCHEMA
    rows = got.collect()
    assert tuple(rows[0]) == tuple(GOOD.values())
    assert rows[1].fare_amount is None and rows[1].total_amount == 15.86
    assert rows[2].airport_fee is None and rows[2].congestion_surcharge == 2.5
    assert tuple(rows[3]) == tuple(GOOD.values())
    assert clean.clean_trips(got).count() == 3

    lines = files.lines_to_zone_hours(files.read_lines(spark, str(tmp_path / "*" / "*")))
    assert tuples(clean.row_quality(lines)) == [(3, 1)]
    assert tuples(counts.trips_per_zone_hour(lines)) == [("239", "00", 3)]


def test_known_text_lines(spark, tmp_path):
    # Three lines of a January file; the second and third carry
    # no passenger.
    lines = [
        '2,2026-01-01 00:54:04.000000,2026-01-01 00:59:37.000000,1,0.97,1,"N",239,238,1,7.2,1,0.5,3.66,0,1,15.86,2.5,0',
        '1,2026-01-01 00:34:04.000000,2026-01-01 00:39:47.000000,0,0.9,1,"N",163,162,2,7.9,4.25,0.5,0,0,1,13.65,2.5,0',
        '1,2026-01-01 00:57:06.000000,2026-01-01 01:05:59.000000,0,1.4,1,"N",43,237,1,10.7,4.25,0.5,2.5,0,1,18.95,2.5,0',
    ]
    (tmp_path / "trips.csv").write_text("\n".join(lines) + "\n")
    trips = files.read_trips_text(spark, str(tmp_path / "trips.csv"))
    assert tuples(clean.quality_counts(trips)) == [(3, 1, 33.33)]
    derived = enrich.derive(trips).selectExpr("round(duration_min, 2)", "round(tip_pct, 2)")
    assert tuples(derived) == [(5.55, 50.83), (5.72, 0.0), (8.88, 23.36)]


def test_zone_file(spark, zone_file):
    complete = [
        (1, "EWR", "Newark Airport", "EWR"),
        (7, "Queens", "Astoria, upper", "Boro Zone"),
        (132, "Queens", "JFK Airport", "Airports"),
        (265, "N/A", "Outside of NYC", "N/A"),
    ]
    assert sorted(tuples(files.read_zones(spark, zone_file, complete_only=True))) == complete
    padded = tuples(files.read_zones(spark, zone_file).filter("location_id = 9"))
    assert padded == [(9, "short", None, None)]
    assert files.read_zones(spark, zone_file).count() == 5


def test_source_values_that_do_not_fit_become_null(spark, tmp_path):
    path = source_file(spark, str(tmp_path / "m"))
    odd = spark.read.parquet(path).withColumn("payment_type", F.lit(9_999_999_999))
    assert conform(odd).collect()[0].payment_type is None


def test_missing_result_raises(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_result(spark, "q1_hotspots", str(tmp_path / "nowhere"))


def test_tables_of_other_types_are_cast(spark, tmp_path):
    spark.range(3).selectExpr("id AS r_regionkey", "'x' AS r_name", "1 AS more").write.parquet(
        orderbook.table_path(str(tmp_path), "region")
    )
    got = orderbook.table(spark, str(tmp_path), "region")
    assert got.dtypes == [("r_regionkey", "int"), ("r_name", "string")]
    assert got.count() == 3


def test_source_scan_prunes_columns_and_pushes_filters(spark, tables):
    text = plan(questions.q1_hotspots(enrich.derive(orderbook.raw_trips(spark, tables)).selectExpr(
        "pickup_hour", "'b' AS pu_borough", "'z' AS pu_zone")))
    assert "l_extendedprice" not in text and "o_orderpriority" not in text
    cleaned = plan(clean.clean_trips(orderbook.raw_trips(spark, tables)))
    assert "IsNotNull(l_quantity)" in cleaned


# Sinks -----------------------------------------------------------------------------


def test_landing_replaces_only_its_month(spark, tmp_path):
    january = source_file(spark, str(tmp_path / "trips_2026-01.parquet"), rows=[{}, {}])
    february = source_file(spark, str(tmp_path / "trips_2026-02.parquet"), passengers="double")
    root = str(tmp_path / "raw")
    sinks.land_months(spark, [january, february], root)
    sinks.land_months(spark, [february], root)
    got = spark.read.parquet(root).groupBy("year", "month").count()
    assert sorted(tuples(got)) == [(2026, 1, 2), (2026, 2, 1)]
    assert sorted(os.listdir(os.path.join(root, "year=2026"))) == ["month=01", "month=02"]
    pruned = plan(spark.read.parquet(root).filter("month = 2"))
    assert "PartitionFilters: [isnotnull(month" in pruned


def test_a_file_without_month_in_its_name_is_refused(spark, tmp_path):
    path = source_file(spark, str(tmp_path / "trips.parquet"))
    with pytest.raises(ValueError, match="no YYYY-MM"):
        sinks.land_months(spark, [path], str(tmp_path / "raw"))
    assert sinks.file_month("in/2024-05/trips_2026-12.parquet/") == ("2026", "12")


def test_store_refuses_an_existing_target(spark, tmp_path):
    path = str(tmp_path / "clean")
    sinks.store(raw(spark, {}), path)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        sinks.store(raw(spark, {}), path)
    sinks.store(raw(spark, {}, {}), path, "overwrite")
    assert spark.read.parquet(path).count() == 2


def test_managed_external_and_partition_lifecycle(spark, tmp_path):
    sinks.create_schema(spark, "life", str(tmp_path / "life"))
    sinks.save_table(raw(spark, {}), "life.trips")
    sinks.save_table(raw(spark, {}, {}), "life.trips")
    assert spark.table("life.trips").count() == 2

    path = str(tmp_path / "facts")
    sinks.store(fact(spark, {}), path)
    sinks.register_external(spark, "life.facts", path, FACT_SCHEMA)
    assert tuples(spark.table("life.facts")) == tuples(fact(spark, {}))
    sinks.drop_table(spark, "life.facts")
    assert spark.read.parquet(path).count() == 1

    dated = raw(spark, {"vendor_id": 2024}, {"vendor_id": 2026}).selectExpr(
        "*", "CAST(vendor_id AS STRING) AS year", "explode(array('01', '02')) AS month"
    )
    sinks.save_table(dated.coalesce(1), "life.landed", "parquet", ("year", "month"))
    assert sinks.drop_partitions(spark, "life.landed", year="2024") == 2
    assert sinks.drop_partitions(spark, "life.landed", year="2024") == 0
    assert sinks.drop_partitions(spark, "life.landed", year="2026", month="01") == 1
    assert [r.year for r in spark.table("life.landed").select("year").distinct().collect()] == ["2026"]


def test_export_round_trip_with_nulls(spark, tmp_path):
    rows = [("Queens", "Card", 2, 1.4647820673e8, 1.5, None), ("N/A", "Cash", 1, 0.0, 0.0, 0.0)]
    table = spark.createDataFrame(rows, RESULT_SCHEMAS["q2_revenue_by_borough"])
    path = str(tmp_path / "q2")
    sinks.export_text(table.repartition(3), path, one_file=True)
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(parts) == 1
    text = open(os.path.join(path, parts[0])).read()
    assert "\\N" in text and "pu_borough" not in text
    assert sorted(tuples(files.read_result(spark, "q2_revenue_by_borough", path))) == sorted(rows)


# The whole job ----------------------------------------------------------------------


def test_month_from_files_to_exports(spark, tmp_path, zone_file):
    rows = [{}, {"pu_loc_id": 132}, {"pu_loc_id": 132, "payment_type": 2}, {"fare_amount": -1.0}]
    source = source_file(spark, str(tmp_path / "trips_2026-01.parquet"), rows=rows)
    root = str(tmp_path / "house")
    counted = jobs.run_month(spark, [source], zone_file, root, schema="monthly", min_trips=1)
    assert counted == {"raw_rows": 4, "clean_rows": 3}
    report = spark.read.parquet(f"{root}/clean/quality_report")
    assert tuples(report) == [("2026", "01", 4, 3, 75.0)]

    stored = spark.table("monthly.fact_trips")
    assert stored.count() == 3 and spark.table("monthly.dim_zone").count() == 5
    for name in ("q1_hotspots", "q2_revenue_by_borough", "q3_congestion", "q4_airports", "q5_payment_share"):
        table = spark.table(f"monthly.{name}")
        exported = files.read_result(spark, name, f"{root}/results/{name}")
        assert sorted(tuples(exported), key=str) == sorted(tuples(table), key=str), name
        if name != "q4_airports":
            assert table.agg(F.sum("trips")).collect()[0][0] == 3
    zone_hours = files.read_result(
        spark, "trips_per_zone_hour", f"{root}/results/trips_per_zone_hour", sep="\t"
    )
    assert sorted(tuples(zone_hours)) == [("132", "00", 2), ("239", "00", 1)]
    assert spark.table("monthly.zone_lookup").count() == 4
    keys = [r.row_key for r in spark.table("monthly.trip_by_zone").collect()]
    assert sorted(keys) == ["JFK_Airport_00", "Unknown_00"]
    profile = {r.row_key: r for r in spark.table("monthly.zone_hour_profile").collect()}
    assert sorted(profile) == ["132_00", "239_00"]
    assert profile["132_00"].stats.trips == 2
    assert profile["132_00"].top_do.zones == '[{"rank":1,"do_loc_id":238,"trips":2}]'

    # Running the month again gives the same tables.
    assert jobs.run_month(spark, [source], zone_file, root, schema="monthly", min_trips=1) == counted
    assert spark.table("monthly.q1_hotspots").count() == 2

    # The next month is added; the first is not touched.
    def january():
        return sorted(os.listdir(f"{root}/clean/trips_enriched/year=2026/month=01"))

    before = january()
    later = source_file(spark, str(tmp_path / "trips_2026-02.parquet"), rows=[{}, {}])
    added = jobs.run_month(spark, [later], zone_file, root, schema="monthly", min_trips=1)
    assert added == {"raw_rows": 2, "clean_rows": 2} and january() == before
    per_month = spark.table("monthly.fact_trips").groupBy("year", "month").count()
    assert sorted(tuples(per_month)) == [(2026, 1, 3), (2026, 2, 2)]
    assert spark.table("monthly.q2_revenue_by_borough").agg(F.sum("trips")).collect()[0][0] == 5

    # A month whose rows all fail leaves nothing of its former load behind.
    os.makedirs(tmp_path / "again")
    failing = source_file(spark, str(tmp_path / "again" / "trips_2026-02.parquet"), rows=[{"fare_amount": 0.0}])
    jobs.run_month(spark, [failing], zone_file, root, schema="monthly", min_trips=1)
    assert spark.table("monthly.fact_trips").count() == 3


def test_a_month_of_headerless_text_gives_the_same_fact(spark, tmp_path, zone_file):
    rows = [{}, {"pu_loc_id": 132}, {"fare_amount": -1.0}]
    parquet = source_file(spark, str(tmp_path / "trips_2026-01.parquet"), rows=rows)
    text = str(tmp_path / "trips_2026-01.csv")
    wall = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    files.read_source(spark, parquet).write.options(**wall).csv(text)
    for name, path, is_text in (("p", parquet, False), ("t", text, True)):
        jobs.run_month(spark, [path], zone_file, str(tmp_path / name), f"m_{name}", text=is_text)
    facts = [files.read_fact(spark, str(tmp_path / n / "clean/trips_enriched")) for n in "pt"]
    assert sorted(tuples(facts[0]), key=str) == sorted(tuples(facts[1]), key=str)
    assert facts[0].count() == 2


def test_two_files_of_one_month_are_landed_together(spark, tmp_path):
    paths = [source_file(spark, str(tmp_path / f"{k}_2026-03.parquet")) for k in ("a", "b")]
    assert sinks.land_months(spark, paths, str(tmp_path / "raw")) == [("2026", "03")]
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 2


def test_stored_keyed_table_is_upserted(spark):
    sinks.create_schema(spark, "keyed")
    first = spark.createDataFrame([("a", ("x",)), ("b", ("y",))], "row_key string, info struct<v string>")
    again = spark.createDataFrame([("b", ("a",)), ("c", ("z",))], "row_key string, info struct<v string>")
    jobs.upsert_table(spark, "keyed.t", first)
    jobs.upsert_table(spark, "keyed.t", again)
    got = spark.table("keyed.t").select("row_key", "info.v")
    assert sorted(tuples(got)) == [("a", "x"), ("b", "a"), ("c", "z")]


def test_command_line_and_dashboard(spark, tmp_path, zone_file, capsys):
    from tripflow.__main__ import main
    from tripflow.plans.dashboard import dashboard

    late = {"pickup_dt": "2026-01-01 18:10:00.000000", "dropoff_dt": "2026-01-01 18:30:00.000000"}
    rows = [{}, {**late, "pu_loc_id": 132, "do_loc_id": 7}, {**late, "pu_loc_id": 1, "do_loc_id": 7}]
    source = source_file(spark, str(tmp_path / "trips_2026-01.parquet"), rows=rows)
    root = str(tmp_path / "out")
    main(["month", "--zones", zone_file, "--root", root, "--schema", "cli", "--min-trips", "1", source])
    assert "kept 3 of 3 trips" in capsys.readouterr().out

    panels = dashboard(spark, root)
    assert panels["headline"].collect()[0].total_trips == 3
    assert [r.pu_zone for r in panels["hotspots"].collect()] == ["Newark Airport", "JFK Airport"]
    assert [r.destination_zone for r in panels["destinations"].collect()] == ["Astoria, upper"]
    assert tuples(panels["congestion"]) == [(0, 5.72), (18, 20.62)]
    assert panels["slowest_pairs"].count() == 3
    assert panels["payment_share"].count() == 9
    main(["dashboard", "--root", root, "--hour", "0"])
    assert "Unknown" in capsys.readouterr().out
