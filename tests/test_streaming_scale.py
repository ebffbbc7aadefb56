import os

import pytest

from tests.rows import FACT, plan, tuples, zones
from tripflow import session
from tripflow.operators import enrich, joins, questions
from tripflow.plans import catalog, oracle
from tripflow.schema import FACT_SCHEMA
from tripflow.sources import orderbook
from tripflow.streaming import hourly

FEED = "ts timestamp_ntz, event_type string"


def write_feed(spark, path, *events):
    frame = spark.createDataFrame(list(events), "ts string, event_type string")
    frame.selectExpr("CAST(ts AS TIMESTAMP_NTZ) AS ts", "event_type").coalesce(1).write.mode(
        "append"
    ).parquet(path)


def as_text(counted):
    return sorted(tuples(counted.selectExpr("CAST(hour_start AS STRING)", "event_type", "n_events")))


def test_stream_continues_from_its_checkpoint(spark, tmp_path):
    feed, folder = str(tmp_path / "feed"), str(tmp_path / "state")
    write_feed(spark, feed, ("2026-03-08 01:10:00", "a"), ("2026-03-08 02:10:00", "a"))
    stream = lambda: hourly.read_feed(spark, feed, FEED)
    first = hourly.run_hourly_counts(stream(), "ts", ["event_type"], folder)
    assert as_text(first) == [("2026-03-08 01:00:00", "a", 1), ("2026-03-08 02:00:00", "a", 1)]

    write_feed(spark, feed, ("2026-03-08 02:20:00", "a"), ("2026-03-08 02:30:00", "b"))
    second = hourly.run_hourly_counts(stream(), "ts", ["event_type"], folder)
    assert as_text(second) == [
        ("2026-03-08 01:00:00", "a", 1),
        ("2026-03-08 02:00:00", "a", 2),
        ("2026-03-08 02:00:00", "b", 1),
    ]
    batch = hourly.hourly_counts(spark.read.schema(FEED).parquet(feed), "ts", ["event_type"])
    assert as_text(batch) == as_text(second)
    # Two runs leave one result: earlier epochs are gone.
    assert len(list((tmp_path / "state" / "counts").glob("epoch=*"))) == 1
    third = hourly.run_hourly_counts(stream(), "ts", ["event_type"], folder)
    assert as_text(third) == as_text(second)
    assert hourly.late_rows(spark, folder) == 0


@pytest.mark.parametrize("name", ["feed/", "feed", "feed.parquet"])
def test_any_path_can_be_a_feed(spark, tmp_path, name):
    path = f"{tmp_path}/{name}"
    write_feed(spark, path, ("2026-03-08 01:10:00", "a"))
    write_feed(spark, f"{tmp_path}/feed_other", ("2026-03-08 01:10:00", "other"))
    stream = hourly.read_feed(spark, path, FEED)
    counted = hourly.run_hourly_counts(stream, "ts", ["event_type"], f"{tmp_path}/state")
    assert as_text(counted) == [("2026-03-08 01:00:00", "a", 1)]


def test_staged_folders_go_with_the_application(spark):
    name = session.new_folder(spark, "passing")
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert system.exists(path) and not system.deleteOnExit(path.suffix("-absent"))
    session.remove_folder(spark, name)
    assert not system.exists(path)


def test_a_size_check_sends_one_row_per_task(spark):
    text = plan(joins.size_of(zones(spark)))
    assert "Limit" not in text and text.count("SinglePartition") == 1
    assert "partial_count" in text


def test_a_file_rewritten_in_place_is_measured_again(spark, tmp_path, monkeypatch):
    import shutil

    monkeypatch.setattr(joins, "MAX_ROWS", 10)
    for name, rows in (("small", 3), ("large", 400)):
        spark.range(rows).coalesce(1).write.parquet(str(tmp_path / name))
    target = tmp_path / "dimension"
    target.mkdir()
    (small,), (large,) = (list((tmp_path / name).glob("*.parquet")) for name in ("small", "large"))
    shutil.copyfile(small, target / "part.parquet")
    assert joins.is_small(spark.read.parquet(str(target)))
    shutil.copyfile(large, target / "part.parquet")
    spark.catalog.refreshByPath(str(target))
    assert not joins.is_small(spark.read.parquet(str(target)))


def test_an_empty_feed_has_an_empty_result(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    stream = spark.readStream.schema(FEED).parquet(str(feed))
    counted = hourly.run_hourly_counts(stream, "ts", ["event_type"], str(tmp_path / "state"))
    assert as_text(counted) == []


def test_trips_as_a_stream_equal_the_batch_count(spark, tables, tmp_path):
    feed = str(tmp_path / "trips")
    orderbook.raw_trips(spark, tables).repartition(3).write.parquet(feed)
    batch = spark.read.parquet(feed)
    stream = spark.readStream.schema(batch.schema).parquet(feed)
    keys = ["pu_loc_id"]
    streamed = hourly.run_hourly_counts(stream, "pickup_dt", keys, str(tmp_path / "state"))
    expected = hourly.hourly_counts(batch, "pickup_dt", keys)
    assert streamed.exceptAll(expected).count() == 0 == expected.exceptAll(streamed).count()
    assert streamed.agg({"n_events": "sum"}).collect()[0][0] == 6000


def test_rows_behind_the_watermark_are_late(spark, tmp_path):
    feed, folder = str(tmp_path / "feed"), str(tmp_path / "state")
    stream = lambda: hourly.read_feed(spark, feed, FEED)
    write_feed(spark, feed, ("2026-01-01 10:00:00", "a"))
    hourly.run_hourly_counts(stream(), "ts", ["event_type"], folder, lateness="1 hour")
    write_feed(spark, feed, ("2026-01-01 03:00:00", "a"), ("2026-01-01 09:30:00", "a"))
    late = hourly.run_hourly_counts(stream(), "ts", ["event_type"], folder, lateness="1 hour")
    assert as_text(late) == [("2026-01-01 09:00:00", "a", 1), ("2026-01-01 10:00:00", "a", 1)]
    assert hourly.late_rows(spark, folder) == 1


@pytest.mark.parametrize(
    "size, cores, scan_mib, shuffles",
    [(10**9, 8, 128, 16), (10**12, 400, 128, 2000), (10**14, 8000, 128, 46567), (10**14, 500, 1024, 46567)],
)
def test_partitions_grow_with_the_input(size, cores, scan_mib, shuffles):
    options = session.sizing(size, cores)
    assert int(options["spark.sql.files.maxPartitionBytes"]) // 2**20 == scan_mib
    assert int(options["spark.sql.shuffle.partitions"]) == shuffles


def test_shared_folder_is_the_one_the_session_names(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_written_frame_ends_its_lineage(spark):
    kept = session.written_once(spark.range(10).selectExpr("id", "id * 2 AS twice"), "kept")
    assert kept.agg({"twice": "sum"}).collect()[0][0] == 90
    assert "Range" not in plan(kept) and "Scan parquet" in plan(kept)


def test_shared_folder_is_refused_on_a_cluster_without_setting():
    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_no_query_runs_python_per_row(spark, tables):
    for name, query in catalog.queries().items():
        if name == "stream_hourly_counts":  # runs a job to build
            continue
        text = plan(query(spark, tables))
        assert "Python" not in text and "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_order_lines_never_travel_by_broadcast(spark, tables):
    text = plan(orderbook.raw_trips(spark, tables))
    assert "SortMergeJoin" in text


def test_a_hot_zone_is_split_when_the_dimension_is_large(spark, conf, monkeypatch):
    """A third of the trips start in one zone; the shuffled join must split it."""
    monkeypatch.setattr(joins, "MAX_ROWS", 0)
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
    )
    values = {name: f"CAST('{value}' AS {FACT_SCHEMA[name].dataType.simpleString()})" for name, value in FACT.items()}
    values["pu_loc_id"] = "CAST(CASE WHEN id % 3 = 0 THEN 132 ELSE id % 265 END AS INT)"
    values["fare_amount"] = "CAST(id AS DOUBLE)"
    values["tip_amount"] = "rand(1)"
    trips = spark.range(0, 60000, 1, 8).selectExpr(
        *(f"{values[n]} AS {n}" for n in values if n not in ("pu_borough", "pu_zone"))
    )
    joined = enrich.attach_pickup_zone(trips, zones(spark))
    result = joined.selectExpr("fare_amount", "tip_amount", "pu_zone")
    assert result.filter("pu_zone = 'JFK Airport'").count() >= 20000
    rows = result.collect()
    assert len(rows) == 60000
    assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()


def test_a_hot_order_customer_and_supplier_are_split(spark, conf, tables, tmp_path):
    """One order owns a third of the lines, one customer and one supplier likewise."""
    duckdb = pytest.importorskip("duckdb")
    hot = str(tmp_path)
    read = lambda name: spark.read.parquet(f"{tables}/{name}.parquet")
    lines = read("lineitem").crossJoin(spark.range(8).withColumnRenamed("id", "copy"))
    third = "(l_partkey + l_linenumber + copy) % 3 = 0"
    lines.selectExpr(
        f"CASE WHEN {third} THEN 7 ELSE l_orderkey END AS l_orderkey",
        "l_partkey",
        f"CASE WHEN {third} THEN 3 ELSE l_suppkey END AS l_suppkey",
        *(c for c in lines.columns[3:] if c != "copy"),
    ).repartition(8).write.parquet(f"{hot}/lineitem.parquet")
    read("orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey",
        "o_orderdate", "o_orderpriority",
    ).repartition(8).write.parquet(f"{hot}/orders.parquet")
    for name in ("customer", "supplier", "nation", "region"):
        read(name).write.parquet(f"{hot}/{name}.parquet")
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2k",
    )
    result = catalog.queries()["q1_hotspots"](spark, hot)
    got = sorted(tuples(result))
    executed = result._jdf.queryExecution().executedPlan().toString()
    assert executed.count("skew=true") >= 2

    con = duckdb.connect()
    for name in ("lineitem", "orders", "customer", "supplier", "nation", "region"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{hot}/{name}.parquet/*.parquet'")
    assert got == sorted(con.execute(oracle.oracle_sql()["q1_hotspots"]).fetchall())


def test_a_hot_group_combines_before_the_shuffle(spark):
    hot = spark.range(0, 30000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'Queens' ELSE concat('b', id % 7) END AS pu_borough",
        "CAST(id % 5 AS INT) AS payment_type",
    )
    shares = questions.q5_payment_share(hot)
    assert shares.collect()[0][0] == "Queens"
    assert plan(shares).count("partial_count") > 0


def test_repository_holds_no_data():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    heavy = [
        name
        for folder, dirs, names in os.walk(root)
        if ".git" not in folder
        for name in names
        if os.path.getsize(os.path.join(folder, name)) > 1_000_000
    ]
    assert heavy == []
