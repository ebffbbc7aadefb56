"""Stored files and tables: footers, landing, keyed tables, positions, counts, exports."""

import os
import shutil
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.rows import GOOD, plan, raw, tuples
from tests.test_files_jobs import source_file
from tripflow.operators import counts
from tripflow.operators.positions import with_position
from tripflow.plans import jobs
from tripflow.schema import RAW_COLUMNS
from tripflow.sinks import keyed
from tripflow.sinks import tables as sinks
from tripflow.sources import files, footers
from tripflow.streaming import hourly


def jobs_of(spark, action):
    """The result of an action and the number of Spark jobs it took."""
    name = f"group-{os.urandom(4).hex()}"
    spark.sparkContext.setJobGroup(name, name)
    try:
        return action(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")


# Footers ---------------------------------------------------------------------------


def test_a_thousand_footers_cost_one_job(spark, tmp_path):
    one = next(Path(source_file(spark, str(tmp_path / "one"))).glob("*.parquet"))
    other = next(Path(source_file(spark, str(tmp_path / "other"), passengers="double")).glob("*.parquet"))
    folder = tmp_path / "trips_2026-01"
    folder.mkdir()
    for k in range(1000):
        shutil.copyfile(other if k % 100 == 7 else one, folder / f"part {k:04d}.parquet")
    found, n = jobs_of(spark, lambda: footers.files_by_schema(spark, str(folder)))
    assert sorted(len(names) for _, names in found) == [10, 990]
    assert n <= 3  # the footers, and the schema of one file of each layout
    rows = files.read_source(spark, str(folder))
    assert rows.count() == 1000 and rows.where("passenger_count IS NULL").count() == 0


def test_footers_tell_rows_and_stores_that_tasks_cannot_open(spark, tmp_path):
    path = source_file(spark, str(tmp_path / "m"), rows=[{}, {}, {}])
    found = footers.footers(footers.listed_files(spark, path)).collect()
    assert [row.n_rows for row in found] == [3]
    unknown = spark.createDataFrame([("nosuch://store/a.parquet",), ("file:/nowhere/b.parquet",)], "path string")
    assert [row.layout for row in footers.footers(unknown).collect()] == [None, None]


# Landing ----------------------------------------------------------------------------


def test_months_are_landed_by_one_job(spark, tmp_path):
    paths = [source_file(spark, str(tmp_path / f"trips_2026-{m:02d}.parquet"), rows=[{}] * m) for m in range(1, 7)]
    frames = {path: files.read_source(spark, path) for path in paths}
    root = str(tmp_path / "raw")
    months, n = jobs_of(spark, lambda: sinks.land_months(spark, paths, root, lambda _, path: frames[path]))
    assert n == 1 and months == [("2026", f"{m:02d}") for m in range(1, 7)]
    got = spark.read.parquet(root).groupBy("month").count()
    assert sorted(tuples(got)) == [(m, m) for m in range(1, 7)]


def test_a_month_without_rows_replaces_its_month(spark, tmp_path):
    full = source_file(spark, str(tmp_path / "a" / "trips_2026-01.parquet"), rows=[{}, {}])
    other = source_file(spark, str(tmp_path / "a" / "trips_2026-02.parquet"))
    empty = str(tmp_path / "b" / "trips_2026-01.parquet")
    spark.read.parquet(full).limit(0).write.parquet(empty)
    root = str(tmp_path / "raw")
    sinks.land_months(spark, [full, other], root)
    sinks.land_months(spark, [empty], root)
    assert tuples(spark.read.parquet(root).groupBy("month").count()) == [(2, 1)]


def test_a_folder_is_landed_by_the_names_of_its_files(spark, tmp_path):
    folder = tmp_path / "2020-09" / "in"
    folder.mkdir(parents=True)
    for month, n in (("2025-12", 1), ("2026-01", 2)):
        (file,) = Path(source_file(spark, str(tmp_path / month), rows=[{}] * n)).glob("*.parquet")
        shutil.copyfile(file, folder / f"trips_{month}.parquet")
    root = str(tmp_path / "raw")
    sinks.land_files(spark, str(folder), root)
    rows = spark.read.parquet(root)
    assert sorted(tuples(rows.groupBy("year", "month").count())) == [(2025, 12, 1), (2026, 1, 2)]
    assert rows.columns == [*RAW_COLUMNS, "year", "month"]
    assert "PartitionFilters: [isnotnull(year" in plan(rows.where("year = 2026"))
    shutil.copyfile(folder / "trips_2026-01.parquet", folder / "trips.parquet")
    with pytest.raises(Exception, match=r"trips\.parquet: no YYYY-MM"):
        sinks.land_files(spark, str(folder), str(tmp_path / "again"))


# Text ------------------------------------------------------------------------------


def test_faults_of_text_lines(spark, tmp_path):
    line = ",".join(str(value) for value in GOOD.values())
    lines = [
        line,
        line.replace(",N,", ',"N,N",'),  # a separator within quotes
        ",".join(line.split(",")[:12]),
        line + ",more",
        line.replace(",7.2,", ",abc,"),
        "",
        "x",
        line.replace(",7.2,", ",,"),  # an empty field is a null, not a fault
    ]
    (tmp_path / "trips").mkdir()
    (tmp_path / "trips" / "part.csv").write_text("\n".join(lines) + "\n")
    trips = files.read_trips_text_checked(spark, str(tmp_path / "trips"))
    faults = Counter(row.fault for row in trips.collect())
    assert faults == {None: 3, "too few fields": 2, "too many fields": 1, "value does not fit": 1}
    same = files.read_trips_text(spark, str(tmp_path / "trips"))
    assert sorted(tuples(trips.drop("fault")), key=str) == sorted(tuples(same), key=str)
    report = {row.fault: (row.n_lines, row.with_fare) for row in files.lines_by_fault(trips).collect()}
    assert report["sound"] == (3, 2) and report["value does not fit"] == (1, 0)


# Keyed tables -------------------------------------------------------------------------


def key_values(spark, values, family="info"):
    rows = [(key, (value,)) for key, value in values.items()]
    return spark.createDataFrame(rows, f"row_key string, {family} struct<v string>")


def stamps(path):
    return {str(file): file.stat().st_mtime_ns for file in Path(path).rglob("*.parquet")}


def test_a_put_rewrites_the_buckets_of_its_keys_only(spark, tmp_path):
    path = str(tmp_path / "keyed")
    keyed.put(spark, path, key_values(spark, {f"k{k}": "old" for k in range(500)}), buckets=32)
    before = stamps(path)
    assert len(before) == 32
    table = keyed.put(spark, path, key_values(spark, {"k1": "new", "k2": "new", "another": "new"}))
    after = stamps(path)
    folders = {os.path.dirname(file) for file, _ in set(before.items()) ^ set(after.items())}
    assert 1 <= len(folders) <= 3
    values = {row.row_key: row.v for row in table.select("row_key", "info.v").collect()}
    assert len(values) == 501 and Counter(values.values()) == {"old": 498, "new": 3}
    # Nothing to put, nothing written.
    keyed.put(spark, path, key_values(spark, {"x": "y"}).where("false"))
    assert stamps(path) == after


def test_families_come_with_later_puts_and_cells_stay(spark, tmp_path):
    path = str(tmp_path / "keyed")
    keyed.put(spark, path, key_values(spark, {f"k{k}": "old" for k in range(50)}), buckets=8)
    table = keyed.put(spark, path, key_values(spark, {"k3": "stats"}, family="stats"))
    rows = {row.row_key: row for row in table.collect()}
    assert rows["k3"].info.v == "old" and rows["k3"].stats.v == "stats"
    assert rows["k4"].info.v == "old" and (rows["k4"].stats is None or rows["k4"].stats.v is None)


def rows_scanned(df):
    df.collect()
    executed = df._jdf.queryExecution().executedPlan()
    leaves = executed.collectLeaves()
    total = 0
    for k in range(leaves.size()):
        metric = leaves.apply(k).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total


def test_a_point_get_prunes_buckets_and_row_groups(spark, tmp_path, conf):
    path = str(tmp_path / "keyed")
    many = spark.range(200_000).selectExpr("lpad(CAST(id AS STRING), 9, '0') AS row_key", "struct(uuid() AS v) AS info")
    table = keyed.put(spark, path, many, buckets=4, row_group=64 << 10)
    got = keyed.get(table, "000001234", "nothing")
    text = plan(got)
    assert "PartitionFilters: [bucket_4" in text and "PushedFilters: [In(row_key" in text
    conf(spark__sql__adaptive__enabled="false")
    got = keyed.get(table, "000001234", "nothing")
    assert [row.row_key for row in got.collect()] == ["000001234"]
    assert rows_scanned(got) < 20_000  # of 50,000 in a bucket
    assert keyed.get(table).count() == 0
    # A key between others that no row has: the Bloom filter leaves nothing to read.
    absent = keyed.get(table, "000001234x")
    assert rows_scanned(absent) == 0


def test_a_catalog_table_is_there_at_any_time(spark):
    sinks.create_schema(spark, "keyed")
    keyed.upsert_table(spark, "keyed.puts", key_values(spark, {"a": "x", "b": "y"}), buckets=4)
    stored = spark.table("keyed.puts")
    keyed.upsert_table(spark, "keyed.puts", key_values(spark, {"b": "a", "c": "z"}))
    got = spark.table("keyed.puts").select("row_key", "info.v")
    assert sorted(tuples(got)) == [("a", "x"), ("b", "a"), ("c", "z")]
    assert stored.columns == ["row_key", "info", "bucket_4"]
    keyed.upsert_table(spark, "keyed.puts", key_values(spark, {"a": "s"}, family="stats"))
    assert spark.table("keyed.puts").where("row_key = 'a'").select("stats.v").first().v == "s"
    wider = spark.createDataFrame([("a", ("x", "y"))], "row_key string, info struct<v string, w string>")
    with pytest.raises(ValueError, match="info"):
        keyed.upsert_table(spark, "keyed.puts", wider)


# Streaming -----------------------------------------------------------------------------


def test_late_rows_of_more_batches_than_a_query_remembers(spark, tmp_path):
    feed, folder = tmp_path / "feed", str(tmp_path / "state")
    feed.mkdir()
    stamp = 1_767_225_600
    for k in range(130):
        # Every batch brings an hour further on, and from the second on a row of the first hours.
        rows = [(f"2026-01-{1 + k // 24:02d} {k % 24:02d}:10:00", "a")] + [("2025-12-31 00:00:00", "late")] * (k > 1)
        part = tmp_path / f"part{k}"
        spark.createDataFrame(rows, "ts string, event_type string").selectExpr(
            "CAST(ts AS TIMESTAMP_NTZ) AS ts", "event_type"
        ).coalesce(1).write.parquet(str(part))
        (file,) = part.glob("*.parquet")
        shutil.copyfile(file, feed / f"{k:03d}.parquet")
        os.utime(feed / f"{k:03d}.parquet", (stamp + k, stamp + k))
    stream = hourly.read_feed(spark, str(feed), "ts timestamp_ntz, event_type string", files_per_batch=1)
    counted = hourly.run_hourly_counts(stream, "ts", ["event_type"], folder, lateness="1 hour")
    assert counted.where("event_type = 'a'").count() == 130
    assert hourly.late_rows(spark, folder) == 128


# Positions, counts, exports ----------------------------------------------------------------


def test_positions_follow_the_order(spark, conf):
    conf(spark__sql__adaptive__enabled="false")
    rows = spark.range(0, 5000, 1, 7).selectExpr("id", "id * 7919 % 1000 AS v", "CAST(id AS STRING) AS position")
    placed = with_position(rows.select("id", "v").orderBy(F.desc("v"), "id"))
    expected = sorted(((r.id, r.v) for r in rows.collect()), key=lambda row: (-row[1], row[0]))
    got = sorted((row.position, row.id, row.v) for row in placed.collect())
    assert got == [(k, *row) for k, row in enumerate(expected, 1)]
    assert "SinglePartition" not in plan(with_position(rows.select("id").orderBy("id")).select("id"))
    assert with_position(rows.limit(0).select("id").orderBy("id")).collect() == []


def test_counts_while_storing_take_one_job(spark, tmp_path):
    trips = raw(spark, {}, {"fare_amount": -1.0}, {"vendor_id": None})
    counted, n = jobs_of(spark, lambda: jobs.run_clean(spark, trips, str(tmp_path / "clean")))
    assert counted == {"raw_rows": 2, "clean_rows": 1} and n == 1


def test_footers_answer_a_count(spark, tmp_path):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.range(0, 1000, 1, 3).write.parquet(str(tmp_path / "a"))
    spark.range(0).write.parquet(str(tmp_path / "b"))
    counted = counts.footer_counts(spark, {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")})
    assert sorted(tuples(counted)) == [("a", 1000), ("b", 0)]
    assert "PushedAggregation: [COUNT(*)]" in plan(counted)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_files_of_an_export_are_bounded(spark, tmp_path):
    def sizes(path):
        return sorted(len(file.read_text().splitlines()) for file in Path(path).glob("*.csv"))

    frame = spark.range(0, 100, 1, 4).toDF("n")
    sinks.export_text(frame, str(tmp_path / "few"), one_file=True)
    assert sizes(tmp_path / "few") == [100]
    sinks.export_text(frame, str(tmp_path / "many"), one_file=True, rows_per_file=10)
    assert sum(sizes(tmp_path / "many")) == 100 and max(sizes(tmp_path / "many")) == 10
