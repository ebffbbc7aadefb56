"""The registered queries: name -> function of (session, table directory)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.exact import rounded_sum
from tripflow.functions.naming import TRIPS, named
from tripflow.operators import counts, enrich, extensions, questions, reports, serving
from tripflow.operators import clean as cleaning
from tripflow.operators.positions import with_position
from tripflow.plans import jobs
from tripflow.session import new_folder
from tripflow.sinks import keyed, tables
from tripflow.sources import files, orderbook
from tripflow.streaming import hourly

# The default of 20 suits millions of trips; the check data has few
# per zone pair and hour.
MIN_TRIPS = 3

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


#: Queries that write files or tables before they read their answer.
STORING: set[str] = set()


def storing(function: Query) -> Query:
    STORING.add(function.__name__)
    return query(function)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# Shared stages -------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderbook.raw_trips(spark, sf_dir)


def _raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_text_times(_raw(spark, sf_dir))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_trips(_raw(spark, sf_dir))


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact columns without zone names, for answers keyed by zone id only: they
    need no join with the dimension."""
    return enrich.derive(_clean(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.fact_trips(_clean(spark, sf_dir), orderbook.zones(spark, sf_dir))


def _q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unsorted: only the finished result pays for a global sort."""
    return questions.hotspots(_fact(spark, sf_dir))


def _q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.revenue_by_borough(_fact(spark, sf_dir))


def _q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.q3_congestion(_derived(spark, sf_dir), min_trips=MIN_TRIPS)


def _q4(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = orderbook.zones(spark, sf_dir)
    return questions.airport_destinations(
        _derived(spark, sf_dir), zones, orderbook.AIRPORT_ZONES
    )


def _q5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.payment_share(_fact(spark, sf_dir), "pu_borough")


# Sources, cleaning, enrichment ----------------------------------------------


@query
def ingest_contract(spark, sf_dir):
    return _raw_text(spark, sf_dir)


@query
def raw_scan_by_month(spark, sf_dir):
    months = named(year="year(pickup_dt)", month="month(pickup_dt)")
    return _raw(spark, sf_dir).groupBy(*months).agg(*named(**TRIPS))


@query
def dim_zone(spark, sf_dir):
    return orderbook.zones(spark, sf_dir)


@query
def clean_trips(spark, sf_dir):
    return enrich.with_text_times(_clean(spark, sf_dir))


@query
def enrich_trips(spark, sf_dir):
    # From the text layout, so the tolerant time parsing is part of the query.
    return enrich.derive(cleaning.clean_trips(_raw_text(spark, sf_dir)))


@query
def fact_trips(spark, sf_dir):
    return _fact(spark, sf_dir)


@query
def quality_counts(spark, sf_dir):
    return cleaning.quality_counts(_raw(spark, sf_dir))


# Counts -----------------------------------------------------------------------


@query
def trips_per_zone_hour(spark, sf_dir):
    return counts.trips_per_zone_hour(_clean(spark, sf_dir))


@query
def top20_zone_hours(spark, sf_dir):
    return counts.top_zone_hours(trips_per_zone_hour(spark, sf_dir))


@query
def mr_row_quality(spark, sf_dir):
    return cleaning.row_quality(_raw_text(spark, sf_dir))


@query
def table_counts(spark, sf_dir):
    return counts.answer_counts(
        _fact(spark, sf_dir), orderbook.zones(spark, sf_dir), orderbook.AIRPORT_ZONES, MIN_TRIPS
    )


@query
def dim_preview(spark, sf_dir):
    return counts.zone_preview(orderbook.zones(spark, sf_dir))


@query
def fact_preview(spark, sf_dir):
    return counts.fact_preview(_fact(spark, sf_dir))


@query
def word_count(spark, sf_dir):
    return counts.word_count(orderbook.table(spark, sf_dir, "documents"))


# Questions -----------------------------------------------------------------------


@query
def q1_hotspots(spark, sf_dir):
    return questions.q1_hotspots(_fact(spark, sf_dir))


@query
def q1_preview_hour(spark, sf_dir):
    return reports.hotspots_at(_q1(spark, sf_dir), hour=18, top=5)


@query
def q2_revenue_by_borough(spark, sf_dir):
    return questions.q2_revenue_by_borough(_fact(spark, sf_dir))


@query
def q3_congestion(spark, sf_dir):
    return _q3(spark, sf_dir)


@query
def q4_airports(spark, sf_dir):
    zones = orderbook.zones(spark, sf_dir)
    return questions.q4_airports(_derived(spark, sf_dir), zones, orderbook.AIRPORT_ZONES)


@query
def q4_preview_airport(spark, sf_dir):
    return reports.destinations_from(_q4(spark, sf_dir), "JFK", top=10)


@query
def q5_payment_share(spark, sf_dir):
    return questions.q5_payment_share(_fact(spark, sf_dir))


@query
def busiest_zone_hours(spark, sf_dir):
    return questions.busiest_zone_hours(_fact(spark, sf_dir))


# Report frames ----------------------------------------------------------------


@query
def kpi_summary(spark, sf_dir):
    return reports.kpi_summary(_q2(spark, sf_dir))


@query
def hotspots_top10_per_hour(spark, sf_dir):
    return reports.hotspots_top_per_hour(_q1(spark, sf_dir))


@query
def revenue_pivot(spark, sf_dir):
    return reports.revenue_pivot(_q2(spark, sf_dir))


@query
def congestion_by_hour(spark, sf_dir):
    return reports.congestion_by_hour(_q3(spark, sf_dir))


@query
def slowest_pairs(spark, sf_dir):
    return reports.slowest_pairs(_q3(spark, sf_dir))


@query
def airport_top_destinations(spark, sf_dir):
    return reports.airport_top_destinations(_q4(spark, sf_dir))


@query
def payment_share_long(spark, sf_dir):
    return reports.payment_share_long(_q5(spark, sf_dir))


# Serving tables -----------------------------------------------------------------


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup as loaded, then updated by every put in turn."""
    loaded = serving.zone_lookup(orderbook.zones(spark, sf_dir))
    return serving.upsert(loaded, orderbook.zone_puts(spark, sf_dir), ["sequence"])


@query
def kv_zone_lookup(spark, sf_dir):
    return _lookup(spark, sf_dir).select("row_key", "info.*")


def _stored_lookup(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """The zone lookup in a stored keyed table: one load of all zones, then one of the
    puts of some keys (of all if none is named), which touches their buckets only."""
    path = f"{new_folder(spark, 'keyed')}/zones"
    keyed.put(spark, path, serving.zone_lookup(orderbook.zones(spark, sf_dir)), buckets=16)
    puts = orderbook.zone_puts(spark, sf_dir)
    puts = serving.get(puts, *keys) if keys else puts
    return keyed.put(spark, path, serving.merge_cells(puts, ["sequence"]))


_AIRPORT_KEYS = [str(zone) for zone in orderbook.AIRPORT_ZONES]


@storing
def kv_get(spark, sf_dir):
    stored = _stored_lookup(spark, sf_dir)
    return keyed.get(stored, *_AIRPORT_KEYS).select("row_key", "info.*")


@storing
def kv_two_loads(spark, sf_dir):
    return _stored_lookup(spark, sf_dir, *_AIRPORT_KEYS).select("row_key", "info.*")


@query
def kv_scan_filter(spark, sf_dir):
    return serving.scan_equals(_lookup(spark, sf_dir), "info", "borough", "EUROPE")


@query
def kv_trip_by_zone(spark, sf_dir):
    return serving.trip_by_zone(_q1(spark, sf_dir)).select("row_key", "stats.*")


@query
def kv_scan_limit(spark, sf_dir):
    return serving.scan_first(serving.trip_by_zone(_q1(spark, sf_dir))).select("row_key", "stats.*")


@query
def kv_zone_hour_stats(spark, sf_dir):
    return serving.zone_hour_stats(_derived(spark, sf_dir)).select("row_key", "stats.*")


@query
def kv_top_dropoffs(spark, sf_dir):
    return serving.top_dropoffs(_derived(spark, sf_dir)).select("row_key", "top_do.*")


@query
def kv_zone_hour_puts(spark, sf_dir):
    """The two families of the zone-hour table put one after the other."""
    fact = _derived(spark, sf_dir)
    stored = serving.upsert(serving.zone_hour_stats(fact), serving.top_dropoffs(fact))
    return stored.select("row_key", "stats.*", F.col("top_do.zones").alias("zones"))


# Extensions ----------------------------------------------------------------------


@query
def quality_by_rule(spark, sf_dir):
    return cleaning.quality_by_rule(_raw(spark, sf_dir))


@query
def rate_flag(spark, sf_dir):
    flagged = cleaning.flag_unknown_rate(_clean(spark, sf_dir))
    return flagged.groupBy("rate_code", "unknown_rate").agg(*named(**TRIPS))


@query
def out_of_month(spark, sf_dir):
    return extensions.out_of_month(orderbook.landed_trips(spark, sf_dir))


@query
def demand_by_dow(spark, sf_dir):
    return extensions.demand_by_dow(_derived(spark, sf_dir))


@query
def revenue_by_distance(spark, sf_dir):
    return extensions.revenue_by_distance(_fact(spark, sf_dir))


@query
def stream_hourly_counts(spark, sf_dir):
    path = orderbook.table_path(sf_dir, "events")
    events = hourly.read_feed(spark, path, orderbook.table_schema(spark, sf_dir, "events"))
    folder = new_folder(spark, "hourly")
    counted = hourly.run_hourly_counts(events, "ts", ["event_type"], folder)
    return counted.withColumn("hour_start", F.col("hour_start").cast("string"))


@query
def payment_share_by_zone(spark, sf_dir):
    return extensions.payment_share_by_zone(_fact(spark, sf_dir))


@query
def monthly_trend(spark, sf_dir):
    return extensions.monthly_trend(_fact(spark, sf_dir))


@query
def duplicate_report(spark, sf_dir):
    return extensions.duplicate_report(_raw(spark, sf_dir))


# Files, tables and counts around them -----------------------------------------------


def _month_files(spark: SparkSession, trips: DataFrame, label: str) -> str:
    """Source trips as Parquet, a folder ``file=trips_YYYY-MM`` for each file month."""
    folder = new_folder(spark, label)
    name = "concat('trips_', date_format(file_date, 'yyyy-MM'))"
    trips.withColumn("file", F.expr(name)).drop("file_date").write.mode("overwrite").partitionBy("file").parquet(folder)
    return folder


@storing
def landed_months(spark, sf_dir):
    """All months landed by one job, one of them landed again with card trips only, and
    the later years read back."""
    source = orderbook.source_trips(spark, sf_dir)
    root = new_folder(spark, "landed")
    tables.land_files(spark, _month_files(spark, source, "months"), root)
    again = source.where("payment_type = 1 AND file_date >= '1995-03-01' AND file_date < '1995-04-01'")
    tables.land_files(spark, _month_files(spark, again, "again"), root)
    landed = files.read_trips(spark, root).where("year >= 1995")
    return landed.groupBy("year", "month").agg(*named(**TRIPS, revenue_usd=rounded_sum("total_amount")))


#: Faults planted into the text lines of some trips, by a test of the trip.
FAULTS = {
    "short": "passenger_count = 3 AND payment_type = 4",
    "long": "passenger_count = 1 AND pu_loc_id = 5",
    "value": "rate_code = 99",
}


def _text_lines(spark: SparkSession, sf_dir: str) -> str:
    """Trips as delimited lines with planted faults; returns the folder."""
    trips = _raw_text(spark, sf_dir)
    cells = [f"coalesce(CAST({name} AS STRING), '')" for name in trips.columns]
    fare = trips.columns.index("fare_amount")
    short = f"concat_ws(',', {', '.join(cells[:10])})"
    whole = f"concat_ws(',', {', '.join(cells)})"
    cells[fare] = "'abc'"
    value = f"concat_ws(',', {', '.join(cells)})"
    line = (
        f"CASE WHEN {FAULTS['short']} THEN {short} WHEN {FAULTS['long']} THEN {whole} || ',\"a,b\",x'"
        f" WHEN {FAULTS['value']} THEN {value} ELSE {whole} END"
    )
    folder = f"{new_folder(spark, 'lines')}/trips"
    trips.selectExpr(f"{line} AS line").write.mode("overwrite").text(folder)
    return folder


@storing
def text_faults(spark, sf_dir):
    return files.lines_by_fault(files.read_trips_text_checked(spark, _text_lines(spark, sf_dir)))


@storing
def text_reread(spark, sf_dir):
    """Clean trips exported as headerless text and read again."""
    folder = f"{new_folder(spark, 'text')}/clean"
    tables.export_text(enrich.with_text_times(_clean(spark, sf_dir)), folder)
    return files.read_trips_text(spark, folder)


@storing
def observed_counts(spark, sf_dir):
    """Raw and clean rows observed while the clean trips were stored, from the report."""
    folder = new_folder(spark, "observed")
    counted = jobs.run_clean(spark, _raw(spark, sf_dir), f"{folder}/clean")
    jobs.report_counts(spark, ("1998", "12"), counted, f"{folder}/report")
    return spark.read.parquet(f"{folder}/report").select("raw_rows", "clean_rows", "kept_pct")


@storing
def stored_counts(spark, sf_dir):
    """Rows of stored tables, told by their footers."""
    folder = new_folder(spark, "tables")
    stored = {
        "fact_trips": _fact(spark, sf_dir),
        "dim_zone": orderbook.zones(spark, sf_dir),
        "q1_hotspots": _q1(spark, sf_dir),
        "q5_payment_share": _q5(spark, sf_dir),
    }
    for name, frame in stored.items():
        tables.store(frame, f"{folder}/{name}")
    return counts.footer_counts(spark, {name: f"{folder}/{name}" for name in stored})


@storing
def month_partitions(spark, sf_dir):
    """A managed table by month: created, one year and one month dropped, the rest counted."""
    folder = new_folder(spark, "managed")
    schema = f"managed_{folder.rsplit('-', 1)[-1]}"
    tables.create_schema(spark, schema, folder)
    landed = orderbook.landed_trips(spark, sf_dir)
    tables.save_table(landed, f"{schema}.trips", "parquet", ("year", "month"))
    tables.drop_partitions(spark, f"{schema}.trips", year="1992")
    tables.drop_partitions(spark, f"{schema}.trips", year="1993", month="1")
    return tables.months_of(spark, f"{schema}.trips").join(
        spark.table(f"{schema}.trips").groupBy("year", "month").agg(*named(**TRIPS)), ["year", "month"], "left"
    )


@storing
def stream_in_batches(spark, sf_dir):
    """The hourly counts of a backlog of files, worked off two files a batch."""
    events = orderbook.table(spark, sf_dir, "events")
    feed = f"{new_folder(spark, 'feed')}/events"
    events.repartitionByRange(12, "ts").write.parquet(feed)
    stream = hourly.read_feed(spark, feed, events.schema, files_per_batch=2)
    # Files written side by side come in any order: no row may count as late.
    folder = new_folder(spark, "batches")
    counted = hourly.run_hourly_counts(stream, "ts", ["event_type"], folder, lateness="3650 days")
    return counted.withColumn("hour_start", F.col("hour_start").cast("string"))


# Orders that can be checked ------------------------------------------------------------


@storing
def q1_positions(spark, sf_dir):
    return with_position(q1_hotspots(spark, sf_dir))


@storing
def q2_positions(spark, sf_dir):
    return with_position(q2_revenue_by_borough(spark, sf_dir))


@storing
def q4_positions(spark, sf_dir):
    return with_position(q4_airports(spark, sf_dir))


@storing
def q5_positions(spark, sf_dir):
    return with_position(q5_payment_share(spark, sf_dir))


# Exports read back -----------------------------------------------------------------------


def _dressed(fact: DataFrame) -> DataFrame:
    """The fact with zone names that are hard on delimited text."""
    names = {"CHINA": "NULL", "FRANCE": "''", "PERU": "'Pe,ru \"x\"'", "IRAN": "' I|ran\t '"}
    cases = " ".join(f"WHEN '{name}' THEN {text}" for name, text in names.items())
    dressed = f"CASE pu_zone {cases} ELSE pu_zone END"
    return fact.withColumn("pu_zone", F.expr(dressed))


def _reread(spark: SparkSession, name: str, result: DataFrame, **options) -> DataFrame:
    folder = f"{new_folder(spark, 'export')}/{name}"
    tables.export_text(result, folder, **options)
    return files.read_result(spark, name, folder)


@storing
def export_q1(spark, sf_dir):
    result = questions.q1_hotspots(_dressed(_fact(spark, sf_dir)))
    return _reread(spark, "q1_hotspots", result, rows_per_file=100)


@storing
def export_q2(spark, sf_dir):
    return _reread(spark, "q2_revenue_by_borough", _q2(spark, sf_dir), one_file=True)


@storing
def export_q3(spark, sf_dir):
    return _reread(spark, "q3_congestion", _q3(spark, sf_dir), rows_per_file=50)


@storing
def export_q4(spark, sf_dir):
    return _reread(spark, "q4_airports", _q4(spark, sf_dir), one_file=True)


@storing
def export_q5(spark, sf_dir):
    return _reread(spark, "q5_payment_share", _q5(spark, sf_dir))
