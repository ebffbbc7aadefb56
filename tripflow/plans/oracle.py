"""The same queries as SQL for an independent engine.

Each statement is written against the given tables only. Money and ratios are
summed as decimals so that both engines agree to the last digit whatever the
order of the rows.
"""

from __future__ import annotations

from tripflow.plans.catalog import MIN_TRIPS

_CTES: dict[str, str] = {
    "trips": """
        SELECT CASE WHEN l_partkey % 193 <> 0 THEN l_linenumber END AS vendor_id,
               o_orderdate + to_minutes((l_orderkey * 37 + l_linenumber * 101) % 1440) AS pickup_ts,
               o_orderdate + to_minutes((l_orderkey * 37 + l_linenumber * 101) % 1440)
                 + to_seconds((l_partkey * 13 + l_suppkey * 7) % 9000 - 300) AS dropoff_ts,
               CASE WHEN (l_partkey + l_linenumber) % 11 <> 0
                    THEN CAST((l_orderkey + l_linenumber) % 8 AS DOUBLE) END AS passenger_count,
               (l_quantity - 1) * CAST(2.1 AS DOUBLE) AS trip_distance,
               CAST(CASE WHEN l_partkey % 71 = 0 THEN 99 ELSE 1 + l_linenumber % 6 END AS DOUBLE) AS rate_code,
               CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN 99
                    ELSE c_nationkey END AS pu_loc_id,
               CASE WHEN l_partkey % 83 = 0 THEN 99 ELSE s_nationkey END AS do_loc_id,
               CASE WHEN l_partkey % 101 <> 0 THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS payment_type,
               (CASE WHEN l_returnflag = 'R' AND l_discount >= 0.09 THEN -1 ELSE 1 END)
                 * l_extendedprice / 200 AS fare_amount,
               CASE WHEN o_orderpriority = '1-URGENT' THEN l_extendedprice / 200 * l_tax
                    ELSE CAST(0 AS DOUBLE) END AS tip_amount,
               l_extendedprice / 200 * (1 + l_tax)
                 - CASE WHEN l_returnflag = 'A' AND l_discount = 0 THEN 1000 ELSE 0 END AS total_amount,
               CASE WHEN l_partkey % 53 = 0 THEN o_orderdate + to_days(31) ELSE o_orderdate END AS file_date
        FROM lineitem
        JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey
        JOIN supplier ON s_suppkey = l_suppkey""",
    "zones": """
        SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone, r_name AS service_zone
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "kept": """
        SELECT * FROM trips
        WHERE vendor_id IS NOT NULL AND pu_loc_id IS NOT NULL AND do_loc_id IS NOT NULL
          AND passenger_count BETWEEN 1 AND 6
          AND trip_distance > 0 AND trip_distance < 100
          AND fare_amount > 0 AND fare_amount < 500
          AND total_amount > 0""",
    "derived": """
        SELECT *, CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour,
               CAST(day(pickup_ts) AS INTEGER) AS pickup_day,
               CAST(month(pickup_ts) AS INTEGER) AS pickup_month,
               CAST(year(pickup_ts) AS INTEGER) AS pickup_year,
               date_diff('millisecond', pickup_ts, dropoff_ts) / CAST(60000 AS DOUBLE) AS duration_min,
               CASE WHEN fare_amount > 0 THEN tip_amount * CAST(100 AS DOUBLE) / fare_amount
                    ELSE CAST(0 AS DOUBLE) END AS tip_pct
        FROM kept""",
    "fact": """
        SELECT d.*, coalesce(z.borough, 'Unknown') AS pu_borough, coalesce(z.zone, 'Unknown') AS pu_zone
        FROM derived d LEFT JOIN zones z ON z.location_id = d.pu_loc_id""",
}

_NEEDS = {
    "trips": [],
    "zones": [],
    "kept": ["trips"],
    "derived": ["trips", "kept"],
    "fact": ["trips", "zones", "kept", "derived"],
}


def _dec(value: str) -> str:
    return f"CAST({value} AS DECIMAL(28,8))"


def _sum(value: str) -> str:
    return f"SUM({_dec(value)})"


def _mean(value: str) -> str:
    return f"CAST({_sum(value)} AS DOUBLE) / COUNT({value})"


def _r(value: str, places: int = 2) -> str:
    return f"CAST(ROUND({_dec(value)}, {places}) AS DOUBLE)"


def _rmean(value: str, places: int = 2) -> str:
    return _r(_mean(value), places)


def _rsum(value: str) -> str:
    return f"CAST(ROUND({_sum(value)}, 2) AS DOUBLE)"


def _share(condition: str) -> str:
    return _r(f"CAST(COUNT(*) FILTER (WHERE {condition}) AS DOUBLE) * 100 / COUNT(*)")


def _with(source: str, body: str, **more: str) -> str:
    ctes = [f"{name} AS ({_CTES[name]})" for name in [*_NEEDS[source], source]]
    ctes += [f"{name} AS ({text})" for name, text in more.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


_RAW_OUT = f"""
    vendor_id, {_text('pickup_ts')} AS pickup_dt, {_text('dropoff_ts')} AS dropoff_dt,
    passenger_count, trip_distance, rate_code, 'N' AS store_fwd, pu_loc_id, do_loc_id, payment_type,
    fare_amount, CAST(0 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax, tip_amount,
    CAST(0 AS DOUBLE) AS tolls_amount, CAST(1 AS DOUBLE) AS improvement_surcharge, total_amount,
    CAST(2.5 AS DOUBLE) AS congestion_surcharge, CAST(0 AS DOUBLE) AS airport_fee"""

_DERIVED_OUT = """
    pickup_hour, pickup_day, pickup_month, pickup_year, duration_min, passenger_count,
    trip_distance, pu_loc_id, do_loc_id, payment_type, fare_amount, tip_amount, total_amount, tip_pct"""

_Q1 = "SELECT pickup_hour, pu_borough, pu_zone, COUNT(*) AS trips FROM fact GROUP BY ALL"

_Q2 = f"""
    SELECT pu_borough,
           coalesce(label, 'Other') AS payment_method,
           COUNT(*) AS trips,
           {_rsum('total_amount')} AS revenue_usd,
           {_rmean('fare_amount')} AS avg_fare,
           {_rmean('tip_pct')} AS avg_tip_pct
    FROM fact
    LEFT JOIN (VALUES (1, 'Card'), (2, 'Cash'), (3, 'NoCharge'), (4, 'Dispute')) AS codes(code, label)
      ON code = payment_type
    GROUP BY 1, 2"""

_Q3 = f"""
    SELECT pickup_hour, pu_loc_id, do_loc_id, COUNT(*) AS trips,
           {_rmean('duration_min')} AS avg_duration_min,
           {_rmean('trip_distance')} AS avg_distance_mi,
           {_rmean('(duration_min / trip_distance)')} AS min_per_mile
    FROM fact
    WHERE trip_distance > 0.1 AND duration_min >= 1 AND duration_min <= 120
    GROUP BY pickup_hour, pu_loc_id, do_loc_id
    HAVING COUNT(*) >= {MIN_TRIPS}
    ORDER BY trips DESC, pickup_hour, pu_loc_id, do_loc_id
    LIMIT 500"""

_Q4 = f"""
    SELECT airport, dest.zone AS destination_zone, dest.borough AS destination_borough,
           COUNT(*) AS trips,
           {_rmean('trip_distance')} AS avg_distance_mi,
           {_rmean('fare_amount')} AS avg_fare,
           {_rmean('tip_pct')} AS avg_tip_pct,
           {_rmean('duration_min', 1)} AS avg_duration_min
    FROM fact
    JOIN (VALUES (1, 'EWR'), (13, 'JFK'), (21, 'LGA')) AS codes(code, airport) ON code = pu_loc_id
    JOIN zones dest ON dest.location_id = do_loc_id
    GROUP BY 1, 2, 3"""


def _shares(*keys: str) -> str:
    return f"""
    SELECT {', '.join(keys)},
           {_share('payment_type = 1')} AS pct_card,
           {_share('payment_type = 2')} AS pct_cash,
           {_share('payment_type NOT IN (1, 2)')} AS pct_other,
           COUNT(*) AS trips
    FROM fact GROUP BY {', '.join(keys)}"""


_Q5 = _shares("pu_borough")

_ZONE_HOUR = f"""
    SELECT CAST(pu_loc_id AS VARCHAR) AS pu_loc_id, substr({_text('pickup_ts')}, 12, 2) AS hour,
           COUNT(*) AS trips
    FROM kept GROUP BY 1, 2"""

_TRIP_BY_ZONE = """
    SELECT row_key, CAST(trips AS VARCHAR) AS trips, pu_borough AS borough, pu_zone AS zone
    FROM (SELECT *, replace(pu_zone, ' ', '_') || '_' || lpad(CAST(pickup_hour AS VARCHAR), 2, '0') AS row_key
          FROM q1)
    QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY trips, pu_borough DESC, pu_zone DESC) = 1"""

_KEY = "CAST(pu_loc_id AS VARCHAR) || '_' || lpad(CAST(pickup_hour AS VARCHAR), 2, '0')"

_LOOKUP = """
    SELECT CAST(location_id AS VARCHAR) AS row_key, borough, zone AS zone_name,
           CASE WHEN c_nationkey IS NULL THEN service_zone ELSE last_segment END AS service_zone
    FROM zones
    LEFT JOIN (SELECT c_nationkey, arg_max(c_mktsegment, c_custkey) AS last_segment
               FROM customer GROUP BY c_nationkey)
      ON c_nationkey = location_id"""

_FAILS = {
    "vendor_present": "vendor_id IS NOT NULL",
    "pickup_zone_present": "pu_loc_id IS NOT NULL",
    "dropoff_zone_present": "do_loc_id IS NOT NULL",
    "passengers_1_to_6": "passenger_count BETWEEN 1 AND 6",
    "distance_0_to_100": "trip_distance > 0 AND trip_distance < 100",
    "fare_0_to_500": "fare_amount > 0 AND fare_amount < 500",
    "total_positive": "total_amount > 0",
}


def oracle_sql() -> dict[str, str]:
    weighted = {
        name: _r(f"CAST({_sum(f'{name} * trips')} AS DOUBLE) / SUM(trips)")
        for name in ("avg_fare", "avg_tip_pct")
    }
    counted = {
        "fact_trips": "fact",
        "dim_zone": "zones",
        "q1_hotspots": "q1",
        "q2_revenue_by_borough": "q2",
        "q3_congestion": "q3",
        "q4_airports": "q4",
        "q5_payment_share": "q5",
        "zone_lookup": "zones",
    }
    month = "CAST(year({0}) AS INTEGER) AS year, CAST(month({0}) AS INTEGER) AS month"
    return {
        "ingest_contract": _with("trips", f"SELECT {_RAW_OUT} FROM trips"),
        "raw_scan_by_month": _with(
            "trips",
            f"SELECT {month.format('pickup_ts')}, COUNT(*) AS trips FROM trips GROUP BY ALL",
        ),
        "dim_zone": _with("zones", "SELECT * FROM zones"),
        "clean_trips": _with("kept", f"SELECT {_RAW_OUT} FROM kept"),
        "enrich_trips": _with(
            "derived",
            f"SELECT vendor_id, {_text('pickup_ts')} AS pickup_dt, {_text('dropoff_ts')} AS dropoff_dt, "
            f"{_DERIVED_OUT} FROM derived",
        ),
        "fact_trips": _with(
            "fact",
            f"SELECT vendor_id, {_text('pickup_ts')} AS pickup_dt, pu_borough, pu_zone, {_DERIVED_OUT} FROM fact",
        ),
        "quality_counts": _with(
            "kept",
            f"""SELECT raw_rows, clean_rows,
                       {_r('CAST(clean_rows AS DOUBLE) * 100 / raw_rows')} AS kept_pct
                FROM (SELECT COUNT(vendor_id) AS raw_rows FROM trips),
                     (SELECT COUNT(vendor_id) AS clean_rows FROM kept)""",
        ),
        "trips_per_zone_hour": _with("kept", _ZONE_HOUR),
        "top20_zone_hours": _with(
            "kept", "SELECT * FROM zh ORDER BY trips DESC, pu_loc_id, hour LIMIT 20", zh=_ZONE_HOUR
        ),
        "mr_row_quality": _with(
            "trips",
            """SELECT COUNT(*) FILTER (WHERE pu_loc_id IS NOT NULL) AS rows_ok,
                      COUNT(*) FILTER (WHERE pu_loc_id IS NULL) AS rows_bad FROM trips""",
        ),
        "table_counts": _with(
            "fact",
            "\nUNION ALL ".join(
                f"SELECT '{name}' AS table_name, COUNT(*) AS n_rows FROM {source}"
                for name, source in counted.items()
            ),
            q1=_Q1, q2=_Q2, q3=_Q3, q4=_Q4, q5=_Q5,
        ),
        "dim_preview": _with("zones", "SELECT * FROM zones ORDER BY location_id LIMIT 5"),
        "fact_preview": _with(
            "fact",
            f"""SELECT vendor_id, {_text('pickup_ts')} AS pickup_dt, pu_zone, fare_amount, tip_amount, total_amount
                FROM fact
                ORDER BY pickup_ts, vendor_id, pu_zone, fare_amount, tip_amount, total_amount LIMIT 5""",
        ),
        "word_count": """
            SELECT word, COUNT(*) AS occurrences
            FROM (SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents)
            WHERE word <> '' GROUP BY word""",
        "q1_hotspots": _with("fact", _Q1),
        "q1_preview_hour": _with(
            "fact",
            "SELECT * FROM q1 WHERE pickup_hour = 18 ORDER BY trips DESC, pu_borough, pu_zone LIMIT 5",
            q1=_Q1,
        ),
        "q2_revenue_by_borough": _with("fact", _Q2),
        "q3_congestion": _with("fact", _Q3),
        "q4_airports": _with("fact", _Q4),
        "q4_preview_airport": _with(
            "fact",
            """SELECT * FROM q4 WHERE airport = 'JFK'
               ORDER BY trips DESC, destination_zone, destination_borough LIMIT 10""",
            q4=_Q4,
        ),
        "q5_payment_share": _with("fact", _Q5),
        "busiest_zone_hours": _with(
            "fact",
            """SELECT pickup_hour, pu_zone, COUNT(*) AS trips FROM fact GROUP BY ALL
               ORDER BY trips DESC, pickup_hour, pu_zone LIMIT 10""",
        ),
        "kpi_summary": _with(
            "fact",
            f"""SELECT CAST(SUM(trips) AS BIGINT) AS total_trips,
                       {_rsum('revenue_usd')} AS revenue_usd,
                       {_r(f"CAST({_sum('revenue_usd')} AS DOUBLE) / 1000000")} AS revenue_musd,
                       {_rmean('avg_fare')} AS avg_fare,
                       {_rmean('avg_tip_pct')} AS avg_tip_pct,
                       {weighted['avg_fare']} AS weighted_avg_fare,
                       {weighted['avg_tip_pct']} AS weighted_avg_tip_pct
                FROM q2""",
            q2=_Q2,
        ),
        "hotspots_top10_per_hour": _with(
            "fact",
            """SELECT *, CAST(row_number() OVER (PARTITION BY pickup_hour
                                                 ORDER BY trips DESC, pu_borough, pu_zone) AS INTEGER) AS rank
               FROM q1 QUALIFY rank <= 10""",
            q1=_Q1,
        ),
        "revenue_pivot": _with(
            "fact",
            "SELECT pu_borough, "
            + ", ".join(
                f"MAX(revenue_usd) FILTER (WHERE payment_method = '{m}') AS \"{m}\""
                for m in ("Card", "Cash", "NoCharge", "Dispute", "Other")
            )
            + " FROM q2 GROUP BY pu_borough",
            q2=_Q2,
        ),
        "congestion_by_hour": _with(
            "fact",
            f"SELECT pickup_hour, {_mean('min_per_mile')} AS min_per_mile FROM q3 GROUP BY pickup_hour",
            q3=_Q3,
        ),
        "slowest_pairs": _with(
            "fact",
            """SELECT * FROM q3 ORDER BY min_per_mile DESC, pickup_hour, pu_loc_id, do_loc_id LIMIT 15""",
            q3=_Q3,
        ),
        "airport_top_destinations": _with(
            "fact",
            """SELECT *, rank <= 10 AS charted FROM (
                 SELECT *, CAST(row_number() OVER (PARTITION BY airport
                   ORDER BY trips DESC, destination_zone, destination_borough) AS INTEGER) AS rank FROM q4)
               WHERE rank <= 15""",
            q4=_Q4,
        ),
        "payment_share_long": _with(
            "fact",
            "\nUNION ALL ".join(
                f"SELECT pu_borough, trips, '{label}' AS method, {column} AS pct FROM q5"
                for column, label in (("pct_card", "Card"), ("pct_cash", "Cash"), ("pct_other", "Other"))
            ),
            q5=_Q5,
        ),
        "kv_zone_lookup": _with("zones", _LOOKUP),
        "kv_get": _with("zones", f"SELECT * FROM ({_LOOKUP}) WHERE row_key IN ('1', '13', '21')"),
        "kv_two_loads": _with(
            "zones",
            f"""SELECT l.row_key, l.borough, l.zone_name,
                       CASE WHEN l.row_key IN ('1', '13', '21') THEN l.service_zone ELSE z.service_zone END AS service_zone
                FROM ({_LOOKUP}) l JOIN zones z ON CAST(z.location_id AS VARCHAR) = l.row_key""",
        ),
        "kv_scan_filter": _with(
            "zones", f"SELECT row_key, borough FROM ({_LOOKUP}) WHERE borough = 'EUROPE'"
        ),
        "kv_trip_by_zone": _with("fact", _TRIP_BY_ZONE, q1=_Q1),
        "kv_scan_limit": _with(
            "fact", f"SELECT * FROM ({_TRIP_BY_ZONE}) ORDER BY row_key LIMIT 5", q1=_Q1
        ),
        "kv_zone_hour_stats": _with(
            "fact",
            f"""SELECT {_KEY} AS row_key, COUNT(*) AS trips, {_rmean('fare_amount')} AS avg_fare,
                       {_rmean('tip_pct')} AS avg_tip_pct, {_rmean('duration_min')} AS avg_duration_min
                FROM fact GROUP BY pu_loc_id, pickup_hour""",
        ),
        "kv_top_dropoffs": _with(
            "fact",
            f"""SELECT {_KEY} AS row_key,
                       '[' || string_agg('{{"rank":' || rn || ',"do_loc_id":' || do_loc_id
                              || ',"trips":' || trips || '}}', ',' ORDER BY rn) || ']' AS zones
                FROM (SELECT *, row_number() OVER (PARTITION BY pu_loc_id, pickup_hour
                                                   ORDER BY trips DESC, do_loc_id) AS rn FROM pairs)
                WHERE rn <= 5 GROUP BY pu_loc_id, pickup_hour""",
            pairs="SELECT pu_loc_id, pickup_hour, do_loc_id, COUNT(*) AS trips FROM fact GROUP BY ALL",
        ),
        "kv_zone_hour_puts": _with(
            "fact",
            f"""SELECT * FROM (
                  SELECT {_KEY} AS row_key, COUNT(*) AS trips, {_rmean('fare_amount')} AS avg_fare,
                         {_rmean('tip_pct')} AS avg_tip_pct, {_rmean('duration_min')} AS avg_duration_min
                  FROM fact GROUP BY pu_loc_id, pickup_hour)
                JOIN (
                  SELECT {_KEY} AS row_key,
                         '[' || string_agg('{{"rank":' || rn || ',"do_loc_id":' || do_loc_id
                                || ',"trips":' || trips || '}}', ',' ORDER BY rn) || ']' AS zones
                  FROM (SELECT *, row_number() OVER (PARTITION BY pu_loc_id, pickup_hour
                                                     ORDER BY trips DESC, do_loc_id) AS rn FROM pairs)
                  WHERE rn <= 5 GROUP BY pu_loc_id, pickup_hour) USING (row_key)""",
            pairs="SELECT pu_loc_id, pickup_hour, do_loc_id, COUNT(*) AS trips FROM fact GROUP BY ALL",
        ),
        "quality_by_rule": _with(
            "trips",
            "\nUNION ALL ".join(
                f"SELECT '{rule}' AS rule, COUNT(*) FILTER (WHERE ({test}) IS NOT TRUE) AS failing_rows FROM trips"
                for rule, test in _FAILS.items()
            ),
        ),
        "rate_flag": _with(
            "kept",
            "SELECT rate_code, rate_code = 99 AS unknown_rate, COUNT(*) AS trips FROM kept GROUP BY 1, 2",
        ),
        "out_of_month": _with(
            "trips",
            f"""SELECT {month.format('file_date')}, COUNT(*) AS trips,
                       COUNT(*) FILTER (WHERE strftime(file_date, '%Y-%m') <> strftime(pickup_ts, '%Y-%m'))
                         AS out_of_month
                FROM trips GROUP BY 1, 2""",
        ),
        "demand_by_dow": _with(
            "fact",
            """SELECT CAST(dayofweek(pickup_ts) + 1 AS INTEGER) AS day_of_week, pickup_hour, COUNT(*) AS trips
               FROM fact GROUP BY 1, 2""",
        ),
        "revenue_by_distance": _with(
            "fact",
            f"""SELECT pu_borough, pu_zone,
                       CASE WHEN trip_distance >= 20 THEN '20+' WHEN trip_distance >= 10 THEN '10-20'
                            WHEN trip_distance >= 5 THEN '05-10' WHEN trip_distance >= 2 THEN '02-05'
                            WHEN trip_distance >= 1 THEN '01-02' ELSE '00-01' END AS distance_mi,
                       COUNT(*) AS trips, {_rsum('total_amount')} AS revenue_usd,
                       {_rmean('fare_amount')} AS avg_fare, {_rmean('tip_amount')} AS avg_tip,
                       {_rmean('tip_pct')} AS avg_tip_pct
                FROM fact GROUP BY 1, 2, 3""",
        ),
        "stream_hourly_counts": """
            SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_start, event_type,
                   COUNT(*) AS n_events
            FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""",
        "payment_share_by_zone": _with("fact", _shares("pu_borough", "pu_zone")),
        "monthly_trend": _with(
            "fact",
            f"""SELECT *, {_r('CAST(trips - prev_trips AS DOUBLE) * 100 / prev_trips')} AS trips_change_pct
                FROM (SELECT *, lag(trips) OVER (PARTITION BY pu_borough
                                                 ORDER BY pickup_year, pickup_month) AS prev_trips
                      FROM (SELECT pu_borough, pickup_year, pickup_month, COUNT(*) AS trips,
                                   {_rsum('total_amount')} AS revenue_usd
                            FROM fact GROUP BY 1, 2, 3))""",
        ),
        "landed_months": _with(
            "trips",
            f"""SELECT {month.format('file_date')}, COUNT(*) AS trips, {_rsum('total_amount')} AS revenue_usd
                FROM trips
                WHERE year(file_date) >= 1995
                  AND (strftime(file_date, '%Y-%m') <> '1995-03' OR payment_type = 1)
                GROUP BY 1, 2""",
        ),
        "text_faults": _with(
            "trips",
            """SELECT fault, COUNT(*) AS n_lines,
                      COUNT(*) FILTER (fault IN ('sound', 'too many fields')) AS with_fare,
                      COUNT(*) AS with_pickup
               FROM (SELECT CASE WHEN passenger_count = 3 AND payment_type = 4 THEN 'too few fields'
                                 WHEN passenger_count = 1 AND pu_loc_id = 5 THEN 'too many fields'
                                 WHEN rate_code = 99 THEN 'value does not fit' ELSE 'sound' END AS fault FROM trips)
               GROUP BY fault""",
        ),
        "text_reread": _with("kept", f"SELECT {_RAW_OUT} FROM kept"),
        "observed_counts": _with(
            "kept",
            f"""SELECT raw_rows, clean_rows,
                       {_r('CAST(clean_rows AS DOUBLE) * 100 / raw_rows')} AS kept_pct
                FROM (SELECT COUNT(vendor_id) AS raw_rows FROM trips),
                     (SELECT COUNT(vendor_id) AS clean_rows FROM kept)""",
        ),
        "stored_counts": _with(
            "fact",
            "\nUNION ALL ".join(
                f"SELECT '{name}' AS table_name, COUNT(*) AS n_rows FROM {counted[name]}"
                for name in ("fact_trips", "dim_zone", "q1_hotspots", "q5_payment_share")
            ),
            q1=_Q1, q5=_Q5,
        ),
        "month_partitions": _with(
            "trips",
            f"""SELECT {month.format('file_date')}, COUNT(*) AS trips FROM trips
                WHERE year(file_date) <> 1992 AND strftime(file_date, '%Y-%m') <> '1993-01' GROUP BY 1, 2""",
        ),
        "stream_in_batches": """
            SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_start, event_type,
                   COUNT(*) AS n_events
            FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""",
        **{
            f"{name}_positions": _with(
                "fact", f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({body})"
            )
            for name, body, order in (
                ("q1", _Q1, "pickup_hour, trips DESC, pu_borough, pu_zone"),
                ("q2", _Q2, "revenue_usd DESC, pu_borough, payment_method"),
                ("q4", _Q4, "airport, trips DESC, destination_zone, destination_borough"),
                ("q5", _Q5, "trips DESC, pu_borough"),
            )
        },
        "export_q1": _with(
            "fact",
            """SELECT pickup_hour, pu_borough,
                      CASE pu_zone WHEN 'CHINA' THEN NULL WHEN 'FRANCE' THEN '' WHEN 'PERU' THEN 'Pe,ru "x"'
                                   WHEN 'IRAN' THEN ' I|ran' || chr(9) || ' ' ELSE pu_zone END AS pu_zone,
                      COUNT(*) AS trips
               FROM fact GROUP BY 1, 2, 3""",
        ),
        "export_q2": _with("fact", _Q2),
        "export_q3": _with("fact", _Q3),
        "export_q4": _with("fact", _Q4),
        "export_q5": _with("fact", _Q5),
        "duplicate_report": _with(
            "trips",
            """SELECT CAST(SUM(copies) AS BIGINT) AS trips, COUNT(*) AS distinct_trips,
                      COUNT(*) FILTER (WHERE copies > 1) AS duplicated_trips,
                      CAST(coalesce(SUM(copies - 1) FILTER (WHERE copies > 1), 0) AS BIGINT) AS surplus_rows
               FROM (SELECT COUNT(*) AS copies FROM trips
                     GROUP BY vendor_id, pickup_ts, dropoff_ts, passenger_count, trip_distance, rate_code,
                              pu_loc_id, do_loc_id, payment_type, fare_amount, tip_amount, total_amount)""",
        ),
    }
