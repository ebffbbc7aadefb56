"""Keyed serving tables: a text ``row_key`` and one struct column per family."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.exact import Rows
from tripflow.functions.naming import named
from tripflow.operators.reports import top_per_group


def last_write_wins(puts: DataFrame, sequence: Sequence[str]) -> DataFrame:
    """One row per ``row_key``: the put that comes last by ``sequence``.

    ``sequence`` lists SQL expressions compared in turn; puts equal in all of
    them are decided by their cells, so the result is always the same. Written
    as a max over (sequence, cells), which combines map-side: a key written
    millions of times sends one row per task through the shuffle.
    """
    families = [name for name in puts.columns if name != "row_key"]
    entry = f"struct({', '.join(sequence) or '0'}) AS seq, struct({', '.join(families)}) AS cells"
    puts = puts.filter("row_key IS NOT NULL")
    last = puts.groupBy("row_key").agg(*named(last=f"max(struct({entry}))"))
    return last.select("row_key", "last.cells.*")


def merge_cells(puts: DataFrame, sequence: Sequence[str]) -> DataFrame:
    """One row per ``row_key`` with every cell as last put.

    A put sets the cells it names and leaves the others: a null cell, or a null
    family, is one the put does not name. Each cell is a max over (sequence,
    value) of its non-null puts and combines map-side. A column that is no
    struct is a cell by itself.
    """
    columns = [f for f in puts.schema if f.name != "row_key" and f.name not in sequence]
    cells = {
        field.name: [part.name for part in field.dataType] if isinstance(field.dataType, T.StructType) else None
        for field in columns
    }
    order = ", ".join(sequence) or "0"

    def last(name: str, path: str) -> str:
        return f"max(struct({order}, {path} AS _cell)) FILTER (WHERE {path} IS NOT NULL)"

    lasts, packed = {}, []
    for name, parts in cells.items():
        if parts is None:
            lasts[name] = last(name, f"`{name}`")
            packed.append(f"`{name}`._cell AS `{name}`")
        else:
            lasts |= {f"{name}.{part}": last(name, f"`{name}`.`{part}`") for part in parts}
            built = ", ".join(f"`{name}.{part}`._cell AS `{part}`" for part in parts)
            packed.append(f"struct({built}) AS `{name}`")
    merged = puts.filter("row_key IS NOT NULL").groupBy("row_key").agg(*named(**lasts))
    return merged.selectExpr("row_key", *packed)


def upsert(table: DataFrame, puts: DataFrame, sequence: Sequence[str] = ()) -> DataFrame:
    """``table`` after ``puts`` in their ``sequence``, cell by cell.

    A family may be put alone: those that either side lacks count as null.
    """
    columns = [F.lit(None).cast(puts.schema[name].dataType).alias(name) for name in sequence]
    stored = table.select("*", *columns).withColumn("_load", F.lit(0))
    stacked = stored.unionByName(puts.withColumn("_load", F.lit(1)), allowMissingColumns=True)
    return merge_cells(stacked, ["_load", *sequence])


def zone_lookup(zones: DataFrame) -> DataFrame:
    """Zones by location id as text, cells in family ``info``.

    Should an id come twice, the row with the greatest cells is kept; a load
    with an order of its own goes through ``last_write_wins``.
    """
    puts = zones.selectExpr(
        "CAST(location_id AS STRING) AS row_key",
        "struct(borough, zone AS zone_name, service_zone) AS info",
    )
    return last_write_wins(puts, [])


def get(table: DataFrame, *keys: str) -> DataFrame:
    """Point read of some keys; a pushed filter when the table is a file."""
    return table.filter(F.col("row_key").isin(list(keys)))


def scan_equals(table: DataFrame, family: str, qualifier: str, value: str) -> DataFrame:
    """Keys and one cell of the rows whose cell equals ``value``."""
    cell = F.col(family)[qualifier]
    return table.filter(cell == value).select("row_key", cell.alias(qualifier))


def scan_first(table: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows in byte order of the key, so '10' comes before '2'."""
    return table.orderBy("row_key").limit(rows)


_HH = "lpad(CAST(pickup_hour AS STRING), 2, '0')"
_ZONE_HOUR_KEY = f"concat_ws('_', CAST(pu_loc_id AS STRING), {_HH}) AS row_key"


def trip_by_zone(hotspots: DataFrame) -> DataFrame:
    """Zone-hour counts keyed ``<zone with _>_<HH>``, all cells as text.

    Several hotspots may share a key. They are loaded in result order (trips
    descending, then borough and zone), so the last of them is kept.
    """
    puts = hotspots.selectExpr(
        f"concat_ws('_', translate(pu_zone, ' ', '_'), {_HH}) AS row_key",
        "struct(CAST(trips AS STRING) AS trips, pu_borough AS borough, pu_zone AS zone) AS stats",
    )
    return last_write_wins(
        puts, ["-CAST(stats.trips AS BIGINT)", "stats.borough", "stats.zone"]
    )


def zone_hour_stats(fact: DataFrame, of: type = Rows) -> DataFrame:
    """Zone-hour metrics keyed ``<zone id>_<HH>``."""
    measures = {
        "avg_fare": of.rounded_mean("fare_amount"),
        "avg_tip_pct": of.rounded_mean("tip_pct"),
        "avg_duration_min": of.rounded_mean("duration_min"),
    }
    groups = fact.groupBy("pu_loc_id", "pickup_hour").agg(*named(trips=of.trips, **measures))
    return groups.selectExpr(_ZONE_HOUR_KEY, f"struct(trips, {', '.join(measures)}) AS stats")


def top_dropoffs(fact: DataFrame, top: int = 5, of: type = Rows) -> DataFrame:
    """The ``top`` drop-off zones of every zone-hour as a JSON list, best first."""
    pairs = fact.groupBy("pu_loc_id", "pickup_hour", "do_loc_id").agg(*named(trips=of.trips))
    order = [F.desc("trips"), F.asc("do_loc_id")]
    ranked = top_per_group(pairs, ["pu_loc_id", "pickup_hour"], order, top)
    lists = ranked.groupBy("pu_loc_id", "pickup_hour").agg(
        *named(entries="sort_array(collect_list(struct(rank, do_loc_id, trips)))")
    )
    return lists.selectExpr(_ZONE_HOUR_KEY, "struct(to_json(entries) AS zones) AS top_do")


def zone_hour_profile(fact: DataFrame, top: int = 5, of: type = Rows) -> DataFrame:
    """Both families of the zone-hour table side by side."""
    return zone_hour_stats(fact, of).join(top_dropoffs(fact, top, of), "row_key", "left")
