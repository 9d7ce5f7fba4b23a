"""Join and duplicate queries the reference describes."""

from __future__ import annotations

from pyspark.sql import functions as F

from plover.operators import joins as J
from plover.plans import standins as S
from plover.plans.registry import query, rounded, with_ctes
from plover.session import fresh_path
from plover.sources.tables import scan

R = 6
FL = S.flights_sql()
DAILY_SQL = ("SELECT CAST(l_shipdate AS DATE) AS day, avg(l_tax) * 100 AS daily_temp, count(*) AS n_readings "
             "FROM lineitem GROUP BY 1")


def _daily(spark, sf):
    """Daily 'weather' derived from lineitem ship dates: one row per calendar day."""
    li = scan(spark, sf, "lineitem", ["l_shipdate", "l_tax"])
    return li.groupBy(F.to_date("l_shipdate").alias("day")).agg(
        (F.avg("l_tax") * 100).alias("daily_temp"), F.count(F.lit(1)).alias("n_readings"))


def _join_sql(how):
    return with_ctes(
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(FL_DATE AS VARCHAR) AS FL_DATE, "
        f"round(daily_temp, {R}) AS daily_temp, n_readings FROM flights f {how} JOIN daily d ON f.FL_DATE = d.day",
        flights=FL, daily=DAILY_SQL)


def _join(spark, sf, how):
    f = S.flights(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "FL_DATE")
    # written first (a row per calendar day): the planner then knows its bytes and leaves the flights where they are
    path = fresh_path(spark, "daily")
    _daily(spark, sf).write.parquet(path)
    j = J.join_by_date(f, spark.read.parquet(path), "FL_DATE", "day", how)
    return rounded(j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                            F.col("FL_DATE").cast("string").alias("FL_DATE"), "daily_temp", "n_readings"), R)


@query("join_by_date", _join_sql("INNER"))
def join_by_date(spark, sf):
    """Flights joined to daily readings by date (inner)."""
    return _join(spark, sf, "inner")


@query("join_by_date_left", _join_sql("LEFT"))
def join_by_date_left(spark, sf):
    """Left variant -- flights without a reading that day keep nulls."""
    return _join(spark, sf, "left")


LAG = 2 * 3600
#: Departures (every event, from a station of its own) and the readings that the stations took.
DEPARTURES_SQL = "SELECT event_id, 'ST' || CAST(event_id % 9 AS VARCHAR) AS station, ts AS departure FROM events"
READINGS_SQL = ("SELECT station, weather_ts, max({'reading': reading, 'event_id': event_id}) AS r FROM (SELECT * FROM weather "
                "WHERE event_id % 7 <> 0) w GROUP BY 1, 2")


@query("join_weather_as_of", with_ctes(
    "SELECT f.event_id, f.station, strftime(w.weather_ts, '%Y-%m-%d %H:%M:%S.%f') AS weather_ts, w.r.reading AS reading, "
    f"w.r.event_id AS reading_id FROM departures f ASOF LEFT JOIN readings w ON f.station = w.station "
    f"AND f.departure - INTERVAL {LAG} SECOND >= w.weather_ts",
    weather=S.weather_sql(), departures=DEPARTURES_SQL, readings=READINGS_SQL))
def join_weather_as_of(spark, sf):
    """Every departure with the last weather reading of its station known two hours before (one station has none)."""
    ev = scan(spark, sf, "events", ["event_id", "ts"])
    flights = ev.select("event_id", F.expr("'ST' || CAST(event_id % 9 AS STRING)").alias("station"), F.col("ts").alias("departure"))
    w = S.weather(spark, sf).filter("event_id % 7 <> 0").select("station", "weather_ts", "reading", F.col("event_id").alias("reading_id"))
    j = J.join_as_of(flights, w, "departure", "weather_ts", ["station"], ["reading", "reading_id"], lag_seconds=LAG)
    return j.select("event_id", "station", F.date_format("weather_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("weather_ts"),
                    "reading", "reading_id")


@query("join_dimension",
       "SELECT r_name, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
       "JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def join_dimension(spark, sf):
    """Attach origin region (nation, region: small dimensions) to every line."""
    li = scan(spark, sf, "lineitem", ["l_suppkey"])
    sup = scan(spark, sf, "supplier", ["s_suppkey", "s_nationkey"])
    nat = scan(spark, sf, "nation", ["n_nationkey", "n_regionkey"])
    reg = scan(spark, sf, "region", ["r_regionkey", "r_name"])
    geo = J.join_dimension(nat, reg, nat.n_regionkey == reg.r_regionkey, "inner")
    s = J.join_dimension(sup, geo, sup.s_nationkey == geo.n_nationkey, "inner").select("s_suppkey", "r_name")
    return J.aggregate_through_dimension(li, ["l_suppkey"], [(s, "l_suppkey", "s_suppkey")], ["r_name"], count_name="n")


@query("duplicate_counts",
       "SELECT copies, count(*) AS n_keys FROM (SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem "
       "GROUP BY 1, 2) k GROUP BY copies")
def duplicate_counts(spark, sf):
    """Keys seen once, twice, ... -- (l_orderkey, l_linenumber) is not unique."""
    return J.duplicate_counts(scan(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"]), ["l_orderkey", "l_linenumber"])


_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus", "l_shipdate"]


@query("deduplicate",
       "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
       + ", ".join(f"{c} NULLS LAST" for c in _LI_REST) + ") AS rn FROM lineitem) x WHERE rn = 1")
def deduplicate(spark, sf):
    """One row per (l_orderkey, l_linenumber), the smallest by the remaining columns."""
    return J.deduplicate(scan(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LI_REST)
