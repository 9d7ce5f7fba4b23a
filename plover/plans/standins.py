"""Stand-in tables derived from the driver's parquet tables.

The reference reads flight, weather, loan and score tables we do not have.
Each stand-in below is derived row-for-row from the given tables, so its size
grows with them.  Every column is one SQL expression; where Spark SQL and
DuckDB spell it differently both spellings are given, so the Spark view and
the oracle CTE compute the same values.  Dirty values (nulls, NaN, junk text)
are planted by arithmetic rules on keys, identically on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plover.sources.tables import scan


@dataclass(frozen=True)
class Col:
    name: str
    spark: str
    duck: str | None = None

    def sql(self, dialect: str) -> str:
        return self.duck if (dialect == "duck" and self.duck is not None) else self.spark


def _select_list(cols: list[Col], dialect: str) -> str:
    return ",\n  ".join(f"{c.sql(dialect)} AS {c.name}" for c in cols)


def _apply(df: DataFrame, cols: list[Col]) -> DataFrame:
    return df.selectExpr(*[f"{c.sql('spark')} AS {c.name}" for c in cols])


# ---------------------------------------------------------------- flights
# lineitem x orders; day difference folded to +-180 is the delay in minutes.
_D = Col(
    "d",
    "datediff(CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE)) % 180",
    "date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) % 180",
)
_ARR_NULL = "(l_orderkey + l_linenumber) % 11 = 0"
_DEP_NULL = "(l_orderkey + l_linenumber) % 13 = 0"
_CLOCK_ARR = "((l_orderkey * 7 + l_linenumber * 131 + 3) % 25)"


def _flight_cols(d: str) -> list[Col]:
    reason = f"{d} >= 15 AND NOT ({_ARR_NULL})"
    return [
        Col("FL_DATE", "CAST(o_orderdate AS DATE)"),
        Col("OP_UNIQUE_CARRIER", "'C' || CAST(l_suppkey % 17 AS STRING)"),
        Col("ARR_DELAY", f"CASE WHEN {_ARR_NULL} THEN NULL ELSE CAST({d} AS DOUBLE) END"),
        Col("DEP_DELAY", f"CASE WHEN {_DEP_NULL} THEN NULL ELSE CAST({d} AS DOUBLE) - l_quantity + 10 END"),
        Col("CARRIER_DELAY", f"CASE WHEN {reason} THEN CAST({d} * CAST(round(l_tax * 100) AS INT) AS DOUBLE) / 20 END"),
        Col("WEATHER_DELAY", f"CASE WHEN {reason} THEN CAST({d} * CAST(round(l_discount * 100) AS INT) AS DOUBLE) / 100 END"),
        Col("NAS_DELAY", f"CASE WHEN {reason} THEN CAST(l_linenumber * 3 AS DOUBLE) END"),
        Col("SECURITY_DELAY", f"CASE WHEN {reason} THEN CAST(CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END AS DOUBLE) END"),
        Col("LATE_AIRCRAFT_DELAY", f"CASE WHEN {reason} THEN CAST({d} * 3 AS DOUBLE) / 10 END"),
        Col("CRS_DEP_TIME", "CAST(((l_orderkey * 7 + l_linenumber * 131) % 24) * 100 + l_partkey % 60 AS INT)"),
        Col(
            "CRS_ARR_TIME",
            f"CAST(CASE WHEN {_CLOCK_ARR} = 24 THEN 2400 ELSE {_CLOCK_ARR} * 100 + (l_partkey * 7) % 60 END AS INT)",
        ),
        Col("DISTANCE", "l_extendedprice / l_quantity"),
        Col(
            "ARR_DEL15",
            f"CASE WHEN {_ARR_NULL} THEN NULL WHEN l_orderkey % 97 = 0 "
            f"THEN CAST(CASE WHEN {d} >= 15 THEN 0 ELSE 1 END AS DOUBLE) "
            f"ELSE CAST(CASE WHEN {d} >= 15 THEN 1 ELSE 0 END AS DOUBLE) END",
        ),
    ]


_FLIGHT_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def flights(spark: SparkSession, sf_dir: str, cities: bool = False, lineitem: DataFrame | None = None,
            orders: DataFrame | None = None) -> DataFrame:
    """Flight stand-in: one row per lineitem (sort-merge join on the order key).

    ``cities`` adds ORIGIN/DEST city names (supplier / customer nation).  Those
    two extra joins are only planned when a query needs the names.
    ``lineitem`` / ``orders``: pre-laid-out tables (e.g. ``sources.tables.colocate``
    on the order key) instead of the parquet files; the join then needs no shuffle.
    """
    li = (lineitem if lineitem is not None else scan(spark, sf_dir, "lineitem")).select(
        *_FLIGHT_KEYS, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    od = (orders if orders is not None else scan(spark, sf_dir, "orders")).select("o_orderkey", "o_orderdate", "o_custkey")
    extra: list[str] = []
    if cities:  # customers join the orders, a quarter of the rows, before those meet the lines
        cus = dest_cities(spark, sf_dir)
        od = od.join(cus, od.o_custkey == cus.c_custkey).drop("c_custkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    if cities:
        sup = origin_cities(spark, sf_dir)
        j = j.join(sup, j.l_suppkey == sup.s_suppkey)
        extra = ["ORIGIN_CITY_NAME", "DEST_CITY_NAME"]
    j = j.withColumn("d", F.expr(_D.spark))
    cols = _flight_cols("d")
    return j.selectExpr(*_FLIGHT_KEYS, "o_custkey", *[f"{c.spark} AS {c.name}" for c in cols], *extra)


def flights_sql(cities: bool = False) -> str:
    cols = _flight_cols("d")
    city_join = ""
    extra = ""
    if cities:
        city_join = (
            " JOIN supplier s ON l_suppkey = s.s_suppkey JOIN nation ns ON s.s_nationkey = ns.n_nationkey"
            " JOIN customer c ON o_custkey = c.c_custkey JOIN nation nc ON c.c_nationkey = nc.n_nationkey"
        )
        extra = ",\n  ns.n_name AS ORIGIN_CITY_NAME, nc.n_name AS DEST_CITY_NAME"
    return (
        f"SELECT {', '.join(_FLIGHT_KEYS)}, o_custkey,\n  {_select_list(cols, 'duck')}{extra}\n"
        f"FROM (SELECT *, {_D.duck} AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey) b{city_join}"
    )


# ---------------------------------------------------------------- weather readings (events)
_FLOOR_V = "CAST(floor(value) AS BIGINT)"
WEATHER_COLS = [
    Col("event_id", "event_id"),
    Col("station", "'ST' || CAST(user_id % 8 AS STRING)"),
    Col("weather_ts", "ts"),
    Col("DATE", "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")", "strftime(ts, '%Y-%m-%dT%H:%M:%S')"),
    Col(
        "HourlyPrecipitation",
        "CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 'T' "
        "WHEN event_id % 19 = 0 THEN '0.00s' ELSE CAST(" + _FLOOR_V + " % 50 AS STRING) END",
    ),
    Col(
        "HourlyVisibility",
        "CASE WHEN event_id % 10 = 3 THEN NULL ELSE ' ' || CAST(" + _FLOOR_V + " % 11 AS STRING) || ' ' END",
    ),
    Col(
        "HourlyWindSpeed",
        "CASE WHEN event_id % 29 = 0 THEN '2500' WHEN event_id % 10 = 5 THEN NULL "
        "ELSE CAST(" + _FLOOR_V + " % 40 AS STRING) END",
    ),
    Col("HourlyWindGustSpeed", "CASE WHEN event_id % 4 = 0 THEN CAST(" + _FLOOR_V + " % 60 AS STRING) END"),
    Col(
        "reading",
        "CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 23 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END",
    ),
    Col("DailyAverageDryBulbTemperature", "round(value % 60 + 10, 2)"),
]


def weather_of(events: DataFrame) -> DataFrame:
    """The readings of a batch or streaming frame of events."""
    return _apply(events, WEATHER_COLS)


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_of(scan(spark, sf_dir, "events", ["event_id", "user_id", "ts", "value"]))


def weather_sql() -> str:
    return f"SELECT {_select_list(WEATHER_COLS, 'duck')}\nFROM events"


# ---------------------------------------------------------------- flights joined with weather (P2 "OTPW" CSV)
_ARR2_NULL = "event_id % 31 = 0"
_DEP2_NULL = "event_id % 37 = 0"
OTPW_COLS = [
    Col("event_id", "event_id"),
    Col("FL_DATE", "CAST(CAST(ts AS DATE) AS STRING)"),
    Col("CRS_DEP_TIME", "CAST(hour(ts) * 100 + minute(ts) AS INT)"),
    Col("ARR_DELAY", f"CASE WHEN {_ARR2_NULL} THEN NULL ELSE round(value - 50, 2) END"),
    Col("DEP_DELAY", f"CASE WHEN {_DEP2_NULL} THEN NULL ELSE round(value - 55, 2) END"),
    Col(
        "ARR_DEL15",
        f"CASE WHEN {_ARR2_NULL} THEN NULL WHEN event_id % 53 = 0 "
        "THEN CAST(CASE WHEN round(value - 50, 2) >= 15 THEN 0 ELSE 1 END AS DOUBLE) "
        "ELSE CAST(CASE WHEN round(value - 50, 2) >= 15 THEN 1 ELSE 0 END AS DOUBLE) END",
    ),
    Col(
        "DEP_DEL15",
        f"CASE WHEN {_DEP2_NULL} THEN NULL ELSE CAST(CASE WHEN round(value - 55, 2) >= 15 THEN 1 ELSE 0 END AS DOUBLE) END",
    ),
] + [c for c in WEATHER_COLS if c.name in (
    "DATE", "HourlyPrecipitation", "HourlyVisibility", "HourlyWindSpeed", "HourlyWindGustSpeed")]


def otpw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = scan(spark, sf_dir, "events", ["event_id", "ts", "value"], heavy_rows=True)
    return _apply(ev, OTPW_COLS)


def otpw_sql() -> str:
    return f"SELECT {_select_list(OTPW_COLS, 'duck')}\nFROM events"


# ---------------------------------------------------------------- loans (LW)
# Discounted price in whole cents (integer arithmetic, then one division), so
# both engines produce bit-identical doubles and later rounding never meets a
# half-way case.
PAID = ("floor(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) / 100)"
        " / 100")
_TENURE = (
    "CASE l_partkey % 12 WHEN 0 THEN 'n/a' WHEN 1 THEN '< 1 year' WHEN 2 THEN '1 year' "
    "WHEN 11 THEN '10+ years' ELSE CAST(l_partkey % 12 - 1 AS STRING) || ' years' END"
)
LOAN_COLS = [
    Col("l_orderkey", "l_orderkey"),
    Col("l_linenumber", "l_linenumber"),
    Col("l_partkey", "l_partkey"),
    Col("l_suppkey", "l_suppkey"),
    Col(
        "loan_status",
        "CASE WHEN o_orderstatus = 'F' THEN 'Fully Paid' WHEN o_orderstatus = 'O' AND l_linenumber = 1 THEN 'Default' "
        "WHEN o_orderstatus = 'O' THEN 'Charged Off' ELSE 'Current' END",
    ),
    Col(
        "int_rate",
        "CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE CAST(CAST(round(l_discount * 100) AS INT) AS STRING) || '.' "
        "|| CAST(CAST(round(l_tax * 100) AS INT) % 10 AS STRING) || '%' END",
    ),
    Col("revol_util", "CASE WHEN l_partkey % 13 = 0 THEN '' ELSE CAST(l_partkey % 100 AS STRING) || '%' END"),
    Col("issue_d", "date_format(o_orderdate, 'MMM-yyyy')", "strftime(o_orderdate, '%b-%Y')"),
    Col(
        "earliest_cr_line",
        "date_format(l_shipdate, 'MMM') || '-' || CAST(year(l_shipdate) - 6 - CAST(l_partkey % 20 AS INT) AS STRING)",
        "strftime(l_shipdate, '%b') || '-' || CAST(year(l_shipdate) - 6 - CAST(l_partkey % 20 AS INT) AS STRING)",
    ),
    Col("emp_length", _TENURE),
    Col(
        "verification_status",
        "CASE l_suppkey % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Source Verified' ELSE 'Not Verified' END",
    ),
    Col("total_pymnt", PAID),
    Col("loan_amnt", "l_quantity * 1000"),
    Col("grade", "l_returnflag"),
    Col("annual_inc", "CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE o_totalprice END"),
    Col("dti", "CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE round(l_tax * 300 + l_discount * 100, 2) END"),
    Col("delinq_2yrs", "CAST(l_linenumber - 1 AS INT)"),
    Col("total_acc", "CAST(l_partkey % 40 + 1 AS INT)"),
    Col("addr_state", "'ST' || CAST(o_custkey % 51 AS STRING)"),
    Col("term", "CASE WHEN l_quantity > 25 THEN ' 60 months' ELSE ' 36 months' END"),
    Col("home_ownership", "CASE o_custkey % 4 WHEN 0 THEN 'RENT' WHEN 1 THEN 'OWN' WHEN 2 THEN 'MORTGAGE' ELSE 'OTHER' END"),
    Col(
        "purpose",
        "CASE l_partkey % 5 WHEN 0 THEN 'debt_consolidation' WHEN 1 THEN 'credit_card' WHEN 2 THEN 'home_improvement' "
        "WHEN 3 THEN 'major_purchase' ELSE 'other' END",
    ),
    Col("application_type", "CASE WHEN l_linenumber = 7 THEN 'Joint App' ELSE 'Individual' END"),
]


def loans_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw (dirty-text) loan table, one row per lineitem."""
    li = scan(spark, sf_dir, "lineitem", heavy_rows=True)
    od = scan(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice", "o_custkey"])
    return _apply(li.join(od, li.l_orderkey == od.o_orderkey), LOAN_COLS)


def loans_raw_sql() -> str:
    return f"SELECT {_select_list(LOAN_COLS, 'duck')}\nFROM lineitem JOIN orders ON l_orderkey = o_orderkey"


# ---------------------------------------------------------------- scores
SCORE_COLS = [
    Col("l_orderkey", "l_orderkey"),
    Col("l_linenumber", "l_linenumber"),
    Col("score_tied", "l_discount * 10"),
    Col("score", "l_extendedprice / 105000"),
    Col("label", "CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS DOUBLE)"),
    Col("net", f"{PAID} - l_quantity * 1000"),
]


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = scan(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_discount", "l_extendedprice",
                                          "l_returnflag", "l_quantity"])
    return _apply(li, SCORE_COLS)


def scores_sql() -> str:
    return f"SELECT {_select_list(SCORE_COLS, 'duck')}\nFROM lineitem"


def origin_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension: supplier key -> origin city (supplier nation name; nation is 25 rows by spec)."""
    nation = scan(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    sup = scan(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    return sup.join(nation, sup.s_nationkey == nation.n_nationkey).select(
        "s_suppkey", F.col("n_name").alias("ORIGIN_CITY_NAME"))


def dest_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension: customer key -> destination city (customer nation name)."""
    nation = scan(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    cus = scan(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    return cus.join(nation, cus.c_nationkey == nation.n_nationkey).select(
        "c_custkey", F.col("n_name").alias("DEST_CITY_NAME"))
