"""Flight+weather feature-flow queries (the P2 notebook; SURVEY B7-B15, C11-C16, D13-D15, E1, H6, H8, J10, J15)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plover.functions import flight_timestamp, label_from_threshold, parse_number_text, parse_timestamp
from plover.functions.labels import label_audit as _label_audit
from plover.operators import clean as C
from plover.operators import features as FT
from plover.operators import profile
from plover.operators.rolling import lagged_range_mean, tumbling_mean as _tumbling_mean
from plover.plans import standins as S
from plover.plans.registry import query, rounded, with_ctes
from plover.sources.tables import scan, table_path
from plover.streaming import TumblingMeanStream

OT = S.otpw_sql()
WX = S.weather_sql()
R = 6
HOURLY = ["HourlyPrecipitation", "HourlyVisibility", "HourlyWindGustSpeed", "HourlyWindSpeed"]
ROLLING = [f"rolling_{c}_average" for c in HOURLY]
HOURS = 3600
LO, HI = 6 * HOURS, 2 * HOURS
NUDGE = 1e-9  # readings have two decimals: a mean of 32 lies exactly between two sixth digits; both sides round it up


def labelled(spark, sf):
    """P2:130 -- rows with a missing label dropped."""
    return C.drop_missing(S.otpw(spark, sf), ["ARR_DEL15"])


LABELLED_SQL = "SELECT * FROM otpw WHERE ARR_DEL15 IS NOT NULL AND NOT isnan(ARR_DEL15)"


def experiment(spark, sf):
    """P2:185-216: timestamps parsed, features selected and cast to float."""
    df = labelled(spark, sf).withColumns({
        "flight_datetime": flight_timestamp("FL_DATE", "CRS_DEP_TIME"),
        "weather_datetime": parse_timestamp("DATE"),
    })
    exp = df.select("event_id", "flight_datetime", "weather_datetime", *HOURLY, "DEP_DEL15")
    return C.cast_many(exp, HOURLY, "float")


_FLIGHT_TS_SQL = (
    "CASE WHEN CRS_DEP_TIME IS NULL THEN NULL "
    "WHEN lpad(CAST(CRS_DEP_TIME AS VARCHAR), 4, '0') = '2400' "
    "THEN try_strptime(FL_DATE, '%Y-%m-%d') + INTERVAL 1 DAY "
    "ELSE try_strptime(FL_DATE || ' ' || lpad(CAST(CRS_DEP_TIME AS VARCHAR), 4, '0'), '%Y-%m-%d %H%M') END")
EXPERIMENT_SQL = (
    f"SELECT event_id, {_FLIGHT_TS_SQL} AS flight_datetime, "
    "try_strptime(DATE, '%Y-%m-%dT%H:%M:%S') AS weather_datetime, "
    + ", ".join(f"TRY_CAST(trim({c}) AS FLOAT) AS {c}" for c in HOURLY)
    + ", DEP_DEL15 FROM labelled")


def rolled(spark, sf):
    """E1 on the experiment table: lagged 6h..2h means of the four readings, no key."""
    exp = experiment(spark, sf)
    return lagged_range_mean(exp, "weather_datetime", HOURLY, LO, HI, id_cols=["event_id"],
                             keep_cols=[c for c in exp.columns if c != "event_id"])


_ROLLED_SQL = (
    "SELECT *, " + ", ".join(
        f"avg({c}) OVER (ORDER BY epoch_us(weather_datetime) // 1000000 RANGE BETWEEN {LO} PRECEDING AND {HI} PRECEDING) "
        f"AS rolling_{c}_average" for c in HOURLY) + " FROM exp")


def _ctes(**extra):
    base = {"otpw": OT, "labelled": LABELLED_SQL, "exp": EXPERIMENT_SQL}
    base.update(extra)
    return base


# ------------------------------------------------------------------ B7, B8, B9, B15
@query("label_from_threshold", with_ctes(
    "SELECT event_id, CASE WHEN ARR_DELAY >= 15.0 THEN 1 ELSE 0 END AS MY_ARR_DEL15 FROM otpw", otpw=OT))
def label_from_threshold_q(spark, sf):
    return S.otpw(spark, sf).select("event_id", label_from_threshold("ARR_DELAY", 15.0).alias("MY_ARR_DEL15"))


@query("label_audit", with_ctes(
    "SELECT count(*) AS n_rows, count_if(m <> ARR_DEL15) AS n_discrepant, count_if(ARR_DEL15 IS NULL) AS n_recorded_null, "
    "count_if(m IS DISTINCT FROM ARR_DEL15) AS n_discrepant_null_safe "
    "FROM (SELECT *, CASE WHEN ARR_DELAY >= 15.0 THEN 1 ELSE 0 END AS m FROM otpw) x", otpw=OT))
def label_audit(spark, sf):
    return _label_audit(S.otpw(spark, sf), "ARR_DELAY", "ARR_DEL15", 15.0)


@query("drop_columns", with_ctes(
    "SELECT * EXCLUDE (ARR_DEL15, m), (m = ARR_DEL15) AS arr_del15_correct "
    "FROM (SELECT *, CASE WHEN ARR_DELAY >= 15.0 THEN 1 ELSE 0 END AS m FROM otpw) x", otpw=OT))
def drop_columns(spark, sf):
    """The audit column added, helper and recorded label dropped."""
    df = S.otpw(spark, sf).withColumn("MY_ARR_DEL15", label_from_threshold("ARR_DELAY", 15.0))
    df = df.withColumn("arr_del15_correct", F.col("MY_ARR_DEL15") == F.col("ARR_DEL15"))
    return df.drop("MY_ARR_DEL15").drop("ARR_DEL15")


@query("dropped_share", with_ctes(
    "SELECT count(*) AS n_before, count_if(ARR_DEL15 IS NOT NULL AND NOT isnan(ARR_DEL15)) AS n_after, "
    f"round((count(*) - count_if(ARR_DEL15 IS NOT NULL AND NOT isnan(ARR_DEL15))) * 100.0 / count(*), {R}) "
    "AS dropped_pct FROM otpw", otpw=OT))
def dropped_share(spark, sf):
    return C.dropped_share(S.otpw(spark, sf), ["ARR_DEL15"])


@query("drop_missing_any", with_ctes(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ARR_DELAY, DEP_DELAY FROM flights "
    "WHERE ARR_DELAY IS NOT NULL AND NOT isnan(ARR_DELAY) AND DEP_DELAY IS NOT NULL AND NOT isnan(DEP_DELAY)",
    flights=S.flights_sql()))
def drop_missing_any(spark, sf):
    """``na.drop()`` over the projected columns."""
    f = S.flights(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ARR_DELAY", "DEP_DELAY")
    return C.drop_missing(f)


@query("drop_missing_subset", with_ctes(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CARRIER_DELAY FROM flights "
    "WHERE FL_DATE IS NOT NULL AND ARR_DELAY IS NOT NULL AND NOT isnan(ARR_DELAY) "
    "AND DEP_DELAY IS NOT NULL AND NOT isnan(DEP_DELAY)", flights=S.flights_sql()))
def drop_missing_subset(spark, sf):
    """``na.drop(subset=..)``; other columns may stay null."""
    f = C.drop_missing(S.flights(spark, sf), ["FL_DATE", "ARR_DELAY", "DEP_DELAY"])
    return f.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "CARRIER_DELAY")


# ------------------------------------------------------------------ D13-D15, J15
def _missing_sql(table: str, cols_types: list[tuple[str, bool]], select: str, where: str = "") -> str:
    parts = []
    for c, floating in cols_types:
        cond = f"{c} IS NULL OR isnan({c})" if floating else f"{c} IS NULL"
        parts.append(f"SELECT '{c}' AS column, count_if({cond}) AS n_missing, count(*) AS n_rows FROM {table}")
    select = select.replace("column,", '"column",', 1)
    body = f"SELECT {select} FROM ({' UNION ALL '.join(parts)}) m"
    return body + (f" WHERE {where}" if where else "")


_OTPW_TYPES = [("event_id", False), ("FL_DATE", False), ("CRS_DEP_TIME", False), ("ARR_DELAY", True),
               ("DEP_DELAY", True), ("ARR_DEL15", True), ("DEP_DEL15", True), ("DATE", False),
               ("HourlyPrecipitation", False), ("HourlyVisibility", False), ("HourlyWindSpeed", False),
               ("HourlyWindGustSpeed", False)]
_WX_TYPES = [("event_id", False), ("station", False), ("weather_ts", False), ("DATE", False),
             ("HourlyPrecipitation", False), ("HourlyVisibility", False), ("HourlyWindSpeed", False),
             ("HourlyWindGustSpeed", False), ("reading", True), ("DailyAverageDryBulbTemperature", True)]
_PCT = f"round(n_missing * 100.0 / n_rows, {R}) AS missing_pct"


@query("missing_counts", with_ctes(_missing_sql("weather", _WX_TYPES, "column, n_missing"), weather=WX))
def missing_counts(spark, sf):
    """Null (and NaN for doubles) per column, every column in one pass."""
    return profile.missing_counts(S.weather(spark, sf)).select("column", "n_missing")


@query("missing_label", with_ctes(
    "SELECT count_if(ARR_DEL15 IS NULL OR isnan(ARR_DEL15)) AS ARR_DEL15 FROM otpw", otpw=OT))
def missing_label(spark, sf):
    """D13 on the label only (P2:122)."""
    return profile.missing_counts(S.otpw(spark, sf), ["ARR_DEL15"]).select(F.col("n_missing").alias("ARR_DEL15"))


@query("missing_percent", with_ctes(_missing_sql("labelled", _OTPW_TYPES, f"column, n_missing, {_PCT}"),
                                    otpw=OT, labelled=LABELLED_SQL))
def missing_percent(spark, sf):
    """Missing share per column, in percent of the labelled rows."""
    m = profile.missing_counts(labelled(spark, sf))
    return rounded(m.select("column", "n_missing", "missing_pct"), R)


@query("columns_with_missing", with_ctes(_missing_sql("labelled", _OTPW_TYPES, f"column, {_PCT}", "n_missing > 0"),
                                         otpw=OT, labelled=LABELLED_SQL))
def columns_with_missing(spark, sf):
    """One job for all columns (the reference ran one job per column)."""
    return rounded(profile.columns_with_missing(labelled(spark, sf)).select("column", "missing_pct"), R)


@query("columns_mostly_null", with_ctes(
    _missing_sql("labelled", _OTPW_TYPES, f"column, {_PCT}", "n_missing * 100.0 / n_rows >= 50"),
    otpw=OT, labelled=LABELLED_SQL))
def columns_mostly_null(spark, sf):
    """Columns at least half missing -- candidates to drop."""
    return rounded(profile.columns_mostly_null(labelled(spark, sf), 50.0).select("column", "missing_pct"), R)


_ROLL_TYPES = [("flight_datetime", False), ("weather_datetime", False)] + [(c, True) for c in ROLLING]


@query("missing_rolling", with_ctes(_missing_sql("rolled", _ROLL_TYPES, "column, n_missing"),
                                    **_ctes(rolled=_ROLLED_SQL)))
def missing_rolling(spark, sf):
    """D13 after the rolling features (timestamps: null only)."""
    r = rolled(spark, sf)
    return profile.missing_counts(r, ["flight_datetime", "weather_datetime"] + ROLLING).select("column", "n_missing")


_ROLLED_MISSING = " OR ".join(
    [f"{c} IS NULL" for c in ("flight_datetime", "weather_datetime")]
    + [f"{c} IS NULL OR isnan({c})" for c in [*HOURLY, "DEP_DEL15", *ROLLING]])


@query("dropped_share_rolled", with_ctes(
    f"SELECT count(*) AS n_before, count_if(NOT miss) AS n_after, round((count(*) - count_if(NOT miss)) * 100.0 / count(*), {R}) "
    f"AS dropped_pct FROM (SELECT ({_ROLLED_MISSING}) AS miss FROM rolled) r", **_ctes(rolled=_ROLLED_SQL)))
def dropped_share_rolled(spark, sf):
    """B15 over all columns after the rolling step."""
    return C.dropped_share(rolled(spark, sf).drop("event_id"))


# ------------------------------------------------------------------ C11-C13, B10/C15
@query("flight_timestamp", with_ctes(
    "SELECT event_id, strftime(flight_datetime, '%Y-%m-%d %H:%M:%S') AS flight_datetime, "
    "strftime(weather_datetime, '%Y-%m-%d %H:%M:%S') AS weather_datetime FROM exp", **_ctes()))
def flight_timestamp_q(spark, sf):
    e = experiment(spark, sf)
    fmt = "yyyy-MM-dd HH:mm:ss"
    return e.select("event_id", F.date_format("flight_datetime", fmt).alias("flight_datetime"),
                    F.date_format("weather_datetime", fmt).alias("weather_datetime"))


@query("cast_many", with_ctes(f"SELECT event_id, {', '.join(HOURLY)} FROM exp", **_ctes()))
def cast_many(spark, sf):
    return experiment(spark, sf).select("event_id", *HOURLY)


# ------------------------------------------------------------------ E1 (+ keyed), J10
@query("rolling_mean_lagged", with_ctes(
    f"SELECT event_id, {', '.join(f'round({c}, {R}) AS {c}' for c in ROLLING)} FROM rolled",
    **_ctes(rolled=_ROLLED_SQL)))
def rolling_mean_lagged(spark, sf):
    """Keyless lagged range-window means, computed partitioned by time bucket."""
    return rounded(rolled(spark, sf).select("event_id", *ROLLING), R)


@query("rolling_mean_lagged_by_key", with_ctes(
    f"SELECT event_id, station, round(avg(reading) OVER (PARTITION BY station ORDER BY epoch_us(weather_ts) // 1000000 "
    f"RANGE BETWEEN {LO} PRECEDING AND {HI} PRECEDING) + {NUDGE}, {R}) AS rolling_reading_average FROM weather", weather=WX))
def rolling_mean_lagged_by_key(spark, sf):
    """E1 with a partition key (station); NaN readings make their frames NaN."""
    w = S.weather(spark, sf)
    out = lagged_range_mean(w, "weather_ts", ["reading"], LO, HI, id_cols=["event_id"], partition_cols=["station"])
    return rounded(out.withColumn("rolling_reading_average", F.col("rolling_reading_average") + NUDGE), R)


_TUMBLING_SQL = with_ctes(
    "SELECT strftime(time_bucket(INTERVAL '4 hours', weather_ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') "
    "AS window_start, strftime(time_bucket(INTERVAL '4 hours', weather_ts, TIMESTAMP '1970-01-01') + INTERVAL '4 hours', "
    f"'%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS n, round(avg(p), {R}) AS mean "
    "FROM (SELECT *, TRY_CAST(trim(HourlyPrecipitation) AS DOUBLE) AS p FROM weather) w GROUP BY 1, 2", weather=WX)
_TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def _windows(t):
    return rounded(t.select(F.date_format("window_start", _TIME_TEXT).alias("window_start"),
                            F.date_format("window_end", _TIME_TEXT).alias("window_end"), "n", "mean"), R)


@query("tumbling_mean", _TUMBLING_SQL)
def tumbling_mean(spark, sf):
    """4-hour tumbling mean of the precipitation reading."""
    w = S.weather(spark, sf).withColumn("p", parse_number_text("HourlyPrecipitation"))
    return _windows(_tumbling_mean(w, "weather_ts", "p", "4 hours"))


@query("tumbling_mean_stream", _TUMBLING_SQL)
def tumbling_mean_stream(spark, sf):
    """J10 as a stream over the files of events: watermark, state in the shared folder, run to the end of the files."""
    source = table_path(sf, "events")

    def readings(events):
        return S.weather_of(events).select("weather_ts", parse_number_text("HourlyPrecipitation").alias("p"))

    # the star makes a pattern of the path: a table may be one file or a folder of them
    stream = TumblingMeanStream(spark, f"{source}*", spark.read.parquet(source).schema, "weather_ts", "p", prepare=readings)
    return _windows(stream.finish())


# ------------------------------------------------------------------ D13/D14 on a very wide table
_WIDE = 200


def _wide_cols():
    return [f"CASE WHEN (l_orderkey + l_linenumber * {i}) % {i % 9 + 2} = 0 THEN NULL ELSE l_partkey % {i + 1} END AS w{i}"
            for i in range(_WIDE)]


@query("missing_wide", with_ctes(
    "SELECT name AS column, n_rows - value AS n_missing, n_rows, round((n_rows - value) * 100.0 / n_rows, 6) AS missing_pct "
    "FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM wide) ON *), (SELECT count(*) AS n_rows FROM wide) t",
    wide=f"SELECT {', '.join(_wide_cols())} FROM lineitem"))
def missing_wide(spark, sf):
    """D13/D14 on 200 columns in one scan."""
    wide = scan(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"], heavy_rows=True).selectExpr(*_wide_cols())
    return rounded(profile.column_states(wide).drop("n_distinct"), 6)


# ------------------------------------------------------------------ H6, H8
def assembled(spark, sf):
    """H6: VectorAssembler(handleInvalid='skip') over the rolling features."""
    va = VectorAssembler(inputCols=ROLLING, outputCol="features", handleInvalid="skip")
    return va.transform(rolled(spark, sf))


_KEPT = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in ROLLING)


@query("assemble_skip", with_ctes(
    "SELECT count(*) AS n_kept, " + ", ".join(f"round(sum({c}), 4) AS sum_{i}" for i, c in enumerate(ROLLING))
    + f" FROM rolled WHERE {_KEPT}", **_ctes(rolled=_ROLLED_SQL)))
def assemble_skip(spark, sf):
    a = assembled(spark, sf).select(vector_to_array("features").alias("v"))
    return rounded(a.agg(F.count(F.lit(1)).alias("n_kept"),
                         *[F.sum(F.col("v")[i]).alias(f"sum_{i}") for i in range(len(ROLLING))]), 4)


@query("scale_std_only", with_ctes(
    "SELECT event_id, " + ", ".join(
        f"round({c} / (SELECT stddev_samp({c}) FROM kept), {R}) AS s{i}" for i, c in enumerate(ROLLING))
    + " FROM kept", **_ctes(rolled=_ROLLED_SQL, kept=f"SELECT * FROM rolled WHERE {_KEPT}")))
def scale_std_only(spark, sf):
    """H8: ``StandardScaler()`` defaults (withStd only), fitted then applied."""
    a = assembled(spark, sf)
    scaled = FT.scaler("features", "scaled", with_mean=False).fit(a).transform(a)
    out = scaled.select("event_id", vector_to_array("scaled").alias("v"))
    return rounded(out.select("event_id", *[F.col("v")[i].alias(f"s{i}") for i in range(len(ROLLING))]), R)
