"""Flight and weather exploration queries (the FD notebook's cells, SURVEY D, F, J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plover.functions.parse import clock_hour, parse_number_text, route_name
from plover.operators import joins as J
from plover.operators import correlated, profile, rank
from plover.operators.clean import drop_missing
from plover.plans import standins as S
from plover.plans.registry import query, rounded, with_ctes
from plover.session import stored
from plover.sources.tables import scan

FL = S.flights_sql()
FLC = S.flights_sql(cities=True)
WX = S.weather_sql()
R = 6  # digits kept for floating results

ROUTE_FILTER = "ARR_DELAY IS NOT NULL AND NOT isnan(ARR_DELAY) AND DEP_DELAY IS NOT NULL AND NOT isnan(DEP_DELAY)"
REASONS = ["CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY"]


def _complete_flights(spark, sf, cols=("ARR_DELAY", "DEP_DELAY")):
    """Flights complete in the delay columns; city names are attached later, per key."""
    return drop_missing(S.flights(spark, sf), list(cols))


_CITY_DIM = {
    "ORIGIN_CITY_NAME": ("l_suppkey", "s_suppkey", S.origin_cities),
    "DEST_CITY_NAME": ("o_custkey", "c_custkey", S.dest_cities),
}


def _per_city(spark, sf, fact, city, means=None, count_name=None):
    """Aggregate per foreign key first, then join the small result to the city dimension."""
    fk, dk, dim = _CITY_DIM[city]
    return J.aggregate_through_dimension(fact, [fk], [(dim(spark, sf), fk, dk)], [city], means, count_name)


def _nonnull_dates(spark, sf):
    return drop_missing(S.flights(spark, sf), ["FL_DATE", "ARR_DELAY", "DEP_DELAY"])


# ------------------------------------------------------------------ D1, D2
@query("summary_stats", with_ctes(
    f"SELECT round(avg(ARR_DELAY), {R}) AS mean, round(stddev_samp(ARR_DELAY), {R}) AS stddev, "
    "min(ARR_DELAY) AS min, max(ARR_DELAY) AS max FROM flights", flights=FL))
def summary_stats(spark, sf):
    return rounded(profile.summary_stats(S.flights(spark, sf), "ARR_DELAY"), R)


@query("summary_stats_positive", with_ctes(
    f"SELECT round(avg(ARR_DELAY), {R}) AS mean, round(stddev_samp(ARR_DELAY), {R}) AS stddev, "
    "min(ARR_DELAY) AS min, max(ARR_DELAY) AS max FROM flights WHERE ARR_DELAY > 0", flights=FL))
def summary_stats_positive(spark, sf):
    return rounded(profile.summary_stats(S.flights(spark, sf).filter(F.col("ARR_DELAY") > 0), "ARR_DELAY"), R)


@query("summary_stats_dep_positive", with_ctes(
    f"SELECT round(avg(DEP_DELAY), {R}) AS mean, round(stddev_samp(DEP_DELAY), {R}) AS stddev, "
    "min(DEP_DELAY) AS min, max(DEP_DELAY) AS max FROM flights WHERE DEP_DELAY > 0", flights=FL))
def summary_stats_dep_positive(spark, sf):
    return rounded(profile.summary_stats(S.flights(spark, sf).filter(F.col("DEP_DELAY") > 0), "DEP_DELAY"), R)


@query("max_date", with_ctes("SELECT CAST(max(FL_DATE) AS VARCHAR) AS max_fl_date FROM flights", flights=FL))
def max_date(spark, sf):
    return S.flights(spark, sf).agg(F.max("FL_DATE").cast("string").alias("max_fl_date"))


# ------------------------------------------------------------------ D4, F2
@query("count_by_carrier", with_ctes(
    "SELECT OP_UNIQUE_CARRIER, count(*) AS flight_count FROM flights GROUP BY OP_UNIQUE_CARRIER", flights=FL))
def count_by_carrier(spark, sf):
    counts = profile.group_count(S.flights(spark, sf), ["OP_UNIQUE_CARRIER"], name="flight_count")
    return rank.sort_by(counts, "flight_count", ["OP_UNIQUE_CARRIER"], ascending=False)


def _top_counts(spark, sf, city):
    counts = _per_city(spark, sf, _complete_flights(spark, sf), city, count_name="count")
    return rank.top_k(counts, "count", 10, [city])


def _top_counts_sql(city):
    return with_ctes(
        f"SELECT {city}, count(*) AS count FROM flights WHERE {ROUTE_FILTER} GROUP BY {city} "
        f"ORDER BY count DESC, {city} LIMIT 10", flights=FLC)


@query("top_origin_counts", _top_counts_sql("ORIGIN_CITY_NAME"))
def top_origin_counts(spark, sf):
    return _top_counts(spark, sf, "ORIGIN_CITY_NAME")


@query("top_dest_counts", _top_counts_sql("DEST_CITY_NAME"))
def top_dest_counts(spark, sf):
    return _top_counts(spark, sf, "DEST_CITY_NAME")


# ------------------------------------------------------------------ D5, F3, F4 (flagship = top_origin_delay)
def _city_delay(spark, sf, city, measure, name, k, top):
    src = _nonnull_dates(spark, sf)
    means = _per_city(spark, sf, src, city, {name: measure})
    return rounded((rank.top_k if top else rank.bottom_k)(means, name, k, [city]), R)


def _city_delay_sql(city, measure, name, k, top):
    order = "DESC" if top else "ASC"
    return with_ctes(
        f"SELECT {city}, round(m, {R}) AS {name} FROM (SELECT {city}, avg({measure}) AS m FROM flights "
        f"WHERE FL_DATE IS NOT NULL AND ARR_DELAY IS NOT NULL AND NOT isnan(ARR_DELAY) "
        f"AND DEP_DELAY IS NOT NULL AND NOT isnan(DEP_DELAY) "
        f"GROUP BY {city} ORDER BY m {order}, {city} LIMIT {k}) t", flights=FLC)


@query("top_origin_delay", _city_delay_sql("ORIGIN_CITY_NAME", "ARR_DELAY", "avg_arr_delay", 10, True))
def top_origin_delay(spark, sf):
    """Flagship: scan -> drop missing -> group mean -> top 10 (FD's shape)."""
    return _city_delay(spark, sf, "ORIGIN_CITY_NAME", "ARR_DELAY", "avg_arr_delay", 10, True)


@query("top_dest_delay", _city_delay_sql("DEST_CITY_NAME", "DEP_DELAY", "avg_dep_delay", 10, True))
def top_dest_delay(spark, sf):
    return _city_delay(spark, sf, "DEST_CITY_NAME", "DEP_DELAY", "avg_dep_delay", 10, True)


@query("bottom_origin_delay", _city_delay_sql("ORIGIN_CITY_NAME", "ARR_DELAY", "avg_arr_delay", 10, False))
def bottom_origin_delay(spark, sf):
    return _city_delay(spark, sf, "ORIGIN_CITY_NAME", "ARR_DELAY", "avg_arr_delay", 10, False)


@query("bottom_dest_delay", _city_delay_sql("DEST_CITY_NAME", "DEP_DELAY", "avg_dep_delay", 10, False))
def bottom_dest_delay(spark, sf):
    return _city_delay(spark, sf, "DEST_CITY_NAME", "DEP_DELAY", "avg_dep_delay", 10, False)


@query("mean_by_carrier", with_ctes(
    f"SELECT OP_UNIQUE_CARRIER, round(avg(ARR_DELAY), {R}) AS avg_arr_delay FROM flights WHERE {ROUTE_FILTER} "
    "GROUP BY OP_UNIQUE_CARRIER", flights=FLC))
def mean_by_carrier(spark, sf):
    return rounded(profile.group_means(_complete_flights(spark, sf), ["OP_UNIQUE_CARRIER"],
                                       {"avg_arr_delay": "ARR_DELAY"}), R)


# ------------------------------------------------------------------ D8, C18, F5
_ROUTE_SQL = (f"SELECT ORIGIN_CITY_NAME, DEST_CITY_NAME, avg(ARR_DELAY) AS avg_arr_delay, "
              f"avg(DEP_DELAY) AS avg_dep_delay FROM flights WHERE {ROUTE_FILTER} "
              "GROUP BY ORIGIN_CITY_NAME, DEST_CITY_NAME")
_ROUTE_ROUNDED = f"round(avg_arr_delay, {R}) AS avg_arr_delay, round(avg_dep_delay, {R}) AS avg_dep_delay"


def _route_means(spark, sf):
    """Straight to the city pairs: partial aggregation leaves a few hundred rows per task."""
    f = drop_missing(S.flights(spark, sf, cities=True), ["ARR_DELAY", "DEP_DELAY"])
    return profile.group_means(f, ["ORIGIN_CITY_NAME", "DEST_CITY_NAME"],
                               {"avg_arr_delay": "ARR_DELAY", "avg_dep_delay": "DEP_DELAY"})


@query("route_means", with_ctes(
    f"SELECT ORIGIN_CITY_NAME, DEST_CITY_NAME, {_ROUTE_ROUNDED} FROM ({_ROUTE_SQL}) r", flights=FLC))
def route_means(spark, sf):
    return rounded(_route_means(spark, sf), R)


def _routes_ranked(spark, sf, by, top):
    r = _route_means(spark, sf).withColumn("route", route_name("ORIGIN_CITY_NAME", "DEST_CITY_NAME"))
    return rounded((rank.top_k if top else rank.bottom_k)(r, by, 5, ["route"]), R)


def _routes_sql(by, top):
    order = "DESC" if top else "ASC"
    return with_ctes(
        f"SELECT ORIGIN_CITY_NAME, DEST_CITY_NAME, {_ROUTE_ROUNDED}, route FROM (SELECT *, ORIGIN_CITY_NAME || ' - ' || "
        f"DEST_CITY_NAME AS route FROM ({_ROUTE_SQL}) r ORDER BY {by} {order}, route LIMIT 5) t", flights=FLC)


@query("top_routes", _routes_sql("avg_arr_delay", True))
def top_routes(spark, sf):
    return _routes_ranked(spark, sf, "avg_arr_delay", True)


@query("top_routes_dep", _routes_sql("avg_dep_delay", True))
def top_routes_dep(spark, sf):
    return _routes_ranked(spark, sf, "avg_dep_delay", True)


@query("bottom_routes", _routes_sql("avg_arr_delay", False))
def bottom_routes(spark, sf):
    return _routes_ranked(spark, sf, "avg_arr_delay", False)


@query("bottom_routes_dep", _routes_sql("avg_dep_delay", False))
def bottom_routes_dep(spark, sf):
    return _routes_ranked(spark, sf, "avg_dep_delay", False)


# ------------------------------------------------------------------ D9, D10, D11
@query("carrier_means", with_ctes(
    f"SELECT OP_UNIQUE_CARRIER, round(avg(DEP_DELAY), {R}) AS Avg_DEP_DELAY, round(avg(ARR_DELAY), {R}) AS Avg_ARR_DELAY, "
    f"round(avg(DISTANCE), {R}) AS Avg_DISTANCE FROM flights GROUP BY OP_UNIQUE_CARRIER", flights=FL))
def carrier_means(spark, sf):
    return rounded(profile.group_means(S.flights(spark, sf), ["OP_UNIQUE_CARRIER"], {
        "Avg_DEP_DELAY": "DEP_DELAY", "Avg_ARR_DELAY": "ARR_DELAY", "Avg_DISTANCE": "DISTANCE"}), R)


@query("neighbor_distance",
       f"SELECT l_suppkey AS neighbor_id, round(avg(l_quantity * 10), {R}) AS avg_distance_to_neighbor "
       "FROM lineitem GROUP BY l_suppkey ORDER BY avg_distance_to_neighbor, neighbor_id")
def neighbor_distance(spark, sf):
    """Stations stand-in = lineitem by supplier; mean distance, ascending."""
    st = scan(spark, sf, "lineitem", ["l_suppkey", "l_quantity"]).select(
        F.col("l_suppkey").alias("neighbor_id"), (F.col("l_quantity") * 10).alias("distance_to_neighbor"))
    g = rounded(profile.group_means(st, ["neighbor_id"], {"avg_distance_to_neighbor": "distance_to_neighbor"}), R)
    return rank.sort_by(g, "avg_distance_to_neighbor", ["neighbor_id"])


@query("mean_by_reason", with_ctes(
    " UNION ALL ".join(f"SELECT '{c}' AS column, round(avg({c}), {R}) AS mean FROM flights" for c in REASONS),
    flights=FL))
def mean_by_reason(spark, sf):
    return rounded(profile.means_long(S.flights(spark, sf), REASONS), R)


# ------------------------------------------------------------------ C9, D6
def _calendar(part, sql_fn):
    sql = with_ctes(
        f"SELECT CAST({sql_fn}(FL_DATE) AS INTEGER) AS {part}, round(avg(ARR_DELAY), {R}) AS avg_arr_delay "
        "FROM flights WHERE FL_DATE IS NOT NULL AND ARR_DELAY IS NOT NULL AND DEP_DELAY IS NOT NULL "
        f"GROUP BY {part}", flights=FL)

    def fn(spark, sf):
        return rounded(profile.mean_by_calendar(_nonnull_dates(spark, sf), "FL_DATE", part, "ARR_DELAY",
                                                "avg_arr_delay"), R)

    return sql, fn


for _part, _fn in (("year", "year"), ("month", "month"), ("day", "dayofmonth")):
    _sql, _q = _calendar(_part, _fn)
    query(f"mean_by_{_part}", _sql)(_q)


# ------------------------------------------------------------------ C7, C8, D7, F6
def _clock_sql(clock, measure, name, hour_name):
    return with_ctes(
        f"SELECT CAST(substring(lpad(CAST({clock} AS VARCHAR), 4, '0'), 1, 2) AS INTEGER) AS {hour_name}, "
        f"round(avg({measure}), {R}) AS {name} FROM flights GROUP BY {hour_name}", flights=FL)


@query("clock_hour_mean", _clock_sql("CRS_ARR_TIME", "ARR_DELAY", "avg_arr_delay", "arr_hour"))
def clock_hour_mean(spark, sf):
    f = S.flights(spark, sf).select(clock_hour("CRS_ARR_TIME").alias("arr_hour"), "ARR_DELAY")
    g = rounded(profile.group_means(f, ["arr_hour"], {"avg_arr_delay": "ARR_DELAY"}), R)
    return rank.sort_by(g, "arr_hour", [])


@query("clock_hour_mean_dep", _clock_sql("CRS_DEP_TIME", "DEP_DELAY", "avg_dep_delay", "dep_hour"))
def clock_hour_mean_dep(spark, sf):
    f = S.flights(spark, sf).select(clock_hour("CRS_DEP_TIME").alias("dep_hour"), "DEP_DELAY")
    g = rounded(profile.group_means(f, ["dep_hour"], {"avg_dep_delay": "DEP_DELAY"}), R)
    return rank.sort_by(g, "dep_hour", [])


@query("filter_cast_lt", with_ctes(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CRS_ARR_TIME FROM flights "
    "WHERE TRY_CAST(CAST(CRS_ARR_TIME AS VARCHAR) AS INTEGER) < 200", flights=FL))
def filter_cast_lt(spark, sf):
    """Bracket filter with a cast of the clock text."""
    f = S.flights(spark, sf)
    return f.filter(F.col("CRS_ARR_TIME").cast("string").try_cast("int") < 200).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "CRS_ARR_TIME")


# ------------------------------------------------------------------ D16, D17
def _hist_sql(col, bins, log, positive="ARR_DELAY"):
    x = f"log10({col})" if log else col
    return with_ctes(
        f"""SELECT b.bin, round(s.mn + b.bin * (s.mx - s.mn) / {bins}, {R}) AS lo,
       round(s.mn + (b.bin + 1) * (s.mx - s.mn) / {bins}, {R}) AS hi, coalesce(c.n, 0) AS n
FROM (SELECT range AS bin FROM range({bins})) b CROSS JOIN stats s
LEFT JOIN (SELECT least(CAST(floor((x - s.mn) / (s.mx - s.mn) * {bins}) AS BIGINT), {bins - 1}) AS bin,
                  count(*) AS n FROM v, stats s GROUP BY 1) c ON c.bin = b.bin""",
        flights=FL,
        v=f"SELECT {x} AS x FROM flights WHERE {positive} > 0 AND {col} > 0",
        raw="SELECT min(x) AS mn, max(x) AS mx FROM v",
        stats="SELECT CASE WHEN mx > mn THEN mn ELSE mn - 0.5 END AS mn, CASE WHEN mx > mn THEN mx ELSE mx + 0.5 END AS mx "
              "FROM raw")


@query("histogram_linear", _hist_sql("ARR_DELAY", 20, False))
def histogram_linear(spark, sf):
    src = S.flights(spark, sf).filter(F.col("ARR_DELAY") > 0)
    return rounded(profile.histogram(src, "ARR_DELAY", 20), R)


@query("histogram_log", _hist_sql("ARR_DELAY", 50, True))
def histogram_log(spark, sf):
    src = S.flights(spark, sf).filter(F.col("ARR_DELAY") > 0)
    return rounded(profile.histogram(src, "ARR_DELAY", 50, log_scale=True), R)


@query("histogram_log_dep", _hist_sql("DEP_DELAY", 50, True, "DEP_DELAY"))
def histogram_log_dep(spark, sf):
    src = S.flights(spark, sf).filter(F.col("DEP_DELAY") > 0)
    return rounded(profile.histogram(src, "DEP_DELAY", 50, log_scale=True), R)


# ------------------------------------------------------------------ D18, J4
_WX_NUM = ["HourlyPrecipitationDouble", "HourlyVisibilityDouble", "HourlyWindSpeedDouble"]


def _weather_numeric(spark, sf):
    w = S.weather(spark, sf)
    w = w.withColumns({
        "HourlyPrecipitationDouble": parse_number_text("HourlyPrecipitation"),
        "HourlyVisibilityDouble": parse_number_text("HourlyVisibility"),
        "HourlyWindSpeedDouble": parse_number_text("HourlyWindSpeed"),
    })
    return w.filter(F.col("HourlyWindSpeedDouble") < 2000)


_WX_NUM_SQL = (
    "SELECT *, TRY_CAST(trim(HourlyPrecipitation) AS DOUBLE) AS HourlyPrecipitationDouble, "
    "TRY_CAST(trim(HourlyVisibility) AS DOUBLE) AS HourlyVisibilityDouble, "
    "TRY_CAST(trim(HourlyWindSpeed) AS DOUBLE) AS HourlyWindSpeedDouble FROM weather")


def _box_sql():
    parts = []
    for c in _WX_NUM:
        parts.append(f"""SELECT '{c}' AS column, q.n, round(q.q1, {R}) AS q1, round(q.median, {R}) AS median,
  round(q.q3, {R}) AS q3, q.min, q.max, round(q.q3 - q.q1, {R}) AS iqr,
  round(q.q1 - 1.5 * (q.q3 - q.q1), {R}) AS lower_fence, round(q.q3 + 1.5 * (q.q3 - q.q1), {R}) AS upper_fence,
  (SELECT min({c}) FROM wn WHERE {c} >= q.q1 - 1.5 * (q.q3 - q.q1)) AS lower_whisker,
  (SELECT max({c}) FROM wn WHERE {c} <= q.q3 + 1.5 * (q.q3 - q.q1)) AS upper_whisker,
  (SELECT count(*) FROM wn WHERE {c} < q.q1 - 1.5 * (q.q3 - q.q1) OR {c} > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers
FROM (SELECT count({c}) AS n, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
      quantile_cont({c}, 0.75) AS q3, min({c}) AS min, max({c}) AS max FROM wn WHERE NOT isnan({c})) q""")
    return with_ctes(" UNION ALL ".join(parts), weather=WX,
                     wn=f"SELECT * FROM ({_WX_NUM_SQL}) x WHERE HourlyWindSpeedDouble < 2000")


@query("boxplot_stats", _box_sql())
def boxplot_stats(spark, sf):
    return rounded(profile.boxplot_stats(_weather_numeric(spark, sf), _WX_NUM), R)


def _outlier_sql():
    parts = []
    for c in _WX_NUM:
        parts.append(f"""SELECT '{c}' AS column,
  (SELECT count(*) FROM wn WHERE {c} < q.q1 - 1.5 * (q.q3 - q.q1) OR {c} > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers,
  (SELECT count(*) FROM wn WHERE {c} >= q.q1 - 1.5 * (q.q3 - q.q1) AND {c} <= q.q3 + 1.5 * (q.q3 - q.q1)) AS n_kept
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM wn) q""")
    return with_ctes(" UNION ALL ".join(parts), weather=WX,
                     wn=f"SELECT * FROM ({_WX_NUM_SQL}) x WHERE HourlyWindSpeedDouble < 2000")


@query("outlier_counts", _outlier_sql())
def outlier_counts(spark, sf):
    """Rows outside / inside the box-plot fences per column."""
    w = _weather_numeric(spark, sf)
    box = profile.boxplot_stats(w, _WX_NUM)
    return box.select("column", "n_outliers", (F.col("n") - F.col("n_outliers")).alias("n_kept"))


# ------------------------------------------------------------------ D19, J5
def _corr_sql(cols):
    filt = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in cols)
    parts = []
    for a in cols:
        for b in cols:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS corr FROM c")
    return with_ctes(" UNION ALL ".join(parts), flights=FL, c=f"SELECT * FROM flights WHERE {filt}")


@query("correlation_pair", _corr_sql(["ARR_DELAY", "DEP_DELAY"]))
def correlation_pair(spark, sf):
    return rounded(profile.correlation_long(S.flights(spark, sf), ["ARR_DELAY", "DEP_DELAY"]), 9)


@query("correlation_matrix", _corr_sql(["ARR_DELAY"] + REASONS))
def correlation_matrix(spark, sf):
    return rounded(profile.correlation_long(S.flights(spark, sf), ["ARR_DELAY"] + REASONS), 9)


@query("correlation_matrix_dep", _corr_sql(["DEP_DELAY"] + REASONS))
def correlation_matrix_dep(spark, sf):
    return rounded(profile.correlation_long(S.flights(spark, sf), ["DEP_DELAY"] + REASONS), 9)


def _corr_pairs_sql(cols, t):
    filt = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in cols)
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS corr FROM c")
    return with_ctes(f"SELECT * FROM ({' UNION ALL '.join(parts)}) p WHERE abs(corr) >= {t}", flights=FL,
                     c=f"SELECT * FROM flights WHERE {filt}")


@query("correlated_pairs", _corr_pairs_sql(["ARR_DELAY"] + REASONS, 0.3))
def correlated_pairs(spark, sf):
    return rounded(profile.correlated_pairs(S.flights(spark, sf), ["ARR_DELAY"] + REASONS, 0.3), 9)


_DROP_COLS = ["ARR_DELAY", "DEP_DELAY", *REASONS, "DISTANCE"]
_DROP_AT = 0.5


def _thin_ctes():
    """The greedy elimination as a recursive CTE: its state is the list of the columns left, by position."""
    filt = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in _DROP_COLS)
    pairs = " UNION ALL ".join(f"SELECT {i} AS a, {j} AS b, corr({_DROP_COLS[i]}, {_DROP_COLS[j]}) AS r FROM c"
                               for i in range(len(_DROP_COLS)) for j in range(i + 1, len(_DROP_COLS)))
    left = "list_filter(e.links, lambda l: (l.a = {x} OR l.b = {x}) AND list_contains(s.alive, l.a) AND list_contains(s.alive, l.b))"
    return {
        "flights": FL, "c": f"SELECT * FROM flights WHERE {filt}",
        "e": f"SELECT coalesce(list({{'a': a, 'b': b, 'r': r}}), []) AS links FROM ({pairs}) p WHERE abs(r) >= {_DROP_AT}",
        "s": f"""SELECT -1 AS step, range({len(_DROP_COLS)}) AS alive, CAST(NULL AS BIGINT) AS gone,
  CAST(NULL AS BIGINT) AS n_links, CAST(NULL AS BIGINT) AS partner, CAST(NULL AS DOUBLE) AS corr
UNION ALL
SELECT step + 1, list_filter(alive, lambda x: x <> worst.i), worst.i, worst.n,
  near[1].c, near[1].r FROM (SELECT step, alive, worst, list_sort(list_transform(
      list_filter(links, lambda l: (l.a = worst.i OR l.b = worst.i) AND list_contains(alive, l.a) AND list_contains(alive, l.b)),
      lambda l: {{'k': -round(abs(l.r), 9), 'c': l.a + l.b - worst.i, 'r': l.r}})) AS near
    FROM (SELECT s.step, s.alive, e.links, list_sort(list_transform(s.alive, lambda x: {{'n': len({left.format(x='x')}), 'i': x}}))[-1] AS worst
          FROM s, e) w WHERE worst.n > 0) n"""}


def _thin_sql(body):
    return with_ctes(body, **_thin_ctes()).replace("WITH", "WITH RECURSIVE", 1)


_NAMES_SQL = "(VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(_DROP_COLS)) + ")"


@query("drop_correlated", _thin_sql(
    f"SELECT v.name AS column, s.gone IS NULL AS kept, CAST(s.step AS INTEGER) AS step, CAST(coalesce(s.n_links, 0) AS INTEGER) AS n_links, "
    f"p.name AS partner, round(s.corr, 9) AS corr FROM {_NAMES_SQL} AS v(i, name) LEFT JOIN (SELECT * FROM s WHERE step >= 0) s "
    f"ON s.gone = v.i LEFT JOIN {_NAMES_SQL} AS p(i, name) ON s.partner = p.i"))
def drop_correlated(spark, sf):
    """Which delay columns stay, and why the others go."""
    _, decisions = correlated.drop_correlated(S.flights(spark, sf), _DROP_COLS, _DROP_AT)
    rows = [(d.column, d.kept, d.step, d.n_links, d.partner, d.corr) for d in decisions]
    return rounded(spark.createDataFrame(rows, "column string, kept boolean, step int, n_links int, partner string, corr double"), 9)


@query("uncorrelated_values", _thin_sql(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, u.column, u.value + 0.0 AS value FROM (" + " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '{c}' AS column, {i} AS i, {c} AS value FROM flights"
        for i, c in enumerate(_DROP_COLS)) + ") u WHERE u.i NOT IN (SELECT gone FROM s WHERE step >= 0)"))
def uncorrelated_values(spark, sf):
    """The reduced table, in long form (its columns depend on the data)."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    flights = stored(S.flights(spark, sf).select(*keys, *_DROP_COLS), "flights")  # read for the matrix and for the result
    kept, _ = correlated.drop_correlated(flights, _DROP_COLS, _DROP_AT)
    long = kept.unpivot(keys, [c for c in kept.columns if c not in keys], "column", "value")
    return long.withColumn("value", F.col("value") + 0.0)  # no negative zeros


# ------------------------------------------------------------------ D18 by group, with sketches
_PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]
_GROUP_COLS = ["ARR_DELAY", "DEP_DELAY"]
RANK_ERROR = 0.01


@query("quantile_sketch_ranks", with_ctes(" UNION ALL ".join(
    f"SELECT OP_UNIQUE_CARRIER, '{c}' AS column, count(*) AS n, CAST({p} AS DOUBLE) AS prob, TRUE AS within FROM flights "
    f"WHERE {c} IS NOT NULL AND NOT isnan({c}) GROUP BY 1" for c in _GROUP_COLS for p in _PROBS), flights=FL))
def quantile_sketch_ranks(spark, sf):
    """Delay quantiles per carrier from sketches of each departure hour, merged; their true ranks against the stated bound.

    The quantiles themselves vary from run to run within that bound (the sketch compacts at random).
    """
    f = S.flights(spark, sf).select("OP_UNIQUE_CARRIER", F.floor(F.col("CRS_DEP_TIME") / 100).alias("hour"), *_GROUP_COLS)
    fine = profile.quantile_sketches(f, ["OP_UNIQUE_CARRIER", "hour"], _GROUP_COLS)
    merged = profile.merge_sketches(fine, ["OP_UNIQUE_CARRIER"])
    # written first (a row per carrier and column): the planner then knows its bytes and leaves the flights where they are
    quantiles = stored(profile.sketch_quantiles(merged.drop("n"), _PROBS), "quantiles")
    errors = profile.rank_errors(f, ["OP_UNIQUE_CARRIER"], _GROUP_COLS, quantiles, _PROBS)
    return errors.select("OP_UNIQUE_CARRIER", "column", "n", "prob", (F.col("rank_error") <= RANK_ERROR).alias("within"))


# ------------------------------------------------------------------ weather: filters, calendar mean
@query("filter_before_date", with_ctes(
    "SELECT event_id, station, DATE FROM weather WHERE weather_ts < TIMESTAMP '2024-01-15 00:00:00'", weather=WX))
def filter_before_date(spark, sf):
    """Typed timestamp comparison, pushed to the parquet scan of events."""
    return S.weather(spark, sf).filter(F.col("weather_ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).select(
        "event_id", "station", "DATE")


@query("filter_from_date", with_ctes(
    "SELECT event_id, station, DATE FROM weather WHERE weather_ts >= TIMESTAMP '2024-01-10 00:00:00'", weather=WX))
def filter_from_date(spark, sf):
    """The lower bound of a date range, pushed to the scan too."""
    return S.weather(spark, sf).filter(F.col("weather_ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")).select(
        "event_id", "station", "DATE")


@query("temperature_by_month", with_ctes(
    f"SELECT CAST(month(CAST(DATE AS DATE)) AS INTEGER) AS month, round(avg(DailyAverageDryBulbTemperature), {R}) "
    "AS avg_temp FROM weather GROUP BY 1", weather=WX))
def temperature_by_month(spark, sf):
    """``to_date`` of the ISO text, mean per month."""
    w = S.weather(spark, sf).withColumn("day", F.to_date(F.substring("DATE", 1, 10)))
    return rounded(profile.mean_by_calendar(w, "day", "month", "DailyAverageDryBulbTemperature", "avg_temp"), R)


@query("category_distribution", with_ctes(
    f"SELECT OP_UNIQUE_CARRIER, count(*) AS n, round(count(*) / (SELECT count(*) FROM flights), {R}) AS share "
    "FROM flights GROUP BY 1", flights=FL))
def category_distribution(spark, sf):
    return rounded(profile.category_distribution(S.flights(spark, sf), "OP_UNIQUE_CARRIER"), R)


@query("filter_positive", with_ctes(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ARR_DELAY FROM flights WHERE ARR_DELAY > 0", flights=FL))
def filter_positive(spark, sf):
    """Comparison filter on a number."""
    return S.flights(spark, sf).filter(F.col("ARR_DELAY") > 0).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ARR_DELAY")


_FLIGHT_TYPES = [("FL_DATE", False), *((c, True) for c in ("ARR_DELAY", "DEP_DELAY", *REASONS)), ("CRS_DEP_TIME", False),
                 ("CRS_ARR_TIME", False), ("DISTANCE", True), ("ARR_DEL15", True), ("OP_UNIQUE_CARRIER", False)]


@query("missing_flights", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column, count_if({c} IS NULL{f' OR isnan({c})' if real else ''}) AS n_missing FROM flights"
    for c, real in _FLIGHT_TYPES), flights=FL))
def missing_flights(spark, sf):
    """D13 on every flight column, one pass."""
    return profile.missing_counts(S.flights(spark, sf), [c for c, _ in _FLIGHT_TYPES]).select("column", "n_missing")
