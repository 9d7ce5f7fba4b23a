"""Loan-flow queries (the LW notebook: sources, cleaning, snapshots, catalog; SURVEY A, B, C, J11)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plover.functions import parse_tenure
from plover.operators import clean as C
from plover.operators import profile
from plover.plans import flows
from plover.plans import standins as S
from plover.plans.registry import query, rounded, with_ctes
from plover.session import fresh_path
from plover.sources import catalog, csv, schema
from plover.sources.tables import scan, scan_glob

RAW = S.loans_raw_sql()
CLEAN = flows.loans_clean_sql()
MUNGED = flows.loans_munged_sql()
KEYS = flows.KEYS
SPEC = flows.FeatureSpec()
KEY_SQL = ", ".join(KEYS)
R = 6


# ------------------------------------------------------------------ A1, A2, A3, A16
@query("scan_parquet", "SELECT * FROM lineitem")
def scan_parquet(spark, sf):
    return scan(spark, sf, "lineitem")


@query("scan_parquet_glob", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, "
                            "CAST(year(o_orderdate) AS INTEGER) AS year FROM orders "
                            "WHERE year(o_orderdate) BETWEEN 1995 AND 1999")
def scan_parquet_glob(spark, sf):
    """A2: one folder of files per order year, of which a glob takes the folders of five."""
    path = fresh_path(spark, "orders-by-year")
    o = scan(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    o.repartition("year", "o_orderkey").write.partitionBy("year").parquet(path)
    back = scan_glob(spark, f"{path}/year=199[5-9]", base=path)
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "year")


@query("scan_parquet_folder", "SELECT * FROM lineitem")
def scan_parquet_folder(spark, sf):
    """A1: a folder of many part files, read as one table."""
    path = fresh_path(spark, "lineitem-parts")
    scan(spark, sf, "lineitem").repartition(16, "l_orderkey").write.parquet(path)
    return spark.read.parquet(path)


@query("csv_roundtrip", "SELECT * FROM events")
def csv_roundtrip(spark, sf):
    """A3: all columns of events as gzip CSV with a header, read back with an inferred schema."""
    path = fresh_path(spark, "csv-events")
    source = scan(spark, sf, "events")
    csv.write_csv(source, path)
    back = csv.read_csv(spark, path, infer=True)
    return back.select(*[F.col(f.name).cast(f.dataType) for f in source.schema.fields])


#: Lines of a hand-kept file: some with junk for a number, some cut short, some with a field too many.
_LINE = ("CAST(event_id AS STRING) || ',' || event_type || CASE WHEN event_id % 43 = 0 THEN '' ELSE ',' || "
         "CASE WHEN event_id % 41 = 0 THEN 'n/a' ELSE CAST(user_id AS STRING) END END || "
         "CASE WHEN event_id % 47 = 0 THEN ',surplus,surplus' ELSE '' END")
_BROKEN = "event_id % 41 = 0 OR event_id % 43 = 0 OR event_id % 47 = 0"
_FIELDS = "event_id bigint, event_type string, user_id bigint"


@query("csv_quarantine",
       f"SELECT event_id, event_type, user_id, NULL AS line FROM events WHERE NOT ({_BROKEN}) "
       f"UNION ALL SELECT NULL, NULL, NULL, {_LINE} FROM events WHERE {_BROKEN}")
def csv_quarantine(spark, sf):
    """A3 with bad rows: the lines that fit, and the others whole."""
    path = fresh_path(spark, "csv-lines")
    lines = scan(spark, sf, "events", ["event_id", "event_type", "user_id"])
    lines.select(F.expr(_LINE).alias("value")).write.text(path)
    good, bad = csv.read_csv_checked(spark, path, StructType.fromDDL(_FIELDS), header=False)
    return good.unionByName(bad.select("line"), allowMissingColumns=True)


@query("peek_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 4")
def peek_rows(spark, sf):
    """``take(n)`` with an explicit order (TakeOrderedAndProject)."""
    return scan(spark, sf, "orders").orderBy("o_orderkey").limit(4)


_SHAPE_TABLES = {"lineitem": 11, "orders": 6, "customer": 5, "events": 6}


@query("table_shape", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS n_rows, CAST({n} AS BIGINT) AS n_columns FROM {t}"
    for t, n in _SHAPE_TABLES.items()))
def table_shape(spark, sf):
    """Rows and columns per table (counts come from parquet footers)."""
    out = None
    for t in _SHAPE_TABLES:
        s = schema.table_shape(scan(spark, sf, t), t)
        out = s if out is None else out.unionByName(s)
    return out


# ------------------------------------------------------------------ B1, B2, B6
@query("project_columns", with_ctes(f"SELECT {', '.join(flows.LOAN_COLUMNS)} FROM loans", loans=RAW))
def project_columns(spark, sf):
    return C.project(S.loans_raw(spark, sf), flows.LOAN_COLUMNS)


@query("project_clean_columns", with_ctes(
    f"SELECT {KEY_SQL}, {', '.join(SPEC.categoricals + SPEC.numerics)} FROM m", m=MUNGED))
def project_clean_columns(spark, sf):
    """B1: the model's columns of the cleaned loans."""
    return C.project(flows.loans_munged(spark, sf), [*KEYS, *SPEC.categoricals, *SPEC.numerics])


@query("filter_in_list", with_ctes(
    f"SELECT {KEY_SQL}, loan_status FROM loans WHERE loan_status IN ('Default', 'Charged Off', 'Fully Paid')",
    loans=RAW))
def filter_in_list(spark, sf):
    return C.filter_in(S.loans_raw(spark, sf), "loan_status", flows.LOAN_STATUSES).select(*KEYS, "loan_status")


@query("label_from_status", with_ctes(
    "SELECT loan_status, bad_loan, count(*) AS n FROM clean GROUP BY 1, 2", clean=CLEAN))
def label_from_status(spark, sf):
    return flows.loans_clean(spark, sf).groupBy("loan_status", "bad_loan").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ C1-C6
@query("parse_percent", with_ctes(f"SELECT {KEY_SQL}, int_rate, revol_util FROM clean", clean=CLEAN))
def parse_percent(spark, sf):
    return flows.loans_clean(spark, sf).select(*KEYS, "int_rate", "revol_util")


@query("parse_month_year", with_ctes(f"SELECT {KEY_SQL}, issue_year, earliest_year FROM clean", clean=CLEAN))
def parse_month_year(spark, sf):
    return flows.loans_clean(spark, sf).select(*KEYS, "issue_year", "earliest_year")


@query("credit_length", with_ctes(f"SELECT {KEY_SQL}, credit_length_in_years FROM clean", clean=CLEAN))
def credit_length(spark, sf):
    return flows.loans_clean(spark, sf).select(*KEYS, "credit_length_in_years")


@query("parse_tenure", with_ctes(
    f"SELECT emp_length AS emp_length_text, {flows._TENURE_SQL} AS emp_length, count(*) AS n FROM loans GROUP BY 1, 2",
    loans=RAW))
def parse_tenure_q(spark, sf):
    raw = S.loans_raw(spark, sf)
    return raw.groupBy(F.col("emp_length").alias("emp_length_text"), parse_tenure("emp_length").alias("emp_length")).agg(
        F.count(F.lit(1)).alias("n"))


@query("merge_levels", with_ctes("SELECT verification_status, count(*) AS n FROM m GROUP BY 1", m=MUNGED))
def merge_levels_q(spark, sf):
    return flows.loans_munged(spark, sf).groupBy("verification_status").agg(F.count(F.lit(1)).alias("n"))


@query("net_amount", with_ctes(f"SELECT {KEY_SQL}, net FROM m", m=MUNGED))
def net_amount_q(spark, sf):
    return flows.loans_munged(spark, sf).select(*KEYS, "net")


# ------------------------------------------------------------------ D3, J11
@query("count_by_state", with_ctes("SELECT addr_state, count(annual_inc) AS n FROM m GROUP BY 1", m=MUNGED))
def count_by_state(spark, sf):
    return profile.group_count(flows.loans_munged(spark, sf), ["addr_state"], col="annual_inc", name="n")


@query("net_by_label_grade", with_ctes(
    f"SELECT bad_loan, grade, round(sum(net), 2) AS sum_net FROM m GROUP BY 1, 2", m=MUNGED))
def net_by_label_grade(spark, sf):
    g = flows.loans_munged(spark, sf).groupBy("bad_loan", "grade").agg(F.sum("net").alias("sum_net"))
    return rounded(g, 2)


# ------------------------------------------------------------------ B11, J6, B12
def _split_sql(weights):
    b = C.split_bounds(weights)
    h = C.key_hash_sql(KEYS)
    case = "CASE " + " ".join(f"WHEN {h} < {x} THEN {i}" for i, x in enumerate(b)) + f" ELSE {len(b)} END"
    return with_ctes(f"SELECT CAST({case} AS INTEGER) AS split, count(*) AS n FROM loans GROUP BY 1", loans=RAW)


@query("hash_split", _split_sql([0.025, 0.975]))
def hash_split(spark, sf):
    """The 2.5% sample side by key hash (partitioning-independent), counts per side."""
    s = C.hash_split(S.loans_raw(spark, sf), KEYS, [0.025, 0.975])
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("hash_split_3", _split_sql([0.7, 0.15, 0.15]))
def hash_split_3(spark, sf):
    """Train / validation / test by key hash."""
    s = C.hash_split(S.loans_raw(spark, sf), KEYS, [0.7, 0.15, 0.15])
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def _sample_sql(size, strata):
    part = f"PARTITION BY {', '.join(strata)} " if strata else ""
    order = f"ORDER BY md5({C.key_text_sql(KEYS)}), {KEY_SQL}"
    return with_ctes(f"SELECT {KEY_SQL}, grade, addr_state FROM (SELECT *, row_number() OVER ({part}{order}) AS place "
                     f"FROM loans) x WHERE place <= {size}", loans=RAW)


@query("sample_of_size", _sample_sql(1000, []))
def sample_of_size(spark, sf):
    """A sample of a stated size."""
    return C.sample_rows(S.loans_raw(spark, sf), KEYS, 1000).select(*KEYS, "grade", "addr_state")


@query("sample_by_stratum", _sample_sql(40, ["grade", "addr_state"]))
def sample_by_stratum(spark, sf):
    """A sample of a stated size from each grade and state."""
    return C.sample_rows(S.loans_raw(spark, sf), KEYS, 40, ["grade", "addr_state"]).select(*KEYS, "grade", "addr_state")


TRAIN_CUTOFF = 1998.0


@query("temporal_split", with_ctes(
    f"SELECT CASE WHEN issue_year <= {TRAIN_CUTOFF} THEN 'train' WHEN issue_year > {TRAIN_CUTOFF} THEN 'valid' "
    "ELSE 'neither' END AS side, count(*) AS n FROM clean GROUP BY 1", clean=CLEAN))
def temporal_split(spark, sf):
    """Train <= cutoff year < valid; a null year is in neither side (one pass)."""
    c = flows.loans_clean(spark, sf)
    return c.groupBy(C.temporal_side("issue_year", TRAIN_CUTOFF).alias("side")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ A4-A8, A12: overwrite, evolution, catalog
@query("snapshot_latest", with_ctes("SELECT * FROM clean", clean=CLEAN))
def snapshot_latest(spark, sf):
    """A4/A5: write a table (overwrite), read it back."""
    path = fresh_path(spark, "loan-stats")
    flows.loans_clean(spark, sf).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _two_states(spark, sf):
    """The table before and after it gained a column, as two partitions of one folder."""
    path = fresh_path(spark, "loan-stats")
    flows.loans_clean(spark, sf).write.parquet(f"{path}/state=0")
    flows.munge_loans(spark.read.parquet(f"{path}/state=0")).write.parquet(f"{path}/state=1")
    return path


@query("snapshot_evolved", with_ctes(
    "SELECT 0 AS state, count(*) AS n_rows, 0 AS n_net FROM clean "
    "UNION ALL SELECT 1, count(*), count(net) FROM m", clean=CLEAN, m=MUNGED))
def snapshot_evolved(spark, sf):
    """Both states read with a merged schema (rows before the column: null)."""
    both = spark.read.option("mergeSchema", "true").parquet(_two_states(spark, sf))
    return both.groupBy(F.col("state").cast("int").alias("state")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("net").cast("int").alias("n_net"))


@query("external_table_scan", with_ctes("SELECT grade, count(*) AS n FROM m GROUP BY 1", m=MUNGED))
def external_table_scan(spark, sf):
    """``USE default; DROP TABLE IF EXISTS; CREATE TABLE .. USING parquet LOCATION`` the evolved state."""
    path = _two_states(spark, sf)
    name = "plover_" + path.rsplit("-", 1)[-1]
    tbl = catalog.register_external(spark, name, f"{path}/state=1")
    catalog.drop_table(spark, name)  # the frame keeps the resolved location; the catalog is left as it was
    return tbl.groupBy("grade").agg(F.count(F.lit(1)).alias("n"))


def _filled_sql(src):
    return f"SELECT name AS column, value AS n FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM {src}) ON *)"


@query("schema_diff", with_ctes(
    "SELECT coalesce(a.column, b.column) AS column, a.n AS n_before, b.n AS n_after, CASE WHEN a.column IS NULL THEN 'added' "
    "WHEN b.column IS NULL THEN 'removed' ELSE 'same' END AS status FROM a FULL OUTER JOIN b ON a.column = b.column",
    clean=CLEAN, m=MUNGED, a=_filled_sql("clean"), b=_filled_sql("m")))
def schema_diff(spark, sf):
    """Columns before and after the evolution, with the values that they hold."""
    return schema.filled_diff(flows.loans_clean(spark, sf), flows.loans_munged(spark, sf))


@query("column_prefix_families", with_ctes(
    "SELECT family, count(DISTINCT c) AS n_columns, CAST(sum(n) AS BIGINT) AS n_filled FROM (SELECT filled.column AS c, n, "
    "substring(filled.column, 1, CAST(k AS INTEGER)) AS family, k FROM filled, range(1, length(filled.column) + 1) r(k)) p "
    "WHERE family IN (SELECT substring(filled.column, 1, CAST(k AS INTEGER)) FROM filled, "
    "range(1, length(filled.column)) r(k)) GROUP BY family",
    otpw=S.otpw_sql(), filled=_filled_sql("otpw")))
def column_prefix_families(spark, sf):
    """Families of input columns by common name prefix, with the values that they hold."""
    return schema.filled_families(S.otpw(spark, sf))


# ------------------------------------------------------------------ A9
@query("view_select", with_ctes("SELECT * FROM scores", scores=S.scores_sql()))
def view_select(spark, sf):
    """A temp view, its table registered under a second name, and all rows selected from that by SQL."""
    with catalog.views(spark, gbt_valid=S.scores(spark, sf)) as first:
        with catalog.views(spark, gbt_valid_table=spark.table(first["gbt_valid"])) as second:
            return spark.sql(f"SELECT * FROM {second['gbt_valid_table']}")
