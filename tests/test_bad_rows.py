"""A3 quarantine, wide column states, and profiles with infinities."""

import math

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plover.operators import profile as P
from plover.sources import catalog, csv

LINES = ["id,name,price,_line", "1,one,1.5,x", "2,two,n/a,x", "3,three", "4,four,4.5,x,y", '5,"fi,ve",5.5,x', "six,six,6.5,x", ",,,", "7,,7.0,x"]


def test_broken_lines_go_to_quarantine(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(path)
    schema = StructType.fromDDL("id int, name string, price double, _line string")
    good, bad = csv.read_csv_checked(spark, path, schema)
    assert good.columns == ["id", "name", "price", "_line"]
    assert sorted((tuple(r) for r in good.collect()), key=str) == sorted(
        [(1, "one", 1.5, "x"), (5, "fi,ve", 5.5, "x"), (7, None, 7.0, "x"), (None, None, None, None)], key=str)
    assert sorted(r.line for r in bad.collect()) == sorted(LINES[i] for i in (2, 3, 4, 6))
    assert all(r.file.startswith("file:") and "lines" in r.file for r in bad.collect())
    assert good.count() + bad.count() == len(LINES) - 1


def test_schema_is_inferred_once_and_kept(spark, tmp_path):
    path, at = str(tmp_path / "data"), str(tmp_path / "schema")
    spark.createDataFrame([(1, 2.5), (2, 3.5)], "a int, b double").coalesce(1).write.option("header", True).csv(path)
    first = csv.kept_schema(spark, path, at)
    assert first.simpleString() == "struct<a:int,b:double>"
    spark.createDataFrame([("junk", "text")], "a string, b string").write.mode("append").option("header", True).csv(path)
    assert csv.kept_schema(spark, path, at) == first
    good, bad = csv.read_csv_checked(spark, path, first)
    assert good.count() == 2 and [r.line for r in bad.collect()] == ["junk,text"]


def test_two_hundred_columns_in_one_scan(spark):
    df = spark.range(500).select("id", *[
        (F.when(F.col("id") % (i % 7 + 2) != 0, F.lit(float("nan")) if i % 5 == 0 else F.col("id") % (i + 1))).alias(f"c{i}")
        for i in range(199)])
    conf = {"spark.sql.codegen.fallback": "false", "spark.sql.codegen.factoryMode": "CODEGEN_ONLY"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)  # code that does not compile now fails instead of being interpreted
        out = P.column_states(df)
        got = {r.column: r for r in out.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Range (0, 500") == 1
    assert len(got) == 200
    small = P.missing_counts(df, [f"c{i}" for i in range(0, 199, 9)]).collect()
    assert all((got[r.column].n_missing, got[r.column].n_rows, got[r.column].missing_pct) == (r.n_missing, 500, r.missing_pct) for r in small)
    for i in (1, 3, 50, 198):
        exact = df.select(f"c{i}").distinct().filter(f"c{i} IS NOT NULL").count()
        assert abs(got[f"c{i}"].n_distinct - exact) <= max(1, 0.1 * exact)
    empty = P.column_states(df.limit(0).select("id", "c1")).collect()
    assert [(r.column, r.n_rows, r.n_missing, r.missing_pct, r.n_distinct) for r in sorted(empty)] == [
        ("c1", 0, 0, None, 0), ("id", 0, 0, None, 0)]


def test_histogram_leaves_infinities_out(spark):
    inf = math.inf
    df = spark.createDataFrame([(x,) for x in (0.0, 1.0, 2.0, inf, -inf, math.nan, None)], "x double")
    got = sorted(tuple(r) for r in P.histogram(df, "x", 2).collect())
    assert got == [(0, 0.0, 1.0, 1), (1, 1.0, 2.0, 2)]
    assert sum(r.n for r in P.histogram(df, "x", 2, log_scale=True).collect()) == 2
    assert all(r.lo is None and r.n == 0 for r in P.histogram(df.filter("abs(x) = double('infinity')"), "x", 3).collect())


def test_catalog_is_left_as_it_was(spark):
    from conftest import SF_SMALL
    from plover.plans.catalog import queries

    def names():
        return {t.name for t in spark.catalog.listTables()}

    before = names()
    for q in ("external_table_scan", "view_select"):
        assert queries()[q](spark, SF_SMALL).count() > 0
    assert names() == before
    a, b = spark.range(3), spark.range(5)
    with catalog.views(spark, t=a) as x, catalog.views(spark, t=b) as y:
        assert (spark.table(x["t"]).count(), spark.table(y["t"]).count()) == (3, 5)


def test_view_select_has_every_row(spark):
    from conftest import SF_SMALL
    from plover.plans import standins as S
    from plover.plans.catalog import queries

    got, want = queries()["view_select"](spark, SF_SMALL), S.scores(spark, SF_SMALL)
    assert got.columns == want.columns and got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_shares_read_the_input_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0), (None, 9.0)], "k string, x double").mapInArrow(
        counted, "k string, x double")
    got = {r.k: (r.n, r.share) for r in P.category_distribution(df, "k").collect()}
    assert got == {"a": (2, 0.5), "b": (1, 0.25), None: (1, 0.25)}
    assert runs.value == 4
    box = P.boxplot_stats(df, ["x"]).collect()[0]  # whiskers from the counted values
    assert (box.n, box.median, box.lower_whisker, box.upper_whisker, box.n_outliers) == (4, 2.5, 1.0, 3.0, 1)
