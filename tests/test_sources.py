"""CSV, catalog, schema and layout helpers on tiny tables."""

import pytest
from pyspark.sql import functions as F

from plover.session import fresh_path
from plover.sources import catalog, csv, schema


def test_csv_roundtrip_and_external_table(spark):
    path = fresh_path(spark, "csv")
    df = spark.createDataFrame([(1, 2.5, "x"), (2, None, "y")], "a long, b double, c string")
    csv.write_csv(df, path)
    back = csv.read_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == [(1, 2.5, "x"), (2, None, "y")]
    tbl = catalog.register_external(spark, "plover_test_ext", path, fmt="csv", options={"header": "true"})
    assert tbl.count() == 2
    catalog.drop_table(spark, "plover_test_ext")


def test_schema_diff(spark):
    a = spark.createDataFrame([(1, "x")], "k long, s string")
    b = spark.createDataFrame([(1, 2.0)], "k int, y double")
    got = {r.column: r.status for r in schema.schema_diff(a, b).collect()}
    assert got == {"k": "changed", "s": "removed", "y": "added"}


def test_colocated_join_has_no_shuffle(spark):
    from conftest import SF_SMALL
    from plover.plans import standins as S
    from plover.sources.tables import colocate, scan

    li = colocate(scan(spark, SF_SMALL, "lineitem"), "plover_li_b", ["l_orderkey"], 8)
    od = colocate(scan(spark, SF_SMALL, "orders"), "plover_od_b", ["o_orderkey"], 8)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = S.flights(spark, SF_SMALL, lineitem=li, orders=od)
        plan = f._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert f.count() == S.flights(spark, SF_SMALL).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
