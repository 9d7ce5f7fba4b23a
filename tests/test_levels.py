"""H1/H3 without collected levels: equal to StringIndexer, at any number of levels."""

import random

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conftest import SF_SMALL
from plover.operators import levels as L


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    out = [(i, rng.choice(["hot"] * 20 + [f"v{rng.randrange(60)}", "ü", "", " ", None]), rng.choice(["x", "y", "y"])) for i in range(3000)]
    return spark.createDataFrame(out, "id long, a string, b string")


def test_equals_string_indexer(spark, rows, monkeypatch):
    monkeypatch.setattr(L, "HOT", 5)
    table = L.level_table(rows, ["a", "b"])
    indexed = L.index_levels(rows, ["a", "b"], table)
    assert indexed.columns == ["id", "a", "b", "a_idx", "b_idx"] and indexed.count() == 3000
    for c in ("a", "b"):
        model = StringIndexer(inputCol=c, outputCol="i").fit(rows.filter(F.col(c).isNotNull()))
        got = table.filter(F.col("column") == c).orderBy("idx").collect()
        assert [r.level for r in got] == list(model.labels) and [r.idx for r in got] == list(range(len(got)))
        want = {v: i for i, v in enumerate(model.labels)}
        assert all(r[f"{c}_idx"] == want.get(r[c]) for r in indexed.collect())
    sparse = L.one_hot_sparse(rows, ["id"], ["a", "b"], table.filter("level <> 'hot'"))
    assert {(r.id, r.column) for r in sparse.collect()} == {
        (r.id, c) for r in rows.collect() for c in ("a", "b") if r[c] is not None and r[c] != "hot"}


def test_equals_string_index_on_the_tables(spark):
    from plover.plans.catalog import queries

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").filter("l_linenumber <= 4").withColumn("part", F.col("l_partkey").cast("string"))
    labels = StringIndexer(inputCol="part", outputCol="i").fit(li).labels
    got = queries()["level_ranks"](spark, SF_SMALL).filter("column = 'l_partkey'").orderBy("idx").collect()
    assert [r.level for r in got] == list(labels)


def test_many_levels_collect_nothing(spark, monkeypatch):
    n = 200_000
    df = spark.range(2 * n).select("id", F.when(F.col("id") < n // 2, "hot").otherwise((F.col("id") % n).cast("string")).alias("c"))
    with monkeypatch.context() as m:
        for name in ("collect", "toPandas", "toArrow", "take", "first", "head", "toLocalIterator"):
            m.setattr(DataFrame, name, lambda *a, **k: pytest.fail("rows sent to the driver"))
        table = L.level_table(df, ["c"])
        indexed = L.index_levels(df, ["c"], table)
    assert table.count() == n + 1
    assert table.agg(F.min("idx"), F.max("idx"), F.countDistinct("idx")).first()[:] == (0, n, n + 1)
    out = indexed.agg(F.count_if(F.col("c_idx").isNull()), F.count_if((F.col("c") == "hot") != (F.col("c_idx") == 0))).first()
    assert out[:] == (0, 0)
    order = table.join(table.select((F.col("idx") - 1).alias("idx"), F.col("n").alias("n2"), F.col("level").alias("l2")), "idx")
    assert order.filter("n < n2 OR (n = n2 AND level > l2)").count() == 0


def test_empty(spark, rows):
    table = L.level_table(rows.limit(0), ["a"])
    assert table.count() == 0
    assert L.index_levels(rows, ["a"], table).filter("a_idx IS NOT NULL").count() == 0
