import textwrap

import pytest
from llm_data import EDGES, make_docs

from plover.llm import licenses as L


def test_variants_of_a_text_share_its_digest(spark, no_docs):
    mit = L.KNOWN["MIT"]
    rows = [
        (11, mit, "en"), (12, "Copyright (c) 2020 Some Body\nAll rights reserved.\n\n" + mit.upper().replace(",", ""), "en"),
        (13, mit.replace("sublicense", "sub-licence") + "\n", "en"), (14, mit + " And more.", "en"),
        (15, "Prose.\n  Licensed under the APACHE licence, version 2.0\nMore.\nReleased under the MIT Licence", "en"),
        *EDGES,
    ]
    got = {(r.doc_id, r.digest): r for r in L.license_report(make_docs(spark, rows), L.KNOWN).collect()}
    by = {i: r for (i, _), r in got.items()}
    assert [by[i].license for i in (11, 12, 13, 14, 15)] == ["MIT", "MIT", "MIT", None, None]
    assert by[11].digest == by[12].digest == by[13].digest != by[14].digest
    assert by[15].notices == "Apache-2.0-notice,MIT-notice" and by[7].notices == ""
    assert L.license_report(make_docs(spark, rows), L.KNOWN).count() == len(rows)
    assert L.license_report(no_docs, L.KNOWN).count() == 0
    assert L.license_report(make_docs(spark, rows), {}).filter("license IS NOT NULL OR notices <> ''").count() == 0


def wrapped(text, width=76):
    return "\n\n".join(textwrap.fill(x, width) for x in text.split("\n\n"))


def test_complete_license_files(spark):
    """Title, blank line, copyright lines and wrapped body, as the files stand in repositories; in Spark and SQL."""
    import duckdb

    import __spark_entry__ as entry

    mark = "Copyright (c) 2024, Some Body\nAll rights reserved."
    files = [(k, f"{title}\n\n{mark}\n\n{wrapped(L.KNOWN[k])}\n") for k, titles in L.TITLES.items() for title in titles]
    files += [(k, f"{mark}\n\n{wrapped(text)}") for k, text in L.KNOWN.items()]
    files += [(None, f"MIT License\n\n{mark}\n\n{wrapped(L.KNOWN['ISC'])}"), (None, "MIT License"), (None, "BSD 3-Clause License\n" + mark)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(files)], "doc_id long, text string")
    report = L.license_report(docs, L.KNOWN)
    got = {r.doc_id: r.license for r in report.collect()}
    assert [got[i] for i in range(len(files))] == [k for k, _ in files]
    documents = docs.toPandas()  # noqa: F841 (read by name)
    con = duckdb.connect()
    want = con.execute(f"SELECT {', '.join(report.columns)} FROM ({entry.oracle_sql()['op2_license_digests']})").fetchall()
    assert sorted(map(str, (tuple(r) for r in report.collect()))) == sorted(map(str, want))
    assert L.license_report(docs, L.KNOWN, titles={}).filter("license IS NOT NULL").count() == len(L.KNOWN)


def test_native(spark, edge_docs):
    plan = L.license_report(edge_docs, L.KNOWN)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("name", ["op2_license_digests", "op10_contamination"])
def test_query_matches_sql(spark, name):
    import duckdb
    from conftest import SF_SMALL

    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SF_SMALL)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, want))
