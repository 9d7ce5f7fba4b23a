"""Registered queries of the training-data operators: opN_<name> and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plover.sources.tables import scan

TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


@register("op6_simhash_components")
def op6(spark, sf_dir):
    from plover.llm.simhash import simhash_components

    return simhash_components(scan(spark, sf_dir, "documents"), size=3, budget=2)


@register("op1_quality")
def op1(spark, sf_dir):
    from plover.llm.quality import quality_report

    return quality_report(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "labels"))


def _license_sql() -> str:
    """The scan in DuckDB: the same patterns, over inline rows of the known texts."""
    from plover.llm.licenses import COPYRIGHT_LINE, KNOWN, SPELLINGS, TITLES, forms

    def quoted(x):
        return "'" + x.replace("'", "''") + "'"

    def canon(x):
        low = f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        out = f"trim(regexp_replace(regexp_replace({low}, {quoted('(?m)' + COPYRIGHT_LINE)}, '', 'g'), '[^a-z0-9]+', ' ', 'g'))"
        for pattern, put in SPELLINGS:
            put = put.replace("$1", "\\1")
            out = f"regexp_replace({out}, {quoted(chr(92) + 'b' + pattern + chr(92) + 'b')}, {quoted(put)}, 'g')"
        return out

    rows = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in forms(KNOWN, TITLES))
    return f"""
WITH known AS (SELECT sha256(w) AS digest, min(license) AS license
  FROM (SELECT license, {canon('text')} AS w FROM (VALUES {rows}) AS v(license, text)) WHERE w <> '' GROUP BY 1),
lines AS (SELECT doc_id, sha256(w) AS digest FROM (SELECT doc_id, {canon('line')} AS w
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)) WHERE w <> ''),
notices AS (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS notices
  FROM (SELECT DISTINCT doc_id, license FROM lines JOIN known USING (digest)) GROUP BY doc_id)
SELECT d.doc_id, d.digest, k.license, coalesce(n.notices, '') AS notices
FROM (SELECT doc_id, sha256({canon("coalesce(text, '')")}) AS digest FROM documents) d
LEFT JOIN known k USING (digest) LEFT JOIN notices n USING (doc_id)
"""


@register("op2_license_digests", _license_sql())
def op2(spark, sf_dir):
    from plover.llm.licenses import KNOWN, license_report

    return license_report(scan(spark, sf_dir, "documents"), KNOWN)


@register("op3_repeat_removal")
def op3(spark, sf_dir):
    from plover.llm.repeats import repeat_report

    return repeat_report(scan(spark, sf_dir, "documents"), length=400)


@register("op4_order_minhash")
def op4(spark, sf_dir):
    from plover.llm.order_minhash import edit_report

    return edit_report(scan(spark, sf_dir, "documents"))


@register("op5_lm_scores")
def op5(spark, sf_dir):
    from plover.llm.neural_lm import lm_scores

    return lm_scores(scan(spark, sf_dir, "documents"), folds=7, fold=2)


@register("op7_packing")
def op7(spark, sf_dir):
    import public_tokenizers

    from plover.llm.packing import pack
    from plover.llm.tokens import token_counts

    return pack(token_counts(scan(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)))


@register("op8_language")
def op8(spark, sf_dir):
    from plover.llm.langid import language_report

    return language_report(scan(spark, sf_dir, "documents"), folds=5)


@register("op9_token_counts")
def op9(spark, sf_dir):
    import public_tokenizers

    from plover.llm.tokens import token_counts

    return token_counts(scan(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=512)


BENCHMARK_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item_words WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT k FROM windows
), starts AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc_words, sizes WHERE len(w) >= k)
), found AS (
  SELECT s.doc_id, s.i, s.k, v.item_id FROM starts s JOIN windows v ON s.k = v.k AND s.g = v.g
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""


@register("op10_contamination", BENCHMARK_SQL)
def op10(spark, sf_dir):
    from plover.llm.decontaminate import contamination

    return contamination(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "benchmark"), size=10)


def _cluster_sql(k: int = 16, rounds: int = 3) -> str:
    """The clustering in DuckDB: lists instead of planes, one set of CTEs per round."""
    square = "list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    ctes = ["""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
  list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, e
  FROM (SELECT e, sha256('1:' || CAST(vec_id AS VARCHAR)) AS h FROM v ORDER BY h LIMIT {k}))"""]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT v.rid, min(CAST({square} AS HUGEINT) * {k} + c.c) AS m
  FROM v, c{r} c GROUP BY v.rid)""")
        if r < rounds:
            ctes.append(f"""u{r} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS e FROM (
  SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT a.m % {k} AS c, unnest(v.e) AS x, unnest(range(1, 65)) AS i
  FROM v JOIN a{r} a USING (rid)) GROUP BY c, i) GROUP BY c)""")
            ctes.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.c, CAST(coalesce(u.e, c.e) AS BIGINT[]) AS e
  FROM c{r} c LEFT JOIN u{r} u ON u.c = c.c)""")
    last = rounds
    return "WITH " + ",\n".join(ctes) + f"""
SELECT v.vec_id, CAST(a.m % {k} AS INTEGER) AS cluster, CAST(a.m // {k} AS BIGINT) AS distance,
       CAST(sum(a.m // {k}) OVER (PARTITION BY a.m % {k}) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.m // {k}) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM v JOIN a{last} a USING (rid) JOIN c{last} c ON c.c = a.m % {k}
"""


@register("op11_centroid_clusters", _cluster_sql())
def op11(spark, sf_dir):
    from plover.llm.bitplanes import centroid_clusters

    return centroid_clusters(scan(spark, sf_dir, "embeddings"))


@register("op12_nearest")
def op12(spark, sf_dir):
    from plover.llm.pstable import nearest

    return nearest(scan(spark, sf_dir, "embeddings"))


@register("op13_spelling_variants")
def op13(spark, sf_dir):
    from plover.llm.spelling import spelling_variants

    return spelling_variants(scan(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
