"""Projections, filters, missing-row drops and deterministic splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plover.functions.parse import is_missing

def project(df: DataFrame, cols: list[str]) -> DataFrame:
    """B1."""
    return df.select(*cols)


def filter_in(df: DataFrame, col: str, values: list) -> DataFrame:
    """B2: membership filter (null never matches)."""
    return df.filter(F.col(col).isin(values))


def missing_any(df: DataFrame, cols: list[str] | None = None) -> Column:
    """True when any of ``cols`` is null (or NaN for floating columns)."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cols = cols or df.columns
    out = F.lit(False)
    for c in cols:
        out = out | is_missing(c, types[c])
    return out


def drop_missing(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """``na.drop`` (any null, or NaN in floating columns)."""
    return df.na.drop(how="any", subset=subset)


def dropped_share(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Both counts in one aggregate; share of rows a drop removes, in percent."""
    miss = missing_any(df, subset)
    agg = df.agg(F.count(F.lit(1)).alias("n_before"), F.count_if(~miss).alias("n_after"))
    return agg.select(
        "n_before",
        "n_after",
        F.when(F.col("n_before") > 0,
               F.round((F.col("n_before") - F.col("n_after")) * 100.0 / F.col("n_before"), 6)).alias("dropped_pct"),
    )


def key_text(cols: list[str | Column]) -> Column:
    """A key as one text; null parts count as an empty text."""
    return F.concat_ws("|", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols])


def key_hash(cols: list[str | Column], modulus: int = 1000) -> Column:
    """Hash of a key in [0, modulus): the first eight hex digits of the md5 of its text.

    Any SQL engine has md5, so the assignment can be repeated elsewhere; it does not
    depend on partitioning, and sides are independent of any arithmetic of the key.
    Null parts count as an empty text.
    """
    return F.conv(F.substring(F.md5(key_text(cols)), 1, 8), 16, 10).cast("bigint") % F.lit(modulus)


def key_text_sql(cols: list[str]) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)


def key_hash_sql(cols: list[str], modulus: int = 1000) -> str:
    return f"(CAST('0x' || substring(md5({key_text_sql(cols)}), 1, 8) AS BIGINT) % {modulus})"


def sample_rows(df: DataFrame, key_cols: list[str], size: int, strata: list[str] | None = None) -> DataFrame:
    """``size`` rows, or ``size`` rows of each stratum (all of a smaller one): those whose md5 of the key is smallest.

    The choice follows the keys alone, neither the partitioning nor the row order; ties
    (a repeated key) go by the key itself, then stay undecided between rows of one key.
    Every task keeps its own ``size`` smallest before the shuffle (per stratum, or for
    the table as a whole), so a stratum with most rows costs no more than the others.
    A null stratum is one like any other.
    """
    order = [F.md5(key_text(key_cols)).asc(), *[F.col(c).asc() for c in key_cols]]
    if not strata:
        return df.orderBy(*order).limit(size)
    place = F.row_number().over(Window.partitionBy(*strata).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= size).drop("_place")


def hash_split(df: DataFrame, key_cols: list[str], weights: list[float], name: str = "split",
               modulus: int = 1000) -> DataFrame:
    """Label each row with the index of its side by cumulative weights."""
    total = float(sum(weights))
    h = key_hash(key_cols, modulus)
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(int(round(acc * modulus)))
    side = F.lit(len(weights) - 1)
    for i in reversed(range(len(bounds))):
        side = F.when(h < bounds[i], F.lit(i)).otherwise(side)
    return df.withColumn(name, side)


def split_bounds(weights: list[float], modulus: int = 1000) -> list[int]:
    total = float(sum(weights))
    out, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        out.append(int(round(acc * modulus)))
    return out


def temporal_split(df: DataFrame, col: str, cutoff) -> tuple[DataFrame, DataFrame]:
    """Rows <= cutoff train, > cutoff valid; a null split value is in neither."""
    return df.filter(F.col(col) <= cutoff), df.filter(F.col(col) > cutoff)


def temporal_side(col: str, cutoff) -> Column:
    """B12 as one column ('train' / 'valid' / 'neither'), for single-pass reports."""
    c = F.col(col)
    return F.when(c <= cutoff, "train").when(c > cutoff, "valid").otherwise("neither")


def cast_many(df: DataFrame, cols: list[str], dtype: str) -> DataFrame:
    """Many casts in one projection; text goes through ``try_cast``."""
    types = dict(df.dtypes)
    return df.withColumns({
        c: (F.trim(F.col(c)).try_cast(dtype) if types[c] == "string" else F.col(c).cast(dtype)) for c in cols
    })
