"""Typed views of loosely typed columns. Bad values become null instead of errors, and NaN never reaches a double."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells that a table reader takes for missing.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def missing_tokens_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null in place of the tokens for missing cells, in string columns."""
    strings = [c for c, t in df.dtypes if t == "string" and (columns is None or c in columns)]
    return df.withColumns({c: F.when(~F.trim(c).isin(*NA_TOKENS), F.col(c)) for c in strings}) if strings else df


def to_double(c: Column) -> Column:
    """A double, or null where the value is no finite number."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x), x)


def to_text(c: Column) -> Column:
    """A string; null becomes `nan`, which then counts as a value."""
    return F.coalesce(c.cast("string"), F.lit("nan"))


def to_time(c: Column) -> Column:
    """A timestamp, or null where the value is none."""
    return c.try_cast("timestamp")


def is_missing(c: Column) -> Column:
    """Null, or blank after trimming."""
    return c.isNull() | (F.trim(c.cast("string")) == "")


def zip3(c: Column) -> Column:
    """A three-digit postal prefix as an integer: leading zeros go, blank is 0, what is no number is null, null is -1."""
    bare = F.ltrim(F.trim(c.cast("string")), F.lit("0"))
    return F.coalesce(F.when(c.isNull(), F.lit(-1)), F.when(bare == "", F.lit(0)).otherwise(F.floor(bare.try_cast("double")).cast("int")), F.lit(-1))


def round_half_even(c: Column, digits: int = 0) -> Column:
    return F.rint(c) if digits == 0 else F.bround(c, digits)


def clip(c: Column, low: float | Column, high: float | Column) -> Column:
    lo, hi = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return F.when(c.isNotNull(), F.greatest(F.least(c, hi), lo))


def right_closed_bin(c: Column, edges: list[float], labels: list[str], include_lowest: bool = False) -> Column:
    """The label of the interval (edge, next edge] that holds the value; null outside."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label fewer than edges")
    out = F.lit(None).cast("string")
    for k in range(len(labels) - 1, -1, -1):
        above = c >= edges[k] if include_lowest and k == 0 else c > edges[k]
        out = F.when(above & (c <= edges[k + 1]), F.lit(labels[k])).otherwise(out)
    return out


def slug(c: Column) -> Column:
    """Lower case with runs of other characters than letters and digits as one underscore."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_")


def ordinal(c: Column, order: list[str], unseen: int = -1) -> Column:
    """The rank of a value in the given order; null counts as blank, and unseen values have one rank of their own."""
    at = F.array_position(F.array(*(F.lit(o) for o in order)), F.coalesce(c.cast("string"), F.lit("")))
    return F.when(at > 0, (at - 1).cast("int")).otherwise(F.lit(unseen))
