"""Repair and parsing of generated text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID_CELL = "(?i)^(?=.*[a-f])[0-9a-f]{8,}$|^[0-9a-f]{32}$"


def strip_comments(c: Column) -> Column:
    """Without `<!-- -->` blocks."""
    return F.regexp_replace(c, r"(?s)<!--.*?-->", "")


def strip_fences(c: Column) -> Column:
    """Without Markdown fences around the text."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), r"^```[A-Za-z]*\s*", ""), r"\s*```$", ""))


def drop_section(c: Column, title: str) -> Column:
    """Without the Markdown section of this title: its heading up to the next of its level or the end."""
    import re

    return F.regexp_replace(c, rf"(?s)(?m:^)## {re.escape(title)}.*?(?=(?m:^)## |\z)", "")


def verdict(c: Column) -> Column:
    """An auditor's JSON as a struct; `error` holds the text where it is not JSON."""
    schema = "verdict string, score double, issues array<string>"
    body = strip_fences(c)
    parsed = F.from_json(body, schema, {"mode": "PERMISSIVE"})
    bad = F.try_parse_json(body).isNull()
    return F.struct(F.when(~bad, parsed["verdict"]).alias("verdict"), F.when(~bad, parsed["score"]).alias("score"), F.when(~bad, parsed["issues"]).alias("issues"), F.when(bad, body).alias("error"))


def repaired_cells(line: Column, columns: list[str], pad: int = 3) -> Column:
    """The cells of a generated line, or null where it cannot be repaired.

    Cells are trimmed and lose quotes around them. A line with one cell too many loses a leading identifier; one
    that is `pad` cells short gets blanks at its end; an identifier in the first of the right number of cells, or any other number of cells, is beyond repair.
    """
    n = len(columns)
    cells = F.transform(F.split(line, r",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)"), lambda x: F.trim(F.regexp_replace(F.trim(x), r'^"(.*)"$', "$1")))
    head_id = F.element_at(cells, 1).rlike(ID_CELL)
    blank = F.array_repeat(F.lit(""), pad)
    return (
        F.when((F.size(cells) == n + 1) & head_id, F.slice(cells, 2, n))
        .when((F.size(cells) == n - pad) & ~head_id, F.concat(cells, blank))
        .when((F.size(cells) == n) & ~head_id, cells)
    )


def parse_rows(lines: DataFrame, columns: list[str], line: str = "line", pad: int = 3) -> DataFrame:
    """The input with `cells` and `malformed`; blank lines, fences and repeated headers are left out."""
    bare = F.trim(F.col(line))
    header = F.lower(F.regexp_replace(bare, r"\s*,\s*", ",")) == F.lit(",".join(columns).lower())
    kept = lines.where((F.coalesce(bare, F.lit("")) != "") & ~bare.startswith("```") & ~header)
    return kept.withColumn("cells", repaired_cells(bare, columns, pad)).withColumn("malformed", F.col("cells").isNull())


def rule_items(c: Column) -> Column:
    """The items of a serialised set such as `frozenset({'a_1', 'b_2'})`, sorted."""
    return F.sort_array(F.regexp_extract_all(c, F.lit("'([^']+)'"), F.lit(1)))


def feature(column: str, value: Column) -> Column:
    """`<column>_<value>`, or null for a null value."""
    return F.when(value.isNotNull(), F.concat(F.lit(f"{column}_"), value.cast("string")))


def is_hash_like(df: DataFrame, column: str, probe: int = 20, share: float = 0.8) -> DataFrame:
    """One row: whether most of the first non-null values are 32 hexadecimal digits."""
    some = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("v")).limit(probe)
    return some.agg(F.coalesce(F.avg(F.col("v").rlike("^[0-9a-f]{32}$").cast("double")) > share, F.lit(False)).alias("hash_like"))
