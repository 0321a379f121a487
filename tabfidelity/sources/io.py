"""Readers and sinks. Missing cells are decided once, here: tokens for missing become null in every reader of text."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import missing_tokens_to_null
from ..functions.text import rule_items, strip_comments
from ..spec import deep_merge

#: Names that a written index column has.
INDEX_NAMES = ("", "_c0", "Unnamed: 0")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, typed: bool = True) -> DataFrame:
    """A CSV table with a header, without a written index column, and with null for missing.

    A schema is applied by position of its names; without one, typed=True infers types from the cells that are there, typed=False
    keeps strings, so that no bad value is hidden.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False, escape='"', multiLine=False)
    if raw.columns and raw.columns[0] in INDEX_NAMES:
        raw = raw.drop(raw.columns[0])
    clean = missing_tokens_to_null(raw)
    if schema is not None:
        want = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return clean.select(*(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in want))
    if not typed or not clean.columns:
        return clean
    # One pass over all cells: a column is long or double if every cell that is there is.
    tests = [x for i, c in enumerate(clean.columns) for x in (F.count(F.col(f"`{c}`")).alias(f"n{i}"), F.count(F.col(f"`{c}`").try_cast("long")).alias(f"l{i}"), F.count(F.col(f"`{c}`").try_cast("double")).alias(f"d{i}"))]
    got = clean.agg(*tests).first()
    kind = lambda i: "long" if got[f"n{i}"] and got[f"l{i}"] == got[f"n{i}"] else "double" if got[f"n{i}"] and got[f"d{i}"] == got[f"n{i}"] else "string"
    return clean.select(*(F.col(f"`{c}`").try_cast(kind(i)).alias(c) for i, c in enumerate(clean.columns)))


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV table; only the first line is read."""
    return [c for c in spark.read.csv(path, header=True, inferSchema=False).columns if c not in INDEX_NAMES]


def read_stats(path: str) -> dict[str, Any]:
    """A stats profile."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def read_config(*paths: str) -> dict[str, Any]:
    """YAML files merged in order; the later wins, lists are replaced whole."""
    import yaml

    out: dict[str, Any] = {}
    for p in paths:
        with open(p, encoding="utf-8") as f:
            out = deep_merge(out, yaml.safe_load(f) or {})
    return out


def project_root(start: str | None = None, marker: str = "config.yaml", variable: str = "TABFIDELITY_ROOT") -> Path:
    """The folder named by the environment, or the nearest one upwards that has the marker, or the start."""
    if os.environ.get(variable):
        return Path(os.environ[variable])
    here = Path(start or os.getcwd()).resolve()
    return next((p for p in (here, *here.parents) if (p / marker).exists()), here)


def domain_of(path: str, known: list[str]) -> str | None:
    """The known domain that a file's name tells: all its words, else the longest name that it starts with."""
    words = Path(path).stem.lower().replace("-", "_").split("_")
    exact = [k for k in known if all(w in words for w in k.lower().split("_"))]
    starts = [k for k in known if k.lower().startswith(words[0]) or words[0].startswith(k.lower().split("_")[0])]
    return max(exact or starts, key=len, default=None)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """antecedents, consequents (sorted arrays), support, confidence, lift of a mined-rule CSV; lift is null where it was not kept."""
    raw = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"')
    lift = F.col("lift").try_cast("double") if "lift" in raw.columns else F.lit(None).cast("double")
    return raw.select(rule_items(F.col("antecedents")).alias("antecedents"), rule_items(F.col("consequents")).alias("consequents"), F.col("support").try_cast("double").alias("support"), F.col("confidence").try_cast("double").alias("confidence"), lift.alias("lift"))


def read_prompt(path: str) -> str:
    """A prompt file without comments."""
    import re

    return re.sub(r"(?s)<!--.*?-->", "", Path(path).read_text(encoding="utf-8")).strip()


def prompts_table(spark: SparkSession, path: str) -> DataFrame:
    """A row per prompt file: path and text without comments."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), strip_comments(F.col("value")).alias("text"))


# -- sinks ---------------------------------------------------------------------------------------------------


def write_json(value: Mapping[str, Any], path: str) -> None:
    """One JSON document, indented; what JSON has no form for is written as text."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, indent=2, default=str), encoding="utf-8")


def write_csv(rows: Sequence[Mapping[str, Any]], path: str) -> None:
    """A small report, a row per entry, with a header."""
    import csv

    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        out = csv.DictWriter(f, list(rows[0]) if rows else [])
        out.writeheader()
        out.writerows(rows)


def append_rows(df: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> None:
    """Append rows under their run's partition, so that runs can be told apart and taken back."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").format(fmt).save(path)


def write_rules(rules: DataFrame, path: str) -> None:
    """Mined rules with their lift: sets as text, one file per partition."""
    as_set = lambda c: F.concat(F.lit("frozenset({"), F.concat_ws(", ", F.transform(c, lambda x: F.concat(F.lit("'"), x, F.lit("'")))), F.lit("})"))
    rules.select(as_set("antecedents").alias("antecedents"), as_set("consequents").alias("consequents"), "support", "confidence", "lift").write.mode("overwrite").csv(path, header=True, quoteAll=True)


def save_model(model: Any, path: str) -> None:
    model.write().overwrite().save(path)
