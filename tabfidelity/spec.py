"""What a table's columns are for, and the declarative rules over them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def deep_merge(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """A new mapping: `over` wins, mappings merge, lists are replaced whole."""
    out = dict(base)
    for k, v in over.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


@dataclass(frozen=True)
class TableSpec:
    """Roles of columns. A declared role wins over an inferred one."""

    categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    datetime: tuple[str, ...] = ()
    boolean: tuple[str, ...] = ()
    text: tuple[str, ...] = ()
    target: str | None = None
    quasi_ids: tuple[str, ...] = ()
    row_key: tuple[str, ...] = ()
    orders: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def expected(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((*self.categorical, *self.numeric, *self.datetime, *self.boolean, *self.text, *((self.target,) if self.target else ()))))

    @staticmethod
    def from_config(config: Mapping[str, Any]) -> TableSpec:
        schema = config.get("schema", {})
        cats, target = tuple(schema.get("categorical_columns", ())), config.get("target", schema.get("target_column"))
        numbers = tuple(c for c in schema.get("expected_columns", ()) if c not in cats and c != target)
        return TableSpec(categorical=cats, numeric=numbers, target=target, quasi_ids=tuple(config.get("quasi_identifiers", ())), orders={k: tuple(map(str, v)) for k, v in config.get("ordinal_orders", {}).items()})

    @staticmethod
    def from_types(df: DataFrame, types: Mapping[str, str], **declared: Any) -> TableSpec:
        """types: inferred semantic type of each column; declared roles win."""
        taken = {c for v in declared.values() if isinstance(v, (tuple, list)) for c in v}
        roles: dict[str, list[str]] = {"categorical": [], "numeric": [], "datetime": [], "boolean": [], "text": []}
        for c in df.columns:
            kind = {"integer": "numeric", "float": "numeric"}.get(types.get(c, "text"), types.get(c, "text"))
            if c not in taken and kind in roles:
                roles[kind].append(c)
        return TableSpec(**{k: tuple(declared.pop(k, ())) + tuple(v) for k, v in roles.items()}, **declared)


@dataclass(frozen=True)
class Rule:
    """A row is violated where `column operator value` does not hold. nulls: `violate` or `ignore`."""

    name: str
    column: str
    operator: str
    value: Any
    severity: str = "MEDIUM"
    description: str = ""
    nulls: str = "violate"


@dataclass(frozen=True)
class Bound:
    column: str
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class GroupRule:
    """The mean, or the share of some values, of one group against another's. A group is a value, null, or {operator: value}."""

    name: str
    group_column: str
    group_a: Any
    group_b: Any
    metric_column: str
    expected_direction: str
    metric_type: str = "mean"
    proportion_values: tuple[str, ...] = ()
    severity: str = "MEDIUM"


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
