"""Filter mini-language: `{"col": ">= 5"}`, AND-ed, pushed down to any source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Operators, longest first so that ">=" is not read as ">".
OPERATORS = (">=", "<=", "!=", ">", "<")


def apply_filters(df: DataFrame, filters: dict[str, object] | None) -> DataFrame:
    for name, rule in (filters or {}).items():
        if name not in df.columns:
            raise ValueError(f"Filter column '{name}' not found; available: {df.columns}")
        column, op, value = F.col(name), "=", rule
        if isinstance(rule, str):
            text = rule.strip()
            op = next((o for o in OPERATORS if text.startswith(o)), "=")
            value = text[len(op) :].strip() if op != "=" else rule
        dtype = df.schema[name].dataType
        # The literal takes the column's type, so that the scan can use the filter.
        right = F.lit(value)
        if isinstance(value, str) and not isinstance(dtype, T.StringType):
            right = right.cast(dtype)
        condition = {
            "=": column == right, "!=": column != right, ">": column > right,
            "<": column < right, ">=": column >= right, "<=": column <= right,
        }[op]
        df = df.where(condition)
    return df
