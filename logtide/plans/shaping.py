"""Plan-shaping helper.

`with_columns_once`: Catalyst pushes a filter below a projection by
substituting each projected alias into the predicate. When the alias is a
costly expression (`from_json`, `to_json`), every field the predicate touches
re-evaluates it — a filter on three fields of a parsed line parses the line
three more times. A Generate node (``inline`` of a one-element array) is a
boundary predicates cannot cross, so its output columns are computed exactly
once per row and later filters read them as plain fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(df: DataFrame, **named: Column) -> DataFrame:
    """df plus columns `named`, each evaluated once per row (see module doc)."""
    row = F.struct(*[expr.alias(name) for name, expr in named.items()])
    keep = [c for c in df.columns if c not in named]
    return df.select(*keep, F.inline(F.array(row)))
