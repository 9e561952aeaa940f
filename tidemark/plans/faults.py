"""Faults planted in one model of a warehouse, to show that the checks on it report them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.warehouse import Warehouse

Change = Callable[[DataFrame], DataFrame]
# models that are staged tables
STAGED = {
    "users": "users", "documents": "documents", "sessions": "sessions", "events": "product_events", "runs": "agent_runs",
    "spans": "agent_spans", "assignments": "experiment_assignments",
}


def with_fault(w: Warehouse, model: str, change: Change) -> Warehouse:
    """The warehouse, with ``model`` replaced; models that are derived from it later read the changed one."""
    if model in STAGED:
        w._staged[STAGED[model]] = change(w.staged(STAGED[model]))
    else:
        w.__dict__[model] = change(getattr(w, model))
    return w


def repeat_rows(condition: str) -> Change:
    """Rows that meet the condition appear twice."""
    return lambda df: df.unionByName(df.where(condition))


def lose_rows(condition: str) -> Change:
    """Rows that meet the condition are missing."""
    return lambda df: df.where(~F.coalesce(F.expr(condition), F.lit(False)))


def overwrite(column: str, value: str, condition: str) -> Change:
    """A column holds another value in rows that meet the condition."""
    def change(df: DataFrame) -> DataFrame:
        kind = df.schema[column].dataType
        return df.withColumn(column, F.when(F.expr(condition), F.expr(value).cast(kind)).otherwise(F.col(column)))
    return change
