"""Name -> (DataFrame query, SQL counterpart) with shared result conventions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.views import EXPERIMENT_END, EXPERIMENT_START, sql
from tidemark.functions.exprs import stable_round
from tidemark.plans.warehouse import Warehouse
from tidemark.session import apply_defaults
from tidemark.sources import bindings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# the counterparts before they are bound to tables
SELECTS: dict[str, str] = {}


def warehouse(spark: SparkSession, folder: str, binding: str = "product") -> Warehouse:
    texts = bindings.PRODUCT_BINDING if binding == "product" else bindings.TRACE_BINDING
    return Warehouse(
        bindings.bind(spark, folder, texts),
        experiment_start=EXPERIMENT_START,
        experiment_end=EXPERIMENT_END,
    )


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable result: doubles rounded without negative zero, all integers BIGINT."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            column = stable_round(column, digits) + F.lit(0.0)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def register(
    name: str,
    build: Callable[[Warehouse], DataFrame],
    select: str | None = None,
    doubles: str = "",
    integers: str = "",
    binding: str = "product",
    digits: int = 6,
) -> None:
    """Register a query on a warehouse and, where SQL can express it, its counterpart."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        apply_defaults(spark)
        return finish(build(warehouse(spark, folder, binding)), digits)

    if name in QUERIES:
        raise ValueError(f"duplicate query name: {name}")
    QUERIES[name] = run
    if select is not None:
        SELECTS[name] = select
        ORACLES[name] = sql(select, doubles, integers, binding, digits)
