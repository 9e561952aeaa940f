"""Staging: one typed projection per table, driven by its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import count_rows
from tidemark.sources.contracts import Contract
from tidemark.sources.raw import LINEAGE



# --- fixed values: columns staging derives from others of the same row --------------------------
DERIVED = {
    "users": ["CAST(signup_time AS DATE) AS signup_date"],
    "documents": [
        "CAST(created_at AS DATE) AS created_date",
        "coalesce(complexity_level = 'complex', false) AS is_complex",
    ],
    "agent_runs": ["CAST(started_at AS DATE) AS run_date"],
}


def stage(raw: DataFrame, contract: Contract, key_type: str | None = None) -> DataFrame:
    """Cast to contract types, keep lineage where present, add the derived columns.

    Text columns keep the type they arrive with (``key_type`` forces one for ids), so integer keys
    stay integers and joins on them stay cheap.
    """
    found = dict(raw.dtypes)
    columns = []
    for name, kind in contract.types.items():
        wanted = kind
        if kind == "string":
            wanted = key_type if (name.endswith("_id") and key_type) else found[name]
        columns.append(name if wanted == found[name] else f"CAST({name} AS {wanted}) AS {name}")
    columns.extend(c for c in LINEAGE if c in found)
    staged = raw.selectExpr(*columns)
    derived = DERIVED.get(contract.name)
    return staged.selectExpr("*", *derived) if derived else staged


def cast_rejects(raw: DataFrame, contract: Contract) -> DataFrame:
    """Per typed column: rows whose non-null raw value does not survive the cast."""
    typed = {c: t for c, t in contract.types.items() if t != "string" and c in raw.columns}
    totals = raw.agg(
        count_rows("checked_rows"),
        *[
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c)
            for c, t in typed.items()
        ],
    )
    return totals.unpivot(["checked_rows"], list(typed), "column_name", "rejected_rows").select(
        F.lit(contract.name).alias("table_name"), "column_name", "checked_rows", "rejected_rows"
    )
