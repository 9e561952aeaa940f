"""Table profiles, raw-layer verification and order-free content hashes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import count_rows, ratio, stable_round
from tidemark.sources.contracts import Contract


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, row_count: one partial count per table, nothing shuffled but the totals."""
    return _union(
        [
            frame.agg(count_rows("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, frame in tables.items()
        ]
    )


def verify_raw(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract], manifest: DataFrame
) -> DataFrame:
    """Row count equals the manifest count and no primary key is NULL, per table.

    ``manifest`` has table_name and expected_rows.
    """
    counted = _union(
        [
            frame.agg(
                count_rows("row_count"),
                F.count_if(F.col(contracts[name].primary_key).isNull()).alias("null_pk_count"),
            ).select(F.lit(name).alias("table_name"), "row_count", "null_pk_count")
            for name, frame in tables.items()
        ]
    )
    return counted.join(manifest, "table_name", "left").select(
        "table_name",
        "row_count",
        "expected_rows",
        "null_pk_count",
        F.coalesce(
            (F.col("row_count") == F.col("expected_rows")) & (F.col("null_pk_count") == 0), F.lit(False)
        ).alias("passed"),
    )


def target_deviation(tables: Mapping[str, DataFrame], targets: Mapping[str, int]) -> DataFrame:
    """Actual against configured row counts; the ratio divides by at least one."""
    wanted = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
    target = F.coalesce(F.element_at(wanted, F.col("table_name")), F.lit(0)).cast("bigint")
    return row_counts(tables).select(
        "table_name",
        target.alias("configured_target"),
        F.col("row_count").alias("actual_rows"),
        stable_round(ratio(F.col("row_count") - target, F.greatest(target, F.lit(1))), 4).alias("deviation_ratio"),
    )


def column_profile(df: DataFrame, contract: Contract, distinct: bool = False) -> DataFrame:
    """Per column: type, key roles, rows, NULLs and (optionally) distinct values."""
    roles = {f.column: f"{f.parent}.{f.parent_column}" for f in contract.foreign_keys}
    names = [c for c in contract.types if c in df.columns]
    types = dict(df.dtypes)
    pieces = [count_rows("__rows")]
    for c in names:
        pieces.append(F.count_if(F.col(c).isNull()).alias(f"__null_{c}"))
        if distinct:
            pieces.append(F.approx_count_distinct(c).alias(f"__dist_{c}"))
    totals = df.agg(*pieces)
    entries = [
        F.struct(
            F.lit(contract.name).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            F.lit(c == contract.primary_key).alias("is_primary_key"),
            F.lit(roles.get(c)).cast("string").alias("references"),
            F.col("__rows").alias("row_count"),
            F.col(f"__null_{c}").alias("null_count"),
            *([F.col(f"__dist_{c}").alias("approx_distinct")] if distinct else []),
        )
        for c in names
    ]
    return totals.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def normalised_text(df: DataFrame, column: str) -> Column:
    """Text form that does not depend on engine defaults: NULL marker, 10 decimals, ISO times."""
    kind = dict(df.dtypes)[column]
    value = F.col(column)
    if kind.startswith("timestamp"):
        text = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    elif kind == "date":
        text = F.date_format(value, "yyyy-MM-dd")
    elif kind in ("double", "float"):
        text = F.format_string("%.10f", value.cast("double"))
    else:
        text = value.cast("string")
    return F.coalesce(F.when(value.isNotNull(), text), F.lit("NULL"))


def content_hash(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Fingerprint that does not depend on row order: no sort, one partial aggregate.

    Every row is hashed with SHA-256 over its normalised columns in name order. Four 32-bit pieces
    of the digest are summed separately, so equal multisets of rows give equal sums.
    """
    columns = sorted(columns or df.columns)
    digest = F.sha2(F.concat_ws("\x1f", *[normalised_text(df, c) for c in columns]), 256)
    hashed = df.select(digest.alias("h"))

    def piece(i: int) -> Column:
        number = F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("decimal(20,0)")
        return F.sum(number).cast("string").alias(f"digest_{i + 1}")

    return hashed.agg(count_rows("row_count"), *[piece(i) for i in range(4)]).select(
        F.lit(name).alias("table_name"), "row_count", *[f"digest_{i + 1}" for i in range(4)]
    )
