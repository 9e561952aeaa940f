"""Raw layer: typed readers plus the lineage columns every raw row carries."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.contracts import Contract

LINEAGE = ("_source_run_id", "_source_config_hash", "_loaded_at_utc")


def read_parquet(spark: SparkSession, path: str, contract: Contract | None = None) -> DataFrame:
    """Parquet scan; a contract fixes the schema so no footer has to be read to plan."""
    reader = spark.read
    if contract is not None:
        reader = reader.schema(contract.ddl())
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, contract: Contract | str) -> DataFrame:
    """CSV with a header line and an explicit schema (never inferred)."""
    ddl = contract if isinstance(contract, str) else contract.ddl()
    return spark.read.schema(ddl).option("header", True).option("mode", "FAILFAST").csv(path)


def with_lineage(
    df: DataFrame, run_id: str, config_hash: str, source_file: str | None = None,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """Add run id, config hash, load time and source file to every row.

    The load time is fixed when the frame is built, so every task and every retry writes one value.
    Without ``source_file`` the name of the scanned file is taken, which needs a frame that is a
    plain scan of one source.
    """
    loaded_at = loaded_at or datetime.now(timezone.utc)
    stamp = loaded_at.strftime("%Y-%m-%d %H:%M:%S")
    origin = F.lit(source_file) if source_file else F.input_file_name()
    return df.select(
        "*",
        F.lit(run_id).alias("_source_run_id"),
        F.lit(config_hash).alias("_source_config_hash"),
        F.to_timestamp_ntz(F.lit(stamp)).alias("_loaded_at_utc"),
        origin.alias("_source_file"),
    )


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Expose a layer to SQL as temporary views; nothing is written or computed."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
