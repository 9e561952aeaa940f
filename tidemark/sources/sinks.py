"""Writers. A table is published as a new version with a manifest; readers follow the newest manifest.

A version's data is written first, under a folder of its own, by Spark's commit protocol. Then its
manifest is put in place by a rename that fails if another writer took the number. A failed write
leaves no manifest, so readers keep the old version; a table may be rebuilt from itself, since its old
version stays until ``prune``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder

# beside the versions of a table: one manifest per version, numbered
MANIFESTS = "manifests"


def written_once(df: DataFrame) -> DataFrame:
    """Write a frame that several parts of a result read to the shared folder, and hand back the written one.

    It cuts the lineage and survives lost executors. The folder is removed when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/once-{uuid.uuid4().hex}"
    df.write.parquet(path)
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(there)
    return spark.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str) -> tuple[Any, Any]:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions of a table, ascending."""
    fs, folder = _at(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict[str, Any]:
    """What was recorded when a version was published, the newest by default."""
    numbers = _numbers(spark, path)
    if not numbers or (version is not None and version not in numbers):
        raise FileNotFoundError(f"nothing is published at {path}" + (f" as version {version}" if version is not None else ""))
    fs, there = _at(spark, f"{path}/{MANIFESTS}/{version if version is not None else numbers[-1]:08d}.json")
    stream = fs.open(there)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _record(spark: SparkSession, path: str, entry: dict[str, Any]) -> dict[str, Any]:
    """Put a manifest in place under the next free number."""
    fs, draft = _at(spark, f"{path}/{MANIFESTS}/.{uuid.uuid4().hex}")
    while True:
        numbers = _numbers(spark, path)
        entry["version"] = numbers[-1] + 1 if numbers else 1
        stream = fs.create(draft, True)
        stream.write(bytearray(json.dumps(entry), "utf-8"))
        stream.close()
        # a rename onto an existing file fails: then another writer was first
        if fs.rename(draft, _at(spark, f"{path}/{MANIFESTS}/{entry['version']:08d}.json")[1]):
            return entry


def publish(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), measures: Mapping[str, Column] | None = None
) -> dict[str, Any]:
    """Write the frame as the next version of the table at ``path`` and return its manifest.

    Rows, and any other aggregate in ``measures``, are counted by the writing job itself. With partition
    columns, rows are first brought together by partition value, with a hash of nothing else, so AQE
    can split a partition value that holds most rows into several files.
    """
    spark = df.sparkSession
    data = f"data-{uuid.uuid4().hex}"
    seen = Observation()
    # counted after the last shuffle, so that a repeated task of an earlier stage counts once
    counted = (df.hint("rebalance", *partition_by) if partition_by else df).observe(
        seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (measures or {}).items()])
    out = counted.write.partitionBy(*partition_by) if partition_by else counted.write
    out.parquet(f"{path}/{data}")
    return _record(spark, path, {"data": data, "columns": [list(c) for c in df.dtypes], **seen.get})


def data_folder(spark: SparkSession, path: str, version: int | None = None) -> str:
    """Where a published version's files are."""
    return f"{path}/{manifest(spark, path, version)['data']}"


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(data_folder(spark, path, version))


def prune(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove all but the newest versions, manifests first; returns the numbers removed."""
    gone = _numbers(spark, path)[:-keep]
    for number in gone:
        data = data_folder(spark, path, number)
        fs, there = _at(spark, f"{path}/{MANIFESTS}/{number:08d}.json")
        fs.delete(there, False)
        fs.delete(_at(spark, data)[1], True)
    return gone


def manifests(spark: SparkSession, paths: Mapping[str, str], versions: Mapping[str, int] | None = None) -> DataFrame:
    """(table_name, expected_rows) as recorded at publication, one row per table."""
    entries = [(name, manifest(spark, path, (versions or {}).get(name))["rows"]) for name, path in paths.items()]
    return spark.createDataFrame(entries, "table_name string, expected_rows bigint")


def publish_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Publish the frame as a new version of ``path``; returns the folder of its files."""
    return f"{path}/{publish(df, path, partition_by)['data']}"


def materialise(
    models: Mapping[str, DataFrame],
    folder: str,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """Publish each model and hand back frames that read the written files."""
    partition_by = partition_by or {}
    written = {}
    for name, frame in models.items():
        path = publish_parquet(frame, f"{folder}/{name}", partition_by.get(name, ()))
        written[name] = frame.sparkSession.read.parquet(path)
    return written


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """UTF-8 CSV with a header line; an empty result still writes the header.

    ``single_file`` is for report-sized results: it funnels the rows through one task.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
    return path
