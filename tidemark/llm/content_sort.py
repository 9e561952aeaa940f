"""Exact duplicates by a content sort.

Sampled splitters cut normalised texts into ranges, each range is sorted externally, and neighbours
are compared in full. The row with the smallest identifier of equal texts stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, keep, prepare, shuffle_partitions, text_or_empty

RUN_SCHEMA = (
    "doc_id long, first_id long, n long, lead boolean, text_sha256 string, "
    "part int, run int, edge_text string"
)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in one sorted range.

    Only the identifiers of the texts that share the current sort key are held. A run whose key is
    the first or last of the range may go on in the next range: it is marked with its number, and one
    extra row carries its text for the comparison between ranges.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    schema = pa.schema([
        ("doc_id", pa.int64()), ("first_id", pa.int64()), ("n", pa.int64()), ("lead", pa.bool_()),
        ("text_sha256", pa.string()), ("part", pa.int32()), ("run", pa.int32()), ("edge_text", pa.string()),
    ])
    group: list[tuple[str, bytes, list[pa.Array]]] = []  # runs under the current key
    key = None
    flushed = 0
    numbered = 0

    def flush(edge: bool) -> Iterator[pa.RecordBatch]:
        nonlocal flushed, numbered
        for digest, text, ids in group:
            own = pa.concat_arrays(ids)
            n = len(own)
            edge_row = int(edge)
            total = n + edge_row
            lead = np.zeros(total, dtype=bool)
            lead[0] = True
            run = pa.array(np.full(total, numbered, np.int32)) if edge else pa.nulls(total, pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([own, pa.nulls(1, pa.int64())]) if edge else own,
                pa.concat_arrays([own.take(pa.array(np.zeros(total, np.int64)))]),
                pa.array(np.full(total, n, np.int64)), pa.array(lead), pa.array([digest] * total),
                pa.array(np.full(total, part, np.int32)), run,
                pa.array([None] * n + [text.decode()] * edge_row, pa.string()),
            ], schema=schema)
            numbered += edge_row
        flushed += 1
        group.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        ids, prefix, hashes, text = (batch.column(i) for i in range(4))
        size = batch.num_rows
        fresh = np.ones(size, dtype=bool)
        moved = np.ones(size, dtype=bool)
        if size > 1:
            same_key = pc.and_(pc.equal(prefix[1:], prefix[:-1]), pc.equal(hashes[1:], hashes[:-1]))
            moved[1:] = ~same_key.to_numpy(zero_copy_only=False)
            fresh[1:] = moved[1:] | pc.not_equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(fresh)
        binary = text.cast(pa.binary())
        for start, end in zip(starts, np.append(starts[1:], size), strict=True):
            content = binary[start].as_py()
            if moved[start]:
                at = (prefix[start].as_py(), hashes[start].as_py())
                if at != key:
                    if group:
                        yield from flush(edge=flushed == 0)
                    key = at
            own = ids.slice(start, end - start)
            if group and group[-1][1] == content:
                group[-1][2].append(own)
            else:
                group.append((hashlib.sha256(content).hexdigest(), content, [own]))
    if group:
        yield from flush(edge=True)


def content_sort_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix: int = 32,
    partitions: int | None = None,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    The sort key is the text's first ``prefix`` characters, a hash of the whole text, the whole text
    and the identifier. Ranges are cut by the short parts and the identifier, so the sample that
    the driver sees is short and the copies of one text, however many, spread over several ranges.
    Texts under one key are compared in full, within a range and between ranges.

    Null text counts as empty; null identifiers sort last; of rows that repeat identifier and text
    one is kept; an empty table gives an empty result; other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("i"), F.regexp_replace(text_or_empty(text_col), SPACES, " ").alias("t")
    ).select("i", F.substring("t", 1, prefix).alias("p"), F.xxhash64("t").alias("h"), "t")
    order = ["p", "h", "t", F.col("i").asc_nulls_last()]
    ranged = rows.repartitionByRange(
        partitions or shuffle_partitions(spark), "p", "h", F.col("i").asc_nulls_last()
    ).sortWithinPartitions(*order)
    runs = keep(ranged.mapInArrow(_runs, RUN_SCHEMA))
    edges = runs.where("edge_text is not null")
    whole = edges.groupBy("edge_text").agg(F.min("first_id").alias("keep_id"), F.sum("n").alias("total"))
    # at most a few rows for each range: its first and last runs
    joined = edges.join(whole, "edge_text").select("part", "run", "keep_id", "total")
    body = runs.where("edge_text is null")
    inner = body.where("run is null").select(
        "doc_id", F.col("first_id").alias("keep_id"), F.col("n").alias("group_size"), F.col("lead").alias("kept"), "text_sha256"
    )
    outer = body.where("run is not null").join(F.broadcast(joined), ["part", "run"]).select(
        "doc_id", "keep_id", F.col("total").alias("group_size"),
        (F.col("lead") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256",
    )
    return inner.unionByName(outer)


ORACLE = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)
"""
