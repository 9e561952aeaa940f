"""Importance resampling towards a target: hashed n-gram gains, Gumbel noise, the highest scores."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.order_stats import exact_percentiles
from tidemark.llm.common import keep, prepare

# What stands between words, in lower-cased text, as the contract writes it.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST_RUN = 3
BUCKETS = 10_000
LEAST_WORDS = 20
DRAWN_PERCENT = 5
SEED = 42


class Crc:
    """CRC-32 of texts put together, for whole arrays: appending n bytes acts on a CRC as one linear map per n."""

    def __init__(self, appended: list[bytes]):
        self.own = np.array([zlib.crc32(a) for a in appended], dtype=np.uint32)
        lengths, self.kind = np.unique(np.array([len(a) for a in appended], dtype=np.int64), return_inverse=True)
        self.tables = np.stack([self._map(n) for n in lengths.tolist()]) if len(lengths) else np.zeros((1, 4, 256), np.uint32)

    @staticmethod
    def _map(n: int) -> np.ndarray:
        """The map of n bytes as four tables, one per byte of the CRC, from its images of single bits."""
        zeros, table, byte = bytes(n), np.zeros((4, 256), dtype=np.uint32), np.arange(256)
        for bit in range(32):
            image = zlib.crc32(zeros, 1 << bit) ^ zlib.crc32(zeros)
            table[bit // 8] ^= np.where(byte >> (bit % 8) & 1, image, 0).astype(np.uint32)
        return table

    def after(self, before: np.ndarray, which: np.ndarray) -> np.ndarray:
        """CRCs of the texts with CRCs ``before``, each followed by the appended text number ``which``."""
        kind, out = self.kind.take(which), self.own.take(which)
        for place in range(4):
            out = out ^ self.tables[kind, place, before >> np.uint32(8 * place) & np.uint32(255)]
        return out


class Features:
    """The word runs of a batch of texts: per length of run, the bucket of each distinct run and where it occurs."""

    def __init__(self, texts: pa.Array, buckets: int):
        parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), BETWEEN)
        words, row = pc.list_flatten(parts), pc.list_parent_indices(parts)
        real = pc.not_equal(words, "")  # a separator at either end leaves an empty piece
        coded = words.filter(real).dictionary_encode()
        self.row = row.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)
        names = [w.encode() for w in coded.dictionary.to_pylist()]
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = np.bincount(self.row, minlength=len(texts))
        # (row of each run, number of its distinct run, bucket of each distinct run)
        crcs = np.array([zlib.crc32(n) for n in names], dtype=np.uint32)
        self.runs = [(self.row, index, crcs.astype(np.int64) % buckets)]
        spaced, base = Crc([b" " + n for n in names]), max(len(names), 1)
        run, at = index, np.arange(len(index))
        for length in range(2, LONGEST_RUN + 1):
            # the run that starts here, one word longer: its number so far beside the index of the next word
            inside = at + length - 1 < len(self.row)
            at, run = at[inside], run[inside]
            same = self.row[at] == self.row[at + length - 1]
            at, run = at[same], run[same]
            pairs = pa.array(run * base + index[at + length - 1]).dictionary_encode()
            distinct = pairs.dictionary.to_numpy(zero_copy_only=False)
            crcs = spaced.after(crcs.take(distinct // base), distinct % base)
            run = pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            self.runs.append((self.row[at], run, crcs.astype(np.int64) % buckets))

    def counts(self, buckets: int) -> np.ndarray:
        """How many runs of the batch fall into each bucket."""
        total = np.zeros(buckets, dtype=np.int64)
        for _, run, bucket in self.runs:
            np.add.at(total, bucket, np.bincount(run, minlength=len(bucket)))
        return total

    def sums(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text: number of runs, and the sum of their buckets' gains."""
        number, weight = np.zeros_like(self.words), np.zeros(len(self.words), dtype=np.int64)
        for row, run, bucket in self.runs:
            ends = np.searchsorted(row, np.arange(len(self.words) + 1))
            reached = np.concatenate([[0], np.cumsum(gains.take(bucket).take(run))])
            number += np.diff(ends)
            weight += np.diff(reached.take(ends))
        return number, weight


def _count_task(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            total += Features(batch.column(0), buckets).counts(buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return run


def _score_task(gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Features(batch.column(1), len(gains))
            number, weight = found.sums(gains)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.words.astype(np.int64)), pa.array(number.astype(np.int64)), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"])

    return run


def bucket_counts(rows: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): runs per bucket over all texts. A task hands on at most one row per bucket."""
    found = rows.select(F.col(text_col).alias("text")).mapInArrow(_count_task(buckets), "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, in thousandths: smoothed log ratio of its share in ``target`` and in ``docs``.

    Exactly ``buckets`` numbers reach the driver, whatever the size of the tables.
    """
    spark = docs.sparkSession
    source = bucket_counts(docs, text_col, buckets).select("bucket", F.col("n").alias("s"))
    wanted = bucket_counts(target, text_col, buckets).select("bucket", F.col("n").alias("t"))
    every = spark.range(buckets).withColumnRenamed("id", "bucket").join(source, "bucket", "left").join(wanted, "bucket", "left")
    pairs = every.select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
    # sorted here: a distributed sort would sample its input, which reads the texts once more
    found = pairs.toPandas().sort_values("bucket")
    s, t = found["s"].to_numpy(dtype=float), found["t"].to_numpy(dtype=float)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = DRAWN_PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank.

    A document's weight is the sum of its runs' gains; a Gumbel number from SHA-256 of the identifier is
    added, and of the documents with ``least_words`` words the given percentage with the highest scores
    is drawn without replacement. Ties go to the smaller identifier, null last.

    Batches are counted by Arrow kernels: words become dictionary indices, runs pairs of indices, and each
    distinct run is hashed once per batch. The lowest drawn score is an exact order statistic from counts;
    only rows from there on are sorted, dealt by range and written, and numbered part by part.

    Null and empty texts have no features, weight 0 and are never drawn; a null identifier hashes as the
    text 'null'; repeated rows count and are drawn separately; very long texts are read whole; empty tables
    give an empty result or gains against an empty target; other columns are not read.
    """
    prepare(docs.sparkSession)
    gains = bucket_gains(docs, target, text_col, buckets)
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = named.schema["doc_id"].dataType.simpleString()
    measured = named.mapInArrow(_score_task(gains), f"doc_id {kind}, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))
    scored = keep(measured.withColumn("score", F.col("weight") + noise).withColumn("row", F.monotonically_increasing_id()))
    enough = F.col("n_words") >= least_words
    # the score at the place where the drawn ones begin, counted from the lowest
    begins = exact_percentiles(
        scored.where(enough).select(F.lit(0).alias("all"), "score"), ["all"], "score",
        {"from": lambda n: n - F.greatest(F.floor(n * percent / 100), F.lit(1))}, bounded_groups=True)
    lowest = begins.select("from").scalar().cast("long")
    number = scored.where(enough).agg(F.floor(F.count("*") * percent / 100)).scalar()
    reaches = F.coalesce(enough & (F.col("score") >= lowest), F.lit(False))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    marked = scored.withColumn("reaches", reaches)
    dealt = keep(marked.where("reaches").repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    sizes = dealt.groupBy("part").agg(F.count("*").alias("k"))
    # one row per partition of the sort
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("part"), F.coalesce(F.sum("k").over(before), F.lit(0)).alias("start"))
    placed = dealt.join(starts, "part").withColumn(
        "place", F.col("start") + F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    rank = F.when(F.col("place") <= number, F.col("place"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return placed.select(*columns, rank.cast("long").alias("rank")).unionByName(
        marked.where(~F.col("reaches")).select(*columns, F.lit(None).cast("long").alias("rank")))
