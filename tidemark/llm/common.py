"""What the corpus operators share: shared-folder tables, word patterns, components of a graph."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import apply_defaults, shared_folder

# The white space of the contracts, as patterns that Java, RE2 and Python read alike.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# Rows and bytes in an Arrow batch, whichever is reached first: documents may be long, and a worker
# never holds more than a few batches.
ARROW_ROWS = 2000
ARROW_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session defaults of the corpus operators."""
    apply_defaults(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def keep(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Write a frame into the shared folder and read it back: cuts lineage, survives lost executors.

    The folder is removed when the driver's JVM ends; ``forget`` removes it earlier.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    out = spark.read.schema(df.schema).parquet(path)
    out._kept_at = path
    return out


def forget(*frames: DataFrame) -> None:
    """Remove what ``keep`` wrote, once nothing reads it any more."""
    for df in frames:
        path = getattr(df, "_kept_at", None)
        if path:
            spark = df.sparkSession
            jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def residue(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; ids that are null count as the text 'null'."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return F.crc32(text.cast("binary")) % modulus


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of links (a, b) between longs: one row (node, root), root the smallest node.

    Large-star and small-star rounds. A star's centre may be linked with a third of all nodes: minima
    combine before the shuffle, and the join back is an equi-join whose hot keys Spark splits.
    Nodes without a link do not appear. Raises if ``max_rounds`` do not suffice.
    """
    current = keep(edges.select("a", "b").where("a <> b").distinct())
    for _ in range(max_rounds):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("a")).agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: each node points at its smallest smaller neighbour, and so do its other ones
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        following = keep(small.where("a <> b").distinct())
        # settled when every node points at one root and no root points further
        fan = following.groupBy("a").agg(F.count("*").alias("n"))
        roots = following.select(F.col("b").alias("a")).distinct()
        open_ends = fan.join(roots, "a", "left_semi").limit(1).count() + fan.where("n > 1").limit(1).count()
        forget(current)
        current = following
        if not open_ends:
            roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
    raise RuntimeError("components did not settle")


# A key with more than this share of all rows is a hot one; there are fewer of them than 1 / HOT_SHARE.
HOT_SHARE = 0.001


def join_counted(rows: DataFrame, table: DataFrame, on: list[str], count: str) -> DataFrame:
    """Inner join with a ``table`` that has one row per key, where column ``count`` says how many rows have the key.

    Hot keys, those with more than ``HOT_SHARE`` of all rows, come from a broadcast of at most
    1 / ``HOT_SHARE`` rows, and their rows are dealt by a salt; the others meet in a shuffled join.
    """
    values = [c for c in table.columns if c not in on]
    hot_from = table.agg(F.sum(count) * F.lit(HOT_SHARE)).scalar()
    hot = table.where(F.col(count) > hot_from).select(*on, F.struct(*values).alias("__hot"))
    cold = table.where(F.col(count) <= hot_from)
    # not a literal, or the salt would be folded out of the keys
    cold = cold.select(*on, F.least(F.col(count), F.lit(0)).cast("long").alias("__salt"), F.struct(*values).alias("__cold"))
    others = [c for c in rows.columns if c not in on]
    salt = F.when(F.col("__hot").isNull(), F.lit(0)).otherwise(F.xxhash64(*others))
    marked = rows.join(F.broadcast(hot), on, "left").withColumn("__salt", salt)
    joined = marked.join(cold, [*on, "__salt"], "left").withColumn("__found", F.coalesce("__hot", "__cold"))
    return joined.where(F.col("__found").isNotNull()).select(*rows.columns, *[F.col("__found")[v].alias(v) for v in values])


def with_row_key(rows: DataFrame, id_col: str = "doc_id", key: str = "key"):
    """Rows with a column ``key`` that tells them apart, and a function that puts the identifier back.

    Where identifiers are unique and not null they are the keys. Otherwise the rows are written once
    with a number of their own.
    """
    seen = rows.groupBy(id_col).agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col(id_col).isNull())
    if not seen.limit(1).count():
        return rows.withColumn(key, F.col(id_col)), lambda made, column: made
    numbered = keep(rows.withColumn(key, F.monotonically_increasing_id()))
    names = numbered.select(F.col(key).alias("__key"), F.col(id_col).alias("__id"))

    def put_back(made: DataFrame, column: str) -> DataFrame:
        joined = made.join(names, made[column] == names["__key"])
        return joined.select(*[F.col("__id").alias(c) if c == column else made[c] for c in made.columns])

    return numbered, put_back
