"""Mixing sources to target weights by systematic sampling, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, join_counted, keep, prepare

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix"
# Rows of one source and size that are ranked together; larger groups are cut by their hash.
RANKED_TOGETHER = 4096


def _unit(text: Column) -> Column:
    """A fixed number in [0, 1) from a text: the first 32 bits of its MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: source_size and target.

    Sources by code point, null last, take the weights in turn. A target stops at ``most`` times its
    source's size; the rest is shared again by weight. With sources in the order of cap / weight, the
    stopped ones are a prefix, so the common level follows from two running sums over the sources.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight.cast("double")).withColumn("turn", turn)
    per = per.withColumn("cap", (F.col("source_size") * most).cast("double"))
    by_ratio = W.orderBy(F.col("cap") / F.col("w"), "turn")
    everything = W.orderBy("turn").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    per = per.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    stopped = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("w").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    per = per.withColumn("level", (F.col("total") - stopped) / left)
    per = per.withColumn("capped", F.col("cap") / F.col("w") < F.col("level"))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    return per.withColumn("common", level).select(
        "source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("common") * F.col("w")).alias("target")
    )


def mix_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    Every document of a source expects target / source_size copies. Documents stand in the order of
    size, then MD5 of the identifier; with one random offset per source, a document is taken once for
    each integer that the running sum of expected copies crosses. In this order a source's taken words
    miss its target by less than its largest document.

    The running sum is a rank. Ranks come from counts: per (source, size), then per slice of the hash
    within a large group, so that no window holds more than sizes, slices, or one slice's rows.

    Null text and text without a word have size 0 and add no words; a null source is a source, the
    last one; null identifiers hash as the text 'null'; repeated rows count separately; an empty
    table gives an empty result; other columns are not read.
    """
    prepare(docs.sparkSession)
    sized = keep(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ))
    targets = source_targets(sized, weights, most)
    # a null source cannot be an equi-join key: it becomes a flag beside the text
    named = [F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("s_null")]
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"))
    rows = sized.select("doc_id", "source", "size", *named, digest.alias("d"))
    group = ["s", "s_null", "size"]
    cells = rows.groupBy(*group).agg(F.count("*").alias("n"))
    before = W.partitionBy("s", "s_null").orderBy("size").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("cell_at", F.coalesce(F.sum("n").over(before), F.lit(0)))
    cells = cells.withColumn("slices", F.ceil(F.col("n") / RANKED_TOGETHER).cast("long"))
    first = F.conv(F.substring("d", 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    rows = join_counted(rows, keep(cells), group, "n").withColumn("slice", F.floor(first * F.col("slices")))
    parts = rows.groupBy(*group, "slice").agg(F.count("*").alias("k"))
    before = W.partitionBy(*group).orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("slice_at", F.coalesce(F.sum("k").over(before), F.lit(0)))
    rank = F.row_number().over(W.partitionBy(*group, "slice").orderBy("d", "doc_id"))
    ranked = rows.withColumn("rank", rank).join(parts, [*group, "slice"])
    position = F.col("cell_at") + F.col("slice_at") + F.col("rank")
    goal = targets.select(
        *named, "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
        _unit(F.concat(F.lit(f"{seed}|"), F.coalesce("source", F.lit("")), F.when(F.col("source").isNull(), "|null").otherwise(""))).alias("u"),
    )
    crossed = F.floor(position * F.col("rate") + F.col("u")) - F.floor((position - 1) * F.col("rate") + F.col("u"))
    return ranked.join(goal, ["s", "s_null"]).select(
        "doc_id", "source", "size", "source_size", "target", crossed.cast("long").alias("copies")
    ).withColumn("taken", F.col("copies") * F.col("size"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The mixed corpus: every input row as often as ``mix_copies`` takes it, with the input's columns.

    Rows that agree in identifier, source and size share their copies evenly, in the order of the text.
    """
    counts = mix_copies(docs, id_col, text_col, source_col, **options)
    keys = [F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"), F.col("size").alias("__mix_size")]
    counts = counts.groupBy(*keys).agg(F.sum("copies").alias("__mix_copies"), F.count("*").alias("__mix_rows"))
    counts = keep(counts.where("__mix_copies > 0"))
    sized = docs.withColumn("__mix_n", F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long"))
    joined = sized.join(
        counts,
        sized[id_col].eqNullSafe(counts["__mix_id"])
        & sized[source_col].eqNullSafe(counts["__mix_source"])
        & (sized["__mix_n"] == counts["__mix_size"]),
    )
    alone = joined.where("__mix_rows = 1").withColumn("__mix_own", F.col("__mix_copies"))
    within = W.partitionBy("__mix_id", "__mix_source", "__mix_size").orderBy(text_col)
    shared = joined.where("__mix_rows > 1").withColumn(
        "__mix_own",
        F.floor(F.col("__mix_copies") / F.col("__mix_rows"))
        + (F.row_number().over(within) <= F.col("__mix_copies") % F.col("__mix_rows")).cast("long"),
    )
    out = alone.unionByName(shared).where("__mix_own > 0")
    out = out.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_own").cast("int"))))
    return out.select(*docs.columns)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][(turn % 3 + 1)::INT]::DOUBLE AS w, (source_size * 3)::DOUBLE AS cap FROM per
), levelled AS (
  SELECT *, ((SELECT sum(source_size) FROM per)::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / w, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), goal AS (
  SELECT source, source_size,
         CASE WHEN cap / w < level THEN cap ELSE w * max(level) FILTER (WHERE cap / w >= level) OVER () END AS target,
         ('0x' || substr(md5('mix|' || coalesce(source, '') || CASE WHEN source IS NULL THEN '|null' ELSE '' END), 1, 8))::BIGINT
           / 4294967296.0::DOUBLE AS u
  FROM levelled
), placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.u,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, md5(coalesce(s.doc_id::VARCHAR, 'null')), s.doc_id) AS k
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       ((floor(k * rate + u) - floor((k - 1) * rate + u)) * size)::BIGINT AS taken
FROM placed
"""
