"""Repeated runs of lines by a suffix array over line identifiers, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, forget, join_counted, keep, prepare, text_or_empty, with_row_key

# Lines that a repeated run has at least; a power of two.
MIN_LINES = 2
# Words from which one repeated line is a passage, a run by itself.
PASSAGE_WORDS = 50
# Ranks that one window orders; larger groups are cut by ranges of their second rank.
RANKED_TOGETHER = 4096
# Ranges of the hash in which the first ranks are counted.
RANGE_BITS = 14
_MOST_ROUNDS = 40


def _first_ranks(lines: DataFrame) -> DataFrame:
    """Repeated lines: how many, where first, and the rank of the identifier (one more than there are smaller ones)."""
    counts = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("place").alias("first")).where("n > 1")
    counts = keep(counts.withColumn("range", F.shiftright("h1", 64 - RANGE_BITS)))
    ranges = counts.groupBy("range").agg(F.sum("n").alias("k"))
    # one row per range, a fixed number
    before = F.coalesce(F.sum("k").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select("range", before.alias("at"))
    inside = W.partitionBy("range").orderBy("h1", "h2").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return counts.join(ranges, "range").select("h1", "h2", "n", "first", (F.col("at") + F.col("inside") + 1).alias("r"))


def _refine(rows: DataFrame) -> DataFrame:
    """New rank, group size and first place from (rank, rank of what follows).

    A group keeps its place in the array; its members are ordered by their second rank. Small
    groups are ordered by one window each. In large ones, equal pairs are counted first, the second
    ranks are cut into ranges, and running sums go over ranges, then within a range.
    """
    own = W.partitionBy("r", "r2")
    small = rows.where(F.col("n") <= RANKED_TOGETHER)
    small = small.withColumn("rank", F.rank().over(W.partitionBy("r").orderBy("r2")))
    small = small.withColumn("n", F.count("*").over(own)).withColumn("first", F.min("place").over(own))
    small = small.withColumn("r", F.col("r") + F.col("rank") - 1)
    big = rows.where(F.col("n") > RANKED_TOGETHER)
    cells = big.groupBy("r", "r2").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    cells = cells.withColumn("range", F.floor(F.col("r2") / RANKED_TOGETHER))
    ranges = cells.groupBy("r", "range").agg(F.sum("n").alias("k"))
    before = W.partitionBy("r").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select("r", "range", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("at"))
    within = W.partitionBy("r", "range").orderBy("r2").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
    cells = cells.join(ranges, ["r", "range"]).select(
        "r", "r2", F.col("n").alias("n2"), "first", (F.col("r") + F.col("at") + F.col("inside")).alias("rank"))
    big = join_counted(big.drop("first"), cells, ["r", "r2"], "n2").withColumn("r", F.col("rank")).withColumn("n", F.col("n2"))
    columns = ["key", "segment", "pos", "line_no", "place", "rest", "r", "n", "first", "copied"]
    return small.select(*columns).unionByName(big.select(*columns))


def repeated_lines(rows: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """Lines of ``rows`` (key, text) in later copies of repeated runs: key, pos, line_no, last_line_no.

    The corpus is a sequence of line identifiers, cut wherever a text ends or a line occurs once. Its
    suffix array is built by prefix doubling: ranks after 1, 2, 4, ... lines follow from the pairs
    of ranks that meet at half the distance, until no tie is left that more lines could break. Equal ranks at
    a depth are the longest-common-prefix intervals of that depth; in each, all suffixes but the first in
    the corpus start a later copy of that many lines. Blank lines are no part of the sequence. With
    ``min_words``, a line of at least so many words is a repeated run by itself, which depth 1 tells.
    """
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be a power of two")
    numbered = F.transform(F.split(text_or_empty("text"), "\n", -1), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    filled = F.filter(numbered, lambda line: line["x"].rlike(WORD))
    place = (F.col("key").cast("decimal(19,0)") * F.lit(1 << 31).cast("decimal(10,0)")).cast("decimal(38,0)") + F.col("pos").cast("decimal(10,0)")
    lines = rows.select("key", F.posexplode(filled)).select(
        "key", "pos", F.col("col.i").alias("line_no"), place.cast("decimal(38,0)").alias("place"),
        # 128 bits: two hashes with different seeds
        F.xxhash64("col.x").alias("h1"), F.xxhash64(F.lit("second"), F.col("col.x")).alias("h2"),
        *([(F.regexp_count("col.x", F.lit(WORD)) >= min_words).alias("passage")] if min_words else []))
    table = join_counted(lines, keep(_first_ranks(lines)), ["h1", "h2"], "n")
    segment = F.col("pos") - F.row_number().over(W.partitionBy("key").orderBy("pos"))
    along = W.partitionBy("key", "segment").orderBy("pos")
    table = table.withColumn("segment", segment).withColumn("rest", F.count("*").over(W.partitionBy("key", "segment")))
    table = table.withColumn("rest", F.col("rest") - F.row_number().over(along) + 1)
    copied = _copied(1, min_lines, F.lit(0))
    if min_words:
        copied = F.when(F.col("passage"), _copied(1, 1, F.lit(0))).otherwise(copied)
    state = keep(table.select("key", "segment", "pos", "line_no", "place", "rest", "r", "n", "first", copied.alias("copied")))
    settled: list[DataFrame] = []
    depth = 1
    for _ in range(_MOST_ROUNDS):
        # a segment goes on while one of its suffixes is tied with another beyond the present depth
        is_open = (F.col("n") > 1) & (F.col("rest") > depth)
        following = F.when(F.col("rest") > depth, F.lead("r", depth).over(along))
        marked = state.withColumn("open", is_open).withColumn("r2", F.coalesce(following, F.lit(0)))
        marked = marked.withColumn("live", F.max(F.col("open").cast("int")).over(W.partitionBy("key", "segment")) == 1)
        marked = keep(marked)
        forget(state)
        settled.append(marked.where("not live").select("key", "segment", "pos", "line_no", "copied"))
        live = marked.where("live")
        columns = ["key", "segment", "pos", "line_no", "place", "rest", "r", "n", "first", "copied"]
        if not live.where("open").limit(1).count():
            settled.append(live.select("key", "segment", "pos", "line_no", "copied"))
            break
        # all members of a group are refined together; a group without open members stays as it is
        depth *= 2
        refined = _refine(live.where("n > 1")).withColumn("copied", _copied(depth, min_lines, F.col("copied")))
        state = keep(refined.select(*columns).unionByName(live.where("n = 1").select(*columns)))
    else:
        raise RuntimeError("prefix doubling did not settle")
    every = settled[0]
    for part in settled[1:]:
        every = every.unionByName(part)
    reach = F.max(F.col("pos") + F.col("copied")).over(along.rowsBetween(W.unboundedPreceding, 0))
    return every.withColumn("reach", reach).where("reach > pos").select("key", "segment", "pos", "line_no")


def _copied(depth: int, min_lines: int, before):
    """Lines that a suffix shares with an earlier one, as far as this depth tells."""
    shared = F.least(F.lit(depth), F.col("rest"))
    again = (F.col("n") > 1) & (F.col("place") > F.col("first")) & (shared >= min_lines)
    return F.when(again, F.greatest(before, shared)).otherwise(before)


def _removed_runs(lines: DataFrame) -> DataFrame:
    """One row per text: its removed runs in order, as (from line, to line, lines)."""
    island = F.col("pos") - F.row_number().over(W.partitionBy("key").orderBy("pos"))
    runs = lines.withColumn("island", island).groupBy("key", "island").agg(
        F.min("line_no").alias("a"), F.max("line_no").alias("b"), F.count("*").alias("n"))
    return runs.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("a", "b", "n"))).alias("runs"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, out: str = "line_dedup",
    min_words: int | None = None,
) -> DataFrame:
    """The rows of ``docs`` with a column ``out``: lines, removed and runs (numbers), kept (the text that stays).

    A run of at least ``min_lines`` consecutive lines that occurs more than once stays where it occurs
    first, by identifier and place; later copies are deleted, also where copies overlap, and with them
    the blank lines inside. Lines are compared exactly; blank lines are skipped. With ``min_words``, a
    single line of at least so many words is such a run too, whatever stands around it.

    Null text counts as empty and stays null; one very long text is as good as many; rows that
    repeat an identifier are texts of their own, in the order of the table; an empty table gives an
    empty result; other columns pass through, one named like ``out`` is replaced.
    """
    prepare(docs.sparkSession)
    rows, _ = with_row_key(docs, id_col, "__row")
    found = repeated_lines(rows.select(F.col("__row").alias("key"), F.col(text_col).alias("text")), min_lines, min_words)
    runs = _removed_runs(found).select(F.col("key").alias("__key"), F.col("runs").alias("__runs"))
    joined = rows.join(runs, F.col("__row") == F.col("__key"), "left")
    joined = joined.withColumn("__all", F.split(text_or_empty(text_col), "\n", -1))

    def piece(i):
        """What stands before removed run i, or after the last."""
        start = F.when(i == 0, F.lit(0)).otherwise(F.col("__runs")[i - 1]["b"] + 1)
        end = F.when(i == F.size("__runs"), F.size("__all")).otherwise(F.col("__runs")[i]["a"])
        return F.slice("__all", (start + 1).cast("int"), (end - start).cast("int"))

    rest = F.flatten(F.transform(F.sequence(F.lit(0), F.size("__runs")), piece))
    cut = F.col("__runs").isNotNull()
    removed = F.aggregate("__runs", F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"] + 1)
    result = F.struct(
        F.size("__all").cast("long").alias("lines"),
        F.when(cut, removed).otherwise(F.lit(0).cast("long")).alias("removed"),
        F.when(cut, F.size("__runs")).otherwise(F.lit(0)).cast("long").alias("runs"),
        F.when(cut, F.array_join(rest, "\n")).otherwise(F.col(text_col)).alias("kept"),
    )
    return joined.withColumn(out, result).select(*[c for c in docs.columns if c != out], out)


ORACLE = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), filled AS (
  SELECT doc_id, x, i, row_number() OVER w AS p, lead(x) OVER w AS y FROM line WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), starts AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY md5(x), md5(y) ORDER BY doc_id, p) AS k FROM filled WHERE y IS NOT NULL) WHERE k > 1
), gone AS (
  SELECT doc_id, p FROM starts UNION SELECT doc_id, p + 1 FROM starts
), marked AS (
  SELECT l.doc_id, l.x, l.i, f.p, CASE WHEN f.p IS NULL THEN NULL ELSE g.p IS NOT NULL END AS out
  FROM line l LEFT JOIN filled f USING (doc_id, i) LEFT JOIN gone g ON g.doc_id = f.doc_id AND g.p = f.p
), around AS (
  SELECT *, last_value(out IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before,
            first_value(out IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
  FROM marked
), final AS (SELECT *, coalesce(before, false) AND coalesce(after, false) AS removed FROM around),
runs AS (SELECT doc_id, count(*) AS n FROM (
  SELECT doc_id, removed, lag(removed, 1, false) OVER (PARTITION BY doc_id ORDER BY i) AS was FROM final) WHERE removed AND NOT was GROUP BY 1)
SELECT f.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE removed) AS n_removed, coalesce(any_value(r.n), 0) AS n_runs,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (WHERE NOT removed), '')) AS kept_sha256
FROM final f LEFT JOIN runs r USING (doc_id) GROUP BY f.doc_id
"""

# The same with passages of one line: later copies of a line of at least PASSAGE_WORDS words go, whatever their neighbours.
PASSAGES_ORACLE = ORACLE.replace(
    "SELECT doc_id, p + 1 FROM starts\n",
    rf"""SELECT doc_id, p + 1 FROM starts UNION SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY md5(x) ORDER BY doc_id, p) AS k FROM filled
    WHERE len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) >= {PASSAGE_WORDS}) WHERE k > 1
""")
