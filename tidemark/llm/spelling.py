"""Spelling variants: words one edit apart, found by a bit-sliced position index over the vocabulary."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import forget, keep, prepare, shuffle_partitions

# What a word is, as the contract writes it.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS = 7
LEAST_COUNT = 2
VARIANT_RATIO = 10
DROP_EVERY = 31
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words in one index; a cell with more is split further, see ``_children``.
CELL = 1024
# Crowded cells are broadcast up to this many (16 bytes each).
CROWDED_BROADCAST = 100_000


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of all texts after the contract's deletions, with at least ``LEAST_COUNT`` uses."""
    runs = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{LEAST_LETTERS},}}"), F.lit(0)))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    low = docs.select(name.alias("id"), runs.alias("run")).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = low.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % DROP_EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _cell(shorter: Column, left: Column, right: Column, apart: Column) -> Column:
    """Names a cell: words with these first ``left`` and last ``right`` letters, for pairs whose shorter word has ``shorter``.

    A clash of hashes only puts more words into one index, which compares whole words.
    """
    head, tail = F.substring("word", F.lit(1), left), F.call_function("right", F.col("word"), right)
    return F.xxhash64(shorter, left, right, apart, head, tail)


def _children(rows: DataFrame) -> DataFrame:
    """Each row in the two cells below its own.

    A pair one edit apart that agrees outside its middle also agrees either on the first half of the
    middle or on what follows that half. The second cell leaves out pairs that agree on the first
    half (``apart``: that many first letters must differ), so every pair is met in exactly one cell.
    """
    half = F.floor((F.col("shorter") - F.col("left") - F.col("right")) / 2).cast("int")
    split = F.col("left") + half
    first = F.struct(split.alias("left"), F.col("right").alias("right"), F.col("apart").alias("apart"))
    rest = F.col("shorter") - split
    second = F.struct(F.col("left").alias("left"), rest.alias("right"), split.alias("apart"))
    below = rows.select("word", "n", "shorter", F.explode(F.array(first, second)).alias("c")).select("word", "n", "shorter", "c.*")
    return below.withColumn("cell", _cell(F.col("shorter"), F.col("left"), F.col("right"), F.col("apart")))


def _cells(words: DataFrame, size: int) -> DataFrame:
    """(cell, shorter, apart, word, n): cells of at most ``size`` words, or with a middle of one letter.

    A word stands for pairs in which it is the shorter one or as long, and for pairs in which it is the
    longer one. Crowded cells are found by counting and split again; with one letter left a cell holds
    at most a + a^2 words for an alphabet of a letters, so no cell grows without bound.
    """
    length = F.length("word")
    nothing = F.lit(0)
    shorter = F.explode(F.sequence(length - 1, length))
    open_rows = _children(words.select("word", "n", shorter.alias("shorter"), nothing.alias("left"), nothing.alias("right"), F.lit(-1).alias("apart")))
    done: DataFrame | None = None
    columns = ["cell", "shorter", "apart", "word", "n"]
    while True:
        open_rows = keep(open_rows)
        splits = F.col("shorter") - F.col("left") - F.col("right") > 1
        crowded = keep(open_rows.where(splits).groupBy("cell").agg(F.count("*").alias("k")).where(F.col("k") > size).select("cell"))
        number = crowded.count()
        if number and number <= CROWDED_BROADCAST:
            crowded = F.broadcast(crowded)
        calm = open_rows.join(crowded, "cell", "left_anti") if number else open_rows
        done = calm.select(*columns) if done is None else done.unionByName(calm.select(*columns))
        if not number:
            return done
        open_rows = _children(open_rows.join(crowded, "cell", "left_semi"))


class PositionIndex:
    """Bitsets over the words of a cell: per position and letter, which words have it there.

    Words are numbered by descending n, then code point, so the lowest bit of a set is its first choice.
    """

    def __init__(self, words: Sequence[str]):
        self.all = (1 << len(words)) - 1
        self.at: list[dict[str, int]] = []
        self.of_length: dict[int, int] = {}
        for number, word in enumerate(words):
            bit = 1 << number
            self.of_length[len(word)] = self.of_length.get(len(word), 0) | bit
            while len(self.at) < len(word):
                self.at.append({})
            for place, letter in zip(self.at, word):
                place[letter] = place.get(letter, 0) | bit

    def near(self, word: str, shorter: int, apart: int = -1) -> int:
        """The words one edit from ``word`` among pairs whose shorter word has ``shorter`` letters.

        One pass over the letters keeps four sets: equal so far; one letter replaced (or none); one letter
        more than ``word``, whose letters then stand one place later; one letter less, one place earlier.
        With ``apart`` >= 0 words that agree on so many first letters are left out.
        """
        at, reach = self.at, len(self.at)
        equal, replaced, longer, less = self.all, 0, self.all, 0
        agreeing = equal if apart == 0 else 0
        for j, letter in enumerate(word):
            here = at[j].get(letter, 0) if j < reach else 0
            after = at[j + 1].get(letter, 0) if j + 1 < reach else 0
            before = at[j - 1].get(letter, 0) if j else 0
            replaced = (replaced & here) | equal
            less = (less & before) | equal
            equal &= here
            longer = (longer & after) | equal
            if j + 1 == apart:
                agreeing = equal
            if not (replaced | less | longer):
                return 0
        if len(word) == shorter:
            found = (replaced & ~equal & self.of_length.get(shorter, 0)) | (longer & self.of_length.get(shorter + 1, 0))
        else:
            found = less & self.of_length.get(shorter, 0)
        return found & ~agreeing


def _neighbours(words: list[str], counts: list[int], shorter: int, apart: int):
    """(word, number of near words, n and name of the first of them) for the words of one cell that have any."""
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    index = PositionIndex([words[i] for i in order])
    for i in order:
        found = index.near(words[i], shorter, apart)
        if found:
            first = order[(found & -found).bit_length() - 1]
            yield words[i], found.bit_count(), counts[first], words[first]


LINKS = "word string, n_near long, best_n long, best string"


def _link_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by cell to the near words of each cell; a cell may run over several batches."""
    held: list[tuple] = []  # rows of the cell that the last batch ended in
    found: list[tuple] = []

    def close(rows: list[tuple]) -> None:
        _, shorter, apart, *_ = rows[0] if rows else (None, None, None)
        if len(rows) > 1 and any(len(r[3]) == shorter for r in rows):
            found.extend(_neighbours([r[3] for r in rows], [r[4] for r in rows], shorter, apart))

    def out() -> pa.RecordBatch:
        columns = list(zip(*found)) if found else [(), (), (), ()]
        found.clear()
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["word", "n_near", "best_n", "best"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cells = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])).tolist() + [len(cells)]
        columns = [c.to_pylist() for c in batch.columns]
        if held and held[0][0] != columns[0][0]:
            close(held)
            held = []
        for start, end in zip(starts, starts[1:]):
            last = end == len(cells)
            if end - start < 2 and not last and not held:
                continue
            held.extend(zip(*[c[start:end] for c in columns]))
            if not last:
                close(held)
                held = []
        if found:
            yield out()
    close(held)
    yield out()


def near_words(words: DataFrame, size: int = CELL) -> DataFrame:
    """(word, n_near, best_n, best) for the words of (word, n) that have a near word."""
    cells = _cells(words, size)
    dealt = cells.repartition(shuffle_partitions(words.sparkSession), "cell").sortWithinPartitions("cell")
    links = dealt.mapInArrow(_link_cells, LINKS)
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("best")))
    return links.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.minus")).alias("best_n"), "b.best")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each chain, by joining every word's step with its step's step.

    Counts grow tenfold along a chain, so it has at most 19 links, and rounds double what is followed.
    """
    current = keep(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = keep(current.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        forget(current)
        current = moved
        if not moved.where("moved").limit(1).count():
            return current.select("word", "root")
        current = moved.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = CELL) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are counted over all texts. Near words are found cell by cell: two words one edit apart agree on
    one half, so every pair shares a cell named by that half, and in each cell of at most ``size`` words a
    position index answers all its words. Of the near words the one of largest n (ties: smallest in
    code-point order) is the form if it is ``VARIANT_RATIO`` times as frequent; the root ends the chain of forms.

    Null and empty texts have no words; a null identifier counts as the text 'null'; repeated rows count
    separately; very long texts and words are read whole; an empty table gives an empty result; other
    columns are not read.
    """
    prepare(docs.sparkSession)
    words = keep(vocabulary(docs, id_col, text_col))
    links = near_words(words, size).withColumnRenamed("word", "w")
    often = F.col("best_n") >= F.col("n") * VARIANT_RATIO
    known = keep(words.join(links, words["word"] == links["w"], "left").select(
        "word", F.when(often, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, F.col("best_n")).alias("form_n")))
    roots = follow(known.where(F.col("form").isNotNull()).select("word", "form")).withColumnRenamed("word", "w")
    joined = known.join(roots, known["word"] == roots["w"], "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
