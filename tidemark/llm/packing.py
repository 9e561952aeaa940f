"""Best-fit packing of token sequences, certified by dual-feasible-function lower bounds."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, islice
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import forget, keep, prepare

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
# Pieces that one task packs together.
PACKED_TOGETHER = 40_000
# Words whose ids a worker remembers; the oldest go first.
REMEMBERED_WORDS = 400_000

# A stop or comma that ends a word is no part of a longer run of punctuation.
_STOP = re.compile(rb"[A-Za-z0-9][.,]$")

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
BIN_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long, fill long, gap long"


def _tokenizer_path(name: str) -> str:
    import os

    import public_tokenizers

    return name if os.path.sep in name else public_tokenizers.path(name)


class WordIds:
    """Token ids of texts. Words are tokenized once and remembered; ASCII white space only separates them.

    A tokenizer qualifies if ids depend neither on the neighbouring words nor on the case of ASCII letters,
    and if a full stop or comma at a word's end is a token of its own, which holds for vocabularies
    of lower-case words with word ends; the tests compare with whole texts.
    """

    def __init__(self, path: str, most: int = REMEMBERED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}  # ids as little-endian bytes
        self.most = most
        self.bar = self.tokenizer.encode("|", add_special_tokens=False).ids

    def _learn(self, words: set[bytes]) -> None:
        """Words without a final stop or comma are tokenized many at a time, with a bar between two."""
        known = self.known
        ends = {w: w[:-1] for w in words if _STOP.search(w)}
        cores = words.difference(ends).union(ends.values(), (b".", b",")).difference(known)
        plain = [w for w in cores if b"|" not in w and len(self.bar) == 1]
        for word in cores.difference(plain):
            known[word] = self._ids(word.decode("utf-8", "replace"))
        for at in range(0, len(plain), 20_000):
            lots = [plain[i : i + 100] for i in range(at, min(at + 20_000, len(plain)), 100)]
            joined = [b" | ".join(lot).decode("utf-8", "replace") for lot in lots]
            for lot, made in zip(lots, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
                ids = np.array(made.ids, dtype="<u4")
                cuts = (np.append(np.flatnonzero(ids == self.bar[0]), len(ids)) * 4).tolist()
                raw, start = ids.tobytes(), 0
                for word, cut in zip(lot, cuts, strict=True):
                    known[word] = raw[start:cut]
                    start = cut + 4
        for word, core in ends.items():
            known[word] = known[core] + known[word[-1:]]

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        split: list[list[bytes]] = []
        for text in texts:
            raw = text.encode("utf-8", "surrogatepass")
            # names of special tokens are matched as they are written
            split.append((raw if b"<|" in raw else raw.lower()).split())
        known = self.known
        found = [list(map(known.get, words)) for words in split]
        gaps = [[i for i, ids in enumerate(got) if ids is None] for got in found]
        new = {words[i] for words, places in zip(split, gaps, strict=True) for i in places}
        if new:
            self._learn(new)
        for words, got, places in zip(split, found, gaps, strict=True):
            for i in places:
                got[i] = known[words[i]]
        out = [np.frombuffer(b"".join(got), "<u4") for got in found]
        if len(known) > self.most:  # the frequent words come back with the next batch
            self.known = dict(islice(known.items(), len(known) - self.most // 2, None))
        return out


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    """One model per worker process: what a task has learned serves the next ones."""
    import os

    # an executor runs one worker per core; threads of the tokenizer's own would only take memory
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path)


def _pieces(tokenizer: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # what earlier tasks of this worker left
        model = _word_ids(_tokenizer_path(tokenizer))
        for batch in batches:
            texts = batch.column(1)
            step = 100
            for at in range(0, batch.num_rows, step):
                ids = batch.column(0).slice(at, step).to_pylist()
                out: list[tuple] = []
                kept: list[np.ndarray] = []
                for doc, tokens in zip(ids, model.batch([x or "" for x in texts.slice(at, step).to_pylist()]), strict=True):
                    tokens = np.append(tokens, np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(tokens), capacity)):
                        part = tokens[start : start + capacity]
                        out.append((doc, piece, start, len(part), crc32(part.tobytes())))
                        kept.append(part)
                columns = list(zip(*out, strict=True))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int32) for x in kept], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Each document's ids and its end id, cut where it is longer than ``capacity``."""
    prepare(docs.sparkSession)
    schema = PIECE_SCHEMA + (", ids array<int>" if with_ids else "")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_pieces(tokenizer, capacity, end_id, with_ids), schema)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that no packing can do without, by two families of dual feasible functions.

    Threshold functions round lengths above capacity - t up to a whole bin and drop those below t.
    Rounding functions count how many of k + 1 equal shares a length exceeds.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    sizes = np.arange(capacity + 1)
    best = -(-int((counts * sizes).sum()) // capacity)
    more = np.cumsum(counts[::-1])[::-1]  # pieces at least this long
    mass = np.concatenate([[0], np.cumsum(counts * sizes)])  # tokens in pieces shorter than this
    for t in range(1, capacity // 2 + 1):
        whole = int(more[capacity - t + 1]) if t else 0
        middle = int(mass[capacity - t + 1] - mass[t])
        best = max(best, whole + -(-middle // capacity))
    for k in range(1, 64):
        exact = sizes * (k + 1) % capacity == 0
        share = np.where(exact, sizes * k, sizes * (k + 1) // capacity * capacity)  # times k * capacity
        best = max(best, -(-int((counts * share).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing: the bin of each piece. The rooms of open bins are the bits of one integer."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by room
    rooms = 0
    made = 0
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = waiting[room].pop()
            if not waiting[room]:
                rooms &= ~(1 << room)
        else:
            room, at, made = capacity, made, made + 1
        bins[i] = at
        room -= size
        if room:
            waiting[room].append(at)
            rooms |= 1 << room
    return bins


def _pack(capacity: int, round_no: int):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base = (round_no << 54) + (TaskContext.get().partitionId() << 32)
        held = [x[columns] for x in frames if len(x)]
        if not held:
            return
        rows = pd.concat(held).sort_values(columns, kind="stable", ignore_index=True)
        lengths = rows["length"].to_numpy()
        bins = best_fit(lengths, capacity)
        fills = np.bincount(bins, weights=lengths).astype(np.int64)
        gap = len(fills) - lower_bound(lengths, capacity)
        order = np.argsort(bins, kind="stable")
        sorted_bins = bins[order]
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_bins[1:] != sorted_bins[:-1]]))
        rows = rows.iloc[order]
        rows["sequence_id"] = base + sorted_bins
        rows["offset"] = before - np.repeat(before[first], np.diff(np.append(first, len(before))))
        rows["fill"] = fills[sorted_bins]
        rows["gap"] = gap
        yield rows

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, together: int = PACKED_TOGETHER) -> DataFrame:
    """Sequences for all pieces: the pieces' columns, sequence_id and offset.

    Pieces are dealt evenly over partitions, each packed by best-fit decreasing and certified where its
    bins meet its lower bound. Partitions with a gap give up all bins with room, certified ones the
    bin with the most room, and these pieces meet in new, fewer partitions. A round counts only if
    it needs fewer bins than its pieces had; exchanges go on as long as rounds count.
    """
    spark = pieces.sparkSession

    def packed(rows: DataFrame, n: int, round_no: int) -> DataFrame:
        dealt = rows.repartition(max(1, -(-n // together)))
        return keep(dealt.mapInPandas(_pack(capacity, round_no), BIN_SCHEMA))

    wanted = pieces.select("doc_id", "piece", "start", "length", "ids_crc32")
    current = packed(wanted, wanted.count(), 0)
    done: list[DataFrame] = []
    for round_no in count(1):
        home = F.shiftright("sequence_id", 32)
        emptiest = current.groupBy(home.alias("home")).agg(F.min("fill").alias("least"))
        # at most one row per partition
        marked = current.withColumn("home", home).join(F.broadcast(emptiest), "home")
        free = (F.col("fill") < capacity) & ((F.col("gap") > 0) | (F.col("fill") == F.col("least")))
        marked = marked.withColumn("moves", free)
        moving = marked.where("moves").drop("home", "least", "moves")
        figures = moving.agg(F.count("*").alias("n"), F.count_distinct("sequence_id").alias("bins")).first()
        if not figures["n"]:
            break
        again = packed(moving, figures["n"], round_no)
        bins = again.select("sequence_id").distinct().count()
        if bins >= figures["bins"]:
            forget(again)
            break
        done.append(marked.where("not moves").drop("home", "least", "moves"))
        current = again
    out = current
    for part in done:
        out = out.unionByName(part)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty text is the end id alone; a document longer than ``capacity`` is cut into full
    pieces and a rest; repeated rows are packed each for itself; an empty table gives an empty
    result; null identifiers stay null; other columns are not read. Full pieces are sequences of
    their own.
    """
    pieces = keep(token_pieces(docs, id_col, text_col, tokenizer, capacity, end_id))
    return pack_pieces(pieces, capacity)
