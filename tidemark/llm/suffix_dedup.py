"""Repeated byte strings by suffix arrays, built by two-stage sorting."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_counted, keep, prepare, shuffle_partitions, with_row_key

LENGTH = 200
# An anchor is the smallest-hashed gram of this many bytes in a window of LENGTH bytes. A power of 2.
GRAM = 32
# Fragments of one core that are sorted in one suffix array; beyond, windows are counted by digest.
SORTED_TOGETHER = 6000
# Bytes that a suffix array takes in at once, and that the anchor search looks at in one step (arrays
# of eight times the size should fit a core's cache).
SORTED_BYTES = 1 << 18
SCANNED_BYTES = 1 << 16

_ODD = np.uint64(0x9E3779B97F4A7C15)
_POSITION_BITS = np.uint64(24)


def _gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the gram at each position, from hashes of halves."""
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    h = np.ascontiguousarray(words).view(np.uint64).ravel()
    width = 8
    with np.errstate(over="ignore"):
        h = h * _ODD
        h ^= h >> np.uint64(29)
        while width < gram:
            left, right = h[:-width], h[width:]
            h = (left * np.uint64(0xBF58476D1CE4E5B9)) + right
            h ^= h >> np.uint64(32)
            h *= _ODD
            h ^= h >> np.uint64(29)
            width *= 2
    return h


def _window_minima(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window, where its anchor is, and whether that differs from the window before."""
    h = _gram_hashes(data, gram)
    key = (h >> _POSITION_BITS << _POSITION_BITS) | np.arange(len(h), dtype=np.uint64)
    width, window = 1, length - gram + 1
    while width * 2 <= window:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    rest = window - width
    if rest:
        key = np.minimum(key[:-rest], key[rest:])
    positions = (key & np.uint64((1 << 24) - 1)).astype(np.int64)
    fresh = np.ones(len(positions), bool)
    fresh[1:] = positions[1:] != positions[:-1]
    return positions, fresh


def _grams_at(data: np.ndarray, positions: np.ndarray, gram: int) -> np.ndarray:
    if not len(positions):
        return np.empty(0, np.uint64)
    grams = np.lib.stride_tricks.sliding_window_view(data, gram)[positions]
    return _row_hashes(np.ascontiguousarray(grams).view(np.uint64).reshape(len(positions), gram // 8))


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of one text: the leftmost smallest gram of each window.

    Equal windows choose the same gram at the same place, wherever they stand.
    """
    found: list[np.ndarray] = []
    for at in range(0, max(0, len(data) - length + 1), SCANNED_BYTES):
        positions, fresh = _window_minima(data[at : at + SCANNED_BYTES + length - 1], length, gram)
        found.append(at + positions[fresh])
    positions = np.unique(np.concatenate([np.empty(0, np.int64), *found]))
    return positions, _grams_at(data, positions, gram)


def anchors_of_many(raws: list[bytes], length: int = LENGTH, gram: int = GRAM) -> list[tuple[np.ndarray, np.ndarray]]:
    """``anchors`` of each text; short texts are searched side by side, a window never spans two."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(raws):
        end, size = at, 0
        while end < len(raws) and (end == at or size + len(raws[end]) <= SCANNED_BYTES):
            size += len(raws[end])
            end += 1
        if end - at == 1:
            out.append(anchors(np.frombuffer(raws[at], np.uint8), length, gram))
        else:
            data = np.frombuffer(b"".join(raws[at:end]), np.uint8)
            sizes = np.fromiter(map(len, raws[at:end]), np.int64, end - at)
            begins = np.cumsum(sizes) - sizes
            positions, fresh = _window_minima(data, length, gram)
            # windows within one text only; the first of each text counts as new
            fresh[begins[begins < len(fresh)]] = True
            last = np.repeat(begins + sizes - length, sizes)[: len(fresh)]
            chosen = np.unique(positions[fresh & (np.arange(len(fresh)) <= last)])
            grams = _grams_at(data, chosen, gram)
            cuts = np.searchsorted(chosen, np.append(begins, len(data)))
            out += [(chosen[a:b] - begin, grams[a:b]) for a, b, begin in zip(cuts, cuts[1:], begins, strict=False)]
        at = end
    return out


def _row_hashes(words: np.ndarray) -> np.ndarray:
    """A hash of each row of 64-bit words; independent of the one that chooses the anchors."""
    h = np.full(len(words), 0x243F6A8885A308D3, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(words.shape[1]):
            h = (h ^ words[:, i]) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(33)
            h *= np.uint64(0xC4CEB9FE1A85EC53)
            h ^= h >> np.uint64(29)
    return h


def _raw_texts(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, bytes]]:
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
        if len(raw) >= length:
            yield key, raw


def _gram_rows(length: int, gram: int):
    """The gram of every anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [g for _, g in anchors_of_many([raw for _, raw in _raw_texts(batch, length)], length, gram)]
            if grams:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams).view(np.int64))], names=["gram"])

    return run


def _fragment_rows(length: int, gram: int):
    """The two fragments of every anchor: (gram, core, whole, key, begin, size), twice side by side.

    Half of the windows around an anchor start so far left of it that they hold its left core, the
    others hold its right core; a fragment is what the windows with one core can reach.
    """
    import xxhash

    half, reach = (length - gram) // 2, length - gram
    sides = ((reach, half, 0), (half, 0, 1))  # starts of windows, from and to, left of the anchor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            rows: list[tuple] = []
            grams_of: list[np.ndarray] = []
            texts = list(_raw_texts(batch, length))
            made = anchors_of_many([raw for _, raw in texts], length, gram)
            for (key, raw), (at, grams) in zip(texts, made, strict=True):
                grams_of.append(np.repeat(grams.view(np.int64), 2))
                for p in at.tolist():
                    for first, last, side in sides:
                        begin, end = max(0, p - first), min(len(raw), p - last + length)
                        core = raw[max(0, p - last) : p - first + length]
                        # the seed tells sides and clipped starts apart
                        rows.append((digest(core, side), digest(raw[begin:end], p - begin), key, begin, end - begin))
            if rows:
                core, whole, key, begin, size = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(grams_of)), pa.array(np.array(core, np.uint64).view(np.int64)),
                    pa.array(np.array(whole, np.uint64).view(np.int64)), pa.array(key, pa.int64()),
                    pa.array(begin, pa.int32()), pa.array(size, pa.int32()),
                ], names=["gram", "core", "whole", "key", "begin", "size"])

    return run


# ---------------------------------------------------------------- suffix array by two-stage sorting


def suffix_array(data: np.ndarray, depth: int | None = None, wanted: np.ndarray | None = None) -> np.ndarray:
    """Suffix array of small integers, at most 2 ** 22 of them, by two-stage sorting.

    Suffixes that are smaller than their successors (type S) are sorted directly, by doubling of ranks
    among themselves; the others are induced: a scan through the buckets from the smallest suffix on
    puts the predecessor of each suffix found, if it is of the other type, at the front of its bucket.
    The scan takes whole runs of equal first symbols at a time. With ``depth``, suffixes that agree
    in so many symbols may stand in any order. With ``wanted`` (marks), only marked suffixes and those
    that induce them are sorted: from a marked one up to the next smaller suffix.
    """
    n = len(data)
    if n < 2:
        return np.arange(n)
    # symbols as small numbers, in their order
    present = np.bincount(data) > 0
    data = (np.cumsum(present) - 1)[data]
    kinds = int(present.sum())
    # type S: smaller than its successor; the last suffix is larger than the empty one
    step = np.sign(np.diff(data))
    change = np.where(step != 0, np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(change[::-1])[::-1]  # the next place where the symbol changes
    smaller = np.append(np.append(step, -1)[following] > 0, False)
    if wanted is None:
        needed = np.ones(n, bool)
    else:
        # a position is needed if a wanted one stands at or before it, after the last smaller suffix before it
        run = np.concatenate([[0], np.cumsum(smaller)[:-1]])
        last_wanted = np.maximum.accumulate(np.where(wanted, np.arange(n), -1))
        needed = (last_wanted >= 0) & (run == run[last_wanted])
    small = _sort_directly(data, np.flatnonzero(smaller & needed), n if depth is None else depth, kinds)
    # buckets: larger suffixes stand before smaller ones of the same symbol
    bucket = data
    counts = np.bincount(bucket[needed], minlength=kinds)
    begin = np.concatenate([[0], np.cumsum(counts)])
    out = np.full(begin[-1], -1, np.int64)
    small_bucket = bucket[small]
    small_counts = np.bincount(small_bucket, minlength=kinds)
    at = begin[1:] - small_counts
    out[np.repeat(at, small_counts) + np.arange(len(small)) - np.repeat(np.cumsum(small_counts) - small_counts, small_counts)] = small
    front = begin[:-1].copy()

    def put(found: np.ndarray) -> None:
        """Larger suffixes, in the order in which the scan met their successors, into their buckets."""
        b = bucket[found]
        order = np.argsort(b, kind="stable")
        sorted_b = b[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_b[1:] != sorted_b[:-1]]))
        size = np.diff(np.append(first, len(sorted_b)))
        out[np.repeat(front[sorted_b[first]], size) + np.arange(len(sorted_b)) - np.repeat(first, size)] = found[order]
        front[sorted_b[first]] += size

    def met(part: np.ndarray) -> np.ndarray:
        before = part[part > 0] - 1
        return before[~smaller[before] & needed[before]]

    if needed[n - 1]:
        put(np.array([n - 1]))  # the successor of the last suffix is the empty one
    for c in range(kinds):
        done = begin[c]
        while done < front[c]:  # larger suffixes of this bucket may induce more of it
            part = out[done : front[c]]
            done = front[c]
            found = met(part)
            if len(found):
                put(found)
        found = met(out[done : begin[c + 1]])
        if len(found):
            put(found)
    return out


def _sort_directly(data: np.ndarray, chosen: np.ndarray, enough: int, kinds: int) -> np.ndarray:
    """The chosen suffixes in order, by comparing a word of symbols at a time until all differ."""
    if len(chosen) < 2:
        return chosen
    n = len(data)
    bits = kinds.bit_length()
    width = max(1, 40 // bits)
    padded = np.concatenate([data + 1, np.zeros(width, np.int64)])
    word = np.zeros(n + 1, np.int64)
    for k in range(width):
        word[:n] = word[:n] << bits | padded[k : k + n]
    order = chosen[np.argsort(word[chosen])]
    first = word[order]
    fresh = np.concatenate([[True], first[1:] != first[:-1]])
    depth = width
    while depth < enough:
        # only members of groups that are still tied go on
        places = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
        if not len(places):
            break
        members = order[places]
        own = np.cumsum(fresh[places])  # fits into the bits that a word leaves free
        key = own << (bits * width) | word[np.minimum(members + depth, n)]
        again = np.argsort(key)
        order[places] = members[again]
        key = key[again]
        fresh[places] = np.concatenate([[True], key[1:] != key[:-1]])
        depth += width
    return order


def shares_prefix(raw: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """Whether the common prefix of each start and the one before reaches ``most`` bytes (a multiple of 8)."""
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, 8)).view(np.uint64).ravel()
    ok = np.zeros(len(starts), bool)
    left = np.arange(1, len(starts))
    for k in range(0, most, 8):  # few pairs are left after the first bytes
        left = left[words[starts[left] + k] == words[starts[left - 1] + k]]
    ok[left] = True
    return ok


def repeated_windows(fragments: list[bytes], keys: np.ndarray, begins: np.ndarray, twice: np.ndarray, length: int) -> list[np.ndarray]:
    """For each fragment, the starts in it of the windows that also start elsewhere.

    ``keys`` and ``begins`` say where a fragment stands; ``twice`` that it occurs more than once.
    """
    sizes = np.fromiter(map(len, fragments), np.int64, len(fragments))
    raw = np.frombuffer(b"\0".join(fragments) + b"\0" * 8, np.uint8)
    at = np.cumsum(sizes + 1) - sizes - 1
    data = raw[: len(raw) - 8].astype(np.int32) + 1
    data[at[1:] - 1] = 0  # what separates two fragments is smaller than any byte
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)[: len(data)]
    inside = np.arange(len(data)) - at[owner]
    valid = inside + length <= sizes[owner]
    suffixes = suffix_array(data, length, valid)
    suffixes = suffixes[valid[suffixes]]
    same = shares_prefix(raw, suffixes, length)
    if not same.any():
        return [np.empty(0, np.int64)] * len(fragments)
    first = np.flatnonzero(~same)
    whose = owner[suffixes]
    _, number = np.unique(keys, return_inverse=True)
    place = (number[whose] << 40) + begins[whose] + inside[suffixes]
    several = (np.minimum.reduceat(place, first) != np.maximum.reduceat(place, first)) | np.logical_or.reduceat(twice[whose], first)
    marked = suffixes[np.repeat(several, np.diff(np.append(first, len(suffixes))))]
    marked = np.sort(marked)
    cuts = np.searchsorted(marked, np.append(at, len(data)))
    return [marked[cuts[i] : cuts[i + 1]] - at[i] for i in range(len(sizes))]


def _spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs that windows at sorted starts cover."""
    if not len(starts):
        return starts, starts
    fresh = np.concatenate([[True], starts[1:] > starts[:-1] + length])
    return starts[fresh], starts[np.append(fresh[1:], True)] + length


# ---------------------------------------------------------------- the Spark side


def _fragments(together: int):
    """The bytes of each wanted fragment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["core", "key", "begin", "twice", "crowded", "bytes"]
        for batch in batches:
            for key, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                wanted = wanted.as_py()
                yield pa.RecordBatch.from_arrays([
                    pa.array([w["core"] for w in wanted], pa.int64()), pa.array([key] * len(wanted), pa.int64()),
                    pa.array([w["begin"] for w in wanted], pa.int64()), pa.array([w["n"] > 1 for w in wanted]),
                    pa.array([w["others"] > together for w in wanted]),
                    pa.array([raw[w["begin"] : w["begin"] + w["size"]] for w in wanted], pa.binary()),
                ], names=names)

    return run


def _sorted_spans(length: int):
    """Spans to remove, from suffix arrays over the fragments of whole cores."""

    def solve(rows: list[tuple]) -> pa.RecordBatch | None:
        keys = np.array([r[1] for r in rows], np.int64)
        begins = np.array([r[2] for r in rows], np.int64)
        twice = np.array([r[3] for r in rows], bool)
        found = repeated_windows([r[4] for r in rows], keys, begins, twice, length)
        out_key, out_from, out_to = [], [], []
        for i, starts in enumerate(found):
            if len(starts) and not twice[i]:  # a fragment that occurs twice is removed in full anyway
                a, b = _spans(starts, length)
                out_key.append(np.full(len(a), keys[i]))
                out_from.append(a + begins[i])
                out_to.append(b + begins[i])
        if not out_key:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x), pa.int64()) for x in (out_key, out_from, out_to)], names=["key", "from", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        last = None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if row[0] != last and size >= SORTED_BYTES:
                    if (made := solve(held)) is not None:
                        yield made
                    held, size = [], 0
                last = row[0]
                held.append(row)
                size += len(row[4]) + 1
        if held and (made := solve(held)) is not None:
            yield made

    return run


def _window_digests(length: int):
    """Digest, place and multiplicity of every window of the fragments of crowded cores."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for key, begin, twice, raw in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                n = len(raw) - length + 1
                digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[i : i + length]) for i in range(n)), np.int64)
                for column, x in zip(out, (digests[::2], digests[1::2], np.full(n, key), begin + np.arange(n), np.full(n, twice)), strict=True):
                    column.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in out], names=["d1", "d2", "key", "at", "twice"])

    return run


def _cut(with_text: bool):
    """Merge the spans of each text and take them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                merged: list[list[int]] = []
                for span in sorted((s["from"], s["to"]) for s in spans.as_py() or ()):
                    if merged and span[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], span[1])
                    else:
                        merged.append(list(span))
                kept, at = [], 0
                for a, b in merged:
                    kept.append(raw[at:a])
                    at = b
                kept.append(raw[at:])
                rest = b"".join(kept)
                rows.append((key, len(raw), len(raw) - len(rest), len(merged), hashlib.sha256(rest).hexdigest(), rest))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            arrays = [pa.array(columns[i], pa.int64()) for i in range(4)] + [pa.array(columns[4], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                arrays.append(pa.array(columns[5], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def suffix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    with_text: bool = False,
    together: int = SORTED_TOGETHER,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes).

    Every byte in a ``length``-byte string that also starts elsewhere is removed, the first copy too.

    1. Each window has one anchor. Equal windows have equal anchors, so only anchors whose gram occurs
       twice matter. The windows around an anchor hold either its left or its right core, some 116
       bytes, and lie in the fragment of that core, some 284 bytes.
    2. Fragments that are equal as a whole need no sorting: where one occurs twice, it is removed.
       One copy of each different fragment goes to the task of its core.
    3. There, a suffix array over the fragments, by two-stage sorting, and the common prefixes of
       neighbours show the windows that repeat. A core with more than ``together`` different fragments
       is spread out instead: its windows are counted by 128-bit digest.

    Null text counts as empty; texts shorter than ``length`` lose nothing; repeated rows are copies of
    each other; null and repeated identifiers are allowed; an empty table gives an empty result;
    other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    n = shuffle_partitions(spark)
    rows, doc_of = with_row_key(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    rows = rows.select("key", "text")
    grams = rows.mapInArrow(_gram_rows(length, GRAM), "gram long")
    # a gram has two fragments where it has one anchor, so shares of anchors are shares of fragments
    shared = keep(grams.groupBy("gram").agg(F.count("*").alias("times")).where("times > 1"))
    found = rows.mapInArrow(_fragment_rows(length, GRAM), "gram long, core long, whole long, key long, begin int, size int")
    found = keep(join_counted(found.where(F.col("size") >= length), shared, ["gram"], "times").drop("gram", "times"))
    classes = found.groupBy("core", "whole").agg(
        F.count("*").alias("n"), F.first("key").alias("key"), F.first("begin").alias("begin"), F.first("size").alias("size"))
    classes = keep(classes)
    copied = found.join(classes.where("n > 1").select("core", "whole"), ["core", "whole"], "left_semi").select(
        "key", F.col("begin").cast("long").alias("from"), (F.col("begin") + F.col("size")).cast("long").alias("to"))
    various = classes.groupBy("core").agg(F.count("*").alias("others")).where("others > 1")
    wanted = classes.join(various, "core").groupBy("key").agg(F.collect_list(F.struct("core", "begin", "size", "n", "others")).alias("wanted"))
    # both joins with the texts ask for the same exchange
    texts = rows.where("key is not null").repartition(n, "key")
    fragments = texts.join(wanted, "key").select("key", "text", "wanted").mapInArrow(
        _fragments(together), "core long, key long, begin long, twice boolean, crowded boolean, bytes binary")
    fragments = keep(fragments)
    dealt = fragments.where("not crowded").select("core", "key", "begin", "twice", "bytes")
    dealt = dealt.repartition(n, "core").sortWithinPartitions("core")
    spans = "key long, from long, to long"
    sorted_spans = dealt.mapInArrow(_sorted_spans(length), spans)
    windows = fragments.where("crowded").select("key", "begin", "twice", "bytes").mapInArrow(
        _window_digests(length), "d1 long, d2 long, key long, at long, twice boolean").distinct()
    often = windows.groupBy("d1", "d2").agg(
        F.min("key").alias("k0"), F.max("key").alias("k1"), F.min("at").alias("a0"), F.max("at").alias("a1"),
        F.max(F.col("twice").cast("int")).alias("twice"))
    often = often.where("k0 <> k1 or a0 <> a1 or twice = 1").select("d1", "d2")
    counted = windows.where("not twice").join(often, ["d1", "d2"], "left_semi").select(
        "key", F.col("at").alias("from"), (F.col("at") + length).alias("to"))
    every = copied.unionByName(sorted_spans).unionByName(counted).distinct()
    per_doc = every.groupBy("key").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    schema = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    schema = schema.replace("key", "doc_id", 1)
    made = texts.join(per_doc, "key", "left").select("key", "text", "spans").mapInArrow(_cut(with_text), schema)
    return doc_of(made, "doc_id")
