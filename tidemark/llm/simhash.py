"""SimHash near-duplicates by a segment-popcount embedding and a grid range-join."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, keep, prepare, shuffle_partitions

SHINGLE = 4
MAX_BITS = 4
SEED = 42
# The embedding counts the set bits of each of 32 two-bit segments. Six blocks of segments: a Manhattan
# distance of at most 4 leaves at least two blocks without any difference.
SEGMENT_BITS = 2
# Fingerprints of one grid cell that are compared in one piece; larger cells are cut into pieces.
CELL_PIECE = 4096
# Cells up to this size are compared by shifted rows of many cells at once.
SHIFTED = 48

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint_of(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one whole text; 0 where it has no word."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    last = ends[min(width, len(words)) - 1 :][:n]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)), np.uint64, n
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 8192):  # a very long text is counted in steps
        bits = np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter(
                (fingerprint_of(x.as_py(), width, seed) for x in batch.column(1)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    return run


_ODD = np.int64(0x5555555555555555)


def _embedded(fp: np.ndarray) -> np.ndarray:
    """The set-bit count of every segment, in unary: 0, 01 or 11. Differing bits of two are their Manhattan distance."""
    low, high = fp & _ODD, (fp >> 1) & _ODD
    return (low | high) | ((low & high) << 1)


def _near(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= most  # of a signed number, it would count the absolute value's bits


def _forest(fp: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected within one cell: each fingerprint is reached once."""
    left, grid = np.arange(len(fp)), _embedded(fp)
    a, b = [], []
    while len(left):
        front = [left[0]]
        left = left[1:]
        while front and len(left):
            node = front.pop()
            # the distance on the grid is a lower bound; what passes it is compared bit by bit
            close = np.flatnonzero(_near(grid[left], grid[node], most))
            hit = np.zeros(len(left), bool)
            hit[close] = _near(fp[left[close]], fp[node], most)
            if hit.any():
                found = left[hit]
                a.append(np.full(len(found), fp[node]))
                b.append(fp[found])
                front.extend(found.tolist())
                left = left[~hit]
    none = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _links(most: int):
    """Links in grid cells; the rows arrive sorted by cell, and a cell is held until it ends."""
    names = ["a", "b"]

    def solve(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        """``cell`` numbers the cells in their order."""
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        sizes = np.diff(np.append(starts, len(cell)))
        out_a, out_b = [], []
        small = np.repeat(sizes <= SHIFTED, sizes)
        c, f = cell[small], fp[small]
        grid = _embedded(f)
        for shift in range(1, min(SHIFTED, len(c))):
            same = c[shift:] == c[:-shift]
            if not same.any():
                break
            close = np.flatnonzero(same & _near(grid[shift:], grid[:-shift], most))
            hit = close[_near(f[close + shift], f[close], most)]
            out_a.append(f[hit])
            out_b.append(f[hit + shift])
        for at in np.flatnonzero(sizes > SHIFTED):
            x, y = _forest(fp[starts[at] : starts[at] + sizes[at]], most)
            out_a.append(x)
            out_b.append(y)
        if not out_a:
            return None
        x, y = np.concatenate(out_a), np.concatenate(out_b)
        pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def numbered(parts):
            columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
            keys = columns[:-1]
            fresh = np.zeros(len(keys[0]), bool)
            for k in keys:
                fresh[1:] |= k[1:] != k[:-1]
            return np.cumsum(fresh), columns[-1]

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(batch.column(i).to_numpy() for i in range(batch.num_columns)))
            rows += batch.num_rows
            if rows >= 200_000:
                cell, fp = numbered(held)
                cut = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
                if cut:
                    found = solve(cell[:cut], fp[:cut])
                    if found is not None:
                        yield found
                    whole = [np.concatenate(x) for x in zip(*held, strict=True)]
                    held = [tuple(x[cut:] for x in whole)]
                    rows = len(whole[0]) - cut
        if held:
            found = solve(*numbered(held))
            if found is not None:
                yield found

    return run


def _block_masks(blocks: int) -> list[int]:
    """Masks of ``blocks`` runs of whole segments, as signed longs."""
    segments = 64 // SEGMENT_BITS
    cuts = [round(i * segments / blocks) * SEGMENT_BITS for i in range(blocks + 1)]
    return [((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, together: int = CELL_PIECE) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` at most ``max_bits`` bits apart.

    Each fingerprint is embedded as the set-bit counts of its segments. Bits that differ bound the
    Manhattan distance of two embeddings from above, so near fingerprints are near on the grid:
    of ``max_bits + 2`` blocks of coordinates two agree in full. A fingerprint therefore enters one
    cell for each pair of blocks. In the joined cells the Manhattan distance of two embeddings is taken
    first, and the bits of those within ``max_bits`` decide. Cells with many members
    are cut into pieces by hash, and every two pieces of a cell meet in one task. Pieces return links
    that connect what is connected in them, not every pair.
    """
    spark = fps.sparkSession
    nodes = fps.select("fp").distinct()
    odd = _signed(0x5555555555555555)
    low, high = F.col("fp").bitwiseAND(F.lit(odd)), F.shiftrightunsigned("fp", 1).bitwiseAND(F.lit(odd))
    # the count of each segment, in its own two bits
    counts = F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseXOR(high))
    masks = _block_masks(max_bits + 2)
    pairs = list(combinations(range(max_bits + 2), 2))
    cells = nodes.withColumn("e", counts).select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("grid"), F.col("e").bitwiseAND(F.lit(_signed(masks[x] | masks[y]))).alias("cell"))
            for i, (x, y) in enumerate(pairs)
        ])).alias("g"),
    ).select("g.grid", "g.cell", "fp")
    crowded = cells.groupBy("grid", "cell").agg(F.count("*").alias("n")).where(F.col("n") > together)
    crowded = crowded.select("grid", "cell", F.ceil(F.col("n") / together).cast("int").alias("pieces"))
    placed = cells.join(crowded, ["grid", "cell"], "left")
    own = F.pmod(F.xxhash64("fp"), F.coalesce("pieces", F.lit(1))).cast("int")
    placed = placed.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1))
    )
    met = placed.select(
        "grid", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"
    )
    key = ["grid", "cell", "i", "j"]
    dealt = met.repartition(shuffle_partitions(spark), *key).sortWithinPartitions(*key, "fp")
    return dealt.mapInArrow(_links(max_bits), "a long, b long").distinct()


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    max_bits: int = MAX_BITS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    A-Z are lower-cased, words are what white space separates, shingles are ``width`` words with
    repeats. Null and wordless text has fingerprint zero and is linked like any other; fewer words
    than ``width`` make one shingle. component_id is the smallest doc_id of the component (null only
    if all of its identifiers are null). Repeated rows give repeated rows; an empty table an empty
    result; other columns are not read.

    Equal fingerprints are one node with their smallest doc_id, so a group of copies, however
    large, is one node in the search.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = keep(rows.mapInArrow(_fingerprints(width, seed), "doc_id long, fp long"))
    nodes = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(fingerprint_links(nodes, max_bits)).withColumnRenamed("node", "fp")
    named = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    found = named.join(smallest, "root").select("fp", "component_id")
    return prints.join(found, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
