"""Embedding near-duplicates by an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ARROW_ROWS, components, keep, prepare, shuffle_partitions

THRESHOLD = 0.95
# Leading principal dimensions: of the grid order, and of the bounds that skip blocks.
GRID_DIMS = 4
BOUND_DIMS = 16
# Vectors in a block of the sequence (a row of work is a pair of blocks), children of an interval of
# blocks, and vectors of a part that is no longer split within a pair of blocks.
BLOCK = 4096
FAN = 8
LEAF = 256
# Slack for rounding: nothing is skipped that a bound excludes by less.
SLACK = 1e-9
# Cosines of unit vectors from a matrix product are off by far less than this.
ROUNDED = 1e-9
# Partial sums that one task adds up.
FOLD = 16
LINKS = "node long, links long, near long"


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, unit vector as bytes of doubles) of usable vectors."""
    for batch in batches:
        ids, out = [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not v or any(x is None for x in v):
                continue
            x = np.array(v, np.float64)
            top = np.abs(x).max() if np.isfinite(x).all() else 0.0
            if top == 0.0:
                continue
            x /= top  # no overflow in the norm
            ids.append(i)
            out.append((x / np.sqrt((x * x).sum())).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "unit"])


def _moments(dims: int):
    """Count, sum and second moment of the unit vectors of one task."""

    def run(batches):
        n, total, square = 0, np.zeros(dims), np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column(0).to_pylist(), dims)
            n += len(x)
            total += x.sum(axis=0)
            square += x.T @ x
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n]), pa.array([np.concatenate([total, square.ravel()]).tobytes()], pa.binary())], names=["n", "sums"])

    return run


def _matrix(rows: list[bytes], dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.float64).reshape(-1, dims)


def _project(axes: np.ndarray, epsilon: float):
    """Grid cells and coordinates on the leading principal dimensions."""

    def run(batches):
        dims = axes.shape[0]
        for batch in batches:
            x = _matrix(batch.column(2).to_pylist(), dims) @ axes
            cells = np.floor(x[:, :GRID_DIMS] / epsilon).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(cells[:, i]) for i in range(cells.shape[1])], pa.array(x[:, 0])],
                names=["node", "copies", "unit", *[f"c{i}" for i in range(cells.shape[1])], "x0"])

    return run


def _blocks(axes: np.ndarray, size: int):
    """One row per block of consecutive vectors of the sequence, with its bounds."""

    def run(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        copies: list[int] = []
        units: list[bytes] = []

        def emit():
            nonlocal number
            x = _matrix(units, axes.shape[0])
            p = x @ axes
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                pa.array([np.array(copies, np.int64).tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()),
                pa.array([p.min(axis=0).tolist()]), pa.array([p.max(axis=0).tolist()]),
            ], names=["part", "number", "ids", "copies", "units", "low", "high"])
            number += 1
            ids.clear()
            copies.clear()
            units.clear()
            return row

        for batch in batches:
            for i, n, u in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                ids.append(i)
                copies.append(n)
                units.append(u)
                if len(ids) == size:
                    yield emit()
        if ids:
            yield emit()

    return run


def _connect(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links (a, b): linked places get the smallest label among them."""
    a, b = label[a], label[b]
    while True:
        open_links = a != b
        if not open_links.any():
            return label
        a, b = a[open_links], b[open_links]
        high, low = np.maximum(a, b), np.minimum(a, b)
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        first = np.r_[True, high[1:] != high[:-1]]
        parent = np.arange(len(label))
        parent[high[first]] = low[first]  # downwards only, so there is no cycle
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label, a, b = parent[label], parent[high], parent[low]


def _close(axes: np.ndarray, threshold: float, squared: float):
    """Links between the vectors of two blocks, in double precision; the recursion goes on inside.

    Returns a row per linked vector, not per link: how many links it has here, and a vector that
    stands for all that are connected with it here.
    """
    dims = axes.shape[0]

    def parts(p: np.ndarray):
        """Bounds of the leaves of one block."""
        at = np.arange(0, len(p), LEAF)
        return at, np.minimum.reduceat(p, at, axis=0), np.maximum.reduceat(p, at, axis=0)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                same = row["same"]
                ids, weight = np.frombuffer(row["ids_a"], np.int64), np.frombuffer(row["copies_a"], np.int64)
                x = y = _matrix([row["units_a"]], dims)
                shift = 0  # where the second block's places begin
                if not same:
                    y, shift = _matrix([row["units_b"]], dims), len(ids)
                    ids = np.concatenate([ids, np.frombuffer(row["ids_b"], np.int64)])
                    weight = np.concatenate([weight, np.frombuffer(row["copies_b"], np.int64)])
                links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
                at_x, low_x, high_x = parts(x @ axes)
                at_y, low_y, high_y = parts(y @ axes)
                for i, start in enumerate(at_x):
                    gaps = np.maximum(0.0, np.maximum(low_x[i] - high_y, low_y - high_x[i]))
                    near = (gaps * gaps).sum(axis=1) <= squared
                    if same:
                        near[:i] = False
                    mine = x[start : start + LEAF]
                    for j in at_y[near]:
                        theirs = y[j : j + LEAF]
                        cosine = mine @ theirs.T
                        yes = cosine >= threshold + ROUNDED
                        # where rounding could matter the pair's own sum decides, in one order everywhere
                        doubt_a, doubt_b = np.nonzero((cosine >= threshold - ROUNDED) & ~yes)
                        for k in range(0, len(doubt_a), LEAF):
                            d, e = doubt_a[k : k + LEAF], doubt_b[k : k + LEAF]
                            yes[d, e] = (mine[d] * theirs[e]).sum(axis=1) >= threshold
                        if same and start == j:
                            yes = np.triu(yes, 1)
                        hit_a, hit_b = np.nonzero(yes)
                        if len(hit_a):
                            of_x, of_y = slice(start, start + len(mine)), slice(shift + j, shift + j + len(theirs))
                            links[of_x] += yes.astype(np.int64) @ weight[of_y]
                            links[of_y] += weight[of_x] @ yes.astype(np.int64)
                            label = _connect(label, hit_a + start, hit_b + shift + j)
                met = np.flatnonzero(links)
                for k in range(0, len(met), ARROW_ROWS):
                    m = met[k : k + ARROW_ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[m]), pa.array(links[m]), pa.array(ids[label[m]])], names=["node", "links", "near"])

    return run


def _not_apart(pairs: DataFrame, squared: float) -> DataFrame:
    """Pairs of intervals whose bounds do not prove them more than epsilon apart."""
    gaps = F.zip_with(
        F.zip_with("low_a", "high_b", lambda x, y: x - y), F.zip_with("low_b", "high_a", lambda x, y: x - y),
        lambda p, q: F.greatest(p, q, F.lit(0.0)),
    )
    return pairs.where(F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= squared)


def close_links(units: DataFrame, dims: int, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Links between nodes (node, copies, unit) with cosine at least ``threshold``, counted per pair of blocks.

    One row (node, links, near) per pair of blocks and node with a link in it: ``links`` is the number of
    copies of the nodes it is linked with there, ``near`` a node it is connected with by links there,
    the same one for all that are connected there. Summed up, the links are exact, and the rows
    (node, near) connect what the links connect; a dense group costs rows in proportion to its
    nodes, not to its links.

    Unit vectors with cosine c are sqrt(2 - 2c) apart, and a projection only shortens distances. The
    vectors are sorted by their grid cells on the leading principal dimensions, and cut into blocks.
    Pairs of intervals of blocks are split recursively, from the whole sequence down to pairs of
    blocks; a pair whose bounds are provably more than epsilon apart is skipped. Every remaining pair of blocks is
    one row of work.
    """
    spark = units.sparkSession
    epsilon = float(np.sqrt(max(0.0, 2.0 - 2.0 * threshold))) + SLACK
    # dims * (dims + 1) sums of each task are added up by a tree of tasks; one row reaches the driver
    sums = units.select("unit").mapInArrow(_moments(dims), "n long, sums binary")
    tasks = units.rdd.getNumPartitions()
    while tasks > 1:
        tasks = -(-tasks // FOLD)
        sums = sums.repartition(tasks).mapInArrow(_add_up, "n long, sums binary")
    folded = sums.first()
    if folded is None:
        return spark.createDataFrame([], LINKS)
    values = np.frombuffer(folded["sums"], np.float64)
    mean = values[:dims] / folded["n"]
    spread = values[dims:].reshape(dims, dims) / folded["n"] - np.outer(mean, mean)
    _, vectors = np.linalg.eigh(spread)
    axes = np.ascontiguousarray(vectors[:, ::-1][:, : min(dims, BOUND_DIMS)])
    grid = [f"c{i} int" for i in range(min(GRID_DIMS, axes.shape[1]))]
    placed = units.select("node", "copies", "unit").mapInArrow(
        _project(axes, epsilon), "node long, copies long, unit binary, " + ", ".join(grid) + ", x0 double")
    order = [g.split()[0] for g in grid] + ["x0", "node"]
    sequence = placed.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    blocks = keep(sequence.select("node", "copies", "unit").mapInArrow(
        _blocks(axes, block), "part int, number int, ids binary, copies binary, units binary, low array<double>, high array<double>"))
    # numbers along the sequence: blocks of earlier ranges first
    offsets = {}
    at = 0
    for row in blocks.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").toLocalIterator():
        offsets[row["part"]] = at  # one number per range
        at += row["n"]
    starts = spark.createDataFrame(list(offsets.items()), "part int, first long")
    blocks = blocks.join(F.broadcast(starts), "part").withColumn("block", F.col("first") + F.col("number")).drop("part", "number", "first")
    bounds = keep(blocks.select("block", "low", "high"))
    levels = 0
    while FAN**levels < at:
        levels += 1
    width = len(axes[0])

    def intervals(level: int) -> DataFrame:
        wide = bounds.withColumn("id", F.floor(F.col("block") / FAN**level).cast("long"))
        tops = wide.groupBy("id").agg(
            *[F.min(F.col("low")[i]).alias(f"l{i}") for i in range(width)],
            *[F.max(F.col("high")[i]).alias(f"h{i}") for i in range(width)],
        )
        return tops.select("id", F.array(*[f"l{i}" for i in range(width)]).alias("low"), F.array(*[f"h{i}" for i in range(width)]).alias("high"))

    pairs = spark.createDataFrame([(0, 0)], "a long, b long")
    for level in range(levels - 1, -1, -1):
        here = intervals(level)
        split = pairs.withColumn("x", F.explode(F.sequence(F.col("a") * FAN, F.col("a") * FAN + FAN - 1)))
        split = split.withColumn("y", F.explode(F.sequence(F.col("b") * FAN, F.col("b") * FAN + FAN - 1)))
        split = split.where("x <= y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        left = here.select(F.col("id").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"))
        right = here.select(F.col("id").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
        pairs = keep(_not_apart(split.join(left, "a").join(right, "b"), epsilon * epsilon).select("a", "b"))
    sides = ["ids", "copies", "units"]
    left = blocks.select(F.col("block").alias("a"), *[F.col(c).alias(f"{c}_a") for c in sides])
    right = blocks.select(F.col("block").alias("b"), *[F.col(c).alias(f"{c}_b") for c in sides])
    work = pairs.join(left, "a").join(right, "b").select(
        *[f"{c}_a" for c in sides], *[f"{c}_b" for c in sides], (F.col("a") == F.col("b")).alias("same"))
    return work.mapInArrow(_close(axes, threshold, epsilon * epsilon), LINKS)


def _add_up(batches):
    n, total = 0, None
    for batch in batches:
        for k, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(s, np.float64)
            n, total = n + k, x if total is None else total + x
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tobytes()], pa.binary())], names=["n", "sums"])


def embedding_groups(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, as do
    vectors without identifier; each is its own component. Vectors that point in exactly the same
    direction are one node, however many. Repeated rows are vectors of their own that link with each
    other; of those that share the smallest identifier each is kept. Vectors of different lengths are
    compared with those of their own length only. An empty table gives an empty result; other columns
    are not read.
    """
    spark = prepare(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    units = keep(rows.where("vec_id is not null").mapInArrow(_unit_rows, "vec_id long, unit binary"))
    nodes = units.groupBy("unit").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    nodes = keep(nodes.withColumn("node", F.monotonically_increasing_id()))
    links = spark.createDataFrame([], LINKS)
    # one pass for each length of vectors, which a table has one of
    for size in [r[0] for r in nodes.select(F.length("unit")).distinct().collect()]:
        own = nodes.where(F.length("unit") == size)
        links = links.union(close_links(own, size // 8, threshold))
    links = keep(links)
    around = links.groupBy("node").agg(F.sum("links").alias("around"))
    roots = components(links.select(F.col("node").alias("a"), F.col("near").alias("b")))
    named = nodes.join(around, "node", "left").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    found = named.join(smallest, "root").select(
        "unit", "component_id", (F.col("copies") - 1 + F.coalesce("around", F.lit(0))).alias("n_links"))
    # a null or unusable vector has no unit row; it is added from the input
    linked = units.join(found, "unit").select("vec_id", "n_links", "component_id")
    alone = rows.mapInArrow(_unusable, "vec_id long").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _unusable(batches):
    """Identifiers of the rows that ``_unit_rows`` leaves out, and rows without identifier."""
    for batch in batches:
        ids = [
            i
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            if i is None or not v or any(x is None for x in v) or not np.isfinite(v).all() or not np.any(v)
        ]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())], names=["vec_id"])


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE a = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.a = e.vec_id
"""
