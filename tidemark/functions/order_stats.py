"""Exact percentiles and row numbers that never place a whole group in one task.

``percentile`` keeps every distinct value of a group in one aggregation buffer and
``row_number`` sorts a whole group in one task; either stalls when one group holds a large part
of the rows. The functions here first cut each group into order-preserving bins, count the bins (a
small frame), and then only sort inside single bins.

The bin of a value is a pure function of the value (and, for row numbers, of the group's exact
minimum and maximum), so a recomputed task always produces the same bins.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import null_safe_join
from tidemark.sources.sinks import written_once

# slices per unit of the natural logarithm in exact_percentiles: each spans under one percent
BINS_PER_UNIT = 128
# a group has one slice per so many rows in positions_within
ROWS_PER_BIN = 4096


def _log_bin(value: Column, per_unit: int) -> Column:
    """Slice of the signed logarithmic scale; never decreases when the value increases.

    Slices have one relative width at every magnitude, cents and millions alike: the logarithm of the
    smallest positive double is -744.4, so all shifted logarithms are positive.
    """
    size = (F.ln(F.abs(value)) + F.lit(746.0)) * F.lit(float(per_unit))
    return F.when(value == 0, F.lit(0)).otherwise(F.floor(F.signum(value) * size).cast("int"))


def _bin_index(code: Column, low: Column, high: Column, bins: Column) -> Column:
    position = F.floor((code - low) / (high - low) * bins)
    return F.when(high > low, F.least(position, bins - 1)).otherwise(F.lit(0)).cast("int")


def _bins_for(rows: Column, most: int | None, rows_per_bin: int) -> Column:
    """Number of bins of a group, in proportion to its rows; ``most`` is a ceiling where a caller wants one."""
    wanted = F.ceil(rows / F.lit(float(rows_per_bin)))
    return wanted if most is None else F.least(wanted, F.lit(most))


def exact_percentiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Mapping[str, float | Callable[[Column], Column]],
    weight: str | None = None,
    carry: Mapping[str, Column] | None = None,
    bounded_groups: bool = False,
    bins_per_unit: int = BINS_PER_UNIT,
) -> DataFrame:
    """Continuous (interpolated) percentiles per group, one output column per entry of ``probs``.

    The input is read once. It is collapsed to one row per (group, value) with its count, combined
    map-side, and dealt by group, bin and value, where a bin is a slice of the logarithmic scale and
    depends on nothing but the value. Both steps read that one exchange: counts per (group, bin) and a
    running count over a group's bins find the few bins that hold a wanted rank; then the values in those
    bins are sorted, bin by bin. ``weight`` gives each row an integer multiplicity. Instead of a share,
    an entry may be a function from the number of rows of a group to a rank, counted from 0.

    ``carry`` adds per-group sums over all rows (NULL values included) to the result: the sums of
    wanted bins come from the second step, all others from the first, so both steps need the same columns
    of the exchange. Without it groups that hold only NULLs are left out.

    ``bounded_groups`` states that the number of groups is bounded by the data model (days of the
    calendar, variants of an experiment). The per-group frame is then broadcast and the second
    step shuffles nothing but values of wanted bins. Otherwise AQE decides by measured size.
    """
    by, carry = list(by), dict(carry or {})
    if not by:
        raise ValueError("exact_percentiles needs at least one grouping column")
    number = F.col(value).cast("double")
    known = F.col("__v").isNotNull()
    source = df if carry else df.where(F.col(value).isNotNull())
    rows = source.select("*", number.alias("__v")).withColumn("__bin", _log_bin(F.col("__v"), bins_per_unit))
    amount = (F.col(weight) if weight else F.lit(1)).cast("double")
    collapsed = rows.groupBy(*by, "__bin", "__v").agg(
        F.sum(F.when(known, amount)).alias("__n"), *[F.sum(c).alias(name) for name, c in carry.items()]
    )

    per_bin = collapsed.groupBy(*by, "__bin").agg(
        F.sum("__n").alias("__size"), *[F.sum(name).alias(name) for name in carry]
    )
    ordered = Window.partitionBy(*by).orderBy("__bin")
    whole = Window.partitionBy(*by)
    counted = per_bin.withColumns(
        {
            "__before": F.sum("__size").over(ordered) - F.col("__size"),
            "__total": F.sum("__size").over(whole),
        }
    )
    total = F.col("__total")
    rank = {name: p(total) if callable(p) else F.lit(float(p)) * (total - 1) for name, p in probs.items()}

    def holds(position: Column, start: Column, size: Column) -> Column:
        return (position >= start) & (position < start + size)

    wanted = F.lit(False)
    for position in rank.values():
        for end in (F.floor(position), F.ceil(position)):
            wanted = wanted | F.coalesce(holds(end, F.col("__before"), F.col("__size")), F.lit(False))
    # at most two bins per percentile
    targets = F.map_from_entries(F.collect_list(F.when(wanted, F.struct("__bin", "__before"))))
    groups = counted.groupBy(*by).agg(
        F.max("__total").alias("__total"),
        targets.alias("__targets"),
        *[F.sum(F.when(~wanted, F.col(name))).alias(f"__rest_{name}") for name in carry],
    )

    kept = null_safe_join(collapsed, F.broadcast(groups) if bounded_groups else groups, by).withColumn(
        "__before", F.try_element_at("__targets", F.col("__bin"))
    )
    here = F.col("__before").isNotNull()
    # rows without a value only keep their group in the result
    placed = kept.where(here | ~known)
    inside = Window.partitionBy(*by, "__bin").orderBy("__v")
    placed = placed.withColumn(
        "__start", F.when(known, F.col("__before") + F.sum("__n").over(inside) - F.col("__n"))
    )

    def value_at(position: Column) -> Column:
        return F.max(F.when(holds(position, F.col("__start"), F.col("__n")), F.col("__v")))

    def carried(name: str) -> Column:
        near, rest = F.sum(F.when(here, F.col(name))), F.first(f"__rest_{name}")
        return F.coalesce(near + rest, near, rest).alias(name)

    pieces = []
    for name, position in rank.items():
        pieces.append(value_at(F.floor(position)).alias(f"__lo_{name}"))
        pieces.append(value_at(F.ceil(position)).alias(f"__hi_{name}"))
    found = placed.groupBy(*by).agg(
        F.max("__total").alias("__total"), *pieces, *[carried(name) for name in carry]
    )
    out = []
    for name, position in rank.items():
        low, high = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        out.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return found.select(*by, *carry, *out)


# characters by which one round of text_slices looks further into the keys of a crowded slice
CHARACTERS_AT_ONCE = 2


def text_slices(df: DataFrame, by: Sequence[str], order: str, out: str, rows_per_slice: int = ROWS_PER_BIN) -> DataFrame:
    """Add ``out``: the beginning of a text key that names its slice, in the order of the keys.

    All keys of a group start in one slice. A slice of more than ``rows_per_slice`` rows is split by the
    characters after its own common beginning, again and again over the whole key, however its
    characters are spread (serial numbers use ten of them). Slices are counted exactly; only crowded ones
    travel on. A slice stays larger only if its keys are equal. Ends after as many rounds as the keys
    differ in ``CHARACTERS_AT_ONCE`` characters.
    """
    by = list(by)
    sliced = df.withColumn(out, F.lit(""))
    while True:
        sizes = sliced.groupBy(*by, out).agg(
            F.count(F.lit(1)).alias("__rows"), F.min(order).alias("__first"), F.max(order).alias("__last"))
        crowded = sizes.where((F.col("__rows") > rows_per_slice) & (F.col("__first") < F.col("__last")))
        shared = F.expr(
            "aggregate(sequence(0, least(length(__first), length(__last))), 0, "
            "(k, i) -> if(i > 0 and k = i - 1 and substr(__first, i, 1) = substr(__last, i, 1), i, k))")
        crowded = written_once(crowded.select(*by, out, (shared + CHARACTERS_AT_ONCE).alias("__reach")))
        if not crowded.limit(1).count():
            return sliced
        found = null_safe_join(sliced, crowded, [*by, out], "left")
        longer = F.substring(F.col(order), F.lit(1), F.col("__reach"))
        sliced = found.withColumn(out, F.when(F.col("__reach").isNotNull(), longer).otherwise(F.col(out))).drop("__reach")


def positions_within(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    out: str,
    bins: int | None = None,
    rows_per_bin: int = ROWS_PER_BIN,
) -> DataFrame:
    """Add ``row_number() over (partition by <by> order by <order>)`` as ``out``.

    ``order`` must be unique and non-null inside a group. Each task sorts one bin of one group: of a
    number, equal parts of its exact range; of a text, the slices of ``text_slices``.
    """
    by = list(by)
    if isinstance(df.schema[order].dataType, T.StringType):
        binned = text_slices(df, by, order, "__bin", rows_per_bin)
        return _number_in_bins(binned, by, order, out).select(*df.columns, out)
    coded = df.withColumn("__code", F.col(order).cast("double"))
    span = coded.groupBy(*by).agg(
        F.min("__code").alias("__low"),
        F.max("__code").alias("__high"),
        _bins_for(F.count("__code"), bins, rows_per_bin).alias("__k"),
    )
    binned = null_safe_join(coded, span, by).withColumn(
        "__bin", _bin_index(F.col("__code"), F.col("__low"), F.col("__high"), F.col("__k"))
    )
    return _number_in_bins(binned, by, order, out).select(*df.columns, out)


def _number_in_bins(binned: DataFrame, by: list[str], order: str, out: str) -> DataFrame:
    sizes = binned.groupBy(*by, "__bin").agg(F.count(F.lit(1)).alias("__size"))
    ordered = Window.partitionBy(*by).orderBy("__bin")
    starts = sizes.select(
        *by, "__bin", (F.sum("__size").over(ordered) - F.col("__size")).alias("__before")
    )
    inside = Window.partitionBy(*by, "__bin").orderBy(order)
    numbered = null_safe_join(binned, starts, [*by, "__bin"])
    return numbered.withColumn(out, F.col("__before") + F.row_number().over(inside))
