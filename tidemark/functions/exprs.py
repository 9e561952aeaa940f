"""Small column expressions that pin down the semantics every operator shares."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division that yields NULL for a zero denominator (never decimal, never an error)."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def stable_round(value: Column | str, digits: int) -> Column:
    """Half-up decimal rounding that ignores the last bits of a sum.

    The order in which partial sums meet differs between runs of a distributed job. Rounding three
    digits further out first keeps a value that sits on a tie from flipping with that order.
    """
    return F.round(F.round(as_column(value).cast("double"), digits + 3), digits)


def pct(numerator: Column | str, denominator: Column | str, digits: int = 2) -> Column:
    scaled = as_column(numerator).cast("double") * F.lit(100.0)
    return stable_round(F.try_divide(scaled, as_column(denominator).cast("double")), digits)


def count_rows(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)


def flag(condition: Column) -> Column:
    """1 when the condition holds, else 0 (NULL counts as 0)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def week_start(day: Column | str) -> Column:
    """Monday of the week as a DATE."""
    return F.date_trunc("week", as_column(day)).cast("date")


def month_start(day: Column | str) -> Column:
    return F.date_trunc("month", as_column(day)).cast("date")


def as_date(value: Column | str) -> Column:
    return as_column(value).cast("date")


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """Second boundaries crossed between two zone-free timestamps (0.9 s to 1.1 s counts 1)."""
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    since = lambda c: F.timestamp_diff("SECOND", epoch, as_column(c))
    return since(end) - since(start)


def elapsed_hours(start: Column | str, end: Column | str) -> Column:
    micros = F.timestamp_diff("MICROSECOND", as_column(start), as_column(end))
    return micros.cast("double") / F.lit(3600.0 * 1_000_000)


def is_finite(value: Column | str) -> Column:
    """True for a non-null number that is neither NaN nor infinite."""
    number = as_column(value).cast("double")
    return number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))


def in_unit_interval(value: Column | str) -> Column:
    return as_column(value).between(0, 1)


def first_time(name: Column | str, wanted: str, time: Column | str) -> Column:
    """Earliest ``time`` among rows whose event name is ``wanted`` (an aggregate)."""
    return F.min(F.when(as_column(name) == wanted, as_column(time)))


def extreme_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str], carried: Sequence[str], largest: bool = False) -> DataFrame:
    """The first (or ``largest``) row of each group by ``order``, as keys, order and carried columns.

    ``order[0]`` has a fixed width (a time, a date, a number). Its extreme is found by a hash aggregate
    that combines map-side; rows are then matched on keys and that value, and only those that tie are
    compared as structs. Rows are never sorted, and the match deals a hot group by its values. NULL
    keys are a group; rows with a NULL ``order[0]`` count only where a group has no other.
    """
    pick = F.max if largest else F.min
    best = rows.groupBy(*keys).agg(pick(order[0]).alias("__best"))
    best = best.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__best")
    match = F.col(order[0]).eqNullSafe(F.col("__best"))
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    tied = rows.join(best, match, "left_semi")
    return tied.groupBy(*keys).agg(pick(F.struct(*order, *carried)).alias("__row")).select(*keys, "__row.*")


def bucket(value: Column, bounds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label by the first upper bound that is not exceeded."""
    (first_bound, first_label), *rest = bounds
    chain = F.when(value <= first_bound, first_label)
    for bound, label in rest:
        chain = chain.when(value <= bound, label)
    return chain.otherwise(otherwise)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner") -> DataFrame:
    """Join on keys where NULL matches NULL; the right-hand key columns are dropped."""
    keys = list(keys)
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    condition = None
    for k in keys:
        term = left[k].eqNullSafe(renamed[f"__r_{k}"])
        condition = term if condition is None else condition & term
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def trailing_rows(order: str, rows: int) -> Window:
    """ROWS frame over a frame already reduced to one row per calendar day."""
    return Window.orderBy(order).rowsBetween(-(rows - 1), Window.currentRow)


def running_rows(*order: Column | str):
    return Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
