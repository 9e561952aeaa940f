"""Rate and mix decomposition of a change between two windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import ratio, stable_round


def pick_windows(days: DataFrame, date_column: str, length: int = 7) -> DataFrame:
    """One row: the last ``length`` days of the data and the ``length`` days before them."""
    last = days.agg(F.max(date_column).cast("date").alias("current_end"))
    return last.select(
        F.date_sub("current_end", length - 1).alias("current_start"),
        "current_end",
        F.date_sub("current_end", 2 * length - 1).alias("prior_start"),
        F.date_sub("current_end", length).alias("prior_end"),
    )


def kitagawa(periods: DataFrame, by: Sequence[str], segment: str = "segment") -> DataFrame:
    """Decompose a rate change per segment.

    Input: one row per (by, segment) with prior_volume, prior_hits, current_volume, current_hits.
    rate effect = (s0 + s1) / 2 * (r1 - r0), mix effect = (r0 + r1) / 2 * (s1 - s0). A segment missing
    in one window has volume and rate 0 there. The residual is the part of the overall change that
    the effects do not explain.
    """
    whole = Window.partitionBy(*by)
    total = lambda c: F.sum(c).over(whole)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    filled = periods.select(
        *by,
        segment,
        *[
            F.coalesce(F.col(c), F.lit(0)).alias(c)
            for c in ("prior_volume", "current_volume", "prior_hits", "current_hits")
        ],
    )
    rated = filled.select(
        "*",
        zero(ratio("prior_hits", "prior_volume")).alias("prior_rate"),
        zero(ratio("current_hits", "current_volume")).alias("current_rate"),
        ratio("prior_volume", total("prior_volume")).alias("prior_share"),
        ratio("current_volume", total("current_volume")).alias("current_share"),
        (
            ratio(total("current_hits"), total("current_volume"))
            - ratio(total("prior_hits"), total("prior_volume"))
        ).alias("overall_change"),
    )
    half = F.lit(0.5)
    rate_effect = half * (F.col("prior_share") + F.col("current_share")) * (
        F.col("current_rate") - F.col("prior_rate")
    )
    mix_effect = half * (F.col("prior_rate") + F.col("current_rate")) * (
        F.col("current_share") - F.col("prior_share")
    )
    effects = rated.select(
        "*", rate_effect.alias("rate_effect"), mix_effect.alias("mix_effect")
    ).withColumn("total_effect", F.col("rate_effect") + F.col("mix_effect"))
    return effects.withColumn("residual", F.col("overall_change") - total("total_effect"))


def dimension_decomposition(
    dimension_daily: DataFrame,
    windows: DataFrame,
    volume: str = "total_tasks",
    hits: str = "exported_tasks",
) -> DataFrame:
    """Kitagawa decomposition of every dimension of a daily rate table.

    Both windows are summed in one conditional aggregate. ``windows`` is one row from
    :func:`pick_windows` and enters as one scalar subquery.
    """
    at = windows.select(F.struct(*windows.columns)).scalar()
    day = F.col("event_date")
    is_current = day.between(at["current_start"], at["current_end"])
    is_prior = day.between(at["prior_start"], at["prior_end"])
    summed = lambda cond, c: F.sum(F.when(cond, F.col(c)).otherwise(0))
    periods = (
        dimension_daily.where(is_current | is_prior)
        .groupBy("dimension_name", "segment")
        .agg(
            summed(is_prior, volume).alias("prior_volume"),
            summed(is_prior, hits).alias("prior_hits"),
            summed(is_current, volume).alias("current_volume"),
            summed(is_current, hits).alias("current_hits"),
        )
    )
    return kitagawa(periods, ["dimension_name"])


def top_contributors(effects: DataFrame, k: int = 5) -> DataFrame:
    """The k largest positive and k largest negative contributions over all dimensions, with each
    entry's share of the summed absolute contributions of its dimension."""
    shared = effects.withColumn(
        "contribution_share",
        ratio(
            "total_effect",
            F.sum(F.abs(F.col("total_effect"))).over(Window.partitionBy("dimension_name")),
        ),
    )
    signed = shared.where(F.col("total_effect") != 0).withColumn(
        "direction", F.when(F.col("total_effect") > 0, "positive").otherwise("negative")
    )
    strongest = Window.partitionBy("direction").orderBy(
        stable_round(F.abs(F.col("total_effect")), 12).desc(), "dimension_name", "segment"
    )
    return (
        signed.withColumn("position", F.row_number().over(strongest))
        .where(F.col("position") <= k)
        .select(
            "direction",
            "position",
            "dimension_name",
            "segment",
            "rate_effect",
            "mix_effect",
            "total_effect",
            "contribution_share",
        )
    )


def event_date_decomposition(
    events: DataFrame,
    users: DataFrame,
    flags: DataFrame,
    current_days: int = 7,
    prior_days: int = 7,
    segment: str = "acquisition_channel",
) -> DataFrame:
    """Decomposition by day of activity: a task counts in every window it has events in.

    ``current_days=8`` gives the window of the original report, whose current window is one day
    longer than its prior one. Tasks are made distinct per window before counting.
    """
    last = events.agg(F.max("event_date")).scalar()
    current_from = F.date_sub(last, current_days - 1)
    prior_from = F.date_sub(last, current_days + prior_days - 1)
    day = F.col("event_date")
    touched = (
        events.where(day >= prior_from)
        .groupBy("user_id", "task_id")
        .agg(
            F.max(day >= current_from).alias("in_current"),
            F.max(day < current_from).alias("in_prior"),
        )
    )
    exported = flags.groupBy("task_id").agg(F.max("did_export").alias("did_export"))
    who = users.select("user_id", F.col(segment).alias("segment"))
    per_task = (
        touched.join(who, "user_id")
        .groupBy("segment", "task_id")
        .agg(F.max("in_current").alias("in_current"), F.max("in_prior").alias("in_prior"))
        .join(exported, "task_id", "left")
    )
    done = F.coalesce("did_export", F.lit(False))
    counted: list[Column] = []
    for name in ("prior", "current"):
        counted.append(F.count_if(F.col(f"in_{name}")).alias(f"{name}_volume"))
        counted.append(F.count_if(F.col(f"in_{name}") & done).alias(f"{name}_hits"))
    periods = per_task.groupBy(F.lit(segment).alias("dimension_name"), "segment").agg(*counted)
    return kitagawa(periods, ["dimension_name"])
