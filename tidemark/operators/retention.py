"""Signup retention with right-censoring, and the weekly views built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import count_rows, flag, ratio, week_start

HORIZONS = (1, 7, 30)
# fewest eligible users for a weekly rate to be shown (fixed value)
MIN_COHORT_SAMPLE = 20


def retention_cohort(
    users: DataFrame,
    events: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    population: str = "signups",
) -> DataFrame:
    """(signup date, channel): eligible and retained users at each exact-day horizon.

    A cohort is matured at horizon n once n days have been observed after it; before that the rate
    is NULL, never 0. ``population="active"`` counts only users with at least one event.
    """
    active = events.select("user_id", "event_date").distinct()
    cohort = users.select("user_id", "signup_date", "acquisition_channel")
    return_days = [F.date_add("signup_date", n) for n in horizons]
    # keep only the active days that can matter before grouping
    seen = (
        cohort.join(active, "user_id")
        .where(F.col("event_date").isin(*return_days))
        .groupBy("user_id")
        .agg(
            *[
                F.max(flag(F.datediff("event_date", "signup_date") == n)).alias(f"r{n}")
                for n in horizons
            ]
        )
    )
    base = cohort
    if population == "active":
        base = cohort.join(events.select("user_id").distinct(), "user_id", "left_semi")
    grouped = (
        base.join(seen, "user_id", "left")
        .groupBy(F.col("signup_date").alias("cohort_date"), "acquisition_channel")
        .agg(
            count_rows("eligible_users"),
            *[
                F.sum(F.coalesce(F.col(f"r{n}"), F.lit(0))).alias(f"d{n}_retained_users")
                for n in horizons
            ],
        )
    )
    end = events.agg(F.max("event_date")).scalar()
    observed = grouped.withColumn("observation_end_date", end)
    out: list[Column | str] = ["cohort_date", "acquisition_channel", "eligible_users"]
    for n in horizons:
        matured = F.coalesce(
            F.date_add("cohort_date", n) <= F.col("observation_end_date"), F.lit(False)
        )
        out += [
            matured.alias(f"d{n}_matured"),
            F.when(matured, F.col("eligible_users")).otherwise(0).alias(f"d{n}_eligible_users"),
            f"d{n}_retained_users",
            F.when(matured, ratio(f"d{n}_retained_users", "eligible_users")).alias(f"d{n}_retention_rate"),
        ]
    return observed.select(*out, "observation_end_date")


def sample_status(eligible: Column, minimum: int = MIN_COHORT_SAMPLE) -> Column:
    return (
        F.when(eligible == 0, "unmatured").when(eligible < minimum, "insufficient").otherwise("ok")
    )


def weekly_retention(
    retention: DataFrame, horizons: Sequence[int] = HORIZONS, minimum: int = MIN_COHORT_SAMPLE
) -> DataFrame:
    """Signup week by channel: matured days only, rate weighted by cohort size, sample status."""
    sums = []
    for n in horizons:
        for kind in ("eligible", "retained"):
            value = F.when(F.col(f"d{n}_matured"), F.col(f"d{n}_{kind}_users")).otherwise(0)
            sums.append(F.sum(value).alias(f"d{n}_{kind}_users"))
    weekly = retention.groupBy(
        week_start("cohort_date").alias("cohort_week"), "acquisition_channel"
    ).agg(*sums)
    out: list[Column | str] = ["cohort_week", "acquisition_channel"]
    for n in horizons:
        eligible = F.col(f"d{n}_eligible_users")
        out += [
            eligible,
            f"d{n}_retained_users",
            ratio(f"d{n}_retained_users", eligible).alias(f"d{n}_weighted_rate"),
            sample_status(eligible, minimum).alias(f"d{n}_maturity_status"),
            sample_status(eligible, minimum).alias(f"d{n}_sample_status"),
        ]
    return weekly.select(*out)


def sample_size_summary(weekly: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Long table: week, channel, horizon with sample sizes and status."""
    entries = [
        F.struct(
            F.lit(f"D{n}").alias("horizon"),
            F.col(f"d{n}_maturity_status").alias("maturity_status"),
            F.col(f"d{n}_eligible_users").alias("eligible_users"),
            F.col(f"d{n}_retained_users").alias("retained_users"),
            F.col(f"d{n}_weighted_rate").alias("retention_rate"),
            F.col(f"d{n}_maturity_status").alias("sample_status"),
        )
        for n in horizons
    ]
    return weekly.select(
        "cohort_week", F.col("acquisition_channel").alias("channel"), F.explode(F.array(*entries)).alias("h")
    ).select("cohort_week", "channel", "h.*")


def all_channel_weekly(
    weekly: DataFrame,
    horizon: int,
    minimum: int = MIN_COHORT_SAMPLE,
    only_without_channels: bool = True,
) -> DataFrame:
    """Weekly rate over all channels together.

    With ``only_without_channels`` the rows appear only when no single channel and week has enough
    users, which is when the chart falls back to this series.
    """
    eligible, retained = f"d{horizon}_eligible_users", f"d{horizon}_retained_users"
    overall = (
        weekly.groupBy("cohort_week")
        .agg(
            F.sum(eligible).alias("eligible_users"),
            F.sum(retained).alias("retained_users"),
        )
        .select(
            "cohort_week",
            "eligible_users",
            "retained_users",
            ratio("retained_users", "eligible_users").alias("retention_rate"),
            F.when(F.col("eligible_users") >= minimum, "ok").otherwise("insufficient").alias("sample_status"),
        )
    )
    if not only_without_channels:
        return overall
    plottable = weekly.agg(F.count_if(F.col(f"d{horizon}_sample_status") == "ok")).scalar()
    return overall.where(plottable == 0)


