"""Activity: rolling active users, return rates, lifecycle, streaks, activation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import (
    as_date,
    bucket,
    count_rows,
    elapsed_hours,
    extreme_rows,
    flag,
    pct,
    ratio,
    running_rows,
    stable_round,
    trailing_rows,
    week_start,
)
from tidemark.functions.order_stats import positions_within


def trailing_distinct(user_days: DataFrame, windows: Mapping[str, int], day_count: str = "dau") -> DataFrame:
    """Per date: users that day, and distinct users in the n days ending that day for each window.

    Input: distinct (user_id, event_date). A user covers the dates [d, d + n) after each active
    day, cut short by the next active day. Each piece adds +1 where it starts and -1 where it
    ends, and a running sum over the calendar gives the answer. All windows share one pass; work
    is linear in user-days and the calendar is the only thing ordered globally.
    """
    per_user = Window.partitionBy("user_id").orderBy("event_date")
    following = F.lead("event_date").over(per_user)
    known = F.when(F.col("user_id").isNotNull(), 1).otherwise(0)
    spans = user_days.select("event_date", following.alias("next_date"), known.alias("n"))

    def edge(at: Column, starts: bool, closing: str | None = None) -> Column:
        changes = [
            (F.col("n") if starts else (-F.col("n") if name == closing else F.lit(0))).alias(name)
            for name in windows
        ]
        return F.struct(
            at.alias("at"),
            F.lit(1 if starts else 0).alias("is_day"),
            (F.col("n") if starts else F.lit(0)).alias(day_count),
            *changes,
        )

    edges = [edge(F.col("event_date"), True)]
    for name, days in windows.items():
        until = F.date_add("event_date", days)
        edges.append(edge(F.least(until, F.coalesce(F.col("next_date"), until)), False, name))
    daily = (
        spans.select(F.explode(F.array(*edges)).alias("e"))
        .groupBy(F.col("e.at").alias("event_date"))
        .agg(
            F.sum("e.is_day").alias("is_day"),
            *[F.sum(f"e.{c}").alias(c) for c in (day_count, *windows)],
        )
    )
    running = running_rows("event_date")
    summed = daily.select(
        "event_date", "is_day", day_count, *[F.sum(name).over(running).alias(name) for name in windows]
    )
    return summed.where(F.col("is_day") > 0).drop("is_day")


def rolling_active_users(events: DataFrame, week: int = 7, month: int = 30) -> DataFrame:
    """Per date: DAU, row-frame averages and true trailing distinct users."""
    user_days = events.select("user_id", "event_date").distinct()
    daily = trailing_distinct(user_days, {"wau_distinct": week, "mau_distinct": month})
    return daily.select(
        "event_date",
        "dau",
        (F.sum("dau").over(trailing_rows("event_date", week)) / F.lit(float(week))).alias("wau_avg_daily"),
        (F.sum("dau").over(trailing_rows("event_date", month)) / F.lit(float(month))).alias("mau_avg_daily"),
        "wau_distinct",
        "mau_distinct",
    )


def signup_activation(users: DataFrame, cohorts: DataFrame, within: int = 7) -> DataFrame:
    """Per signup date: new users, activation within ``within`` days, mean and median days.

    The median is read from a histogram of whole days, so its buffer is bounded by the calendar.
    """
    days = F.col("days_to_activation")
    histogram = (
        users.select("user_id", "signup_date")
        .where(F.col("signup_date").isNotNull())
        .join(cohorts.select("user_id", "days_to_activation"), "user_id", "left")
        .groupBy("signup_date", "days_to_activation")
        .agg(count_rows("n"))
    )
    reached = F.sum(F.when(days <= within, F.col("n")).otherwise(0))
    total = F.sum("n")
    known = F.sum(F.when(days.isNotNull(), F.col("n")))
    return histogram.groupBy("signup_date").agg(
        total.alias("new_users"),
        reached.alias("activated_within_7d"),
        pct(reached, total).alias("activation_rate_pct"),
        stable_round(ratio(F.sum(days * F.col("n")), known), 2).alias("avg_days_to_activation"),
        F.expr("percentile(days_to_activation, 0.5, n)").alias("median_days_to_activation"),
    )


# --- fixed values: upper bounds in days / hours and their labels --------------------------------
EXPORT_DAY_BUCKETS = (
    (1, "same_or_next_day"),
    (7, "within_1_week"),
    (30, "within_1_month"),
    (90, "within_3_months"),
)
SUCCESS_HOUR_BUCKETS = ((1, "under_1h"), (24, "1-24h"), (24 * 7, "1-7d"), (24 * 30, "7-30d"))


def time_to_first_export(users: DataFrame, first_activity: DataFrame) -> DataFrame:
    """Days from signup to first export with rank, dense rank and row number over all users.

    Ranks come from the histogram of days (one row per day count): rank = 1 + users on smaller
    values. Only that histogram is ordered globally. The row number adds the position inside a
    day count, which is itself computed bin by bin.
    """
    exported = first_activity.where(F.col("first_export_date").isNotNull())
    days = users.select("user_id", "signup_date").join(
        exported.select("user_id", "first_export_date"), "user_id"
    ).withColumn("days_to_export", F.datediff("first_export_date", "signup_date"))
    ordered = Window.orderBy("days_to_export")
    histogram = days.groupBy("days_to_export").agg(count_rows("n"))
    ranks = histogram.select(
        F.col("days_to_export").alias("__days"),
        (F.lit(1) + F.sum("n").over(ordered) - F.col("n")).alias("rank_days_to_export"),
        F.row_number().over(ordered).alias("dense_rank_days_to_export"),
    )
    placed = positions_within(days, ["days_to_export"], "user_id", "__place")
    return placed.join(ranks, F.col("days_to_export").eqNullSafe(F.col("__days"))).select(
        "user_id",
        "signup_date",
        "first_export_date",
        "days_to_export",
        "rank_days_to_export",
        (F.col("rank_days_to_export") - 1 + F.col("__place")).alias("row_number_days_to_export"),
        "dense_rank_days_to_export",
        bucket(F.col("days_to_export"), EXPORT_DAY_BUCKETS, "over_3_months").alias("time_bucket"),
    )


def activity_return_rates(daily: DataFrame, offsets: Sequence[int] = (1, 7, 30)) -> DataFrame:
    """Per export day: users, and how many export again exactly n days later.

    One shifted equi-join for all offsets: each active day is matched against the same days moved
    back by every offset, so there is no self join per offset.
    """
    active = daily.where(F.col("had_export") == 1).select("user_id", "activity_date")
    back = F.explode(F.array(*[F.lit(n) for n in offsets]))
    anchors = active.select("user_id", "activity_date", back.alias("n")).select(
        "user_id", F.date_sub("activity_date", F.col("n")).alias("activity_date"), "n"
    )
    earlier = anchors.groupBy("user_id", "activity_date").agg(
        *[F.max(flag(F.col("n") == n)).alias(f"r{n}") for n in offsets]
    )
    joined = active.join(earlier, ["user_id", "activity_date"], "left")
    out = joined.groupBy("activity_date").agg(
        count_rows("active_users"),
        *[F.sum(F.coalesce(F.col(f"r{n}"), F.lit(0))).alias(f"retained_d{n}_users") for n in offsets],
    )
    return out.select(
        "*", *[pct(f"retained_d{n}_users", "active_users").alias(f"d{n}_retention_pct") for n in offsets]
    )


def cohort_retention_matrix(cohorts: DataFrame, daily: DataFrame, last_week: int = 12) -> DataFrame:
    """Signup week by activity week: eligible users, returning users, rate, week number 0..12."""
    weeks = daily.select("user_id", week_start("activity_date").alias("activity_week")).distinct()
    base = cohorts.select("user_id", "cohort_week")
    size = base.groupBy("cohort_week").agg(F.count("user_id").alias("eligible_users"))
    number = (F.datediff("activity_week", "cohort_week") / 7).cast("int")
    seen = (
        base.join(weeks, "user_id")
        .where(number.between(0, last_week) & (F.col("activity_week") >= F.col("cohort_week")))
        .groupBy("cohort_week", "activity_week")
        .agg(count_rows("retained_users"))
    )
    return seen.join(size, "cohort_week").select(
        "cohort_week",
        "eligible_users",
        "activity_week",
        number.alias("week_number"),
        "retained_users",
        pct("retained_users", "eligible_users").alias("retention_rate_pct"),
    )


def _per_user_day(daily: DataFrame):
    """Ordered days of one user: a window never holds more rows than the calendar has days."""
    return Window.partitionBy("user_id").orderBy("activity_date")


def lifecycle_segments(daily: DataFrame, mode: str = "rows") -> DataFrame:
    """Per day and stage: users, mean tasks, exporting users.

    ``mode="rows"`` takes "seven days ago" from the seventh row before, as the original report does.
    ``mode="days"`` looks for activity exactly seven days before and also reports users who
    left: 'churned' on the day after their last day of activity before a gap, 'dormant' 30 days
    after it.
    """
    window = _per_user_day(daily)
    first = F.min("activity_date").over(Window.partitionBy("user_id"))
    previous = F.lag("activity_date").over(window)
    gap = F.datediff("activity_date", previous)
    if mode == "rows":
        week_ago = F.lag("activity_date", 7).over(window)
        returned = F.datediff("activity_date", week_ago) == 7
    else:
        days = F.collect_set("activity_date").over(window.rowsBetween(-7, -1))
        returned = F.array_contains(days, F.date_sub("activity_date", 7))
    stage = (
        F.when(F.col("activity_date") == first, "new")
        .when(gap == 1, "active")
        .when(returned, "retained")
        .when(gap >= 30, "resurrected")
        .otherwise("active")
    )
    classified = daily.select("user_id", "activity_date", "tasks_touched", "had_export", stage.alias("stage"))
    if mode == "days":
        classified = classified.unionByName(_absent_days(daily))
    return classified.groupBy("activity_date", F.col("stage").alias("lifecycle_stage")).agg(
        F.count("user_id").alias("user_count"),
        stable_round(ratio(F.sum("tasks_touched"), F.count("tasks_touched")), 2).alias("avg_tasks_touched"),
        F.sum("had_export").alias("users_with_export"),
        stable_round(ratio(F.sum("had_export"), F.count("had_export")) * 100, 2).alias("export_pct"),
    )


def _absent_days(daily: DataFrame, dormant_after: int = 30) -> DataFrame:
    """Days on which a user counts as churned (first day away) or dormant (30 days away)."""
    end = daily.agg(F.max("activity_date")).scalar()
    until = F.coalesce(
        F.lead("activity_date").over(_per_user_day(daily)), F.date_add(end, 1)
    )
    spans = daily.select("user_id", "activity_date", until.alias("until"))
    marks = spans.select(
        "user_id",
        "until",
        F.explode(
            F.array(
                F.struct(F.date_add("activity_date", 1).alias("at"), F.lit("churned").alias("stage")),
                F.struct(
                    F.date_add("activity_date", dormant_after).alias("at"), F.lit("dormant").alias("stage")
                ),
            )
        ).alias("m"),
    ).where(F.col("m.at") < F.col("until"))
    return marks.select(
        "user_id",
        F.col("m.at").alias("activity_date"),
        F.lit(0).cast("bigint").alias("tasks_touched"),
        F.lit(0).alias("had_export"),
        F.col("m.stage").alias("stage"),
    )


def streak_days(daily: DataFrame) -> DataFrame:
    """Per day: users, users in the middle of three consecutive days, mean tasks of each."""
    window = _per_user_day(daily)
    near = lambda move, step: (
        F.coalesce(move("tasks_touched").over(window), F.lit(0)) > 0
    ) & (move("activity_date").over(window) == F.date_add("activity_date", step))
    middle = (F.col("tasks_touched") > 0) & near(F.lag, -1) & near(F.lead, 1)
    marked = daily.select("*", F.coalesce(middle, F.lit(False)).alias("middle"))
    streak_tasks = F.when(F.col("middle"), F.col("tasks_touched"))
    return marked.groupBy("activity_date").agg(
        F.count("user_id").alias("active_users"),
        F.count_if("middle").alias("streak_users"),
        pct(F.count_if("middle"), F.count("user_id")).alias("streak_users_pct"),
        stable_round(ratio(F.sum("tasks_touched"), F.count("tasks_touched")), 2).alias("avg_tasks_touched"),
        stable_round(ratio(F.sum(streak_tasks), F.count(streak_tasks)), 2).alias("avg_streak_tasks_touched"),
        F.sum("had_export").alias("exporting_users"),
    )


def activity_streaks(daily: DataFrame, at_least: int = 3) -> DataFrame:
    """Runs of consecutive active days of length ``at_least`` or more (gaps and islands)."""
    position = F.row_number().over(_per_user_day(daily))
    islands = daily.where(F.col("tasks_touched") > 0).select(
        "user_id", "activity_date", F.date_sub("activity_date", position).alias("island")
    )
    return (
        islands.groupBy("user_id", "island")
        .agg(
            F.min("activity_date").alias("streak_start"),
            F.max("activity_date").alias("streak_end"),
            count_rows("streak_days"),
        )
        .where(F.col("streak_days") >= at_least)
        .drop("island")
    )


def first_successful_task(users: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Earliest exported task of each user (ties by task id) and the time since signup."""
    done = outcomes.where(F.col("is_successful") & F.col("exported_at").isNotNull())
    carried = ["field_edit_count", "event_count", "task_duration_seconds"]
    first = extreme_rows(done, ["user_id"], ["exported_at", "task_id"], carried)
    joined = first.join(users.select("user_id", "signup_time"), "user_id")
    hours = elapsed_hours("signup_time", "exported_at")
    return joined.select(
        "user_id",
        "task_id",
        "signup_time",
        "exported_at",
        hours.alias("time_to_success_hours"),
        F.datediff(as_date("exported_at"), as_date("signup_time")).alias("time_to_success_days"),
        "field_edit_count",
        "event_count",
        "task_duration_seconds",
        bucket(hours, SUCCESS_HOUR_BUCKETS, "over_30d").alias("time_bucket"),
    )


def latest_task_per_user(outcomes: DataFrame, as_of: Column) -> DataFrame:
    """Most recent task of each user; ties by outcome priority, then by highest task id."""
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    times = ["uploaded_at", "exported_at", "abandoned_at", "failed_at"]
    latest = F.greatest(*[F.coalesce(F.col(c), epoch) for c in times])
    priority = (
        F.when(F.col("exported_at").isNotNull(), 3)
        .when(F.col("abandoned_at").isNotNull(), 2)
        .when(F.col("failed_at").isNotNull(), 1)
        .otherwise(0)
    )
    carried = [
        "document_id",
        *times,
        "final_outcome",
        "is_successful",
        "event_count",
        "field_edit_count",
        "task_duration_seconds",
    ]
    ordered = outcomes.withColumn("latest_event_at", latest).withColumn("p", priority)
    rows = extreme_rows(ordered, ["user_id"], ["latest_event_at", "p", "task_id"], carried, largest=True)
    at = F.col("latest_event_at")
    status = (
        F.when(F.col("exported_at") == at, "exported")
        .when(F.col("abandoned_at") == at, "abandoned")
        .when(F.col("failed_at") == at, "failed")
        .otherwise("uploaded")
    )
    return rows.select(
        "user_id",
        "task_id",
        *carried,
        "latest_event_at",
        status.alias("latest_status"),
        F.datediff(as_of, as_date("latest_event_at")).alias("days_since_latest_activity"),
    )
