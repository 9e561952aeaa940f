"""Day and week level scorecards and alerts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import as_date, ratio, week_start


def task_totals(flags: DataFrame) -> DataFrame:
    """One row per task: outcome flags, edits and upload time."""
    return flags.where(F.col("task_id").isNotNull()).groupBy("task_id").agg(
        F.max("did_export").alias("did_export"),
        F.max("did_abandon").alias("did_abandon"),
        F.max("did_fail").alias("did_fail"),
        F.max("field_edit_count").alias("field_edit_count"),
        F.max("uploaded_at").alias("uploaded_at"),
    )


def daily_product_kpis(events: DataFrame, flags: DataFrame) -> DataFrame:
    """Activity by event date, full-joined with tasks by upload date.

    Activity comes from one (date, user) aggregate that also carries whether the user uploaded.
    """
    user_days = events.groupBy("event_date", "user_id").agg(
        F.max(F.col("event_name") == "document_uploaded").alias("uploaded")
    )
    activity = user_days.groupBy("event_date").agg(
        F.count("user_id").alias("dau"),
        F.count_if(F.col("uploaded") & F.col("user_id").isNotNull()).alias("uploaders"),
    )
    cohort = (
        task_totals(flags)
        .where(F.col("uploaded_at").isNotNull())
        .groupBy(as_date("uploaded_at").alias("event_date"))
        .agg(
            F.count("task_id").alias("total_tasks"),
            F.count_if("did_export").alias("exported_tasks"),
            F.count_if("did_abandon").alias("abandoned_tasks"),
            F.count_if("did_fail").alias("failed_tasks"),
            ratio(F.sum("field_edit_count"), F.count("field_edit_count")).alias("avg_manual_edits"),
        )
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return activity.join(cohort, "event_date", "full_outer").select(
        "event_date",
        zero("dau").alias("dau"),
        zero("uploaders").alias("uploaders"),
        zero("total_tasks").alias("total_tasks"),
        zero("exported_tasks").alias("exported_tasks"),
        ratio(zero("exported_tasks"), zero("total_tasks")).alias("export_rate"),
        ratio(zero("abandoned_tasks"), zero("total_tasks")).alias("abandonment_rate"),
        ratio(zero("failed_tasks"), zero("total_tasks")).alias("failure_rate"),
        F.coalesce("avg_manual_edits", F.lit(0.0)).alias("avg_manual_edits"),
    )


def executive_daily_scorecard(kpis: DataFrame, retention: DataFrame, agent_daily: DataFrame) -> DataFrame:
    """Per date: DAU, north star, rates, weighted D7 of matured cohorts, agent KPIs, data status."""
    d7 = (
        retention.where("d7_matured")
        .groupBy(F.col("cohort_date").alias("event_date"))
        .agg(ratio(F.sum("d7_retained_users"), F.sum("d7_eligible_users")).alias("d7_retention"))
    )
    agent = agent_daily.select(
        F.col("run_date").alias("event_date"),
        F.col("agent_success_rate").alias("__success"),
        F.col("p95_latency_ms").alias("__p95"),
        F.col("cost_per_successful_task").alias("__cost"),
    )
    status = (
        F.when(F.col("d7_retention").isNull(), "D7 retention unavailable")
        .when(F.col("__success").isNull(), "agent KPI missing")
        .otherwise("ok")
    )
    zero = lambda c, out: F.coalesce(F.col(c), F.lit(0.0)).alias(out)
    return (
        kpis.join(d7, "event_date", "left")
        .join(agent, "event_date", "left")
        .select(
            "event_date",
            "dau",
            F.col("exported_tasks").alias("north_star_metric"),
            "export_rate",
            "abandonment_rate",
            "avg_manual_edits",
            "d7_retention",
            zero("__success", "agent_success_rate"),
            zero("__p95", "agent_p95_latency_ms"),
            zero("__cost", "cost_per_successful_task"),
            status.alias("data_quality_status"),
        )
    )


def _task_outcome_by(events: DataFrame, flags: DataFrame, period: Column, name: str) -> DataFrame:
    """(period, task) with the task's outcome and its number of event rows in the period."""
    per_task = events.groupBy(period.alias(name), "task_id").agg(F.count(F.lit(1)).alias("event_rows"))
    outcome = task_totals(flags).select("task_id", "did_export", "did_fail")
    edits = flags.groupBy("task_id").agg(
        F.sum("field_edit_count").alias("edits"), F.count("field_edit_count").alias("edit_rows")
    )
    return per_task.join(outcome, "task_id", "left").join(edits, "task_id", "left")


def weekly_business_review(events: DataFrame, flags: DataFrame, weight: str = "event") -> DataFrame:
    """ISO week: WAU, tasks, exports, rates, mean edits.

    ``weight="event"`` averages edits over event rows, so long tasks weigh more; ``"task"`` gives
    every task one vote.
    """
    week = week_start("event_date")
    users = (
        events.select(week.alias("week_start"), "user_id")
        .distinct()
        .groupBy("week_start")
        .agg(F.count("user_id").alias("wau"))
    )
    rows = _task_outcome_by(events, flags, week, "week_start")
    share = F.col("event_rows") if weight == "event" else F.lit(1)
    total = F.count("task_id")
    has_task = F.col("task_id").isNotNull()
    tasks = rows.groupBy("week_start").agg(
        total.alias("weekly_tasks"),
        F.count_if(F.col("did_export") & has_task).alias("weekly_exports"),
        ratio(F.count_if(F.col("did_export") & has_task), total).alias("export_rate"),
        ratio(F.sum(F.col("edits") * share), F.sum(F.col("edit_rows") * share)).alias("avg_edits"),
        ratio(F.count_if(F.col("did_fail") & has_task), total).alias("failure_rate"),
    )
    return users.join(tasks, "week_start")


@dataclass(frozen=True)
class Threshold:
    """A daily metric, the breach direction, the limit and the status it raises."""

    metric: str
    above: bool
    limit: float
    status: str

    def breached(self) -> Column:
        value = F.col(self.metric)
        return value > self.limit if self.above else value < self.limit


# --- fixed values: alert limits, in order of precedence ----------------------------------------
ALERT_THRESHOLDS = (
    Threshold("failure_rate", True, 0.20, "HIGH_FAILURE_RATE"),
    Threshold("export_rate", False, 0.40, "LOW_EXPORT_RATE"),
    Threshold("agent_success_rate", False, 0.80, "LOW_AGENT_SUCCESS"),
    Threshold("p95_latency_ms", True, 10000, "HIGH_LATENCY"),
)


def daily_alerts(
    events: DataFrame,
    flags: DataFrame,
    agent_daily: DataFrame,
    thresholds: Sequence[Threshold] = ALERT_THRESHOLDS,
) -> DataFrame:
    """Dates breaching any threshold, labelled by the first one breached."""
    rows = _task_outcome_by(events, flags, F.col("event_date"), "event_date")
    total = F.count("task_id")
    has_task = F.col("task_id").isNotNull()
    daily = rows.groupBy("event_date").agg(
        ratio(F.count_if(F.col("did_export") & has_task), total).alias("export_rate"),
        ratio(F.count_if(F.col("did_fail") & has_task), total).alias("failure_rate"),
    )
    agent = agent_daily.select(
        F.col("run_date").alias("event_date"), "agent_success_rate", "p95_latency_ms"
    )
    status, any_breach = None, F.lit(False)
    for rule in thresholds:
        hit = F.coalesce(rule.breached(), F.lit(False))
        status = F.when(hit, rule.status) if status is None else status.when(hit, rule.status)
        any_breach = any_breach | hit
    return (
        daily.join(agent, "event_date", "left")
        .where(any_breach)
        .select(
            "event_date",
            F.lit("quality").alias("alert_type"),
            status.otherwise("OK").alias("alert_status"),
            "failure_rate",
            "export_rate",
            "agent_success_rate",
            "p95_latency_ms",
        )
    )


def scorecard_totals(scorecard: DataFrame, condition: Column | None = None) -> DataFrame:
    """Period totals: summed north star, means of the daily values."""
    rows = scorecard if condition is None else scorecard.where(condition)
    means = [
        "dau",
        "export_rate",
        "d7_retention",
        "agent_success_rate",
        "agent_p95_latency_ms",
        "cost_per_successful_task",
    ]
    return rows.agg(
        F.coalesce(F.sum("north_star_metric"), F.lit(0)).alias("total_exported_tasks"),
        *[F.avg(c).alias(f"avg_{c}") for c in means],
    )


def clamp_window(
    days: DataFrame,
    date_column: str,
    start: str | None = None,
    end: str | None = None,
    window_days: int = 30,
) -> DataFrame:
    """One row (date_start, date_end) inside the data's range.

    Missing bounds take the last ``window_days`` days, stale bounds are pulled into range, and an
    inverted window falls back to the default.
    """
    wanted = lambda v: F.lit(v).cast("date")
    bounds = days.agg(F.min(date_column).alias("lo"), F.max(date_column).alias("hi"))
    default_start = F.greatest("lo", F.date_sub("hi", window_days))
    inside = lambda c: F.greatest(F.col("lo"), F.least(c, F.col("hi")))
    first = inside(F.coalesce(wanted(start), default_start))
    last = inside(F.coalesce(wanted(end), F.col("hi")))
    return bounds.select(
        F.when(first > last, default_start).otherwise(first).alias("date_start"),
        F.when(first > last, F.col("hi")).otherwise(last).alias("date_end"),
    )
