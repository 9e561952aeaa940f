"""Ordered funnels: step counts, step and overall conversion, by any dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import pct, ratio, stable_round

# --- fixed values: funnel order ----------------------------------------------------------------
STEPS = {
    "uploaded": None,
    "ocr_completed": "did_complete_ocr",
    "anonymization_completed": "did_complete_anonymization",
    "risk_detection_completed": "did_complete_risk_detection",
    "autofill_completed": "did_complete_autofill",
    "review_started": "did_start_review",
    "exported": "did_export",
}
NUMBERED_STEPS = {
    "1_upload": None,
    "2_ocr": "did_complete_ocr",
    "3_anonymization": "did_complete_anonymization",
    "4_risk_detection": "did_complete_risk_detection",
    "5_autofill": "did_complete_autofill",
    "6_review": "did_start_review",
    "7_export": "did_export",
}
PAGE_STEPS = {
    "Upload": "did_upload",
    "OCR": "did_complete_ocr",
    "Anonymization": "did_complete_anonymization",
    "Risk Detection": "did_complete_risk_detection",
    "Autofill": "did_complete_autofill",
    "Review": "did_start_review",
    "Export": "did_export",
}


def distinct_tasks(
    flags: DataFrame, steps: Mapping[str, str | None], by: Sequence[str] = ()
) -> DataFrame:
    """One row per (group, task) with each step flag reduced by OR.

    Replaces one COUNT(DISTINCT CASE ...) per step, which Spark would expand into a copy of
    every row per step, by one aggregate and plain counts.
    """
    named = [c for c in dict.fromkeys(steps.values()) if c]
    return flags.where(F.col("task_id").isNotNull()).groupBy(*by, "task_id").agg(
        *[F.max(c).alias(c) for c in named]
    )


def step_counts(rows: DataFrame, steps: Mapping[str, str | None], by: Sequence[str] = ()) -> DataFrame:
    """Long form: group columns, step_order, step, tasks; one scan for all steps."""
    counts = [
        (F.count_if(F.col(c)) if c else F.count(F.lit(1))).alias(f"__{i}")
        for i, c in enumerate(steps.values())
    ]
    entries = [
        F.struct(F.lit(i + 1).alias("step_order"), F.lit(name).alias("step"), F.col(f"__{i}").alias("tasks"))
        for i, name in enumerate(steps)
    ]
    wide = rows.groupBy(*by).agg(*counts)
    return wide.select(*by, F.explode(F.array(*entries)).alias("s")).select(*by, "s.*")


def _order(by: Sequence[str]):
    """Window over the few steps of one group."""
    return Window.partitionBy(*by).orderBy("step_order")


def conversion_funnel(flags: DataFrame) -> DataFrame:
    """Seven rows: distinct tasks, conversion from the step before and from the first, dropoff."""
    counts = step_counts(distinct_tasks(flags, STEPS), STEPS)
    before = F.lag("tasks").over(_order(()))
    first = F.first("tasks").over(_order(()))
    opening = F.col("step_order") == 1
    return counts.select(
        "step",
        "tasks",
        F.when(opening, F.lit(1.0)).otherwise(ratio("tasks", before)).alias("step_conversion"),
        F.when(opening, F.lit(1.0)).otherwise(ratio("tasks", first)).alias("overall_conversion"),
        F.when(opening, F.lit(0)).otherwise(before - F.col("tasks")).cast("bigint").alias("dropoff"),
    )


def full_task_funnel(flags: DataFrame) -> DataFrame:
    """Row-grain funnel with percentages and dropoff rate against the step before."""
    counts = step_counts(flags, NUMBERED_STEPS)
    before = F.lag("tasks").over(_order(()))
    first = F.first("tasks").over(_order(()))
    return counts.select(
        "step",
        "tasks",
        (F.col("tasks") - before).alias("dropoff_from_prior"),
        pct("tasks", before).alias("step_conversion_pct"),
        pct("tasks", first).alias("overall_conversion_pct"),
        stable_round(F.lit(1.0) - ratio("tasks", before), 4).alias("step_dropoff_rate"),
    )


def device_funnel(flags: DataFrame, users: DataFrame) -> DataFrame:
    """The funnel per registered device; tasks without a known user keep a NULL device."""
    device = users.select("user_id", F.coalesce("device_type", F.lit("unknown")).alias("device_type"))
    counts = step_counts(flags.join(device, "user_id", "left"), NUMBERED_STEPS, ["device_type"])
    before = F.coalesce(F.lag("tasks").over(_order(["device_type"])), F.col("tasks"))
    return counts.select("device_type", "step", "tasks", pct("tasks", before).alias("step_conversion_pct"))


def channel_funnel(flags: DataFrame, users: DataFrame) -> DataFrame:
    """Wide funnel per acquisition channel with mean edits and events per task row."""
    channel = users.select(
        "user_id", F.coalesce("acquisition_channel", F.lit("unknown")).alias("acquisition_channel")
    )
    steps = {k: v for k, v in STEPS.items() if v}
    per_task = (
        flags.join(channel, "user_id", "left")
        .groupBy("acquisition_channel", "task_id")
        .agg(
            *[F.max(c).alias(c) for c in steps.values()],
            F.sum("field_edit_count").alias("edits"),
            F.sum("event_count").alias("events"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
    has_task = F.col("task_id").isNotNull()
    counted = per_task.groupBy("acquisition_channel").agg(
        F.count_if(has_task).alias("total_tasks"),
        F.count_if(has_task & F.col("did_complete_ocr")).alias("completed_ocr"),
        F.count_if(has_task & F.col("did_complete_anonymization")).alias("completed_anonymization"),
        F.count_if(has_task & F.col("did_complete_risk_detection")).alias("completed_risk_detection"),
        F.count_if(has_task & F.col("did_complete_autofill")).alias("completed_autofill"),
        F.count_if(has_task & F.col("did_start_review")).alias("started_review"),
        F.count_if(has_task & F.col("did_export")).alias("exported"),
        stable_round(ratio(F.sum("edits"), F.sum("rows")), 2).alias("avg_field_edits"),
        stable_round(ratio(F.sum("events"), F.sum("rows")), 1).alias("avg_events_per_task"),
    )
    return counted.select(
        "acquisition_channel",
        "total_tasks",
        "completed_ocr",
        pct("completed_ocr", "total_tasks").alias("ocr_conversion_pct"),
        "completed_anonymization",
        pct("completed_anonymization", "completed_ocr").alias("anonymization_conversion_pct"),
        "completed_risk_detection",
        pct("completed_risk_detection", "completed_anonymization").alias("risk_detection_conversion_pct"),
        "completed_autofill",
        pct("completed_autofill", "completed_risk_detection").alias("autofill_conversion_pct"),
        "started_review",
        pct("started_review", "completed_autofill").alias("review_conversion_pct"),
        "exported",
        pct("exported", "total_tasks").alias("overall_export_rate_pct"),
        "avg_field_edits",
        "avg_events_per_task",
    )


def slice_filters(
    start: Column | None = None, end: Column | None = None, **equal: str | None
) -> Column:
    """Predicate for an optional date window and optional exact values (None means all)."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (F.col("event_date") >= start)
    if end is not None:
        condition = condition & (F.col("event_date") <= end)
    for column, value in equal.items():
        if value is not None:
            condition = condition & (F.col(column) == value)
    return condition


def sliced_funnel(enriched: DataFrame, condition: Column | None = None) -> DataFrame:
    """Seven-step funnel over a slice, as share of the first and of the previous step."""
    rows = enriched if condition is None else enriched.where(condition)
    counts = step_counts(distinct_tasks(rows, PAGE_STEPS), PAGE_STEPS)
    before = F.lag("tasks").over(_order(()))
    first = F.first("tasks").over(_order(()))
    zero_safe = lambda a, b: F.coalesce(ratio(a, b), F.lit(0.0))
    return counts.select(
        "step_order",
        F.col("step").alias("step_name"),
        F.col("tasks").alias("task_count"),
        zero_safe("tasks", first).alias("pct_of_step1"),
        F.when(F.col("step_order") == 1, F.lit(1.0)).otherwise(zero_safe("tasks", before)).alias(
            "pct_of_prior_step"
        ),
    )
