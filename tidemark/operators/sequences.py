"""Event streams reduced to one row per task, user or document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import (
    as_date,
    count_rows,
    elapsed_seconds,
    first_time,
    flag,
    month_start,
    week_start,
)

# --- fixed values: milestone columns and the events that set them ------------------------------
MILESTONES = {
    "uploaded_at": "document_uploaded",
    "ocr_started_at": "ocr_started",
    "ocr_completed_at": "ocr_completed",
    "anonymization_completed_at": "anonymization_completed",
    "risk_detection_completed_at": "risk_detection_completed",
    "autofill_completed_at": "autofill_completed",
    "review_started_at": "form_review_started",
    "exported_at": "form_exported",
    "abandoned_at": "task_abandoned",
    "failed_at": "agent_run_failed",
}
REACHED = {
    "reached_ocr": "ocr_completed_at",
    "reached_autofill": "autofill_completed_at",
    "reached_review": "review_started_at",
    "was_exported": "exported_at",
    "was_abandoned": "abandoned_at",
    "had_failure": "failed_at",
}
STEP_FLAGS = {
    "did_upload": "uploaded_at",
    "did_complete_ocr": "ocr_completed_at",
    "did_complete_anonymization": "anonymization_completed_at",
    "did_complete_risk_detection": "risk_detection_completed_at",
    "did_complete_autofill": "autofill_completed_at",
    "did_start_review": "review_started_at",
    "did_export": "exported_at",
    "did_abandon": "abandoned_at",
    "did_fail": "failed_at",
}
TERMINAL_PRIORITY = (("exported_at", "exported"), ("abandoned_at", "abandoned"), ("failed_at", "failed"))
TASK_KEYS = ("task_id", "user_id", "document_id")


def task_event_sequence(
    events: DataFrame,
    entity: Sequence[str] = TASK_KEYS,
    milestones: Mapping[str, str] = MILESTONES,
    edit_event: str = "field_edited",
    failure_event: str = "agent_run_failed",
) -> DataFrame:
    """One row per entity with the first time of each milestone, counts and reached flags.

    A single hash aggregate: the partial step collapses each input partition to its entities, so
    the shuffle carries entities, not events.
    """
    counted = events.groupBy(*entity).agg(
        *[first_time("event_name", event, "event_time").alias(c) for c, event in milestones.items()],
        F.max("event_time").alias("last_event_at"),
        count_rows("event_count"),
        F.count_if(F.col("event_name") == edit_event).alias("field_edit_count"),
    )
    # an event without a time has no first time, so "reached" follows from the milestone
    reached = {c: flag(F.col(at).isNotNull()).alias(c) for c, at in REACHED.items() if at in milestones}
    stage = F.when(F.col("failed_at").isNotNull(), F.lit(failure_event))
    return counted.select("*", *reached.values(), stage.alias("failure_stage_guess"))


def task_funnel_flags(sequence: DataFrame) -> DataFrame:
    """Boolean did_<step> per task from the milestone times."""
    return sequence.select(
        *TASK_KEYS,
        *[F.col(at).isNotNull().alias(name) for name, at in STEP_FLAGS.items()],
        "field_edit_count",
        "event_count",
        "uploaded_at",
        "exported_at",
    )


def task_funnel_enriched(flags: DataFrame, users: DataFrame, documents: DataFrame) -> DataFrame:
    """Uploaded tasks with user and document dimensions; a missing dimension reads 'unknown'."""
    unknown = lambda c: F.coalesce(F.col(c), F.lit("unknown"))
    steps = [s for s in STEP_FLAGS if s not in ("did_abandon", "did_fail")]
    who = users.select("user_id", "acquisition_channel", "device_type", "user_segment")
    what = documents.select("document_id", "complexity_level")
    return (
        flags.where(F.col("uploaded_at").isNotNull())
        .join(who, "user_id", "left")
        .join(what, "document_id", "left")
        .select(
            *TASK_KEYS,
            as_date("uploaded_at").alias("event_date"),
            unknown("acquisition_channel").alias("acquisition_channel"),
            unknown("device_type").alias("device_type"),
            unknown("user_segment").alias("user_segment"),
            unknown("complexity_level").alias("complexity"),
            *steps,
        )
    )


def task_outcomes(sequence: DataFrame) -> DataFrame:
    """Terminal state by priority, completion time and duration in whole second boundaries."""
    state = None
    for column, label in TERMINAL_PRIORITY:
        reached = F.col(column).isNotNull()
        state = F.when(reached, label) if state is None else state.when(reached, label)
    finished = F.coalesce(*[F.col(c) for c, _ in TERMINAL_PRIORITY])
    return sequence.select(
        *TASK_KEYS,
        "uploaded_at",
        "exported_at",
        "abandoned_at",
        "failed_at",
        state.otherwise("in_progress").alias("final_outcome"),
        F.coalesce(finished, F.col("last_event_at")).alias("completed_at"),
        F.col("exported_at").isNotNull().alias("is_successful"),
        "event_count",
        "field_edit_count",
        elapsed_seconds("uploaded_at", finished).alias("task_duration_seconds"),
    )


def user_first_activity(events: DataFrame) -> DataFrame:
    """First active day and time, first upload day, first export day per user."""
    return events.groupBy("user_id").agg(
        F.min("event_date").alias("first_activity_date"),
        F.min("event_time").alias("first_activity_time"),
        first_time("event_name", "document_uploaded", "event_date").alias("first_upload_date"),
        first_time("event_name", "form_exported", "event_date").alias("first_export_date"),
    )


def user_cohorts(users: DataFrame, first_activity: DataFrame) -> DataFrame:
    """Signup cohort of every user with first activity, first export and the days to each.

    Takes the per-user aggregate instead of events, so the join is one row to one row whatever the
    activity of a single user.
    """
    first = first_activity.select("user_id", "first_activity_date", "first_export_date")
    return users.join(first, "user_id", "left").select(
        "user_id",
        "signup_date",
        week_start("signup_date").alias("cohort_week"),
        month_start("signup_date").alias("cohort_month"),
        "acquisition_channel",
        "device_type",
        "user_segment",
        "first_activity_date",
        "first_export_date",
        F.datediff("first_activity_date", "signup_date").alias("days_to_first_activity"),
        F.datediff("first_export_date", "signup_date").alias("days_to_activation"),
    )


def user_daily_activity(events: DataFrame) -> DataFrame:
    """(user, day): distinct tasks touched, distinct tasks started, whether an export happened.

    Reduces to (user, day, task) first: that level combines map-side and spreads a very active
    user over their tasks; the second level only counts rows.
    """
    per_task = events.groupBy("user_id", "event_date", "task_id").agg(
        F.max(flag(F.col("event_name") == "document_uploaded")).alias("started"),
        F.max(flag(F.col("event_name") == "form_exported")).alias("exported"),
    )
    has_task = F.col("task_id").isNotNull()
    return per_task.groupBy("user_id", F.col("event_date").alias("activity_date")).agg(
        F.count_if(has_task).alias("tasks_touched"),
        F.count_if(has_task & (F.col("started") == 1)).alias("tasks_started"),
        F.max("exported").alias("had_export"),
    )


def document_complexity_features(documents: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Every document with its task counts, mean edits and mean task duration."""
    per_task = outcomes.groupBy("document_id", "task_id").agg(
        F.max("is_successful").alias("succeeded"),
        F.sum("field_edit_count").alias("edits"),
        F.count("field_edit_count").alias("edit_rows"),
        F.sum("task_duration_seconds").alias("seconds"),
        F.count("task_duration_seconds").alias("second_rows"),
    )
    per_document = per_task.groupBy("document_id").agg(
        F.count("task_id").alias("task_count"),
        F.count_if(F.col("succeeded") & F.col("task_id").isNotNull()).alias("successful_task_count"),
        F.try_divide(F.sum("edits").cast("double"), F.sum("edit_rows")).alias("avg_field_edits"),
        F.try_divide(F.sum("seconds").cast("double"), F.sum("second_rows")).alias("avg_task_duration_seconds"),
    )
    kept = [
        "document_id",
        "user_id",
        "document_type",
        "language",
        "page_count",
        "complexity_level",
        "contains_pii",
        "contains_high_risk_terms",
        "is_complex",
    ]
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return documents.select(*kept).join(per_document, "document_id", "left").select(
        *kept,
        zero("task_count"),
        zero("successful_task_count"),
        "avg_field_edits",
        "avg_task_duration_seconds",
    )


def task_context(events: DataFrame) -> DataFrame:
    """First user, document and experiment of each task, by event time (ties by event id)."""
    stamp = F.struct(F.col("event_time"), F.col("event_id"))
    earliest = lambda c: F.min_by(F.col(c), stamp).alias(c)
    return events.groupBy("task_id").agg(
        earliest("user_id"),
        earliest("document_id"),
        F.min("event_time").alias("task_started_at"),
        earliest("experiment_id"),
        earliest("experiment_group"),
    )
