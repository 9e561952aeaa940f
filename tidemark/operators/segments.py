"""Channel, segment and dimension views of task outcomes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import null_safe_join, ratio

# --- fixed values: dimension names and the columns they read ------------------------------------
DIMENSIONS = {
    "user_segment": "user_segment",
    "device_type": "device_type",
    "channel": "acquisition_channel",
    "complexity": "complexity",
}


def export_rate_by_dimension(enriched: DataFrame, dimensions: Mapping[str, str] = DIMENSIONS) -> DataFrame:
    """(date, dimension, segment): distinct tasks, exported tasks, rate.

    One unpivot instead of one scan per dimension. A task seen with several users or documents may
    sit in several segments of a dimension, so tasks are made distinct after the unpivot; that
    aggregate is keyed by task and spreads evenly even when one segment holds most tasks.
    """
    entries = [
        F.struct(F.lit(name).alias("dimension_name"), F.col(c).alias("segment"))
        for name, c in dimensions.items()
    ]
    long = enriched.select(
        "event_date", "task_id", "did_export", F.explode(F.array(*entries)).alias("d")
    ).select("event_date", "task_id", "did_export", "d.*")
    per_task = long.groupBy("event_date", "dimension_name", "segment", "task_id").agg(
        F.max("did_export").alias("did_export")
    )
    total = F.count("task_id")
    exported = F.count_if(F.col("did_export") & F.col("task_id").isNotNull())
    return per_task.groupBy("event_date", "dimension_name", "segment").agg(
        total.alias("total_tasks"),
        exported.alias("exported_tasks"),
        ratio(exported, total).alias("export_rate"),
    )


def channel_performance(users: DataFrame, flags: DataFrame) -> DataFrame:
    """Channel: users, converted users, tasks, exported tasks, rates and rank by conversion.

    Distinct tasks and distinct converted users are each an aggregate keyed by task or user, which
    stays even when one channel holds most rows; only per-channel counts meet at the end.
    """
    who = users.select("user_id", "acquisition_channel")
    sizes = who.groupBy("acquisition_channel").agg(F.count("user_id").alias("cohort_users"))
    per_task = (
        flags.join(who, "user_id")
        .groupBy("acquisition_channel", "task_id", "user_id")
        .agg(F.max("did_export").alias("did_export"))
    )
    tasks = (
        per_task.groupBy("acquisition_channel", "task_id")
        .agg(F.max("did_export").alias("did_export"))
        .groupBy("acquisition_channel")
        .agg(
            F.count("task_id").alias("total_tasks"),
            F.count_if(F.col("did_export") & F.col("task_id").isNotNull()).alias("exported_tasks"),
        )
    )
    converted = (
        per_task.groupBy("acquisition_channel", "user_id")
        .agg(F.max("did_export").alias("did_export"))
        .groupBy("acquisition_channel")
        .agg(F.count_if("did_export").alias("converted_users"))
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    key = ["acquisition_channel"]
    joined = null_safe_join(null_safe_join(sizes, converted, key, "left"), tasks, key, "left").select(
        *key, "cohort_users", zero("converted_users"), zero("total_tasks"), zero("exported_tasks")
    )
    rate = ratio("converted_users", "cohort_users")
    return joined.select(
        "*",
        rate.alias("user_conversion_rate"),
        ratio("exported_tasks", "total_tasks").alias("task_export_rate"),
        F.rank().over(Window.orderBy(rate.desc_nulls_last())).alias("conversion_rank"),
    )


def user_segments(users: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(segment, channel, device): users, tasks, success rate, mean edits, mean duration."""
    cell = ["user_segment", "acquisition_channel", "device_type"]
    who = users.select("user_id", *cell)
    sizes = who.groupBy(*cell).agg(F.count("user_id").alias("user_count"))
    per_task = (
        outcomes.join(who, "user_id")
        .groupBy(*cell, "task_id")
        .agg(
            F.max("is_successful").alias("ok"),
            F.sum("field_edit_count").alias("edits"),
            F.count("field_edit_count").alias("edit_rows"),
            F.sum("task_duration_seconds").alias("seconds"),
            F.count("task_duration_seconds").alias("second_rows"),
        )
    )
    total = F.count("task_id")
    done = F.count_if(F.col("ok") & F.col("task_id").isNotNull())
    work = per_task.groupBy(*cell).agg(
        total.alias("total_tasks"),
        ratio(done, total).alias("task_success_rate"),
        ratio(F.sum("edits"), F.sum("edit_rows")).alias("avg_edits"),
        ratio(F.sum("seconds"), F.sum("second_rows")).alias("avg_duration_s"),
    )
    return null_safe_join(sizes, work, cell, "left").select(
        *cell,
        "user_count",
        F.coalesce("total_tasks", F.lit(0)).alias("total_tasks"),
        "task_success_rate",
        "avg_edits",
        "avg_duration_s",
    )
