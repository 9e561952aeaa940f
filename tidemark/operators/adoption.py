"""Feature adoption by day and segment, and time to first use."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import as_date, count_rows, extreme_rows, pct, ratio

# --- fixed values: features, their flags and milestone times -----------------------------------
FEATURE_FLAGS = {
    "OCR": "did_complete_ocr",
    "Anonymization": "did_complete_anonymization",
    "Risk Detection": "did_complete_risk_detection",
    "Autofill": "did_complete_autofill",
}
FEATURE_TIMES = {
    "OCR": "ocr_completed_at",
    "Anonymization": "anonymization_completed_at",
    "Risk Detection": "risk_detection_completed_at",
    "Autofill": "autofill_completed_at",
}
ADOPTION_COLUMNS = {
    "ocr_adoption": "did_complete_ocr",
    "anonymization_adoption": "did_complete_anonymization",
    "risk_detection_adoption": "did_complete_risk_detection",
    "autofill_adoption": "did_complete_autofill",
}
TREND_FLAGS = {
    "ocr": "did_complete_ocr",
    "anonymization": "did_complete_anonymization",
    "risk_detection": "did_complete_risk_detection",
    "autofill": "did_complete_autofill",
    "export": "did_export",
}


def explode_features(rows: DataFrame, columns: Mapping[str, str], label: str, value: str) -> DataFrame:
    """Wide feature columns to (label, value) rows in one pass over the input."""
    entries = [
        F.struct(F.lit(name).alias(label), F.col(c).alias(value)) for name, c in columns.items()
    ]
    rest = [c for c in rows.columns if c not in set(columns.values())]
    return rows.select(*rest, F.explode(F.array(*entries)).alias("__f")).select(*rest, "__f.*")


def feature_adoption(events: DataFrame, flags: DataFrame) -> DataFrame:
    """Per upload date: distinct uploaded tasks and the share reaching each feature."""
    uploads = (
        events.where(F.col("event_name") == "document_uploaded")
        .select("event_date", "task_id")
        .distinct()
    )
    named = list(ADOPTION_COLUMNS.values())
    per_task = flags.groupBy("task_id").agg(*[F.max(c).alias(c) for c in named])
    total = F.count("task_id")
    return (
        uploads.join(per_task, "task_id", "left")
        .groupBy("event_date")
        .agg(
            total.alias("total_tasks"),
            *[ratio(F.count_if(F.col(c)), total).alias(n) for n, c in ADOPTION_COLUMNS.items()],
        )
    )


def feature_adoption_segmented(enriched: DataFrame) -> DataFrame:
    """(date, feature, segment, device, complexity): distinct users, adopters, rate.

    Flags are reduced to one row per user and cell while still wide; only those rows are unpivoted.
    """
    cell = ["event_date", "user_segment", "device_type", "complexity"]
    per_user = enriched.groupBy(*cell, "user_id").agg(
        *[F.max(c).alias(c) for c in FEATURE_FLAGS.values()]
    )
    totals = per_user.where(F.col("user_id").isNotNull()).groupBy(*cell).agg(
        count_rows("total_users"), *[F.count_if(F.col(c)).alias(c) for c in FEATURE_FLAGS.values()]
    )
    return explode_features(totals, FEATURE_FLAGS, "feature_name", "adopted_users").select(
        "event_date",
        "feature_name",
        "user_segment",
        "device_type",
        "complexity",
        "total_users",
        "adopted_users",
        ratio("adopted_users", "total_users").alias("adoption_rate"),
    )


def feature_time_to_first_use(
    sequence: DataFrame, users: DataFrame, documents: DataFrame
) -> DataFrame:
    """Users by days from signup to the first use of each feature (non-negative days only).

    The first use per (user, feature) is taken before any join, so the joins see at most one row per
    user and feature.
    """
    uses = explode_features(
        sequence.select("user_id", "task_id", "document_id", *FEATURE_TIMES.values()),
        FEATURE_TIMES,
        "feature_name",
        "used_at",
    ).where(F.col("used_at").isNotNull())
    uses = uses.withColumn("first_use_date", as_date("used_at"))
    first = extreme_rows(uses, ["user_id", "feature_name"], ["first_use_date", "task_id"], ["document_id"])
    days = F.datediff("first_use_date", "signup_date")
    return (
        first.join(users.select("user_id", "user_segment", "device_type", "signup_date"), "user_id", "left")
        .join(documents.select("document_id", "complexity_level"), "document_id", "left")
        .where(days >= 0)
        .groupBy(
            "first_use_date",
            "feature_name",
            "user_segment",
            "device_type",
            F.coalesce("complexity_level", F.lit("unknown")).alias("complexity"),
            days.alias("days_to_first_use"),
        )
        .agg(F.count("user_id").alias("user_count"))
    )


def adoption_trend(flags: DataFrame) -> DataFrame:
    """Per upload date and feature: tasks, adoption, rank within the date, change from the day before."""
    daily = (
        flags.where(F.col("uploaded_at").isNotNull())
        .groupBy(as_date("uploaded_at").alias("event_date"))
        .agg(count_rows("total_tasks"), *[F.count_if(F.col(c)).alias(c) for c in TREND_FLAGS.values()])
    )
    rows = explode_features(daily, TREND_FLAGS, "feature", "feature_tasks")
    in_day = Window.partitionBy("event_date").orderBy(F.desc("feature_tasks"))
    in_feature = Window.partitionBy("feature").orderBy("event_date")
    return rows.select(
        "event_date",
        "feature",
        "feature_tasks",
        "total_tasks",
        pct("feature_tasks", "total_tasks").alias("adoption_pct"),
        F.rank().over(in_day).alias("feature_rank"),
        (F.col("feature_tasks") - F.lag("feature_tasks").over(in_feature)).alias("daily_change_tasks"),
    )


def adoption_trend_long(adoption: DataFrame) -> DataFrame:
    """Four wide daily rates to (date, feature, rate)."""
    return adoption.unpivot(["event_date"], list(ADOPTION_COLUMNS), "feature", "rate")


def adoption_totals(
    segmented: DataFrame, by: tuple[str, ...], condition: Column | None = None
) -> DataFrame:
    """Ratio of sums over any set of the segment columns."""
    rows = segmented if condition is None else segmented.where(condition)
    return rows.groupBy(*by).agg(
        F.sum("total_users").alias("total_users"),
        F.sum("adopted_users").alias("adopted_users"),
        ratio(F.sum("adopted_users"), F.sum("total_users")).alias("adoption_rate"),
    )


def first_use_totals(first_use: DataFrame, condition: Column | None = None) -> DataFrame:
    """User counts by feature, segment and days, summed over first-use dates."""
    rows = first_use if condition is None else first_use.where(condition)
    return rows.groupBy(
        "feature_name", "user_segment", "device_type", "complexity", "days_to_first_use"
    ).agg(F.sum("user_count").alias("user_count"))
