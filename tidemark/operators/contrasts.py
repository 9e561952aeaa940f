"""Baseline against affected group: one generic contrast and the standard set built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import count_rows, flag, ratio, stable_round
from tidemark.functions.order_stats import exact_percentiles


def contrast_record(
    sides: DataFrame, phenomenon: str, metric: str, baseline: str, affected: str, rises: bool
) -> DataFrame:
    """Standard record from one row with baseline_value, affected_value, baseline_n, affected_n."""
    low, high = F.col("baseline_value"), F.col("affected_value")
    difference = high - low
    moved = (high > low) if rises else (high < low)
    return sides.select(
        F.lit(phenomenon).alias("phenomenon_id"),
        F.lit(metric).alias("metric"),
        F.lit(baseline).alias("baseline_group"),
        stable_round(low, 6).alias("baseline_value"),
        F.lit(affected).alias("affected_group"),
        stable_round(high, 6).alias("affected_value"),
        stable_round(difference, 6).alias("absolute_difference"),
        stable_round(difference / F.greatest(F.abs(low), F.lit(1e-10)), 6).alias("relative_difference"),
        F.col("baseline_n"),
        F.col("affected_n"),
        F.lit("affected > baseline" if rises else "affected < baseline").alias("expected_direction"),
        F.coalesce(moved & (F.col("baseline_n") > 0) & (F.col("affected_n") > 0), F.lit(False)).alias("passed"),
    )


def contrast(
    rows: DataFrame, is_affected: Column, value: Column, phenomenon: str, metric: str, baseline: str,
    affected: str, rises: bool = True,
) -> DataFrame:
    """Mean of ``value`` by side; rows where ``is_affected`` is NULL belong to neither side."""
    sided = rows.select(is_affected.alias("hit"), value.cast("double").alias("v"))
    sides = sided.agg(
        F.avg(F.when(~F.col("hit"), F.col("v"))).alias("baseline_value"),
        F.avg(F.when(F.col("hit"), F.col("v"))).alias("affected_value"),
        F.count_if(~F.col("hit")).alias("baseline_n"),
        F.count_if("hit").alias("affected_n"),
    )
    return contrast_record(sides, phenomenon, metric, baseline, affected, rises)


def either(column: str, baseline: str, affected: str) -> Column:
    """True for the affected value, False for the baseline value, NULL for anything else."""
    return F.when(F.col(column) == affected, True).when(F.col(column) == baseline, False)


def ocr_latency(events: DataFrame, version: str = "2.3.0") -> DataFrame:
    """p95 latency of OCR events, one app version against all others."""
    ocr = events.where(F.col("event_name").isin("ocr_started", "ocr_completed")).select(
        (F.col("app_version") == version).alias("hit"), "latency_ms"
    )
    both = exact_percentiles(
        ocr, ["hit"], "latency_ms", {"p95": 0.95}, carry={"n": F.lit(1)}, bounded_groups=True
    )
    side = lambda c, hit: F.max(F.when(F.col("hit") == hit, F.col(c)))
    sides = both.agg(
        side("p95", False).alias("baseline_value"),
        side("p95", True).alias("affected_value"),
        F.coalesce(side("n", False), F.lit(0)).alias("baseline_n"),
        F.coalesce(side("n", True), F.lit(0)).alias("affected_n"),
    )
    return contrast_record(sides, "P01", "p95_ocr_latency_ms", "other_versions", f"v{version}", True)


def complex_edits(events: DataFrame, documents: DataFrame) -> DataFrame:
    """Edits per edited document, complex against simple."""
    edits = (
        events.where(F.col("event_name") == "field_edited")
        .groupBy("document_id")
        .agg(count_rows("edit_count"))
    )
    joined = edits.join(documents.select("document_id", "complexity_level"), "document_id")
    return contrast(
        joined, either("complexity_level", "simple", "complex"), F.col("edit_count"),
        "P02", "avg_edits_per_document", "simple", "complex",
    )


def mobile_export(events: DataFrame, users: DataFrame) -> DataFrame:
    """Exported over reviewed tasks, mobile against desktop."""
    tasks = (
        events.where(F.col("event_name").isin("form_review_started", "form_exported"))
        .groupBy("user_id", "task_id")
        .agg(
            F.max(flag(F.col("event_name") == "form_review_started")).alias("reviewed"),
            F.max(flag(F.col("event_name") == "form_exported")).alias("exported"),
        )
        .join(users.select("user_id", "device_type"), "user_id")
        .groupBy("device_type", "task_id")
        .agg(F.max("reviewed").alias("reviewed"), F.max("exported").alias("exported"))
    )
    total = lambda c, d: F.coalesce(F.sum(F.when(F.col("device_type") == d, F.col(c))), F.lit(0))
    sides = tasks.agg(
        total("reviewed", "desktop").alias("baseline_n"),
        total("reviewed", "mobile").alias("affected_n"),
        total("exported", "desktop").alias("__d"),
        total("exported", "mobile").alias("__m"),
    ).select(
        "baseline_n",
        "affected_n",
        ratio("__d", F.greatest(F.col("baseline_n"), F.lit(1))).alias("baseline_value"),
        ratio("__m", F.greatest(F.col("affected_n"), F.lit(1))).alias("affected_value"),
    )
    return contrast_record(sides, "P03", "review_to_export_rate", "desktop", "mobile", False)


def d7_retention(
    events: DataFrame, users: DataFrame, baseline: str = "organic", affected: str = "paid_search"
) -> DataFrame:
    """Exact day-7 retention of users with any event, by acquisition channel.

    Users whose day 7 lies after the observed range are left out.
    """
    end = events.agg(F.max("event_date")).scalar()
    days = events.select("user_id", "event_date").distinct()
    eligible = users.select(
        "user_id", "acquisition_channel", F.date_add("signup_date", 7).alias("d7")
    ).where(F.col("d7") <= end)
    per_user = (
        eligible.join(days, "user_id")
        .groupBy("user_id", "acquisition_channel")
        .agg(F.max(flag(F.col("event_date") == F.col("d7"))).alias("retained"))
    )
    return contrast(
        per_user, either("acquisition_channel", baseline, affected), F.col("retained"),
        "P04", "d7_retention_rate", baseline, affected, rises=False,
    )


def prompt_cost(runs: DataFrame, prompt: str = "v2.0.0-beta", label: str = "v1.x") -> DataFrame:
    """Cost per run of one prompt version against all others."""
    return contrast(
        runs, F.col("prompt_version") == prompt, F.col("estimated_cost_usd"),
        "P05", "avg_cost_per_run_usd", label, prompt,
    )


def group_quality(runs: DataFrame) -> DataFrame:
    """Accuracy and latency of group B against group A."""
    hit = either("experiment_group", "A", "B")
    accuracy = contrast(runs, hit, F.col("field_accuracy"), "P06", "field_accuracy", "A", "B")
    latency = contrast(runs, hit, F.col("total_latency_ms"), "P06", "avg_latency_ms", "A", "B")
    return accuracy.unionByName(latency)


def duplicate_rate(events: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Worst day's share of repeated uploads of a document against the overall share."""
    per_document = (
        events.where(F.col("event_name") == "document_uploaded")
        .groupBy("event_date", "document_id")
        .agg(F.count("event_id").alias("n"))
    )
    daily = per_document.groupBy("event_date").agg(
        F.sum("n").alias("total"), (F.sum("n") - F.count("document_id")).alias("repeats")
    )
    rated = daily.withColumn("rate", ratio("repeats", "total"))
    worst = F.max(F.struct(F.col("rate"), (-F.datediff("event_date", F.lit("1970-01-01"))).alias("o"), "event_date", "total"))
    totals = rated.agg(worst.alias("w"), F.sum("total").alias("t"), F.sum("repeats").alias("r"))
    sides = totals.select(
        stable_round(ratio("r", F.greatest(F.col("t"), F.lit(1))), 6).alias("low"),
        stable_round(F.col("w.rate"), 6).alias("high"),
        F.col("t").alias("baseline_n"),
        F.col("w.total").alias("affected_n"),
        F.col("w.event_date").alias("day"),
        (F.col("w.rate") > threshold).alias("passed"),
    )
    return sides.select(
        F.lit("P07").alias("phenomenon_id"),
        F.lit("affected_day_duplicate_rate").alias("metric"),
        F.lit("overall_rate").alias("baseline_group"),
        F.col("low").alias("baseline_value"),
        F.concat(F.lit("day_"), F.col("day").cast("string")).alias("affected_group"),
        F.col("high").alias("affected_value"),
        stable_round(F.col("high") - F.col("low"), 6).alias("absolute_difference"),
        stable_round((F.col("high") - F.col("low")) / F.greatest(F.abs("low"), F.lit(1e-10)), 6).alias(
            "relative_difference"
        ),
        "baseline_n",
        "affected_n",
        F.lit(f"affected day rate > {threshold}").alias("expected_direction"),
        F.coalesce("passed", F.lit(False)).alias("passed"),
    )


def group_contamination(assignments: DataFrame) -> DataFrame:
    """Users in one group against users in several."""
    per_user = (
        assignments.select("user_id", "experiment_group")
        .distinct()
        .groupBy("user_id")
        .agg(F.count("experiment_group").alias("k"))
    )
    sides = per_user.agg(
        F.count_if(F.col("k") == 1).alias("baseline_n"), F.count_if(F.col("k") > 1).alias("affected_n")
    ).select(
        "*", F.col("baseline_n").cast("double").alias("baseline_value"),
        F.col("affected_n").cast("double").alias("affected_value"),
    )
    record = contrast_record(sides, "P08", "users_in_multiple_groups", "clean_users", "contaminated_users", True)
    return record.withColumns(
        {"expected_direction": F.lit("contaminated > 0"), "passed": F.col("affected_n") > 0}
    )


def high_risk_retries(runs: DataFrame, documents: DataFrame) -> DataFrame:
    """Retries per run on documents with high-risk terms against the others."""
    joined = runs.select("document_id", "retry_count").join(
        documents.select("document_id", "contains_high_risk_terms"), "document_id"
    )
    return contrast(
        joined, F.col("contains_high_risk_terms"), F.col("retry_count"),
        "P09", "avg_retry_count", "low_risk", "high_risk",
    )


def export_impact(events: DataFrame, share: float = 0.20) -> DataFrame:
    """One row: how many unexported tasks had a failed run before."""
    tasks = events.where(F.col("task_id").isNotNull()).groupBy("task_id").agg(
        F.max(F.col("event_name") == "agent_run_failed").alias("failed"),
        F.max(F.col("event_name") == "form_exported").alias("exported"),
    )
    counted = tasks.agg(
        count_rows("total_tasks"),
        F.count_if("failed").alias("ocr_failed_tasks"),
        F.count_if("exported").alias("exported_tasks"),
        F.count_if(F.col("failed") & ~F.col("exported")).alias("tasks_lost_after_ocr_failure"),
        F.count_if(~F.col("exported")).alias("total_not_exported"),
    )
    at_least_one = lambda c: F.greatest(F.col(c), F.lit(1))
    lost = ratio("tasks_lost_after_ocr_failure", at_least_one("total_not_exported"))
    return counted.select(
        F.lit("P10").alias("phenomenon_id"),
        F.lit("overall_export_impact").alias("metric"),
        stable_round(ratio("ocr_failed_tasks", at_least_one("total_tasks")), 6).alias("ocr_failure_rate"),
        stable_round(ratio("exported_tasks", at_least_one("total_tasks")), 6).alias("overall_export_rate"),
        "total_tasks",
        "ocr_failed_tasks",
        "exported_tasks",
        "tasks_lost_after_ocr_failure",
        "total_not_exported",
        stable_round(lost, 6).alias("ocr_attributable_share"),
        ((lost >= share) & (F.col("ocr_failed_tasks") > 0)).alias("passed"),
    )

