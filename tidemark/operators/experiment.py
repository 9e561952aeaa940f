"""Experiment assignment, user metrics, effect sizes, bootstrap, guardrails and the decision."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import as_date, count_rows, extreme_rows, null_safe_join, ratio, stable_round
from tidemark.functions.order_stats import exact_percentiles
from tidemark.functions.tails import Z_975, chi2_pvalue, normal_pvalue, t_critical, t_pvalue

# ---- assignments -------------------------------------------------------------------------------


def contaminated_ids(assignments: DataFrame) -> DataFrame:
    """Users in several groups through unflagged rows, plus users with a flagged row.

    Rows are collapsed to (user, label) before labels are counted: labels are keys and every buffer is
    of fixed width, so both steps are hash aggregates and assignments are never sorted.
    """
    flagged = F.col("is_intentional_contamination")
    regular = F.when(~flagged, F.col("experiment_group"))
    per_label = assignments.groupBy("user_id", regular.alias("__label")).agg(F.max(flagged).alias("__flagged"))
    per_user = per_label.groupBy("user_id").agg(F.max("__flagged").alias("flagged"), F.count("__label").alias("labels"))
    return per_user.where(F.col("flagged") | (F.col("labels") > 1)).select("user_id")


def clean_assignments(assignments: DataFrame) -> DataFrame:
    """Unflagged assignment rows, each tagged with whether its user is contaminated."""
    tagged = contaminated_ids(assignments).withColumn("__hit", F.lit(True))
    return (
        assignments.where(~F.col("is_intentional_contamination"))
        .join(tagged, "user_id", "left")
        .select(
            "assignment_id",
            "experiment_id",
            "user_id",
            "experiment_group",
            "assigned_at",
            F.col("__hit").isNotNull().alias("is_contaminated"),
        )
    )


def contaminated_users(assignments: DataFrame, per_assignment: bool = False) -> DataFrame:
    """Users seen in several groups with their sorted group list.

    One row per user by default; ``per_assignment`` repeats it for every assignment row of the user.
    The list holds distinct group labels, so its length is bounded by the number of groups.
    """
    groups = (
        assignments.select("user_id", "experiment_group")
        .where(F.col("experiment_group").isNotNull())
        .distinct()
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("group_count"),
            F.array_join(F.array_sort(F.collect_set("experiment_group")), ",").alias("assigned_groups"),
        )
        .where(F.col("group_count") > 1)
    )
    if per_assignment:
        rows = assignments.select("user_id", "is_intentional_contamination")
        return groups.join(rows, "user_id")
    flags = assignments.groupBy("user_id").agg(
        F.max("is_intentional_contamination").alias("is_intentional_contamination")
    )
    return groups.join(flags, "user_id")


# ---- user metrics ------------------------------------------------------------------------------


def _run_totals(runs: DataFrame) -> DataFrame:
    """Sums and counts of run metrics per task: additive, so they survive any later join grain."""
    return runs.where(F.col("task_id").isNotNull()).groupBy("task_id").agg(
        F.sum("field_accuracy").alias("acc"),
        F.count("field_accuracy").alias("acc_n"),
        F.sum("total_latency_ms").alias("lat"),
        F.count("total_latency_ms").alias("lat_n"),
        F.sum("estimated_cost_usd").alias("cost"),
        F.count(F.lit(1)).alias("run_n"),
    )


RUN_SUMS = ("acc", "acc_n", "lat", "lat_n", "cost")


def experiment_user_metrics(
    clean: DataFrame, flags: DataFrame, runs: DataFrame, start: str, end: str
) -> DataFrame:
    """Clean users with their tasks uploaded inside the experiment window and the runs of those tasks.

    The upper bound compares an upload time with midnight of the end day, so only the first instant of
    that day belongs to the window. Tasks and runs are summed per user before they meet the
    assignment row.
    """
    low, high = (F.to_timestamp_ntz(F.lit(f"{d} 00:00:00")) for d in (start, end))
    windowed = flags.where(F.col("uploaded_at").between(low, high))
    per_task = (
        windowed.groupBy("user_id", "task_id")
        .agg(F.max("did_export").alias("did_export"), count_rows("rows"))
        .join(_run_totals(runs), "task_id", "left")
    )
    per_user = per_task.groupBy("user_id").agg(
        F.count("task_id").alias("total_tasks"),
        F.count_if("did_export").alias("exported_tasks"),
        *[F.sum(F.col(n) * F.col("rows")).alias(n) for n in RUN_SUMS],
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return (
        clean.where(~F.col("is_contaminated"))
        .select("user_id", "experiment_group", "assigned_at")
        .join(per_user, "user_id", "left")
        .select(
            "user_id",
            "experiment_group",
            "assigned_at",
            F.lit(start).cast("date").alias("experiment_start_date"),
            F.lit(end).cast("date").alias("experiment_end_date"),
            zero("total_tasks"),
            zero("exported_tasks"),
            ratio("exported_tasks", "total_tasks").alias("export_rate"),
            ratio("acc", "acc_n").alias("avg_field_accuracy"),
            ratio("lat", "lat_n").alias("avg_latency_ms"),
            F.col("cost").alias("total_cost_usd"),
        )
    )


def ab_test_summary(user_metrics: DataFrame) -> DataFrame:
    """Per group: users, tasks, mean user metrics, cost and cost per task."""
    return user_metrics.groupBy("experiment_group").agg(
        F.count_distinct("user_id").alias("user_count"),
        F.sum("total_tasks").alias("total_tasks"),
        F.avg("export_rate").alias("avg_export_rate"),
        F.avg("avg_field_accuracy").alias("avg_field_accuracy"),
        F.avg("avg_latency_ms").alias("avg_latency_ms"),
        F.sum("total_cost_usd").alias("total_cost_usd"),
        ratio(F.sum("total_cost_usd"), F.sum("total_tasks")).alias("cost_per_task"),
    )


def ab_test_user_metrics(clean: DataFrame, outcomes: DataFrame, runs: DataFrame) -> DataFrame:
    """Clean users over their whole history: tasks, success, edits, duration, run quality and cost.

    A task with several runs weighs its edits and duration by its runs, as a task-to-run join
    does; the weights are applied to per-task sums instead of joining rows.
    """
    weight = F.coalesce(F.col("run_n"), F.lit(1))
    per_task = (
        outcomes.groupBy("user_id", "task_id")
        .agg(
            F.max("is_successful").alias("ok"),
            F.sum("field_edit_count").alias("edits"),
            F.count("field_edit_count").alias("edits_n"),
            F.sum("task_duration_seconds").alias("secs"),
            F.count("task_duration_seconds").alias("secs_n"),
            count_rows("rows"),
        )
        .join(_run_totals(runs), "task_id", "left")
    )
    per_user = per_task.groupBy("user_id").agg(
        F.count("task_id").alias("total_tasks"),
        F.count_if(F.col("ok") & F.col("task_id").isNotNull()).alias("successful_tasks"),
        *[F.sum(F.col(n) * weight).alias(n) for n in ("edits", "edits_n", "secs", "secs_n")],
        *[F.sum(F.col(n) * F.col("rows")).alias(n) for n in RUN_SUMS],
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    users = clean.where(~F.col("is_contaminated")).select("user_id", "experiment_group", "experiment_id").distinct()
    return users.join(per_user, "user_id", "left").select(
        "user_id",
        "experiment_group",
        "experiment_id",
        zero("total_tasks"),
        zero("successful_tasks"),
        ratio("successful_tasks", "total_tasks").alias("task_success_rate"),
        ratio("edits", "edits_n").alias("avg_field_edits"),
        ratio("secs", "secs_n").alias("avg_task_duration_s"),
        ratio("acc", "acc_n").alias("avg_field_accuracy"),
        ratio("lat", "lat_n").alias("avg_agent_latency_ms"),
        F.col("cost").alias("total_cost_usd"),
    )


def ab_test_segment_effects(clean: DataFrame, users: DataFrame, user_metrics: DataFrame) -> DataFrame:
    """(segment, channel, group): users, mean user metrics, cost per user."""
    metrics = user_metrics.select(
        "user_id", "experiment_group", "export_rate", "avg_field_accuracy", "avg_latency_ms", "total_cost_usd"
    )
    who = users.select("user_id", "user_segment", "acquisition_channel")
    return (
        clean.where(~F.col("is_contaminated"))
        .select("user_id", "experiment_group")
        .join(who, "user_id")
        .join(metrics, ["user_id", "experiment_group"], "left")
        .groupBy("user_segment", "acquisition_channel", "experiment_group")
        .agg(
            F.count_distinct("user_id").alias("user_count"),
            F.avg("export_rate").alias("avg_task_success_rate"),
            F.avg("avg_field_accuracy").alias("avg_field_accuracy"),
            F.avg("avg_latency_ms").alias("avg_agent_latency_ms"),
            ratio(F.sum("total_cost_usd"), F.count_distinct("user_id")).alias("avg_cost_per_user"),
        )
    )


def experiment_guardrails(
    clean: DataFrame, runs: DataFrame, flags: DataFrame, mode: str = "unfanned"
) -> DataFrame:
    """Per group: latency, cost, abandonment and error rate.

    ``unfanned`` weighs every run once and adds a true p95. ``fanned`` reproduces the means of a
    runs x tasks join per user, by weighting each user's sums with the other side's row count, so
    the joined rows are never built.
    """
    # a user of a group counts once, in however many experiments
    users = clean.where(~F.col("is_contaminated")).select("user_id", "experiment_group").distinct()
    per_user_runs = runs.groupBy("user_id").agg(
        count_rows("run_n"),
        F.sum("total_latency_ms").alias("lat"),
        F.count("total_latency_ms").alias("lat_n"),
        F.sum("estimated_cost_usd").alias("cost"),
        F.count("estimated_cost_usd").alias("cost_n"),
        F.count("error_type").alias("errors"),
    )
    per_user_tasks = flags.groupBy("user_id").agg(count_rows("task_n"))
    joined = users.join(per_user_runs, "user_id", "left").join(per_user_tasks, "user_id", "left")
    if mode == "fanned":
        run_weight = F.greatest(F.coalesce("task_n", F.lit(0)), F.lit(1))
        rows = F.greatest(F.coalesce("run_n", F.lit(0)), F.lit(1)) * run_weight
    else:
        run_weight, rows = F.lit(1), F.coalesce("run_n", F.lit(0))
    weigh = lambda c: F.sum(F.col(c) * run_weight)
    by_group = joined.groupBy("experiment_group").agg(
        F.count("user_id").alias("user_count"),
        ratio(weigh("lat"), weigh("lat_n")).alias("avg_latency_ms"),
        ratio(weigh("cost"), weigh("cost_n")).alias("avg_cost_per_run"),
        ratio(F.coalesce(weigh("errors"), F.lit(0)), F.sum(rows)).alias("agent_error_rate"),
    )
    left_behind = F.col("did_upload") & ~F.col("did_export")
    tasks = (
        flags.join(users, "user_id")
        .groupBy("experiment_group", "task_id")
        .agg(F.max(left_behind).alias("abandoned"))
        .groupBy("experiment_group")
        .agg(ratio(F.count_if("abandoned"), F.count("task_id")).alias("abandonment_rate"))
    )
    out = null_safe_join(by_group, tasks, ["experiment_group"], "left")
    if mode == "fanned":
        return out.select(
            "experiment_group",
            "user_count",
            F.col("avg_latency_ms").alias("avg_p95_latency_ms"),
            "avg_cost_per_run",
            "abandonment_rate",
            "agent_error_rate",
        )
    run_rows = runs.select("user_id", "total_latency_ms").join(users, "user_id")
    p95 = exact_percentiles(
        run_rows, ["experiment_group"], "total_latency_ms", {"p95_latency_ms": 0.95}, bounded_groups=True
    )
    return null_safe_join(out, p95, ["experiment_group"], "left").select(
        "experiment_group",
        "user_count",
        "avg_latency_ms",
        "p95_latency_ms",
        "avg_cost_per_run",
        "abandonment_rate",
        "agent_error_rate",
    )


# --- fixed values: readout metrics --------------------------------------------------------------
USER_METRICS = (
    "total_tasks",
    "successful_tasks",
    "task_success_rate",
    "avg_field_accuracy",
    "avg_agent_latency_ms",
    "total_cost_usd",
    "avg_field_edits",
    "avg_task_duration_s",
)


def clean_user_metrics(
    experiment_id: str, clean: DataFrame, user_metrics: DataFrame, contaminated: DataFrame
) -> DataFrame:
    """Wide per-user metrics of one experiment: contaminated users removed, NULL read as 0.

    Metrics are matched on user, group and experiment.
    """
    key = ["user_id", "experiment_group", "experiment_id"]
    users = (
        clean.where((F.col("experiment_id") == experiment_id) & ~F.col("is_contaminated"))
        .select(*key)
        .join(contaminated.select("user_id").distinct(), "user_id", "left_anti")
    )
    return users.join(user_metrics.select(*key, *USER_METRICS), key, "left").select(
        "user_id",
        "experiment_group",
        *[F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(m) for m in USER_METRICS],
    )


def long_metrics(
    wide: DataFrame, keep: Sequence[str] = ("user_id", "experiment_group"), metrics: Sequence[str] = USER_METRICS
) -> DataFrame:
    """Wide user metrics to (metric, value) rows."""
    return wide.unpivot(list(keep), list(metrics), "metric", "value")


# ---- two-group statistics ----------------------------------------------------------------------


def two_group_moments(
    rows: DataFrame, by: Sequence[str] = ("metric",), value: str = "value",
    group: str = "experiment_group", control: str = "A", treatment: str = "B",
) -> DataFrame:
    """n, mean and standard deviation of both groups per ``by``: one partial aggregate."""
    parts = []
    for side, label in (("a", control), ("b", treatment)):
        v = F.when(F.col(group) == label, F.col(value).cast("double"))
        parts += [
            F.count(v).alias(f"{side}_n"),
            F.avg(v).alias(f"{side}_mean"),
            F.stddev_samp(v).alias(f"{side}_std"),
        ]
    return rows.groupBy(*by).agg(*parts)


def _welch(moments: DataFrame) -> DataFrame:
    """Standard error and Welch-Satterthwaite degrees of freedom from the moments."""
    va = F.pow("a_std", F.lit(2.0)) / F.col("a_n")
    vb = F.pow("b_std", F.lit(2.0)) / F.col("b_n")
    denominator = F.pow(F.col("__va"), F.lit(2.0)) / (F.col("a_n") - 1) + F.pow(
        F.col("__vb"), F.lit(2.0)
    ) / (F.col("b_n") - 1)
    return (
        moments.withColumns({"__va": va, "__vb": vb, "mean_diff": F.col("b_mean") - F.col("a_mean")})
        .withColumns(
            {
                "__se": F.sqrt(F.col("__va") + F.col("__vb")),
                "__df": F.when(
                    denominator > 0, F.pow(F.col("__va") + F.col("__vb"), F.lit(2.0)) / denominator
                ).otherwise((F.least("a_n", "b_n") - 1).cast("double")),
            }
        )
        .drop("__va", "__vb")
    )


def continuous_effect(rows: DataFrame, by: Sequence[str] = ("metric",), **names: str) -> DataFrame:
    """Welch t-test, Cohen's d and 95 % interval of the mean difference, per metric.

    Groups with fewer than two users have no variance: their statistics are NULL.
    """
    base = _welch(two_group_moments(rows, by, **names).where((F.col("a_n") >= 2) & (F.col("b_n") >= 2)))
    t = F.try_divide(F.col("mean_diff"), F.col("__se"))
    pooled = F.sqrt((F.pow("a_std", F.lit(2.0)) + F.pow("b_std", F.lit(2.0))) / 2.0)
    margin = t_critical(F.lit(0.975), F.col("__df")) * F.col("__se")
    return base.select(
        *by,
        "a_n",
        "b_n",
        "a_mean",
        "b_mean",
        "a_std",
        "b_std",
        "mean_diff",
        t.alias("welch_t_stat"),
        F.col("__df").alias("welch_df"),
        t_pvalue(t, F.col("__df")).alias("welch_p_value"),
        F.when(pooled > 0, F.col("mean_diff") / pooled).otherwise(F.lit(0.0)).alias("cohens_d"),
        (F.col("mean_diff") - margin).alias("ci_lower"),
        (F.col("mean_diff") + margin).alias("ci_upper"),
    )


def binary_effect(
    rows: DataFrame, success: str, by: Sequence[str] = (), group: str = "experiment_group",
    control: str = "A", treatment: str = "B",
) -> DataFrame:
    """Risk difference, relative risk, odds ratio, pooled z-test and Wald interval."""
    sums = []
    for side, label in (("a", control), ("b", treatment)):
        here = F.col(group) == label
        sums += [
            F.count_if(here).alias(f"{side}_n"),
            F.count_if(here & F.col(success)).alias(f"{side}_success"),
        ]
    counts = rows.groupBy(*by).agg(*sums).where((F.col("a_n") > 0) & (F.col("b_n") > 0))
    return binary_effect_from_counts(counts, by)


def binary_effect_from_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """:func:`binary_effect` on rows that already hold a_n, a_success, b_n, b_success."""
    infinity = F.lit(float("inf"))
    rated = counts.withColumns(
        {
            "a_rate": ratio("a_success", "a_n"),
            "b_rate": ratio("b_success", "b_n"),
            "__oa": ratio("a_success", F.greatest(F.col("a_n") - F.col("a_success"), F.lit(1))),
            "__ob": ratio("b_success", F.greatest(F.col("b_n") - F.col("b_success"), F.lit(1))),
            "__pool": ratio(F.col("a_success") + F.col("b_success"), F.col("a_n") + F.col("b_n")),
        }
    ).withColumn("risk_difference", F.col("b_rate") - F.col("a_rate"))
    one_over = lambda c: F.lit(1.0) / F.col(c)
    pooled_se = F.sqrt(F.col("__pool") * (1.0 - F.col("__pool")) * (one_over("a_n") + one_over("b_n")))
    z = F.coalesce(F.try_divide(F.col("risk_difference"), pooled_se), F.lit(0.0))
    spread = lambda s: F.col(f"{s}_rate") * (1.0 - F.col(f"{s}_rate")) / F.col(f"{s}_n")
    margin = F.lit(Z_975) * F.sqrt(spread("a") + spread("b"))
    return rated.select(
        *by,
        "a_n",
        "b_n",
        "a_rate",
        "b_rate",
        "risk_difference",
        F.when(F.col("a_rate") > 0, F.try_divide(F.col("b_rate"), F.col("a_rate"))).otherwise(infinity).alias(
            "relative_risk"
        ),
        F.when(F.col("__oa") > 0, F.try_divide(F.col("__ob"), F.col("__oa"))).otherwise(infinity).alias(
            "odds_ratio"
        ),
        normal_pvalue(z).alias("p_value_ztest"),
        (F.col("risk_difference") - margin).alias("ci_lower"),
        (F.col("risk_difference") + margin).alias("ci_upper"),
    )


def srm_test(
    clean: DataFrame,
    experiment_id: str | None = None,
    expected: Sequence[float] = (0.5, 0.5),
    alpha: float = 0.05,
    by: Sequence[str] = (),
) -> DataFrame:
    """Sample ratio check: distinct users per group against an expected split.

    One row per (by, group) with observed and expected counts; the chi-square statistic, p-value
    and verdict repeat on every row. Shares are normalised to 1, so groups beyond the given list
    are expected to be empty; surplus shares are dropped and the rest normalised. No rows means
    nothing to fail.
    """
    rows = clean if experiment_id is None else clean.where(F.col("experiment_id") == experiment_id)
    counts = (
        rows.select(*by, "experiment_group", "user_id")
        .distinct()
        .groupBy(*by, "experiment_group")
        .agg(F.count("user_id").alias("observed"))
    )
    total_share = float(sum(expected))
    shares = F.array(*[F.lit(float(s) / total_share) for s in expected])
    whole = Window.partitionBy(*by)
    placed = counts.withColumns(
        {
            "__i": F.row_number().over(Window.partitionBy(*by).orderBy("experiment_group")),
            "__k": F.count(F.lit(1)).over(whole),
            "n_total": F.sum("observed").over(whole),
        }
    )
    given = F.coalesce(F.try_element_at(shares, F.col("__i").cast("int")), F.lit(0.0))
    shared = placed.withColumn("__share", given).withColumn(
        "__share", F.try_divide(F.col("__share"), F.sum("__share").over(whole))
    )
    expected_count = F.col("__share") * F.col("n_total")
    miss = F.pow(F.col("observed") - F.col("expected"), F.lit(2.0))
    # users in a group that was given no share are an infinite deviation
    scored = shared.withColumn("expected", expected_count).withColumn(
        "__part", F.when(F.col("expected") > 0, F.try_divide(miss, F.col("expected"))).otherwise(F.lit(float("inf")))
    )
    tested = scored.withColumn("chi2_stat", F.sum("__part").over(whole))
    p = chi2_pvalue(F.col("chi2_stat"), (F.col("__k") - 1).cast("double"))
    return tested.withColumn("p_value", p).select(
        *by,
        "experiment_group",
        "observed",
        "expected",
        "n_total",
        "chi2_stat",
        "p_value",
        F.lit(float(alpha)).alias("srm_alpha"),
        F.coalesce(F.col("p_value") >= alpha, F.lit(True)).alias("passed"),
    )


def srm_daily_inputs(clean: DataFrame, assignments: DataFrame) -> DataFrame:
    """(experiment, day, group): clean and raw users, allocation, chi-square part, flag over 1 pp."""
    key = ["experiment_id", "assignment_date", "experiment_group"]

    def users_per_day(rows: DataFrame, out: str) -> DataFrame:
        return (
            rows.select("experiment_id", as_date("assigned_at").alias("assignment_date"), "experiment_group", "user_id")
            .distinct()
            .groupBy(*key)
            .agg(F.count("user_id").alias(out))
        )

    day = Window.partitionBy("experiment_id", "assignment_date")
    counts = users_per_day(clean, "clean_user_count")
    joined = counts.join(users_per_day(assignments, "raw_user_count"), key, "left").select(
        *key,
        "clean_user_count",
        F.coalesce("raw_user_count", F.lit(0)).alias("raw_user_count"),
        F.sum("clean_user_count").over(day).alias("total_clean_users_for_experiment"),
        F.count("experiment_group").over(day).alias("__k"),
    )
    observed = ratio(F.col("clean_user_count") * 100.0, "total_clean_users_for_experiment")
    even = F.lit(100.0) / F.col("__k")
    fair = ratio("total_clean_users_for_experiment", "__k")
    return joined.where(F.col("__k") > 0).select(
        *key,
        "clean_user_count",
        "raw_user_count",
        "total_clean_users_for_experiment",
        stable_round(observed, 4).alias("observed_allocation_pct"),
        stable_round(even, 4).alias("expected_allocation_pct"),
        stable_round(observed - even, 4).alias("deviation_from_expected_pp"),
        stable_round(
            F.try_divide(F.pow(F.col("clean_user_count") - fair, F.lit(2.0)), fair), 4
        ).alias("chi_squared_contribution"),
        (F.col("raw_user_count") - F.col("clean_user_count")).alias("potentially_contaminated_users"),
        (F.abs(observed - even) > 1.0).alias("srm_flagged"),
    )


def bh_correction(tests: DataFrame, p: str, by: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    """Benjamini-Hochberg adjusted p-values and rejections inside each family ``by``.

    Input is one row per test, so the window never holds more rows than there are tests.
    """
    family = Window.partitionBy(*by)
    others = [c for c in tests.columns if c not in (*by, p)]
    ordered = family.orderBy(p, *others)
    n = F.count(F.lit(1)).over(family)
    ranked = tests.withColumns(
        {"__rank": F.row_number().over(ordered), "__raw": F.least(F.col(p) * n / F.row_number().over(ordered), F.lit(1.0))}
    )
    from_here = family.orderBy("__rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (
        ranked.withColumn("adjusted_p", F.min("__raw").over(from_here))
        .withColumn("rejected", F.col("adjusted_p") <= alpha)
        .drop("__rank", "__raw")
    )


def summary_stats(rows: DataFrame, by: Sequence[str] = ("experiment_group", "metric")) -> DataFrame:
    """Mean, deviation, quartiles, extremes and n per group and metric."""
    totals = rows.groupBy(*by).agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count("value").alias("n"),
    )
    quartiles = exact_percentiles(rows, by, "value", {"p25": 0.25, "p50": 0.50, "p75": 0.75})
    return null_safe_join(totals, quartiles, by, "left")


def guardrail_test(
    rows: DataFrame,
    margins: Mapping[str, float],
    higher_is_better: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """Non-inferiority per metric with a one-sided 95 % Welch bound.

    Lower-is-better metrics pass when the upper bound of the difference stays under
    (margin - 1) x control mean; higher-is-better metrics pass when the lower bound stays above
    (1 / margin - 1) x control mean. No data or no variance passes.
    """
    margin = F.element_at(F.create_map(*[F.lit(x) for kv in margins.items() for x in (kv[0], float(kv[1]))]), F.col("metric"))
    kept = rows.where(F.col("metric").isin(*margins))
    base = _welch(two_group_moments(kept, [*by, "metric"]))
    better = F.col("metric").isin(*higher_is_better) if higher_is_better else F.lit(False)
    usable = (F.col("a_n") > 0) & (F.col("b_n") > 0)
    varied = usable & (F.col("__se") > 0)
    reach = F.coalesce(t_critical(F.lit(0.95), F.when(varied, F.col("__df"))) * F.col("__se"), F.lit(0.0))
    bounds = base.select(
        *by,
        "metric",
        "a_n",
        "b_n",
        "a_mean",
        "b_mean",
        F.col("mean_diff").alias("diff"),
        F.when(usable, F.coalesce(ratio(F.col("mean_diff") * 100.0, "a_mean"), F.lit(0.0))).alias("diff_pct"),
        F.when(usable, F.col("mean_diff") - reach).alias("ci_lower"),
        F.when(usable, F.col("mean_diff") + reach).alias("ci_upper"),
        margin.alias("margin"),
        better.alias("higher_is_better"),
        F.coalesce(varied, F.lit(False)).alias("__varied"),
    )
    within = F.when(
        F.col("higher_is_better"), F.col("ci_lower") > (1.0 / F.col("margin") - 1.0) * F.col("a_mean")
    ).otherwise(F.col("ci_upper") < (F.col("margin") - 1.0) * F.col("a_mean"))
    return bounds.withColumn(
        "non_inferiority_passed", F.when(F.col("__varied"), within).otherwise(F.lit(True))
    ).drop("__varied")


# ---- bootstrap ---------------------------------------------------------------------------------

BOOTSTRAP_SEED = 20260616
# cumulative Poisson(1) probabilities: P(X <= k) for k = 0..11
_POISSON_1 = [
    0.36787944117144233,
    0.7357588823428847,
    0.9196986029286058,
    0.9810118431238462,
    0.9963401531726563,
    0.9994058151824183,
    0.999916758850712,
    0.9999898033696939,
    0.9999988745837053,
    0.9999998888521389,
    0.9999999900597187,
    0.9999999991763959,
]


# a uniform 32-bit number below the k-th bound has a weight of at most k
WEIGHT_BOUNDS = [math.ceil(p * 2**32) for p in _POISSON_1]
# multipliers of the 32-bit finaliser that mixes a user's key with a replicate's
MIX_1, MIX_2 = 2246822507, 3266489909
# Replicates of a user that poisson_weights draws at a time.
_DRAWN_AT_ONCE = 1000


def poisson_weights(
    users: DataFrame, iterations: int, seed: int = BOOTSTRAP_SEED, user: str = "user_id"
) -> DataFrame:
    """Every user once per replicate with a Poisson(1) weight that depends only on (seed, user, replicate).

    Users and replicates have keys, hashed once each (64 and 32 bits); a weight comes from mixing the two.
    Zero weights are dropped at once. No random generator is involved: repartitioning, retries and lost
    executors cannot change a weight.
    """
    # The rows multiply here, so they are spread first: AQE sizes tasks by input bytes and would
    # leave a small input in one task. A hash of the key keeps the planner from dropping the
    # exchange in favour of an existing partitioning by the key itself.
    session = users.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)

    def draw(names: pd.Series, starts: pd.Series) -> pd.Series:
        found = pd.Series([None] * len(names), dtype=object)
        for start in starts.unique():
            own = np.flatnonzero(starts == start)
            turns = range(int(start), min(int(start) + _DRAWN_AT_ONCE, iterations))
            for place, weights in zip(own, _weights(names.iloc[own].tolist(), turns, seed).astype(int), strict=True):
                found[place] = weights
        return found

    parts = F.explode(F.sequence(F.lit(0), F.lit(iterations - 1), F.lit(_DRAWN_AT_ONCE)))
    spread = users.repartition(tasks, F.xxhash64(user)).withColumn("__start", parts)
    drawn = F.pandas_udf(draw, "array<int>")(F.col(user).cast("string"), F.col("__start"))
    placed = spread.withColumn("__drawn", drawn).select("*", F.posexplode("__drawn").alias("__at", "weight"))
    return placed.withColumn("rep", F.col("__start") + F.col("__at")).drop("__start", "__drawn", "__at").where(F.col("weight") > 0)


# Users whose weights one task holds at a time.
_USERS_AT_ONCE = 128


def _mix(numbers: np.ndarray) -> np.ndarray:
    """The 32-bit finaliser on an array of unsigned numbers, in place; products wrap."""
    numbers ^= numbers >> np.uint32(16)
    numbers *= np.uint32(MIX_1)
    numbers ^= numbers >> np.uint32(13)
    numbers *= np.uint32(MIX_2)
    numbers ^= numbers >> np.uint32(16)
    return numbers


def _weights(users: Sequence[str | None], replicates: range, seed: int) -> np.ndarray:
    """The weights of ``poisson_weights``, users x replicates."""
    names = b"".join(md5(f"{seed}|{user or ''}".encode(), usedforsecurity=False).digest()[:8] for user in users)
    keys = np.frombuffer(names, ">u4").reshape(-1, 2).astype(np.uint32)
    stems = b"".join(md5(f"{seed}#{rep}".encode(), usedforsecurity=False).digest()[:4] for rep in replicates)
    numbers = _mix(keys[:, :1] ^ np.frombuffer(stems, ">u4").astype(np.uint32)[None, :])
    numbers += keys[:, 1:]
    numbers = _mix(numbers)
    weights = np.zeros(numbers.shape, dtype=np.uint8)
    for bound in WEIGHT_BOUNDS:
        weights += numbers >= np.uint32(bound)
    return weights.astype(float)


def _weighted_sums(metrics: Sequence[str], iterations: int, seed: int):
    """Arrow batches of (user, group, metrics) to sums per replicate and group, a fixed number of rows per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str | None, np.ndarray] = {}
        for batch in batches:
            users, groups = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), dtype=object)
            values = [batch.column(2 + i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(metrics))]
            known = [batch.column(2 + i).is_valid().to_numpy(zero_copy_only=False) for i in range(len(metrics))]
            for at in range(0, len(users), _USERS_AT_ONCE):
                chunk = slice(at, at + _USERS_AT_ONCE)
                weights = _weights(users[chunk], range(iterations), seed)
                # the sum of weights, then of each metric its weighted sum and whether it is known at all
                parts = [np.ones(len(weights))]
                for v, k in zip(values, known, strict=True):
                    parts += [np.where(k[chunk], v[chunk], 0.0), k[chunk].astype(float)]
                table = np.stack(parts, axis=1)
                for group in set(groups[chunk]):
                    own = groups[chunk] == group
                    found = weights[own].T @ table[own]
                    totals[group] = totals[group] + found if group in totals else found
        for group, found in totals.items():
            columns = [pa.array(np.arange(iterations, dtype=np.int64)), pa.array([group] * iterations, pa.string()), pa.array(found[:, 0])]
            for i in range(len(metrics)):
                columns.append(pa.array(found[:, 1 + 2 * i], mask=found[:, 2 + 2 * i] == 0))
            yield pa.RecordBatch.from_arrays(columns, names=["rep", "experiment_group", "__w", *metrics])

    return run


def _replicate_sums(compared: DataFrame, metrics: Sequence[str], iterations: int, seed: int, user: str = "user_id") -> DataFrame:
    """Sum of weights and weighted sum of each metric per (replicate, group), with the weights of ``poisson_weights``.

    A task draws the weights of its users in memory and hands on replicates x groups rows: no row per
    user and replicate exists anywhere.
    """
    session = compared.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)
    # work multiplies here, so a small input is spread first (see poisson_weights)
    narrow = compared.select(
        F.col(user).cast("string").alias("__user"), "experiment_group", *[F.col(m).cast("double").alias(m) for m in metrics]
    ).repartition(tasks, F.xxhash64("__user"))
    schema = "rep long, experiment_group string, __w double, " + ", ".join(f"`{m}` double" for m in metrics)
    return narrow.mapInArrow(_weighted_sums(list(metrics), iterations, seed), schema)


# Half the bracket around a median, in square roots of the number of users: eight standard deviations of its rank.
_BRACKET = 4.0
# Replicates whose medians one task finds at a time.
_REPLICATES_AT_ONCE = 200


def _medians_in_bracket(iterations: int, seed: int):
    """(users inside the bracket, sums of weights per replicate) of one metric, group and chunk to medians."""

    def run(inside: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        sums = sums[sums["known"] > 0].sort_values("rep")
        if sums.empty:
            return pd.DataFrame({"rep": [], "experiment_group": [], "metric": [], "stat": []})
        inside = inside.sort_values("value")
        start = int(sums["chunk"].iloc[0]) * _REPLICATES_AT_ONCE
        drawn = range(start, min(start + _REPLICATES_AT_ONCE, iterations))
        reached = np.zeros((len(inside) + 2, len(drawn)))  # weight up to the lower end, then each user inside, then the upper end
        for at in range(0, len(inside), _USERS_AT_ONCE):
            users = inside["user"].iloc[at : at + _USERS_AT_ONCE].tolist()
            reached[1 + at : 1 + at + len(users)] = _weights(users, drawn, seed)
        reached = reached[:, sums["rep"].to_numpy() - start]
        below, known = sums["below"].to_numpy(), sums["known"].to_numpy()
        reached[0] = below + sums["low_end"].to_numpy()
        reached[-1] = sums["high_end"].to_numpy()
        reached = np.cumsum(reached, axis=0)
        values = np.concatenate([sums["lo"].iloc[:1], inside["value"], sums["hi"].iloc[:1]])
        ends = []
        for rank in (np.floor((known - 1) / 2), np.ceil((known - 1) / 2)):
            if (rank < below).any() or (rank >= reached[-1]).any():
                raise ValueError("a replicate's median lies outside the bracket; widen _BRACKET")
            ends.append(values[(reached <= rank).sum(axis=0)])
        return pd.DataFrame({
            "rep": sums["rep"], "experiment_group": sums["experiment_group"], "metric": sums["metric"],
            "stat": (ends[0] + ends[1]) / 2.0,
        })

    return run


def _replicate_medians(compared: DataFrame, metrics: Sequence[str], iterations: int, seed: int, user: str = "user_id") -> DataFrame:
    """(rep, experiment_group, metric, stat): the exact weighted median of every replicate.

    The rank of a bootstrap median strays from the middle by some square roots of the number of users.
    Two order statistics bracket it; only the users strictly between them, no more than
    2 x ``_BRACKET`` x sqrt(n) per group and metric however many values tie, are sent to the tasks that
    find medians, once per chunk of replicates. Of all others the sums of weights below and at the ends of
    the bracket suffice, which ``_replicate_sums`` makes without a row per user and replicate. A median
    outside its bracket raises an error, so no result is approximate.
    """
    cell = ["metric", "experiment_group"]
    long = compared.unpivot([user, "experiment_group"], list(metrics), "metric", "value")

    def off_middle(side: int):
        def rank(n):
            middle = F.floor((n - 1) / 2.0) if side < 0 else F.ceil((n - 1) / 2.0)
            reach = F.ceil(F.sqrt(n) * _BRACKET) + 1
            return F.greatest(F.least(middle + side * reach, n - 1), F.lit(0)).cast("double")
        return rank

    brackets = exact_percentiles(long, cell, "value", {"lo": off_middle(-1), "hi": off_middle(1)})
    ends = brackets.groupBy("experiment_group").agg(
        *[F.max(F.when(F.col("metric") == m, F.struct("lo", "hi"))).alias(f"__{m}") for m in metrics])
    # at most one row per compared group
    placed = compared.join(F.broadcast(ends), "experiment_group")
    marks: dict[str, Column] = {}
    for m in metrics:
        value, lo, hi = F.col(m).cast("double"), F.col(f"__{m}")["lo"], F.col(f"__{m}")["hi"]
        marks[f"{m}__below"] = (value < lo).cast("double")
        marks[f"{m}__low_end"] = (value == lo).cast("double")
        marks[f"{m}__high_end"] = ((value == hi) & (hi > lo)).cast("double")
        marks[f"{m}__known"] = value.isNotNull().cast("double")
    drawn = _replicate_sums(placed.select(user, "experiment_group", *[c.alias(n) for n, c in marks.items()]), list(marks), iterations, seed, user)
    summed = drawn.groupBy("rep", "experiment_group").agg(*[F.sum(n).alias(n) for n in marks])
    kinds = ("below", "low_end", "high_end", "known")
    per_metric = F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), *[F.coalesce(F.col(f"{m}__{k}"), F.lit(0.0)).alias(k) for k in kinds]) for m in metrics]))
    chunk = F.floor(F.col("rep") / _REPLICATES_AT_ONCE).cast("int")
    sums = summed.select("rep", "experiment_group", chunk.alias("chunk"), per_metric.alias("__s")).select(
        "rep", "experiment_group", "chunk", "__s.*").join(brackets.select(*cell, "lo", "hi"), cell)
    candidates = F.array(*[
        F.when((F.col(m) > F.col(f"__{m}")["lo"]) & (F.col(m) < F.col(f"__{m}")["hi"]),
               F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))) for m in metrics])
    inside = placed.select(F.col(user).cast("string").alias("user"), "experiment_group", F.explode(F.array_compact(candidates)).alias("__c"))
    chunks = F.explode(F.sequence(F.lit(0), F.lit((iterations - 1) // _REPLICATES_AT_ONCE)))
    inside = inside.select("user", "experiment_group", "__c.metric", "__c.value", chunks.alias("chunk"))
    key = [*cell, "chunk"]
    return inside.groupBy(*key).cogroup(sums.groupBy(*key)).applyInPandas(
        _medians_in_bracket(iterations, seed), "rep long, experiment_group string, metric string, stat double")


def _replicate_diffs(
    wide: DataFrame, metrics: Sequence[str], iterations: int, seed: int, statistic: str,
    control: str, treatment: str,
) -> DataFrame:
    """(metric, rep, diff): the statistic of treatment minus control in every replicate."""
    compared = wide.where(F.col("experiment_group").isin(control, treatment))
    if statistic == "mean":
        # all metrics share the weights: one pass
        drawn = _replicate_sums(compared, metrics, iterations, seed)
        sums = drawn.groupBy("rep", "experiment_group").agg(*[F.sum(m).alias(m) for m in metrics], F.sum("__w").alias("__w"))
        sums = sums.where(F.col("__w") > 0)
        per_group = sums.select(
            "rep", "experiment_group", *[ratio(m, "__w").alias(m) for m in metrics]
        ).unpivot(["rep", "experiment_group"], list(metrics), "metric", "stat")
    else:
        per_group = _replicate_medians(compared, metrics, iterations, seed)
    side = lambda g: F.max(F.when(F.col("experiment_group") == g, F.col("stat")))
    return per_group.groupBy("metric", "rep").agg((side(treatment) - side(control)).alias("diff"))


def bootstrap_diff(
    wide: DataFrame,
    metrics: Sequence[str] = USER_METRICS,
    iterations: int = 5000,
    seed: int = BOOTSTRAP_SEED,
    statistic: str = "mean",
    control: str = "A",
    treatment: str = "B",
) -> DataFrame:
    """Bootstrap the difference of a user-level mean or median between two groups.

    Users, not events, are resampled. Output per metric: observed difference, bias-corrected
    estimate, standard error and 95 % percentile interval. The final percentile runs over
    ``iterations`` rows per metric.
    """
    diffs = _replicate_diffs(wide, metrics, iterations, seed, statistic, control, treatment)
    replicated = diffs.groupBy("metric").agg(
        F.avg("diff").alias("bootstrap_mean"),
        F.stddev_samp("diff").alias("std_err"),
        F.percentile("diff", F.array(F.lit(0.025), F.lit(0.975))).alias("__ci"),
        F.count("diff").alias("replicates"),
    )
    long = wide.unpivot(["user_id", "experiment_group"], list(metrics), "metric", "value")
    if statistic == "mean":
        per_group = long.groupBy("metric", "experiment_group").agg(F.avg("value").alias("stat"))
    else:
        per_group = exact_percentiles(long, ["metric", "experiment_group"], "value", {"stat": 0.5})
    side = lambda g: F.max(F.when(F.col("experiment_group") == g, F.col("stat")))
    observed = per_group.groupBy("metric").agg((side(treatment) - side(control)).alias("observed_diff"))
    return observed.join(replicated, "metric").select(
        "metric",
        "observed_diff",
        "bootstrap_mean",
        (2.0 * F.col("observed_diff") - F.col("bootstrap_mean")).alias("estimate"),
        "std_err",
        F.col("__ci")[0].alias("ci_lower"),
        F.col("__ci")[1].alias("ci_upper"),
        "replicates",
        F.lit(seed).alias("seed"),
    )


# ---- decision and readout ----------------------------------------------------------------------

SEVERE_DEGRADATION_PCT = 50.0


def experiment_decision(
    srm: DataFrame,
    primary: DataFrame,
    guardrails: DataFrame,
    alpha: float = 0.05,
    data_validation_passed: bool = True,
) -> DataFrame:
    """One row: the decision and what it rests on.

    Order: sample ratio or data validation failure, severe guardrail harm, primary result.
    ``primary`` has one row with p_value and effect.
    """
    failed = ~F.col("non_inferiority_passed")
    guard = guardrails.agg(
        F.count_if(failed).alias("guardrail_failures"),
        F.count_if(
            failed & (F.abs(F.coalesce("diff_pct", F.lit(0.0))) >= SEVERE_DEGRADATION_PCT)
        ).alias("severe_failures"),
    )
    srm_ok = srm.agg(F.coalesce(F.min("passed"), F.lit(True))).scalar()
    measured = primary.agg(F.max("p_value").alias("p_value"), F.max("effect").alias("effect"), count_rows("n"))
    base = guard.select(
        srm_ok.alias("srm_passed"),
        F.lit(data_validation_passed).alias("data_validation_passed"),
        "guardrail_failures",
        "severe_failures",
        measured.select("p_value").scalar().alias("p_value"),
        measured.select("effect").scalar().alias("effect"),
        measured.select("n").scalar().alias("__n"),
    )
    significant = F.coalesce(F.col("p_value") < alpha, F.lit(False))
    positive = F.coalesce(F.col("effect") > 0, F.lit(False))
    decision = (
        F.when(~F.col("srm_passed") | ~F.col("data_validation_passed"), "INCONCLUSIVE")
        .when(F.col("severe_failures") > 0, "STOP_FOR_HARM")
        .when(F.col("__n") == 0, "INCONCLUSIVE")
        .when(significant & positive & (F.col("guardrail_failures") > 0), "SHIP_WITH_MONITORING")
        .when(significant & positive, "SHIP")
        .when(~significant, "CONTINUE_EXPERIMENT")
        .otherwise("INCONCLUSIVE")
    )
    return base.select(
        decision.alias("decision"),
        "srm_passed",
        "data_validation_passed",
        significant.alias("primary_significant"),
        "p_value",
        "effect",
        "guardrail_failures",
        "severe_failures",
    )


def experiment_readout(
    wide: DataFrame,
    clean: DataFrame,
    experiment_id: str,
    primary: str = "task_success_rate",
    guardrails: Mapping[str, float] | None = None,
    higher_is_better: Sequence[str] = ("avg_field_accuracy", "task_success_rate"),
    iterations: int = 5000,
    alpha: float = 0.05,
    srm_alpha: float = 0.05,
) -> dict[str, DataFrame]:
    """All parts of the readout as frames, plus ``long``: one metric x statistic table."""
    guardrails = guardrails or {"avg_agent_latency_ms": 1.15, "total_cost_usd": 1.15, "avg_field_accuracy": 1.05}
    rows = long_metrics(wide)
    effects = continuous_effect(rows)
    secondary = bh_correction(
        effects.where(F.col("metric") != primary).select("metric", F.col("welch_p_value").alias("p_value")),
        "p_value",
        alpha=alpha,
    )
    guards = guardrail_test(rows, guardrails, higher_is_better)
    srm = srm_test(clean, experiment_id, alpha=srm_alpha)
    main = effects.where(F.col("metric") == primary).select(
        F.col("welch_p_value").alias("p_value"), F.col("mean_diff").alias("effect")
    )
    boot = bootstrap_diff(wide, iterations=iterations)
    parts = {
        "srm": srm,
        "effects": effects,
        "secondary": secondary,
        "guardrails": guards,
        "bootstrap": boot,
        "summary": summary_stats(rows),
        "decision": experiment_decision(srm, main, guards, alpha),
    }
    effect_stats = ["a_mean", "b_mean", "mean_diff", "welch_t_stat", "welch_p_value", "cohens_d", "ci_lower", "ci_upper"]
    boot_stats = ["observed_diff", "estimate", "std_err", "ci_lower", "ci_upper"]
    tagged = lambda df, part, stats: df.unpivot(["metric"], stats, "statistic", "value").select(
        F.lit(part).alias("part"), "metric", "statistic", "value"
    )
    passed = guards.select("metric", "diff", "diff_pct", F.col("non_inferiority_passed").cast("double").alias("passed"))
    parts["long"] = (
        tagged(effects, "welch", effect_stats)
        .unionByName(tagged(boot, "bootstrap", boot_stats))
        .unionByName(tagged(secondary, "multiplicity", ["p_value", "adjusted_p"]))
        .unionByName(tagged(passed, "guardrail", ["diff", "diff_pct", "passed"]))
    )
    return parts


# ---- checks on the experiment population -------------------------------------------------------


def randomization_balance(
    clean: DataFrame,
    users: DataFrame,
    dimensions: Sequence[str] = ("device_type", "acquisition_channel", "user_segment"),
    limit: float = 0.1,
) -> DataFrame:
    """Per dimension value: share in each group and the standardised mean difference of its indicator."""
    who = clean.where(~F.col("is_contaminated")).select("user_id", "experiment_group").distinct()
    joined = who.join(users.select("user_id", *dimensions), "user_id")
    long = joined.unpivot(["user_id", "experiment_group"], list(dimensions), "dimension", "level")
    here = lambda g: F.count_if(F.col("experiment_group") == g)
    counts = long.groupBy("dimension", "level").agg(here("A").alias("a"), here("B").alias("b"))
    whole = Window.partitionBy("dimension")
    sized = counts.withColumns({"a_n": F.sum("a").over(whole), "b_n": F.sum("b").over(whole)})
    pa, pb = ratio("a", "a_n"), ratio("b", "b_n")
    smd = F.coalesce(F.try_divide(pa - pb, F.sqrt((pa * (1.0 - pa) + pb * (1.0 - pb)) / 2.0)), F.lit(0.0))
    return sized.select(
        "dimension",
        "level",
        "a_n",
        "b_n",
        pa.alias("a_share"),
        pb.alias("b_share"),
        smd.alias("smd"),
        F.when(F.abs(smd) < limit, "balanced").otherwise("imbalanced").alias("status"),
    )


def population_check(assignments: DataFrame, contaminated: DataFrame, user_metrics: DataFrame) -> DataFrame:
    """Assignment rows, users, clean users by first group, contaminated and users without outcomes."""
    first = assignments.groupBy("user_id").agg(
        count_rows("rows"),
        F.min_by("experiment_group", F.struct("assigned_at", "assignment_id")).alias("first_group"),
    )
    bad = contaminated.select("user_id").distinct().withColumn("__bad", F.lit(True))
    seen = user_metrics.where(F.col("total_tasks") > 0).select("user_id").distinct().withColumn("__seen", F.lit(True))
    joined = first.join(bad, "user_id", "left").join(seen, "user_id", "left")
    clean = F.col("__bad").isNull()
    return joined.agg(
        F.sum("rows").alias("raw_assignment_rows"),
        count_rows("unique_assigned_users"),
        F.count("first_group").alias("canonical_first_assignment_users"),
        F.count_if(clean).alias("clean_itt_users"),
        F.count_if(clean & (F.col("first_group") == "A")).alias("clean_itt_a_n"),
        F.count_if(clean & (F.col("first_group") == "B")).alias("clean_itt_b_n"),
        F.count_if(~clean).alias("contaminated_users"),
        F.count_if(clean & F.col("__seen").isNotNull()).alias("users_with_outcomes"),
        F.count_if(clean & F.col("__seen").isNull()).alias("missing_outcome_users"),
    )


def latest_assignment_metrics(
    clean: DataFrame, user_metrics: DataFrame, as_of: Column, control: str = "A"
) -> DataFrame:
    """Latest clean assignment of each (experiment, user) with derived ratios."""
    latest = extreme_rows(
        clean.where(~F.col("is_contaminated")),
        ["experiment_id", "user_id"], ["assigned_at", "assignment_id"], ["experiment_group"], largest=True,
    ).drop("assignment_id")
    metrics = user_metrics.groupBy("user_id", "experiment_group").agg(
        *[
            F.max(c).alias(c)
            for c in (
                "total_tasks",
                "exported_tasks",
                "export_rate",
                "avg_field_accuracy",
                "avg_latency_ms",
                "total_cost_usd",
            )
        ]
    )
    return latest.join(metrics, ["user_id", "experiment_group"], "left").select(
        "experiment_id",
        "user_id",
        "experiment_group",
        "assigned_at",
        "total_tasks",
        "exported_tasks",
        stable_round("export_rate", 4).alias("export_rate"),
        stable_round("avg_field_accuracy", 2).alias("avg_field_accuracy"),
        stable_round("avg_latency_ms", 2).alias("avg_latency_ms"),
        stable_round("total_cost_usd", 6).alias("total_cost_usd"),
        ratio("exported_tasks", "total_tasks").alias("task_success_rate"),
        stable_round(F.col("avg_latency_ms") * F.col("exported_tasks"), 2).alias("total_latency_cost"),
        F.when(
            F.col("exported_tasks") > 0, stable_round(ratio("total_cost_usd", "exported_tasks"), 8)
        ).alias("cost_per_successful_task"),
        F.when(F.col("experiment_group") == control, 0).otherwise(1).alias("is_treatment"),
        F.datediff(as_of, as_date("assigned_at")).alias("days_since_assignment"),
    )


def agent_metric_coverage(events: DataFrame, runs: DataFrame, groups: Sequence[str] = ("A", "B")) -> DataFrame:
    """Per group: distinct tasks and distinct runs attached to them."""
    tasks = (
        events.where(F.col("experiment_group").isin(*groups))
        .select("experiment_group", "task_id")
        .distinct()
    )
    attached = runs.where(F.col("task_id").isNotNull()).groupBy("task_id").agg(
        F.count("agent_run_id").alias("runs")
    )
    return (
        tasks.join(attached, "task_id", "left")
        .groupBy("experiment_group")
        .agg(
            F.count("task_id").alias("total_tasks"),
            F.coalesce(F.sum("runs"), F.lit(0)).alias("tasks_with_agent"),
        )
    )


def experiment_sizes(clean: DataFrame, contaminated: DataFrame) -> DataFrame:
    """Assignment period, clean rows per group and number of contaminated users."""
    return clean.agg(
        F.min("assigned_at").alias("experiment_start"),
        F.max("assigned_at").alias("experiment_end"),
        F.count_if(F.col("experiment_group") == "A").alias("clean_a"),
        F.count_if(F.col("experiment_group") == "B").alias("clean_b"),
    ).withColumn("contaminated", contaminated.agg(F.count(F.lit(1))).scalar())


def metric_histogram(
    rows: DataFrame, value: str, by: Sequence[str] = ("experiment_group",), bins: int = 40,
    weight: str | None = None,
) -> DataFrame:
    """Counts per (by, bin) with equal bins between the overall minimum and maximum; NULLs dropped."""
    known = rows.where(F.col(value).isNotNull())
    number = F.col(value).cast("double")
    low = known.agg(F.min(number)).scalar()
    high = known.agg(F.max(number)).scalar()
    framed = known.withColumns({"__lo": low, "__width": (high - low) / F.lit(float(bins))})
    position = F.floor((number - F.col("__lo")) / F.col("__width"))
    index = F.when(F.col("__width") > 0, F.least(position, F.lit(bins - 1))).otherwise(F.lit(0))
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    return (
        framed.groupBy(*by, index.cast("int").alias("bin"))
        .agg(amount.alias("n"), F.first("__lo").alias("__lo"), F.first("__width").alias("__width"))
        .select(
            *by,
            "bin",
            (F.col("__lo") + F.col("bin") * F.col("__width")).alias("bin_start"),
            (F.col("__lo") + (F.col("bin") + 1) * F.col("__width")).alias("bin_end"),
            "n",
        )
    )
