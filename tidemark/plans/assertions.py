"""Assertions on the model layers. Each returns the violating rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import count_rows, in_unit_interval, is_finite, ratio
from tidemark.plans.warehouse import Warehouse

HORIZONS = (1, 7, 30)
SUMMARY_METRICS = ("avg_field_accuracy", "avg_latency_ms", "cost_per_task")
# --- fixed values: pipeline order of the milestone columns --------------------------------------
PIPELINE = (
    "uploaded_at",
    "ocr_started_at",
    "ocr_completed_at",
    "anonymization_completed_at",
    "risk_detection_completed_at",
    "autofill_completed_at",
    "review_started_at",
    "exported_at",
)


def _any(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _out_of_order(sequence: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(task, step, step time, previous step time) for neighbouring steps in the wrong order."""
    pairs = [
        F.struct(
            F.lit(later).alias("step_name"),
            F.lit(earlier).alias("previous_step"),
            F.col(later).alias("step_timestamp"),
            F.col(earlier).alias("previous_step_timestamp"),
        )
        for earlier, later in zip(columns, columns[1:], strict=False)
    ]
    rows = sequence.select("task_id", F.explode(F.array(*pairs)).alias("p")).select("task_id", "p.*")
    return rows.where(F.col("step_timestamp") < F.col("previous_step_timestamp"))


def agent_coverage_per_group(w: Warehouse) -> DataFrame:
    tasks = w.events.where(F.col("experiment_group").isin("A", "B")).select("task_id", "experiment_group").distinct()
    have = w.runs.groupBy("task_id").agg(F.count("agent_run_id").alias("runs"))
    rows = F.greatest(F.coalesce("runs", F.lit(0)), F.lit(1))
    return (
        tasks.join(have, "task_id", "left")
        .groupBy("experiment_group")
        .agg(F.sum(rows).alias("total_tasks"), F.sum(F.coalesce("runs", F.lit(0))).alias("tasks_with_agent"))
        .withColumn("coverage_rate", ratio("tasks_with_agent", "total_tasks"))
        .where(F.col("coverage_rate") <= 0.99)
    )


def _summary_not_finite() -> Column:
    return _any([F.col(m).isNotNull() & ~is_finite(m) for m in SUMMARY_METRICS])


def _summary_null() -> Column:
    return _any([F.col(m).isNull() for m in SUMMARY_METRICS])


def summary_metrics_finite(w: Warehouse) -> DataFrame:
    return w.ab_test_summary.where(_summary_not_finite()).select("experiment_group", *SUMMARY_METRICS)


def summary_metrics_non_null(w: Warehouse) -> DataFrame:
    return w.ab_test_summary.where(_summary_null()).select("experiment_group", *SUMMARY_METRICS)


def run_task_exists(w: Warehouse) -> DataFrame:
    return w.runs.select("task_id").distinct().join(w.events.select("task_id").distinct(), "task_id", "left_anti")


def run_identity_matches(w: Warehouse) -> DataFrame:
    identity = ["task_id", "user_id", "document_id"]
    product = w.events.select(*identity).distinct().toDF("task_id", "product_user", "product_doc")
    agent = w.runs.select(*identity).distinct().toDF("task_id", "agent_user", "agent_doc")
    differs = (F.col("agent_user") != F.col("product_user")) | (F.col("agent_doc") != F.col("product_doc"))
    return agent.join(product, "task_id").where(differs)


def contaminated_are_identified(w: Warehouse) -> DataFrame:
    tagged = w.clean_assignments.where("is_contaminated").select("user_id").distinct()
    return tagged.join(w.contaminated_users.select("user_id"), "user_id", "left_anti")


def cost_in_range(w: Warehouse) -> DataFrame:
    cost = F.col("estimated_cost_usd")
    bad = (cost < 0) | (cost > 100)
    one = lambda f, key, name: f.where(bad).select(
        F.lit(name).alias("table_name"), F.col(key).cast("string").alias("record_id"), "estimated_cost_usd"
    )
    return one(w.runs, "agent_run_id", "agent_runs").unionByName(one(w.spans, "span_id", "agent_spans"))


def _duplicate_dates(mart: DataFrame) -> DataFrame:
    return mart.groupBy("event_date").agg(count_rows("cnt")).where(F.col("cnt") > 1)


def daily_kpi_date_unique(w: Warehouse) -> DataFrame:
    return _duplicate_dates(w.daily_product_kpis)


def event_temporal_order(w: Warehouse) -> DataFrame:
    return _out_of_order(w.task_event_sequence, PIPELINE[1:])


def _total(frame: DataFrame, column: str) -> Column:
    return frame.agg(F.coalesce(F.sum(column), F.lit(0))).scalar()


def _delta(left: DataFrame, column: str, other: Column) -> DataFrame:
    total = left.agg(F.coalesce(F.sum(column), F.lit(0)).alias("total"))
    return total.select(F.abs(F.col("total") - other).alias("delta")).where(F.col("delta") > 1e-9)


def scorecard_matches_kpis(w: Warehouse) -> DataFrame:
    return _delta(w.executive_daily_scorecard, "north_star_metric", _total(w.daily_product_kpis, "exported_tasks"))


def scorecard_matches_funnel(w: Warehouse) -> DataFrame:
    exported = w.conversion_funnel.where(F.col("step") == "exported")
    return _delta(w.executive_daily_scorecard, "north_star_metric", _total(exported, "tasks"))


def scorecard_date_unique(w: Warehouse) -> DataFrame:
    return _duplicate_dates(w.executive_daily_scorecard)


def one_clean_assignment(w: Warehouse) -> DataFrame:
    rows = w.clean_assignments.groupBy("experiment_id", "user_id").agg(count_rows("assignment_count"))
    return rows.where(F.col("assignment_count") > 1)


def _export_without_review() -> Column:
    return F.col("did_export") & ~F.col("did_start_review")


def _export_and_abandon() -> Column:
    return F.col("did_export") & F.col("did_abandon")


def export_requires_review(w: Warehouse) -> DataFrame:
    return w.task_funnel_flags.where(_export_without_review()).select("task_id", "did_export", "did_start_review")


def timestamps_monotone(w: Warehouse) -> DataFrame:
    return _out_of_order(w.task_event_sequence, PIPELINE)


def _no_runs() -> Column:
    return F.coalesce("total_runs", F.lit(0)) == 0


def denominators_nonzero(w: Warehouse) -> DataFrame:
    return w.agent_daily_kpis.where(_no_runs()).select("run_date", "total_runs")


def no_export_abandon_conflict(w: Warehouse) -> DataFrame:
    return w.task_funnel_flags.where(_export_and_abandon()).select("task_id")


def _rates(extra: Sequence[str]) -> list[str]:
    return ["cohort_date", "acquisition_channel", *extra]


def _rate(n: int) -> Column:
    return F.col(f"d{n}_retention_rate")


def _matured_out_of_range() -> Column:
    return _any([F.col(f"d{n}_matured") & ~in_unit_interval(_rate(n)) for n in HORIZONS])


def _rate_out_of_range() -> Column:
    return _any([~in_unit_interval(_rate(n)) for n in HORIZONS])


def _known_out_of_range() -> Column:
    return _any([_rate(n).isNotNull() & ~in_unit_interval(_rate(n)) for n in HORIZONS])


def _unmatured_with_rate() -> Column:
    return _any([~F.col(f"d{n}_matured") & _rate(n).isNotNull() for n in HORIZONS])


def matured_rates_in_range(w: Warehouse) -> DataFrame:
    shown = [c for n in HORIZONS for c in (f"d{n}_matured", f"d{n}_retention_rate")]
    return w.retention_cohort.where(_matured_out_of_range()).select(*_rates(shown))


def retention_bounds(w: Warehouse) -> DataFrame:
    shown = ["eligible_users", *[f"d{n}_retained_users" for n in HORIZONS], *[f"d{n}_retention_rate" for n in HORIZONS]]
    return w.retention_cohort.where(_rate_out_of_range()).select(*_rates(shown))


def known_rates_in_unit_interval(w: Warehouse) -> DataFrame:
    return w.retention_cohort.where(_known_out_of_range()).select(*_rates([f"d{n}_retention_rate" for n in HORIZONS]))


def _span_reversed() -> Column:
    return F.col("end_time") < F.col("start_time")


def _success_unknown() -> Column:
    return F.col("success_flag").isNull()


def span_ends_after_start(w: Warehouse) -> DataFrame:
    return w.spans.where(_span_reversed()).select(
        "span_id", "trace_id", "span_name", "start_time", "end_time"
    )


def success_flag_known(w: Warehouse) -> DataFrame:
    return w.runs.where(_success_unknown()).select("agent_run_id", "trace_id", "success_flag")


def unmatured_rate_is_null(w: Warehouse) -> DataFrame:
    shown = [c for n in HORIZONS for c in (f"d{n}_matured", f"d{n}_retention_rate")]
    return w.retention_cohort.where(_unmatured_with_rate()).select(*_rates(shown))


ASSERTIONS: dict[str, Callable[[Warehouse], DataFrame]] = {
    f.__name__: f
    for f in (
        agent_coverage_per_group,
        summary_metrics_finite,
        summary_metrics_non_null,
        run_task_exists,
        run_identity_matches,
        contaminated_are_identified,
        cost_in_range,
        daily_kpi_date_unique,
        event_temporal_order,
        scorecard_matches_kpis,
        scorecard_matches_funnel,
        scorecard_date_unique,
        one_clean_assignment,
        export_requires_review,
        timestamps_monotone,
        denominators_nonzero,
        no_export_abandon_conflict,
        matured_rates_in_range,
        retention_bounds,
        known_rates_in_unit_interval,
        span_ends_after_start,
        success_flag_known,
        unmatured_rate_is_null,
    )
}


# row rules: assertion -> (model, condition of a violating row). Rules on one model are counted in a
# single pass over it.
ROW_RULES: dict[str, tuple[str, Callable[[], Column]]] = {
    "summary_metrics_finite": ("ab_test_summary", _summary_not_finite),
    "summary_metrics_non_null": ("ab_test_summary", _summary_null),
    "export_requires_review": ("task_funnel_flags", _export_without_review),
    "no_export_abandon_conflict": ("task_funnel_flags", _export_and_abandon),
    "matured_rates_in_range": ("retention_cohort", _matured_out_of_range),
    "retention_bounds": ("retention_cohort", _rate_out_of_range),
    "known_rates_in_unit_interval": ("retention_cohort", _known_out_of_range),
    "unmatured_rate_is_null": ("retention_cohort", _unmatured_with_rate),
    "denominators_nonzero": ("agent_daily_kpis", _no_runs),
    "span_ends_after_start": ("spans", _span_reversed),
    "success_flag_known": ("runs", _success_unknown),
}


def _count_rules(w: Warehouse, model: str, rules: Sequence[str]) -> DataFrame:
    totals = getattr(w, model).agg(*[F.count_if(ROW_RULES[r][1]()).alias(r) for r in rules], F.lit(0).alias("__k"))
    return totals.unpivot(["__k"], list(rules), "assertion", "violations").drop("__k")


def assertion_summary(w: Warehouse) -> DataFrame:
    """One row per assertion: name, violating rows, passed."""
    by_model: dict[str, list[str]] = {}
    for rule, (model, _) in ROW_RULES.items():
        by_model.setdefault(model, []).append(rule)
    parts = [_count_rules(w, model, rules) for model, rules in by_model.items()]
    parts += [
        check(w).agg(count_rows("violations")).select(F.lit(name).alias("assertion"), "violations")
        for name, check in ASSERTIONS.items()
        if name not in ROW_RULES
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("passed", F.col("violations") == 0)
