"""Agent observability: trace roll-ups, errors, latency percentiles, tokens and cost."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import count_rows, pct, ratio, running_rows, stable_round, trailing_rows
from tidemark.functions.order_stats import exact_percentiles

# --- fixed values ------------------------------------------------------------------------------
ERROR_CATEGORIES = {
    "ocr_error": "ocr",
    "timeout": "timeout",
    "api_error": "api",
    "parse_error": "parse",
}
# model: (input price, output price) in USD per million tokens
MODEL_PRICES = {
    "gpt-4o-mini-2024-07-18": (0.150, 0.600),
    "gpt-4o-2024-08-06": (2.500, 10.000),
    "claude-haiku-3.5-20241022": (0.250, 1.250),
}
DAY_PERCENTILES = {"p50_latency_ms": 0.50, "p95_latency_ms": 0.95, "p99_latency_ms": 0.99}


def spans_per_trace(spans: DataFrame) -> DataFrame:
    """Everything the run-level operators need from spans, one row per trace, in one aggregate.

    Joining runs to this frame instead of to spans keeps runs from fanning out, and a trace with
    very many spans is already collapsed map-side.
    """
    failed = F.col("status") == "error"
    kind = lambda v: F.col("span_type") == v
    latency = lambda cond: F.sum(F.when(cond, F.col("latency_ms")).otherwise(0))
    return spans.groupBy("trace_id").agg(
        F.count("span_id").alias("span_count"),
        F.count_if(kind("tool")).alias("tool_span_count"),
        F.count_if(kind("llm")).alias("llm_span_count"),
        F.count_if(failed).alias("failed_span_count"),
        latency(F.col("span_name") == "ocr_extraction").alias("ocr_latency_ms"),
        latency(kind("llm")).alias("llm_latency_ms"),
        latency(F.col("span_name") == "output_validation").alias("validation_latency_ms"),
    )


def failures_per_trace(spans: DataFrame) -> DataFrame:
    """Failed spans of each trace: their number, and the last span name and error by alphabet.

    Only failed spans are read. They are collapsed by name and error first, where labels are keys of a
    hash aggregate; the largest labels are then taken from the few rows that are left.
    """
    collapsed = (
        spans.where(F.col("status") == "error")
        .groupBy("trace_id", "span_name", "error_type")
        .agg(count_rows("spans"))
    )
    return collapsed.groupBy("trace_id").agg(
        F.sum("spans").alias("failed_span_count"),
        F.max("span_name").alias("failing_span_name"),
        F.max("error_type").alias("span_error_type"),
    )


def agent_trace_rollup(runs: DataFrame, per_trace: DataFrame) -> DataFrame:
    """One row per run with span counts by type and status and latency by stage."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return runs.join(per_trace, "trace_id", "left").select(
        "trace_id",
        "agent_run_id",
        "user_id",
        "document_id",
        F.col("started_at").alias("trace_start"),
        F.col("ended_at").alias("trace_end"),
        F.col("total_latency_ms").alias("trace_latency_ms"),
        zero("span_count"),
        zero("tool_span_count"),
        zero("llm_span_count"),
        zero("failed_span_count"),
        zero("ocr_latency_ms"),
        zero("llm_latency_ms"),
        zero("validation_latency_ms"),
        "total_input_tokens",
        "total_output_tokens",
        "estimated_cost_usd",
        "success_flag",
        "error_type",
        "model_name",
        "prompt_version",
    )


def error_category(categories: Mapping[str, str] = ERROR_CATEGORIES) -> Column:
    chain = None
    for error, label in categories.items():
        hit = F.col("error_type") == error
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.when(~F.col("success_flag"), "unknown").otherwise("none")


def agent_error_classification(runs: DataFrame, failures: DataFrame) -> DataFrame:
    """Error category of every run with the failing span and the number of failed spans."""
    failures = failures.withColumnRenamed("failed_span_count", "error_span_count")
    return runs.join(failures, "trace_id", "left").select(
        "agent_run_id",
        "trace_id",
        "task_id",
        F.col("error_type").alias("run_error_type"),
        "success_flag",
        error_category().alias("error_category"),
        "failing_span_name",
        "span_error_type",
        F.coalesce("error_span_count", F.lit(0)).alias("error_span_count"),
        "run_date",
        "total_latency_ms",
    )


def _mean(column: str) -> Column:
    return F.avg(F.col(column).cast("double"))


def _success_rate() -> Column:
    return ratio(F.count_if("success_flag"), F.count(F.lit(1)))


def _carried(means: Sequence[str], where: Column | None = None) -> dict[str, Column]:
    """Sum and row count of each column, to be turned into a mean by :func:`_carried_mean`."""
    out = {}
    for c in means:
        value = F.col(c).cast("double")
        kept = value if where is None else F.when(where, value)
        out[f"__sum_{c}"] = kept
        out[f"__rows_{c}"] = kept.isNotNull().cast("int")
    return out


def _carried_mean(column: str) -> Column:
    return ratio(f"__sum_{column}", f"__rows_{column}")


def _ones(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def agent_daily_kpis(runs: DataFrame, per_trace: DataFrame) -> DataFrame:
    """Per run date: volume, success, tool errors, retries, latency percentiles, tokens, cost."""
    failed = per_trace.select("trace_id", (F.col("failed_span_count") > 0).alias("had_failed_span"))
    joined = runs.join(failed, "trace_id", "left")
    means = {
        "retry_count": "avg_retry_count",
        "total_input_tokens": "avg_input_tokens",
        "total_output_tokens": "avg_output_tokens",
        "estimated_cost_usd": "avg_cost_per_run",
        "field_accuracy": "avg_field_accuracy",
        "manual_edit_count": "avg_manual_edit_count",
    }
    sums = {
        "total_runs": F.lit(1),
        "__success": _ones(F.col("success_flag")),
        "__failed": _ones(F.col("had_failed_span")),
        **_carried(list(means)),
    }
    # one group per calendar day
    stats = exact_percentiles(
        joined, ["run_date"], "total_latency_ms", DAY_PERCENTILES, carry=sums, bounded_groups=True
    )
    return stats.select(
        "run_date",
        "total_runs",
        ratio("__success", "total_runs").alias("agent_success_rate"),
        ratio("__failed", "total_runs").alias("tool_error_rate"),
        *DAY_PERCENTILES,
        ratio("__sum_estimated_cost_usd", "__success").alias("cost_per_successful_task"),
        *[_carried_mean(c).alias(out) for c, out in means.items()],
    )


def agent_stage_performance(spans: DataFrame, runs: DataFrame) -> DataFrame:
    """(run date, stage, span type): volume, latency, error rate and model-call tokens and cost."""
    key = ["run_date", "stage", "span_type"]
    joined = spans.select(
        "trace_id",
        F.col("span_name").alias("stage"),
        "span_type",
        "latency_ms",
        "status",
        "input_tokens",
        "output_tokens",
        "estimated_cost_usd",
    ).join(runs.select("trace_id", "run_date"), "trace_id")
    model_call = F.col("span_type") == "llm"
    means = {"input_tokens": "avg_input_tokens", "output_tokens": "avg_output_tokens", "estimated_cost_usd": "avg_cost_usd"}
    sums = {
        "span_count": F.lit(1),
        "__errors": _ones(F.col("status") == "error"),
        **_carried(["latency_ms"]),
        **_carried(list(means), model_call),
    }
    # spans meet runs once: totals travel with the collapsed latencies
    stats = exact_percentiles(
        joined, key, "latency_ms", {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95}, carry=sums
    )
    return stats.select(
        *key,
        "span_count",
        _carried_mean("latency_ms").alias("avg_latency_ms"),
        "p50_latency_ms",
        "p95_latency_ms",
        ratio("__errors", "span_count").alias("error_rate"),
        *[_carried_mean(c).alias(out) for c, out in means.items()],
    )


def error_root_cause(classified: DataFrame) -> DataFrame:
    """(run date, category, error type, failing span): count, share of the date, affected tasks."""
    key = ["run_date", "error_category", "run_error_type", "failing_span_name"]
    per_task = (
        classified.where(F.col("error_category") != "none")
        .groupBy(*key, "task_id")
        .agg(
            count_rows("n"),
            F.sum(F.when(~F.col("success_flag"), F.col("total_latency_ms"))).alias("latency"),
            F.count(F.when(~F.col("success_flag"), F.col("total_latency_ms"))).alias("latency_rows"),
        )
    )
    grouped = per_task.groupBy(*key).agg(
        F.sum("n").alias("error_count"),
        ratio(F.sum("latency"), F.sum("latency_rows")).alias("avg_failed_latency_ms"),
        F.count("task_id").alias("affected_tasks"),
    )
    of_day = F.sum("error_count").over(Window.partitionBy("run_date"))
    return grouped.select(
        *key,
        "error_count",
        ratio("error_count", of_day).alias("error_share"),
        "avg_failed_latency_ms",
        "affected_tasks",
    )


def cost_quality_tradeoff(runs: DataFrame) -> DataFrame:
    """(model, prompt): cost, accuracy, quality, cost per accuracy point, success, p95 latency."""
    key = ["model_name", "prompt_version"]
    sums = {
        "run_count": F.lit(1),
        "__success": _ones(F.col("success_flag")),
        **_carried(["estimated_cost_usd", "field_accuracy", "quality_score"]),
    }
    stats = exact_percentiles(runs, key, "total_latency_ms", {"p95_latency_ms": 0.95}, carry=sums)
    cost, accuracy = _carried_mean("estimated_cost_usd"), _carried_mean("field_accuracy")
    return stats.select(
        *key,
        "run_count",
        cost.alias("avg_cost_usd"),
        accuracy.alias("avg_field_accuracy"),
        _carried_mean("quality_score").alias("avg_quality_score"),
        ratio(cost, accuracy).alias("cost_per_accuracy_point"),
        ratio("__success", "run_count").alias("success_rate"),
        "p95_latency_ms",
    )


def model_version_comparison(runs: DataFrame) -> DataFrame:
    """(run date, model, prompt): volume, mean cost, latency, quality, token sums, success."""
    return runs.groupBy("run_date", "model_name", "prompt_version").agg(
        count_rows("run_count"),
        _mean("estimated_cost_usd").alias("avg_cost_usd"),
        _mean("total_latency_ms").alias("avg_latency_ms"),
        _mean("field_accuracy").alias("avg_field_accuracy"),
        _mean("quality_score").alias("avg_quality_score"),
        F.sum("total_input_tokens").alias("total_input_tokens"),
        F.sum("total_output_tokens").alias("total_output_tokens"),
        _mean("retry_count").alias("avg_retry_count"),
        _success_rate().alias("success_rate"),
    )


def token_cost(
    rows: DataFrame,
    input_tokens: str = "total_input_tokens",
    output_tokens: str = "total_output_tokens",
    model: str = "model_name",
    prices: Mapping[str, tuple[float, float]] = MODEL_PRICES,
    out: str = "priced_cost_usd",
) -> DataFrame:
    """Add the token cost in USD (6 decimals); an unknown model costs 0.

    The price list is part of the plan as a literal map, so there is no join.
    """
    price = lambda i: F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for m, p in prices.items() for x in (m, p[i])]), F.col(model)),
        F.lit(0.0),
    )
    cost = F.col(input_tokens) * price(0) + F.col(output_tokens) * price(1)
    return rows.withColumn(out, stable_round(cost / F.lit(1_000_000.0), 6))


def agent_success_trend(runs: DataFrame, days: int = 7) -> DataFrame:
    """Daily success, latency, cost and retries with trailing row averages."""
    daily = runs.groupBy("run_date").agg(
        count_rows("total_runs"),
        F.count_if("success_flag").alias("successful_runs"),
        pct(F.count_if("success_flag"), F.count(F.lit(1))).alias("success_rate_pct"),
        stable_round(_mean("total_latency_ms"), 2).alias("avg_latency_ms"),
        stable_round(_mean("estimated_cost_usd"), 6).alias("avg_cost_usd"),
        stable_round(_mean("retry_count"), 2).alias("avg_retry_count"),
    )
    recent = trailing_rows("run_date", days)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return daily.select(
        "run_date",
        "total_runs",
        "successful_runs",
        zero("success_rate_pct"),
        stable_round(F.avg("success_rate_pct").over(recent), 2).alias("moving_avg_7d_success_rate"),
        zero("avg_latency_ms"),
        stable_round(F.avg("avg_latency_ms").over(recent), 2).alias("moving_avg_7d_latency"),
        zero("avg_cost_usd"),
        zero("avg_retry_count"),
    )


MODEL_PERCENTILES = {
    "p50_latency_ms": 0.50,
    "p90_latency_ms": 0.90,
    "p95_latency_ms": 0.95,
    "p99_latency_ms": 0.99,
}


def latency_percentiles(runs: DataFrame) -> DataFrame:
    """(run date, model): latency percentiles, extremes, mean and spreads."""
    key = ["run_date", "model_name"]
    wanted = {**MODEL_PERCENTILES, "min_latency_ms": 0.0, "max_latency_ms": 1.0}
    known = runs.where(F.col("total_latency_ms").isNotNull())
    sums = {"total_runs": F.lit(1), **_carried(["total_latency_ms"])}
    found = exact_percentiles(known, key, "total_latency_ms", wanted, carry=sums)
    p50, p95, p99 = (F.col(f"p{n}_latency_ms") for n in (50, 95, 99))
    return found.select(
        *key,
        "total_runs",
        *[stable_round(F.col(c), 2).alias(c) for c in MODEL_PERCENTILES],
        "min_latency_ms",
        "max_latency_ms",
        stable_round(_carried_mean("total_latency_ms"), 2).alias("avg_latency_ms"),
        stable_round(p99 - p50, 2).alias("p99_to_p50_spread"),
        stable_round(ratio(p99 - p50, p50), 4).alias("relative_spread_p99_to_p50"),
        stable_round(ratio(p95 * 100.0, p50), 2).alias("p95_as_pct_of_median"),
    )


def token_cost_trend(runs: DataFrame, days: int = 7) -> DataFrame:
    """Daily tokens and cost with cumulative and trailing sums.

    Distinct users come from a (date, user) aggregate that also carries the sums, so there is one
    pass and no row copy for the distinct count.
    """
    per_user = runs.groupBy("run_date", "user_id").agg(
        count_rows("n"),
        F.sum("total_input_tokens").alias("i"),
        F.sum("total_output_tokens").alias("o"),
        F.sum(F.col("total_input_tokens") + F.col("total_output_tokens")).alias("t"),
        F.sum("estimated_cost_usd").alias("c"),
        F.count("estimated_cost_usd").alias("c_rows"),
    )
    daily = per_user.groupBy("run_date").agg(
        F.sum("n").alias("total_runs"),
        F.sum("i").alias("daily_input_tokens"),
        F.sum("o").alias("daily_output_tokens"),
        F.sum("t").alias("daily_total_tokens"),
        F.sum("c").alias("daily_cost_usd"),
        ratio(F.sum("c"), F.sum("c_rows")).alias("avg_cost"),
        F.count("user_id").alias("distinct_users"),
    )
    so_far = running_rows("run_date")
    recent = trailing_rows("run_date", days)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return daily.select(
        "run_date",
        "total_runs",
        zero("daily_input_tokens"),
        zero("daily_output_tokens"),
        zero("daily_total_tokens"),
        F.coalesce("daily_cost_usd", F.lit(0.0)).alias("daily_cost_usd"),
        F.coalesce(stable_round("avg_cost", 6), F.lit(0.0)).alias("avg_cost_per_run"),
        "distinct_users",
        F.sum("daily_total_tokens").over(so_far).alias("cum_total_tokens"),
        F.sum("daily_input_tokens").over(so_far).alias("cum_input_tokens"),
        F.sum("daily_output_tokens").over(so_far).alias("cum_output_tokens"),
        stable_round(F.sum("daily_cost_usd").over(so_far), 4).alias("cum_cost_usd"),
        stable_round(F.sum("daily_cost_usd").over(recent), 4).alias("rolling_7d_cost_usd"),
        F.when(
            F.col("daily_total_tokens") > 0, stable_round(ratio("daily_cost_usd", "daily_total_tokens"), 8)
        ).alias("cost_per_token"),
    )


def model_cost_quality(runs: DataFrame) -> DataFrame:
    """(model, prompt): cost, quality and per-dollar ratios, ranked by quality then cost."""
    key = ["model_name", "prompt_version"]
    known = runs.where(F.col("estimated_cost_usd").isNotNull() & F.col("quality_score").isNotNull())
    tokens = known.withColumn("total_tokens", F.col("total_input_tokens") + F.col("total_output_tokens"))
    # means and the digits they are shown with
    shown = {
        "total_latency_ms": ("avg_latency_ms", 2),
        "quality_score": ("avg_quality_score", 2),
        "field_accuracy": ("avg_field_accuracy", 2),
        "total_tokens": ("avg_total_tokens", 1),
        "retry_count": ("avg_retry_count", 2),
        "manual_edit_count": ("avg_manual_edit_count", 2),
        "estimated_cost_usd": ("avg_cost_usd", 6),
    }
    sums = {"run_count": F.lit(1), "successful_runs": _ones(F.col("success_flag")), **_carried(list(shown))}
    wanted = {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95}
    stats = exact_percentiles(tokens, key, "total_latency_ms", wanted, carry=sums)
    cost, quality, accuracy = (
        _carried_mean(c) for c in ("estimated_cost_usd", "quality_score", "field_accuracy")
    )
    totals = stats.select(
        *key,
        "run_count",
        "successful_runs",
        pct("successful_runs", "run_count").alias("success_rate_pct"),
        *[stable_round(_carried_mean(c), digits).alias(name) for c, (name, digits) in shown.items()],
        stable_round(ratio(cost, accuracy), 8).alias("cost_per_accuracy_point"),
        stable_round(ratio(cost, quality), 8).alias("cost_per_quality_point"),
        *wanted,
    )
    # model and prompt break ties, so the rank does not depend on row order
    best_first = Window.orderBy(
        F.col("avg_quality_score").desc_nulls_last(), "avg_cost_usd", "model_name", "prompt_version"
    )
    return totals.select(
        "*",
        stable_round(ratio(F.col("avg_quality_score") * 100.0, "avg_cost_usd"), 2).alias("quality_per_dollar"),
        stable_round(ratio(F.col("avg_field_accuracy") * 100.0, "avg_cost_usd"), 2).alias("accuracy_per_dollar"),
        F.row_number().over(best_first).alias("efficiency_rank"),
    )


def error_pareto(classified: DataFrame, cutoff: float = 80.0) -> DataFrame:
    """Failed runs by category, error type and failing span with cumulative share.

    Category names break ties. The entry that crosses the cutoff is still part of the top group.
    """
    key = ["error_category", "run_error_type", "failing_span_name"]
    counts = classified.where(~F.col("success_flag")).groupBy(*key).agg(count_rows("error_count"))
    order = [F.desc("error_count"), *[F.col(c).asc_nulls_last() for c in key]]
    everything = Window.partitionBy()
    ranked = counts.select(
        *key,
        "error_count",
        F.row_number().over(Window.orderBy(*order)).alias("rank_by_frequency"),
        F.sum("error_count").over(everything).alias("total_error_count"),
        stable_round(
            ratio(F.col("error_count") * 100.0, F.sum("error_count").over(everything)), 4
        ).alias("error_share_pct"),
        F.max("error_count").over(everything).alias("__top"),
    )
    cumulative = F.sum("error_share_pct").over(running_rows("rank_by_frequency"))
    return ranked.select(
        *key,
        "error_count",
        "rank_by_frequency",
        "error_share_pct",
        stable_round(cumulative, 4).alias("cumulative_share_pct"),
        ((cumulative <= cutoff) | (cumulative - F.col("error_share_pct") < cutoff)).alias("in_pareto_top_80"),
        "total_error_count",
        pct("error_count", "__top").alias("pct_of_most_frequent"),
    )


# ---- re-aggregation of the daily marts over a period -------------------------------------------


def _slice(mart: DataFrame, condition: Column | None) -> DataFrame:
    return mart if condition is None else mart.where(condition)


def period_error_pareto(root_cause: DataFrame, condition: Column | None = None) -> DataFrame:
    """Error categories over a period: count, share of total, cumulative share."""
    grouped = (
        _slice(root_cause, condition)
        .groupBy("error_category")
        .agg(
            F.sum("error_count").alias("error_count"),
            ratio(F.sum(F.col("error_count") * F.col("error_share")), F.sum("error_count")).alias(
                "weighted_error_share"
            ),
            F.sum("affected_tasks").alias("affected_tasks"),
            F.avg("avg_failed_latency_ms").alias("avg_failed_latency_ms"),
        )
    )
    share = ratio("error_count", F.sum("error_count").over(Window.partitionBy()))
    shared = grouped.withColumn("pct_of_total", share)
    return shared.select(
        "error_category",
        "error_count",
        "weighted_error_share",
        "pct_of_total",
        F.sum("pct_of_total").over(running_rows(F.desc("error_count"), "error_category")).alias("cumulative_pct"),
        "affected_tasks",
        "avg_failed_latency_ms",
    )


def agent_period_averages(agent_daily: DataFrame, condition: Column | None = None) -> DataFrame:
    """Means of the daily KPIs and the total number of runs."""
    names = {
        "agent_success_rate": "avg_success_rate",
        "p50_latency_ms": "avg_p50",
        "p95_latency_ms": "avg_p95",
        "p99_latency_ms": "avg_p99",
        "avg_cost_per_run": "avg_cost_per_run",
        "cost_per_successful_task": "avg_cost_per_success",
        "avg_field_accuracy": "avg_field_accuracy",
    }
    return _slice(agent_daily, condition).agg(
        *[F.avg(c).alias(out) for c, out in names.items()], F.sum("total_runs").alias("total_runs")
    )


def _reaggregate(
    mart: DataFrame, by: Sequence[str], means: Sequence[str], sums: Sequence[str], condition: Column | None
) -> DataFrame:
    return (
        _slice(mart, condition)
        .groupBy(*by)
        .agg(*[F.avg(c).alias(c) for c in means], *[F.sum(c).alias(c) for c in sums])
    )


def stage_totals(stages: DataFrame, condition: Column | None = None) -> DataFrame:
    """Stage by span type over a period: means of the daily values, summed span counts."""
    means = ["avg_latency_ms", "avg_cost_usd", "avg_input_tokens", "avg_output_tokens", "error_rate"]
    return _reaggregate(stages, ["stage", "span_type"], means, ["span_count"], condition)


def model_totals(models: DataFrame, condition: Column | None = None) -> DataFrame:
    """Model over a period: mean accuracy, summed runs."""
    return _reaggregate(models, ["model_name"], ["avg_field_accuracy"], ["run_count"], condition)


def model_prompt_totals(models: DataFrame, condition: Column | None = None) -> DataFrame:
    """Model by prompt over a period."""
    means = [
        "avg_cost_usd",
        "avg_field_accuracy",
        "avg_latency_ms",
        "success_rate",
        "avg_retry_count",
        "avg_quality_score",
    ]
    sums = ["run_count", "total_input_tokens", "total_output_tokens"]
    return _reaggregate(models, ["model_name", "prompt_version"], means, sums, condition)
