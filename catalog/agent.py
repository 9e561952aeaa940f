"""Agent observability on both bindings: task runs and order traces."""

from __future__ import annotations

from catalog.registry import register
from tidemark.operators import agents

ROLLUP = "SELECT * FROM rollup"
CLASSIFIED = "SELECT * FROM classified"
DAILY = """agent_success_rate tool_error_rate avg_retry_count p50_latency_ms p95_latency_ms p99_latency_ms avg_input_tokens
 avg_output_tokens avg_cost_per_run cost_per_successful_task avg_field_accuracy avg_manual_edit_count"""
STAGE = "avg_latency_ms p50_latency_ms p95_latency_ms error_rate avg_input_tokens avg_output_tokens avg_cost_usd"

register("agent_trace_rollup", lambda w: w.agent_trace_rollup, ROLLUP, "estimated_cost_usd", binding="traces")
register(
    "agent_error_classification",
    lambda w: w.agent_error_classification.drop("run_date", "total_latency_ms"),
    CLASSIFIED,
    binding="traces",
)
register("agent_daily_kpis", lambda w: w.agent_daily_kpis, "SELECT * FROM agent_kpis", DAILY, binding="traces")
register("agent_daily_kpis_task_runs", lambda w: w.agent_daily_kpis, "SELECT * FROM agent_kpis", DAILY)
register("agent_stage_performance", lambda w: w.agent_stage_performance, "SELECT * FROM stage_perf", STAGE, binding="traces")
register("agent_stage_performance_task_runs", lambda w: w.agent_stage_performance, "SELECT * FROM stage_perf", STAGE)
register(
    "error_root_cause", lambda w: w.error_root_cause, "SELECT * FROM root_cause", "error_share avg_failed_latency_ms",
    binding="traces",
)
register(
    "cost_quality_tradeoff",
    lambda w: w.cost_quality_tradeoff,
    """SELECT model_name, prompt_version, count(*) AS run_count, avg(estimated_cost_usd) AS avg_cost_usd,
              avg(field_accuracy) AS avg_field_accuracy, avg(quality_score) AS avg_quality_score,
              avg(estimated_cost_usd) / nullif(avg(field_accuracy), 0) AS cost_per_accuracy_point,
              avg(success_flag::INT) AS success_rate, quantile_cont(total_latency_ms, 0.95) AS p95_latency_ms
       FROM runs GROUP BY ALL""",
    "avg_cost_usd avg_field_accuracy avg_quality_score cost_per_accuracy_point success_rate p95_latency_ms",
    binding="traces",
)
register(
    "model_version_comparison", lambda w: w.model_version_comparison, "SELECT * FROM model_cmp",
    "avg_cost_usd avg_latency_ms avg_field_accuracy avg_quality_score avg_retry_count success_rate", binding="traces",
)
register(
    "token_cost",
    lambda w: agents.token_cost(w.runs).select(
        "agent_run_id", "model_name", "total_input_tokens", "total_output_tokens", "priced_cost_usd"
    ),
    """SELECT agent_run_id, model_name, total_input_tokens, total_output_tokens,
              round((total_input_tokens * CASE model_name WHEN 'gpt-4o-mini-2024-07-18' THEN 0.15::DOUBLE
                         WHEN 'gpt-4o-2024-08-06' THEN 2.5::DOUBLE WHEN 'claude-haiku-3.5-20241022' THEN 0.25::DOUBLE ELSE 0 END
                     + total_output_tokens * CASE model_name WHEN 'gpt-4o-mini-2024-07-18' THEN 0.6::DOUBLE
                         WHEN 'gpt-4o-2024-08-06' THEN 10::DOUBLE WHEN 'claude-haiku-3.5-20241022' THEN 1.25::DOUBLE ELSE 0 END)
                    / 1000000.0, 6) AS priced_cost_usd FROM runs""",
    "priced_cost_usd",
)
register(
    "agent_success_trend",
    lambda w: agents.agent_success_trend(w.runs),
    """WITH d AS (
           SELECT run_date, count(*) AS total_runs, count(*) FILTER (success_flag) AS successful_runs,
                  round(count(*) FILTER (success_flag) * 100.0 / count(*), 2) AS success_rate_pct,
                  round(avg(total_latency_ms), 2) AS avg_latency_ms, round(avg(estimated_cost_usd), 6) AS avg_cost_usd,
                  round(avg(retry_count), 2) AS avg_retry_count FROM runs GROUP BY 1)
       SELECT run_date, total_runs, successful_runs, success_rate_pct,
              round(avg(success_rate_pct) OVER o, 2) AS moving_avg_7d_success_rate, avg_latency_ms,
              round(avg(avg_latency_ms) OVER o, 2) AS moving_avg_7d_latency, avg_cost_usd, avg_retry_count
       FROM d WINDOW o AS (ORDER BY run_date ROWS 6 PRECEDING)""",
    "success_rate_pct moving_avg_7d_success_rate avg_latency_ms moving_avg_7d_latency avg_cost_usd avg_retry_count",
    binding="traces",
)
register(
    "latency_percentiles",
    lambda w: agents.latency_percentiles(w.runs),
    """WITH q AS (SELECT run_date, model_name, count(*) AS total_runs, quantile_cont(total_latency_ms, 0.5) AS a,
                  quantile_cont(total_latency_ms, 0.9) AS b, quantile_cont(total_latency_ms, 0.95) AS c,
                  quantile_cont(total_latency_ms, 0.99) AS d, min(total_latency_ms) AS lo, max(total_latency_ms) AS hi,
                  avg(total_latency_ms) AS m FROM runs WHERE total_latency_ms IS NOT NULL GROUP BY ALL)
       SELECT run_date, model_name, total_runs, round(a, 2) AS p50_latency_ms, round(b, 2) AS p90_latency_ms,
              round(c, 2) AS p95_latency_ms, round(d, 2) AS p99_latency_ms, lo AS min_latency_ms, hi AS max_latency_ms,
              round(m, 2) AS avg_latency_ms, round(d - a, 2) AS p99_to_p50_spread,
              round((d - a) / nullif(a, 0), 4) AS relative_spread_p99_to_p50,
              round(c * 100.0 / nullif(a, 0), 2) AS p95_as_pct_of_median FROM q""",
    "p50_latency_ms p90_latency_ms p95_latency_ms p99_latency_ms min_latency_ms max_latency_ms avg_latency_ms "
    "p99_to_p50_spread relative_spread_p99_to_p50 p95_as_pct_of_median",
    binding="traces",
)
register(
    "token_cost_trend",
    lambda w: agents.token_cost_trend(w.runs),
    """WITH d AS (SELECT run_date, count(*) AS total_runs, sum(total_input_tokens)::BIGINT AS i, sum(total_output_tokens)::BIGINT AS o,
                  sum(total_input_tokens + total_output_tokens)::BIGINT AS t, sum(estimated_cost_usd) AS c,
                  avg(estimated_cost_usd) AS m, count(DISTINCT user_id) AS distinct_users FROM runs GROUP BY 1)
       SELECT run_date, total_runs, i AS daily_input_tokens, o AS daily_output_tokens, t AS daily_total_tokens,
              c AS daily_cost_usd, round(m, 6) AS avg_cost_per_run, distinct_users,
              sum(t) OVER w AS cum_total_tokens, sum(i) OVER w AS cum_input_tokens, sum(o) OVER w AS cum_output_tokens,
              round(sum(c) OVER w, 4) AS cum_cost_usd,
              round(sum(c) OVER (ORDER BY run_date ROWS 6 PRECEDING), 4) AS rolling_7d_cost_usd,
              CASE WHEN t > 0 THEN round(c / t, 8) END AS cost_per_token
       FROM d WINDOW w AS (ORDER BY run_date ROWS UNBOUNDED PRECEDING)""",
    "daily_cost_usd avg_cost_per_run cum_cost_usd rolling_7d_cost_usd cost_per_token",
    "cum_total_tokens cum_input_tokens cum_output_tokens",
    binding="traces",
    digits=4,
)
register(
    "model_cost_quality",
    lambda w: agents.model_cost_quality(w.runs),
    """WITH m AS (
           SELECT model_name, prompt_version, count(*) AS run_count, count(*) FILTER (success_flag) AS successful_runs,
                  round(count(*) FILTER (success_flag) * 100.0 / count(*), 2) AS success_rate_pct,
                  round(avg(estimated_cost_usd), 6) AS avg_cost_usd, round(avg(total_latency_ms), 2) AS avg_latency_ms,
                  round(avg(quality_score), 2) AS avg_quality_score, round(avg(field_accuracy), 2) AS avg_field_accuracy,
                  round(avg(total_input_tokens + total_output_tokens), 1) AS avg_total_tokens,
                  round(avg(retry_count), 2) AS avg_retry_count, round(avg(manual_edit_count), 2) AS avg_manual_edit_count,
                  round(avg(estimated_cost_usd) / nullif(avg(field_accuracy), 0), 8) AS cost_per_accuracy_point,
                  round(avg(estimated_cost_usd) / nullif(avg(quality_score), 0), 8) AS cost_per_quality_point,
                  quantile_cont(total_latency_ms, 0.5) AS p50_latency_ms, quantile_cont(total_latency_ms, 0.95) AS p95_latency_ms
           FROM runs WHERE estimated_cost_usd IS NOT NULL AND quality_score IS NOT NULL GROUP BY ALL)
       SELECT *, round(avg_quality_score * 100.0 / nullif(avg_cost_usd, 0), 2) AS quality_per_dollar,
              round(avg_field_accuracy * 100.0 / nullif(avg_cost_usd, 0), 2) AS accuracy_per_dollar,
              row_number() OVER (ORDER BY avg_quality_score DESC, avg_cost_usd, model_name, prompt_version) AS efficiency_rank FROM m""",
    "success_rate_pct avg_cost_usd avg_latency_ms avg_quality_score avg_field_accuracy avg_total_tokens avg_retry_count "
    "avg_manual_edit_count cost_per_accuracy_point cost_per_quality_point p50_latency_ms p95_latency_ms quality_per_dollar "
    "accuracy_per_dollar",
    binding="traces",
)
register(
    "error_pareto",
    lambda w: agents.error_pareto(w.agent_error_classification),
    """WITH e AS (SELECT error_category, run_error_type, failing_span_name, count(*) AS error_count FROM classified
                  WHERE NOT success_flag GROUP BY ALL),
            r AS (SELECT *, row_number() OVER (ORDER BY error_count DESC, error_category NULLS LAST, run_error_type NULLS LAST,
                                               failing_span_name NULLS LAST) AS rank_by_frequency,
                         sum(error_count) OVER () AS total_error_count,
                         round(error_count * 100.0 / sum(error_count) OVER (), 4) AS error_share_pct,
                         max(error_count) OVER () AS top FROM e),
            c AS (SELECT *, sum(error_share_pct) OVER (ORDER BY rank_by_frequency ROWS UNBOUNDED PRECEDING) AS cum FROM r)
       SELECT error_category, run_error_type, failing_span_name, error_count, rank_by_frequency, error_share_pct,
              round(cum, 4) AS cumulative_share_pct, cum <= 80 OR cum - error_share_pct < 80 AS in_pareto_top_80,
              total_error_count, round(error_count * 100.0 / top, 2) AS pct_of_most_frequent FROM c""",
    "error_share_pct cumulative_share_pct pct_of_most_frequent",
    "total_error_count",
    binding="traces",
)

# ---- period re-aggregation ---------------------------------------------------------------------
register(
    "period_error_pareto",
    lambda w: agents.period_error_pareto(w.error_root_cause),
    """WITH g AS (SELECT error_category, sum(x.error_count)::BIGINT AS error_count,
                  sum(x.error_count * error_share) / sum(x.error_count) AS weighted_error_share,
                  sum(x.affected_tasks)::BIGINT AS affected_tasks, avg(x.avg_failed_latency_ms) AS avg_failed_latency_ms
                  FROM root_cause x GROUP BY 1),
            p AS (SELECT *, error_count / sum(error_count) OVER () AS pct_of_total FROM g)
       SELECT *, sum(pct_of_total) OVER (ORDER BY error_count DESC, error_category ROWS UNBOUNDED PRECEDING) AS cumulative_pct FROM p""",
    "weighted_error_share pct_of_total cumulative_pct avg_failed_latency_ms",
    binding="traces",
)
register(
    "agent_period_averages",
    lambda w: agents.agent_period_averages(w.agent_daily_kpis),
    """SELECT avg(agent_success_rate) AS avg_success_rate, avg(p50_latency_ms) AS avg_p50, avg(p95_latency_ms) AS avg_p95,
              avg(p99_latency_ms) AS avg_p99, avg(avg_cost_per_run) AS avg_cost_per_run,
              avg(cost_per_successful_task) AS avg_cost_per_success, avg(avg_field_accuracy) AS avg_field_accuracy,
              sum(total_runs)::BIGINT AS total_runs FROM agent_kpis""",
    "avg_success_rate avg_p50 avg_p95 avg_p99 avg_cost_per_run avg_cost_per_success avg_field_accuracy",
    binding="traces",
)
register(
    "stage_totals",
    lambda w: agents.stage_totals(w.agent_stage_performance),
    """SELECT stage, span_type, avg(avg_latency_ms) AS avg_latency_ms, avg(avg_cost_usd) AS avg_cost_usd,
              avg(avg_input_tokens) AS avg_input_tokens, avg(avg_output_tokens) AS avg_output_tokens,
              avg(error_rate) AS error_rate, sum(span_count)::BIGINT AS span_count FROM stage_perf GROUP BY ALL""",
    "avg_latency_ms avg_cost_usd avg_input_tokens avg_output_tokens error_rate",
    binding="traces",
)
register(
    "model_totals",
    lambda w: agents.model_totals(w.model_version_comparison),
    """SELECT model_name, avg(avg_field_accuracy) AS avg_field_accuracy, sum(run_count)::BIGINT AS run_count
       FROM model_cmp GROUP BY 1""",
    "avg_field_accuracy",
    binding="traces",
)
register(
    "model_prompt_totals",
    lambda w: agents.model_prompt_totals(w.model_version_comparison),
    """SELECT model_name, prompt_version, avg(avg_cost_usd) AS avg_cost_usd, avg(avg_field_accuracy) AS avg_field_accuracy,
              avg(avg_latency_ms) AS avg_latency_ms, avg(success_rate) AS success_rate, avg(avg_retry_count) AS avg_retry_count,
              avg(avg_quality_score) AS avg_quality_score, sum(run_count)::BIGINT AS run_count,
              sum(total_input_tokens)::BIGINT AS total_input_tokens, sum(total_output_tokens)::BIGINT AS total_output_tokens
       FROM model_cmp GROUP BY ALL""",
    "avg_cost_usd avg_field_accuracy avg_latency_ms success_rate avg_retry_count avg_quality_score",
    binding="traces",
)
