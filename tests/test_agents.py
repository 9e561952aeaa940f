from __future__ import annotations

from conftest import on, rows
from pyspark.sql import functions as F

from tidemark.operators import agents

RUN_DDL = (
    "agent_run_id string, trace_id string, task_id string, user_id string, document_id string, started_at timestamp_ntz, "
    "ended_at timestamp_ntz, total_latency_ms bigint, total_input_tokens bigint, total_output_tokens bigint, "
    "estimated_cost_usd double, model_name string, prompt_version string, tool_call_count int, retry_count int, "
    "success_flag boolean, quality_score double, field_accuracy double, manual_edit_count int, error_type string, "
    "experiment_group string, run_date date"
)
SPAN_DDL = (
    "span_id string, trace_id string, span_name string, span_type string, latency_ms bigint, status string, "
    "input_tokens bigint, output_tokens bigint, estimated_cost_usd double, error_type string"
)


def run(i, day, ok=True, latency=100, error=None, model="m", cost=1.0):
    return (f"r{i}", f"x{i}", f"t{i}", "u", "d", None, None, latency, 10, 5, cost, model, "v1", 1, 0, ok, 0.5, 0.5, 0, error, "A", on(day))


def runs(spark, data):
    return spark.createDataFrame(data, RUN_DDL)


def spans(spark, data):
    return spark.createDataFrame(data, SPAN_DDL)


def test_rollup_does_not_fan_out(spark):
    frame = runs(spark, [run(1, "2026-01-01"), run(2, "2026-01-01")])
    parts = spans(
        spark,
        [("s1", "x1", "ocr_extraction", "tool", 30, "ok", 1, 1, 0.1, None), ("s2", "x1", "form_autofill", "llm", 50, "error", 1, 1, 0.1, "boom")],
    )
    out = {r["trace_id"]: r for r in agents.agent_trace_rollup(frame, agents.spans_per_trace(parts)).collect()}
    assert (out["x1"]["span_count"], out["x1"]["failed_span_count"], out["x1"]["ocr_latency_ms"], out["x1"]["llm_latency_ms"]) == (2, 1, 30, 50)
    assert (out["x2"]["span_count"], out["x2"]["validation_latency_ms"]) == (0, 0)


def test_error_categories(spark):
    data = [run(1, "2026-01-01", False, error="timeout"), run(2, "2026-01-01", False, error="odd"), run(3, "2026-01-01"), run(4, "2026-01-01", False)]
    none = spans(spark, [])
    out = agents.agent_error_classification(runs(spark, data), agents.failures_per_trace(none))
    assert rows(out, "agent_run_id", "error_category") == {("r1", "timeout"), ("r2", "unknown"), ("r3", "none"), ("r4", "unknown")}


def test_error_share_is_of_the_day(spark):
    data = [run(1, "2026-01-01", False, error="timeout"), run(2, "2026-01-01", False, error="timeout"), run(3, "2026-01-01", False, error="api_error"), run(4, "2026-01-02", False)]
    classified = agents.agent_error_classification(runs(spark, data), agents.failures_per_trace(spans(spark, [])))
    out = agents.error_root_cause(classified)
    assert {(str(a), b, round(c, 4)) for a, b, c in rows(out, "run_date", "error_category", "error_share")} == {
        ("2026-01-01", "timeout", 0.6667), ("2026-01-01", "api", 0.3333), ("2026-01-02", "unknown", 1.0),
    }


def test_pareto_includes_the_crossing_entry(spark):
    classified = spark.createDataFrame(
        [(False, c, None, None) for c, n in (("a", 60), ("b", 25), ("c", 10), ("d", 5)) for _ in range(n)],
        "success_flag boolean, error_category string, run_error_type string, failing_span_name string",
    )
    out = {r["error_category"]: r for r in agents.error_pareto(classified).collect()}
    assert [out[c]["in_pareto_top_80"] for c in "abcd"] == [True, True, False, False]
    assert out["d"]["cumulative_share_pct"] == 100.0


def test_token_cost_of_unknown_model_is_zero(spark):
    frame = spark.createDataFrame([("gpt-4o-2024-08-06", 1000, 500), ("nobody", 1000, 500)], "model_name string, total_input_tokens bigint, total_output_tokens bigint")
    assert rows(agents.token_cost(frame), "model_name", "priced_cost_usd") == {("gpt-4o-2024-08-06", 0.0075), ("nobody", 0.0)}


def test_efficiency_rank_is_stable_under_ties(spark):
    frame = runs(spark, [run(i, "2026-01-01", model=m) for i, m in enumerate(["b", "a", "c"])])
    for parts in (1, 3):
        out = agents.model_cost_quality(frame.repartition(parts))
        assert rows(out, "model_name", "efficiency_rank") == {("a", 1), ("b", 2), ("c", 3)}


def test_trailing_averages(spark):
    frame = runs(spark, [run(i, f"2026-01-{i:02d}", ok=i % 2 == 0, latency=i) for i in range(1, 11)])
    out = {r["run_date"].day: r for r in agents.agent_success_trend(frame).collect()}
    assert out[10]["moving_avg_7d_latency"] == 7.0 and out[1]["moving_avg_7d_success_rate"] == 0.0
    assert agents.token_cost_trend(frame).agg(F.max("cum_total_tokens")).first()[0] == 150
