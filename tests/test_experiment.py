from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import at, on, rows
from pyspark.sql import functions as F

from tidemark.operators import experiment as ex

ASSIGN_DDL = (
    "assignment_id string, experiment_id string, user_id string, experiment_group string, assigned_at timestamp_ntz, "
    "is_intentional_contamination boolean"
)


def assignments(spark, data):
    return spark.createDataFrame(
        [(f"a{i}", "x", u, g, at(day + "T00:00:00"), flag) for i, (u, g, flag, day) in enumerate(data)], ASSIGN_DDL
    )


DATA = [
    ("u1", "A", False, "2026-05-01"),
    ("u2", "B", False, "2026-05-01"),
    ("u3", "A", False, "2026-05-01"),
    ("u3", "B", False, "2026-05-02"),
    ("u4", "A", False, "2026-05-01"),
    ("u4", "B", True, "2026-05-03"),
    ("u5", "A", False, "2026-05-01"),
    ("u5", "A", True, "2026-05-04"),
]


def test_clean_assignments_tag_both_kinds_of_contamination(spark):
    out = ex.clean_assignments(assignments(spark, DATA))
    assert rows(out, "user_id", "experiment_group", "is_contaminated") == {
        ("u1", "A", False), ("u2", "B", False), ("u3", "A", True), ("u3", "B", True), ("u4", "A", True), ("u5", "A", True),
    }


def test_contaminated_users_one_row_each(spark):
    frame = assignments(spark, DATA)
    out = ex.contaminated_users(frame)
    assert out.count() == 2
    assert rows(out, "user_id", "assigned_groups") == {("u3", "A,B"), ("u4", "A,B")}
    assert ex.contaminated_users(frame, per_assignment=True).count() == 4


def test_window_upper_bound_is_midnight(spark):
    clean = ex.clean_assignments(assignments(spark, [("u1", "A", False, "2026-05-01")]))
    flags = spark.createDataFrame(
        [("t1", "u1", at("2026-06-01T00:00:00"), True), ("t2", "u1", at("2026-06-01T00:00:01"), True), ("t3", "u1", at("2026-05-02T00:00:00"), False)],
        "task_id string, user_id string, uploaded_at timestamp_ntz, did_export boolean",
    )
    runs = spark.createDataFrame(
        [("r1", "t1", 0.5, 10, 1.0), ("r2", "t1", 1.0, 30, 1.0)],
        "agent_run_id string, task_id string, field_accuracy double, total_latency_ms bigint, estimated_cost_usd double",
    )
    out = ex.experiment_user_metrics(clean, flags, runs, "2026-05-01", "2026-06-01").first()
    assert (out["total_tasks"], out["exported_tasks"], out["export_rate"]) == (2, 1, 0.5)
    assert (out["avg_field_accuracy"], out["avg_latency_ms"], out["total_cost_usd"]) == (0.75, 20.0, 2.0)
    assert out["experiment_start_date"] == on("2026-05-01")


def test_fanned_guardrails_equal_the_joined_rows(spark):
    clean = ex.clean_assignments(assignments(spark, [(f"u{i}", "AB"[i % 2], False, "2026-05-01") for i in range(6)]))
    rng = random.Random(1)
    run_rows = [(f"u{rng.randrange(5)}", rng.randrange(100), rng.random(), rng.choice([None, "e"])) for _ in range(20)]
    flag_rows = [(f"t{i}", f"u{rng.randrange(1, 6)}", True, rng.random() < 0.5) for i in range(15)]
    runs = spark.createDataFrame(run_rows, "user_id string, total_latency_ms bigint, estimated_cost_usd double, error_type string")
    flags = spark.createDataFrame(flag_rows, "task_id string, user_id string, did_upload boolean, did_export boolean")
    got = {r["experiment_group"]: r for r in ex.experiment_guardrails(clean, runs, flags, mode="fanned").collect()}
    for g in "AB":
        joined = []
        for u in [f"u{i}" for i in range(6) if "AB"[i % 2] == g]:
            mine = [r for r in run_rows if r[0] == u] or [None]
            tasks = [f for f in flag_rows if f[1] == u] or [None]
            joined += [(r, t) for r in mine for t in tasks]
        latency = [r[1] for r, _ in joined if r]
        assert got[g]["avg_p95_latency_ms"] == pytest.approx(np.mean(latency))
        assert got[g]["agent_error_rate"] == pytest.approx(np.mean([1.0 if r and r[3] else 0.0 for r, _ in joined]))


def metric_rows(spark, a, b, metric="m"):
    data = [("A", metric, float(v)) for v in a] + [("B", metric, float(v)) for v in b]
    return spark.createDataFrame(data, "experiment_group string, metric string, value double")


def test_welch_against_a_worked_example(spark):
    a = [27.5, 21.0, 19.0, 23.6, 17.0, 17.9, 16.9, 20.1, 21.9, 22.6, 23.1, 19.6, 19.0, 21.7, 21.4]
    b = [27.1, 22.0, 20.8, 23.4, 23.4, 23.5, 25.8, 22.0, 24.8, 20.2, 21.9, 22.1, 22.9, 30.5, 24.4]
    out = ex.continuous_effect(metric_rows(spark, a, b)).first()
    va, vb = np.var(a, ddof=1) / 15, np.var(b, ddof=1) / 15
    assert out["mean_diff"] == pytest.approx(np.mean(b) - np.mean(a))
    assert out["welch_t_stat"] == pytest.approx((np.mean(b) - np.mean(a)) / math.sqrt(va + vb))
    assert out["welch_df"] == pytest.approx((va + vb) ** 2 / (va**2 / 14 + vb**2 / 14))
    assert out["ci_lower"] < out["mean_diff"] < out["ci_upper"]
    assert (out["welch_p_value"] < 0.05) == (out["ci_lower"] > 0)


def test_too_few_users_give_no_row(spark):
    assert ex.continuous_effect(metric_rows(spark, [1.0], [1.0, 2.0])).count() == 0


def test_binary_effect_closed_form(spark):
    counts = spark.createDataFrame([(100, 30, 100, 45)], "a_n bigint, a_success bigint, b_n bigint, b_success bigint")
    out = ex.binary_effect_from_counts(counts).first()
    z = 0.15 / math.sqrt(0.375 * 0.625 * 0.02)
    assert out["risk_difference"] == pytest.approx(0.15) and out["relative_risk"] == pytest.approx(1.5)
    assert out["odds_ratio"] == pytest.approx((45 / 55) / (30 / 70))
    assert out["p_value_ztest"] == pytest.approx(math.erfc(z / math.sqrt(2)))
    edge = spark.createDataFrame([(10, 0, 10, 10)], "a_n bigint, a_success bigint, b_n bigint, b_success bigint")
    assert math.isinf(ex.binary_effect_from_counts(edge).first()["relative_risk"])


def srm_frame(spark, sizes):
    data = [(g, f"{g}{i}") for g, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(data, "experiment_group string, user_id string").withColumn("experiment_id", F.lit("x"))


def test_srm(spark):
    assert ex.srm_test(srm_frame(spark, {"A": 500, "B": 510}), "x").first()["passed"]
    skewed = ex.srm_test(srm_frame(spark, {"A": 700, "B": 300}), "x").first()
    assert not skewed["passed"] and skewed["chi2_stat"] == pytest.approx(160.0)
    assert ex.srm_test(srm_frame(spark, {"A": 700, "B": 300}), "x", expected=(70, 30)).first()["passed"]
    assert ex.srm_test(srm_frame(spark, {"A": 10, "B": 10}), "other").count() == 0
    # a group that was given no share cannot pass
    assert not ex.srm_test(srm_frame(spark, {"A": 50, "B": 50, "C": 1}), "x").first()["passed"]


def test_bh_matches_the_step_up_rule(spark):
    p = {"a": 0.01, "b": 0.04, "c": 0.03, "d": 0.005, "e": 0.8}
    out = {r["metric"]: r for r in ex.bh_correction(spark.createDataFrame(list(p.items()), "metric string, p double"), "p").collect()}
    ordered = sorted(p, key=p.get)
    for i, name in enumerate(ordered):
        best = min(min(p[ordered[j]] * 5 / (j + 1), 1.0) for j in range(i, 5))
        assert out[name]["adjusted_p"] == pytest.approx(best)
        assert out[name]["rejected"] == (best <= 0.05)


def test_bh_keeps_families_apart(spark):
    frame = spark.createDataFrame([("x", "a", 0.04), ("y", "a", 0.04), ("y", "b", 0.5)], "f string, metric string, p double")
    assert rows(ex.bh_correction(frame, "p", by=["f"]), "f", "metric", "adjusted_p") == {("x", "a", 0.04), ("y", "a", 0.08), ("y", "b", 0.5)}


def test_guardrails(spark):
    rng = np.random.default_rng(0)
    base, worse = rng.normal(100, 5, 400), rng.normal(130, 5, 400)
    out = lambda a, b, **kw: ex.guardrail_test(metric_rows(spark, a, b), {"m": 1.1}, **kw).first()
    assert out(base, base)["non_inferiority_passed"]
    assert not out(base, worse)["non_inferiority_passed"]
    assert not out(worse, base, higher_is_better=["m"])["non_inferiority_passed"]
    assert out(base, worse, higher_is_better=["m"])["non_inferiority_passed"]
    flat = out([1.0, 1.0], [9.0, 9.0])
    assert flat["non_inferiority_passed"] and flat["ci_lower"] == flat["ci_upper"] == 8.0
    assert ex.guardrail_test(metric_rows(spark, [1.0, 2.0], []), {"m": 1.1}).first()["non_inferiority_passed"]


def users_frame(spark, n=300, shift=0.0):
    rng = random.Random(5)
    data = [(f"u{i}", "AB"[i % 2], rng.gauss(10 + shift * (i % 2), 2)) for i in range(n)]
    return data, spark.createDataFrame(data, "user_id string, experiment_group string, m double")


def test_bootstrap_is_repeatable_and_free_of_partitioning(spark):
    _, frame = users_frame(spark)
    take = lambda f, **kw: ex.bootstrap_diff(f, ["m"], iterations=60, **kw).first()
    one, two = take(frame.repartition(1)), take(frame.repartition(9))
    for c in ("std_err", "ci_lower", "ci_upper", "estimate"):
        assert one[c] == pytest.approx(two[c], abs=1e-9)
    assert take(frame, seed=1)["std_err"] != pytest.approx(one["std_err"], abs=1e-9)
    assert one["ci_lower"] < one["ci_upper"] and one["replicates"] == 60


def test_bootstrap_agrees_with_theory(spark):
    data, frame = users_frame(spark, 400, shift=1.0)
    out = ex.bootstrap_diff(frame, ["m"], iterations=600).first()
    a, b = ([v for _, g, v in data if g == side] for side in "AB")
    se = math.sqrt(np.var(a, ddof=1) / len(a) + np.var(b, ddof=1) / len(b))
    assert out["observed_diff"] == pytest.approx(np.mean(b) - np.mean(a))
    assert out["std_err"] == pytest.approx(se, rel=0.12)
    assert out["estimate"] == pytest.approx(2 * out["observed_diff"] - out["bootstrap_mean"])


def test_median_bootstrap_matches_brute_force(spark):
    data, frame = users_frame(spark, 60)
    weights = {(r["user_id"], r["rep"]): r["weight"] for r in ex.poisson_weights(frame, 20).collect()}
    diffs = []
    for rep in range(20):
        side = {g: np.median(np.repeat([v for _, k, v in data if k == g], [weights.get((u, rep), 0) for u, k, _ in data if k == g])) for g in "AB"}
        diffs.append(side["B"] - side["A"])
    out = ex.bootstrap_diff(frame, ["m"], iterations=20, statistic="median").first()
    assert out["bootstrap_mean"] == pytest.approx(np.mean(diffs))
    assert out["ci_lower"] == pytest.approx(np.percentile(diffs, 2.5))


@pytest.mark.parametrize("digits", [None, 1, 0])
def test_medians_of_chunks_in_brackets(spark, monkeypatch, digits):
    """Few users in a bracket, several chunks of replicates, ties down to a handful of values, missing values."""
    monkeypatch.setattr(ex, "_REPLICATES_AT_ONCE", 8)
    data, _ = users_frame(spark, 300)
    data = [(u, g, None if i % 17 == 0 else v if digits is None else round(v, digits)) for i, (u, g, v) in enumerate(data)]
    frame = spark.createDataFrame(data, "user_id string, experiment_group string, m double")
    weights = {(r["user_id"], r["rep"]): r["weight"] for r in ex.poisson_weights(frame, 30).collect()}
    got = {(r["rep"], r["experiment_group"]): r["stat"] for r in ex._replicate_medians(frame, ["m"], 30, ex.BOOTSTRAP_SEED).collect()}
    assert len(got) == 60
    for (rep, group), stat in got.items():
        own = [(v, weights.get((u, rep), 0)) for u, g, v in data if g == group and v is not None]
        assert stat == np.median(np.repeat(*map(list, zip(*own, strict=True))))
    monkeypatch.setattr(ex, "_BRACKET", -0.06)
    if digits is None:
        with pytest.raises(Exception, match="widen _BRACKET"):
            ex._replicate_medians(frame, ["m"], 30, ex.BOOTSTRAP_SEED).collect()


def test_median_of_a_group_without_values(spark):
    frame = spark.createDataFrame([(1, "A", 1.0, None), (2, "B", 2.0, None), (3, "B", 4.0, None)],
                                  "user_id long, experiment_group string, m double, k double")
    out = {r["metric"]: r for r in ex.bootstrap_diff(frame, ["m", "k"], iterations=12, statistic="median").collect()}
    assert out["m"]["observed_diff"] == 2.0 and 0 < out["m"]["replicates"] <= 12
    assert out.get("k") is None or out["k"]["replicates"] == 0


def test_poisson_weights_have_the_right_shape(spark):
    _, frame = users_frame(spark, 500)
    total, kept = ex.poisson_weights(frame, 40).agg(F.sum("weight"), F.count("weight")).first()
    assert total / 20000 == pytest.approx(1.0, abs=0.03)
    assert kept / 20000 == pytest.approx(1 - math.exp(-1), abs=0.02)


def decide(spark, srm=True, p=0.01, effect=1.0, guards=((True, 0.0),), data_ok=True, rows_present=True):
    srm_frame_ = spark.createDataFrame([(srm,)], "passed boolean")
    primary = spark.createDataFrame([(p, effect)] if rows_present else [], "p_value double, effect double")
    guard = spark.createDataFrame(list(guards), "non_inferiority_passed boolean, diff_pct double")
    return ex.experiment_decision(srm_frame_, primary, guard, data_validation_passed=data_ok).first()["decision"]


def test_decision_order(spark):
    assert decide(spark) == "SHIP"
    assert decide(spark, guards=((False, 10.0),)) == "SHIP_WITH_MONITORING"
    assert decide(spark, guards=((False, -60.0),)) == "STOP_FOR_HARM"
    assert decide(spark, srm=False, guards=((False, -60.0),)) == "INCONCLUSIVE"
    assert decide(spark, data_ok=False) == "INCONCLUSIVE"
    assert decide(spark, p=0.2) == "CONTINUE_EXPERIMENT"
    assert decide(spark, effect=-1.0) == "INCONCLUSIVE"
    assert decide(spark, p=0.0) == "SHIP"  # a p-value of zero is a value
    assert decide(spark, rows_present=False) == "INCONCLUSIVE"


def test_false_positive_rate_and_power(spark):
    """Many small experiments at once: each metric is one simulated test."""
    rng = np.random.default_rng(42)
    data = []
    for i in range(200):
        for effect, name in ((0.0, f"null{i}"), (0.5, f"real{i}")):
            data += [("A", name, float(v)) for v in rng.normal(0, 1, 80)]
            data += [("B", name, float(v)) for v in rng.normal(effect, 1, 80)]
    frame = spark.createDataFrame(data, "experiment_group string, metric string, value double")
    out = ex.continuous_effect(frame).select("metric", "welch_p_value").collect()
    hits = lambda kind: np.mean([r[1] < 0.05 for r in out if r[0].startswith(kind)])
    assert 0.01 <= hits("null") <= 0.09
    assert hits("real") >= 0.75


def test_histogram_covers_all_values(spark):
    frame = spark.createDataFrame([("A", float(v)) for v in range(101)] + [("B", None)], "experiment_group string, v double")
    out = ex.metric_histogram(frame, "v", bins=10).collect()
    assert sum(r["n"] for r in out) == 101 and {r["bin"] for r in out} == set(range(10))
    same = spark.createDataFrame([("A", 5.0), ("A", 5.0)], "experiment_group string, v double")
    assert rows(ex.metric_histogram(same, "v"), "bin", "n") == {(0, 2)}


def test_balance(spark):
    clean = ex.clean_assignments(assignments(spark, [(f"u{i}", "AB"[i % 2], False, "2026-05-01") for i in range(40)]))
    users = spark.createDataFrame([(f"u{i}", "mobile" if i % 4 < 2 else "desktop", "x" if i % 2 else "y") for i in range(40)], "user_id string, device_type string, user_segment string")
    out = ex.randomization_balance(clean, users, ("device_type", "user_segment"))
    status = rows(out, "dimension", "status")
    assert ("device_type", "balanced") in status and ("user_segment", "imbalanced") not in status
    assert rows(out.where("dimension = 'user_segment'"), "level", "a_share") == {("x", 0.0), ("y", 1.0)}


def test_marts_count_users_not_assignments(spark):
    from tidemark.operators import experiment

    clean = spark.createDataFrame(
        [("u1", "A", "x1", False), ("u1", "A", "x2", False), ("u2", "A", "x1", False)],
        "user_id string, experiment_group string, experiment_id string, is_contaminated boolean",
    )
    metrics = spark.createDataFrame(
        [("u1", "A", 2, 0.5, 1.0, 10.0, 3.0), ("u1", "A", 2, 0.5, 1.0, 10.0, 3.0), ("u2", "A", 1, 1.0, 1.0, 10.0, 1.0)],
        "user_id string, experiment_group string, total_tasks int, export_rate double, avg_field_accuracy double, "
        "avg_latency_ms double, total_cost_usd double",
    )
    users = spark.createDataFrame([("u1", "s", "c"), ("u2", "s", "c")], "user_id string, user_segment string, acquisition_channel string")
    assert [r["user_count"] for r in experiment.ab_test_summary(metrics).collect()] == [2]
    assert [r["user_count"] for r in experiment.ab_test_segment_effects(clean, users, metrics).collect()] == [2]
    runs = spark.createDataFrame(
        [("u1", "r1", "t1", 100.0, 2.0, None), ("u2", "r2", "t2", 400.0, 1.0, "e")],
        "user_id string, run_id string, task_id string, total_latency_ms double, estimated_cost_usd double, error_type string",
    )
    flags = spark.createDataFrame([("u1", "t1", True, False), ("u2", "t2", True, True)], "user_id string, task_id string, did_upload boolean, did_export boolean")
    made = experiment.experiment_guardrails(clean, runs, flags).collect()
    assert [(r["user_count"], r["avg_latency_ms"], r["agent_error_rate"]) for r in made] == [(2, 250.0, 0.5)]
