"""The configured readout: metric registry, per-user frame, parts, segments."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import rows

from tidemark.operators import experiment as ex
from tidemark.operators import readout as ro
from tidemark.sources import sinks

CONFIG = {
    "experiment_id": "x",
    "design": {"traffic_split": [0.5, 0.5]},
    "metrics": {
        "primary": [{"name": "form_export_rate"}],
        "secondary": [{"name": "field_accuracy"}, {"name": "manual_edit_rate", "direction": "lower_is_better"}],
    },
    "guardrails": [
        {"name": "p95_latency_ms", "threshold_relative": 1.15},
        {"name": "cost_per_successful_task_usd", "threshold_relative": 1.1},
        {"name": "abandonment_rate", "threshold_relative": 1.05},
        {"name": "agent_error_rate", "threshold_relative": 1.05},
    ],
    "analysis": {"bootstrap_iterations": 40, "segment_dimensions": ["device_type", "document_complexity"]},
}
TASKS = ("user_id string, task_id string, document_id string, is_successful boolean, uploaded_at timestamp_ntz, "
         "field_edit_count long, task_duration_seconds long")
RUNS = "user_id string, task_id string, error_type string, estimated_cost_usd double, total_latency_ms long, field_accuracy double"
ASSIGNED = "assignment_id string, user_id string, experiment_id string, experiment_group string, is_intentional_contamination boolean"


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    rng = random.Random(3)
    from datetime import datetime

    people = [f"u{i}" for i in range(60)]
    assigned = [(f"a{i}", u, "x", "AB"[i % 2], False) for i, u in enumerate(people)]
    assigned += [("b1", "u1", "x", "A", False), ("b2", "u2", "y", "B", False), ("b3", "u4", "x", "A", True), ("b4", "u5", "x", "B", False),
                 ("b5", "v", "y", "A", False), ("b6", "u6", "y", None, None)]
    tasks, runs = [], []
    for k in range(150):
        u, t = rng.choice(people[:50]), f"t{k}"
        up = datetime(2026, 5, 1) if rng.random() < 0.9 else None
        tasks.append((u, t, f"d{k % 9}", rng.random() < 0.5, up, rng.choice([None, 0, 1, 5]), rng.choice([None, 60])))
        runs += [(u, t, rng.choice([None, "e"]), rng.random(), rng.choice([None, rng.randrange(1000)]), rng.choice([None, rng.random()]))
                 for _ in range(rng.randrange(4))]
    docs = [(f"d{i}", ["simple", "complex", None][i % 3]) for i in range(9)]
    users = [(u, rng.choice(["mobile", "desktop", None])) for u in people]
    made = {
        "assignments": spark.createDataFrame(assigned, ASSIGNED), "tasks": spark.createDataFrame(tasks, TASKS),
        "runs": spark.createDataFrame(runs, RUNS), "docs": spark.createDataFrame(docs, "document_id string, complexity_level string"),
        "users": spark.createDataFrame(users, "user_id string, device_type string"),
    }
    folder = tmp_path_factory.mktemp("readout")
    frames = {}
    for name, df in made.items():
        df.write.parquet(f"{folder}/{name}")
        frames[name] = spark.read.parquet(f"{folder}/{name}")
    return frames, {"assigned": assigned, "tasks": tasks, "runs": runs, "docs": dict(docs), "users": dict(users)}


def expected(tasks, runs):
    """One user's metrics from the user's rows."""
    share = lambda top, n: top / n if n else 0.0
    known = lambda values: [v for v in values if v is not None]
    won, lat = sum(t[3] for t in tasks), known(r[4] for r in runs)
    accuracy, edits = known(r[5] for r in runs), known(t[5] for t in tasks)
    return {
        "form_export_rate": share(won, len(tasks)), "field_accuracy": share(sum(accuracy), len(accuracy)),
        "manual_edit_rate": share(sum(edits), len(edits)), "p95_latency_ms": float(np.quantile(lat, 0.95)) if lat else 0.0,
        "cost_per_successful_task_usd": share(sum(r[3] for r in runs), won),
        "abandonment_rate": share(sum(t[4] is not None and not t[3] for t in tasks), len(tasks)),
        "agent_error_rate": share(sum(r[2] is not None for r in runs), len(runs)),
    }


def test_user_frame_matches_brute_force(world):
    frames, raw = world
    config = ro.Experiment.from_mapping(CONFIG)
    got = {(r["user_id"], r["experiment_group"]): r for r in ro.user_metric_frame(config, frames["assignments"], frames["tasks"], frames["runs"]).collect()}
    assert set(got) == {(a[1], a[3]) for a in raw["assigned"] if a[2] == "x" and not a[4]}
    groups = {}
    for _, u, _, g, marked in raw["assigned"]:
        groups.setdefault(u, set()).update({g} - {None}, {"!", "!!"} if marked else ())
    for (user, group), row in got.items():
        assert row["analysed"] == (len(groups[user]) == 1)
        want = expected([t for t in raw["tasks"] if t[0] == user], [r for r in raw["runs"] if r[0] == user])
        for name, value in want.items():
            assert row[name] == pytest.approx(value), (user, name)


def test_segments_match_brute_force(world):
    frames, raw = world
    config = ro.Experiment.from_mapping(CONFIG)
    frame = ro.segment_frame(config, frames["assignments"], frames["users"], frames["docs"], frames["tasks"], frames["runs"])
    got = {(r["dimension"], r["level"], r["user_id"], r["experiment_group"]): r for r in frame.collect()}
    level = {t[1]: raw["docs"][t[2]] or "unknown" for t in raw["tasks"]}
    graded = {(level[t[1]], t[0]) for t in raw["tasks"]}
    assert {(k[1], k[2]) for k in got if k[0] == "document_complexity"} == graded & {(lv, u) for lv in ("simple", "complex", "unknown") for u in raw["users"]}
    assert {(k[1], k[2]) for k in got if k[0] == "device_type"} == {(d or "unknown", u) for u, d in raw["users"].items()}
    for (dimension, at, user, _), row in got.items():
        mine = lambda r, user=user, at=at, dimension=dimension: r[0] == user and (dimension == "device_type" or level[r[1]] == at)
        for name, value in expected([t for t in raw["tasks"] if mine(t)], [r for r in raw["runs"] if mine(r)]).items():
            assert row[name] == pytest.approx(value), (dimension, at, user, name)
    parts = rows(ro.segment_readout(config, frame), "part", "dimension")
    assert parts == {(p, d) for p in ("srm", "effect", "guardrail") for d in ("device_type", "document_complexity")}


def test_sources_are_read_once_and_parts_read_the_written_frame(world, monkeypatch):
    frames, _ = world
    config = ro.Experiment.from_mapping(CONFIG)
    seen = []
    monkeypatch.setattr(ro, "written_once", lambda df: seen.append(df) or sinks.written_once(df))
    frame = ro.user_metric_frame(config, frames["assignments"], frames["tasks"], frames["runs"])
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    source = frames["assignments"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("is_intentional_contamination#") and source
    scans = [line for line in plan.splitlines() if "Relation" in line and "is_intentional_contamination#" in line]
    assert len(scans) == 1
    parts = ro.readout(config, frame)
    assert set(parts) == {"srm", "primary", "secondary", "bootstrap", "guardrails", "summary", "decision", "long"}
    written = set(frame.inputFiles())
    for part in parts.values():
        assert set(part.inputFiles()) <= written
    names = rows(parts["long"], "part")
    assert names == {(p,) for p in ("srm", "primary", "secondary", "bootstrap", "guardrail", "summary", "decision")}
    assert {r["metric"] for r in parts["guardrails"].collect()} == set(config.named(ro.GUARDRAIL))
    assert rows(parts["secondary"].where("adjusted_p IS NOT NULL"), "metric") == {("field_accuracy",), ("manual_edit_rate",)}


def test_status_of_metrics(spark):
    frame = spark.createDataFrame(
        [("u1", "A", True, 1.0, 0.0), ("u2", "A", True, 2.0, 0.0), ("u3", "B", True, 3.0, 0.0), ("u4", "B", True, 5.0, 0.0)],
        "user_id string, experiment_group string, analysed boolean, form_export_rate double, field_accuracy double")
    names = ["form_export_rate", "field_accuracy", "total_tasks"]
    long = ro._rows(frame, names[:2])
    status = dict(rows(ro.metric_status(long, ex.continuous_effect(long), names), "metric", "status"))
    assert status == {"form_export_rate": "ok", "field_accuracy": "constant_data", "total_tasks": "no_data"}
    few = ro._rows(frame.where("user_id <> 'u4'"), names[:1])
    assert rows(ro.metric_status(few, ex.continuous_effect(few), names[:1]), "status") == {("insufficient_data",)}


@pytest.mark.parametrize("metric, role, direction, margin, message", [
    ("nonsense", "primary", "higher_is_better", None, "unknown metric"),
    ("total_tasks", "tertiary", "higher_is_better", None, "unknown role"),
    ("total_tasks", "primary", "sideways", None, "unknown role or direction"),
    ("p95_latency_ms", "guardrail", "lower_is_better", None, "needs a margin"),
])
def test_wrong_configurations_are_refused(metric, role, direction, margin, message):
    with pytest.raises(ValueError, match=message):
        ro.Metric(metric, role, direction, margin)


def test_a_lower_is_better_primary_metric_can_ship(spark):
    data = [(f"u{i}", "AB"[i % 2], True, 5.0 - 3.0 * (i % 2) + (i % 7) / 10, 1.0 + (i % 5) / 100) for i in range(60)]
    frame = spark.createDataFrame(data, "user_id string, experiment_group string, analysed boolean, manual_edit_rate double, p95_latency_ms double")
    config = ro.Experiment("x", (ro.Metric("manual_edit_rate", "primary", "lower_is_better"), ro.Metric("p95_latency_ms", "guardrail", "lower_is_better", 1.2)), iterations=8)
    decision = ro.readout(config, frame)["decision"].first()
    assert decision["decision"] == "SHIP" and decision["effect"] > 0
