"""Configured experiment readout: named metrics compiled into one per-user frame that every part reads.

A metric is a ratio (or a single total, or a percentile of a user's runs) named in ``METRICS``; a
configuration gives metrics their role, direction and margin. The per-user frame aggregates tasks and
runs once, holds just the totals the configuration needs and is written once; all parts and all
replicates read the written frame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import null_safe_join, ratio
from tidemark.functions.order_stats import exact_percentiles
from tidemark.operators import experiment as ex
from tidemark.sources.sinks import written_once

PRIMARY, SECONDARY, GUARDRAIL = "primary", "secondary", "guardrail"
HIGHER, LOWER = "higher_is_better", "lower_is_better"


def _counts(condition: Column) -> Column:
    return F.when(condition, F.lit(1))


# Per-user totals: each is the sum of an expression over a user's tasks or runs.
TASK_TOTALS: dict[str, Column] = {}
RUN_TOTALS: dict[str, Column] = {}


def _totals() -> tuple[dict[str, Column], dict[str, Column]]:
    """Built on first use: expressions need a running session."""
    if not TASK_TOTALS:
        TASK_TOTALS.update(
            tasks=_counts(F.col("task_id").isNotNull()),
            successes=_counts(F.col("is_successful")),
            left_behind=_counts(F.col("uploaded_at").isNotNull() & ~F.col("is_successful")),
            edits=F.col("field_edit_count"),
            edited=_counts(F.col("field_edit_count").isNotNull()),
            seconds=F.col("task_duration_seconds"),
            timed=_counts(F.col("task_duration_seconds").isNotNull()),
        )
        RUN_TOTALS.update(
            runs=F.lit(1),
            errors=_counts(F.col("error_type").isNotNull()),
            cost=F.col("estimated_cost_usd"),
            latency=F.col("total_latency_ms"),
            measured=_counts(F.col("total_latency_ms").isNotNull()),
            accuracy=F.col("field_accuracy"),
            judged=_counts(F.col("field_accuracy").isNotNull()),
        )
    return TASK_TOTALS, RUN_TOTALS


# Percentiles over a user's runs: column and share.
RUN_PERCENTILES = {"p95": ("total_latency_ms", 0.95), "p50": ("total_latency_ms", 0.50)}
# A metric is numerator / denominator over one user's totals, or the numerator alone.
METRICS: dict[str, tuple[str, str | None]] = {
    "form_export_rate": ("successes", "tasks"),
    "task_success_rate": ("successes", "tasks"),
    "field_accuracy": ("accuracy", "judged"),
    "manual_edit_rate": ("edits", "edited"),
    "avg_task_duration_s": ("seconds", "timed"),
    "abandonment_rate": ("left_behind", "tasks"),
    "agent_error_rate": ("errors", "runs"),
    "avg_agent_latency_ms": ("latency", "measured"),
    "p50_latency_ms": ("p50", None),
    "p95_latency_ms": ("p95", None),
    "cost_per_successful_task_usd": ("cost", "successes"),
    "total_cost_usd": ("cost", None),
    "total_tasks": ("tasks", None),
    "successful_tasks": ("successes", None),
}


@dataclass(frozen=True)
class Metric:
    """A metric's part in an experiment. ``margin`` is the non-inferiority factor of a guardrail."""

    name: str
    role: str
    direction: str = HIGHER
    margin: float | None = None

    def __post_init__(self) -> None:
        if self.name not in METRICS:
            raise ValueError(f"unknown metric {self.name!r}; known: {', '.join(sorted(METRICS))}")
        if self.role not in (PRIMARY, SECONDARY, GUARDRAIL) or self.direction not in (HIGHER, LOWER):
            raise ValueError(f"unknown role or direction of {self.name!r}: {self.role!r}, {self.direction!r}")
        if self.role == GUARDRAIL and not (self.margin and self.margin >= 1):
            raise ValueError(f"guardrail {self.name!r} needs a margin of at least 1")


@dataclass(frozen=True)
class Experiment:
    """What an experiment's configuration file says."""

    experiment_id: str
    metrics: tuple[Metric, ...]
    split: tuple[float, ...] = (0.5, 0.5)
    alpha: float = 0.05
    srm_alpha: float = 0.05
    iterations: int = 10_000
    seed: int = ex.BOOTSTRAP_SEED
    segments: tuple[str, ...] = ()

    @classmethod
    def from_mapping(cls, config: Mapping[str, Any], **overrides: Any) -> Experiment:
        """From a parsed configuration: design, metrics by role, guardrails, analysis.

        Guardrails are read as lower-is-better unless they state a direction.
        """
        named = config.get("metrics", {})
        metrics = [Metric(m["name"], role, m.get("direction", HIGHER)) for role in (PRIMARY, SECONDARY) for m in named.get(role, ())]
        metrics += [Metric(m["name"], GUARDRAIL, m.get("direction", LOWER), float(m["threshold_relative"])) for m in config.get("guardrails", ())]
        analysis = config.get("analysis", {})
        settings: dict[str, Any] = {
            "experiment_id": config["experiment_id"],
            "metrics": tuple(metrics),
            "split": tuple(config.get("design", {}).get("traffic_split", cls.split)),
            "alpha": float(analysis.get("significance_level", cls.alpha)),
            "srm_alpha": float(analysis.get("srm_significance_level", cls.srm_alpha)),
            "iterations": int(analysis.get("bootstrap_iterations", cls.iterations)),
            "segments": tuple(analysis.get("segment_dimensions", ())),
        }
        return cls(**{**settings, **overrides})

    def named(self, *roles: str) -> list[str]:
        return list(dict.fromkeys(m.name for m in self.metrics if m.role in roles))


def user_totals(tasks: DataFrame, runs: DataFrame, metrics: Sequence[str], by: Sequence[str] = ("user_id",)) -> DataFrame:
    """One row per user (and other keys): the totals that the metrics need, tasks and runs read once each.

    Percentiles are exact and take a user with very many runs apart by slices; the other run totals ride
    along with their counts.
    """
    task_totals, run_totals = _totals()
    inputs = {part for m in metrics for part in METRICS[m] if part}
    by = list(by)
    per_task = tasks.groupBy(*by).agg(*[F.sum(c.cast("double")).alias(n) for n, c in task_totals.items() if n in inputs | {"tasks"}])
    wanted = {n: c.cast("double") for n, c in run_totals.items() if n in inputs}
    shares = {n: RUN_PERCENTILES[n] for n in sorted(inputs & set(RUN_PERCENTILES))}
    columns = {column for column, _ in shares.values()}
    if len(columns) > 1:
        raise ValueError("percentiles of one run column only")
    if shares:
        per_run = exact_percentiles(runs, by, columns.pop(), {n: share for n, (_, share) in shares.items()}, carry=wanted)
    elif wanted:
        per_run = runs.groupBy(*by).agg(*[F.sum(c).alias(n) for n, c in wanted.items()])
    else:
        return per_task
    return null_safe_join(per_task, per_run, by, "full")


def _values(names: Sequence[str]) -> list[Column]:
    """Metrics from totals; a user without the denominator counts as 0, as in the user mart."""
    out = []
    for name in names:
        top, bottom = METRICS[name]
        value = F.col(top).cast("double") if bottom is None else ratio(top, bottom)
        out.append(F.coalesce(value, F.lit(0.0)).alias(name))
    return out


def assigned_users(assignments: DataFrame, experiment_id: str) -> DataFrame:
    """(user_id, experiment_group, analysed): each assigned user and group once, from one read of the assignments.

    Rows marked as intended contamination assign nobody. Users with such a row, or seen in several groups
    of any experiment, are not analysed.
    """
    marked = F.coalesce(F.col("is_intentional_contamination"), F.lit(False))
    here = (F.col("experiment_id") == experiment_id) & ~marked
    per_group = assignments.groupBy("user_id", "experiment_group").agg(
        F.max(marked.cast("int")).alias("__marked"), F.max(here.cast("int")).alias("__here"))
    user = Window.partitionBy("user_id")
    seen = per_group.withColumns({"__groups": F.count("experiment_group").over(user), "__marked": F.max("__marked").over(user)})
    clean = (F.col("__marked") == 0) & (F.col("__groups") <= 1)
    return seen.where("__here = 1").select("user_id", "experiment_group", clean.alias("analysed"))


def user_metric_frame(config: Experiment, assignments: DataFrame, tasks: DataFrame, runs: DataFrame) -> DataFrame:
    """The per-user frame of a readout, written once: user, group, analysed, one column per configured metric."""
    names = config.named(PRIMARY, SECONDARY, GUARDRAIL)
    users = assigned_users(assignments, config.experiment_id)
    totals = user_totals(tasks, runs, names)
    return written_once(users.join(totals, "user_id", "left").select("user_id", "experiment_group", "analysed", *_values(names)))


def _rows(frame: DataFrame, names: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, group, metric, value) of the analysed users."""
    return frame.where("analysed").unpivot([*keys, "user_id", "experiment_group"], list(names), "metric", "value")


def metric_status(rows: DataFrame, effects: DataFrame, names: Sequence[str]) -> DataFrame:
    """(metric, status) of every configured metric: ok, constant_data, insufficient_data or no_data."""
    spark = rows.sparkSession
    asked = spark.createDataFrame([(n,) for n in names], "metric string")
    moments = ex.two_group_moments(rows).select("metric", F.least("a_n", "b_n").alias("__least"))
    found = asked.join(moments, "metric", "left").join(effects.select("metric", F.col("welch_p_value").alias("__p")), "metric", "left")
    known = F.coalesce(F.col("__least"), F.lit(0))
    status = (
        F.when(known == 0, "no_data").when(known < 2, "insufficient_data")
        .when(F.col("__p").isNull() | F.isnan("__p"), "constant_data").otherwise("ok"))
    return found.select("metric", status.alias("status"))


def _long(df: DataFrame, part: str, statistics: Sequence[str], labels: Sequence[str] = (), keys: Sequence[str] = (), metric: str = "metric") -> DataFrame:
    """One row per statistic: part, keys, metric, statistic, value (numbers), label (texts)."""
    entries = [F.struct(F.lit(s).alias("statistic"), F.col(s).cast("double").alias("value"), F.lit(None).cast("string").alias("label")) for s in statistics]
    entries += [F.struct(F.lit(s).alias("statistic"), F.lit(None).cast("double").alias("value"), F.col(s).cast("string").alias("label")) for s in labels]
    flat = df.select(F.lit(part).alias("part"), *keys, F.col(metric).alias("metric"), F.explode(F.array(*entries)).alias("e"))
    return flat.select("part", *keys, "metric", "e.*").where(F.col("value").isNotNull() | F.col("label").isNotNull())


EFFECT = ("a_n", "b_n", "a_mean", "b_mean", "mean_diff", "welch_t_stat", "p_value", "cohens_d", "ci_lower", "ci_upper", "significant")
BOOTSTRAP = ("observed_diff", "bootstrap_mean", "estimate", "std_err", "ci_lower", "ci_upper", "replicates")
GUARD = ("a_mean", "b_mean", "diff", "diff_pct", "ci_lower", "ci_upper", "margin", "passed")
SUMMARY = ("mean", "std", "min", "max", "n", "p25", "p50", "p75")
DECISION = ("srm_passed", "primary_significant", "p_value", "effect", "guardrail_failures", "severe_failures")


def _effects(rows: DataFrame, alpha: float, by: Sequence[str] = ("metric",)) -> DataFrame:
    effects = ex.continuous_effect(rows, by)
    return effects.withColumns({"p_value": F.col("welch_p_value"), "significant": F.coalesce(F.col("welch_p_value") < alpha, F.lit(False))})


def _guards(config: Experiment, rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    guards = [m for m in config.metrics if m.role == GUARDRAIL]
    tested = ex.guardrail_test(rows, {m.name: m.margin for m in guards}, [m.name for m in guards if m.direction == HIGHER], by)
    return tested.withColumn("passed", F.col("non_inferiority_passed"))


def _signed(config: Experiment, name: str, effect: Column) -> Column:
    lower = any(m.name == name and m.role == PRIMARY and m.direction == LOWER for m in config.metrics)
    return -effect if lower else effect


def readout(config: Experiment, frame: DataFrame) -> dict[str, DataFrame]:
    """The seven parts of a readout over a written ``user_metric_frame``, and ``long``: all of them in one table.

    srm over all assigned users; primary and secondary effects with status, the latter with adjusted
    p-values; bootstrap of both; guardrails with their own margins; summary per group; the decision.
    """
    tested = config.named(PRIMARY, SECONDARY)
    guarded = config.named(GUARDRAIL)
    every = config.named(PRIMARY, SECONDARY, GUARDRAIL)
    rows = _rows(frame, every)
    srm = ex.srm_test(frame, None, config.split, config.srm_alpha)
    effects = _effects(rows.where(F.col("metric").isin(*tested)), config.alpha)
    status = metric_status(rows.where(F.col("metric").isin(*tested)), effects, tested)
    found = status.join(effects, "metric", "left")
    primary = found.where(F.col("metric").isin(*config.named(PRIMARY)))
    others = found.where(F.col("metric").isin(*config.named(SECONDARY)))
    corrected = ex.bh_correction(others.where("p_value IS NOT NULL").select("metric", "p_value"), "p_value", alpha=config.alpha)
    secondary = others.join(corrected.select("metric", "adjusted_p", "rejected"), "metric", "left")
    guards = _guards(config, rows)
    boot = ex.bootstrap_diff(frame.where("analysed"), tested, config.iterations, config.seed)
    summary = ex.summary_stats(rows)
    first = config.named(PRIMARY)[:1]
    main = effects.where(F.col("metric").isin(*first)).select("p_value", _signed(config, "".join(first), F.col("mean_diff")).alias("effect"))
    decision = ex.experiment_decision(srm, main, guards, config.alpha)
    parts = {"srm": srm, "primary": primary, "secondary": secondary, "bootstrap": boot, "guardrails": guards, "summary": summary, "decision": decision}
    by_group = F.concat_ws(".", "experiment_group", "metric")
    parts["long"] = reduce(DataFrame.unionByName, [
        _long(srm, "srm", ["observed", "expected", "chi2_stat", "p_value", "passed"], metric="experiment_group"),
        _long(primary, "primary", EFFECT, ["status"]),
        _long(secondary, "secondary", [*EFFECT, "adjusted_p", "rejected"], ["status"]),
        _long(boot, "bootstrap", BOOTSTRAP),
        _long(guards, "guardrail", GUARD),
        _long(summary.withColumn("metric", by_group), "summary", SUMMARY),
        _long(decision.withColumn("metric", F.lit("".join(first))), "decision", DECISION, ["decision"]),
    ])
    return parts


def segment_frame(
    config: Experiment,
    assignments: DataFrame,
    users: DataFrame,
    documents: DataFrame,
    tasks: DataFrame,
    runs: DataFrame,
) -> DataFrame:
    """The per-user frame by segment, written once: dimension, level, user, group, analysed, metrics.

    A dimension is a column of the users, or ``document_complexity``: then a user stands in each level of
    which the user has a task, with the tasks and runs of that level.
    """
    names = config.named(PRIMARY, SECONDARY, GUARDRAIL)
    assigned = assigned_users(assignments, config.experiment_id)
    own = [d for d in config.segments if d != "document_complexity"]
    parts = []
    if own:
        totals = user_totals(tasks, runs, names)
        levels = users.select("user_id", *[F.coalesce(F.col(d), F.lit("unknown")).alias(d) for d in own])
        wide = assigned.join(levels, "user_id").join(totals, "user_id", "left")
        entries = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("level")) for d in own]))
        spread = wide.select("user_id", "experiment_group", "analysed", *_values(names), entries.alias("s"))
        parts.append(spread.select("s.dimension", "s.level", "user_id", "experiment_group", "analysed", *names))
    if "document_complexity" in config.segments:
        level = documents.select("document_id", F.coalesce("complexity_level", F.lit("unknown")).alias("level"))
        graded = tasks.join(level, "document_id")
        of_task = graded.select("task_id", "level").distinct()
        totals = user_totals(graded, runs.join(of_task, "task_id"), names, ("user_id", "level")).where("tasks > 0")
        wide = assigned.join(totals, "user_id")
        parts.append(wide.select(F.lit("document_complexity").alias("dimension"), "level", "user_id", "experiment_group", "analysed", *_values(names)))
    if not parts:
        raise ValueError("the configuration names no segment dimension")
    return written_once(reduce(DataFrame.unionByName, parts))


def segment_readout(config: Experiment, frame: DataFrame) -> DataFrame:
    """Sample ratio, effects and guardrails in every segment, as one long table."""
    keys = ["dimension", "level"]
    every = config.named(PRIMARY, SECONDARY, GUARDRAIL)
    rows = _rows(frame, every, keys)
    srm = ex.srm_test(frame, None, config.split, config.srm_alpha, by=keys)
    effects = _effects(rows.where(F.col("metric").isin(*config.named(PRIMARY, SECONDARY))), config.alpha, [*keys, "metric"])
    return reduce(DataFrame.unionByName, [
        _long(srm, "srm", ["observed", "expected", "chi2_stat", "p_value", "passed"], keys=keys, metric="experiment_group"),
        _long(effects, "effect", EFFECT, keys=keys),
        _long(_guards(config, rows, keys), "guardrail", GUARD, keys=keys),
    ])
