"""The model layers as one lazily composed set of frames.

Every property is a pure plan; nothing runs until a result is asked for. A frame asked for twice is
the same plan object, so Spark can reuse its shuffles inside one query. ``materialise_marts`` writes
the mart layer, ``persist`` keeps chosen frames between queries.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tidemark.operators import adoption, agents, executive, experiment, funnel, retention, segments
from tidemark.operators import sequences as seq
from tidemark.sources import sinks
from tidemark.sources.contracts import CONTRACTS
from tidemark.sources.staging import stage

MARTS = (
    "conversion_funnel",
    "daily_product_kpis",
    "retention_cohort",
    "feature_adoption",
    "feature_adoption_segmented",
    "feature_time_to_first_use",
    "export_rate_dimension_daily",
    "channel_performance",
    "user_segments",
    "executive_daily_scorecard",
    "weekly_business_review",
    "alerts",
    "agent_daily_kpis",
    "agent_stage_performance",
    "error_root_cause",
    "cost_quality_tradeoff",
    "model_version_comparison",
    "ab_test_summary",
    "ab_test_user_metrics",
    "ab_test_segment_effects",
    "experiment_guardrails",
)
# marts that other marts read
FOUNDATION_MARTS = ("daily_product_kpis", "retention_cohort", "agent_daily_kpis")


class Warehouse:
    """Staging, intermediate and mart frames over raw role tables."""

    def __init__(
        self,
        raw: Mapping[str, DataFrame | Callable[[], DataFrame]],
        experiment_start: str = "2026-05-01",
        experiment_end: str = "2026-06-01",
    ):
        self._raw = raw
        self._staged: dict[str, DataFrame] = {}
        self.experiment_start = experiment_start
        self.experiment_end = experiment_end

    # ---- raw and staging
    def raw(self, name: str) -> DataFrame:
        frame = self._raw[name]
        return frame if isinstance(frame, DataFrame) else frame()

    def staged(self, name: str) -> DataFrame:
        if name not in self._staged:
            self._staged[name] = stage(self.raw(name), CONTRACTS[name])
        return self._staged[name]

    def all_staged(self) -> dict[str, DataFrame]:
        return {name: self.staged(name) for name in CONTRACTS if name in self._raw}

    def all_raw(self) -> dict[str, DataFrame]:
        return {name: self.raw(name) for name in CONTRACTS if name in self._raw}

    def persist(self, *names: str) -> None:
        """Keep frames between queries; a lost executor's blocks are rebuilt from lineage."""
        for name in names:
            frame = getattr(self, name).persist(StorageLevel.MEMORY_AND_DISK)
            self.__dict__[name] = frame

    users = property(lambda self: self.staged("users"))
    documents = property(lambda self: self.staged("documents"))
    sessions = property(lambda self: self.staged("sessions"))
    events = property(lambda self: self.staged("product_events"))
    runs = property(lambda self: self.staged("agent_runs"))
    spans = property(lambda self: self.staged("agent_spans"))
    assignments = property(lambda self: self.staged("experiment_assignments"))

    # ---- intermediate
    @cached_property
    def task_event_sequence(self) -> DataFrame:
        return seq.task_event_sequence(self.events)

    @cached_property
    def task_funnel_flags(self) -> DataFrame:
        return seq.task_funnel_flags(self.task_event_sequence)

    @cached_property
    def task_funnel_enriched(self) -> DataFrame:
        return seq.task_funnel_enriched(self.task_funnel_flags, self.users, self.documents)

    @cached_property
    def task_outcomes(self) -> DataFrame:
        return seq.task_outcomes(self.task_event_sequence)

    @cached_property
    def user_first_activity(self) -> DataFrame:
        return seq.user_first_activity(self.events)

    @cached_property
    def user_cohorts(self) -> DataFrame:
        return seq.user_cohorts(self.users, self.user_first_activity)

    @cached_property
    def user_daily_activity(self) -> DataFrame:
        return seq.user_daily_activity(self.events)

    @cached_property
    def document_complexity_features(self) -> DataFrame:
        return seq.document_complexity_features(self.documents, self.task_outcomes)

    @cached_property
    def spans_per_trace(self) -> DataFrame:
        return agents.spans_per_trace(self.spans)

    @cached_property
    def agent_trace_rollup(self) -> DataFrame:
        return agents.agent_trace_rollup(self.runs, self.spans_per_trace)

    @cached_property
    def agent_error_classification(self) -> DataFrame:
        return agents.agent_error_classification(self.runs, agents.failures_per_trace(self.spans))

    @cached_property
    def clean_assignments(self) -> DataFrame:
        return experiment.clean_assignments(self.assignments)

    @cached_property
    def contaminated_users(self) -> DataFrame:
        return experiment.contaminated_users(self.assignments)

    @cached_property
    def experiment_user_metrics(self) -> DataFrame:
        return experiment.experiment_user_metrics(
            self.clean_assignments, self.task_funnel_flags, self.runs, self.experiment_start, self.experiment_end
        )

    # ---- marts
    @cached_property
    def conversion_funnel(self) -> DataFrame:
        return funnel.conversion_funnel(self.task_funnel_flags)

    @cached_property
    def daily_product_kpis(self) -> DataFrame:
        return executive.daily_product_kpis(self.events, self.task_funnel_flags)

    @cached_property
    def retention_cohort(self) -> DataFrame:
        return retention.retention_cohort(self.users, self.events)

    @cached_property
    def feature_adoption(self) -> DataFrame:
        return adoption.feature_adoption(self.events, self.task_funnel_flags)

    @cached_property
    def feature_adoption_segmented(self) -> DataFrame:
        return adoption.feature_adoption_segmented(self.task_funnel_enriched)

    @cached_property
    def feature_time_to_first_use(self) -> DataFrame:
        return adoption.feature_time_to_first_use(self.task_event_sequence, self.users, self.documents)

    @cached_property
    def export_rate_dimension_daily(self) -> DataFrame:
        return segments.export_rate_by_dimension(self.task_funnel_enriched)

    @cached_property
    def channel_performance(self) -> DataFrame:
        return segments.channel_performance(self.users, self.task_funnel_flags)

    @cached_property
    def user_segments(self) -> DataFrame:
        return segments.user_segments(self.users, self.task_outcomes)

    @cached_property
    def executive_daily_scorecard(self) -> DataFrame:
        return executive.executive_daily_scorecard(
            self.daily_product_kpis, self.retention_cohort, self.agent_daily_kpis
        )

    @cached_property
    def weekly_business_review(self) -> DataFrame:
        return executive.weekly_business_review(self.events, self.task_funnel_flags)

    @cached_property
    def alerts(self) -> DataFrame:
        return executive.daily_alerts(self.events, self.task_funnel_flags, self.agent_daily_kpis)

    @cached_property
    def agent_daily_kpis(self) -> DataFrame:
        return agents.agent_daily_kpis(self.runs, self.spans_per_trace)

    @cached_property
    def agent_stage_performance(self) -> DataFrame:
        return agents.agent_stage_performance(self.spans, self.runs)

    @cached_property
    def error_root_cause(self) -> DataFrame:
        return agents.error_root_cause(self.agent_error_classification)

    @cached_property
    def cost_quality_tradeoff(self) -> DataFrame:
        return agents.cost_quality_tradeoff(self.runs)

    @cached_property
    def model_version_comparison(self) -> DataFrame:
        return agents.model_version_comparison(self.runs)

    @cached_property
    def ab_test_summary(self) -> DataFrame:
        return experiment.ab_test_summary(self.experiment_user_metrics)

    @cached_property
    def ab_test_user_metrics(self) -> DataFrame:
        return experiment.ab_test_user_metrics(self.clean_assignments, self.task_outcomes, self.runs)

    @cached_property
    def ab_test_segment_effects(self) -> DataFrame:
        return experiment.ab_test_segment_effects(self.clean_assignments, self.users, self.experiment_user_metrics)

    @cached_property
    def experiment_guardrails(self) -> DataFrame:
        return experiment.experiment_guardrails(self.clean_assignments, self.runs, self.task_funnel_flags)

    def marts(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in MARTS}

    def materialise_marts(self, folder: str, at_once: int = 4) -> dict[str, DataFrame]:
        """Publish every mart as a new version and return frames over the written files.

        Frames that several marts read are written first and read back, so a later mart scans tasks or
        days instead of events again. Marts of one wave do not depend on each other; their jobs
        share the cluster.
        """
        self._write_wave(folder, ("task_event_sequence", "agent_error_classification"), at_once)
        self._write_wave(folder, ("task_funnel_enriched", "experiment_user_metrics", *FOUNDATION_MARTS), at_once)
        self._write_wave(folder, tuple(m for m in MARTS if m not in FOUNDATION_MARTS), at_once)
        return {name: getattr(self, name) for name in MARTS}

    def _write_wave(self, folder: str, names: tuple[str, ...], at_once: int) -> None:
        frames = {name: getattr(self, name) for name in names}
        with ThreadPoolExecutor(at_once) as pool:
            written = list(pool.map(lambda item: sinks.materialise(dict([item]), folder), frames.items()))
        for part in written:
            self.__dict__.update(part)
