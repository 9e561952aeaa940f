"""The data model: seven tables with keys, types and value rules."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Contract:
    """Columns with staging types, keys and rules of one table."""

    name: str
    types: Mapping[str, str]
    primary_key: str
    foreign_keys: tuple[ForeignKey, ...] = ()
    nullable: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    allowed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    minimum: Mapping[str, float] = field(default_factory=dict)
    maximum: Mapping[str, float] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [c for c in self.types if c not in self.nullable]

    def ddl(self) -> str:
        return ", ".join(f"`{c}` {t}" for c, t in self.types.items())


# --- fixed values: vocabularies of the data model ---------------------------------------------
DEVICES = ("desktop", "mobile", "tablet")
CHANNELS = ("organic", "paid_search", "social", "referral", "campus")
SEGMENTS = ("student", "individual", "small_business", "enterprise_trial")
EXPERIENCE = ("new", "intermediate", "expert")
COMPLEXITY = ("simple", "medium", "complex")
DOCUMENT_TYPES = (
    "bank_transfer_form",
    "invoice",
    "identity_document",
    "beneficiary_form",
    "exchange_declaration",
)
PLATFORMS = ("web", "api")
EVENT_STATUS = ("success", "failure", "pending")
EVENT_NAMES = (
    "document_uploaded",
    "ocr_started",
    "ocr_completed",
    "anonymization_started",
    "anonymization_completed",
    "risk_detection_started",
    "risk_detection_completed",
    "autofill_started",
    "autofill_completed",
    "form_review_started",
    "field_edited",
    "form_exported",
    "task_abandoned",
    "agent_run_failed",
)
SPAN_NAMES = (
    "document_classification",
    "ocr_extraction",
    "pii_detection",
    "anonymization",
    "risk_detection",
    "field_mapping",
    "form_autofill",
    "output_validation",
)
SPAN_TYPES = ("agent", "llm", "tool", "retrieval", "validation")
SPAN_STATUS = ("ok", "error", "warning")
GROUPS = ("A", "B")

USERS = Contract(
    "users",
    {
        "user_id": "string",
        "signup_time": "timestamp_ntz",
        "acquisition_channel": "string",
        "country": "string",
        "device_type": "string",
        "user_segment": "string",
        "company_size": "string",
        "experience_level": "string",
        "is_returning_user": "boolean",
    },
    primary_key="user_id",
    allowed={
        "acquisition_channel": CHANNELS,
        "device_type": DEVICES,
        "user_segment": SEGMENTS,
        "experience_level": EXPERIENCE,
    },
)
DOCUMENTS = Contract(
    "documents",
    {
        "document_id": "string",
        "user_id": "string",
        "document_type": "string",
        "language": "string",
        "page_count": "int",
        "complexity_level": "string",
        "contains_pii": "boolean",
        "contains_high_risk_terms": "boolean",
        "created_at": "timestamp_ntz",
    },
    primary_key="document_id",
    foreign_keys=(ForeignKey("user_id", "users", "user_id"),),
    allowed={"document_type": DOCUMENT_TYPES, "complexity_level": COMPLEXITY},
    minimum={"page_count": 1},
)
SESSIONS = Contract(
    "sessions",
    {
        "session_id": "string",
        "user_id": "string",
        "started_at": "timestamp_ntz",
        "ended_at": "timestamp_ntz",
        "device_type": "string",
        "platform": "string",
        "acquisition_channel": "string",
        "is_bounced": "boolean",
        "page_views": "int",
    },
    primary_key="session_id",
    foreign_keys=(ForeignKey("user_id", "users", "user_id"),),
    allowed={"device_type": DEVICES, "platform": PLATFORMS, "acquisition_channel": CHANNELS},
    minimum={"page_views": 1},
)
PRODUCT_EVENTS = Contract(
    "product_events",
    {
        "event_id": "string",
        "event_time": "timestamp_ntz",
        "event_date": "date",
        "user_id": "string",
        "session_id": "string",
        "document_id": "string",
        "task_id": "string",
        "event_name": "string",
        "event_status": "string",
        "platform": "string",
        "app_version": "string",
        "experiment_id": "string",
        "experiment_group": "string",
        "latency_ms": "double",
        "error_type": "string",
        "metadata_json": "string",
    },
    primary_key="event_id",
    foreign_keys=(
        ForeignKey("user_id", "users", "user_id"),
        ForeignKey("session_id", "sessions", "session_id"),
        ForeignKey("document_id", "documents", "document_id"),
    ),
    nullable=("experiment_id", "experiment_group", "error_type"),
    allowed={"event_name": EVENT_NAMES, "event_status": EVENT_STATUS, "platform": PLATFORMS},
    minimum={"latency_ms": 0},
)
AGENT_RUNS = Contract(
    "agent_runs",
    {
        "agent_run_id": "string",
        "trace_id": "string",
        "task_id": "string",
        "user_id": "string",
        "document_id": "string",
        "started_at": "timestamp_ntz",
        "ended_at": "timestamp_ntz",
        "total_latency_ms": "bigint",
        "total_input_tokens": "bigint",
        "total_output_tokens": "bigint",
        "estimated_cost_usd": "double",
        "model_name": "string",
        "prompt_version": "string",
        "tool_call_count": "int",
        "retry_count": "int",
        "success_flag": "boolean",
        "quality_score": "double",
        "field_accuracy": "double",
        "manual_edit_count": "int",
        "error_type": "string",
        "experiment_group": "string",
    },
    primary_key="agent_run_id",
    foreign_keys=(
        ForeignKey("user_id", "users", "user_id"),
        ForeignKey("document_id", "documents", "document_id"),
    ),
    nullable=("error_type", "experiment_group"),
    unique=("trace_id",),
    minimum={
        "total_latency_ms": 0,
        "total_input_tokens": 0,
        "total_output_tokens": 0,
        "estimated_cost_usd": 0,
        "tool_call_count": 0,
        "retry_count": 0,
        "quality_score": 0,
        "field_accuracy": 0,
        "manual_edit_count": 0,
    },
    maximum={"quality_score": 1, "field_accuracy": 1},
)
AGENT_SPANS = Contract(
    "agent_spans",
    {
        "span_id": "string",
        "trace_id": "string",
        "parent_span_id": "string",
        "span_name": "string",
        "span_type": "string",
        "start_time": "timestamp_ntz",
        "end_time": "timestamp_ntz",
        "latency_ms": "bigint",
        "status": "string",
        "model_name": "string",
        "input_tokens": "bigint",
        "output_tokens": "bigint",
        "estimated_cost_usd": "double",
        "tool_name": "string",
        "error_type": "string",
        "metadata_json": "string",
    },
    primary_key="span_id",
    foreign_keys=(ForeignKey("trace_id", "agent_runs", "trace_id"),),
    nullable=("parent_span_id", "model_name", "tool_name", "error_type"),
    allowed={"span_name": SPAN_NAMES, "span_type": SPAN_TYPES, "status": SPAN_STATUS},
    minimum={"latency_ms": 0, "input_tokens": 0, "output_tokens": 0, "estimated_cost_usd": 0},
)
ASSIGNMENTS = Contract(
    "experiment_assignments",
    {
        "assignment_id": "string",
        "experiment_id": "string",
        "user_id": "string",
        "experiment_group": "string",
        "assigned_at": "timestamp_ntz",
        "is_intentional_contamination": "boolean",
    },
    primary_key="assignment_id",
    foreign_keys=(ForeignKey("user_id", "users", "user_id"),),
    allowed={"experiment_group": GROUPS},
)
CONTRACTS = {
    c.name: c
    for c in (USERS, DOCUMENTS, SESSIONS, PRODUCT_EVENTS, AGENT_RUNS, AGENT_SPANS, ASSIGNMENTS)
}


def contract_errors(
    tables: Mapping[str, DataFrame],
    manifests: Mapping[str, int] | None = None,
    contracts: Mapping[str, Contract] = CONTRACTS,
) -> list[str]:
    """Missing tables, missing columns and missing manifest entries, by schema alone (no scan)."""
    errors = []
    for name, contract in contracts.items():
        if name not in tables:
            errors.append(f"missing table: {name}")
            continue
        present = set(tables[name].columns)
        errors.extend(f"{name}: missing column {c}" for c in contract.types if c not in present)
        if manifests is not None and name not in manifests:
            errors.append(f"missing manifest entry: {name}")
    return errors


def contract_report(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract] = CONTRACTS
) -> DataFrame:
    """One row per expected column: expected type, found type, row count of the table holding it."""
    from pyspark.sql import functions as F

    rows = []
    for name, contract in contracts.items():
        if name not in tables:
            continue
        found = dict(tables[name].dtypes)
        expected = F.array(
            *[
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit(c).alias("column_name"),
                    F.lit(t).alias("expected_type"),
                    F.lit(found.get(c)).alias("found_type"),
                    F.lit(c in found).alias("present"),
                )
                for c, t in contract.types.items()
            ]
        )
        counted = tables[name].agg(F.count(F.lit(1)).alias("table_rows"))
        rows.append(counted.select(F.explode(expected).alias("r"), "table_rows").select("r.*", "table_rows"))
    out = rows[0]
    for part in rows[1:]:
        out = out.unionByName(part)
    return out
