"""Sources, contracts, integrity checks, reconciliation, assertions and contrasts."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import catalog.agent  # noqa: F401  (the marts' counterparts are registered there)
import catalog.experiments  # noqa: F401
import catalog.product  # noqa: F401
from catalog.registry import SELECTS, register
from tidemark.operators import agents, contrasts
from tidemark.operators import quality as q
from tidemark.plans import assertions, faults
from tidemark.plans.warehouse import MARTS
from tidemark.session import shared_folder
from tidemark.sources import profile, raw, sinks, staging
from tidemark.sources.contracts import (
    AGENT_RUNS,
    AGENT_SPANS,
    ASSIGNMENTS,
    CONTRACTS,
    DOCUMENTS,
    EVENT_NAMES,
    PRODUCT_EVENTS,
    SESSIONS,
    USERS,
    contract_report,
)

RUN_ID, CONFIG_HASH = "run_1", "cfg_1"
ROLE = {
    "users": "r_users",
    "documents": "r_documents",
    "sessions": "r_sessions",
    "product_events": "r_events",
    "agent_runs": "r_runs",
    "agent_spans": "r_spans",
    "experiment_assignments": "r_assign",
}


def union_sql(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


# ---- sources and staging -----------------------------------------------------------------------
register(
    "raw_events_with_lineage",
    lambda w: raw.with_lineage(w.raw("product_events"), RUN_ID, CONFIG_HASH).drop("_loaded_at_utc", "_source_file"),
    f"SELECT *, '{RUN_ID}' AS _source_run_id, '{CONFIG_HASH}' AS _source_config_hash FROM r_events",
    "latency_ms",
)
register("staged_users", lambda w: w.users, "SELECT * FROM users")
register("staged_documents", lambda w: w.documents, "SELECT * FROM docs", integers="page_count")
register("staged_sessions", lambda w: w.sessions, "SELECT * FROM r_sessions", integers="page_views")
register("staged_product_events", lambda w: w.events, "SELECT * FROM r_events", "latency_ms")
register(
    "staged_agent_runs", lambda w: w.runs, "SELECT * FROM runs", "estimated_cost_usd quality_score field_accuracy",
    "tool_call_count retry_count manual_edit_count", binding="traces",
)
register("staged_agent_spans", lambda w: w.spans, "SELECT * FROM r_spans", "estimated_cost_usd", binding="traces")
register("staged_experiment_assignments", lambda w: w.assignments, "SELECT * FROM r_assign")


def _rejects(w) -> DataFrame:
    """Text columns read as numbers and dates: the number of values each cast would lose."""
    as_text = w.raw("agent_runs").select(
        F.col("agent_run_id"),
        F.col("model_name").alias("total_latency_ms"),
        F.col("started_at").cast("string").alias("started_at"),
        F.col("prompt_version").alias("estimated_cost_usd"),
    )
    return staging.cast_rejects(as_text, AGENT_RUNS)


register(
    "cast_rejects",
    _rejects,
    union_sql(
        [
            f"SELECT 'agent_runs' AS table_name, '{c}' AS column_name, count(*) AS checked_rows, "
            f"count(*) FILTER ({src} IS NOT NULL AND TRY_CAST({src} AS {t}) IS NULL) AS rejected_rows FROM runs"
            for c, src, t in (
                ("started_at", "started_at::VARCHAR", "TIMESTAMP"),
                ("total_latency_ms", "model_name", "BIGINT"),
                ("estimated_cost_usd", "prompt_version", "DOUBLE"),
            )
        ]
    ),
    binding="traces",
)
register(
    "contract_report",
    lambda w: contract_report(w.all_raw()),
    union_sql(
        [
            f"SELECT '{n}' AS table_name, c AS column_name, t AS expected_type, f AS found_type, f IS NOT NULL AS present, table_rows "
            f"FROM (VALUES {{{n}}}) v(c, t, f), (SELECT count(*) AS table_rows FROM {ROLE[n]})"
            for n in CONTRACTS
        ]
    ).format(
        **{
            n: ", ".join(
                f"('{c}', '{t}', '{_found}')"
                for c, t in CONTRACTS[n].types.items()
                for _found in [
                    "bigint" if c.endswith("_id") and t == "string" and c != "experiment_id"
                    else "decimal(30,9)" if (n, c) == ("agent_spans", "estimated_cost_usd")
                    else t
                ]
            )
            for n in CONTRACTS
        }
    ),
)


def _landed(w) -> dict[str, str]:
    """Publish every raw table; the writing job records how many rows it wrote."""
    folder = _scratch(w)
    paths = {n: f"{folder}/{n}" for n in w.all_raw()}
    for name, frame in w.all_raw().items():
        sinks.publish(frame, paths[name])
    return paths


def _verified(w) -> DataFrame:
    spark, paths = w.users.sparkSession, _landed(w)
    tables = {n: sinks.read_published(spark, p) for n, p in paths.items()}
    return profile.verify_raw(tables, CONTRACTS, sinks.manifests(spark, paths))


def _verified_after_loss(w) -> DataFrame:
    """Two tables landed again with rows lost; their files no longer agree with the first manifest."""
    spark, paths = w.users.sparkSession, _landed(w)
    sinks.publish(w.raw("users").where("device_type <> 'mobile'"), paths["users"])
    sinks.publish(w.raw("agent_runs").where("error_type IS NULL"), paths["agent_runs"])
    tables = {n: sinks.read_published(spark, p) for n, p in paths.items()}
    return profile.verify_raw(tables, CONTRACTS, sinks.manifests(spark, paths, dict.fromkeys(paths, 1)))


def _verified_sql(left: dict[str, str]) -> str:
    return union_sql(
        [
            f"SELECT '{n}' AS table_name, count(*) FILTER ({left.get(n, 'true')}) AS row_count, count(*) AS expected_rows, "
            f"count(*) FILTER ({c.primary_key} IS NULL) AS null_pk_count, "
            f"count(*) FILTER ({left.get(n, 'true')}) = count(*) AND count(*) FILTER ({c.primary_key} IS NULL) = 0 AS passed FROM {ROLE[n]}"
            for n, c in CONTRACTS.items()
        ]
    )


register("raw_layer_verification", _verified, _verified_sql({}))
register(
    "raw_layer_verification_after_loss",
    _verified_after_loss,
    _verified_sql({"users": "device_type <> 'mobile'", "agent_runs": "error_type IS NULL"}),
)
TARGETS = {
    "users": 2000, "documents": 1500, "sessions": 3000, "product_events": 12000, "agent_runs": 1500, "agent_spans": 6000,
    "experiment_assignments": 2000,
}
register(
    "target_deviation",
    lambda w: profile.target_deviation({n: w.raw(n) for n in TARGETS}, TARGETS),
    union_sql(
        [
            f"SELECT '{n}' AS table_name, {t}::BIGINT AS configured_target, count(*) AS actual_rows, "
            f"round((count(*) - {t}) / {t}, 4) AS deviation_ratio FROM {ROLE[n]}"
            for n, t in TARGETS.items()
        ]
    ),
    "deviation_ratio",
)
# identifiers arrive as integers; the unstaged cost of spans is a decimal
RAW_TYPE = {("agent_spans", "estimated_cost_usd"): "decimal(30,9)"}


def _profile_sql(contract) -> str:
    parents = {f.column: f"'{f.parent}.{f.parent_column}'" for f in contract.foreign_keys}
    return union_sql(
        [
            f"SELECT '{contract.name}' AS table_name, '{c}' AS column_name, "
            f"'{'bigint' if c.endswith('_id') and t == 'string' and c != 'experiment_id' else RAW_TYPE.get((contract.name, c), t)}' AS data_type, "
            f"{c == contract.primary_key} AS is_primary_key, {parents.get(c, 'NULL::VARCHAR')} AS \"references\", count(*) AS row_count, "
            f"count(*) FILTER ({c} IS NULL) AS null_count FROM {ROLE[contract.name]}"
            for c, t in contract.types.items()
        ]
    )


register(
    "column_profile",
    lambda w: q.union_all([profile.column_profile(w.raw(n), c) for n, c in CONTRACTS.items()]),
    union_sql([_profile_sql(c) for c in CONTRACTS.values()]),
)


def _hash_sql(contract) -> str:
    """Every column of a table as text, in name order; NULL has a mark of its own."""
    forms = {
        "timestamp_ntz": "strftime({c}, '%Y-%m-%dT%H:%M:%S.%f')", "date": "strftime({c}, '%Y-%m-%d')", "double": "printf('%.10f', {c}::DOUBLE)",
    }
    texts = ", ".join(f"coalesce({forms.get(t, '{c}::VARCHAR').format(c=c)}, 'NULL')" for c, t in sorted(contract.types.items()))
    sums = ", ".join(f"sum(('0x' || substr(d, {8 * i + 1}, 8))::BIGINT)::VARCHAR AS digest_{i + 1}" for i in range(4))
    return (
        f"SELECT '{contract.name}' AS table_name, count(*) AS row_count, {sums} "
        f"FROM (SELECT sha256(concat_ws(chr(31), {texts})) AS d FROM {ROLE[contract.name]})"
    )


register(
    "content_hash",
    lambda w: q.union_all([profile.content_hash(w.staged(n), n, list(c.types)) for n, c in CONTRACTS.items()]),
    union_sql([_hash_sql(c) for c in CONTRACTS.values()]),
)


def _scratch(w) -> str:
    spark = w.users.sparkSession
    return f"{shared_folder(spark).rstrip('/')}/tidemark/{uuid.uuid4().hex}"


def _csv_roundtrip(w) -> DataFrame:
    path = sinks.export_csv(w.raw("agent_runs"), _scratch(w))
    ddl = ", ".join(f"`{c}` {t}" for c, t in w.raw("agent_runs").dtypes)
    return raw.read_csv(w.users.sparkSession, path, ddl)


RUN_DOUBLES = "estimated_cost_usd quality_score field_accuracy"
register(
    "csv_export_and_read", _csv_roundtrip, "SELECT * FROM r_runs", RUN_DOUBLES,
    "tool_call_count retry_count manual_edit_count", binding="traces",
)


def _parquet_roundtrip(w) -> DataFrame:
    path = sinks.publish_parquet(w.events, _scratch(w), ["event_date"])
    return raw.read_parquet(w.users.sparkSession, path)


register("parquet_publish_and_read", _parquet_roundtrip, "SELECT * FROM r_events", "latency_ms")
def _mart_counts(w) -> DataFrame:
    """Rows of all marts as the jobs that wrote them counted them."""
    folder = _scratch(w)
    w.materialise_marts(folder)
    counted = sinks.manifests(w.users.sparkSession, {n: f"{folder}/{n}" for n in MARTS})
    return counted.withColumnRenamed("expected_rows", "row_count")


# the counterparts of all marts, over the same tables as the marts
MART_COUNTS = union_sql(
    [f"SELECT '{n}' AS table_name, count(*) AS row_count FROM ({SELECTS['daily_alerts' if n == 'alerts' else n]}) AS {n}_rows" for n in MARTS]
)
register("materialised_mart_rows", _mart_counts, MART_COUNTS)


def _layer_counts(w) -> DataFrame:
    parts = [profile.row_counts(t).withColumn("layer", F.lit(name)) for name, t in (("raw", w.all_raw()), ("staging", w.all_staged()))]
    return q.union_all([*parts, _mart_counts(w).withColumn("layer", F.lit("mart"))])


register(
    "layer_row_counts",
    _layer_counts,
    union_sql(
        [f"SELECT '{n}' AS table_name, count(*) AS row_count, '{layer}' AS layer FROM {r}" for layer in ("raw", "staging") for n, r in ROLE.items()]
        + [f"SELECT *, 'mart' AS layer FROM ({MART_COUNTS}) AS marts"]
    ),
)

# ---- rules -------------------------------------------------------------------------------------


def _rule_sql(contract, table: str) -> str:
    parts = []
    for c in contract.types:
        if c in contract.required:
            parts.append((c, "not_null", f"{c} IS NULL"))
        if c in contract.allowed:
            listed = ", ".join(f"'{v}'" for v in contract.allowed[c])
            parts.append((c, "allowed_values", f"{c} NOT IN ({listed})"))
        if c in contract.minimum:
            parts.append((c, "minimum", f"{c} < {contract.minimum[c]}"))
        if c in contract.maximum:
            parts.append((c, "maximum", f"{c} > {contract.maximum[c]}"))
    rules = [
        f"SELECT '{contract.name}' AS table_name, '{c}' AS column_name, '{r}' AS rule, count(*) FILTER ({bad}) AS failing_rows FROM {table}"
        for c, r, bad in parts
    ]
    rules += [
        f"SELECT '{contract.name}' AS table_name, '{k}' AS column_name, 'unique' AS rule, coalesce(sum(n), 0)::BIGINT AS failing_rows "
        f"FROM (SELECT count(*) AS n FROM {table} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1)"
        for k in (contract.primary_key, *contract.unique)
    ]
    return f"SELECT * FROM ({union_sql(rules)}) WHERE failing_rows > 0"


for _name, _contract, _binding in (
    ("schema_contract_users", USERS, "product"),
    ("schema_contract_documents", DOCUMENTS, "product"),
    ("schema_contract_sessions", SESSIONS, "product"),
    ("schema_contract_events", PRODUCT_EVENTS, "product"),
    ("schema_contract_runs", AGENT_RUNS, "traces"),
    ("schema_contract_spans", AGENT_SPANS, "traces"),
    ("schema_contract_assignments", ASSIGNMENTS, "product"),
):
    register(
        _name,
        lambda w, c=_contract: q.contract_violations(w.staged(c.name), c),
        _rule_sql(_contract, ROLE[_contract.name]),
        binding=_binding,
    )


# Runs as a text file would deliver them, with faults of every kind: times and numbers that are none, and
# values that break a bound only once they are read as numbers.
TEXT_FAULTS = {
    "started_at": ("error_type IS NOT NULL", "'soon'"),
    "total_latency_ms": ("error_type IS NOT NULL", "'-5'"),
    "quality_score": ("error_type IS NOT NULL", "'1.5'"),
    "retry_count": ("success_flag", "'none'"),
    "model_name": ("error_type IS NOT NULL", "NULL"),
    "trace_id": ("error_type IS NOT NULL", "'same'"),
}


def _as_text(w) -> DataFrame:
    runs = w.raw("agent_runs")
    columns = [
        F.when(F.expr(TEXT_FAULTS[c][0]), F.expr(TEXT_FAULTS[c][1])).otherwise(F.col(c).cast("string")).alias(c)
        if c in TEXT_FAULTS else F.col(c).cast("string").alias(c)
        for c in AGENT_RUNS.types
    ]
    return runs.select(*columns)


def _text_rules_sql() -> str:
    faulty = ", ".join(f"CASE WHEN {when} THEN {then} ELSE {c}::VARCHAR END AS {c}" for c, (when, then) in TEXT_FAULTS.items())
    casts = {"timestamp_ntz": "TIMESTAMP", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    read = ", ".join(f"TRY_CAST({c} AS {casts[t]}) AS {c}" for c, t in AGENT_RUNS.types.items() if t != "string")
    wrong = [
        f"SELECT 'agent_runs' AS table_name, '{c}' AS column_name, 'type' AS rule, count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS {casts[t]}) IS NULL) AS failing_rows FROM texts"
        for c, t in AGENT_RUNS.types.items() if t != "string"
    ]
    # a value that is no number is missing nowhere: it breaks the type rule alone
    present = _rule_sql(AGENT_RUNS, "typed")
    for c, t in AGENT_RUNS.types.items():
        if t != "string":
            present = present.replace(f"count(*) FILTER ({c} IS NULL) AS failing_rows FROM typed", f"count(*) FILTER ({c} IS NULL) AS failing_rows FROM texts")
    return f"""WITH texts AS (SELECT * REPLACE ({faulty}) FROM r_runs), typed AS (SELECT * REPLACE ({read}) FROM texts)
        {present} UNION ALL SELECT * FROM ({union_sql(wrong)}) WHERE failing_rows > 0"""


register("schema_contract_on_text", lambda w: q.contract_violations(_as_text(w), AGENT_RUNS), _text_rules_sql(), binding="traces")
register(
    "rule_not_null",
    lambda w: q.not_null(w.runs, "error_type").select("agent_run_id"),
    "SELECT agent_run_id FROM runs WHERE error_type IS NULL",
    binding="traces",
)
register(
    "rule_unique",
    lambda w: q.duplicate_keys(w.spans, ["span_id"]),
    "SELECT span_id, count(*) AS copies FROM r_spans GROUP BY 1 HAVING count(*) > 1",
    binding="traces",
)
register(
    "rule_accepted_values",
    lambda w: q.accepted_values(w.events, "event_name", EVENT_NAMES[:8]),
    "SELECT event_name, count(*) AS rows FROM r_events WHERE event_name NOT IN ("
    + ", ".join(f"'{e}'" for e in EVENT_NAMES[:8])
    + ") GROUP BY 1",
)


def records(df: DataFrame) -> DataFrame:
    return df.drop("detected_at")


def record_sql(offenders: str, check: str, name: str, table: str, reason: str, severity="FATAL", expected=False, phenomenon=None):
    tag = f"'{phenomenon}'" if phenomenon else "NULL::VARCHAR"
    return (
        f"SELECT '{check}' AS check_id, '{name}' AS check_name, '{severity}' AS severity, '{table}' AS table_name, "
        f"(SELECT string_agg(k::VARCHAR, ',' ORDER BY k) FROM (SELECT k FROM ({offenders}) ORDER BY k LIMIT 5)) AS record_id, "
        f"n || ' {reason}' AS failure_reason, {expected} AS expected_anomaly, {tag} AS phenomenon_id "
        f"FROM (SELECT count(*) AS n FROM ({offenders})) WHERE n > 0"
    )


REFERENCE_SQL = [
    record_sql(
        f"SELECT DISTINCT {c} AS k FROM {ROLE[t]} WHERE {c} NOT IN (SELECT {pc} FROM {ROLE[p]} WHERE {pc} IS NOT NULL)",
        check, f"{t}.{c} -> {p}.{pc}", t, f"orphan references in {t}",
    )
    for check, t, c, p, pc in q.REFERENCES
]
TIME_SQL = [
    record_sql(f"SELECT {k} AS k FROM {ROLE[t]} WHERE {e} < {s}", check, f"{t} {e} < {s}", t, "rows with reversed times")
    for check, t, k, s, e in q.TIME_ORDER
]
CONTAMINATION = "SELECT user_id AS k FROM r_assign GROUP BY 1 HAVING count(DISTINCT experiment_group) > 1"
DUPLICATES = """SELECT event_id AS k FROM (SELECT event_id, count(*) OVER (PARTITION BY document_id, user_id) AS n FROM r_events
    WHERE event_name = 'document_uploaded') WHERE n > 1"""
CONTAMINATION_SQL = record_sql(CONTAMINATION, "EC-001", "experiment cross-contamination", "experiment_assignments",
                               "users in multiple experiment groups", "WARNING", True, "P08")
DUPLICATE_SQL = record_sql(DUPLICATES, "DE-001", "duplicate document_uploaded events", "product_events", "duplicate upload events detected")
register("referential_integrity", lambda w: records(q.referential_integrity(w.all_staged())), union_sql(REFERENCE_SQL), binding="traces")
register("temporal_consistency", lambda w: records(q.temporal_consistency(w.all_staged())), union_sql(TIME_SQL), binding="traces")
register("experiment_contamination", lambda w: records(q.experiment_contamination(w.assignments, expected=True)), CONTAMINATION_SQL)
register("duplicate_uploads", lambda w: records(q.duplicate_uploads(w.events)), DUPLICATE_SQL)
ALL_CHECKS = union_sql([*REFERENCE_SQL, *TIME_SQL, CONTAMINATION_SQL, DUPLICATE_SQL])
register("all_checks", lambda w: records(q.all_checks(w.all_staged(), expected=["P08"])), ALL_CHECKS, binding="traces")
register(
    "check_summary",
    lambda w: q.check_summary(q.all_checks(w.all_staged(), expected=["P08"])),
    f"""WITH f AS ({ALL_CHECKS})
        SELECT 5::BIGINT AS checks_total, 5 - count(DISTINCT check_id) AS checks_passed, count(*) FILTER (severity = 'WARNING') AS checks_warned,
               count(*) FILTER (severity = 'FATAL') AS checks_failed, count(*) FILTER (expected_anomaly) AS expected_anomalies_detected,
               count(*) FILTER (NOT expected_anomaly) AS unexpected_failures,
               CASE WHEN count(*) FILTER (severity = 'FATAL') > 0 THEN 'failed' WHEN count(*) > 0 THEN 'warnings' ELSE 'passed' END AS overall_status
        FROM f""",
    binding="traces",
)


def _failure_log(w) -> DataFrame:
    path = sinks.publish_parquet(q.schema_failures({"agent_spans": w.spans, "agent_runs": w.runs}), _scratch(w))
    return records(raw.read_parquet(w.users.sparkSession, path))


register(
    "failure_records",
    _failure_log,
    union_sql(
        [
            f"""SELECT 'SCHEMA-' || table_name AS check_id, 'schema contract: ' || column_name || ' ' || rule AS check_name, 'FATAL' AS severity,
                table_name, 'schema_level' AS record_id, failing_rows || ' rows' AS failure_reason, false AS expected_anomaly,
                NULL::VARCHAR AS phenomenon_id FROM ({_rule_sql(c, ROLE[c.name])})"""
            for c in (AGENT_SPANS, AGENT_RUNS)
        ]
    ),
    binding="traces",
)

# ---- reconciliation ----------------------------------------------------------------------------


def _value_rows(w) -> DataFrame:
    """Daily active users counted from raw events against the KPI mart, and edits against mean edits."""
    source = w.raw("product_events").groupBy("event_date").agg(
        F.count_distinct("user_id").cast("double").alias("source_value"),
        F.count_if(F.col("event_name") == "field_edited").cast("double").alias("edits"),
    )
    joined = source.join(w.daily_product_kpis, "event_date")
    day = F.col("event_date").cast("string")
    dau = joined.select(
        F.concat(F.lit("dau_"), day).alias("metric_id"), "source_value", F.col("dau").cast("double").alias("warehouse_value"),
        F.lit(0.0).alias("tolerance"), F.lit(True).alias("stored_passed"),
    )
    edits = joined.select(
        F.concat(F.lit("edits_"), day).alias("metric_id"),
        F.when(F.col("edits") > 60, F.lit(float("nan"))).when(F.col("edits") > 10, F.col("edits")).alias("source_value"),
        F.col("avg_manual_edits").alias("warehouse_value"), F.lit(1.0).alias("tolerance"), (F.col("edits") > 15).alias("stored_passed"),
    )
    return dau.unionByName(edits)


VALUE_ROWS = """SELECT 'dau_' || event_date AS metric_id, s AS source_value, dau::DOUBLE AS warehouse_value, 0::DOUBLE AS tolerance, true AS stored_passed
    FROM (SELECT event_date, count(DISTINCT user_id)::DOUBLE AS s FROM r_events GROUP BY 1) JOIN kpis USING (event_date)
    UNION ALL SELECT 'edits_' || event_date, CASE WHEN e > 60 THEN 'nan'::DOUBLE WHEN e > 10 THEN e::DOUBLE END, avg_manual_edits, 1, e > 15
    FROM (SELECT event_date, count(*) FILTER (event_name = 'field_edited') AS e FROM r_events GROUP BY 1) JOIN kpis USING (event_date)"""
EVALUATED = f"""SELECT *, CASE WHEN is_complete THEN stored_passed = recomputed_passed END AS pass_flag_matches FROM (
    SELECT *, CASE WHEN is_complete THEN abs(source_value - warehouse_value) END AS absolute_difference,
           is_complete AND abs(source_value - warehouse_value) <= tolerance AS recomputed_passed FROM (
        SELECT *, coalesce(isfinite(source_value) AND isfinite(warehouse_value) AND isfinite(tolerance), false) AS is_complete,
               coalesce(isfinite(source_value), true) AND coalesce(isfinite(warehouse_value), true) AND isfinite(tolerance) AS is_finite
        FROM ({VALUE_ROWS})))"""
register(
    "value_reconciliation",
    lambda w: q.reconcile_values(_value_rows(w)).withColumn(
        "source_value", F.when(~F.isnan("source_value"), F.col("source_value"))
    ),
    f"SELECT * REPLACE (CASE WHEN NOT isnan(source_value) THEN source_value END AS source_value) FROM ({EVALUATED})",
    "warehouse_value absolute_difference",
)
register(
    "reconciliation_verdict",
    lambda w: q.reconciliation_verdict(q.reconcile_values(_value_rows(w))),
    f"""SELECT *, row_count > 0 AND incomplete_reconciliation_rows + non_finite_reconciliation_rows + incorrect_pass_flag_count
               + failed_reconciliation_rows + hardcoded_pass_count = 0 AS accepted FROM (
        SELECT count(*) AS row_count, count(*) FILTER (NOT is_complete) AS incomplete_reconciliation_rows,
               count(*) FILTER (NOT is_finite) AS non_finite_reconciliation_rows, count(*) FILTER (NOT pass_flag_matches) AS incorrect_pass_flag_count,
               count(*) FILTER (NOT recomputed_passed) AS failed_reconciliation_rows,
               count(*) FILTER (stored_passed AND (NOT is_complete OR NOT coalesce(pass_flag_matches, true))) AS hardcoded_pass_count
        FROM ({EVALUATED}))""",
)


def _row_counts(w) -> DataFrame:
    return q.reconcile_counts(profile.row_counts(w.all_raw()), profile.row_counts(w.all_staged()))


COUNTS_SQL = union_sql(
    [
        f"SELECT '{n}' AS table_name, count(*) AS raw_rows, count(*) AS staging_rows, 0::BIGINT AS absolute_difference, "
        f"0::DOUBLE AS relative_difference, true AS measurement_completed, true AS passed FROM {r}"
        for n, r in ROLE.items()
    ]
)
register("row_count_reconciliation", _row_counts, COUNTS_SQL, binding="traces")
register(
    "row_count_verdict",
    lambda w: q.count_verdict(_row_counts(w)),
    f"""SELECT count(*) AS reconciliation_row_count, 0::BIGINT AS incomplete_reconciliation_rows, 0::BIGINT AS failed_reconciliation_rows,
               true AS strict_reconciliation_passed FROM ({COUNTS_SQL})""",
)


def _provenance(w) -> DataFrame:
    staged = {
        n: staging.stage(raw.with_lineage(f, RUN_ID, CONFIG_HASH if n != "sessions" else "cfg_0", source_file=n), CONTRACTS[n])
        for n, f in w.all_raw().items()
    }
    return q.provenance(staged, RUN_ID, CONFIG_HASH)


register(
    "provenance_check",
    _provenance,
    f"""WITH l AS ({union_sql([f"SELECT '{RUN_ID}' AS r, '{'cfg_0' if n == 'sessions' else CONFIG_HASH}' AS c FROM {t}" for n, t in ROLE.items()])})
        SELECT count(DISTINCT r) AS run_ids, count(DISTINCT c) AS config_hashes, max(r) AS warehouse_run_id, max(c) AS warehouse_config_hash,
               count(DISTINCT r) = 1 AND count(DISTINCT c) = 1 AS source_consistent, false AS provenance_matches FROM l""",
)

# ---- business metric integrity -----------------------------------------------------------------
LINKAGE = """WITH a AS (SELECT DISTINCT task_id FROM runs), p AS (SELECT DISTINCT task_id FROM r_events),
       i AS (SELECT DISTINCT task_id, user_id AS u, document_id AS d FROM r_events),
       n AS (SELECT (SELECT count(*) FROM a) AS agent_task_count, (SELECT count(*) FROM p) AS product_task_count,
                    (SELECT count(*) FROM a SEMI JOIN p USING (task_id)) AS matching_task_count,
                    (SELECT count(DISTINCT runs.task_id) FROM runs JOIN i ON runs.task_id = i.task_id WHERE user_id <> u) AS user_id_consistency_violations,
                    (SELECT count(DISTINCT runs.task_id) FROM runs JOIN i ON runs.task_id = i.task_id WHERE document_id <> d) AS document_id_consistency_violations)
       SELECT *, round(matching_task_count / greatest(agent_task_count, 1), 6) AS agent_run_task_match_rate,
              round(matching_task_count / greatest(product_task_count, 1), 6) AS product_task_agent_coverage_rate FROM n"""
LINK_DOUBLES = "agent_run_task_match_rate product_task_agent_coverage_rate"
register("task_linkage", lambda w: q.task_linkage(w.runs, w.events), LINKAGE, LINK_DOUBLES)
register("task_linkage_unrelated_runs", lambda w: q.task_linkage(w.runs, w.events), LINKAGE, LINK_DOUBLES, binding="traces")
register(
    "ab_metric_integrity",
    lambda w: q.ab_metric_integrity(w.ab_test_summary, w.ab_test_user_metrics, w.events, w.runs),
    "SELECT count(experiment_group) AS ab_groups_checked, "
    + ", ".join(f"count(*) FILTER ({m} IS NULL) AS {m}_nulls" for m in ("avg_field_accuracy", "avg_latency_ms", "cost_per_task"))
    + ", "
    + ", ".join(
        f"count(*) FILTER ({m} IS NOT NULL AND NOT isfinite({m})) AS {m}_non_finite"
        for m in ("avg_field_accuracy", "avg_latency_ms", "cost_per_task")
    )
    + """, (SELECT round(count(DISTINCT e.task_id) FILTER (agent_run_id IS NOT NULL) / count(DISTINCT e.task_id), 6)
            FROM r_events e LEFT JOIN runs r ON e.task_id = r.task_id) AS ab_agent_metric_coverage_rate,
           (SELECT round(count(DISTINCT u.user_id) FILTER (agent_run_id IS NOT NULL) / count(DISTINCT u.user_id), 6)
            FROM ab_users u LEFT JOIN runs r ON u.user_id = r.user_id) AS user_level_coverage_rate FROM ab_summary""",
    "ab_agent_metric_coverage_rate user_level_coverage_rate",
)
register(
    "executive_grain",
    lambda w: q.executive_grain(w.executive_daily_scorecard, w.daily_product_kpis),
    """SELECT (SELECT count(*) FROM (SELECT event_date FROM scorecard GROUP BY 1 HAVING count(*) > 1)) AS executive_duplicate_date_count,
              (SELECT sum(north_star_metric)::BIGINT FROM scorecard) AS executive_export_total,
              (SELECT sum(exported_tasks)::BIGINT FROM kpis) AS product_export_total, 0::BIGINT AS executive_export_total_delta""",
)
register(
    "terminal_state_conflicts",
    lambda w: q.terminal_state_conflicts(w.task_funnel_flags),
    """SELECT task_id, did_export::BIGINT + did_abandon::BIGINT + did_fail::BIGINT AS terminal_states, did_export AND did_abandon AS export_and_abandon
       FROM (SELECT task_id, bool_or(did_export) AS did_export, bool_or(did_abandon) AS did_abandon, bool_or(did_fail) AS did_fail
             FROM flags GROUP BY 1) WHERE did_export::INT + did_abandon::INT + did_fail::INT > 1""",
)
register(
    "funnel_monotonicity",
    lambda w: q.funnel_monotonicity(w.conversion_funnel),
    """WITH o AS (SELECT list_position(['uploaded', 'ocr_completed', 'anonymization_completed', 'risk_detection_completed', 'autofill_completed',
                  'review_started', 'exported'], step)::BIGINT AS step_order, step, tasks FROM funnel)
       SELECT *, lag(tasks) OVER (ORDER BY step_order) AS previous_tasks,
              coalesce(tasks > lag(tasks) OVER (ORDER BY step_order), false) AS rises FROM o""",
)
register(
    "retention_censoring",
    lambda w: q.retention_censoring(w.retention_cohort),
    union_sql(
        [
            f"SELECT {n}::BIGINT AS horizon, count(*) AS cohorts, count(*) FILTER (d{n}_matured) AS matured_cohorts, "
            f"count(*) FILTER (NOT d{n}_matured AND d{n}_retention_rate IS NOT NULL) AS unmatured_with_rate FROM retention"
            for n in (1, 7, 30)
        ]
    ),
)
register(
    "cross_page_exports",
    lambda w: q.cross_page_exports(w.executive_daily_scorecard, w.conversion_funnel),
    """SELECT a AS executive_exported_tasks, b AS funnel_exported_tasks, abs(a - b) AS delta FROM
       (SELECT sum(north_star_metric)::BIGINT AS a FROM scorecard), (SELECT tasks AS b FROM funnel WHERE step = 'exported')""",
)
register(
    "adoption_rate_range",
    lambda w: q.adoption_rate_range(w.feature_adoption_segmented),
    """SELECT count(*) AS metrics_checked, count(*) FILTER (r BETWEEN 0 AND 1) AS percent_metrics_valid FROM
       (SELECT sum(adopted_users) / sum(total_users) AS r FROM adoption_seg GROUP BY feature_name)""",
)
AGENT_MARTS = {
    "agent_daily_kpis": "agent_kpis",
    "agent_stage_performance": "stage_perf",
    "error_root_cause": "root_cause",
    "model_version_comparison": "model_cmp",
}
register(
    "date_filter_response",
    lambda w: q.date_filter_response({n: getattr(w, n) for n in AGENT_MARTS}),
    union_sql(
        [
            f"SELECT '{n}' AS mart, count(*) AS all_rows, count(*) FILTER (run_date = (SELECT min(run_date) FROM {v})) AS first_day_rows, "
            f"count(*) FILTER (run_date = (SELECT min(run_date) FROM {v})) < count(*) AS date_filtered FROM {v}"
            for n, v in AGENT_MARTS.items()
        ]
    ),
    binding="traces",
)


def _result_contracts(w) -> DataFrame:
    unit = lambda c: ~F.col(c).between(0, 1)
    negative = lambda c: F.col(c) < 0
    pareto = agents.period_error_pareto(w.error_root_cause).agg(F.max("cumulative_pct").alias("last"))
    return q.union_all(
        [
            q.result_contract(
                "feature_adoption", w.feature_adoption_segmented,
                {"adopted_within_total": F.col("adopted_users") > F.col("total_users"), "rate_in_unit": unit("adoption_rate")},
            ),
            q.result_contract(
                "feature_time_to_first_use", w.feature_time_to_first_use,
                {"days_not_negative": negative("days_to_first_use"), "count_positive": F.col("user_count") <= 0},
            ),
            q.result_contract("error_pareto", pareto, {"cumulative_ends_at_one": F.abs(F.col("last") - 1) > 1e-9}),
            q.result_contract(
                "ab_test_user_metrics", w.ab_test_user_metrics,
                {
                    "success_within_tasks": F.col("successful_tasks") > F.col("total_tasks"),
                    "rate_in_unit": unit("task_success_rate"),
                    "latency_not_negative": negative("avg_agent_latency_ms"),
                    "cost_not_negative": negative("total_cost_usd"),
                },
            ),
        ]
    )


def _result_sql(result: str, view: str, rules: dict[str, str]) -> str:
    return union_sql(
        [
            f"SELECT '{result}' AS result, '{r}' AS rule, count(*) AS row_count, count(*) FILTER ({bad}) AS violations, "
            f"count(*) > 0 AND count(*) FILTER ({bad}) = 0 AS passed FROM {view}"
            for r, bad in rules.items()
        ]
    )


register(
    "result_contracts",
    _result_contracts,
    union_sql(
        [
            _result_sql("feature_adoption", "adoption_seg",
                        {"adopted_within_total": "adopted_users > total_users", "rate_in_unit": "adoption_rate NOT BETWEEN 0 AND 1"}),
            _result_sql("feature_time_to_first_use", "ttfu",
                        {"days_not_negative": "days_to_first_use < 0", "count_positive": "user_count <= 0"}),
            _result_sql("error_pareto",
                        "(SELECT sum(s) AS last FROM (SELECT sum(error_count) / (SELECT sum(error_count) FROM root_cause) AS s FROM root_cause GROUP BY error_category))",
                        {"cumulative_ends_at_one": "abs(last - 1) > 1e-9"}),
            _result_sql("ab_test_user_metrics", "ab_users",
                        {"success_within_tasks": "successful_tasks > total_tasks", "rate_in_unit": "task_success_rate NOT BETWEEN 0 AND 1",
                         "latency_not_negative": "avg_agent_latency_ms < 0", "cost_not_negative": "total_cost_usd < 0"}),
        ]
    ),
)
for _name, _after, _column in (
    ("review_before_export", "form_exported", "exported_at"),
    ("review_before_abandon", "task_abandoned", "abandoned_at"),
):
    register(
        _name,
        lambda w, a=_after: q.event_precedence(w.events, "form_review_started", a),
        f"""SELECT task_id, 'form_review_started <= {_after}' AS rule, min(review_started_at) AS before_at, min({_column}) AS after_at
            FROM seq GROUP BY task_id HAVING min(review_started_at) > min({_column})""",
    )
register(
    "event_date_bounds",
    lambda w: q.outside_dates(w.events, "event_date", "2024-01-02", "2024-01-29"),
    """SELECT count(*) AS checked_rows, count(*) FILTER (event_date NOT BETWEEN DATE '2024-01-02' AND DATE '2024-01-29') AS outside_rows
       FROM r_events""",
)

# ---- assertions: violating rows ----------------------------------------------------------------
STEP_PAIRS = list(zip(assertions.PIPELINE, assertions.PIPELINE[1:], strict=False))


def _order_sql(pairs) -> str:
    return union_sql(
        [
            f"SELECT task_id, '{b}' AS step_name, '{a}' AS previous_step, {b} AS step_timestamp, {a} AS previous_step_timestamp "
            f"FROM seq WHERE {b} < {a}"
            for a, b in pairs
        ]
    )


def _retention_rule(rule: str, shown: str) -> str:
    bad = " OR ".join("(" + rule.format(n=n) + ")" for n in (1, 7, 30))
    return f"SELECT cohort_date, acquisition_channel, {shown} FROM retention WHERE {bad}"


MATURED = ", ".join(f"d{n}_matured, d{n}_retention_rate" for n in (1, 7, 30))
RATE_LIST = "d1_retention_rate, d7_retention_rate, d30_retention_rate"
RATE_DOUBLES = "d1_retention_rate d7_retention_rate d30_retention_rate"
SUMMARY = "SELECT experiment_group, avg_field_accuracy, avg_latency_ms, cost_per_task FROM ab_summary WHERE "
SUMMARY_COLUMNS = ("avg_field_accuracy", "avg_latency_ms", "cost_per_task")
# assertion: (SQL, double columns, binding)
ASSERTION_SQL = {
    "agent_coverage_per_group": (
        """SELECT experiment_group, count(*) AS total_tasks, count(agent_run_id) AS tasks_with_agent,
                  count(agent_run_id) / count(*) AS coverage_rate
           FROM (SELECT DISTINCT task_id, experiment_group FROM r_events) e LEFT JOIN (SELECT task_id, agent_run_id FROM runs) r
                ON e.task_id = r.task_id GROUP BY 1 HAVING count(agent_run_id) / count(*) <= 0.99""",
        "coverage_rate", "traces",
    ),
    "summary_metrics_finite": (SUMMARY + " OR ".join(f"NOT isfinite({c})" for c in SUMMARY_COLUMNS), " ".join(SUMMARY_COLUMNS), "product"),
    "summary_metrics_non_null": (SUMMARY + " OR ".join(f"{c} IS NULL" for c in SUMMARY_COLUMNS), " ".join(SUMMARY_COLUMNS), "product"),
    "run_task_exists": ("SELECT DISTINCT task_id FROM runs WHERE task_id NOT IN (SELECT task_id FROM r_events)", "", "traces"),
    "run_identity_matches": (
        """SELECT DISTINCT r.task_id, r.user_id AS agent_user, e.user_id AS product_user, r.document_id AS agent_doc, e.document_id AS product_doc
           FROM runs r JOIN r_events e ON r.task_id = e.task_id WHERE r.user_id <> e.user_id OR r.document_id <> e.document_id""",
        "", "traces",
    ),
    "contaminated_are_identified": (
        "SELECT DISTINCT user_id FROM clean WHERE is_contaminated AND user_id NOT IN (SELECT user_id FROM contaminated)", "", "product"),
    "cost_in_range": (
        """SELECT 'agent_runs' AS table_name, agent_run_id::VARCHAR AS record_id, estimated_cost_usd FROM runs WHERE estimated_cost_usd NOT BETWEEN 0 AND 100
           UNION ALL SELECT 'agent_spans', span_id::VARCHAR, estimated_cost_usd FROM r_spans WHERE estimated_cost_usd NOT BETWEEN 0 AND 100""",
        "estimated_cost_usd", "traces",
    ),
    "daily_kpi_date_unique": ("SELECT event_date, count(*) AS cnt FROM kpis GROUP BY 1 HAVING count(*) > 1", "", "product"),
    "event_temporal_order": (_order_sql(STEP_PAIRS[1:]), "", "product"),
    "scorecard_matches_kpis": (
        """SELECT abs(a - b) AS delta FROM (SELECT sum(north_star_metric)::BIGINT AS a FROM scorecard), (SELECT sum(exported_tasks)::BIGINT AS b FROM kpis)
           WHERE a <> b""", "", "product"),
    "scorecard_matches_funnel": (
        """SELECT abs(a - b) AS delta FROM (SELECT sum(north_star_metric)::BIGINT AS a FROM scorecard), (SELECT tasks AS b FROM funnel WHERE step = 'exported')
           WHERE a <> b""", "", "product"),
    "scorecard_date_unique": ("SELECT event_date, count(*) AS cnt FROM scorecard GROUP BY 1 HAVING count(*) > 1", "", "product"),
    "one_clean_assignment": (
        "SELECT experiment_id, user_id, count(*) AS assignment_count FROM clean GROUP BY 1, 2 HAVING count(*) > 1", "", "product"),
    "export_requires_review": ("SELECT task_id, did_export, did_start_review FROM flags WHERE did_export AND NOT did_start_review", "", "product"),
    "timestamps_monotone": (_order_sql(STEP_PAIRS), "", "product"),
    "denominators_nonzero": ("SELECT run_date, total_runs FROM agent_kpis WHERE coalesce(total_runs, 0) = 0", "", "product"),
    "no_export_abandon_conflict": ("SELECT task_id FROM flags WHERE did_export AND did_abandon", "", "product"),
    "matured_rates_in_range": (_retention_rule("d{n}_matured AND d{n}_retention_rate NOT BETWEEN 0 AND 1", MATURED), RATE_DOUBLES, "product"),
    "retention_bounds": (
        _retention_rule("d{n}_retention_rate NOT BETWEEN 0 AND 1",
                        f"eligible_users, d1_retained_users, d7_retained_users, d30_retained_users, {RATE_LIST}"), RATE_DOUBLES, "product"),
    "known_rates_in_unit_interval": (
        _retention_rule("d{n}_retention_rate IS NOT NULL AND d{n}_retention_rate NOT BETWEEN 0 AND 1", RATE_LIST), RATE_DOUBLES, "product"),
    "span_ends_after_start": (
        "SELECT span_id, trace_id, span_name, start_time, end_time FROM r_spans WHERE end_time < start_time", "", "traces"),
    "success_flag_known": ("SELECT agent_run_id, trace_id, success_flag FROM runs WHERE success_flag IS NULL", "", "product"),
    "unmatured_rate_is_null": (_retention_rule("NOT d{n}_matured AND d{n}_retention_rate IS NOT NULL", MATURED), RATE_DOUBLES, "product"),
}
for _name, (_text, _doubles, _binding) in ASSERTION_SQL.items():
    register(f"assert_{_name}", assertions.ASSERTIONS[_name], _text, _doubles, binding=_binding)
register(
    "assertion_summary",
    assertions.assertion_summary,
    union_sql(
        [f"SELECT '{n}' AS assertion, count(*) AS violations, count(*) = 0 AS passed FROM ({t})" for n, (t, _, _) in ASSERTION_SQL.items()]
    ),
)

# ---- the same checks on models with a planted fault --------------------------------------------
FIRST_WEEK = "day({}) <= 7"
# assertion: (model, fault on the frame, view, the view with the same fault)
FAULTS = {
    "agent_coverage_per_group": (
        "runs", faults.lose_rows("success_flag"), "runs", "SELECT * FROM runs WHERE NOT success_flag"),
    "summary_metrics_finite": (
        "ab_test_summary", faults.overwrite("avg_latency_ms", "'Infinity'", "experiment_group = 'B'"), "ab_summary",
        "SELECT * REPLACE (CASE WHEN experiment_group = 'B' THEN 'inf'::DOUBLE ELSE avg_latency_ms END AS avg_latency_ms) FROM ab_summary"),
    "summary_metrics_non_null": (
        "ab_test_summary", faults.overwrite("avg_field_accuracy", "NULL", "experiment_group = 'A'"), "ab_summary",
        "SELECT * REPLACE (CASE WHEN experiment_group <> 'A' THEN avg_field_accuracy END AS avg_field_accuracy) FROM ab_summary"),
    "daily_kpi_date_unique": (
        "daily_product_kpis", faults.repeat_rows(FIRST_WEEK.format("event_date")), "kpis",
        "SELECT * FROM kpis UNION ALL SELECT * FROM kpis WHERE " + FIRST_WEEK.format("event_date")),
    "scorecard_matches_kpis": (
        "executive_daily_scorecard", faults.lose_rows(FIRST_WEEK.format("event_date")), "scorecard",
        "SELECT * FROM scorecard WHERE NOT " + FIRST_WEEK.format("event_date")),
    "scorecard_date_unique": (
        "executive_daily_scorecard", faults.repeat_rows(FIRST_WEEK.format("event_date")), "scorecard",
        "SELECT * FROM scorecard UNION ALL SELECT * FROM scorecard WHERE " + FIRST_WEEK.format("event_date")),
    "denominators_nonzero": (
        "agent_daily_kpis", faults.overwrite("total_runs", "0", FIRST_WEEK.format("run_date")), "agent_kpis",
        f"SELECT * REPLACE (CASE WHEN {FIRST_WEEK.format('run_date')} THEN 0 ELSE total_runs END AS total_runs) FROM agent_kpis"),
    "matured_rates_in_range": (
        "retention_cohort", faults.overwrite("d1_retention_rate", "1.5", "d1_matured AND eligible_users > 1"), "retention",
        "SELECT * REPLACE (CASE WHEN d1_matured AND eligible_users > 1 THEN 1.5 ELSE d1_retention_rate END AS d1_retention_rate) FROM retention"),
    "retention_bounds": (
        "retention_cohort", faults.overwrite("d7_retention_rate", "-0.25", "eligible_users > 1"), "retention",
        "SELECT * REPLACE (CASE WHEN eligible_users > 1 THEN -0.25 ELSE d7_retention_rate END AS d7_retention_rate) FROM retention"),
    "known_rates_in_unit_interval": (
        "retention_cohort", faults.overwrite("d30_retention_rate", "2", "acquisition_channel = 'BUILDING'"), "retention",
        "SELECT * REPLACE (CASE WHEN acquisition_channel = 'BUILDING' THEN 2 ELSE d30_retention_rate END AS d30_retention_rate) FROM retention"),
    "success_flag_known": (
        "runs", faults.overwrite("success_flag", "NULL", "error_type IS NOT NULL"), "runs",
        "SELECT * REPLACE (CASE WHEN error_type IS NULL THEN success_flag END AS success_flag) FROM runs"),
    "unmatured_rate_is_null": (
        "retention_cohort", faults.overwrite("d30_matured", "false", "acquisition_channel = 'BUILDING'"), "retention",
        "SELECT * REPLACE (d30_matured AND acquisition_channel <> 'BUILDING' AS d30_matured) FROM retention"),
}


def _broken_views(text: str, changed: dict[str, str]) -> str:
    """The text over changed views."""
    for view in changed:
        text = re.sub(rf"\b{view}\b", f"{view}_broken", text)
    return "WITH " + ", ".join(f"{view}_broken AS ({sql})" for view, sql in changed.items()) + f" {text}"


for _name, (_model, _change, _view, _changed) in FAULTS.items():
    _text, _doubles, _binding = ASSERTION_SQL[_name]
    register(
        f"assert_{_name}_broken",
        lambda w, name=_name, model=_model, change=_change: assertions.ASSERTIONS[name](faults.with_fault(w, model, change)),
        _broken_views(_text, {_view: _changed}),
        # an infinite number has no decimal form to round
        _doubles.replace("avg_latency_ms ", "") if _name == "summary_metrics_finite" else _doubles, binding=_binding,
    )
# users and runs lose rows that other tables still refer to
LOST_PARENTS = {
    "users": ("device_type = 'mobile'", "SELECT * FROM r_users WHERE device_type <> 'mobile'"),
    "runs": ("error_type IS NOT NULL", "SELECT * FROM r_runs WHERE error_type IS NULL"),
}


def _orphaned(w):
    for model, (condition, _) in LOST_PARENTS.items():
        faults.with_fault(w, model, faults.lose_rows(condition))
    return records(q.referential_integrity(w.all_staged()))


register(
    "referential_integrity_broken", _orphaned,
    _broken_views(union_sql(REFERENCE_SQL), {"r_users": LOST_PARENTS["users"][1], "r_runs": LOST_PARENTS["runs"][1]}),
)

# ---- contrasts ---------------------------------------------------------------------------------
CONTRAST_DOUBLES = "baseline_value affected_value absolute_difference relative_difference"


def contrast_sql(pid: str, metric: str, base: str, hit: str, source: str, rises: bool = True) -> str:
    """``source`` yields bv, av, bn, an."""
    direction, sign = ("affected > baseline", ">") if rises else ("affected < baseline", "<")
    return f"""SELECT '{pid}' AS phenomenon_id, '{metric}' AS metric, '{base}' AS baseline_group, round(bv, 6) AS baseline_value,
       '{hit}' AS affected_group, round(av, 6) AS affected_value, round(av - bv, 6) AS absolute_difference,
       round((av - bv) / greatest(abs(bv), 1e-10), 6) AS relative_difference, bn AS baseline_n, an AS affected_n,
       '{direction}' AS expected_direction, coalesce(av {sign} bv AND bn > 0 AND an > 0, false) AS passed FROM ({source})"""


def sides(source: str, hit: str, value: str) -> str:
    return (
        f"SELECT avg(v) FILTER (NOT h) AS bv, avg(v) FILTER (h) AS av, count(*) FILTER (NOT h) AS bn, count(*) FILTER (h) AS an "
        f"FROM (SELECT {hit} AS h, ({value})::DOUBLE AS v FROM {source})"
    )


register(
    "contrast_ocr_latency",
    lambda w: contrasts.ocr_latency(w.events),
    contrast_sql(
        "P01", "p95_ocr_latency_ms", "other_versions", "v2.3.0",
        """SELECT quantile_cont(latency_ms, 0.95) FILTER (app_version <> '2.3.0') AS bv, quantile_cont(latency_ms, 0.95) FILTER (app_version = '2.3.0') AS av,
                  count(*) FILTER (app_version <> '2.3.0') AS bn, count(*) FILTER (app_version = '2.3.0') AS an
           FROM r_events WHERE event_name IN ('ocr_started', 'ocr_completed')""",
    ),
    CONTRAST_DOUBLES,
)
register(
    "contrast_complex_edits",
    lambda w: contrasts.complex_edits(w.events, w.documents),
    contrast_sql(
        "P02", "avg_edits_per_document", "simple", "complex",
        sides("(SELECT document_id, count(*) AS n FROM r_events WHERE event_name = 'field_edited' GROUP BY 1) JOIN docs USING (document_id)",
              "CASE complexity_level WHEN 'complex' THEN true WHEN 'simple' THEN false END", "n"),
    ),
    CONTRAST_DOUBLES,
)
register(
    "contrast_mobile_export",
    lambda w: contrasts.mobile_export(w.events, w.users),
    contrast_sql(
        "P03", "review_to_export_rate", "desktop", "mobile",
        """SELECT e0 / greatest(r0, 1) AS bv, e1 / greatest(r1, 1) AS av, r0 AS bn, r1 AS an FROM (
           SELECT count(DISTINCT task_id) FILTER (device_type = 'desktop' AND event_name = 'form_review_started') AS r0,
                  count(DISTINCT task_id) FILTER (device_type = 'desktop' AND event_name = 'form_exported') AS e0,
                  count(DISTINCT task_id) FILTER (device_type = 'mobile' AND event_name = 'form_review_started') AS r1,
                  count(DISTINCT task_id) FILTER (device_type = 'mobile' AND event_name = 'form_exported') AS e1
           FROM r_events JOIN users USING (user_id))""",
        rises=False,
    ),
    CONTRAST_DOUBLES,
)
register(
    "contrast_d7_retention",
    lambda w: contrasts.d7_retention(w.events, w.users, "BUILDING", "MACHINERY"),
    contrast_sql(
        "P04", "d7_retention_rate", "BUILDING", "MACHINERY",
        sides("""(SELECT u.user_id, acquisition_channel, bool_or(event_date = signup_date + 7) AS back FROM users u JOIN r_events e ON u.user_id = e.user_id
                  WHERE signup_date + 7 <= (SELECT max(event_date) FROM r_events) GROUP BY ALL)""",
              "CASE acquisition_channel WHEN 'MACHINERY' THEN true WHEN 'BUILDING' THEN false END", "back::INT"),
        rises=False,
    ),
    CONTRAST_DOUBLES,
)
register(
    "contrast_prompt_cost",
    lambda w: contrasts.prompt_cost(w.runs, "v2", "v1"),
    contrast_sql("P05", "avg_cost_per_run_usd", "v1", "v2", sides("runs", "prompt_version = 'v2'", "estimated_cost_usd")),
    CONTRAST_DOUBLES,
    binding="traces",
)
register(
    "contrast_group_quality",
    lambda w: contrasts.group_quality(w.runs),
    union_sql(
        [
            contrast_sql("P06", m, "A", "B", sides("runs", "CASE experiment_group WHEN 'B' THEN true WHEN 'A' THEN false END", v))
            for m, v in (("field_accuracy", "field_accuracy"), ("avg_latency_ms", "total_latency_ms"))
        ]
    ),
    CONTRAST_DOUBLES,
    binding="traces",
)
register(
    "contrast_duplicate_rate",
    lambda w: contrasts.duplicate_rate(w.events),
    """WITH d AS (SELECT event_date, count(event_id) AS t, count(event_id) - count(DISTINCT document_id) AS r FROM r_events
                  WHERE event_name = 'document_uploaded' GROUP BY 1),
            o AS (SELECT round(sum(r) / sum(t), 6) AS lo, sum(t)::BIGINT AS n FROM d),
            m AS (SELECT event_date, t, round(r / t, 6) AS hi, r / t > 0.05 AS ok FROM d ORDER BY r / t DESC, event_date LIMIT 1)
       SELECT 'P07' AS phenomenon_id, 'affected_day_duplicate_rate' AS metric, 'overall_rate' AS baseline_group, lo AS baseline_value,
              'day_' || event_date AS affected_group, hi AS affected_value, round(hi - lo, 6) AS absolute_difference,
              round((hi - lo) / greatest(abs(lo), 1e-10), 6) AS relative_difference, n AS baseline_n, t AS affected_n,
              'affected day rate > 0.05' AS expected_direction, ok AS passed FROM o, m""",
    CONTRAST_DOUBLES,
)
register(
    "contrast_contamination",
    lambda w: contrasts.group_contamination(w.assignments),
    "SELECT * REPLACE ('contaminated > 0' AS expected_direction, affected_n > 0 AS passed) FROM ("
    + contrast_sql(
        "P08", "users_in_multiple_groups", "clean_users", "contaminated_users",
        """SELECT a::DOUBLE AS bv, b::DOUBLE AS av, a AS bn, b AS an FROM (SELECT count(*) FILTER (k = 1) AS a, count(*) FILTER (k > 1) AS b
           FROM (SELECT count(DISTINCT experiment_group) AS k FROM r_assign GROUP BY user_id))""",
    )
    + ")",
    CONTRAST_DOUBLES,
)
register(
    "contrast_high_risk_retries",
    lambda w: contrasts.high_risk_retries(w.runs, w.documents),
    contrast_sql("P09", "avg_retry_count", "low_risk", "high_risk",
                 sides("runs JOIN (SELECT document_id, contains_high_risk_terms FROM docs) USING (document_id)", "contains_high_risk_terms", "retry_count")),
    CONTRAST_DOUBLES,
)
register(
    "contrast_export_impact",
    lambda w: contrasts.export_impact(w.events),
    """WITH t AS (SELECT task_id, bool_or(event_name = 'agent_run_failed') AS f, bool_or(event_name = 'form_exported') AS e FROM r_events GROUP BY 1),
            c AS (SELECT count(*) AS n, count(*) FILTER (f) AS fails, count(*) FILTER (e) AS done, count(*) FILTER (f AND NOT e) AS lost,
                         count(*) FILTER (NOT e) AS open FROM t)
       SELECT 'P10' AS phenomenon_id, 'overall_export_impact' AS metric, round(fails / n, 6) AS ocr_failure_rate, round(done / n, 6) AS overall_export_rate,
              n AS total_tasks, fails AS ocr_failed_tasks, done AS exported_tasks, lost AS tasks_lost_after_ocr_failure, open AS total_not_exported,
              round(lost / greatest(open, 1), 6) AS ocr_attributable_share, lost / greatest(open, 1) >= 0.2 AND fails > 0 AS passed FROM c""",
    "ocr_failure_rate overall_export_rate ocr_attributable_share",
)
