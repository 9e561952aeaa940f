"""Data-quality rules. Each check yields its violations or one standard failure record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import count_rows, flag, in_unit_interval, is_finite, ratio, stable_round
from tidemark.sources.contracts import CONTRACTS, Contract

FAILURE_SCHEMA = T.StructType(
    [
        T.StructField("check_id", T.StringType(), False),
        T.StructField("check_name", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("record_id", T.StringType(), True),
        T.StructField("failure_reason", T.StringType(), False),
        T.StructField("expected_anomaly", T.BooleanType(), False),
        T.StructField("phenomenon_id", T.StringType(), True),
        T.StructField("detected_at", T.TimestampType(), False),
    ]
)
EXAMPLES = 5

# --- fixed values: check ids of the referential rules -------------------------------------------
REFERENCES = (
    ("RI-001", "product_events", "user_id", "users", "user_id"),
    ("RI-002", "product_events", "session_id", "sessions", "session_id"),
    ("RI-003", "product_events", "document_id", "documents", "document_id"),
    ("RI-004", "agent_runs", "user_id", "users", "user_id"),
    ("RI-005", "agent_spans", "trace_id", "agent_runs", "trace_id"),
    ("RI-006", "experiment_assignments", "user_id", "users", "user_id"),
    ("RI-007", "sessions", "user_id", "users", "user_id"),
    ("RI-008", "documents", "user_id", "users", "user_id"),
)
TIME_ORDER = (
    ("TC-001", "agent_runs", "agent_run_id", "started_at", "ended_at"),
    ("TC-002", "agent_spans", "span_id", "start_time", "end_time"),
    ("TC-003", "sessions", "session_id", "started_at", "ended_at"),
)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def failure_record(
    offenders: DataFrame,
    key: str,
    check_id: str,
    check_name: str,
    table: str,
    reason: str,
    severity: str = "FATAL",
    expected: bool = False,
    phenomenon: str | None = None,
    detected_at: Column | None = None,
) -> DataFrame:
    """At most one row: the number of offenders in ``reason`` and the five smallest as examples.

    Examples come from a top-5 that each task cuts before anything is brought together; offenders
    are only counted.
    """
    smallest = offenders.select(F.col(key).alias("k")).orderBy("k").limit(EXAMPLES)
    examples = smallest.agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("k")), lambda v: v.cast("string")), ",")
    ).scalar()
    counted = offenders.agg(count_rows("n")).where(F.col("n") > 0)
    return counted.select(
        F.lit(check_id).alias("check_id"),
        F.lit(check_name).alias("check_name"),
        F.lit(severity).alias("severity"),
        F.lit(table).alias("table_name"),
        examples.alias("record_id"),
        F.concat(F.col("n").cast("string"), F.lit(f" {reason}")).alias("failure_reason"),
        F.lit(expected).alias("expected_anomaly"),
        F.lit(phenomenon).cast("string").alias("phenomenon_id"),
        (detected_at if detected_at is not None else F.current_timestamp()).alias("detected_at"),
    )


# ---- rules on single tables --------------------------------------------------------------------


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Every rule of a contract with its number of failing rows; rules that hold are left out.

    All row rules share one scan. A uniqueness rule is its own aggregate on the key, which counts
    rows per key map-side.
    """
    found = dict(df.dtypes)
    rules: list[tuple[str, str, Column]] = []
    for name, kind in contract.types.items():
        if name not in found:
            continue
        value = F.col(name)
        if name in contract.required:
            rules.append((name, "not_null", value.isNull()))
        if found[name] == "string" and kind != "string":
            # not cast yet: bounds hold for what the text says, and a text that says nothing breaks the type rule alone
            rules.append((name, "type", value.isNotNull() & value.try_cast(kind).isNull()))
            value = value.try_cast(kind)
        if name in contract.allowed:
            rules.append((name, "allowed_values", value.isNotNull() & ~value.isin(*contract.allowed[name])))
        if name in contract.minimum:
            rules.append((name, "minimum", value < contract.minimum[name]))
        if name in contract.maximum:
            rules.append((name, "maximum", value > contract.maximum[name]))
        if found[name] not in ("string", kind) and (kind != "string" or not name.endswith("_id")):
            # a text column that holds something else is wrong in every row; identifiers may be numbers
            bad = value.isNotNull() if kind == "string" else value.isNotNull() & value.try_cast(kind).isNull()
            rules.append((name, "type", bad))
    totals = df.agg(*[F.count_if(bad).alias(f"__{i}") for i, (_, _, bad) in enumerate(rules)])
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"), F.col(f"__{i}").alias("failing_rows"))
        for i, (c, r, _) in enumerate(rules)
    ]
    parts = [totals.select(F.explode(F.array(*entries)).alias("e")).select("e.*")]
    for key in (contract.primary_key, *contract.unique):
        if key in found:
            parts.append(
                duplicate_keys(df, [key])
                .agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("failing_rows"))
                .select(F.lit(key).alias("column_name"), F.lit("unique").alias("rule"), "failing_rows")
            )
    missing = [c for c in contract.required if c not in found]
    if missing:
        rows = df.agg(count_rows("failing_rows"))
        listed = F.explode(F.array(*[F.lit(c) for c in missing])).alias("column_name")
        parts.append(rows.select(listed, F.lit("missing_column").alias("rule"), "failing_rows"))
    return (
        union_all(parts)
        .where(F.col("failing_rows") > 0)
        .select(F.lit(contract.name).alias("table_name"), "column_name", "rule", "failing_rows")
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of copies (NULL keys are skipped)."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(known).groupBy(*keys).agg(count_rows("copies")).where(F.col("copies") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list with their row counts."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
        .groupBy(column)
        .agg(count_rows("rows"))
    )


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct child keys without a parent row (NULL child keys are not orphans).

    The child side is reduced to distinct keys first: a key that fills a third of the table joins
    as one row.
    """
    keys = child.select(F.col(column).alias("orphan_key")).where(F.col(column).isNotNull()).distinct()
    parents = parent.select(F.col(parent_column).alias("orphan_key"))
    return keys.join(parents, "orphan_key", "left_anti")


def reversed_times(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.where(F.col(end) < F.col(start))


def outside_dates(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """One row: rows checked and rows outside the closed date window."""
    day = F.col(column)
    inside = day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return df.agg(count_rows("checked_rows"), F.count_if(~inside).alias("outside_rows"))


# ---- failure records ---------------------------------------------------------------------------


def referential_integrity(tables: Mapping[str, DataFrame], references=REFERENCES, **kw) -> DataFrame:
    """Orphan references of every rule whose two tables are present."""
    records = []
    for check, child, column, parent, parent_column in references:
        if child in tables and parent in tables:
            orphans = orphan_keys(tables[child], column, tables[parent], parent_column)
            records.append(
                failure_record(
                    orphans,
                    "orphan_key",
                    check,
                    f"{child}.{column} -> {parent}.{parent_column}",
                    child,
                    f"orphan references in {child}",
                    **kw,
                )
            )
    return union_all(records)


def temporal_consistency(tables: Mapping[str, DataFrame], rules=TIME_ORDER, **kw) -> DataFrame:
    """Rows that end before they start."""
    records = []
    for check, table, key, start, end in rules:
        if table in tables:
            bad = reversed_times(tables[table], start, end)
            records.append(
                failure_record(bad, key, check, f"{table} {end} < {start}", table, "rows with reversed times", **kw)
            )
    return union_all(records)


def experiment_contamination(assignments: DataFrame, expected: bool = False, **kw) -> DataFrame:
    """Users in more than one group: a warning when injected on purpose, fatal otherwise."""
    several = (
        assignments.select("user_id", "experiment_group")
        .distinct()
        .groupBy("user_id")
        .agg(F.count("experiment_group").alias("groups"))
        .where(F.col("groups") > 1)
    )
    return failure_record(
        several,
        "user_id",
        "EC-001",
        "experiment cross-contamination",
        "experiment_assignments",
        "users in multiple experiment groups",
        severity="WARNING" if expected else "FATAL",
        expected=expected,
        phenomenon="P08" if expected else None,
        **kw,
    )


def duplicate_uploads(events: DataFrame, expected: bool = False, detected_at: Column | None = None) -> DataFrame:
    """Upload events that share (document, user); every copy counts.

    Counts come from the per-key aggregate. Only the five smallest event ids are looked up in the
    events again.
    """
    uploads = events.where(F.col("event_name") == "document_uploaded")
    keys = duplicate_keys(uploads, ["document_id", "user_id"])
    copies = keys.agg(F.coalesce(F.sum("copies"), F.lit(0))).scalar()
    rows = uploads.select("event_id", "document_id", "user_id").join(
        keys.select("document_id", "user_id"), ["document_id", "user_id"], "left_semi"
    )
    record = failure_record(
        rows,
        "event_id",
        "DE-001",
        "duplicate document_uploaded events",
        "product_events",
        "duplicate upload events detected",
        severity="WARNING" if expected else "FATAL",
        expected=expected,
        phenomenon="P07" if expected else None,
        detected_at=detected_at,
    )
    reason = F.concat(copies.cast("string"), F.lit(" duplicate upload events detected"))
    return record.withColumn("failure_reason", reason)


def schema_failures(tables: Mapping[str, DataFrame], contracts=CONTRACTS, detected_at: Column | None = None) -> DataFrame:
    """Contract violations as failure records: FATAL, one per broken rule."""
    broken = union_all([contract_violations(frame, contracts[name]) for name, frame in tables.items()])
    return broken.select(
        F.concat(F.lit("SCHEMA-"), F.col("table_name")).alias("check_id"),
        F.concat_ws(" ", F.lit("schema contract:"), F.col("column_name"), F.col("rule")).alias("check_name"),
        F.lit("FATAL").alias("severity"),
        "table_name",
        F.lit("schema_level").alias("record_id"),
        F.concat(F.col("failing_rows").cast("string"), F.lit(" rows")).alias("failure_reason"),
        F.lit(False).alias("expected_anomaly"),
        F.lit(None).cast("string").alias("phenomenon_id"),
        (detected_at if detected_at is not None else F.current_timestamp()).alias("detected_at"),
    )


def all_checks(tables: Mapping[str, DataFrame], expected: Sequence[str] = (), detected_at: Column | None = None) -> DataFrame:
    """Failure records of every cross-table check."""
    when = {"detected_at": detected_at}
    return union_all(
        [
            referential_integrity(tables, **when),
            temporal_consistency(tables, **when),
            experiment_contamination(tables["experiment_assignments"], "P08" in expected, **when),
            duplicate_uploads(tables["product_events"], "P07" in expected, **when),
        ]
    )


def check_summary(failures: DataFrame, families: int = 5) -> DataFrame:
    """One row: failures by severity, expected against unexpected, overall status."""
    ids = failures.groupBy("check_id").agg(
        count_rows("n"),
        F.count_if(F.col("severity") == "FATAL").alias("fatal"),
        F.count_if(F.col("severity") == "WARNING").alias("warning"),
        F.count_if("expected_anomaly").alias("expected"),
    )
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    counted = ids.agg(
        count_rows("ids"),
        zero("n").alias("all"),
        zero("fatal").alias("fatal"),
        zero("warning").alias("warning"),
        zero("expected").alias("expected"),
    )
    return counted.select(
        F.lit(families).cast("bigint").alias("checks_total"),
        (F.lit(families) - F.col("ids")).alias("checks_passed"),
        F.col("warning").alias("checks_warned"),
        F.col("fatal").alias("checks_failed"),
        F.col("expected").alias("expected_anomalies_detected"),
        (F.col("all") - F.col("expected")).alias("unexpected_failures"),
        F.when(F.col("fatal") > 0, "failed")
        .when(F.col("warning") > 0, "warnings")
        .otherwise("passed")
        .alias("overall_status"),
    )


# ---- reconciliation ----------------------------------------------------------------------------


def reconcile_values(rows: DataFrame) -> DataFrame:
    """Re-evaluate every reconciliation row from its values; stored verdicts are only compared.

    Input: metric_id, source_value, warehouse_value, tolerance, stored_passed (NULL if none).
    """
    values = ("source_value", "warehouse_value", "tolerance")
    complete = (
        is_finite("source_value")
        & is_finite("warehouse_value")
        & is_finite("tolerance")
        & F.coalesce(F.col("tolerance") >= 0, F.lit(False))
    )
    finite = reduce(lambda a, b: a & b, [F.col(v).isNull() | is_finite(v) for v in values])
    difference = F.abs(F.col("source_value") - F.col("warehouse_value"))
    checked = rows.select("*", complete.alias("is_complete"), finite.alias("is_finite")).withColumns(
        {
            "absolute_difference": F.when(F.col("is_complete"), difference),
            "recomputed_passed": F.when(F.col("is_complete"), difference <= F.col("tolerance")).otherwise(
                F.lit(False)
            ),
        }
    )
    agrees = F.col("stored_passed") == F.col("recomputed_passed")
    return checked.withColumn("pass_flag_matches", F.when(F.col("is_complete"), agrees))


def reconciliation_verdict(evaluated: DataFrame) -> DataFrame:
    """One row: counts of incomplete, non-finite, wrong, failed and hard-coded rows; accepted."""
    hardcoded = F.coalesce(F.col("stored_passed"), F.lit(False)) & (
        ~F.col("is_complete") | F.coalesce(~F.col("pass_flag_matches"), F.lit(False))
    )
    counted = evaluated.agg(
        count_rows("row_count"),
        F.count_if(~F.col("is_complete")).alias("incomplete_reconciliation_rows"),
        F.count_if(~F.col("is_finite")).alias("non_finite_reconciliation_rows"),
        F.count_if(~F.col("pass_flag_matches")).alias("incorrect_pass_flag_count"),
        F.count_if(~F.col("recomputed_passed")).alias("failed_reconciliation_rows"),
        F.count_if(hardcoded).alias("hardcoded_pass_count"),
    )
    clean = reduce(lambda a, b: a & b, [F.col(c) == 0 for c in counted.columns[1:]])
    return counted.withColumn("accepted", (F.col("row_count") > 0) & clean)


def reconcile_counts(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """Raw against staging row counts per table (inputs: table_name, row_count)."""
    joined = (
        raw.select("table_name", F.col("row_count").alias("raw_rows"))
        .join(staged.select("table_name", F.col("row_count").alias("staging_rows")), "table_name", "full_outer")
    )
    delta = F.abs(F.col("raw_rows") - F.col("staging_rows"))
    return joined.select(
        "table_name",
        "raw_rows",
        "staging_rows",
        delta.alias("absolute_difference"),
        ratio(delta, "staging_rows").alias("relative_difference"),
        (F.col("raw_rows").isNotNull() & F.col("staging_rows").isNotNull()).alias("measurement_completed"),
        F.coalesce(delta == 0, F.lit(False)).alias("passed"),
    )


def count_verdict(reconciled: DataFrame) -> DataFrame:
    """One row: accepted when at least one table was measured, all were, and no count differs."""
    counted = reconciled.agg(
        F.count_if("measurement_completed").alias("reconciliation_row_count"),
        F.count_if(~F.col("measurement_completed")).alias("incomplete_reconciliation_rows"),
        F.count_if(F.col("measurement_completed") & ~F.col("passed")).alias("failed_reconciliation_rows"),
    )
    return counted.withColumn(
        "strict_reconciliation_passed",
        (F.col("reconciliation_row_count") > 0)
        & (F.col("incomplete_reconciliation_rows") == 0)
        & (F.col("failed_reconciliation_rows") == 0),
    )


def provenance(staged: Mapping[str, DataFrame], run_id: str, config_hash: str) -> DataFrame:
    """One row: exactly one lineage pair over all staged tables, equal to the expected one."""
    pairs = union_all(
        [f.select("_source_run_id", "_source_config_hash").distinct() for f in staged.values()]
    ).distinct()
    counted = pairs.agg(
        F.count_distinct("_source_run_id").alias("run_ids"),
        F.count_distinct("_source_config_hash").alias("config_hashes"),
        F.max("_source_run_id").alias("warehouse_run_id"),
        F.max("_source_config_hash").alias("warehouse_config_hash"),
    )
    single = (F.col("run_ids") == 1) & (F.col("config_hashes") == 1)
    same = (F.col("warehouse_run_id") == run_id) & (F.col("warehouse_config_hash") == config_hash)
    return counted.select(
        "*",
        single.alias("source_consistent"),
        F.coalesce(single & same, F.lit(False)).alias("provenance_matches"),
    )


# ---- business metric integrity -----------------------------------------------------------------


def task_linkage(runs: DataFrame, events: DataFrame) -> DataFrame:
    """One row: how runs match product tasks and whether users and documents agree."""
    identity = ["task_id", "user_id", "document_id"]
    product = events.select(*identity).distinct()
    agent = runs.select(*identity).distinct()
    agent_tasks = agent.select("task_id").where(F.col("task_id").isNotNull()).distinct()
    product_tasks = product.select("task_id").where(F.col("task_id").isNotNull()).distinct()
    matched = agent_tasks.join(product_tasks, "task_id", "left_semi")
    theirs = product.select("task_id", F.col("user_id").alias("__u"), F.col("document_id").alias("__d"))
    mismatch = (
        agent.join(theirs, "task_id")
        .groupBy("task_id")
        .agg(
            F.max(flag(F.col("user_id") != F.col("__u"))).alias("u"),
            F.max(flag(F.col("document_id") != F.col("__d"))).alias("d"),
        )
        .agg(F.coalesce(F.sum("u"), F.lit(0)).alias("u"), F.coalesce(F.sum("d"), F.lit(0)).alias("d"))
    )
    size = lambda f: f.agg(F.count(F.lit(1))).scalar()
    base = mismatch.select(
        size(agent_tasks).alias("agent_task_count"),
        size(product_tasks).alias("product_task_count"),
        size(matched).alias("matching_task_count"),
        F.col("u").alias("user_id_consistency_violations"),
        F.col("d").alias("document_id_consistency_violations"),
    )
    return base.select(
        "agent_task_count",
        "product_task_count",
        "matching_task_count",
        stable_round(ratio("matching_task_count", F.greatest(F.col("agent_task_count"), F.lit(1))), 6).alias(
            "agent_run_task_match_rate"
        ),
        stable_round(ratio("matching_task_count", F.greatest(F.col("product_task_count"), F.lit(1))), 6).alias(
            "product_task_agent_coverage_rate"
        ),
        "user_id_consistency_violations",
        "document_id_consistency_violations",
    )


def ab_metric_integrity(summary: DataFrame, user_metrics: DataFrame, events: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: NULL and non-finite summary metrics, user and task coverage by runs."""
    metrics = ("avg_field_accuracy", "avg_latency_ms", "cost_per_task")
    base = summary.agg(
        F.count("experiment_group").alias("ab_groups_checked"),
        *[F.count_if(F.col(m).isNull()).alias(f"{m}_nulls") for m in metrics],
        *[F.count_if(F.col(m).isNotNull() & ~is_finite(m)).alias(f"{m}_non_finite") for m in metrics],
    )

    def coverage(keys: DataFrame, column: str) -> Column:
        have = runs.select(column).where(F.col(column).isNotNull()).distinct().withColumn("__hit", F.lit(True))
        covered = keys.where(F.col(column).isNotNull()).distinct().join(have, column, "left")
        return covered.agg(stable_round(F.coalesce(ratio(F.count("__hit"), F.count(F.lit(1))), F.lit(0.0)), 6)).scalar()

    tasks = events.where(F.col("experiment_group").isin("A", "B")).select("task_id")
    return base.select(
        "*",
        coverage(tasks, "task_id").alias("ab_agent_metric_coverage_rate"),
        coverage(user_metrics.select("user_id"), "user_id").alias("user_level_coverage_rate"),
    )


def executive_grain(scorecard: DataFrame, kpis: DataFrame) -> DataFrame:
    """One row: duplicate dates in the scorecard and the export total against product KPIs."""
    duplicates = scorecard.groupBy("event_date").agg(count_rows("n")).where("n > 1")
    totals = scorecard.agg(F.coalesce(F.sum("north_star_metric"), F.lit(0)).alias("executive_export_total"))
    product = kpis.agg(F.coalesce(F.sum("exported_tasks"), F.lit(0))).scalar()
    return totals.select(
        duplicates.agg(F.count(F.lit(1))).scalar().alias("executive_duplicate_date_count"),
        "executive_export_total",
        product.alias("product_export_total"),
        F.abs(F.col("executive_export_total") - product).alias("executive_export_total_delta"),
    )


def terminal_state_conflicts(flags: DataFrame) -> DataFrame:
    """Tasks with more than one terminal state; export together with abandon is marked."""
    states = flags.groupBy("task_id").agg(
        *[F.max(flag(F.col(c))).alias(c) for c in ("did_export", "did_abandon", "did_fail")]
    )
    number = F.col("did_export") + F.col("did_abandon") + F.col("did_fail")
    return states.where(number > 1).select(
        "task_id",
        number.alias("terminal_states"),
        ((F.col("did_export") == 1) & (F.col("did_abandon") == 1)).alias("export_and_abandon"),
    )


# fixed value: order of the funnel mart's steps
FUNNEL_ORDER = (
    "uploaded",
    "ocr_completed",
    "anonymization_completed",
    "risk_detection_completed",
    "autofill_completed",
    "review_started",
    "exported",
)


def funnel_monotonicity(funnel: DataFrame) -> DataFrame:
    """Each step with the step before: whether the count rose."""
    position = F.array_position(F.array(*[F.lit(s) for s in FUNNEL_ORDER]), F.col("step"))
    before = F.lag("tasks").over(Window.orderBy("step_order"))
    placed = funnel.select(position.alias("step_order"), "step", "tasks")
    return placed.select(
        "step_order",
        "step",
        "tasks",
        before.alias("previous_tasks"),
        F.coalesce(F.col("tasks") > before, F.lit(False)).alias("rises"),
    )


def retention_censoring(retention: DataFrame, horizons: Sequence[int] = (1, 7, 30)) -> DataFrame:
    """Per horizon: cohorts, matured cohorts, unmatured cohorts that still show a rate."""
    entries = [
        F.struct(
            F.lit(n).alias("horizon"),
            F.col(f"d{n}_matured").alias("matured"),
            F.col(f"d{n}_retention_rate").alias("rate"),
        )
        for n in horizons
    ]
    rows = retention.select(F.explode(F.array(*entries)).alias("h")).select("h.*")
    return rows.groupBy("horizon").agg(
        count_rows("cohorts"),
        F.count_if("matured").alias("matured_cohorts"),
        F.count_if(~F.col("matured") & F.col("rate").isNotNull()).alias("unmatured_with_rate"),
    )


def cross_page_exports(scorecard: DataFrame, funnel: DataFrame) -> DataFrame:
    """One row: exports on the scorecard against the funnel's last step."""
    exported = funnel.where(F.col("step") == "exported").agg(F.max("tasks")).scalar()
    total = scorecard.agg(F.coalesce(F.sum("north_star_metric"), F.lit(0)).alias("executive_exported_tasks"))
    return total.select(
        "executive_exported_tasks",
        exported.alias("funnel_exported_tasks"),
        F.abs(F.col("executive_exported_tasks") - exported).alias("delta"),
    )


def adoption_rate_range(segmented: DataFrame) -> DataFrame:
    """One row: features found and features whose overall rate lies in [0, 1]."""
    rates = segmented.groupBy("feature_name").agg(
        ratio(F.sum("adopted_users"), F.sum("total_users")).alias("rate")
    )
    return rates.agg(
        count_rows("metrics_checked"), F.count_if(in_unit_interval("rate")).alias("percent_metrics_valid")
    )


def date_filter_response(marts: Mapping[str, DataFrame], date_column: str = "run_date") -> DataFrame:
    """Per mart: all rows, rows on its first date, whether a one-day slice is smaller."""
    parts = []
    for name, mart in marts.items():
        daily = mart.groupBy(date_column).agg(count_rows("n"))
        parts.append(
            daily.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("all_rows"),
                F.min_by("n", date_column).alias("first_day_rows"),
            ).select(
                F.lit(name).alias("mart"),
                "all_rows",
                "first_day_rows",
                F.coalesce(F.col("first_day_rows") < F.col("all_rows"), F.lit(False)).alias("date_filtered"),
            )
        )
    return union_all(parts)


def result_contract(name: str, rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rule violations of a result set (rule: rows that break it); empty results fail too."""
    counted = rows.agg(count_rows("row_count"), *[F.count_if(bad).alias(r) for r, bad in rules.items()])
    return counted.unpivot(["row_count"], list(rules), "rule", "violations").select(
        F.lit(name).alias("result"),
        "rule",
        "row_count",
        "violations",
        ((F.col("row_count") > 0) & (F.col("violations") == 0)).alias("passed"),
    )


def event_precedence(events: DataFrame, before: str, after: str) -> DataFrame:
    """Tasks whose first ``after`` event comes earlier than their first ``before`` event."""
    first = events.where(F.col("event_name").isin(before, after)).groupBy("task_id").agg(
        F.min(F.when(F.col("event_name") == before, F.col("event_time"))).alias("before_at"),
        F.min(F.when(F.col("event_name") == after, F.col("event_time"))).alias("after_at"),
    )
    return first.where(F.col("before_at") > F.col("after_at")).select(
        "task_id", F.lit(f"{before} <= {after}").alias("rule"), "before_at", "after_at"
    )
