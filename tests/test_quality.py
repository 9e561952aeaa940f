from __future__ import annotations

import pytest
from conftest import at, on, rows
from pyspark.sql import functions as F

from tidemark.operators import contrasts
from tidemark.operators import quality as q
from tidemark.sources import profile, raw, sinks, staging
from tidemark.sources.contracts import AGENT_RUNS, CONTRACTS, DOCUMENTS, USERS, contract_errors

USER_ROW = ("u1", at("2026-01-01T00:00:00"), "organic", "DE", "mobile", "student", "small", "new", False)


def users(spark, *data):
    return spark.createDataFrame(list(data), USERS.ddl())


def change(row, **kw):
    names = list(USERS.types)
    return tuple(kw.get(n, v) for n, v in zip(names, row, strict=True))


def test_clean_table_has_no_violations(spark):
    assert q.contract_violations(users(spark, USER_ROW, change(USER_ROW, user_id="u2")), USERS).count() == 0


def test_every_broken_rule_is_named(spark):
    frame = users(
        spark, USER_ROW, USER_ROW, change(USER_ROW, user_id="u3", device_type="fridge"), change(USER_ROW, user_id="u4", country=None)
    )
    assert rows(q.contract_violations(frame, USERS), "column_name", "rule", "failing_rows") == {
        ("user_id", "unique", 2), ("device_type", "allowed_values", 1), ("country", "not_null", 1),
    }
    documents = spark.createDataFrame([("d1", "u1", "invoice", "en", 0, "simple", True, False, at("2026-01-01T00:00:00"))], DOCUMENTS.ddl())
    assert rows(q.contract_violations(documents, DOCUMENTS), "column_name", "rule") == {("page_count", "minimum")}
    assert ("country", "missing_column") in rows(q.contract_violations(users(spark, USER_ROW).drop("country"), USERS), "column_name", "rule")


def test_orphans_are_counted_once_with_five_examples(spark):
    parent = spark.createDataFrame([("u0",)], "user_id string")
    child = spark.createDataFrame([(f"u{i % 8}",) for i in range(100)] + [(None,)], "user_id string")
    tables = {"users": parent, "sessions": child}
    out = q.referential_integrity(tables).collect()
    assert len(out) == 1 and out[0]["check_id"] == "RI-007" and out[0]["severity"] == "FATAL"
    assert out[0]["record_id"] == "u1,u2,u3,u4,u5" and out[0]["failure_reason"].startswith("7 ")
    assert q.referential_integrity({"users": parent, "sessions": parent}).count() == 0


def test_reversed_times(spark):
    ddl = "session_id string, started_at timestamp_ntz, ended_at timestamp_ntz"
    good = ("s1", at("2026-01-01T00:00:00"), at("2026-01-01T00:00:00"))
    bad = ("s2", at("2026-01-01T00:00:01"), at("2026-01-01T00:00:00"))
    assert q.temporal_consistency({"sessions": spark.createDataFrame([good], ddl)}).count() == 0
    out = q.temporal_consistency({"sessions": spark.createDataFrame([good, bad], ddl)}).first()
    assert (out["check_id"], out["record_id"]) == ("TC-003", "s2")


def test_contamination_severity_depends_on_expectation(spark):
    frame = spark.createDataFrame([("u", "A"), ("u", "B"), ("v", "A")], "user_id string, experiment_group string")
    assert q.experiment_contamination(frame).first()["severity"] == "FATAL"
    expected = q.experiment_contamination(frame, expected=True).first()
    assert (expected["severity"], expected["expected_anomaly"], expected["phenomenon_id"]) == ("WARNING", True, "P08")
    assert q.experiment_contamination(frame.where("user_id = 'v'")).count() == 0


def test_duplicate_uploads_count_every_copy(make_events):
    upload = lambda u, t, d: (u, t, "document_uploaded", "2026-01-01T00:00:00", d)
    events = make_events([upload("u", "t1", "d1"), upload("u", "t2", "d1"), upload("u", "t3", "d2"), upload("v", "t4", "d1")])
    out = q.duplicate_uploads(events).first()
    assert out["failure_reason"].startswith("2 ") and out["record_id"] == "e0,e1"
    assert q.duplicate_uploads(make_events([upload("u", "t1", "d1")])).count() == 0


def test_failure_records_follow_the_schema(spark, tmp_path):
    frame = spark.createDataFrame([("u", "A"), ("u", "B")], "user_id string, experiment_group string")
    out = q.experiment_contamination(frame)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in q.FAILURE_SCHEMA]
    path = sinks.publish_parquet(out, str(tmp_path / "failures"))
    assert spark.read.parquet(path).count() == 1


def test_summary_status(spark):
    def failures(*severities):
        data = [(f"c{i}", s, s == "WARNING") for i, s in enumerate(severities)]
        return spark.createDataFrame(data, "check_id string, severity string, expected_anomaly boolean")

    assert q.check_summary(failures()).first()["overall_status"] == "passed"
    warned = q.check_summary(failures("WARNING")).first()
    assert (warned["overall_status"], warned["checks_passed"], warned["unexpected_failures"]) == ("warnings", 4, 0)
    assert q.check_summary(failures("WARNING", "FATAL")).first()["overall_status"] == "failed"


def reconciled(spark, *data):
    ddl = "metric_id string, source_value double, warehouse_value double, tolerance double, stored_passed boolean"
    return q.reconcile_values(spark.createDataFrame([("m", *d) for d in data], ddl))


def test_reconciliation_recomputes_stored_verdicts(spark):
    ok = q.reconciliation_verdict(reconciled(spark, (1.0, 1.005, 0.01, True))).first()
    assert ok["accepted"]
    wrong = q.reconciliation_verdict(reconciled(spark, (1.0, 1.29, 0.01, True))).first()
    assert (wrong["accepted"], wrong["incorrect_pass_flag_count"], wrong["hardcoded_pass_count"]) == (False, 1, 1)
    missing = q.reconciliation_verdict(reconciled(spark, (None, 1.0, 0.01, None))).first()
    assert (missing["accepted"], missing["incomplete_reconciliation_rows"], missing["non_finite_reconciliation_rows"]) == (False, 1, 0)
    nan = q.reconciliation_verdict(reconciled(spark, (1.0, 1.0, float("nan"), None))).first()
    assert (nan["accepted"], nan["non_finite_reconciliation_rows"]) == (False, 1)
    assert not q.reconciliation_verdict(reconciled(spark)).first()["accepted"]


def test_row_counts(spark):
    counts = lambda **kw: spark.createDataFrame(list(kw.items()), "table_name string, row_count bigint")
    assert q.count_verdict(q.reconcile_counts(counts(a=3, b=4), counts(a=3, b=4))).first()["strict_reconciliation_passed"]
    assert not q.count_verdict(q.reconcile_counts(counts(a=3), counts(a=2))).first()["strict_reconciliation_passed"]
    assert not q.count_verdict(q.reconcile_counts(counts(a=3, b=1), counts(a=3))).first()["strict_reconciliation_passed"]
    assert not q.count_verdict(q.reconcile_counts(counts(a=3).limit(0), counts(a=3).limit(0))).first()["strict_reconciliation_passed"]


def test_provenance(spark):
    base = users(spark, USER_ROW)
    same = {n: raw.with_lineage(base, "r", "c", n) for n in ("x", "y")}
    assert q.provenance(same, "r", "c").first()["provenance_matches"]
    assert not q.provenance(same, "other", "c").first()["provenance_matches"]
    mixed = dict(same, z=raw.with_lineage(base, "r2", "c", "z"))
    assert not q.provenance(mixed, "r", "c").first()["source_consistent"]


def test_precedence(make_events):
    early, late = "2026-01-01T00:00:00", "2026-01-02T00:00:00"
    events = make_events(
        [("u", "good", "form_review_started", early), ("u", "good", "form_exported", late), ("u", "bad", "form_exported", early), ("u", "bad", "form_review_started", late), ("u", "open", "form_exported", early)]
    )
    assert rows(q.event_precedence(events, "form_review_started", "form_exported"), "task_id") == {("bad",)}


def test_result_contract_fails_on_empty(spark):
    frame = spark.createDataFrame([(0.5,), (1.5,)], "rate double")
    bad = {"unit": ~F.col("rate").between(0, 1)}
    assert rows(q.result_contract("r", frame, bad), "violations", "passed") == {(1, False)}
    assert rows(q.result_contract("r", frame.limit(0), bad), "violations", "passed") == {(0, False)}
    assert rows(q.result_contract("r", frame.where("rate < 1"), bad), "violations", "passed") == {(0, True)}


def test_contract_errors_name_what_is_missing(spark):
    errors = contract_errors({"users": users(spark, USER_ROW).drop("country")}, manifests={})
    assert "users: missing column country" in errors and "missing table: sessions" in errors
    assert "missing manifest entry: users" in errors


def test_staging_casts_and_derives(spark):
    text = spark.createDataFrame([("d1", "u1", "invoice", "en", "3", "complex", "true", "false", "2026-01-05 10:00:00")],
                                 ", ".join(f"{c} string" for c in DOCUMENTS.types))
    out = staging.stage(text, DOCUMENTS)
    first = out.first()
    assert dict(out.dtypes)["page_count"] == "int" and first["created_date"] == on("2026-01-05") and first["is_complex"]
    rejected = staging.cast_rejects(text.withColumn("page_count", F.lit("three")), DOCUMENTS)
    assert rows(rejected.where("rejected_rows > 0"), "column_name", "rejected_rows") == {("page_count", 1)}


def test_lineage_names_the_file(spark, tmp_path):
    path = sinks.publish_parquet(users(spark, USER_ROW), str(tmp_path / "u"))
    out = raw.with_lineage(raw.read_parquet(spark, path, USERS), "r", "c").first()
    assert out["_source_run_id"] == "r" and str(tmp_path / "u") in out["_source_file"] and out["_loaded_at_utc"] is not None


def test_csv_round_trip_and_empty_header(spark, tmp_path):
    frame = users(spark, USER_ROW, change(USER_ROW, user_id="ü2", country=None))
    back = raw.read_csv(spark, sinks.export_csv(frame, str(tmp_path / "a")), USERS)
    assert rows(back, "user_id", "country", "is_returning_user") == {("u1", "DE", False), ("ü2", None, False)}
    sinks.export_csv(frame.limit(0), str(tmp_path / "b"), single_file=True)
    written = [p for p in (tmp_path / "b").iterdir() if p.suffix == ".csv"]
    assert len(written) == 1 and written[0].read_text(encoding="utf-8").strip() == ",".join(USERS.types)


def test_content_hash_ignores_order_and_sees_changes(spark):
    frame = spark.createDataFrame([(i, i / 3, f"n{i}", None if i % 5 else on("2026-01-01")) for i in range(200)], "a int, x double, n string, d date")
    base = profile.content_hash(frame, "t").first()
    assert profile.content_hash(frame.repartition(7).orderBy(F.desc("a")), "t").first() == base
    assert profile.content_hash(frame.withColumn("n", F.when(F.col("a") == 17, "x").otherwise(F.col("n"))), "t").first() != base
    assert profile.content_hash(frame.union(frame.limit(1)), "t").first() != base


def test_layer_as_views(spark):
    raw.register_views({"users": users(spark, USER_ROW)}, "stg_")
    found = spark.sql("SELECT user_id FROM stg_users WHERE country = :country", args={"country": "DE"})
    assert rows(found, "user_id") == {("u1",)}


def test_materialised_layer_equals_the_lazy_one(spark, tmp_path):
    from catalog.registry import warehouse
    from conftest import SMALL

    warehouse(spark, SMALL).materialise_marts(str(tmp_path))
    # a second build in the same place
    lazy, written = warehouse(spark, SMALL), warehouse(spark, SMALL).materialise_marts(str(tmp_path))
    assert len(written) == 21
    for name in ("conversion_funnel", "executive_daily_scorecard", "alerts", "ab_test_summary", "export_rate_dimension_daily"):
        expected = getattr(lazy, name)
        shown = [F.round(c, 6) if t == "double" else F.col(c) for c, t in expected.dtypes]
        assert sorted(map(repr, expected.select(*shown).collect())) == sorted(map(repr, written[name].select(*shown).collect()))


def test_verify_raw(spark):
    tables = {"users": users(spark, USER_ROW)}
    manifest = lambda n: spark.createDataFrame([("users", n)], "table_name string, expected_rows bigint")
    assert profile.verify_raw(tables, CONTRACTS, manifest(1)).first()["passed"]
    assert not profile.verify_raw(tables, CONTRACTS, manifest(2)).first()["passed"]


def test_column_profile(spark):
    run = spark.createDataFrame([("r1", None)], "agent_run_id string, error_type string")
    out = rows(profile.column_profile(run, AGENT_RUNS, distinct=True), "column_name", "is_primary_key", "null_count")
    assert out == {("agent_run_id", True, 0), ("error_type", False, 1)}


def test_contrast_directions_and_empty_sides(spark):
    frame = spark.createDataFrame([("A", 1.0), ("A", 3.0), ("B", 5.0), ("C", 100.0)], "g string, v double")
    out = contrasts.contrast(frame, contrasts.either("g", "A", "B"), F.col("v"), "P", "m", "A", "B").first()
    assert (out["baseline_value"], out["affected_value"], out["relative_difference"], out["passed"]) == (2.0, 5.0, 1.5, True)
    none = contrasts.contrast(frame, contrasts.either("g", "A", "Z"), F.col("v"), "P", "m", "A", "Z").first()
    assert none["affected_n"] == 0 and none["passed"] is False


def test_duplicate_rate_moves_with_the_anomaly(make_events):
    base = [(f"u{i}", f"t{i}", "document_uploaded", f"2026-01-0{1 + i % 3}T00:00:00", f"d{i}") for i in range(30)]
    clean = contrasts.duplicate_rate(make_events(base)).first()
    copies = contrasts.duplicate_rate(make_events(base + base[:9:3])).first()
    assert (clean["affected_value"], clean["passed"]) == (0.0, False)
    assert copies["passed"] and copies["affected_group"] == "day_2026-01-01"


def test_publication_keeps_old_versions_and_counts_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, path)
    first = sinks.publish(spark.range(10), path, measures={"odd": F.count_if(F.col("id") % 2 == 1)})
    assert (first["version"], first["rows"], first["odd"], first["columns"]) == (1, 10, 5, [["id", "bigint"]])
    # a table may be rebuilt from itself
    again = sinks.read_published(spark, path)
    assert sinks.publish(again.where("id < 4").withColumn("g", F.col("id") % 2), path, ["g"])["rows"] == 4
    assert sinks.read_published(spark, path).count() == 4 and sinks.read_published(spark, path, 1).count() == 10
    assert sinks.publish(spark.range(0), path)["rows"] == 0
    assert sinks.prune(spark, path, keep=2) == [1]
    assert sinks.read_published(spark, path, 2).count() == 4
    with pytest.raises(FileNotFoundError):
        sinks.manifest(spark, path, 1)


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.publish(spark.range(10), path)
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.publish(broken, path)
    assert sinks.manifest(spark, path)["version"] == 1 and sinks.read_published(spark, path).count() == 10


def test_writers_never_take_the_same_number(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda n: sinks.publish(spark.range(n), path), range(1, 9)))
    assert sorted(m["version"] for m in made) == list(range(1, 9))
    for entry in made:
        assert sinks.read_published(spark, path, entry["version"]).count() == entry["rows"]


def test_verification_reports_the_one_table_that_lost_rows(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("users", "documents")}
    sinks.publish(users(spark, USER_ROW, change(USER_ROW, user_id="u2")), paths["users"])
    sinks.publish(spark.createDataFrame([("d1",)], "document_id string"), paths["documents"])
    sinks.publish(users(spark, USER_ROW), paths["users"])
    tables = {n: sinks.read_published(spark, p) for n, p in paths.items()}
    out = profile.verify_raw(tables, CONTRACTS, sinks.manifests(spark, paths, {"users": 1}))
    assert rows(out, "table_name", "passed") == {("users", False), ("documents", True)}


def test_contract_rules_fire_on_text_that_was_not_cast(spark):
    from tidemark.sources.contracts import Contract

    contract = Contract("t", {"k": "string", "n": "int", "at": "timestamp_ntz", "label": "string"}, primary_key="k", minimum={"n": 0}, maximum={"n": 9})
    data = [("a", "5", "2026-01-01 00:00:00", "x"), ("b", "-1", "later", "x"), ("c", "ten", None, "x"), ("c", "10", "2026-01-01", None)]
    text = spark.createDataFrame(data, "k string, n string, at string, label string")
    found = rows(q.contract_violations(text, contract), "column_name", "rule", "failing_rows")
    assert found == {("n", "type", 1), ("n", "minimum", 1), ("n", "maximum", 1), ("at", "type", 1), ("at", "not_null", 1),
                     ("label", "not_null", 1), ("k", "unique", 2)}
    numbers = text.where("n = '5'").select("k", F.lit(5).alias("n"), F.lit(None).cast("timestamp_ntz").alias("at"), F.lit(7).alias("label"))
    assert rows(q.contract_violations(numbers, contract), "column_name", "rule") == {("label", "type"), ("at", "not_null")}
