from __future__ import annotations

from conftest import at, on, rows
from pyspark.sql import functions as F

from tidemark.functions.exprs import bucket, elapsed_seconds, is_finite, ratio, week_start
from tidemark.operators import activity, adoption, executive, funnel, retention, rootcause, segments
from tidemark.operators import sequences as seq

JOURNEY = [
    ("u1", "t1", "document_uploaded", "2026-03-02T10:00:00.900"),
    ("u1", "t1", "ocr_completed", "2026-03-02T10:01:00"),
    ("u1", "t1", "ocr_completed", "2026-03-02T10:00:30"),
    ("u1", "t1", "field_edited", "2026-03-02T10:02:00"),
    ("u1", "t1", "form_review_started", "2026-03-02T10:03:00"),
    ("u1", "t1", "form_exported", "2026-03-02T10:05:01.100"),
    ("u2", "t2", "document_uploaded", "2026-03-03T09:00:00"),
    ("u2", "t2", "task_abandoned", "2026-03-03T09:30:00"),
    ("u2", "t3", "document_uploaded", "2026-03-03T11:00:00"),
    ("u2", "t3", "agent_run_failed", "2026-03-03T11:30:00"),
    ("u2", "t4", "ocr_started", "2026-03-04T11:30:00"),
]


def test_sequence_keeps_first_times_and_counts(make_events):
    out = seq.task_event_sequence(make_events(JOURNEY)).where("task_id = 't1'").first()
    assert out["ocr_completed_at"] == at("2026-03-02T10:00:30")
    assert (out["event_count"], out["field_edit_count"], out["reached_ocr"], out["had_failure"]) == (6, 1, 1, 0)
    assert out["failure_stage_guess"] is None


def test_outcomes_follow_priority_and_count_second_boundaries(make_events):
    out = seq.task_outcomes(seq.task_event_sequence(make_events(JOURNEY)))
    assert rows(out, "task_id", "final_outcome", "task_duration_seconds") == {
        ("t1", "exported", 301),
        ("t2", "abandoned", 1800),
        ("t3", "failed", 1800),
        ("t4", "in_progress", None),
    }


def test_seconds_are_boundaries_not_elapsed(spark):
    df = spark.createDataFrame([(at("2026-01-01T00:00:00.900"), at("2026-01-01T00:00:01.100"))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(elapsed_seconds("a", "b")).first()[0] == 1


def test_ratio_is_double_and_null_for_zero(spark):
    df = spark.sql("select 1L as a, 3L as b, 0L as z")
    out = df.select(ratio("a", "b").alias("r"), ratio("a", "z").alias("n"))
    assert dict(out.dtypes)["r"] == "double" and out.first() == (1 / 3, None)


def test_weeks_start_on_monday(spark):
    df = spark.createDataFrame([(on("2026-03-01"),), (on("2026-03-02"),)], "d date")
    assert [r[0] for r in df.select(week_start("d")).collect()] == [on("2026-02-23"), on("2026-03-02")]


def test_is_finite(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (-float("inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(is_finite("x")).collect()] == [True, False, False, False, False]


def test_bucket_picks_first_bound(spark):
    df = spark.createDataFrame([(1,), (7,), (8,)], "x int")
    assert [r[0] for r in df.select(bucket(F.col("x"), ((1, "a"), (7, "b")), "c")).collect()] == ["a", "b", "c"]


def test_funnel_counts_distinct_tasks(make_events):
    flags = seq.task_funnel_flags(seq.task_event_sequence(make_events(JOURNEY + [("u9", "t1", "document_uploaded", "2026-03-02T12:00:00")])))
    out = {r["step"]: r for r in funnel.conversion_funnel(flags).collect()}
    assert out["uploaded"]["tasks"] == 4 and out["exported"]["tasks"] == 1
    assert out["ocr_completed"]["step_conversion"] == 0.25 and out["ocr_completed"]["dropoff"] == 3
    assert out["risk_detection_completed"]["step_conversion"] is None  # nothing reached the step before


def test_sliced_funnel_reads_zero_for_empty_slices(make_events, make_users, spark):
    flags = seq.task_funnel_flags(seq.task_event_sequence(make_events(JOURNEY)))
    documents = spark.createDataFrame([("d1", "simple")], "document_id string, complexity_level string")
    enriched = seq.task_funnel_enriched(flags, make_users([("u1", "2026-03-01", "organic")]), documents)
    assert rows(enriched, "task_id", "acquisition_channel") == {("t1", "organic"), ("t2", "unknown"), ("t3", "unknown")}
    out = funnel.sliced_funnel(enriched, funnel.slice_filters(device_type="tablet")).collect()
    assert {(r["task_count"], r["pct_of_step1"]) for r in out} == {(0, 0.0)}


def test_rolling_users_match_a_direct_count(make_events):
    days = {"a": [1, 2, 9], "b": [2], "c": [5, 6, 7, 28], "d": [1, 30]}
    events = make_events([(u, f"t{u}{d}", "ocr_started", f"2026-01-{d:02d}T08:00:00") for u, ds in days.items() for d in ds])
    for r in activity.rolling_active_users(events).collect():
        today = r["event_date"].day
        assert r["wau_distinct"] == sum(any(today - 6 <= d <= today for d in ds) for ds in days.values())
        assert r["mau_distinct"] == sum(any(today - 29 <= d <= today for d in ds) for ds in days.values())


def test_retention_rates_are_null_until_matured(make_users, make_events):
    users = make_users([("u1", "2026-01-01", "organic"), ("u2", "2026-01-01", "organic"), ("u3", "2026-01-07", "organic")])
    events = make_events(
        [("u1", "t1", "ocr_started", "2026-01-02T00:00:01"), ("u1", "t1", "ocr_started", "2026-01-08T23:59:59"), ("u3", "t2", "ocr_started", "2026-01-07T10:00:00")]
    )
    out = {r["cohort_date"]: r for r in retention.retention_cohort(users, events).collect()}
    first, late = out[on("2026-01-01")], out[on("2026-01-07")]
    assert (first["d1_retention_rate"], first["d7_retention_rate"], first["d30_retention_rate"]) == (0.5, 0.5, None)
    assert (late["d1_matured"], late["d7_matured"], late["d7_eligible_users"], late["d7_retention_rate"]) == (True, False, 0, None)
    active = retention.retention_cohort(users, events, population="active")
    assert rows(active, "cohort_date", "eligible_users") == {(on("2026-01-01"), 1), (on("2026-01-07"), 1)}


def test_weekly_retention_uses_matured_days_and_sample_size(spark):
    def day(d, channel, eligible, retained, matured):
        return (on(d), channel, matured, eligible if matured else 0, retained)

    data = [
        day("2026-02-16", "organic", 30, 6, True),
        day("2026-02-17", "organic", 10, 4, True),
        day("2026-02-18", "organic", 50, 9, False),
        day("2026-02-16", "social", 8, 2, True),
        day("2026-02-23", "social", 40, 1, False),
    ]
    mart = spark.createDataFrame(data, "cohort_date date, acquisition_channel string, d7_matured boolean, d7_eligible_users bigint, d7_retained_users bigint")
    weekly = retention.weekly_retention(mart, (7,))
    assert rows(weekly, "acquisition_channel", "d7_eligible_users", "d7_weighted_rate", "d7_sample_status") == {
        ("organic", 40, 0.25, "ok"),
        ("social", 8, 0.25, "insufficient"),
        ("social", 0, None, "unmatured"),
    }
    assert retention.all_channel_weekly(weekly, 7).count() == 0  # one channel can be plotted
    lone = retention.weekly_retention(mart.where("acquisition_channel = 'social'"), (7,))
    assert retention.all_channel_weekly(lone, 7).count() == 2
    assert retention.sample_size_summary(weekly, (7,)).count() == 3


def test_adoption_rank_is_taken_after_unpivot(make_events):
    flags = seq.task_funnel_flags(seq.task_event_sequence(make_events(JOURNEY)))
    ranks = rows(adoption.adoption_trend(flags).where("event_date = '2026-03-02'"), "feature", "feature_rank")
    assert ("ocr", 1) in ranks and ("autofill", 3) in ranks


def test_time_to_first_use_drops_negative_days(make_events, make_users, spark):
    documents = spark.createDataFrame([("d1", "simple")], "document_id string, complexity_level string")
    events = make_events(
        [("u1", "t1", "ocr_completed", "2026-01-05T00:00:00"), ("u1", "t2", "ocr_completed", "2026-01-09T00:00:00"), ("u2", "t3", "ocr_completed", "2026-01-01T00:00:00")]
    )
    users = make_users([("u1", "2026-01-03", "organic"), ("u2", "2026-01-02", "organic")])
    out = adoption.feature_time_to_first_use(seq.task_event_sequence(events), users, documents)
    assert rows(out, "feature_name", "days_to_first_use", "user_count") == {("OCR", 2, 1)}


def daily(spark, data):
    return spark.createDataFrame(
        [(u, on(d), 1, 1, 0) for u, d in data], "user_id string, activity_date date, tasks_touched bigint, tasks_started bigint, had_export int"
    )


def test_lifecycle_modes_differ_on_gaps(spark):
    data = [("u", f"2026-01-{d:02d}") for d in (1, 3, 5, 8, 12)] + [("u", "2026-03-01")]
    by_rows = rows(activity.lifecycle_segments(daily(spark, data)), "activity_date", "lifecycle_stage")
    by_days = rows(activity.lifecycle_segments(daily(spark, data), mode="days"), "activity_date", "lifecycle_stage")
    assert (on("2026-01-08"), "active") in by_rows and (on("2026-01-08"), "retained") in by_days
    assert (on("2026-03-01"), "resurrected") in by_rows & by_days
    assert {(on("2026-01-13"), "churned"), (on("2026-02-11"), "dormant")} <= by_days


def test_streaks(spark):
    data = [("u", f"2026-01-{d:02d}") for d in (1, 2, 3, 4, 6, 7)] + [("v", "2026-01-02")]
    out = activity.activity_streaks(daily(spark, data))
    assert rows(out, "user_id", "streak_start", "streak_end", "streak_days") == {("u", on("2026-01-01"), on("2026-01-04"), 4)}
    marked = rows(activity.streak_days(daily(spark, data)), "activity_date", "streak_users")
    assert (on("2026-01-02"), 1) in marked and (on("2026-01-04"), 0) in marked


def test_return_rates_use_exact_offsets(spark):
    frame = daily(spark, [("u", "2026-01-01"), ("u", "2026-01-02"), ("u", "2026-01-08"), ("v", "2026-01-01")]).withColumn("had_export", F.lit(1))
    out = {r["activity_date"]: r for r in activity.activity_return_rates(frame).collect()}
    first = out[on("2026-01-01")]
    assert (first["active_users"], first["retained_d1_users"], first["retained_d7_users"], first["retained_d30_users"]) == (2, 1, 1, 0)


def test_ranks_with_ties(make_users, spark):
    users = make_users([(u, "2026-01-01", "organic") for u in "abcde"])
    firsts = spark.createDataFrame(
        [("a", on("2026-01-02")), ("b", on("2026-01-02")), ("c", on("2026-01-02")), ("d", on("2026-01-05")), ("e", None)],
        "user_id string, first_export_date date",
    )
    out = activity.time_to_first_export(users, firsts)
    assert rows(out, "user_id", "rank_days_to_export", "dense_rank_days_to_export", "row_number_days_to_export") == {
        ("a", 1, 1, 1), ("b", 1, 1, 2), ("c", 1, 1, 3), ("d", 4, 2, 4),
    }


def test_latest_task_breaks_ties_by_outcome_then_id(make_events):
    same = "2026-01-02T10:00:00"
    events = make_events(
        [("u", "t1", "form_exported", same), ("u", "t2", "task_abandoned", same), ("u", "t3", "task_abandoned", same), ("v", "t8", "ocr_started", same), ("v", "t9", "ocr_started", same)]
    )
    out = activity.latest_task_per_user(seq.task_outcomes(seq.task_event_sequence(events)), F.lit("2026-01-10").cast("date"))
    assert rows(out, "user_id", "task_id", "latest_status", "days_since_latest_activity") == {("u", "t1", "exported", 8), ("v", "t9", "uploaded", 20463)}


def test_weekly_review_weights(make_events):
    events = make_events(JOURNEY)
    flags = seq.task_funnel_flags(seq.task_event_sequence(events))
    by_event = executive.weekly_business_review(events, flags).first()["avg_edits"]
    by_task = executive.weekly_business_review(events, flags, weight="task").first()["avg_edits"]
    assert by_event == 6 / 11 and by_task == 1 / 4


def test_alerts_use_the_first_breach(make_events, spark):
    events = make_events(JOURNEY)
    flags = seq.task_funnel_flags(seq.task_event_sequence(events))
    agent = spark.createDataFrame([(on("2026-03-02"), 0.5, 20000.0)], "run_date date, agent_success_rate double, p95_latency_ms double")
    out = rows(executive.daily_alerts(events, flags, agent), "event_date", "alert_status")
    assert out == {(on("2026-03-02"), "LOW_AGENT_SUCCESS"), (on("2026-03-03"), "HIGH_FAILURE_RATE"), (on("2026-03-04"), "LOW_EXPORT_RATE")}


def test_window_clamp(spark):
    days = spark.createDataFrame([(on("2026-02-14"),), (on("2026-06-13"),)], "d date")
    clamp = lambda a, b: tuple(str(x) for x in executive.clamp_window(days, "d", a, b).first())
    assert clamp(None, None) == ("2026-05-14", "2026-06-13")
    assert clamp("2020-01-01", "2030-01-01") == ("2026-02-14", "2026-06-13")
    assert clamp("2026-03-01", "2026-03-05") == ("2026-03-01", "2026-03-05")
    assert clamp("2026-05-01", "2026-03-01") == ("2026-05-14", "2026-06-13")
    assert clamp("2027-01-01", None) == ("2026-06-13", "2026-06-13")
    assert clamp(None, "2026-01-01") == ("2026-05-14", "2026-06-13")


def periods(spark, data):
    return spark.createDataFrame(
        [("dim", s, *v) for s, v in data.items()],
        "dimension_name string, segment string, prior_volume bigint, prior_hits bigint, current_volume bigint, current_hits bigint",
    )


def test_decomposition_adds_up(spark):
    out = rootcause.kitagawa(periods(spark, {"a": (50, 40, 50, 45), "b": (50, 30, 50, 30)}), ["dimension_name"]).collect()
    assert abs(sum(r["total_effect"] for r in out) - 0.05) < 1e-12 and abs(out[0]["residual"]) < 1e-12
    flat = rootcause.kitagawa(periods(spark, {"a": (60, 30, 60, 30), "b": (40, 10, 40, 10)}), ["dimension_name"]).collect()
    assert all(r["total_effect"] == 0 for r in flat)
    gone = rootcause.kitagawa(periods(spark, {"a": (10, 5, 0, 0), "b": (90, 9, 70, 21), "c": (0, 0, 30, 3)}), ["dimension_name"]).collect()
    assert abs(gone[0]["residual"]) < 1e-12


def test_top_contributors_per_sign(spark):
    effects = rootcause.kitagawa(periods(spark, {"a": (50, 40, 50, 10), "b": (50, 10, 50, 40), "c": (50, 20, 50, 25)}), ["dimension_name"])
    out = rootcause.top_contributors(effects, k=1)
    assert rows(out, "direction", "segment") == {("negative", "a"), ("positive", "b")}


def test_task_in_two_segments_counts_in_both(spark):
    enriched = spark.createDataFrame(
        [(on("2026-01-01"), "t1", True, "s1"), (on("2026-01-01"), "t1", False, "s2"), (on("2026-01-01"), "t1", False, "s1")],
        "event_date date, task_id string, did_export boolean, user_segment string",
    )
    out = segments.export_rate_by_dimension(enriched, {"user_segment": "user_segment"})
    assert rows(out, "segment", "total_tasks", "exported_tasks") == {("s1", 1, 1), ("s2", 1, 0)}
