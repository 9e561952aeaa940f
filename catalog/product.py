"""Event sequences, product marts, executive marts and product analysis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import register
from catalog.views import AS_OF
from tidemark.operators import activity, adoption, executive, funnel, retention, rootcause
from tidemark.operators import experiment as ex
from tidemark.operators import sequences as seq

AS_OF_COLUMN = lambda: F.lit(AS_OF).cast("date")

# ---- intermediate ------------------------------------------------------------------------------
register("task_event_sequence", lambda w: w.task_event_sequence, "SELECT * FROM seq")
register("task_funnel_flags", lambda w: w.task_funnel_flags, "SELECT * FROM flags")
register("task_funnel_enriched", lambda w: w.task_funnel_enriched, "SELECT * FROM enriched")
register("task_outcomes", lambda w: w.task_outcomes, "SELECT * FROM outcomes")
register("user_cohorts", lambda w: w.user_cohorts, "SELECT * FROM cohorts")
register("user_daily_activity", lambda w: w.user_daily_activity, "SELECT * FROM daily")
register("user_first_activity", lambda w: w.user_first_activity, "SELECT * FROM first_act")
register(
    "document_complexity_features",
    lambda w: w.document_complexity_features,
    """SELECT d.document_id, d.user_id, document_type, language, page_count, complexity_level, contains_pii,
              contains_high_risk_terms, is_complex, count(DISTINCT task_id) AS task_count,
              count(DISTINCT task_id) FILTER (is_successful) AS successful_task_count,
              avg(field_edit_count) AS avg_field_edits, avg(task_duration_seconds) AS avg_task_duration_seconds
       FROM docs d LEFT JOIN outcomes t ON d.document_id = t.document_id GROUP BY ALL""",
    "avg_field_edits avg_task_duration_seconds",
    "page_count",
)
register(
    "task_context",
    lambda w: seq.task_context(w.events),
    """SELECT task_id, arg_min(user_id, (event_time, event_id)) AS user_id,
              arg_min(document_id, (event_time, event_id)) AS document_id, min(event_time) AS task_started_at,
              arg_min(experiment_id, (event_time, event_id)) AS experiment_id,
              arg_min(experiment_group, (event_time, event_id)) AS experiment_group
       FROM r_events GROUP BY task_id""",
)

# ---- product marts -----------------------------------------------------------------------------
register("conversion_funnel", lambda w: w.conversion_funnel, "SELECT * FROM funnel", "step_conversion overall_conversion")
register(
    "daily_product_kpis", lambda w: w.daily_product_kpis, "SELECT * FROM kpis",
    "export_rate abandonment_rate failure_rate avg_manual_edits",
)
RATES = "d1_retention_rate d7_retention_rate d30_retention_rate"
register("retention_cohort", lambda w: w.retention_cohort, "SELECT * FROM retention", RATES,
         "d1_eligible_users d7_eligible_users d30_eligible_users")
register(
    "retention_cohort_active_users",
    lambda w: retention.retention_cohort(w.users, w.events, (7,), population="active"),
    """SELECT signup_date AS cohort_date, acquisition_channel, count(*) AS eligible_users,
              signup_date <= fin - 7 AS d7_matured,
              CASE WHEN signup_date <= fin - 7 THEN count(*) ELSE 0 END AS d7_eligible_users,
              count(*) FILTER (back) AS d7_retained_users,
              CASE WHEN signup_date <= fin - 7 THEN count(*) FILTER (back) / count(*) END AS d7_retention_rate,
              fin AS observation_end_date
       FROM (SELECT user_id, signup_date, acquisition_channel, bool_or(event_date = signup_date + 7) AS back
             FROM users JOIN r_events USING (user_id) GROUP BY ALL),
            (SELECT max(event_date) AS fin FROM r_events) GROUP BY signup_date, acquisition_channel, fin""",
    "d7_retention_rate", "d7_eligible_users",
)
register(
    "feature_adoption", lambda w: w.feature_adoption, "SELECT * FROM adoption",
    "ocr_adoption anonymization_adoption risk_detection_adoption autofill_adoption",
)
register("feature_adoption_segmented", lambda w: w.feature_adoption_segmented, "SELECT * FROM adoption_seg", "adoption_rate")
register("feature_time_to_first_use", lambda w: w.feature_time_to_first_use, "SELECT * FROM ttfu")
register("export_rate_dimension_daily", lambda w: w.export_rate_dimension_daily, "SELECT * FROM dim_daily", "export_rate")
register(
    "channel_performance",
    lambda w: w.channel_performance,
    """SELECT *, rank() OVER (ORDER BY user_conversion_rate DESC) AS conversion_rank FROM (
           SELECT acquisition_channel, count(DISTINCT u.user_id) AS cohort_users,
                  count(DISTINCT f.user_id) FILTER (did_export) AS converted_users,
                  count(DISTINCT task_id) AS total_tasks, count(DISTINCT task_id) FILTER (did_export) AS exported_tasks,
                  count(DISTINCT f.user_id) FILTER (did_export) / count(DISTINCT u.user_id) AS user_conversion_rate,
                  count(DISTINCT task_id) FILTER (did_export) / nullif(count(DISTINCT task_id), 0) AS task_export_rate
           FROM users u LEFT JOIN flags f ON u.user_id = f.user_id GROUP BY 1)""",
    "user_conversion_rate task_export_rate",
)
register(
    "user_segments",
    lambda w: w.user_segments,
    """SELECT user_segment, acquisition_channel, device_type, count(DISTINCT u.user_id) AS user_count,
              count(DISTINCT task_id) AS total_tasks,
              count(DISTINCT task_id) FILTER (is_successful) / nullif(count(DISTINCT task_id), 0) AS task_success_rate,
              avg(field_edit_count) AS avg_edits, avg(task_duration_seconds) AS avg_duration_s
       FROM users u LEFT JOIN outcomes t ON u.user_id = t.user_id GROUP BY ALL""",
    "task_success_rate avg_edits avg_duration_s",
)

# ---- executive marts ---------------------------------------------------------------------------
register(
    "executive_daily_scorecard", lambda w: w.executive_daily_scorecard, "SELECT * FROM scorecard",
    "export_rate abandonment_rate avg_manual_edits d7_retention agent_success_rate agent_p95_latency_ms "
    "cost_per_successful_task",
)
WEEKLY = """SELECT date_trunc('week', e.event_date)::DATE AS week_start, count(DISTINCT e.user_id) AS wau,
              count(DISTINCT e.task_id) AS weekly_tasks,
              count(DISTINCT e.task_id) FILTER (did_export) AS weekly_exports,
              count(DISTINCT e.task_id) FILTER (did_export) / count(DISTINCT e.task_id) AS export_rate,
              {edits} AS avg_edits,
              count(DISTINCT e.task_id) FILTER (did_fail) / count(DISTINCT e.task_id) AS failure_rate
       FROM r_events e LEFT JOIN flags f ON e.task_id = f.task_id GROUP BY 1"""
register("weekly_business_review", lambda w: w.weekly_business_review, WEEKLY.format(edits="avg(field_edit_count)"),
         "export_rate avg_edits failure_rate")
register(
    "weekly_business_review_task_weighted",
    lambda w: executive.weekly_business_review(w.events, w.task_funnel_flags, weight="task"),
    f"""SELECT * EXCLUDE (avg_edits), (
            SELECT avg(field_edit_count) FROM (SELECT DISTINCT date_trunc('week', event_date)::DATE AS wk, task_id FROM r_events)
            JOIN flags USING (task_id) WHERE wk = week_start) AS avg_edits
        FROM ({WEEKLY.format(edits="0")})""",
    "export_rate avg_edits failure_rate",
)
register(
    "daily_alerts",
    lambda w: w.alerts,
    """WITH d AS (
           SELECT e.event_date, count(DISTINCT e.task_id) FILTER (did_export) / count(DISTINCT e.task_id) AS export_rate,
                  count(DISTINCT e.task_id) FILTER (did_fail) / count(DISTINCT e.task_id) AS failure_rate
           FROM r_events e LEFT JOIN flags f ON e.task_id = f.task_id GROUP BY 1),
       facts AS (SELECT event_date, failure_rate, export_rate, agent_success_rate, p95_latency_ms::DOUBLE AS p95_latency_ms
                 FROM d LEFT JOIN agent_kpis ON event_date = run_date),
       -- fixed values: bounds in order of precedence; side 1 is breached above, -1 below
       bounds(place, alert_status, measure, side, bound) AS (VALUES
           (1, 'HIGH_FAILURE_RATE', 'failure_rate', 1, 0.2::DOUBLE), (2, 'LOW_EXPORT_RATE', 'export_rate', -1, 0.4::DOUBLE),
           (3, 'LOW_AGENT_SUCCESS', 'agent_success_rate', -1, 0.8::DOUBLE), (4, 'HIGH_LATENCY', 'p95_latency_ms', 1, 10000::DOUBLE)),
       measured AS (UNPIVOT facts ON failure_rate, export_rate, agent_success_rate, p95_latency_ms INTO NAME measure VALUE v),
       alerts AS (SELECT event_date, arg_min(alert_status, place) AS alert_status
                  FROM measured JOIN bounds USING (measure) WHERE side * v > side * bound GROUP BY 1)
       SELECT event_date, 'quality' AS alert_type, alert_status, failure_rate, export_rate, agent_success_rate, p95_latency_ms
       FROM alerts JOIN facts USING (event_date)""",
    "failure_rate export_rate agent_success_rate p95_latency_ms",
)

# ---- analysis queries --------------------------------------------------------------------------
register(
    "dau_wau_mau",
    lambda w: activity.rolling_active_users(w.events),
    """WITH ud AS (SELECT DISTINCT event_date, user_id FROM r_events),
            d AS (SELECT event_date, count(*) AS dau FROM ud GROUP BY 1)
       SELECT event_date, dau,
              sum(dau) OVER (ORDER BY event_date ROWS 6 PRECEDING) / 7 AS wau_avg_daily,
              sum(dau) OVER (ORDER BY event_date ROWS 29 PRECEDING) / 30 AS mau_avg_daily,
              (SELECT count(DISTINCT user_id) FROM ud WHERE ud.event_date BETWEEN d.event_date - 6 AND d.event_date) AS wau_distinct,
              (SELECT count(DISTINCT user_id) FROM ud WHERE ud.event_date BETWEEN d.event_date - 29 AND d.event_date) AS mau_distinct
       FROM d""",
    "wau_avg_daily mau_avg_daily",
)
register(
    "new_and_activated_users",
    lambda w: activity.signup_activation(w.users, w.user_cohorts),
    """SELECT u.signup_date, count(*) AS new_users,
              count(*) FILTER (days_to_activation <= 7) AS activated_within_7d,
              round(count(*) FILTER (days_to_activation <= 7) * 100.0 / count(*), 2) AS activation_rate_pct,
              round(avg(days_to_activation), 2) AS avg_days_to_activation,
              quantile_cont(days_to_activation, 0.5) AS median_days_to_activation
       FROM users u LEFT JOIN cohorts c ON u.user_id = c.user_id GROUP BY 1""",
    "activation_rate_pct avg_days_to_activation median_days_to_activation",
)
register(
    "time_to_first_export",
    lambda w: activity.time_to_first_export(w.users, w.user_first_activity),
    """SELECT *, rank() OVER (ORDER BY days_to_export) AS rank_days_to_export,
              row_number() OVER (ORDER BY days_to_export, user_id) AS row_number_days_to_export,
              dense_rank() OVER (ORDER BY days_to_export) AS dense_rank_days_to_export,
              CASE WHEN days_to_export <= 1 THEN 'same_or_next_day' WHEN days_to_export <= 7 THEN 'within_1_week'
                   WHEN days_to_export <= 30 THEN 'within_1_month' WHEN days_to_export <= 90 THEN 'within_3_months'
                   ELSE 'over_3_months' END AS time_bucket
       FROM (SELECT user_id, signup_date, first_export_date, datediff('day', signup_date, first_export_date) AS days_to_export
             FROM users JOIN first_act USING (user_id) WHERE first_export_date IS NOT NULL)""",
)
STEP_ROWS = """(1, '1_upload', true), (2, '2_ocr', did_complete_ocr), (3, '3_anonymization', did_complete_anonymization),
    (4, '4_risk_detection', did_complete_risk_detection), (5, '5_autofill', did_complete_autofill),
    (6, '6_review', did_start_review), (7, '7_export', did_export)"""
register(
    "full_task_funnel",
    lambda w: funnel.full_task_funnel(w.task_funnel_flags),
    f"""WITH s AS (SELECT i, step, count(*) FILTER (hit) AS tasks FROM flags, LATERAL (VALUES {STEP_ROWS}) v(i, step, hit) GROUP BY 1, 2)
        SELECT step, tasks, tasks - lag(tasks) OVER (ORDER BY i) AS dropoff_from_prior,
               round(tasks * 100.0 / nullif(lag(tasks) OVER (ORDER BY i), 0), 2) AS step_conversion_pct,
               round(tasks * 100.0 / nullif(first(tasks) OVER (ORDER BY i), 0), 2) AS overall_conversion_pct,
               round(1.0 - tasks / nullif(lag(tasks) OVER (ORDER BY i), 0), 4) AS step_dropoff_rate FROM s""",
    "step_conversion_pct overall_conversion_pct step_dropoff_rate",
)
register(
    "device_funnel",
    lambda w: funnel.device_funnel(w.task_funnel_flags, w.users),
    f"""WITH s AS (SELECT device_type, i, step, count(*) FILTER (hit) AS tasks
                   FROM flags LEFT JOIN users USING (user_id), LATERAL (VALUES {STEP_ROWS}) v(i, step, hit) GROUP BY 1, 2, 3)
        SELECT device_type, step, tasks,
               round(tasks * 100.0 / nullif(coalesce(lag(tasks) OVER (PARTITION BY device_type ORDER BY i), tasks), 0), 2)
                   AS step_conversion_pct FROM s""",
    "step_conversion_pct",
)
register(
    "channel_funnel",
    lambda w: funnel.channel_funnel(w.task_funnel_flags, w.users),
    """WITH c AS (
           SELECT acquisition_channel, count(DISTINCT task_id) AS t,
                  count(DISTINCT task_id) FILTER (did_complete_ocr) AS o,
                  count(DISTINCT task_id) FILTER (did_complete_anonymization) AS a,
                  count(DISTINCT task_id) FILTER (did_complete_risk_detection) AS r,
                  count(DISTINCT task_id) FILTER (did_complete_autofill) AS f,
                  count(DISTINCT task_id) FILTER (did_start_review) AS s,
                  count(DISTINCT task_id) FILTER (did_export) AS e,
                  avg(field_edit_count) AS edits, avg(event_count) AS events
           FROM flags LEFT JOIN users USING (user_id) GROUP BY 1)
       SELECT acquisition_channel, t AS total_tasks, o AS completed_ocr, round(o * 100.0 / nullif(t, 0), 2) AS ocr_conversion_pct,
              a AS completed_anonymization, round(a * 100.0 / nullif(o, 0), 2) AS anonymization_conversion_pct,
              r AS completed_risk_detection, round(r * 100.0 / nullif(a, 0), 2) AS risk_detection_conversion_pct,
              f AS completed_autofill, round(f * 100.0 / nullif(r, 0), 2) AS autofill_conversion_pct,
              s AS started_review, round(s * 100.0 / nullif(f, 0), 2) AS review_conversion_pct,
              e AS exported, round(e * 100.0 / nullif(t, 0), 2) AS overall_export_rate_pct,
              round(edits, 2) AS avg_field_edits, round(events, 1) AS avg_events_per_task FROM c""",
    "ocr_conversion_pct anonymization_conversion_pct risk_detection_conversion_pct autofill_conversion_pct "
    "review_conversion_pct overall_export_rate_pct avg_field_edits avg_events_per_task",
)
register(
    "activity_return_rates",
    lambda w: activity.activity_return_rates(w.user_daily_activity),
    """WITH x AS (SELECT activity_date, user_id FROM daily WHERE had_export = 1),
            j AS (SELECT activity_date, user_id,
                         EXISTS (FROM x y WHERE y.user_id = x.user_id AND y.activity_date = x.activity_date + 1) AS a,
                         EXISTS (FROM x y WHERE y.user_id = x.user_id AND y.activity_date = x.activity_date + 7) AS b,
                         EXISTS (FROM x y WHERE y.user_id = x.user_id AND y.activity_date = x.activity_date + 30) AS c FROM x)
       SELECT activity_date, count(*) AS active_users, count(*) FILTER (a) AS retained_d1_users,
              count(*) FILTER (b) AS retained_d7_users, count(*) FILTER (c) AS retained_d30_users,
              round(count(*) FILTER (a) * 100.0 / count(*), 2) AS d1_retention_pct,
              round(count(*) FILTER (b) * 100.0 / count(*), 2) AS d7_retention_pct,
              round(count(*) FILTER (c) * 100.0 / count(*), 2) AS d30_retention_pct FROM j GROUP BY 1""",
    "d1_retention_pct d7_retention_pct d30_retention_pct",
)
register(
    "cohort_retention_matrix",
    lambda w: activity.cohort_retention_matrix(w.user_cohorts, w.user_daily_activity),
    """WITH s AS (SELECT cohort_week, count(*) AS eligible_users FROM cohorts GROUP BY 1),
            m AS (SELECT cohort_week, date_trunc('week', activity_date)::DATE AS activity_week,
                         count(DISTINCT user_id) AS retained_users
                  FROM cohorts JOIN daily USING (user_id) GROUP BY ALL)
       SELECT cohort_week, eligible_users, activity_week,
              (datediff('day', cohort_week, activity_week) / 7)::BIGINT AS week_number, retained_users,
              round(retained_users * 100.0 / eligible_users, 2) AS retention_rate_pct
       FROM m JOIN s USING (cohort_week) WHERE datediff('day', cohort_week, activity_week) BETWEEN 0 AND 84""",
    "retention_rate_pct",
)
register(
    "feature_adoption_trend",
    lambda w: adoption.adoption_trend(w.task_funnel_flags),
    """WITH d AS (
           SELECT uploaded_at::DATE AS event_date, feature, count(*) FILTER (hit) AS feature_tasks, count(*) AS total_tasks
           FROM flags, LATERAL (VALUES ('ocr', did_complete_ocr), ('anonymization', did_complete_anonymization),
                ('risk_detection', did_complete_risk_detection), ('autofill', did_complete_autofill), ('export', did_export)) v(feature, hit)
           WHERE uploaded_at IS NOT NULL GROUP BY 1, 2)
       SELECT event_date, feature, feature_tasks, total_tasks, round(feature_tasks * 100.0 / total_tasks, 2) AS adoption_pct,
              rank() OVER (PARTITION BY event_date ORDER BY feature_tasks DESC) AS feature_rank,
              feature_tasks - lag(feature_tasks) OVER (PARTITION BY feature ORDER BY event_date) AS daily_change_tasks FROM d""",
    "adoption_pct",
)
LIFECYCLE = """SELECT activity_date, stage AS lifecycle_stage, count(DISTINCT user_id) AS user_count,
              round(avg(tasks_touched), 2) AS avg_tasks_touched, sum(had_export)::BIGINT AS users_with_export,
              round(avg(had_export) * 100, 2) AS export_pct FROM c GROUP BY 1, 2"""
register(
    "lifecycle_segments",
    lambda w: activity.lifecycle_segments(w.user_daily_activity),
    f"""WITH c AS (SELECT *, CASE
               WHEN activity_date = min(activity_date) OVER (PARTITION BY user_id) THEN 'new'
               WHEN lag(activity_date) OVER o = activity_date - 1 THEN 'active'
               WHEN lag(activity_date, 7) OVER o = activity_date - 7 THEN 'retained'
               WHEN datediff('day', lag(activity_date) OVER o, activity_date) >= 30 THEN 'resurrected'
               ELSE 'active' END AS stage
           FROM daily WINDOW o AS (PARTITION BY user_id ORDER BY activity_date)) {LIFECYCLE}""",
    "avg_tasks_touched export_pct",
)
register(
    "lifecycle_segments_by_days",
    lambda w: activity.lifecycle_segments(w.user_daily_activity, mode="days"),
    f"""WITH b AS (SELECT *, lead(activity_date) OVER o AS nxt, lag(activity_date) OVER o AS prv,
                          min(activity_date) OVER (PARTITION BY user_id) AS fst FROM daily
                   WINDOW o AS (PARTITION BY user_id ORDER BY activity_date)),
             fin AS (SELECT max(activity_date) + 1 AS stop FROM daily),
             c AS (
               SELECT user_id, activity_date, tasks_touched, had_export, CASE
                   WHEN activity_date = fst THEN 'new' WHEN prv = activity_date - 1 THEN 'active'
                   WHEN EXISTS (FROM daily q WHERE q.user_id = b.user_id AND q.activity_date = b.activity_date - 7) THEN 'retained'
                   WHEN datediff('day', prv, activity_date) >= 30 THEN 'resurrected' ELSE 'active' END AS stage FROM b
               UNION ALL SELECT user_id, activity_date + 1, 0, 0, 'churned' FROM b, fin WHERE activity_date + 1 < coalesce(nxt, stop)
               UNION ALL SELECT user_id, activity_date + 30, 0, 0, 'dormant' FROM b, fin WHERE activity_date + 30 < coalesce(nxt, stop))
        {LIFECYCLE}""",
    "avg_tasks_touched export_pct",
)
register(
    "three_day_streaks",
    lambda w: activity.streak_days(w.user_daily_activity),
    """WITH m AS (SELECT *, EXISTS (FROM daily a WHERE a.user_id = d.user_id AND a.activity_date = d.activity_date - 1)
                        AND EXISTS (FROM daily a WHERE a.user_id = d.user_id AND a.activity_date = d.activity_date + 1) AS mid
                  FROM daily d)
       SELECT activity_date, count(*) AS active_users, count(*) FILTER (mid) AS streak_users,
              round(count(*) FILTER (mid) * 100.0 / count(*), 2) AS streak_users_pct,
              round(avg(tasks_touched), 2) AS avg_tasks_touched,
              round(avg(tasks_touched) FILTER (mid), 2) AS avg_streak_tasks_touched,
              sum(had_export)::BIGINT AS exporting_users FROM m GROUP BY 1""",
    "streak_users_pct avg_tasks_touched avg_streak_tasks_touched",
)
register(
    "activity_streaks",
    lambda w: activity.activity_streaks(w.user_daily_activity, 3),
    """SELECT user_id, min(activity_date) AS streak_start, max(activity_date) AS streak_end, count(*) AS streak_days
       FROM (SELECT *, datediff('day', DATE '2000-01-01', activity_date)
                       - row_number() OVER (PARTITION BY user_id ORDER BY activity_date) AS g FROM daily)
       GROUP BY user_id, g HAVING count(*) >= 3""",
)
register(
    "first_successful_task",
    lambda w: activity.first_successful_task(w.users, w.task_outcomes),
    """WITH f AS (SELECT * FROM outcomes WHERE exported_at IS NOT NULL
                  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY exported_at, task_id) = 1),
            h AS (SELECT f.*, signup_time, epoch(exported_at - signup_time) / 3600.0 AS hrs FROM f JOIN users USING (user_id))
       SELECT user_id, task_id, signup_time, exported_at, hrs AS time_to_success_hours,
              datediff('day', signup_time::DATE, exported_at::DATE) AS time_to_success_days,
              field_edit_count, event_count, task_duration_seconds,
              CASE WHEN hrs <= 1 THEN 'under_1h' WHEN hrs <= 24 THEN '1-24h' WHEN hrs <= 168 THEN '1-7d'
                   WHEN hrs <= 720 THEN '7-30d' ELSE 'over_30d' END AS time_bucket FROM h""",
    "time_to_success_hours",
)
register(
    "latest_task_per_user",
    lambda w: activity.latest_task_per_user(w.task_outcomes, AS_OF_COLUMN()),
    f"""WITH moments AS (SELECT *, [{{'at': exported_at, 'what': 'exported'}}, {{'at': abandoned_at, 'what': 'abandoned'}},
                                 {{'at': failed_at, 'what': 'failed'}}, {{'at': uploaded_at, 'what': 'uploaded'}}] AS steps FROM outcomes),
            dated AS (SELECT *, coalesce(list_max(list_transform(steps, lambda e: e.at)), TIMESTAMP '1970-01-01') AS latest_event_at,
                             list_position(['in_progress', 'failed', 'abandoned', 'exported'], final_outcome) AS finality FROM moments),
            newest AS (SELECT user_id, max({{'at': latest_event_at, 'finality': finality, 'task': task_id}}) AS top FROM dated GROUP BY 1)
        SELECT user_id, task_id, document_id, uploaded_at, exported_at, abandoned_at, failed_at, final_outcome, is_successful,
               event_count, field_edit_count, task_duration_seconds, latest_event_at,
               coalesce(list_filter(steps, lambda e: e.at = latest_event_at)[1].what, 'uploaded') AS latest_status,
               datediff('day', latest_event_at::DATE, DATE '{AS_OF}') AS days_since_latest_activity
        FROM dated JOIN newest USING (user_id) WHERE task_id = top.task""",
)

# ---- dashboard-level ---------------------------------------------------------------------------
register(
    "date_window",
    lambda w: executive.clamp_window(w.events, "event_date", start="2024-01-20", end="2025-01-01"),
    "SELECT DATE '2024-01-20' AS date_start, max(event_date) AS date_end FROM r_events",
)
register(
    "sliced_funnel",
    lambda w: funnel.sliced_funnel(
        w.task_funnel_enriched,
        funnel.slice_filters(
            F.lit("2024-01-08").cast("date"), F.lit("2024-01-28").cast("date"), device_type="mobile", acquisition_channel=None
        ),
    ),
    """WITH s AS (
           SELECT i AS step_order, step_name, count(DISTINCT task_id) FILTER (hit) AS task_count
           FROM enriched, LATERAL (VALUES (1, 'Upload', did_upload), (2, 'OCR', did_complete_ocr),
                (3, 'Anonymization', did_complete_anonymization), (4, 'Risk Detection', did_complete_risk_detection),
                (5, 'Autofill', did_complete_autofill), (6, 'Review', did_start_review), (7, 'Export', did_export)) v(i, step_name, hit)
           WHERE device_type = 'mobile' AND event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-28' GROUP BY 1, 2)
       SELECT step_order, step_name, task_count,
              coalesce(task_count / nullif(first(task_count) OVER (ORDER BY step_order), 0), 0) AS pct_of_step1,
              CASE WHEN step_order = 1 THEN 1 ELSE coalesce(task_count / nullif(lag(task_count) OVER (ORDER BY step_order), 0), 0) END
                  AS pct_of_prior_step FROM s""",
    "pct_of_step1 pct_of_prior_step", "step_order",
)
WEEKLY_RETENTION = """
    SELECT date_trunc('week', cohort_date)::DATE AS cohort_week, acquisition_channel,
           coalesce(sum(d1_eligible_users) FILTER (d1_matured), 0)::BIGINT AS d1_eligible_users,
           coalesce(sum(d1_retained_users) FILTER (d1_matured), 0)::BIGINT AS d1_retained_users,
           coalesce(sum(d7_eligible_users) FILTER (d7_matured), 0)::BIGINT AS d7_eligible_users,
           coalesce(sum(d7_retained_users) FILTER (d7_matured), 0)::BIGINT AS d7_retained_users,
           coalesce(sum(d30_eligible_users) FILTER (d30_matured), 0)::BIGINT AS d30_eligible_users,
           coalesce(sum(d30_retained_users) FILTER (d30_matured), 0)::BIGINT AS d30_retained_users
    FROM retention GROUP BY 1, 2"""
STATUS = "CASE WHEN {c} = 0 THEN 'unmatured' WHEN {c} < 20 THEN 'insufficient' ELSE 'ok' END"
WEEKLY_FULL = "SELECT *, " + ", ".join(
    f"d{n}_retained_users / nullif(d{n}_eligible_users, 0) AS d{n}_weighted_rate, "
    + f"{STATUS.format(c=f'd{n}_eligible_users')} AS d{n}_maturity_status, "
    + f"{STATUS.format(c=f'd{n}_eligible_users')} AS d{n}_sample_status"
    for n in (1, 7, 30)
) + f" FROM ({WEEKLY_RETENTION})"
register(
    "weekly_weighted_retention", lambda w: retention.weekly_retention(w.retention_cohort), WEEKLY_FULL,
    "d1_weighted_rate d7_weighted_rate d30_weighted_rate",
)
register(
    "retention_sample_sizes",
    lambda w: retention.sample_size_summary(retention.weekly_retention(w.retention_cohort)),
    " UNION ALL ".join(
        f"SELECT cohort_week, acquisition_channel AS channel, 'D{n}' AS horizon, d{n}_maturity_status AS maturity_status, "
        f"d{n}_eligible_users AS eligible_users, d{n}_retained_users AS retained_users, d{n}_weighted_rate AS retention_rate, "
        f"d{n}_sample_status AS sample_status FROM ({WEEKLY_FULL})"
        for n in (1, 7, 30)
    ),
    "retention_rate",
)
ALL_CHANNELS = f"""SELECT cohort_week, sum(d7_eligible_users)::BIGINT AS eligible_users, sum(d7_retained_users)::BIGINT AS retained_users,
       sum(d7_retained_users) / nullif(sum(d7_eligible_users), 0) AS retention_rate,
       CASE WHEN sum(d7_eligible_users) >= {{m}} THEN 'ok' ELSE 'insufficient' END AS sample_status
       FROM ({WEEKLY_RETENTION}) GROUP BY 1"""
register(
    "all_channel_weekly_retention",
    lambda w: retention.all_channel_weekly(retention.weekly_retention(w.retention_cohort), 7, only_without_channels=False),
    ALL_CHANNELS.format(m=20),
    "retention_rate",
)
register(
    "all_channel_retention_fallback",
    lambda w: retention.all_channel_weekly(retention.weekly_retention(w.retention_cohort, minimum=10**9), 7),
    ALL_CHANNELS.format(m=20),
    "retention_rate",
)
register(
    "scorecard_period_totals",
    lambda w: executive.scorecard_totals(w.executive_daily_scorecard),
    """SELECT sum(north_star_metric)::BIGINT AS total_exported_tasks, avg(dau) AS avg_dau, avg(export_rate) AS avg_export_rate,
              avg(d7_retention) AS avg_d7_retention, avg(agent_success_rate) AS avg_agent_success_rate,
              avg(agent_p95_latency_ms) AS avg_agent_p95_latency_ms,
              avg(cost_per_successful_task) AS avg_cost_per_successful_task FROM scorecard""",
    "avg_dau avg_export_rate avg_d7_retention avg_agent_success_rate avg_agent_p95_latency_ms avg_cost_per_successful_task",
)
register(
    "adoption_by_segment",
    lambda w: adoption.adoption_totals(
        w.feature_adoption_segmented, ("feature_name", "user_segment", "device_type", "complexity")
    ),
    """SELECT feature_name, user_segment, device_type, complexity, sum(total_users)::BIGINT AS total_users,
              sum(adopted_users)::BIGINT AS adopted_users, sum(adopted_users) / sum(total_users) AS adoption_rate
       FROM adoption_seg GROUP BY ALL""",
    "adoption_rate",
)
register(
    "adoption_by_feature",
    lambda w: adoption.adoption_totals(w.feature_adoption_segmented, ("feature_name",)),
    """SELECT feature_name, sum(total_users)::BIGINT AS total_users, sum(adopted_users)::BIGINT AS adopted_users,
              sum(adopted_users) / sum(total_users) AS adoption_rate FROM adoption_seg GROUP BY ALL""",
    "adoption_rate",
)
register(
    "first_use_by_days",
    lambda w: adoption.first_use_totals(w.feature_time_to_first_use),
    """SELECT feature_name, user_segment, device_type, complexity, days_to_first_use, sum(user_count)::BIGINT AS user_count
       FROM ttfu GROUP BY ALL""",
)
HISTOGRAM = """WITH b AS (SELECT min({v})::DOUBLE AS lo, (max({v}) - min({v})) / {k}.0 AS wd FROM {src}),
     p AS (SELECT *, CASE WHEN wd > 0 THEN least(floor(({v} - lo) / wd), {k} - 1) ELSE 0 END::BIGINT AS bin FROM {src}, b WHERE {v} IS NOT NULL)
     SELECT {by}, bin, lo + bin * wd AS bin_start, lo + (bin + 1) * wd AS bin_end, {n} AS n FROM p GROUP BY {by}, bin, lo, wd"""
register(
    "first_use_histogram",
    lambda w: ex.metric_histogram(w.feature_time_to_first_use, "days_to_first_use", ["feature_name"], 30, "user_count"),
    HISTOGRAM.format(v="days_to_first_use", k=30, src="ttfu", by="feature_name", n="sum(user_count)::BIGINT"),
    "bin_start bin_end",
)
register(
    "adoption_trend_long",
    lambda w: adoption.adoption_trend_long(w.feature_adoption),
    """SELECT event_date, feature, rate FROM (UNPIVOT adoption ON ocr_adoption, anonymization_adoption, risk_detection_adoption,
              autofill_adoption INTO NAME feature VALUE rate)""",
    "rate",
)

# ---- root cause --------------------------------------------------------------------------------
WINDOWS = """SELECT max(event_date) - 6 AS current_start, max(event_date) AS current_end, max(event_date) - 13 AS prior_start,
       max(event_date) - 7 AS prior_end FROM {src}"""
register(
    "comparison_windows",
    lambda w: rootcause.pick_windows(w.export_rate_dimension_daily, "event_date"),
    WINDOWS.format(src="dim_daily"),
)
EFFECTS = """
    r AS (SELECT *, coalesce(prior_hits / nullif(prior_volume, 0), 0) AS prior_rate,
                 coalesce(current_hits / nullif(current_volume, 0), 0) AS current_rate,
                 prior_volume / nullif(sum(prior_volume) OVER g, 0) AS prior_share,
                 current_volume / nullif(sum(current_volume) OVER g, 0) AS current_share,
                 sum(current_hits) OVER g / nullif(sum(current_volume) OVER g, 0)
                     - sum(prior_hits) OVER g / nullif(sum(prior_volume) OVER g, 0) AS overall_change
          FROM v WINDOW g AS (PARTITION BY dimension_name)),
    f AS (SELECT *, (prior_share + current_share) / 2 * (current_rate - prior_rate) AS rate_effect,
                 (prior_rate + current_rate) / 2 * (current_share - prior_share) AS mix_effect FROM r),
    eff AS (SELECT *, rate_effect + mix_effect AS total_effect, 0.0 AS residual FROM f)"""
VOLUMES = f"""w AS ({WINDOWS.format(src='dim_daily')}),
    v AS (SELECT dimension_name, segment,
                 coalesce(sum(total_tasks) FILTER (event_date <= prior_end), 0)::BIGINT AS prior_volume,
                 coalesce(sum(total_tasks) FILTER (event_date > prior_end), 0)::BIGINT AS current_volume,
                 coalesce(sum(exported_tasks) FILTER (event_date <= prior_end), 0)::BIGINT AS prior_hits,
                 coalesce(sum(exported_tasks) FILTER (event_date > prior_end), 0)::BIGINT AS current_hits
          FROM dim_daily, w WHERE event_date BETWEEN prior_start AND current_end GROUP BY 1, 2)"""
EFFECT_DOUBLES = "prior_rate current_rate prior_share current_share overall_change rate_effect mix_effect total_effect residual"


def _decomposition(w):
    windows = rootcause.pick_windows(w.task_funnel_flags, "uploaded_at")
    return rootcause.dimension_decomposition(w.export_rate_dimension_daily, windows)


register("rate_mix_decomposition", _decomposition, f"WITH {VOLUMES}, {EFFECTS} SELECT * FROM eff", EFFECT_DOUBLES)
register(
    "top_contributors",
    lambda w: rootcause.top_contributors(_decomposition(w)),
    f"""WITH {VOLUMES}, {EFFECTS},
        s AS (SELECT *, total_effect / sum(abs(total_effect)) OVER (PARTITION BY dimension_name) AS contribution_share,
                     CASE WHEN total_effect > 0 THEN 'positive' ELSE 'negative' END AS direction FROM eff WHERE total_effect <> 0)
        SELECT direction, row_number() OVER o AS position, dimension_name, segment, rate_effect, mix_effect, total_effect,
               contribution_share FROM s
        WINDOW o AS (PARTITION BY direction ORDER BY round(abs(total_effect), 12) DESC, dimension_name, segment)
        QUALIFY row_number() OVER o <= 5""",
    "rate_effect mix_effect total_effect contribution_share",
)
BY_EVENT_DATE = """fin AS (SELECT max(event_date) AS d FROM r_events),
    x AS (SELECT DISTINCT acquisition_channel AS segment, e.task_id, event_date > d - {c} AS cur
          FROM r_events e JOIN users USING (user_id), fin WHERE event_date > d - {c} - 7),
    y AS (SELECT DISTINCT segment, task_id, cur, EXISTS (FROM flags WHERE flags.task_id = x.task_id AND did_export) AS done FROM x),
    v AS (SELECT 'acquisition_channel' AS dimension_name, segment, count(*) FILTER (NOT cur) AS prior_volume,
                 count(*) FILTER (cur) AS current_volume, count(*) FILTER (NOT cur AND done) AS prior_hits,
                 count(*) FILTER (cur AND done) AS current_hits FROM y GROUP BY segment)"""
for _name, _days in (("event_date_decomposition", 7), ("event_date_decomposition_8_days", 8)):
    register(
        _name,
        lambda w, n=_days: rootcause.event_date_decomposition(w.events, w.users, w.task_funnel_flags, current_days=n),
        f"WITH {BY_EVENT_DATE.format(c=_days)}, {EFFECTS} SELECT * FROM eff",
        EFFECT_DOUBLES,
    )
