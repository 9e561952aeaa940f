"""Experiment assignment, metrics, statistics and readout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import register
from catalog.views import AS_OF, LAYERS, Z95, Z975, t_quantile
from tidemark.operators import experiment as ex
from tidemark.operators import readout as ro
from tidemark.sources.sinks import written_once

EXPERIMENT = "exp_autofill"
MARGINS = {"avg_agent_latency_ms": 1.15, "total_cost_usd": 1.15, "avg_field_accuracy": 1.05}
REPLICATES = 10_000


def wide(w):
    return ex.clean_user_metrics(EXPERIMENT, w.clean_assignments, w.ab_test_user_metrics, w.contaminated_users)


def written(w):
    """The per-user frame for what reads it more than once."""
    return written_once(wide(w))


def long(w):
    return ex.long_metrics(wide(w))


# ---- assignments and user metrics --------------------------------------------------------------
register("clean_assignments", lambda w: w.clean_assignments, "SELECT * FROM clean")
register("contaminated_users", lambda w: w.contaminated_users, "SELECT * FROM contaminated")
register(
    "contaminated_users_per_assignment",
    lambda w: ex.contaminated_users(w.assignments, per_assignment=True),
    """SELECT c.user_id, group_count, assigned_groups, a.is_intentional_contamination
       FROM contaminated c JOIN r_assign a ON c.user_id = a.user_id""",
)
USER_DOUBLES = "export_rate avg_field_accuracy avg_latency_ms total_cost_usd"
register("experiment_user_metrics", lambda w: w.experiment_user_metrics, "SELECT * FROM user_metrics", USER_DOUBLES)
register(
    "ab_test_summary", lambda w: w.ab_test_summary, "SELECT * FROM ab_summary",
    "avg_export_rate avg_field_accuracy avg_latency_ms total_cost_usd cost_per_task",
)
register(
    "ab_test_user_metrics", lambda w: w.ab_test_user_metrics, "SELECT * FROM ab_users",
    "task_success_rate avg_field_edits avg_task_duration_s avg_field_accuracy avg_agent_latency_ms total_cost_usd",
)
register(
    "ab_test_segment_effects",
    lambda w: w.ab_test_segment_effects,
    """SELECT user_segment, acquisition_channel, ca.experiment_group, count(DISTINCT ca.user_id) AS user_count,
              avg(export_rate) AS avg_task_success_rate, avg(avg_field_accuracy) AS avg_field_accuracy,
              avg(avg_latency_ms) AS avg_agent_latency_ms, sum(total_cost_usd) / count(DISTINCT ca.user_id) AS avg_cost_per_user
       FROM clean ca JOIN users u ON ca.user_id = u.user_id
       LEFT JOIN user_metrics um ON ca.user_id = um.user_id AND ca.experiment_group = um.experiment_group
       WHERE NOT is_contaminated GROUP BY user_segment, acquisition_channel, ca.experiment_group""",
    "avg_task_success_rate avg_field_accuracy avg_agent_latency_ms avg_cost_per_user",
)
FANNED = """SELECT ca.experiment_group, count(DISTINCT ca.user_id) AS user_count, avg(total_latency_ms) AS avg_p95_latency_ms,
       avg(estimated_cost_usd) AS avg_cost_per_run,
       count(DISTINCT f.task_id) FILTER (NOT did_export AND did_upload) / count(DISTINCT f.task_id) AS abandonment_rate,
       avg((r.error_type IS NOT NULL)::INT) AS agent_error_rate
       FROM clean ca LEFT JOIN runs r ON ca.user_id = r.user_id LEFT JOIN flags f ON ca.user_id = f.user_id
       WHERE NOT is_contaminated GROUP BY 1"""
register(
    "experiment_guardrails_fanned",
    lambda w: ex.experiment_guardrails(w.clean_assignments, w.runs, w.task_funnel_flags, mode="fanned"),
    FANNED,
    "avg_p95_latency_ms avg_cost_per_run abandonment_rate agent_error_rate",
)
register(
    "experiment_guardrails",
    lambda w: w.experiment_guardrails,
    f"""WITH g AS ({FANNED})
        SELECT c.experiment_group, user_count, avg(total_latency_ms) AS avg_latency_ms,
               quantile_cont(total_latency_ms, 0.95) AS p95_latency_ms, avg(estimated_cost_usd) AS avg_cost_per_run,
               abandonment_rate, avg((error_type IS NOT NULL)::INT) AS agent_error_rate
        FROM clean c JOIN runs r ON c.user_id = r.user_id JOIN g ON g.experiment_group = c.experiment_group
        WHERE NOT is_contaminated GROUP BY c.experiment_group, user_count, abandonment_rate""",
    "avg_latency_ms p95_latency_ms avg_cost_per_run abandonment_rate agent_error_rate",
)
METRICS = " ".join(ex.USER_METRICS)
register("clean_user_metrics", wide, "SELECT * FROM xusers", METRICS)

# ---- tests -------------------------------------------------------------------------------------
# two groups: the chi-square tail with one degree of freedom is a normal tail, summed by Simpson's rule
NORMAL_TAIL = """1 - 2 * ({z} / 4000 / 3) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 4001), lambda i:
       (CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-(({z} * i / 4000) ^ 2) / 2)))"""
register(
    "srm_test",
    lambda w: ex.srm_test(w.clean_assignments, EXPERIMENT),
    f"""WITH o AS (SELECT experiment_group, count(DISTINCT user_id) AS observed FROM clean WHERE experiment_id = '{EXPERIMENT}' GROUP BY 1),
             e AS (SELECT *, sum(observed) OVER () / 2 AS expected, sum(observed) OVER () AS n_total FROM o),
             c AS (SELECT *, sum((observed - expected) ^ 2 / expected) OVER () AS chi2_stat FROM e),
             p AS (SELECT *, {NORMAL_TAIL.format(z="sqrt(chi2_stat)")} AS p_value FROM c)
        SELECT *, 0.05::DOUBLE AS srm_alpha, p_value >= 0.05 AS passed FROM p""",
    "expected chi2_stat p_value", "n_total",
)
register(
    "srm_test_by_segment",
    lambda w: ex.srm_test(
        w.clean_assignments.join(w.users.select("user_id", "user_segment"), "user_id"), EXPERIMENT, (0.6, 0.4), 0.001,
        by=["user_segment"],
    ),
    f"""WITH o AS (SELECT user_segment, experiment_group, count(DISTINCT user_id) AS observed FROM clean JOIN users USING (user_id) GROUP BY ALL),
             e AS (SELECT *, sum(observed) OVER g * CASE experiment_group WHEN 'A' THEN 0.6::DOUBLE ELSE 0.4::DOUBLE END AS expected,
                          sum(observed) OVER g AS n_total FROM o WINDOW g AS (PARTITION BY user_segment)),
             c AS (SELECT *, sum((observed - expected) ^ 2 / expected) OVER (PARTITION BY user_segment) AS chi2_stat FROM e),
             p AS (SELECT *, {NORMAL_TAIL.format(z="sqrt(chi2_stat)")} AS p_value FROM c)
        SELECT *, 0.001::DOUBLE AS srm_alpha, p_value >= 0.001 AS passed FROM p""",
    "expected chi2_stat p_value", "n_total",
)
BINARY = f"""WITH c AS (SELECT {{by}} count(*) FILTER (experiment_group = 'A') AS a_n, count(*) FILTER (experiment_group = 'B') AS b_n,
                  count(*) FILTER (experiment_group = 'A' AND {{hit}}) AS a_s, count(*) FILTER (experiment_group = 'B' AND {{hit}}) AS b_s
                  FROM {{src}} {{group}}),
            r AS (SELECT *, a_s / a_n AS a_rate, b_s / b_n AS b_rate, (a_s + b_s) / (a_n + b_n) AS q FROM c),
            z AS (SELECT *, abs(b_rate - a_rate) / sqrt(q * (1 - q) * (1 / a_n + 1 / b_n)) AS z,
                         {Z975} * sqrt(a_rate * (1 - a_rate) / a_n + b_rate * (1 - b_rate) / b_n) AS half FROM r)
       SELECT {{by}} a_n, b_n, a_rate, b_rate, b_rate - a_rate AS risk_difference, b_rate / a_rate AS relative_risk,
              (b_s / greatest(b_n - b_s, 1)) / (a_s / greatest(a_n - a_s, 1)) AS odds_ratio,
              {NORMAL_TAIL.format(z="z")} AS p_value_ztest, b_rate - a_rate - half AS ci_lower, b_rate - a_rate + half AS ci_upper FROM z"""
BINARY_DOUBLES = "a_rate b_rate risk_difference relative_risk odds_ratio p_value_ztest ci_lower ci_upper"
register(
    "binary_effect",
    lambda w: ex.binary_effect(wide(w).withColumn("has_task", F.col("total_tasks") > 0), "has_task"),
    BINARY.format(by="", hit="total_tasks > 0", src="xusers", group=""),
    BINARY_DOUBLES,
)
register(
    "binary_effect_by_device",
    lambda w: ex.binary_effect(
        wide(w).join(w.users.select("user_id", "device_type"), "user_id").withColumn("has_task", F.col("total_tasks") > 0),
        "has_task",
        by=["device_type"],
    ),
    BINARY.format(by="device_type,", hit="total_tasks > 0", src="xusers JOIN users USING (user_id)", group="GROUP BY device_type"),
    BINARY_DOUBLES,
)
WELCH = f"""SELECT metric, a_n, b_n, a_mean, b_mean, a_std, b_std, mean_diff, t AS welch_t_stat, df AS welch_df, p AS welch_p_value,
       mean_diff / sqrt((a_std ^ 2 + b_std ^ 2) / 2) AS cohens_d,
       mean_diff - {t_quantile(Z975, 'df')} * se AS ci_lower, mean_diff + {t_quantile(Z975, 'df')} * se AS ci_upper FROM welch"""
WELCH_DOUBLES = "a_mean b_mean a_std b_std mean_diff welch_t_stat welch_df welch_p_value cohens_d ci_lower ci_upper"
register("continuous_effect", lambda w: ex.continuous_effect(long(w)), WELCH, WELCH_DOUBLES)
register(
    "continuous_effect_by_segment",
    lambda w: ex.continuous_effect(
        long(w).join(w.users.select("user_id", "user_segment"), "user_id"), ["user_segment", "metric"]
    ).drop("ci_lower", "ci_upper"),
    """SELECT user_segment, metric, a_n, b_n, a_mean, b_mean, a_std, b_std, mean_diff, t AS welch_t_stat, df AS welch_df,
              p AS welch_p_value,
              CASE WHEN a_std + b_std > 0 THEN mean_diff / sqrt((a_std ^ 2 + b_std ^ 2) / 2) ELSE 0 END AS cohens_d
       FROM welch_seg WHERE a_n >= 2 AND b_n >= 2""",
    "a_mean b_mean a_std b_std mean_diff welch_t_stat welch_df welch_p_value cohens_d",
)
BH = """WITH r AS (SELECT metric, p AS p_value, row_number() OVER (ORDER BY p, metric) AS k, count(*) OVER () AS n FROM {src})
       SELECT metric, p_value, least(1, min(p_value * n / k) OVER (ORDER BY k DESC)) AS adjusted_p,
              least(1, min(p_value * n / k) OVER (ORDER BY k DESC)) <= 0.05 AS rejected FROM r"""
register(
    "multiplicity_correction",
    lambda w: ex.bh_correction(
        ex.continuous_effect(long(w)).select("metric", F.col("welch_p_value").alias("p_value")), "p_value"
    ),
    BH.format(src="welch"),
    "p_value adjusted_p",
)
GUARDRAIL = f"""WITH g AS (SELECT *, {t_quantile(Z95, 'df')} * se AS reach,
                          CASE metric WHEN 'avg_field_accuracy' THEN 1.05::DOUBLE ELSE 1.15::DOUBLE END AS margin,
                          metric = 'avg_field_accuracy' AS higher_is_better
                   FROM welch WHERE metric IN ('avg_agent_latency_ms', 'total_cost_usd', 'avg_field_accuracy'))
        SELECT metric, a_n, b_n, a_mean, b_mean, mean_diff AS diff, mean_diff * 100 / a_mean AS diff_pct,
               mean_diff - reach AS ci_lower, mean_diff + reach AS ci_upper, margin, higher_is_better,
               CASE WHEN higher_is_better THEN mean_diff - reach > (1 / margin - 1) * a_mean
                    ELSE mean_diff + reach < (margin - 1) * a_mean END AS non_inferiority_passed FROM g"""
register(
    "guardrail_test",
    lambda w: ex.guardrail_test(long(w), MARGINS, ["avg_field_accuracy"]),
    GUARDRAIL,
    "a_mean b_mean diff diff_pct ci_lower ci_upper margin",
)
register(
    "summary_stats",
    lambda w: ex.summary_stats(ex.long_metrics(written(w))),
    """SELECT experiment_group, metric, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max,
              count(*) AS n, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75
       FROM xlong GROUP BY 1, 2""",
    "mean std min max p25 p50 p75",
)

# ---- bootstrap ---------------------------------------------------------------------------------
# A weight is the number of bounds that a mixed 32-bit number reaches. Users and replicates have keys;
# the steps x, y, z are the two rounds of the mixing.


def _round(source: str, result: str, start: str) -> str:
    return f"""
    {result}0 AS (SELECT * REPLACE ({start} AS h) FROM {source}),
    {result}1 AS (SELECT * REPLACE (xor(h, h >> 16) * {ex.MIX_1} & 4294967295 AS h) FROM {result}0),
    {result}2 AS (SELECT * REPLACE (xor(h, h >> 13) * {ex.MIX_2} & 4294967295 AS h) FROM {result}1),
    {result} AS (SELECT * REPLACE (xor(h, h >> 16) AS h) FROM {result}2)"""


def _draws(replicates: int, users: str = "xusers") -> str:
    """CTE x: the columns of ``users`` once per replicate, with rep and the weight w."""
    stem = f"md5('{ex.BOOTSTRAP_SEED}|' || user_id)"
    reached = " + ".join(f"(h >= {bound})::INT" for bound in ex.WEIGHT_BOUNDS)
    return f"""
    keyed AS MATERIALIZED (SELECT *, ('0x' || substr({stem}, 1, 8))::UBIGINT AS k1, ('0x' || substr({stem}, 9, 8))::UBIGINT AS k2
                           FROM {users}),
    turns AS MATERIALIZED (SELECT rep, ('0x' || substr(md5('{ex.BOOTSTRAP_SEED}#' || rep), 1, 8))::UBIGINT AS k FROM range({replicates}) t(rep)),
    paired AS (SELECT keyed.*, rep, xor(k1, k) AS h FROM keyed, turns),
    {_round("paired", "y", "h")}, {_round("y", "z", "(h + k2) & 4294967295")},
    x AS (SELECT * EXCLUDE (h, k1, k2), {reached} AS w FROM z)"""


REPORT = """
    o AS (SELECT metric, max(s) FILTER (experiment_group = 'B') - max(s) FILTER (experiment_group = 'A') AS observed_diff
          FROM (SELECT metric, experiment_group, {stat}(value) AS s FROM xlong GROUP BY 1, 2) GROUP BY 1)
    SELECT metric, observed_diff, avg(diff) AS bootstrap_mean, 2 * observed_diff - avg(diff) AS estimate,
           stddev_samp(diff) AS std_err, quantile_cont(diff, 0.025) AS ci_lower, quantile_cont(diff, 0.975) AS ci_upper,
           count(diff) AS replicates, {seed}::BIGINT AS seed
    FROM r JOIN o USING (metric) GROUP BY metric, observed_diff"""
BOOT_DOUBLES = "observed_diff bootstrap_mean estimate std_err ci_lower ci_upper"
MEAN_COLUMNS = ", ".join(f"sum({m} * w) / sum(w) AS {m}" for m in ex.USER_METRICS)
BOOT_MEAN = f"""WITH {_draws(REPLICATES)},
        s AS (SELECT rep, experiment_group, {MEAN_COLUMNS} FROM x GROUP BY 1, 2),
        l AS (UNPIVOT s ON {', '.join(ex.USER_METRICS)} INTO NAME metric VALUE v),
        r AS (SELECT metric, rep, max(v) FILTER (experiment_group = 'B') - max(v) FILTER (experiment_group = 'A') AS diff
              FROM l GROUP BY 1, 2),
        {REPORT.format(stat="avg", seed=ex.BOOTSTRAP_SEED)}"""
register(
    "bootstrap_mean_difference",
    lambda w: ex.bootstrap_diff(written(w), iterations=REPLICATES),
    BOOT_MEAN,
    BOOT_DOUBLES,
)
# Medians: values far from the middle (4 square roots of the group's size, and more than any replicate
# strays) only count as below or above; the rest is cumulated per replicate from one row per value.
_FAR = "(4 * ceil(sqrt(n)) + 2)::BIGINT"
_ENDS = ", ".join(
    f"(SELECT l[greatest(1, (n + 1) // 2 - {_FAR})] FROM (SELECT list_sort(list({m})) AS l, count({m}) AS n FROM {{users}} i WHERE i.experiment_group = g.experiment_group)) AS {m}_lo, "
    f"(SELECT l[least(n, n // 2 + 1 + {_FAR})] FROM (SELECT list_sort(list({m})) AS l, count({m}) AS n FROM {{users}} i WHERE i.experiment_group = g.experiment_group)) AS {m}_hi"
    for m in ex.USER_METRICS
)
_CLASSES = ", ".join(
    f"CASE WHEN {m} < {m}_lo THEN '-inf'::DOUBLE WHEN {m} > {m}_hi THEN 'inf'::DOUBLE ELSE {m} END AS {m}" for m in ex.USER_METRICS
)
_SETS = ", ".join(f"(rep, experiment_group, {m})" for m in ex.USER_METRICS)
_METRIC = " ".join(f"WHEN grouping({m}) = 0 THEN '{m}'" for m in ex.USER_METRICS)
_VALUE = " ".join(f"WHEN grouping({m}) = 0 THEN {m}" for m in ex.USER_METRICS)


def _boot_median(users: str, rows: str) -> str:
    return f"""WITH ends AS MATERIALIZED (SELECT experiment_group, {_ENDS.replace("{users}", users)} FROM (SELECT DISTINCT experiment_group FROM {users}) g),
        classed AS MATERIALIZED (SELECT user_id, experiment_group, {_CLASSES} FROM {users} JOIN ends USING (experiment_group)),
        {_draws(REPLICATES, "classed")},
        c AS (SELECT rep, experiment_group, CASE {_METRIC} END AS metric, CASE {_VALUE} END AS v, sum(w) AS k
              FROM x WHERE w > 0 GROUP BY GROUPING SETS ({_SETS})),
        q AS (SELECT *, sum(k) OVER (own ORDER BY v) - k AS below, sum(k) OVER own AS n FROM c WHERE v IS NOT NULL
              WINDOW own AS (PARTITION BY metric, experiment_group, rep)),
        s AS (SELECT metric, rep, experiment_group, (max(v) FILTER (below <= (n - 1) // 2 AND (n - 1) // 2 < below + k)
                     + max(v) FILTER (below <= n // 2 AND n // 2 < below + k)) / 2 AS v FROM q GROUP BY 1, 2, 3),
        r AS (SELECT metric, rep, max(v) FILTER (experiment_group = 'B') - max(v) FILTER (experiment_group = 'A') AS diff
              FROM s GROUP BY 1, 2),
        {REPORT.format(stat="median", seed=ex.BOOTSTRAP_SEED).replace("FROM xlong", f"FROM {rows}")}"""


register(
    "bootstrap_median_difference",
    lambda w: ex.bootstrap_diff(written(w), iterations=REPLICATES, statistic="median"),
    _boot_median("xusers", "xlong"),
    BOOT_DOUBLES,
)
# most users of the test tables have no task, so their medians are 0; those with a task differ
register(
    "bootstrap_median_active_users",
    lambda w: ex.bootstrap_diff(written(w).where("total_tasks > 0"), iterations=REPLICATES, statistic="median"),
    _boot_median("(SELECT * FROM xusers WHERE total_tasks > 0)", "xlong SEMI JOIN (SELECT user_id FROM xusers WHERE total_tasks > 0) u USING (user_id)"),
    BOOT_DOUBLES,
)

# ---- decision ----------------------------------------------------------------------------------


def _readout(w):
    return ex.experiment_readout(written(w), w.clean_assignments, EXPERIMENT, guardrails=MARGINS, iterations=REPLICATES)


GUARDS = f"""WITH g AS (SELECT *, {t_quantile(Z95, 'df')} * se AS reach,
                     CASE metric WHEN 'avg_field_accuracy' THEN 1.05::DOUBLE ELSE 1.15::DOUBLE END AS margin FROM welch
                     WHERE metric IN ('avg_agent_latency_ms', 'total_cost_usd', 'avg_field_accuracy')),
       v AS (SELECT *, CASE WHEN metric = 'avg_field_accuracy' THEN mean_diff - reach > (1 / margin - 1) * a_mean
                            ELSE mean_diff + reach < (margin - 1) * a_mean END AS ok FROM g),
       f AS (SELECT count(*) FILTER (NOT ok) AS fails, count(*) FILTER (NOT ok AND abs(mean_diff * 100 / a_mean) >= 50) AS severe FROM v),
       n AS (SELECT count(DISTINCT user_id) FILTER (experiment_group = 'A') AS a, count(DISTINCT user_id) FILTER (experiment_group = 'B') AS b
             FROM clean),
       s AS (SELECT (a - b) ^ 2 / (a + b) < 3.841458820694124 AS srm_passed FROM n),
       m AS (SELECT p, mean_diff AS effect FROM welch WHERE metric = 'task_success_rate')"""
register(
    "experiment_decision",
    lambda w: _readout(w)["decision"],
    f"""{GUARDS}
        SELECT CASE WHEN NOT srm_passed THEN 'INCONCLUSIVE' WHEN severe > 0 THEN 'STOP_FOR_HARM'
                    WHEN p < 0.05 AND effect > 0 AND fails > 0 THEN 'SHIP_WITH_MONITORING'
                    WHEN p < 0.05 AND effect > 0 THEN 'SHIP' WHEN p >= 0.05 THEN 'CONTINUE_EXPERIMENT'
                    ELSE 'INCONCLUSIVE' END AS decision,
               srm_passed, true AS data_validation_passed, p < 0.05 AS primary_significant, p AS p_value, effect,
               fails AS guardrail_failures, severe AS severe_failures FROM f, s, m""",
    "p_value effect",
)

def _part(name: str, inner: str, statistics: str) -> str:
    casts = ", ".join(f"{c}::DOUBLE AS {c}" for c in statistics.split())
    return (
        f"SELECT '{name}' AS part, metric, statistic, value FROM (UNPIVOT (SELECT metric, {casts} FROM ({inner})) "
        f"ON {', '.join(statistics.split())} INTO NAME statistic VALUE value)"
    )


EFFECT_STATS = "a_mean b_mean mean_diff welch_t_stat welch_p_value cohens_d ci_lower ci_upper"
register(
    "experiment_readout",
    lambda w: _readout(w)["long"],
    " UNION ALL ".join(
        [
            _part("welch", WELCH, EFFECT_STATS),
            _part("bootstrap", BOOT_MEAN, "observed_diff estimate std_err ci_lower ci_upper"),
            _part("multiplicity", BH.format(src="welch WHERE metric <> 'task_success_rate'"), "p_value adjusted_p"),
            _part("guardrail", f"SELECT *, non_inferiority_passed AS passed FROM ({GUARDRAIL})", "diff diff_pct passed"),
        ]
    ),
    "value",
)
LEVELS = "UNPIVOT (SELECT user_id, experiment_group, device_type, acquisition_channel, user_segment FROM (SELECT DISTINCT user_id, experiment_group FROM clean WHERE NOT is_contaminated) JOIN users USING (user_id)) ON device_type, acquisition_channel, user_segment INTO NAME dimension VALUE level"
register(
    "randomization_balance",
    lambda w: ex.randomization_balance(w.clean_assignments, w.users),
    f"""WITH l AS ({LEVELS}),
             c AS (SELECT dimension, level, count(*) FILTER (experiment_group = 'A') AS a, count(*) FILTER (experiment_group = 'B') AS b
                   FROM l GROUP BY 1, 2),
             s AS (SELECT *, sum(a) OVER d AS a_n, sum(b) OVER d AS b_n, a / sum(a) OVER d AS a_share, b / sum(b) OVER d AS b_share
                   FROM c WINDOW d AS (PARTITION BY dimension)),
             m AS (SELECT *, (a_share - b_share) / sqrt((a_share * (1 - a_share) + b_share * (1 - b_share)) / 2) AS smd FROM s)
        SELECT dimension, level, a_n, b_n, a_share, b_share, smd, CASE WHEN abs(smd) < 0.1 THEN 'balanced' ELSE 'imbalanced' END AS status
        FROM m""",
    "a_share b_share smd", "a_n b_n",
)
register(
    "population_check",
    lambda w: ex.population_check(w.assignments, w.contaminated_users, w.ab_test_user_metrics),
    """WITH u AS (SELECT user_id, count(*) AS n, arg_min(experiment_group, (assigned_at, assignment_id)) AS g FROM r_assign GROUP BY 1),
            j AS (SELECT *, user_id IN (SELECT user_id FROM contaminated) AS bad,
                         user_id IN (SELECT user_id FROM ab_users WHERE total_tasks > 0) AS seen FROM u)
       SELECT sum(n)::BIGINT AS raw_assignment_rows, count(*) AS unique_assigned_users, count(g) AS canonical_first_assignment_users,
              count(*) FILTER (NOT bad) AS clean_itt_users, count(*) FILTER (NOT bad AND g = 'A') AS clean_itt_a_n,
              count(*) FILTER (NOT bad AND g = 'B') AS clean_itt_b_n, count(*) FILTER (bad) AS contaminated_users,
              count(*) FILTER (NOT bad AND seen) AS users_with_outcomes, count(*) FILTER (NOT bad AND NOT seen) AS missing_outcome_users
       FROM j""",
)
register(
    "latest_assignment_metrics",
    lambda w: ex.latest_assignment_metrics(w.clean_assignments, w.experiment_user_metrics, F.lit(AS_OF).cast("date")),
    f"""WITH a AS (SELECT * FROM clean WHERE NOT is_contaminated
                   QUALIFY row_number() OVER (PARTITION BY user_id, experiment_id ORDER BY assigned_at DESC, assignment_id DESC) = 1)
        SELECT experiment_id, a.user_id, a.experiment_group, a.assigned_at, total_tasks, exported_tasks,
               round(export_rate, 4) AS export_rate, round(avg_field_accuracy, 2) AS avg_field_accuracy,
               round(avg_latency_ms, 2) AS avg_latency_ms, round(total_cost_usd, 6) AS total_cost_usd,
               exported_tasks / nullif(total_tasks, 0) AS task_success_rate,
               round(avg_latency_ms * exported_tasks, 2) AS total_latency_cost,
               CASE WHEN exported_tasks > 0 THEN round(total_cost_usd / exported_tasks, 8) END AS cost_per_successful_task,
               (a.experiment_group <> 'A')::BIGINT AS is_treatment,
               datediff('day', a.assigned_at::DATE, DATE '{AS_OF}') AS days_since_assignment
        FROM a LEFT JOIN user_metrics m ON a.user_id = m.user_id AND a.experiment_group = m.experiment_group""",
    "export_rate avg_field_accuracy avg_latency_ms total_cost_usd task_success_rate total_latency_cost cost_per_successful_task",
)
register(
    "srm_daily_inputs",
    lambda w: ex.srm_daily_inputs(w.clean_assignments, w.assignments),
    """WITH c AS (SELECT experiment_id, assigned_at::DATE AS assignment_date, experiment_group, count(DISTINCT user_id) AS n FROM clean GROUP BY ALL),
            r AS (SELECT experiment_id, assigned_at::DATE AS assignment_date, experiment_group, count(DISTINCT user_id) AS m FROM r_assign GROUP BY ALL),
            t AS (SELECT *, sum(n) OVER d AS tot, count(*) OVER d AS k FROM c LEFT JOIN r USING (experiment_id, assignment_date, experiment_group)
                  WINDOW d AS (PARTITION BY experiment_id, assignment_date))
       SELECT experiment_id, assignment_date, experiment_group, n AS clean_user_count, coalesce(m, 0) AS raw_user_count,
              tot AS total_clean_users_for_experiment, round(n * 100.0 / tot, 4) AS observed_allocation_pct,
              round(100.0 / k, 4) AS expected_allocation_pct, round(n * 100.0 / tot - 100.0 / k, 4) AS deviation_from_expected_pp,
              round((n - tot / k) ^ 2 / (tot / k), 4) AS chi_squared_contribution,
              coalesce(m, 0) - n AS potentially_contaminated_users, abs(n * 100.0 / tot - 100.0 / k) > 1 AS srm_flagged FROM t""",
    "observed_allocation_pct expected_allocation_pct deviation_from_expected_pp chi_squared_contribution",
    "total_clean_users_for_experiment",
)

# ---- dashboard ---------------------------------------------------------------------------------
register(
    "agent_metric_coverage",
    lambda w: ex.agent_metric_coverage(w.events, w.runs),
    """SELECT e.experiment_group, count(DISTINCT e.task_id) AS total_tasks, count(DISTINCT agent_run_id) AS tasks_with_agent
       FROM r_events e LEFT JOIN runs r ON e.task_id = r.task_id WHERE e.experiment_group IN ('A', 'B') GROUP BY 1""",
)
register(
    "experiment_sizes",
    lambda w: ex.experiment_sizes(w.clean_assignments, w.contaminated_users),
    """SELECT min(assigned_at) AS experiment_start, max(assigned_at) AS experiment_end,
              count(*) FILTER (experiment_group = 'A') AS clean_a, count(*) FILTER (experiment_group = 'B') AS clean_b,
              (SELECT count(*) FROM contaminated) AS contaminated FROM clean""",
)


def _histograms(w) -> DataFrame:
    parts = [
        ex.metric_histogram(w.ab_test_user_metrics, c).select(F.lit(c).alias("metric"), "*")
        for c in ("task_success_rate", "avg_field_accuracy")
    ]
    return reduce(DataFrame.unionByName, parts)


def _histogram_sql(column: str) -> str:
    return f"""SELECT '{column}' AS metric, experiment_group, bin, lo + bin * wd AS bin_start, lo + (bin + 1) * wd AS bin_end, count(*) AS n
        FROM (SELECT experiment_group, lo, wd, CASE WHEN wd > 0 THEN least(floor(({column} - lo) / wd), 39) ELSE 0 END::BIGINT AS bin
              FROM ab_users, (SELECT min({column}) AS lo, (max({column}) - min({column})) / 40 AS wd FROM ab_users)
              WHERE {column} IS NOT NULL) GROUP BY ALL"""


register(
    "user_metric_histograms", _histograms,
    _histogram_sql("task_success_rate") + " UNION ALL " + _histogram_sql("avg_field_accuracy"), "bin_start bin_end",
)

# ---- configured readout ------------------------------------------------------------------------
CONFIG = {
    "experiment_id": EXPERIMENT,
    "design": {"traffic_split": [0.5, 0.5]},
    # fixed values: metrics, directions and margins of the experiment's configuration
    "metrics": {
        "primary": [{"name": "form_export_rate", "direction": "higher_is_better"}],
        "secondary": [
            {"name": "task_success_rate", "direction": "higher_is_better"},
            {"name": "field_accuracy", "direction": "higher_is_better"},
            {"name": "manual_edit_rate", "direction": "lower_is_better"},
        ],
    },
    "guardrails": [
        {"name": "p95_latency_ms", "threshold_relative": 1.15},
        {"name": "cost_per_successful_task_usd", "threshold_relative": 1.10},
        {"name": "abandonment_rate", "threshold_relative": 1.05},
        {"name": "agent_error_rate", "threshold_relative": 1.05},
    ],
    "analysis": {
        "significance_level": 0.05,
        "bootstrap_iterations": REPLICATES,
        "segment_dimensions": ["device_type", "user_segment", "document_complexity", "acquisition_channel"],
    },
}
CONFIGURED = ro.Experiment.from_mapping(CONFIG)
TESTED = CONFIGURED.named(ro.PRIMARY, ro.SECONDARY)
GUARDED = CONFIGURED.named(ro.GUARDRAIL)


def configured_frame(w) -> DataFrame:
    return ro.user_metric_frame(CONFIGURED, w.assignments, w.task_outcomes, w.runs)


def configured_segments(w) -> DataFrame:
    frame = ro.segment_frame(CONFIGURED, w.assignments, w.users, w.documents, w.task_outcomes, w.runs)
    return ro.segment_readout(CONFIGURED, frame)


def _user_values(task_join: str = "", run_join: str = "", key: str = "") -> str:
    """CTEs t and r: one row per user (and ``key``), and the metric expressions over them."""
    return f"""
    t AS (SELECT user_id, {key} count(task_id) AS tasks, count(*) FILTER (is_successful) AS ok,
                 count(*) FILTER (uploaded_at IS NOT NULL AND NOT is_successful) AS lost, avg(field_edit_count) AS edits
          FROM outcomes {task_join} GROUP BY ALL),
    u AS (SELECT user_id, {key} avg((error_type IS NOT NULL)::INT) AS errors, sum(estimated_cost_usd) AS cost,
                 avg(field_accuracy) AS accuracy, quantile_cont(total_latency_ms, 0.95) AS p95
          FROM runs {run_join} GROUP BY ALL)"""


_NAMED = """coalesce(ok / nullif(tasks, 0), 0) AS form_export_rate, coalesce(ok / nullif(tasks, 0), 0) AS task_success_rate,
            coalesce(accuracy, 0) AS field_accuracy, coalesce(edits, 0) AS manual_edit_rate, coalesce(p95, 0) AS p95_latency_ms,
            coalesce(cost / nullif(ok, 0), 0) AS cost_per_successful_task_usd, coalesce(lost / nullif(tasks, 0), 0) AS abandonment_rate,
            coalesce(errors, 0) AS agent_error_rate"""
_EVERY = ", ".join(TESTED + GUARDED)
LAYERS["assigned"] = f"""
    SELECT user_id, experiment_group, NOT bool_or(is_contaminated) AND user_id NOT IN (SELECT user_id FROM contaminated) AS analysed
    FROM clean WHERE experiment_id = '{EXPERIMENT}' GROUP BY user_id, experiment_group"""
LAYERS["named_users"] = f"""
    WITH {_user_values()}
    SELECT user_id, experiment_group, analysed, {_NAMED} FROM assigned LEFT JOIN t USING (user_id) LEFT JOIN u USING (user_id)"""
_GRADED = _user_values(
    "JOIN (SELECT document_id, complexity_level AS level FROM docs) d USING (document_id)",
    "JOIN (SELECT DISTINCT task_id, complexity_level AS level FROM outcomes JOIN docs USING (document_id)) d USING (task_id)", "level,",
)
_OWN = ("device_type", "user_segment", "acquisition_channel")
LAYERS["named_segments"] = f"""
    WITH {_GRADED}
    SELECT * FROM (UNPIVOT (SELECT n.*, {', '.join(_OWN)} FROM named_users n JOIN users USING (user_id)) ON {', '.join(_OWN)} INTO NAME dimension VALUE level)
    UNION ALL BY NAME
    SELECT user_id, experiment_group, analysed, {_NAMED}, 'document_complexity' AS dimension, level
    FROM assigned JOIN t USING (user_id) LEFT JOIN u USING (user_id, level) WHERE tasks > 0"""
LAYERS["named_long"] = f"UNPIVOT (SELECT 'all' AS dimension, 'all' AS level, * FROM named_users WHERE analysed) ON {_EVERY} INTO NAME metric VALUE value"
LAYERS["named_segments_long"] = f"UNPIVOT (SELECT * FROM named_segments WHERE analysed) ON {_EVERY} INTO NAME metric VALUE value"
for _long_rows in ("named_long", "named_segments_long"):
    LAYERS[f"{_long_rows}_moments"] = LAYERS["moments"].replace("SELECT metric,", "SELECT dimension, level, metric,").replace(
        "FROM xlong GROUP BY metric", f"FROM {_long_rows} GROUP BY dimension, level, metric")
    LAYERS[f"{_long_rows}_welch"] = LAYERS["welch"].replace("FROM moments", f"FROM {_long_rows}_moments").replace(
        "FROM p", "FROM p WHERE a_n >= 2 AND b_n >= 2")


def _listed(names: list[str]) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def _with_quantile(source: str, z: str, p: float) -> str:
    """``source`` with q, the t quantile: Newton steps from the expansion, for segments with few degrees of freedom."""
    inner = f"(SELECT *, {t_quantile(z, 'df')} AS q, exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()) AS k FROM {source})"
    for _ in range(4):
        inner = f"""(SELECT * REPLACE (q - (0.5 + k * (q / 2000 / 3) * list_sum(list_transform(range(0, 2001), lambda i:
            (CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * (1 + (q * i / 2000) ^ 2 / df) ^ (-(df + 1) / 2))) - {p})
            / (k * (1 + q ^ 2 / df) ^ (-(df + 1) / 2)) AS q) FROM {inner})"""
    return inner


def _effect_sql(rows: str, extra: str = "") -> str:
    half = "q * se"
    return f"""SELECT dimension, level, metric, a_n, b_n, a_mean, b_mean, mean_diff, t AS welch_t_stat, p AS p_value,
        coalesce(mean_diff / nullif(sqrt((a_std ^ 2 + b_std ^ 2) / 2), 0), 0) AS cohens_d, mean_diff - {half} AS ci_lower,
        mean_diff + {half} AS ci_upper, coalesce(p < 0.05, false) AS significant {extra}
        FROM {_with_quantile(f"{rows}_welch", Z975, 0.975)} WHERE metric IN {_listed(TESTED)}"""


def _guard_sql(rows: str) -> str:
    margins = " ".join(f"WHEN '{m.name}' THEN {m.margin}::DOUBLE" for m in CONFIGURED.metrics if m.role == ro.GUARDRAIL)
    return f"""SELECT *, diff - reach AS ci_lower, diff + reach AS ci_upper, reach = 0 OR diff + reach < (margin - 1) * a_mean AS passed
        FROM (SELECT dimension, level, metric, a_mean, b_mean, b_mean - a_mean AS diff, coalesce((b_mean - a_mean) * 100 / nullif(a_mean, 0), 0) AS diff_pct,
                     CASE metric {margins} END AS margin, CASE WHEN se > 0 THEN q * se ELSE 0 END AS reach
              FROM {_with_quantile(f"""(SELECT *, sqrt(a_std ^ 2 / a_n + b_std ^ 2 / b_n) AS se,
                           (a_std ^ 2 / a_n + b_std ^ 2 / b_n) ^ 2 / nullif((a_std ^ 2 / a_n) ^ 2 / (a_n - 1) + (b_std ^ 2 / b_n) ^ 2 / (b_n - 1), 0) AS df
                    FROM {rows}_moments WHERE metric IN {_listed(GUARDED)})""", Z95, 0.95)})
        WHERE a_mean IS NOT NULL AND b_mean IS NOT NULL"""


def _srm_sql(rows: str) -> str:
    return f"""SELECT dimension, level, experiment_group AS metric, observed, expected, chi2_stat, {NORMAL_TAIL.format(z="sqrt(chi2_stat)")} AS p_value,
        {NORMAL_TAIL.format(z="sqrt(chi2_stat)")} >= 0.05 AS passed
        FROM (SELECT *, sum((observed - expected) ^ 2 / expected) OVER (PARTITION BY dimension, level) AS chi2_stat
              FROM (SELECT *, sum(observed) OVER (PARTITION BY dimension, level) / count(*) OVER (PARTITION BY dimension, level) AS expected
                    FROM (SELECT dimension, level, experiment_group, count(DISTINCT user_id) AS observed FROM {rows} GROUP BY ALL)))"""


def _flat(part: str, inner: str, statistics: tuple[str, ...] | list[str], keys: str = "") -> str:
    casts = ", ".join(f"{c}::DOUBLE AS {c}" for c in statistics)
    return (
        f"SELECT '{part}' AS part, {keys} metric, statistic, value, NULL::VARCHAR AS label FROM (UNPIVOT (SELECT {keys} metric, {casts} "
        f"FROM ({inner})) ON {', '.join(statistics)} INTO NAME statistic VALUE value)"
    )


_ALL_ROWS = "(SELECT 'all' AS dimension, 'all' AS level, * FROM named_users)"
_TESTED_MEANS = ", ".join(f"sum({m} * w) / sum(w) AS {m}" for m in TESTED)
_NAMED_BOOT = f"""WITH {_draws(REPLICATES, "(SELECT * FROM named_users WHERE analysed)")},
        s AS (SELECT rep, experiment_group, {_TESTED_MEANS} FROM x GROUP BY 1, 2),
        l AS (UNPIVOT s ON {', '.join(TESTED)} INTO NAME metric VALUE v),
        r AS (SELECT metric, rep, max(v) FILTER (experiment_group = 'B') - max(v) FILTER (experiment_group = 'A') AS diff
              FROM l GROUP BY 1, 2),
        {REPORT.format(stat="avg", seed=ex.BOOTSTRAP_SEED).replace("xlong", "named_long")}"""
_NAMED_BH = BH.format(src=f"named_long_welch WHERE p IS NOT NULL AND metric IN {_listed(CONFIGURED.named(ro.SECONDARY))}")
_STATUS = f"""SELECT CASE WHEN metric IN {_listed(CONFIGURED.named(ro.PRIMARY))} THEN 'primary' ELSE 'secondary' END AS part, metric,
        'status' AS statistic, NULL::DOUBLE AS value, CASE WHEN least(a_n, b_n) < 2 THEN 'insufficient_data' WHEN a_std + b_std > 0 THEN 'ok' ELSE 'constant_data' END AS label
        FROM named_long_moments WHERE metric IN {_listed(TESTED)}"""
_NAMED_DECISION = f"""
    SELECT 'form_export_rate' AS metric, srm_passed, coalesce(p < 0.05, false) AS primary_significant, p AS p_value, mean_diff AS effect,
           fails AS guardrail_failures, severe AS severe_failures,
           CASE WHEN NOT srm_passed THEN 'INCONCLUSIVE' WHEN severe > 0 THEN 'STOP_FOR_HARM'
                WHEN p < 0.05 AND mean_diff > 0 AND fails > 0 THEN 'SHIP_WITH_MONITORING'
                WHEN p < 0.05 AND mean_diff > 0 THEN 'SHIP' WHEN p < 0.05 THEN 'INCONCLUSIVE' ELSE 'CONTINUE_EXPERIMENT' END AS decision
    FROM (SELECT bool_and(passed) AS srm_passed FROM ({_srm_sql(_ALL_ROWS)})),
         (SELECT count(*) FILTER (NOT passed) AS fails, count(*) FILTER (NOT passed AND abs(diff_pct) >= 50) AS severe FROM ({_guard_sql("named_long")})),
         (SELECT p, mean_diff FROM named_long_welch WHERE metric = 'form_export_rate')"""
_SUMMARY = """SELECT experiment_group || '.' || metric AS metric, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max,
        count(*) AS n, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75
        FROM named_long GROUP BY experiment_group, named_long.metric"""
SRM_STATS = ("observed", "expected", "chi2_stat", "p_value", "passed")
register("configured_user_metrics", configured_frame, "SELECT * FROM named_users", " ".join(TESTED + GUARDED))
register(
    "configured_readout",
    lambda w: ro.readout(CONFIGURED, configured_frame(w))["long"],
    " UNION ALL ".join([
        _flat("srm", _srm_sql(_ALL_ROWS), SRM_STATS),
        _flat("primary", f"SELECT * FROM ({_effect_sql('named_long')}) WHERE metric IN {_listed(CONFIGURED.named(ro.PRIMARY))}", ro.EFFECT),
        _flat("secondary", f"SELECT * FROM ({_effect_sql('named_long')}) WHERE metric IN {_listed(CONFIGURED.named(ro.SECONDARY))}", ro.EFFECT),
        _flat("secondary", _NAMED_BH, ["adjusted_p", "rejected"]),
        _STATUS,
        _flat("bootstrap", _NAMED_BOOT, ro.BOOTSTRAP),
        _flat("guardrail", _guard_sql("named_long"), ro.GUARD),
        _flat("summary", _SUMMARY, ro.SUMMARY),
        _flat("decision", _NAMED_DECISION, ro.DECISION),
        f"SELECT 'decision' AS part, metric, 'decision' AS statistic, NULL::DOUBLE AS value, decision AS label FROM ({_NAMED_DECISION})",
    ]),
    "value",
)
register(
    "configured_readout_segments",
    configured_segments,
    " UNION ALL ".join([
        _flat("srm", _srm_sql("named_segments"), SRM_STATS, "dimension, level,"),
        _flat("effect", _effect_sql("named_segments_long"), ro.EFFECT, "dimension, level,"),
        _flat("guardrail", _guard_sql("named_segments_long"), ro.GUARD, "dimension, level,"),
    ]),
    "value",
)
