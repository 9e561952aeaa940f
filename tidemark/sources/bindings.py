"""Two role-bound data sets over the shared test tables.

``product`` reads customers, parts and the event stream as users, documents, product events, runs,
spans, sessions and assignments of one coherent product. ``traces`` reads orders and line items as
agent runs and spans. The SELECT texts hold no filter on ids and run on any SQL engine;
``{ts}`` is the zone-free timestamp type of the engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: schemas of the source tables, so planning reads no file footers ---------------
SOURCE_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}
SOURCE_TABLES = tuple(SOURCE_SCHEMAS)

USERS = """
SELECT c_custkey AS user_id,
       CAST(DATE '2023-12-20' + CAST(c_custkey % 40 AS INT) AS {ts}) AS signup_time,
       c_mktsegment AS acquisition_channel,
       n_name AS country,
       CASE c_custkey % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device_type,
       r_name AS user_segment,
       CASE WHEN c_acctbal < 2000 THEN 'small' WHEN c_acctbal < 6000 THEN 'medium' ELSE 'large' END
           AS company_size,
       CASE WHEN n_nationkey < 8 THEN 'new' WHEN n_nationkey < 16 THEN 'intermediate' ELSE 'expert' END
           AS experience_level,
       c_acctbal > 5000 AS is_returning_user
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

DOCUMENTS = """
SELECT p_partkey AS document_id,
       p_partkey % 15 AS user_id,
       p_type AS document_type,
       p_brand AS language,
       p_size AS page_count,
       CASE WHEN p_size <= 16 THEN 'simple' WHEN p_size <= 33 THEN 'medium' ELSE 'complex' END
           AS complexity_level,
       p_size % 2 = 0 AS contains_pii,
       p_size > 25 AS contains_high_risk_terms,
       CAST(DATE '2023-12-01' + CAST(p_size AS INT) AS {ts}) AS created_at
FROM {part}
"""

PRODUCT_EVENTS = """
SELECT event_id,
       ts AS event_time,
       CAST(ts AS DATE) AS event_date,
       user_id,
       user_id * 100 + CAST(day(ts) AS BIGINT) AS session_id,
       (user_id * 10 + CAST(floor((day(ts) - 1) / 3) AS BIGINT)) % 200 AS document_id,
       user_id * 10 + CAST(floor((day(ts) - 1) / 3) AS BIGINT) AS task_id,
       CASE event_type
           WHEN 'signup' THEN 'document_uploaded'
           WHEN 'view' THEN CASE event_id % 4 WHEN 0 THEN 'ocr_started' WHEN 2 THEN 'ocr_completed'
                                              ELSE 'anonymization_completed' END
           WHEN 'click' THEN CASE event_id % 2 WHEN 0 THEN 'risk_detection_completed'
                                               ELSE 'autofill_completed' END
           WHEN 'purchase' THEN CASE event_id % 2 WHEN 0 THEN 'form_review_started'
                                                  ELSE 'form_exported' END
           ELSE CASE event_id % 4 WHEN 1 THEN 'task_abandoned' WHEN 3 THEN 'field_edited'
                                  ELSE 'agent_run_failed' END
       END AS event_name,
       CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS event_status,
       CASE WHEN value < 50 THEN 'web' ELSE 'api' END AS platform,
       CASE WHEN day(ts) > 20 THEN '2.3.0' ELSE '2.2.1' END AS app_version,
       'exp_autofill' AS experiment_id,
       CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS experiment_group,
       value AS latency_ms,
       CASE WHEN event_type = 'error' THEN CASE WHEN value < 10 THEN 'ocr_error' ELSE 'timeout' END END
           AS error_type,
       props AS metadata_json
FROM {events}
"""

SESSIONS = """
SELECT session_id, user_id, min(event_time) AS started_at, max(event_time) AS ended_at,
       CASE user_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device_type,
       min(platform) AS platform,
       CASE WHEN user_id % 2 = 0 THEN 'organic' ELSE 'social' END AS acquisition_channel,
       count(*) = 1 AS is_bounced,
       CAST(count(*) AS INT) AS page_views
FROM {product_events}
GROUP BY session_id, user_id
"""

TASK_RUNS = """
SELECT task_id AS agent_run_id, task_id AS trace_id, task_id, user_id, document_id,
       started_at, ended_at,
       cents AS total_latency_ms,
       text_length * 20 AS total_input_tokens,
       event_total * 150 AS total_output_tokens,
       CAST(cents AS DOUBLE) / 1000000 AS estimated_cost_usd,
       CASE document_id % 3 WHEN 0 THEN 'gpt-4o-mini-2024-07-18' WHEN 1 THEN 'gpt-4o-2024-08-06'
                            ELSE 'claude-haiku-3.5-20241022' END AS model_name,
       CASE user_id % 2 WHEN 0 THEN 'v1' ELSE 'v2' END AS prompt_version,
       CAST(event_total - failed_total AS INT) AS tool_call_count,
       CAST(failed_total AS INT) AS retry_count,
       failed_total = 0 AS success_flag,
       CAST(export_total AS DOUBLE) / event_total AS quality_score,
       CAST(event_total - failure_total AS DOUBLE) / event_total AS field_accuracy,
       CAST(edit_total AS INT) AS manual_edit_count,
       CASE WHEN failed_total > 0 THEN first_error END AS error_type,
       CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS experiment_group
FROM (
    SELECT task_id, user_id, document_id,
           min(event_time) AS started_at, max(event_time) AS ended_at,
           CAST(sum(CAST(round(latency_ms * 100) AS BIGINT)) AS BIGINT) AS cents,
           CAST(sum(length(metadata_json)) AS BIGINT) AS text_length,
           count(*) AS event_total,
           count(*) FILTER (WHERE event_name = 'agent_run_failed') AS failed_total,
           count(*) FILTER (WHERE event_status = 'failure') AS failure_total,
           count(*) FILTER (WHERE event_name = 'form_exported') AS export_total,
           count(*) FILTER (WHERE event_name = 'field_edited') AS edit_total,
           min(error_type) AS first_error
    FROM {product_events}
    GROUP BY task_id, user_id, document_id
) AS t
"""

TASK_SPANS = """
SELECT event_id AS span_id, task_id AS trace_id, CAST(NULL AS BIGINT) AS parent_span_id,
       CASE event_name
           WHEN 'document_uploaded' THEN 'document_classification'
           WHEN 'ocr_started' THEN 'ocr_extraction'
           WHEN 'ocr_completed' THEN 'ocr_extraction'
           WHEN 'anonymization_completed' THEN 'anonymization'
           WHEN 'risk_detection_completed' THEN 'risk_detection'
           WHEN 'autofill_completed' THEN 'form_autofill'
           WHEN 'form_review_started' THEN 'field_mapping'
           WHEN 'form_exported' THEN 'output_validation'
           ELSE 'pii_detection'
       END AS span_name,
       CASE event_name
           WHEN 'risk_detection_completed' THEN 'llm'
           WHEN 'autofill_completed' THEN 'llm'
           WHEN 'ocr_started' THEN 'tool'
           WHEN 'ocr_completed' THEN 'tool'
           WHEN 'form_exported' THEN 'validation'
           WHEN 'document_uploaded' THEN 'retrieval'
           ELSE 'agent'
       END AS span_type,
       event_time AS start_time,
       event_time + INTERVAL 1 SECOND AS end_time,
       CAST(round(latency_ms * 10) AS BIGINT) AS latency_ms,
       CASE WHEN event_status = 'failure' THEN 'error' ELSE 'ok' END AS status,
       'gpt-4o-mini-2024-07-18' AS model_name,
       CAST(length(metadata_json) AS BIGINT) AS input_tokens,
       CAST(length(event_name) AS BIGINT) AS output_tokens,
       CAST(round(latency_ms * 100) AS BIGINT) / 1000000.0 AS estimated_cost_usd,
       CASE WHEN event_name = 'ocr_completed' THEN 'ocr_api' END AS tool_name,
       error_type, metadata_json
FROM {product_events}
"""

ASSIGNMENTS = """
SELECT c_custkey * 4 AS assignment_id, 'exp_autofill' AS experiment_id, c_custkey AS user_id,
       CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'B' END AS experiment_group,
       CAST(DATE '2024-01-01' + CAST(c_custkey % 10 AS INT) AS {ts}) AS assigned_at,
       FALSE AS is_intentional_contamination
FROM {customer}
UNION ALL
SELECT c_custkey * 4 + 1, 'exp_autofill', c_custkey,
       CASE WHEN c_custkey % 2 = 0 THEN 'B' ELSE 'A' END,
       CAST(DATE '2024-01-02' + CAST(c_custkey % 10 AS INT) AS {ts}), TRUE
FROM {customer} WHERE c_acctbal < 0
UNION ALL
SELECT c_custkey * 4 + 2, 'exp_autofill', c_custkey,
       CASE WHEN c_custkey % 2 = 0 THEN 'B' ELSE 'A' END,
       CAST(DATE '2024-01-03' + CAST(c_custkey % 10 AS INT) AS {ts}), FALSE
FROM {customer} WHERE c_acctbal > 9500
UNION ALL
SELECT c_custkey * 4 + 3, 'exp_autofill', c_custkey,
       CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'B' END,
       CAST(DATE '2024-01-04' + CAST(c_custkey % 10 AS INT) AS {ts}), TRUE
FROM {customer} WHERE c_acctbal BETWEEN 0 AND 300
"""

ORDER_RUNS = """
SELECT o_orderkey AS agent_run_id, o_orderkey AS trace_id, o_orderkey AS task_id,
       o_custkey AS user_id, o_orderkey % 200 AS document_id,
       o_orderdate AS started_at, o_orderdate + INTERVAL 1 HOUR AS ended_at,
       CAST(floor(o_totalprice / 100) AS BIGINT) AS total_latency_ms,
       CAST(floor(o_totalprice) AS BIGINT) AS total_input_tokens,
       CAST(floor(o_totalprice / 4) AS BIGINT) AS total_output_tokens,
       o_totalprice AS estimated_cost_usd,
       o_orderpriority AS model_name,
       CASE o_custkey % 2 WHEN 0 THEN 'v1' ELSE 'v2' END AS prompt_version,
       CAST(o_orderkey % 5 AS INT) AS tool_call_count,
       CAST(o_custkey % 3 AS INT) AS retry_count,
       o_orderstatus = 'F' AS success_flag,
       CAST(o_orderkey % 101 AS DOUBLE) / 100 AS quality_score,
       CAST(o_custkey % 101 AS DOUBLE) / 100 AS field_accuracy,
       CAST(o_orderkey % 7 AS INT) AS manual_edit_count,
       CASE o_orderstatus WHEN 'O' THEN 'timeout' WHEN 'P' THEN 'api_error' END AS error_type,
       CASE o_custkey % 2 WHEN 0 THEN 'A' ELSE 'B' END AS experiment_group
FROM {orders}
"""

LINE_SPANS = """
SELECT l_orderkey * 10 + l_linenumber AS span_id, l_orderkey AS trace_id,
       CAST(NULL AS BIGINT) AS parent_span_id,
       CASE l_returnflag WHEN 'A' THEN 'ocr_extraction' WHEN 'N' THEN 'output_validation'
                         ELSE 'form_autofill' END AS span_name,
       CASE l_linestatus WHEN 'O' THEN 'llm' ELSE 'tool' END AS span_type,
       l_shipdate AS start_time,
       CASE WHEN l_tax >= 0.08 THEN l_shipdate - INTERVAL 1 MINUTE
            ELSE l_shipdate + INTERVAL 1 MINUTE END AS end_time,
       CAST(floor(l_extendedprice / 10) AS BIGINT) AS latency_ms,
       CASE WHEN l_discount >= 0.09 THEN 'error' ELSE 'ok' END AS status,
       CASE l_linestatus WHEN 'O' THEN 'gpt-4o-mini-2024-07-18' END AS model_name,
       CAST(l_quantity AS BIGINT) * 100 AS input_tokens,
       CAST(l_quantity AS BIGINT) * 20 AS output_tokens,
       l_extendedprice AS estimated_cost_usd,
       CASE l_linestatus WHEN 'F' THEN 'ocr_api' END AS tool_name,
       CASE WHEN l_discount >= 0.09 THEN l_returnflag END AS error_type,
       '' AS metadata_json
FROM {lineitem}
"""

PRODUCT_BINDING = {
    "users": USERS,
    "documents": DOCUMENTS,
    "product_events": PRODUCT_EVENTS,
    "sessions": SESSIONS,
    "agent_runs": TASK_RUNS,
    "agent_spans": TASK_SPANS,
    "experiment_assignments": ASSIGNMENTS,
}
TRACE_BINDING = {
    "users": USERS,
    "documents": DOCUMENTS,
    "product_events": PRODUCT_EVENTS,
    "sessions": SESSIONS,
    "agent_runs": ORDER_RUNS,
    "agent_spans": LINE_SPANS,
    "experiment_assignments": ASSIGNMENTS,
}


def bind(spark: SparkSession, folder: str, binding: dict[str, str]) -> dict[str, Callable[[], DataFrame]]:
    """Raw role tables as thunks: a table is only read when an operator asks for it."""
    cache: dict[str, DataFrame] = {}

    def frame(name: str) -> DataFrame:
        if name not in cache:
            if name in binding:
                text = binding[name].replace("{ts}", "timestamp_ntz")
                needed = [n for n in (*SOURCE_TABLES, "product_events") if "{" + n + "}" in text]
                cache[name] = spark.sql(text, **{n: frame(n) for n in needed})
            else:
                scan = spark.read.schema(SOURCE_SCHEMAS[name])
                cache[name] = scan.parquet(f"{folder}/{name}.parquet")
        return cache[name]

    return {name: (lambda n=name: frame(n)) for name in binding}
