from __future__ import annotations

import os
import sys
from datetime import date, datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidemark.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidemark-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def on(text: str) -> date:
    return date.fromisoformat(text)


EVENT_DDL = (
    "event_id string, event_time timestamp_ntz, event_date date, user_id string, session_id string, "
    "document_id string, task_id string, event_name string, event_status string, platform string, "
    "app_version string, experiment_id string, experiment_group string, latency_ms double, "
    "error_type string, metadata_json string"
)


@pytest.fixture(scope="session")
def make_events(spark):
    """Rows (user, task, name, time[, document]) to a product_events frame."""

    def build(rows):
        full = []
        for i, (user, task, name, time, *rest) in enumerate(rows):
            when = at(time)
            full.append(
                (f"e{i}", when, when.date(), user, f"s{user}", rest[0] if rest else "d1", task, name, "success",
                 "web", "1.0", "x", "A", 1.0, None, "{}")
            )
        return spark.createDataFrame(full, EVENT_DDL)

    return build


@pytest.fixture(scope="session")
def make_users(spark):
    """Rows (user, signup day, channel[, device]) to a staged users frame."""

    def build(rows):
        full = [
            (r[0], at(r[1] + "T00:00:00"), r[2], "X", r[3] if len(r) > 3 else "mobile", "student", "s", "new", False, on(r[1]))
            for r in rows
        ]
        ddl = (
            "user_id string, signup_time timestamp_ntz, acquisition_channel string, country string, device_type string, "
            "user_segment string, company_size string, experience_level string, is_returning_user boolean, signup_date date"
        )
        return spark.createDataFrame(full, ddl)

    return build


def rows(df, *columns):
    """Result as a set of tuples of the chosen columns."""
    return {tuple(r) for r in df.select(*columns).collect()}
