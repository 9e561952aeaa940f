"""Every assertion reports a planted fault, and names the rows at fault."""

from __future__ import annotations

import pytest
from conftest import SMALL

from catalog.quality import FAULTS
from catalog.registry import warehouse
from tidemark.plans import assertions, faults

# faults for the assertions whose models hold violations anyway, or only under one rule
MORE = {
    "run_task_exists": ("events", faults.lose_rows("event_time >= TIMESTAMP_NTZ '2024-01-16 00:00:00'")),
    "run_identity_matches": ("runs", faults.overwrite("user_id", "-1", "error_type IS NOT NULL")),
    "contaminated_are_identified": ("clean_assignments", faults.overwrite("is_contaminated", "true", "experiment_group = 'A'")),
    "cost_in_range": ("runs", faults.overwrite("estimated_cost_usd", "101", "NOT success_flag")),
    "event_temporal_order": ("task_event_sequence", faults.overwrite("ocr_completed_at", "ocr_started_at - INTERVAL 1 DAY", "ocr_started_at IS NOT NULL")),
    "timestamps_monotone": ("task_event_sequence", faults.overwrite("ocr_started_at", "uploaded_at - INTERVAL 1 DAY", "uploaded_at IS NOT NULL")),
    "scorecard_matches_funnel": ("conversion_funnel", faults.overwrite("tasks", "tasks + 1", "step = 'exported'")),
    "one_clean_assignment": ("clean_assignments", faults.repeat_rows("experiment_group = 'B'")),
    "export_requires_review": ("task_funnel_flags", faults.overwrite("did_start_review", "false", "did_export")),
    "no_export_abandon_conflict": ("task_funnel_flags", faults.overwrite("did_abandon", "true", "did_export")),
    "span_ends_after_start": ("spans", faults.overwrite("end_time", "start_time - INTERVAL 1 SECOND", "status = 'error'")),
}
PLANTED = {**{name: (model, change) for name, (model, change, _, _) in FAULTS.items()}, **MORE}


def test_every_assertion_has_a_fault():
    assert set(PLANTED) == set(assertions.ASSERTIONS)


@pytest.mark.parametrize("name", sorted(PLANTED))
def test_fault_is_reported(spark, name):
    model, change = PLANTED[name]
    binding = "traces" if name in ("agent_coverage_per_group", "cost_in_range") else "product"
    check = assertions.ASSERTIONS[name]
    before = set(check(warehouse(spark, SMALL, binding)).collect())
    after = set(check(faults.with_fault(warehouse(spark, SMALL, binding), model, change)).collect())
    assert after - before
