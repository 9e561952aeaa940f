"""First and latest rows per group, and that no fact table is sorted for them."""

from __future__ import annotations

import random

import pytest

from conftest import SMALL

import __spark_entry__ as driver
from tidemark.functions.exprs import extreme_rows
from tidemark.operators import experiment


@pytest.mark.parametrize("largest", [False, True])
def test_extreme_rows(spark, largest):
    rng = random.Random(3)
    data = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2, 3]), f"t{rng.randint(0, 9)}", i) for i in range(200)]
    data += [("hot", 5, f"t{i:04d}", i) for i in range(500)] + [("blank", None, "t1", 1), ("blank", None, "t2", 2)]
    frame = spark.createDataFrame(data, "user string, time int, task string, carried int")
    got = {r["user"]: tuple(r) for r in extreme_rows(frame, ["user"], ["time", "task"], ["carried"], largest).collect()}
    for user in {d[0] for d in data}:
        mine = [d for d in data if d[0] == user]
        timed = [d for d in mine if d[1] is not None] or mine
        order = lambda d: (d[1] or 0, d[2], d[3])
        assert got[user] == (max if largest else min)(timed, key=order)
    assert len(got) == len({d[0] for d in data})


def test_contaminated_ids(spark):
    rows = [("a", "A", False), ("a", "A", False), ("b", "A", False), ("b", "B", False), ("c", "A", True), ("d", None, False),
            ("d", "B", False), ("e", "A", False), ("e", "B", None), ("f", "B", None), ("f", "B", True)]
    frame = spark.createDataFrame(rows, "user_id string, experiment_group string, is_intentional_contamination boolean")
    assert {r[0] for r in experiment.contaminated_ids(frame).collect()} == {"b", "c", "f"}


def sorted_facts(df) -> list[str]:
    """Sort-based aggregates of a plan that read a scan before anything has collapsed or matched rows."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = df.select("*")._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    bad = []
    for i, line in enumerate(lines):
        if "SortAggregate" in line:
            for below in lines[i + 1 :]:
                if depth(below) <= depth(line) or "HashAggregate" in below or "Join" in below:
                    break
                if "Scan" in below:
                    bad.append(line)
    return bad


@pytest.mark.parametrize("name", ["agent_error_classification", "clean_assignments"])
def test_registered_queries_do_not_sort_facts(spark, name):
    assert not sorted_facts(driver.queries()[name](spark, SMALL))


def test_winners_are_not_sorted_out_of_facts(spark):
    frame = spark.createDataFrame([("a", 1, "t", "x")], "user string, time int, task string, carried string")
    assert not sorted_facts(extreme_rows(frame, ["user"], ["time", "task"], ["carried"]))
    assert sorted_facts(frame.groupBy("user").agg({"task": "max"}))
