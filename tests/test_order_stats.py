from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.order_stats import BINS_PER_UNIT, _log_bin, exact_percentiles, positions_within, text_slices

PROBS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}


def check(spark, data, **kw):
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    got = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", PROBS, **kw).collect()}
    groups = {g for g, v in data if v is not None}
    assert set(got) == groups
    for g in groups:
        values = [v for k, v in data if k == g and v is not None]
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(np.percentile(values, 100 * p), abs=1e-9)


def test_mixed_signs_outliers_ties_and_nulls(spark):
    rng = random.Random(3)
    data = [("a", rng.gauss(0, 50)) for _ in range(700)]
    data += [("b", float(rng.randint(-3, 3))) for _ in range(500)]
    data += [("c", v) for v in (1.0, 2.0, 1e12, -1e9, 3.0, 3.5)]
    data += [("d", 7.0), (None, 4.0), (None, 5.0), ("a", None)]
    check(spark, data)


@pytest.mark.parametrize("slices", [1, 8, 1024])
def test_any_number_of_bins_gives_the_same_answer(spark, slices):
    rng = random.Random(slices)
    check(spark, [("hot" if rng.random() < 0.9 else "cold", rng.expovariate(0.01)) for _ in range(800)], bins_per_unit=slices)


def test_weights_count_as_copies(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 10.0, 1), ("a", 4.0, 0), ("a", 6.0, 2)], "g string, v double, w int")
    got = exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p80": 0.8}, weight="w").first()
    expanded = [1.0] * 3 + [10.0] + [6.0] * 2
    assert got["p50"] == np.percentile(expanded, 50)
    assert got["p80"] == pytest.approx(np.percentile(expanded, 80))


def test_carried_sums_include_rows_without_a_value(spark):
    data = [("a", 1.0, 10), ("a", 1.0, 20), ("a", 3.0, None), ("a", None, 5), ("b", None, 7)]
    df = spark.createDataFrame(data, "g string, v double, x int")
    out = exact_percentiles(df, ["g"], "v", {"p50": 0.5}, carry={"x": F.col("x"), "n": F.lit(1)})
    assert {tuple(r) for r in out.select("g", "x", "n", "p50").collect()} == {("a", 35, 4, 1.0), ("b", 7, 1, None)}


def test_rows_of_weight_zero_keep_their_sums(spark):
    df = spark.createDataFrame([("a", 1.0, 0, 5), ("a", 1.0001, 2, 7), ("a", 900.0, 0, 1)], "g string, v double, w int, x int")
    out = exact_percentiles(df, ["g"], "v", {"p50": 0.5}, weight="w", carry={"x": F.col("x")}).first()
    assert (out["x"], out["p50"]) == (13, 1.0001)


@pytest.mark.parametrize("bounded", [True, False])
def test_input_is_read_once(spark, tmp_path, bounded):
    spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 1.5).alias("v")).write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in")
    out = exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p95": 0.95}, carry={"n": F.lit(1), "s": F.col("v")}, bounded_groups=bounded)
    assert sorted(r["n"] for r in out.collect()) == [1666, 1667, 1667]
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_positions_match_a_plain_row_number(spark, kind):
    rng = random.Random(11)
    keys = rng.sample(range(10_000_000), 900)
    data = [("hot" if i % 3 else "cold", k if kind == "bigint" else f"user_{k:08d}") for i, k in enumerate(keys)]
    df = spark.createDataFrame(data, f"g string, k {kind}").repartition(7)
    got = {(r["g"], r["k"]): r["n"] for r in positions_within(df, ["g"], "k", "n", bins=16, rows_per_bin=8).collect()}
    for g in ("hot", "cold"):
        ordered = sorted(k for name, k in data if name == g)
        assert [got[(g, k)] for k in ordered] == list(range(1, len(ordered) + 1))


def test_slices_of_serial_text_keys_stay_small(spark):
    """Serial numbers of different lengths, a long common beginning, keys that begin other keys."""
    ids = spark.range(300_000).select(F.concat(F.lit("customer-account-"), F.col("id").cast("string")).alias("k"), F.lit(None).cast("string").alias("g"))
    sliced = text_slices(ids, ["g"], "k", "s", 4096)
    sizes = sliced.groupBy("s").agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("s").collect()
    assert max(r["n"] for r in sizes) <= 4096 and sum(r["n"] for r in sizes) == 300_000
    assert all(a["hi"] < b["lo"] for a, b in zip(sizes, sizes[1:]))


def test_text_positions_with_odd_keys(spark):
    words = ["", "a", "ab", "abc", "abd", "abé", "b", "ba", "zz", "z", "\U0001F600", "\U0001F600a", "é", "a" * 500, "a" * 499 + "b"]
    df = spark.createDataFrame([(w,) for w in words], "k string").withColumn("g", F.lit(1))
    got = {r["k"]: r["n"] for r in positions_within(df, ["g"], "k", "n", rows_per_bin=1).collect()}
    assert [got[w] for w in sorted(words, key=str.encode)] == list(range(1, len(words) + 1))


def test_slices_stay_small_below_one_and_beside_an_outlier(spark):
    small = spark.range(20_000).select((F.col("id") * 3.5e-7 + 1e-4).alias("v"))
    sizes = small.groupBy(_log_bin(F.col("v"), BINS_PER_UNIT)).count()
    assert sizes.agg(F.max("count")).first()[0] < 200
    with_outlier = small.unionByName(spark.createDataFrame([(1e12,), (0.0,), (-1e-9,), (5e-324,)], "v double"))
    sizes = with_outlier.groupBy(_log_bin(F.col("v"), 16)).count()
    assert sizes.agg(F.max("count")).first()[0] < 1500
    ordered = with_outlier.select("v", _log_bin(F.col("v"), BINS_PER_UNIT).alias("b")).orderBy("v").collect()
    assert all(x["b"] <= y["b"] for x, y in zip(ordered, ordered[1:]))
