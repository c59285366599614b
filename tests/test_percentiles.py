import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from cinderlake.operators import percentiles as pc

POINTS = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def expected(frame, keys):
    out = {}
    for key, part in frame.dropna(subset=["v"]).groupby(keys, dropna=False):
        v = part["v"].to_numpy(float)
        out[tuple(None if pd.isna(k) else k for k in key)] = (
            *np.percentile(v, [25, 50, 75]), v.min(), v.max(), v.sum())
    return out


def check(got, want):
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(values, rel=1e-9, abs=1e-9), key


def as_dict(df, n=2):
    return {tuple(r)[:n]: tuple(r)[n:] for r in df.collect()}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(
    st.sampled_from([2001, 2002]), st.sampled_from(["a", "b", None]),
    st.one_of(st.none(), st.floats(-1e9, 1e9), st.integers(-3, 3).map(float))), min_size=1, max_size=60))
def test_equals_numpy(spark, data):
    frame = pd.DataFrame(data, columns=["y", "k", "v"]).astype({"v": float})
    df = spark.createDataFrame(data, "y int, k string, v double")
    want = expected(frame, ["y", "k"])
    got = pc.exact_percentiles(df, ["y", "k"], "v", POINTS, low="lo_", high="hi_", total="sum_")
    check(as_dict(got), want)


def test_hot_group_and_repeated_value(spark):
    hot = spark.range(60000).select(
        F.when(F.col("id") < 40000, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 9).cast("string"))).alias("k"),
        F.when(F.col("id") % 3 == 0, 60000.0).otherwise((F.col("id") * 7919 % 100003).cast("double")).alias("v"))
    got = as_dict(pc.exact_percentiles(hot, ["k"], "v", POINTS), 1)
    builtin = as_dict(hot.groupBy("k").agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in POINTS.items()]), 1)
    check(got, builtin)


def brute_trim(frame, spread, upper):
    out = {}
    for key, part in frame.dropna(subset=["y", "k"]).groupby(["y", "k"]):
        v = part["v"].to_numpy(float)
        q1, q3 = np.percentile(v, [25, 75])
        top = upper if upper is not None else q3 + spread * (q3 - q1)
        kept = v[(v >= q1 - spread * (q3 - q1)) & (v <= top)]
        if len(kept):
            out[key] = (*np.percentile(kept, [25, 50, 75]), kept.min(), kept.max())
    return out


@pytest.mark.parametrize("upper", [None, 400.0])
def test_trimmed_equals_brute_force(spark, upper):
    rng = np.random.default_rng(7)
    frame = pd.DataFrame({
        "y": rng.integers(2001, 2004, 900), "k": rng.choice(["a", "b", None], 900, p=[0.7, 0.2, 0.1]),
        "v": np.round(rng.lognormal(4, 1.2, 900), 1)})
    df = spark.createDataFrame([(int(y), k, float(v)) for y, k, v in frame.itertuples(index=False)], "y int, k string, v double")
    got = pc.trimmed_percentiles(df, ["y", "k"], "v", POINTS, upper=upper)
    check(as_dict(got), brute_trim(frame, 1.5, upper))


def test_untrimmed_keeps_groups_without_key(spark, rows):
    df = spark.createDataFrame([("a", 1.0), (None, 4.0), (None, 6.0)], "k string, v double")
    assert rows(pc.trimmed_percentiles(df, ["k"], "v", {"m": 0.5}, spread=None), "k", "m") == [("a", 1.0), (None, 5.0)]
    assert rows(pc.trimmed_percentiles(df, ["k"], "v", {"m": 0.5}), "k", "m") == [("a", 1.0)]


def test_approximate_form_is_close(spark):
    df = spark.range(10001).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("v"))
    row = pc.approximate_percentiles(df, ["k"], "v", {"m": 0.5}).first()
    assert abs(row["m"] - 5000) <= 2


def test_narrow_values_are_not_ranked_together(spark):
    df = spark.range(200_000).select(F.lit("a").alias("k"), (F.col("id") * 7919 % 200_000 * 1e-9).alias("v")).repartition(7)
    got = pc.exact_percentiles(df, ["k"], "v", POINTS)
    assert tuple(got.first())[1:] == pytest.approx(tuple(np.percentile(np.arange(200_000) * 1e-9, [25, 50, 75])), rel=1e-12)
    plan = got._jdf.queryExecution()
    got.collect()
    # The rows that are ranked: the profile's groups.
    profile = pc.exact_percentiles(df, ["k"], "v", POINTS)
    assert "partial_percentile(" not in plan.executedPlan().toString() and "collect_" not in plan.executedPlan().toString()
    low, high = df.selectExpr(f"percentile_approx(v, array({0.25 - pc.MARGIN}D, {0.25 + pc.MARGIN}D), {pc.ACCURACY}) AS a").first()["a"]
    assert df.filter((F.col("v") >= low) & (F.col("v") <= high)).count() <= 12 * 200_000 / pc.ACCURACY
    assert profile.count() == 1


def test_same_doubles_however_partitioned(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), float(v)) for k, v in zip(rng.integers(0, 3, 30_000), np.round(rng.lognormal(4, 2, 30_000), 3), strict=True)]
    df = spark.createDataFrame(rows, "k int, v double")
    results = {tuple(sorted(map(tuple, pc.exact_percentiles(df.repartition(n), ["k"], "v", POINTS).collect()))) for n in (1, 3, 11)}
    assert len(results) == 1
    for k, *found in results.pop():
        v = np.sort([x for i, x in rows if i == k])
        for p, q in zip((0.25, 0.5, 0.75), found, strict=True):
            at = p * (len(v) - 1)
            a, b = v[int(np.floor(at))], v[int(np.ceil(at))]
            assert q == (a if a == b else a + (b - a) * (at - np.floor(at)))


def test_infinite_and_missing_numbers(spark):
    rows = [("a", float("inf")), ("a", 1.0), ("a", float("nan")), ("a", None), ("a", float("-inf")), ("b", float("inf"))]
    got = as_dict(pc.exact_percentiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", {"m": 0.5}, low="lo_"), 1)
    assert got == {("a",): (1.0, float("-inf")), ("b",): (float("inf"), float("inf"))}


def test_values_on_a_fence_stay(spark):
    values = [10.0, 20.0, 30.0, 40.0, 50.0]  # quartiles 20 and 40, fences -10 and 70
    df = spark.createDataFrame([("a", v) for v in [*values, 70.0, -10.0]], "k string, v double")
    # quartiles of all seven: 15 and 45, fences -30 and 90
    assert as_dict(pc.trimmed_percentiles(df, ["k"], "v", {"m": 0.5}), 1) == {("a",): (30.0, -10.0, 70.0)}
    edge = spark.createDataFrame([("a", v) for v in [0.0, 1.0, 2.0, 3.0, 4.0, 7.0]], "k string, v double")
    # quartiles 1.25 and 3.75, fences -2.5 and 7.5
    assert as_dict(pc.trimmed_percentiles(edge, ["k"], "v", {"m": 0.5}, upper=7.0), 1) == {("a",): (2.5, 0.0, 7.0)}
    assert as_dict(pc.trimmed_percentiles(edge, ["k"], "v", {"m": 0.5}, upper=6.999), 1) == {("a",): (2.0, 0.0, 4.0)}
