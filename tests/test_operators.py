"""Operators against brute force on generated frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators.median import exact_median
from shelfwise.operators.ranking import listed, ordinal_rank, reverse_rank, share_of_total


@pytest.mark.parametrize("kind", ["normal", "heavy_tail", "ties", "negative", "tiny"])
def test_exact_median_matches_builtin(spark, kind):
    rng = np.random.default_rng(7)
    n = 3 if kind == "tiny" else 5000
    if kind == "normal":
        v = rng.normal(100, 15, n)
    elif kind == "heavy_tail":
        v = np.concatenate([rng.pareto(0.7, n - 3) * 10, [1e12, 5e11, 0.0]])
    elif kind == "ties":
        v = rng.integers(0, 5, n).astype(float)
    elif kind == "negative":
        v = rng.normal(-50, 100, n)
    else:
        v = np.array([3.0, -1.0, 7.5])
    k = rng.integers(0, 3, n)
    rows = [(int(a), float(b)) for a, b in zip(k, v)] + [(9, None)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(6)
    mine = {r.k: r.m for r in exact_median(df, ["k"], "v", "m").collect()}
    few = {r.k: r.m for r in exact_median(df, ["k"], "v", "m", partitions=2).collect()}
    assert few == mine
    ref = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).where("m is not null").collect()}
    assert mine.keys() == ref.keys()
    for key in ref:
        assert mine[key] == pytest.approx(ref[key], rel=1e-12, abs=1e-12)
    g = exact_median(df, [], "v", "m").collect()[0].m
    assert g == pytest.approx(df.agg(F.median("v")).collect()[0][0], rel=1e-12)


def test_exact_median_of_hot_null_and_single_groups(spark):
    """A group of most rows, a null key, one value, an even count across a partition's edge, an empty table."""
    rows = [("hot", float(i)) for i in range(3000)] + [("hot", 7.0)] * 500 + [(None, 1.0), (None, 4.0), ("one", 2.5), ("nothing", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    hot = sorted([float(i) for i in range(3000)] + [7.0] * 500)
    for n in (1, 7, 40):
        got = {r.k: r.m for r in exact_median(df, ["k"], "v", "m", partitions=n).collect()}
        assert got == {"hot": (hot[1749] + hot[1750]) / 2, None: 2.5, "one": 2.5}
    assert exact_median(df.limit(0), ["k"], "v").collect() == []


def test_listed_numbers_a_sorted_list(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 5.0)], "k int, v double")
    assert sorted((r.posicion, r.k) for r in listed(df, [F.desc("v"), F.asc("k")]).collect()) == [(1, 2), (2, 1), (3, 3)]
    assert listed(df.limit(0), [F.desc("v")]).collect() == []


def test_ordinal_rank_is_a_permutation(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(x)) for i, x in enumerate(rng.integers(0, 50, 2000))]
    df = spark.createDataFrame(rows, "id int, v double")
    ranked = ordinal_rank(df, [F.col("v").desc(), F.col("id").asc()], "r", partitions=7)
    ranked = reverse_rank(ranked, "r", "r_asc")
    got = sorted((r.r, r.v, r.id, r.r_asc) for r in ranked.collect())
    expected = sorted(rows, key=lambda t: (-t[1], t[0]))
    assert [(g[1], g[2]) for g in got] == [(e[1], e[0]) for e in expected]
    assert [g[0] for g in got] == list(range(1, 2001))
    assert all(g[0] + g[3] == 2001 for g in got)


def test_share_sums_to_100(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 11)], "k int, v double")
    total = share_of_total(df, "v", "s").agg(F.sum("s")).collect()[0][0]
    assert total == pytest.approx(100.0)


def test_distributed_median_on_the_fact(spark):
    import os

    from __spark_entry__ import queries
    from shelfwise.plans.catalog import Context

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    fact = Context(spark, sf).fact.withColumn("p", F.col("onpromotion") > 0)
    mine = {r.p: r.m for r in exact_median(fact, ["p"], "sales", "m").collect()}
    ref = {r.p: r.m for r in fact.groupBy("p").agg(F.median("sales").alias("m")).collect()}
    assert mine == pytest.approx(ref, rel=1e-12)
    assert queries()["promo_general"](spark, sf).count() == 2
