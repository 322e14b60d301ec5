"""Exact sums of doubles: equal to math.fsum in every order, through every merge."""

import math
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.exact import _power, accumulate, totals

INF, NAN = float("inf"), float("nan")


def cases():
    rng = random.Random(4)
    out = {
        "tiny": [4e-13] * 1000,
        "thirds": [1 / 3] * 3,
        "huge": [1e17, 1.0, -1e17, 1e17],
        "cancel": [1e300, 1.0, -1e300, 1e-300],
        "nan": [NAN, 1.0],
        "infinite": [INF, 1.0],
        "both": [INF, -INF],
        "minus": [-INF, 5.0],
        "nulls": [None, None],
        "some": [None, 0.1, 0.2, None],
        "zero": [0.0, -0.0],
        "one": [0.1],
        "subnormal": [5e-324] * 3 + [-5e-324],
        "least": [5e-324, 2.0 ** -1022, -(2.0 ** -1022)],
        "largest": [1.7976931348623157e308, -1.7976931348623157e308, 3.0],
        "even": [1.0, 2.0 ** -53],
        "odd": [1.0, 2.0 ** -53, 2.0 ** -1000],
        "negative even": [-1.0, -(2.0 ** -53)],
        "edges": [2.0 ** (26 * k) for k in range(-30, 30)] + [-(2.0 ** (26 * k)) * (1 - 2.0 ** -53) for k in range(-30, 30)],
    }
    for k in range(25):
        span = rng.choice([2, 20, 300, 600])
        out[f"random {k}"] = [rng.choice([-1, 1]) * math.ldexp(rng.random(), rng.randint(-span, span)) for _ in range(rng.randint(1, 60))]
    for k in range(6):
        out[f"cents {k}"] = [round(rng.uniform(-1e6, 1e6), 2) for _ in range(2000)]
    return out


def want(values):
    values = [v for v in values if v is not None]
    if not values:
        return None
    if any(math.isnan(v) for v in values) or {INF, -INF} <= set(values):
        return "nan"
    return math.fsum(values)


def shown(x):
    return "nan" if x is not None and math.isnan(x) else x


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(name, i % 3, v) for name, values in cases().items() for i, v in enumerate(values)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "name string, part int, x double").repartition(7)


def test_totals_equal_fsum(frame):
    got = {r.name: (shown(r.total), r._count, r._rows) for r in totals(frame, ["name"], "x").collect()}
    assert got == {name: (want(v), sum(x is not None for x in v), len(v)) for name, v in cases().items()}


def test_merged_states_equal_fsum(frame):
    fine = accumulate(frame.withColumn("one", F.lit(1)), ["name", "part"], "x", extra={"ones": ("sum", "one"), "last": ("max", "part")})
    again = accumulate(fine, ["name", "part"], extra={"ones": ("sum", "ones"), "last": ("max", "last")})
    got = totals(again, ["name"], out="sum", extra={"ones": ("sum", "ones"), "last": ("max", "last")}).collect()
    assert {r.name: (shown(r["sum"]), r.ones, r.last) for r in got} == {n: (want(v), len(v), min(len(v) - 1, 2)) for n, v in cases().items()}


def test_overflow_is_infinite(spark):
    df = spark.createDataFrame([(1.7e308,), (1.7e308,)], "x double")
    assert totals(df, [], "x").first().total == INF


def test_powers_are_exact(spark):
    rows = spark.range(2046).select((F.col("id") - 1022).cast("int").alias("k")).select("k", _power(F.col("k")).alias("p")).collect()
    assert all(r.p == math.ldexp(1.0, r.k) for r in rows)
