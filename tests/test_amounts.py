"""Sums keep every digit of their amounts, and nothing is rounded before it is selected."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.columns import rounded
from shelfwise.plans.cells import family_cells, store_cells
from shelfwise.plans.holidays import holiday_sensitivity, holiday_vs_normal, holiday_window
from shelfwise.plans.oil import oil_best_lag
from shelfwise.plans.promotions import promo_by_family, promo_general, promo_negative
from shelfwise.plans.sales import by_family, total_by


@pytest.mark.parametrize("amount, total", [(0.004, 4.0), (12.457, 12457.0), (0.000001, 0.001)])
def test_sums_are_not_cut_to_cents(spark, amount, total):
    rows = spark.range(1000).select(F.lit("A").alias("family"), F.lit(amount).alias("sales"))
    row = total_by(rows, ["family"]).first()
    assert row.ventas_totales == total
    assert row.venta_promedio == pytest.approx(amount, rel=1e-12)


EXTREME = [[4e-13] * 1000, [1 / 3] * 3, [1e17, 0.1, -1e17], [float("nan"), 1.0], [float("inf"), 1.0], [None, 2.5], [0.1] * 10, [1e300, 1e-300, -1e300]]


@pytest.fixture(scope="module")
def extreme(spark):
    """A fact of tiny, huge, missing and special amounts, one family and store per case."""
    day = dt.date(2015, 1, 30)
    rows = [(day + dt.timedelta(days=i % 3), k, f"F{k}", f"C{k}", "S", v, i % 2, i % 3 == 0, 5, 40.0) for k, values in enumerate(EXTREME) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date date, store_nbr bigint, family string, city string, state string, sales double, onpromotion int, "
                                 "es_feriado_nacional boolean, transactions bigint, dcoilwtico double").repartition(5)


def plain_sum(values):
    values = [v for v in values if v is not None]
    return "nan" if any(v != v for v in values) else math.fsum(values)


def test_totals_of_extreme_amounts_from_the_fact_and_from_cells(extreme):
    want = {f"F{k}": plain_sum(v) for k, v in enumerate(EXTREME)}
    for source in (extreme, extreme.repartition(1), family_cells(extreme)):
        got = {r.family: "nan" if r.ventas_totales != r.ventas_totales else r.ventas_totales for r in total_by(source, ["family"]).collect()}
        assert got == want
    got = {r.city: "nan" if r.ventas_totales != r.ventas_totales else r.ventas_totales for r in total_by(store_cells(extreme), ["city"]).collect()}
    assert got == {f"C{k}": plain_sum(v) for k, v in enumerate(EXTREME)}


def test_cells_answer_like_the_fact(spark):
    rng = random.Random(6)
    rows = [(dt.date(2015, 1, 1) + dt.timedelta(days=rng.randrange(60)), rng.randrange(5), f"F{rng.randrange(4)}", "C", "S", round(rng.uniform(-5, 900), 2), rng.randrange(3),
             rng.random() < 0.2, None, 40.0) for _ in range(3000)]
    fact = spark.createDataFrame(rows, "date date, store_nbr bigint, family string, city string, state string, sales double, onpromotion int, "
                                 "es_feriado_nacional boolean, transactions bigint, dcoilwtico double")
    cells = family_cells(fact)
    for fn in (by_family, promo_by_family, holiday_sensitivity, holiday_vs_normal, holiday_window):
        assert sorted(map(str, fn(fact).collect())) == sorted(map(str, fn(cells).collect())), fn
    assert sorted(map(str, promo_general(fact).collect())) == sorted(map(str, promo_general(fact, cells).collect()))


def test_a_tiny_negative_change_is_negative(spark):
    day = dt.date(2015, 1, 1)
    rows = [(day, "A", 100.0, 0), (day, "A", 100.0 * (1 - 1e-11), 1)]
    fact = spark.createDataFrame(rows, "date date, family string, sales double, onpromotion bigint")
    assert promo_negative(promo_by_family(fact)).count() == 1


def test_best_lag_uses_every_digit(spark):
    scan = spark.createDataFrame([(0, 0.5000001, 9), (1, 0.5000003, 9)], "lag_meses int, correlacion double, meses_comparados bigint")
    assert oil_best_lag(scan).first().lag_meses == 1
    assert rounded(scan).first().correlacion == 0.5
