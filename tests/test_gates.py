"""Gates stop the job on literal frames that break them."""

import datetime as dt

import pytest

from shelfwise.operators.expect import require_rows
from shelfwise.plans.holidays import holiday_window
from shelfwise.plans.oil import require_months
from shelfwise.plans.traffic import traffic_daily

DAY = dt.date(1997, 1, 1)


def test_no_holiday(spark):
    fact = spark.createDataFrame([(DAY, "A", 1.0, False)], "date date, family string, sales double, es_feriado_nacional boolean")
    with pytest.raises(ValueError, match="no national holiday"):
        holiday_window(fact)


@pytest.mark.parametrize("values", [[5, 6], [5, None]])
def test_two_transactions_values_for_a_day(spark, values):
    fact = spark.createDataFrame([(DAY, 1, 1.0, v) for v in values], "date date, store_nbr bigint, sales double, transactions bigint")
    with pytest.raises(Exception, match="more than one value"):
        traffic_daily(fact).collect()


def test_one_value_for_a_day(spark):
    rows = [(DAY, 1, 1.0, 5), (DAY, 1, 2.0, 5), (DAY, 2, 1.0, None), (DAY, 3, 1.0, 0)]
    fact = spark.createDataFrame(rows, "date date, store_nbr bigint, sales double, transactions bigint")
    assert [(r.store_nbr, r.ventas_diarias, r.transactions) for r in traffic_daily(fact).collect()] == [(1, 3.0, 5)]


@pytest.mark.parametrize("months, stops", [(2, True), (3, True), (4, False)])
def test_months(spark, months, stops):
    monthly = spark.createDataFrame([(dt.date(1997, m, 1),) for m in range(1, months + 1)], "fecha_mes date")
    if stops:
        with pytest.raises(ValueError, match="fewer than"):
            require_months(monthly)
    else:
        assert require_months(monthly).count() == months


def test_empty(spark):
    with pytest.raises(ValueError, match="nothing"):
        require_rows(spark.range(0), 1, "nothing")
