"""Corner cases on literal frames (FIXTURES.md §4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.columns import pct_change_expr, safe_corr
from shelfwise.operators import clean as C
from shelfwise.operators.expect import ContractError, require_columns
from shelfwise.operators.gapfill import assert_filled, calendar, fill_calendar
from shelfwise.operators.joins import fanout, join_validated
from shelfwise.operators.series import best_lag, pct_change
from shelfwise.plans.consolidate import event_rollup
from shelfwise.plans.holidays import holiday_window
from shelfwise.plans.promotions import promo_by_family
from shelfwise.plans.traffic import ticket_class

D = dt.date


def days(spark, start, end):
    return calendar(spark.createDataFrame([(start, end)], "start date, end date"))


@pytest.mark.parametrize("bucket", [None, "month"])
def test_gap_fill_edges_interpolation(spark, bucket):
    d = [D(2020, 1, 30) + dt.timedelta(days=i) for i in range(6)]
    vals = [None, 10.0, None, None, 16.0, None]
    s = spark.createDataFrame(list(zip(d, vals)), "date date, dcoilwtico double")
    out = fill_calendar(s, days(spark, d[0], d[-1]), bucket=bucket).orderBy("date").collect()
    assert [r.dcoilwtico for r in out] == [10.0, 10.0, 12.0, 14.0, 16.0, 16.0]


@pytest.mark.parametrize("bucket", [None, "month"])
def test_gap_fill_long_gap_across_months(spark, bucket):
    s = spark.createDataFrame([(D(2020, 1, 1), 0.0), (D(2020, 4, 10), 100.0)], "date date, dcoilwtico double")
    out = fill_calendar(s, days(spark, D(2019, 12, 25), D(2020, 4, 20)), bucket=bucket)
    got = {r.date: r.dcoilwtico for r in out.collect()}
    span = (D(2020, 4, 10) - D(2020, 1, 1)).days
    assert got[D(2019, 12, 25)] == 0.0 and got[D(2020, 4, 20)] == 100.0
    assert got[D(2020, 2, 15)] == pytest.approx(100.0 * (D(2020, 2, 15) - D(2020, 1, 1)).days / span)
    assert len(got) == (D(2020, 4, 20) - D(2019, 12, 25)).days + 1


def test_gap_fill_all_null_fails(spark):
    s = spark.createDataFrame([(D(2020, 1, 1), None), (D(2020, 1, 2), None)], "date date, dcoilwtico double")
    filled = assert_filled(fill_calendar(s, days(spark, D(2020, 1, 1), D(2020, 1, 2))), "dcoilwtico")
    with pytest.raises(Exception, match="no known value"):
        filled.collect()


def test_gap_fill_duplicate_date_fails(spark):
    s = spark.createDataFrame([(D(2020, 1, 1), 1.0), (D(2020, 1, 1), 2.0)], "date date, dcoilwtico double")
    with pytest.raises(Exception, match="not unique"):
        fill_calendar(s, days(spark, D(2020, 1, 1), D(2020, 1, 2))).collect()


def test_gap_fill_drops_dates_outside_calendar(spark):
    s = spark.createDataFrame([(D(2020, 1, 1), 1.0), (D(2020, 1, 2), 2.0), (D(2020, 1, 3), 3.0)],
                              "date date, dcoilwtico double")
    out = fill_calendar(s, days(spark, D(2020, 1, 2), D(2020, 1, 3))).orderBy("date").collect()
    assert [(r.date, r.dcoilwtico) for r in out] == [(D(2020, 1, 2), 2.0), (D(2020, 1, 3), 3.0)]


def test_median_imputation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "x double")
    out, log = C.impute(df, "t")
    assert sorted(r.x for r in out.collect()) == [1.0, 2.0, 2.0, 4.0]
    (row,) = log.collect()
    assert (row.column, row.cantidad, row.criterio, row.valor_numerico) == ("x", 1, "mediana", 2.0)


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    out, log = C.impute(df, "t")
    assert sorted(r.s for r in out.collect()) == ["a", "a", "a", "b", "b"]
    assert log.collect()[0].valor_texto == "a"


def test_null_date_is_kept(spark):
    df = spark.createDataFrame([("2020-01-01", 1.0), (None, 2.0)], "date string, x double")
    parsed = C.parse_date(df, "date")
    out, log = C.impute(parsed, "t")
    assert sorted((r.date is None) for r in out.collect()) == [False, True]
    assert log.count() == 0


def test_bad_date_strict_and_quarantine(spark):
    df = spark.createDataFrame([("2020-01-01",), ("2020-13-01",)], "date string")
    with pytest.raises(Exception):
        C.parse_date(df, "date").collect()
    good, bad = C.parse_date_quarantine(df, "date")
    assert [r.date for r in good.collect()] == [D(2020, 1, 1)]
    assert [r.date for r in bad.collect()] == ["2020-13-01"]


def test_duplicate_rows_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "a int, b string")
    clean, metrics, _ = C.clean_table(df, "t")
    m = metrics.collect()[0]
    assert clean.count() == 1
    assert (m.filas_originales, m.filas_finales, m.duplicados_eliminados) == (2, 1, 1)
    assert (m.nulos_antes, m.nulos_despues) == (2, 1)  # an all-null column stays null


def test_holiday_rollup_one_date(spark):
    ev = spark.createDataFrame(
        [(D(2020, 1, 1), "Holiday", "National", "X", "a", True),
         (D(2020, 1, 1), "Holiday", "Local", "Y", "b", False)],
        "date date, type string, locale string, locale_name string, description string, transferred boolean")
    r = event_rollup(ev).collect()[0]
    assert r.cantidad_eventos == 2 and r.tipos_evento == "Holiday"
    assert r.locales_evento == "Local, National" and r.descripciones_evento == "a, b"
    assert r.evento_transferido is True and r.es_feriado_nacional is False and r.es_feriado_evento


def test_join_right_key_twice_fails(spark):
    left = spark.createDataFrame([(1, "x")], "store_nbr int, a string")
    right = spark.createDataFrame([(1, "c1"), (1, "c2")], "store_nbr int, city string")
    with pytest.raises(Exception, match="not unique on the right"):
        join_validated(left, right, ["store_nbr"]).collect()
    assert join_validated(left, right, ["store_nbr"], validate=None).count() == 2
    f = fanout(left, right, ["store_nbr"]).collect()[0]
    assert (f.len, f.filas_train, f.filas_adicionales) == (2, 1, 1)


def test_percent_change_zero_base(spark):
    df = spark.createDataFrame([(1, 100.0), (2, 0.0), (3, 50.0)], "m int, v double")
    out = pct_change(df, "m", {"v": "p"}).orderBy("m").collect()
    assert [r.p for r in out] == [None, -100.0, None]
    one = spark.createDataFrame([(150.0, 100.0), (1.0, 0.0)], "a double, b double")
    assert [r.c for r in one.select(pct_change_expr("a", "b").alias("c")).collect()] == [50.0, None]


@pytest.mark.parametrize("rows,expected", [
    ([(1.0, 2.0), (1.0, 3.0)], None),
    ([(1.0, 2.0)], None),
    ([(1.0, 2.0), (2.0, None), (3.0, 5.0), (4.0, 4.0)], 0.785714),
])
def test_safe_corr(spark, rows, expected):
    df = spark.createDataFrame(rows, "x double, y double")
    got = df.agg(safe_corr("x", "y").alias("c")).collect()[0].c
    assert (got is None) if expected is None else round(got, 6) == expected


def test_quadrant_single_store_is_high(spark):
    st = spark.createDataFrame([(1, 10, 100.0, 5.0, 20.0, None, 3, 10.0)],
                               "store_nbr int, total_transacciones bigint, ventas_totales double, "
                               "transacciones_promedio_diarias double, ventas_promedio_diarias double, "
                               "correlacion_transacciones_ventas double, dias_analizados bigint, "
                               "ticket_promedio double")
    assert ticket_class(st).collect()[0].clasificacion_ticket == "Ticket alto"


def test_best_lag_rules(spark):
    none = spark.createDataFrame([(0, -0.5, 5), (1, 0.0, 5)], "lag_meses int, correlacion double, meses_comparados bigint")
    assert best_lag(none).count() == 0
    tie = spark.createDataFrame([(2, 0.7, 5), (4, 0.7, 5), (1, 0.3, 5)],
                                "lag_meses int, correlacion double, meses_comparados bigint")
    assert best_lag(tie).collect()[0].lag_meses == 2


def test_neighbour_holidays_count_for_both(spark):
    d = D(2020, 3, 10)
    rows = [(d + dt.timedelta(days=i), "F", 1.0, i in (0, 2), 0) for i in range(-4, 7)]
    fact = spark.createDataFrame(rows, "date date, family string, sales double, es_feriado_nacional boolean, onpromotion bigint")
    out = {r.dias_relativo_feriado: r for r in holiday_window(fact).collect()}
    # d+1 is day +1 of d and day -1 of d+2; both holidays count it
    assert out[1].cantidad_feriados == 2 and out[-1].cantidad_feriados == 2
    assert out[2].cantidad_feriados == 2  # d+2 is day +2 of d; d+4 is day +2 of d+2


def test_family_never_promoted_left_out(spark):
    fact = spark.createDataFrame([("A", 1.0, 0), ("A", 2.0, 1), ("B", 3.0, 0)],
                                 "family string, sales double, onpromotion bigint")
    assert [r.family for r in promo_by_family(fact).collect()] == ["A"]


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ContractError, match=r"\['b', 'c'\]"):
        require_columns(df, ["c", "a", "b"])


def test_profile_empty_frame(spark):
    from shelfwise.operators.profile import profile
    df = spark.createDataFrame([], "a int, b string")
    rows = profile(df, "t").collect()
    assert [(r.column, r.rows, r.nulls, r.null_pct) for r in rows] == [("a", 0, 0, 0.0), ("b", 0, 0, 0.0)]


def test_gap_fill_many_series_both_forms_agree(spark):
    import random

    rnd = random.Random(5)
    start = D(2020, 1, 20)
    rows = []
    for key in ("a", "b", "c"):
        for i in range(70):
            if rnd.random() < 0.35:
                rows.append((key, start + dt.timedelta(days=i), None if rnd.random() < 0.3 else rnd.uniform(1, 9)))
    rows.append(("d", start, None))  # a series with no known value stays null
    s = spark.createDataFrame(rows, "k string, date date, dcoilwtico double")
    cal = calendar(spark.createDataFrame([(k, start, start + dt.timedelta(days=69)) for k in "abcd"],
                                         "k string, start date, end date"))
    plain = {(r.k, r.date): r.dcoilwtico for r in fill_calendar(s, cal, keys=("k",), bucket=None).collect()}
    bucketed = {(r.k, r.date): r.dcoilwtico for r in fill_calendar(s, cal, keys=("k",)).collect()}
    assert plain.keys() == bucketed.keys() and len(plain) == 4 * 70
    for key in plain:
        assert (plain[key] is None and bucketed[key] is None) or plain[key] == pytest.approx(bucketed[key])
    # brute force for one series
    known = sorted((d, v) for k, d, v in rows if k == "a" and v is not None)
    for i in range(70):
        d = start + dt.timedelta(days=i)
        before = [(kd, v) for kd, v in known if kd <= d]
        after = [(kd, v) for kd, v in known if kd >= d]
        if before and after:
            (d0, v0), (d1, v1) = before[-1], after[0]
            want = v0 if d0 == d1 else v0 + (v1 - v0) * (d - d0).days / (d1 - d0).days
        else:
            want = (after or before)[0 if after else -1][1]
        assert plain[("a", d)] == pytest.approx(want)
    assert all(plain[("d", start + dt.timedelta(days=i))] is None for i in range(70))
