"""DuckDB oracle SQL, one string per query of ``shelfwise.plans.catalog``.

Written independently of the Spark plans, as the most direct SQL for each result:
plain unpartitioned windows, built-in ``median``, lateral neighbour lookups. Money is
summed as it is, every selection works on full precision, and float results are rounded to
6 decimals once, outermost. Integer results are cast to the types Spark returns.
"""

from __future__ import annotations

from sqlcheck.fixture_views import with_views

INPUT_COLUMNS = {
    "train": [("date", "date"), ("store_nbr", "bigint"), ("family", "string"), ("sales", "double"),
              ("onpromotion", "bigint")],
    "stores": [("store_nbr", "bigint"), ("city", "string"), ("state", "string"), ("type", "string"),
               ("cluster", "int")],
    "transactions": [("date", "date"), ("store_nbr", "bigint"), ("transactions", "bigint")],
    "holidays_events": [("date", "date"), ("type", "string"), ("locale", "string"),
                        ("locale_name", "string"), ("description", "string"), ("transferred", "boolean")],
    "oil": [("date", "date"), ("dcoilwtico", "double")],
}
VIEW_OF = {"train": "train", "stores": "stores", "transactions": "transactions",
           "holidays_events": "holidays", "oil": "oil"}
INPUT_VIEWS = tuple(VIEW_OF.values())


def M(x: str) -> str:
    """Sum of the doubles as they are (compensated, so its last digits don't depend on the order)."""
    return f"fsum({x})"



def CORR(x: str, y: str) -> str:
    return (f"(covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0))")


def FIN(x: str) -> str:
    return f"({x} is not null and isfinite({x}))"


def place(order: str) -> str:
    return f"cast(row_number() over (order by {order}) as integer) as posicion"


def _union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


# ---- shared derived views -------------------------------------------------------------

MONTHLY = f"""
select s.fecha_mes, s.ventas_totales, p.precio_petroleo_promedio,
  cast(year(s.fecha_mes) as integer) as anio, cast(month(s.fecha_mes) as integer) as mes
from (select cast(date_trunc('month', date) as date) as fecha_mes, {M('sales')} as ventas_totales
      from fact group by 1) s
join (select cast(date_trunc('month', date) as date) as fecha_mes, avg(p) as precio_petroleo_promedio
      from (select date, max(dcoilwtico) as p from fact group by date) d
      where p is not null group by 1) p on p.fecha_mes = s.fecha_mes
"""

VARIATIONS = """
select *,
  (precio_petroleo_promedio / nullif(lag(precio_petroleo_promedio) over (order by fecha_mes), 0) - 1) * 100
    as variacion_petroleo_pct,
  (ventas_totales / nullif(lag(ventas_totales) over (order by fecha_mes), 0) - 1) * 100
    as variacion_ventas_pct
from monthly
"""

PERIOD = "fecha_mes between date '1997-01-01' and date '1998-12-01'"

LAG_SCAN = f"""
select l.lag_meses,
  case when coalesce(s.n, 0) >= 3 and {FIN('s.c')} then s.c end as correlacion,
  cast(coalesce(s.n, 0) as bigint) as meses_comparados
from (select cast(unnest(range(0, 7)) as integer) as lag_meses) l
left join (
  select l.lag_meses, {CORR('a.vp', 'b.vv')} as c, count(*) as n
  from (select row_number() over (order by fecha_mes) as rn, variacion_petroleo_pct as vp
        from variations where {PERIOD}) a
  cross join (select cast(unnest(range(0, 7)) as integer) as lag_meses) l
  join (select row_number() over (order by fecha_mes) as rn, variacion_ventas_pct as vv
        from variations where {PERIOD}) b on b.rn = a.rn + l.lag_meses
  where {FIN('a.vp')} and {FIN('b.vv')}
  group by l.lag_meses
) s on s.lag_meses = l.lag_meses
"""

DAILY_TRAFFIC = f"""
select store_nbr, date, {M('sales')} as ventas_diarias, max(transactions) as transactions
from fact group by store_nbr, date having max(transactions) > 0
"""

STORE_TRAFFIC = f"""
select store_nbr,
  cast(sum(transactions) as bigint) as total_transacciones,
  {M('ventas_diarias')} as ventas_totales,
  avg(transactions) as transacciones_promedio_diarias,
  {M('ventas_diarias')} / count(ventas_diarias) as ventas_promedio_diarias,
  {CORR('transactions', 'ventas_diarias')} as correlacion_transacciones_ventas,
  cast(count(*) as bigint) as dias_analizados,
  case when sum(transactions) > 0 then {M('ventas_diarias')} / sum(transactions) end as ticket_promedio
from daily_traffic group by store_nbr
"""

TICKET_CLASS = """
select *,
  case when ventas_promedio_diarias >= (select median(ventas_promedio_diarias) from store_traffic)
        and transacciones_promedio_diarias <= (select median(transacciones_promedio_diarias) from store_traffic)
       then 'Ticket alto'
       when ventas_promedio_diarias <= (select median(ventas_promedio_diarias) from store_traffic)
        and transacciones_promedio_diarias >= (select median(transacciones_promedio_diarias) from store_traffic)
       then 'Ticket bajo'
       else 'Intermedio' end as clasificacion_ticket
from store_traffic
"""

STORE_COLS = f"""store_nbr, total_transacciones, ventas_totales,
  transacciones_promedio_diarias as transacciones_promedio_diarias,
  ventas_promedio_diarias as ventas_promedio_diarias,
  correlacion_transacciones_ventas as correlacion_transacciones_ventas,
  dias_analizados, ticket_promedio as ticket_promedio"""

FAMILY_SENS = f"""
select family,
  h as venta_promedio_diaria_feriado, n as venta_promedio_diaria_normal,
  dias_feriado, dias_normales, chg as cambio_porcentual, abs(chg) as sensibilidad_absoluta
from (
  select *, (h - n) / nullif(n, 0) * 100 as chg from (
    select family,
      {M('case when f then v end')} / nullif(count(case when f then 1 end), 0) as h,
      {M('case when not f then v end')} / nullif(count(case when not f then 1 end), 0) as n,
      cast(count(distinct case when f then date end) as bigint) as dias_feriado,
      cast(count(distinct case when not f then date end) as bigint) as dias_normales
    from (select date, family, es_feriado_nacional as f, {M('sales')} as v from fact group by 1, 2, 3) d
    group by family) x
) y where {FIN('chg')}
"""

PROMO_FAMILY = f"""
select family, con as venta_promedio_con_promocion, sin as venta_promedio_sin_promocion,
  registros_con_promocion, registros_sin_promocion, con - sin as diferencia_promedio,
  inc as incremento_porcentual, abs(inc) as efecto_absoluto
from (
  select *, (con - sin) / nullif(sin, 0) * 100 as inc from (
    select family,
      {M('case when p then sales end')} / nullif(count(case when p then sales end), 0) as con,
      {M('case when not p then sales end')} / nullif(count(case when not p then sales end), 0) as sin,
      cast(count(case when p then sales end) as bigint) as registros_con_promocion,
      cast(count(case when not p then sales end) as bigint) as registros_sin_promocion
    from (select *, coalesce(onpromotion, 0) > 0 as p from fact) f group by family) x
) y where {FIN('inc')}
"""

DERIVED = {
    "monthly": MONTHLY,
    "variations": VARIATIONS,
    "lag_scan": LAG_SCAN,
    "daily_traffic": DAILY_TRAFFIC,
    "store_traffic": STORE_TRAFFIC,
    "ticket_classes": TICKET_CLASS,
    "family_sens": FAMILY_SENS,
    "promo_family": PROMO_FAMILY,
}
DERIVED_DEPS = {
    "variations": ("monthly",),
    "lag_scan": ("variations",),
    "store_traffic": ("daily_traffic",),
    "ticket_classes": ("store_traffic",),
}


def on_fact(body: str, *derived: str) -> str:
    """``body`` over the consolidated fact plus the named derived views."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DERIVED_DEPS.get(n, ()):
            visit(d)
        if n not in order:
            order.append(n)

    for d in derived:
        visit(d)
    return with_views(body, "fact", extra=tuple((n, DERIVED[n]) for n in order))


# ---- sources, profile, cleaning -------------------------------------------------------

def _load_summary() -> str:
    parts = [f"select '{ds}' as dataset, cast(count(*) as bigint) as filas, {len(cols)} as columnas "
             f"from {VIEW_OF[ds]}" for ds, cols in INPUT_COLUMNS.items()]
    return with_views(_union(parts), *INPUT_VIEWS)


def _profile_nulls() -> str:
    parts = []
    for ds, cols in INPUT_COLUMNS.items():
        for c, t in cols:
            parts.append(
                f"select '{ds}' as dataset, '{c}' as \"column\", '{t}' as data_type, "
                f"cast(count(*) as bigint) as rows, cast(count(*) - count({c}) as bigint) as nulls, "
                f"case when count(*) > 0 then round(cast(count(*) - count({c}) as double) * 100 "
                f"/ cast(count(*) as double), 4) else 0.0 end as null_pct from {VIEW_OF[ds]}"
            )
    return with_views(_union(parts), *INPUT_VIEWS)


def _profile_duplicates() -> str:
    parts = [
        f"select '{ds}' as dataset, cast((select count(*) from {VIEW_OF[ds]}) as bigint) as rows, "
        f"cast((select count(*) from (select distinct * from {VIEW_OF[ds]}) d) as bigint) as distinct_rows, "
        f"cast((select count(*) from {VIEW_OF[ds]}) - (select count(*) from (select distinct * from "
        f"{VIEW_OF[ds]}) d) as bigint) as duplicates"
        for ds in INPUT_COLUMNS
    ]
    return with_views(_union(parts), *INPUT_VIEWS)


def _profile_range() -> str:
    parts = [f"select '{ds}' as dataset, min(date) as min_value, max(date) as max_value from {VIEW_OF[ds]}"
             for ds, cols in INPUT_COLUMNS.items() if "date" in dict(cols)]
    return with_views(_union(parts), *INPUT_VIEWS)


def _impute_mode() -> str:
    parts = []
    for ds, cols in INPUT_COLUMNS.items():
        for c, t in cols:
            if t in ("string", "boolean"):
                parts.append(
                    f"select * from (select '{ds}' as dataset, '{c}' as \"column\", "
                    f"cast({c} as varchar) as mode_value, cast(count(*) as bigint) as mode_count "
                    f"from {VIEW_OF[ds]} where {c} is not null group by {c} "
                    f"order by mode_count desc, mode_value asc limit 1)"
                )
    return with_views(_union(parts), *INPUT_VIEWS)


def _impute_log() -> str:
    parts = []
    for ds, cols in INPUT_COLUMNS.items():
        v = VIEW_OF[ds]
        for c, t in cols:
            if t in ("bigint", "int", "double"):
                parts.append(
                    f"select '{ds}' as dataset, '{c}' as \"column\", cast(count(*) - count({c}) as bigint) "
                    f"as cantidad, 'mediana' as criterio, median({c}) as valor_numerico, "
                    f"cast(null as varchar) as valor_texto from {v} "
                    f"having count(*) - count({c}) > 0 and count({c}) > 0"
                )
            elif t in ("string", "boolean"):
                parts.append(
                    f"select '{ds}' as dataset, '{c}' as \"column\", "
                    f"cast((select count(*) - count({c}) from {v}) as bigint) as cantidad, 'moda' as criterio, "
                    f"cast(null as double) as valor_numerico, m.mode_value as valor_texto from "
                    f"(select cast({c} as varchar) as mode_value, count(*) as n from {v} where {c} is not null "
                    f"group by 1 order by n desc, mode_value asc limit 1) m "
                    f"where (select count(*) - count({c}) from {v}) > 0"
                )
    return with_views(_union(parts), *INPUT_VIEWS)


def _cleaning_metrics() -> str:
    parts = []
    for ds in ("train", "stores", "transactions", "holidays_events"):
        v, cols = VIEW_OF[ds], INPUT_COLUMNS[ds]
        nulls = " + ".join(f"(count(*) - count({c}))" for c, _ in cols)
        dates = [c for c, t in cols if t == "date"]
        after = " + ".join(f"(count(*) - count({c}))" for c in dates) or "count(*) * 0"
        parts.append(
            f"select '{ds}' as dataset, cast(count(*) as bigint) as filas_originales, "
            f"cast((select count(*) from (select distinct * from {v}) d) as bigint) as filas_finales, "
            f"cast(count(*) - (select count(*) from (select distinct * from {v}) d) as bigint) "
            f"as duplicados_eliminados, cast({nulls} as bigint) as nulos_antes, "
            f"cast((select {after} from (select distinct * from {v}) d) as bigint) as nulos_despues from {v}"
        )
    return with_views(_union(parts), *INPUT_VIEWS)


GAP_FILL = with_views("select date, dcoilwtico as dcoilwtico from oil_filled", "oil_filled")

GAP_FILL_METRICS = with_views("""
select cast(count(*) as bigint) as filas_originales,
  cast((select count(*) from oil_filled) as bigint) as filas_finales,
  cast((select count(*) from oil_filled) - (count(*) - (count(*) - (select count(*) from (select distinct date,
       dcoilwtico from oil) d))) as bigint) as fechas_diarias_agregadas,
  cast((select count(*) from oil_filled f where not exists (select 1 from oil o where o.date = f.date))
       as bigint) as fechas_nuevas,
  cast(count(*) - (select count(*) from (select distinct date, dcoilwtico from oil) d) as bigint)
       as duplicados_eliminados,
  cast(count(*) - count(dcoilwtico) as bigint) as nulos_antes,
  cast((select count(*) - count(dcoilwtico) from oil_filled) as bigint) as nulos_despues
from oil
""", "oil_filled")


# ---- consolidation -------------------------------------------------------------------

CONSOLIDATION_METRICS = with_views("""
select cast((select count(*) from train) as bigint) as filas_train,
  cast(count(*) as bigint) as filas_consolidado,
  19 as columnas_consolidado,
  cast((select count(*) from holiday_rollup) as bigint) as fechas_eventos_unicas,
  cast(count(*) filter (where transactions = 0) as bigint) as filas_sin_transacciones,
  cast(count(*) filter (where transactions_missing) as bigint) as filas_transacciones_ausentes,
  cast(count(*) filter (where dcoilwtico is null) as bigint) as filas_sin_precio_petroleo,
  cast(count(*) filter (where city is null) as bigint) as filas_sin_ciudad
from fact
""", "fact")


def _dup(view: str, keys: str) -> str:
    return f"(select count(*) from (select {keys} from {view} group by {keys} having count(*) > 1) d)"


JOIN_KEY_VIOLATIONS = with_views(_union([
    f"select 'stores' as tabla, 'store_nbr' as clave, cast({_dup('stores', 'store_nbr')} as bigint) "
    f"as claves_duplicadas",
    f"select 'transactions', 'store_nbr, date', cast({_dup('transactions', 'store_nbr, date')} as bigint)",
    f"select 'oil', 'date', cast({_dup('oil_filled', 'date')} as bigint)",
    f"select 'holidays', 'date', cast({_dup('holiday_rollup', 'date')} as bigint)",
]), "stores", "transactions", "oil_filled", "holiday_rollup")

JOIN_FANOUT = with_views("""
select d.date, cast(d.len as bigint) as len, cast(t.filas_train as bigint) as filas_train,
  cast(t.filas_train * (d.len - 1) as bigint) as filas_adicionales
from (select date, count(*) as len from holidays group by date having count(*) > 1) d
left join (select date, count(*) as filas_train from train group by date) t on t.date = d.date
""", "holidays", "train")

DUPLICATE_KEYS = with_views(
    "select date, cast(count(*) as bigint) as len from holidays group by date having count(*) > 1",
    "holidays")


def _dq_checks() -> str:
    def cnt(name: str, sql: str) -> str:
        return f"select '{name}' as \"check\", cast((select count(*) from ({sql}) x) as bigint) as violations"

    checks = [
        cnt("stores_key_unique", "select store_nbr from stores group by 1 having count(*) > 1"),
        cnt("transactions_key_unique",
            "select store_nbr, date from transactions group by 1, 2 having count(*) > 1"),
        cnt("oil_key_unique", "select date from oil_filled group by 1 having count(*) > 1"),
        cnt("holidays_key_unique", "select date from holiday_rollup group by 1 having count(*) > 1"),
        cnt("oil_series_key_unique",
            "select date from (select distinct date, dcoilwtico from oil) o group by 1 having count(*) > 1"),
        cnt("fact_rows_without_store", "select 1 from fact where city is null"),
        cnt("fact_rows_without_price", "select 1 from fact where dcoilwtico is null"),
        cnt("gap_fill_nulls", "select 1 from oil_filled where dcoilwtico is null"),
        cnt("no_national_holiday",
            "select 1 from (select count(*) as n from fact where es_feriado_nacional) c where n = 0"),
        cnt("fewer_than_3_months", "select 1 from (select count(*) as n from monthly) c where n < 3"),
        cnt("fewer_than_4_period_months",
            f"select 1 from (select count(*) as n from monthly where {PERIOD}) c where n < 4"),
        cnt("transactions_not_functional",
            "select 1 from fact group by store_nbr, date having count(distinct transactions) "
            "+ max(case when transactions is null then 1 else 0 end) > 1"),
        cnt("no_traffic_days", "select 1 from (select count(*) as n from daily_traffic) c where n = 0"),
        "select 'rows_lost_or_added', cast(abs((select count(*) from fact) - (select count(*) from train)) as bigint)",
    ]
    return on_fact(_union(checks), "monthly", "daily_traffic")


# ---- analyses ------------------------------------------------------------------------

def _total_by(key_expr: str, key: str, mean: bool = True) -> str:
    m = f", ({M('sales')} / count(sales)) as venta_promedio" if mean else ""
    return f"select {key_expr} as {key}, {M('sales')} as ventas_totales{m} from fact group by 1"


SALES_BY_FAMILY = f"""
select family, {M('sales')} as ventas_totales, ({M('sales')} / count(sales)) as venta_promedio,
  cast(count(*) as bigint) as numero_registros,
  ({M('sales')} * 100 / sum({M('sales')}) over ()) as participacion_porcentual
from fact group by family
"""

SALES_BY_STORE = f"""
select store_nbr, ventas_totales, venta_promedio,
  cast(row_number() over (order by ventas_totales desc, store_nbr asc) as integer) as ranking_mayor_venta,
  cast(count(*) over () + 1 - row_number() over (order by ventas_totales desc, store_nbr asc) as integer)
    as ranking_menor_venta
from ({_total_by('store_nbr', 'store_nbr')}) t
"""

SALES_BY_MONTH = f"""
select fecha_mes, ventas_totales, cast(year(fecha_mes) as integer) as anio,
  cast(month(fecha_mes) as integer) as mes
from ({_total_by("cast(date_trunc('month', date) as date)", 'fecha_mes', mean=False)}) t
"""

HOLIDAY_VS_NORMAL = f"""
select es_feriado_nacional, {M('v')} as ventas_totales, ({M('v')} / count(*)) as venta_promedio_diaria,
  median(v) as venta_mediana_diaria, cast(count(*) as bigint) as cantidad_dias
from (select date, es_feriado_nacional, {M('sales')} as v from fact group by 1, 2) d
group by es_feriado_nacional
"""

HOLIDAY_CHANGE = f"""
select h as promedio_feriado, n as promedio_normal, (h - n) / nullif(n, 0) * 100
  as cambio_porcentual
from (select {M('case when f then v end')} / nullif(count(case when f then 1 end), 0) as h,
             {M('case when not f then v end')} / nullif(count(case when not f then 1 end), 0) as n
      from (select date, es_feriado_nacional as f, {M('sales')} as v from fact group by 1, 2) d) x
"""

HOLIDAY_WINDOW = f"""
select family, dias_relativo_feriado, {M('v')} as ventas_totales,
  ({M('v')} / count(*)) as venta_promedio_por_feriado, median(v) as venta_mediana_por_feriado,
  cast(count(distinct fecha_feriado) as bigint) as cantidad_feriados
from (
  select w.fecha_feriado, f.family, w.k as dias_relativo_feriado, {M('f.sales')} as v
  from (select h.date as fecha_feriado, k.k from (select distinct date from fact where es_feriado_nacional) h
        cross join (select unnest([-3, -2, -1, 1, 2, 3]) as k) k) w
  join fact f on f.date = w.fecha_feriado + w.k
  group by 1, 2, 3
) e group by family, dias_relativo_feriado
"""

PROMO_GENERAL = f"""
select coalesce(onpromotion, 0) > 0 as en_promocion, {M('sales')} as ventas_totales,
  ({M('sales')} / count(sales)) as venta_promedio, median(sales) as venta_mediana,
  cast(count(*) as bigint) as cantidad_registros
from fact group by 1
"""

CITY_SENS = f"""
with best as (
  select coalesce((select lag_meses from lag_raw where c > 0 order by c desc, lag_meses limit 1), 0) as lag
),
cv as (
  select city, fecha_mes,
    (v / nullif(lag(v) over (partition by city order by fecha_mes), 0) - 1) * 100 as vc
  from (select city, cast(date_trunc('month', date) as date) as fecha_mes, {M('sales')} as v
        from fact group by 1, 2) m
),
j as (
  select cv.city, cv.fecha_mes, cv.vc, o.variacion_petroleo_pct as vp,
    row_number() over (partition by cv.city order by cv.fecha_mes) as rn
  from cv join variations o on o.fecha_mes = cv.fecha_mes
  where cv.{PERIOD}
),
s as (
  select a.city, a.vp as x, b.vc as y from j a
  left join j b on b.city = a.city and b.rn = a.rn + (select lag from best)
)
select city, c as correlacion_petroleo_ventas, n as meses_comparados, abs(c) as sensibilidad_absoluta,
  cast((select lag from best) as integer) as lag_meses_utilizado
from (select city, {CORR('x', 'y')} as c, cast(count(*) as bigint) as n from s
      where {FIN('x')} and {FIN('y')} group by city) r
where {FIN('c')}
"""

LAG_RAW = f"""
select l.lag_meses, s.c from (select cast(unnest(range(0, 7)) as integer) as lag_meses) l
left join (
  select l.lag_meses, {CORR('a.vp', 'b.vv')} as c, count(*) as n
  from (select row_number() over (order by fecha_mes) as rn, variacion_petroleo_pct as vp
        from variations where {PERIOD}) a
  cross join (select cast(unnest(range(0, 7)) as integer) as lag_meses) l
  join (select row_number() over (order by fecha_mes) as rn, variacion_ventas_pct as vv
        from variations where {PERIOD}) b on b.rn = a.rn + l.lag_meses
  where {FIN('a.vp')} and {FIN('b.vv')}
  group by l.lag_meses
) s on s.lag_meses = l.lag_meses where coalesce(s.n, 0) >= 3 and {FIN('s.c')}
"""
DERIVED["lag_raw"] = LAG_RAW
DERIVED_DEPS["lag_raw"] = ("variations",)

ORACLE: dict[str, str] = {
    "load_summary": _load_summary(),
    "profile_nulls": _profile_nulls(),
    "profile_duplicates": _profile_duplicates(),
    "profile_range": _profile_range(),
    "parse_date": with_views("select date, store_nbr, transactions from transactions", "transactions"),
    "dedup_rows": with_views("select distinct * from transactions", "transactions"),
    "impute_median": with_views(
        "select date, (coalesce(dcoilwtico, (select median(dcoilwtico) from oil))) as dcoilwtico from oil",
        "oil"),
    "impute_mode": _impute_mode(),
    "impute_log": _impute_log(),
    "cleaning_metrics": _cleaning_metrics(),
    "gap_fill": GAP_FILL,
    "gap_fill_bucketed": GAP_FILL,
    "gap_fill_metrics": GAP_FILL_METRICS,
    "holiday_rollup": with_views("select * from holiday_rollup", "holiday_rollup"),
    "consolidate": with_views("select * from fact", "fact"),
    "consolidation_metrics": CONSOLIDATION_METRICS,
    "join_key_violations": JOIN_KEY_VIOLATIONS,
    "join_fanout": JOIN_FANOUT,
    "duplicate_keys": DUPLICATE_KEYS,
    "dq_checks": _dq_checks(),
    "sales_by_family": on_fact(SALES_BY_FAMILY),
    "sales_by_store": on_fact(SALES_BY_STORE),
    "sales_by_city": on_fact(_total_by("city", "city")),
    "sales_by_state": on_fact(_total_by("state", "state")),
    "sales_by_year": on_fact(_total_by("cast(year(date) as integer)", "anio")),
    "sales_by_month": on_fact(SALES_BY_MONTH),
    "top_stores": on_fact(f"select * from ({_total_by('store_nbr', 'store_nbr')}) t "
                          "order by ventas_totales desc, store_nbr asc limit 10"),
    "bottom_stores": on_fact(f"select * from ({_total_by('store_nbr', 'store_nbr')}) t "
                             "order by ventas_totales asc, store_nbr asc limit 10"),
    "top_cities_by_mean": on_fact(f"select * from ({_total_by('city', 'city')}) t "
                                  "order by venta_promedio desc, city asc limit 5"),
    "top_families": on_fact(f"select * from ({SALES_BY_FAMILY}) t order by ventas_totales desc, family asc limit 10"),
    "holiday_dates": on_fact("select distinct date from fact where es_feriado_nacional"),
    "holiday_vs_normal": on_fact(HOLIDAY_VS_NORMAL),
    "holiday_change": on_fact(HOLIDAY_CHANGE),
    "holiday_window": on_fact(HOLIDAY_WINDOW),
    "holiday_sensitivity": on_fact("select * from family_sens", "family_sens"),
    "holiday_positive": on_fact(f"select *, {place('cambio_porcentual desc, family')} from family_sens where cambio_porcentual > 0", "family_sens"),
    "holiday_negative": on_fact(f"select *, {place('cambio_porcentual, family')} from family_sens where cambio_porcentual < 0", "family_sens"),
    "promo_general": on_fact(PROMO_GENERAL),
    "promo_by_family": on_fact("select * from promo_family", "promo_family"),
    "promo_top": on_fact("select * from promo_family order by incremento_porcentual desc, family asc limit 10",
                         "promo_family"),
    "promo_negative": on_fact(f"select *, {place('incremento_porcentual, family')} from promo_family where incremento_porcentual < 0", "promo_family"),
    "promo_smallest": on_fact("select * from promo_family where incremento_porcentual >= 0 "
                              "order by incremento_porcentual asc, family asc limit 10", "promo_family"),
    "oil_monthly": on_fact("select fecha_mes, ventas_totales, precio_petroleo_promedio as "
                           "precio_petroleo_promedio, anio, mes from monthly", "monthly"),
    "oil_correlation": on_fact(
        f"select case when {FIN('c')} then c end as correlacion, meses from "
        f"(select {CORR('precio_petroleo_promedio', 'ventas_totales')} as c, cast(count(*) as bigint) as meses "
        f"from monthly) x", "monthly"),
    "oil_variation_period": on_fact(
        "select fecha_mes, ventas_totales, precio_petroleo_promedio as precio_petroleo_promedio, anio, mes, "
        "variacion_petroleo_pct as variacion_petroleo_pct, variacion_ventas_pct as "
        f"variacion_ventas_pct from variations where {PERIOD}", "variations"),
    "oil_lag_scan": on_fact("select lag_meses, correlacion as correlacion, meses_comparados "
                            "from lag_scan", "lag_scan"),
    "oil_best_lag": on_fact("select * from (select lag_meses, correlacion as correlacion, "
                            "meses_comparados from lag_scan) s where correlacion > 0 "
                            "order by correlacion desc, lag_meses asc limit 1", "lag_scan"),
    "oil_city_sensitivity": on_fact(CITY_SENS.replace("with best as", "select * from (with best as", 1) + ") q",
                                    "lag_raw"),
    "fd_violations": on_fact(
        "select store_nbr, date, cast(count(distinct transactions) + max(case when transactions is null then 1 "
        "else 0 end) as bigint) as valores from fact group by 1, 2 having valores > 1"),
    "traffic_daily": on_fact("select * from daily_traffic", "daily_traffic"),
    "traffic_correlation": on_fact(
        f"select case when {FIN('c')} then c end as correlacion from "
        f"(select {CORR('transactions', 'ventas_diarias')} as c from daily_traffic) x", "daily_traffic"),
    "ticket_by_store": on_fact(f"select {STORE_COLS} from store_traffic", "store_traffic"),
    "ticket_class": on_fact(f"select {STORE_COLS}, clasificacion_ticket from ticket_classes", "ticket_classes"),
    "ticket_high": on_fact(f"select {STORE_COLS}, clasificacion_ticket, {place('ticket_promedio desc, store_nbr')} from ticket_classes "
                           "where clasificacion_ticket = 'Ticket alto'", "ticket_classes"),
    "ticket_low": on_fact(f"select {STORE_COLS}, clasificacion_ticket, {place('ticket_promedio, store_nbr')} from ticket_classes "
                          "where clasificacion_ticket = 'Ticket bajo'", "ticket_classes"),
    "traffic_top_stores": on_fact(f"select {STORE_COLS}, {place('correlacion_transacciones_ventas desc, store_nbr')} from store_traffic "
                                  f"where {FIN('correlacion_transacciones_ventas')}", "store_traffic"),
}


# ---- previews, samples, reports ------------------------------------------------------

DERIVED["city_sens"] = "select * from (" + CITY_SENS + ") q"
DERIVED_DEPS["city_sens"] = ("lag_raw",)

PREVIEW = """
select * replace (dcoilwtico as dcoilwtico), 'head' as posicion
from (select * from fact order by date, store_nbr, family limit 10) h
union all
select * replace (dcoilwtico as dcoilwtico), 'tail' as posicion
from (select * from fact order by date desc, store_nbr desc, family desc limit 10) t
"""

HEADLINE = f"""
select
  (select family from (select family, {M('sales')} as v from fact group by 1) x
   order by v desc, family limit 1) as familia_mayor_venta,
  (select store_nbr from (select store_nbr, {M('sales')} as v from fact group by 1) x
   order by v desc, store_nbr limit 1) as tienda_mayor_venta,
  (select store_nbr from (select store_nbr, {M('sales')} as v from fact group by 1) x
   order by v asc, store_nbr limit 1) as tienda_menor_venta,
  cast((select count(distinct date) from fact where es_feriado_nacional) as bigint) as cantidad_feriados_nacionales,
  (select family from family_sens order by sensibilidad_absoluta desc, family limit 1) as familia_mayor_sensibilidad,
  cast((select count(*) from family_sens where cambio_porcentual > 0) as bigint) as familias_impacto_positivo,
  cast((select count(*) from family_sens where cambio_porcentual < 0) as bigint) as familias_impacto_negativo,
  (select family from promo_family order by incremento_porcentual desc, family limit 1) as familia_mayor_incremento,
  (select lag_meses from (select lag_meses, correlacion as c from lag_scan) s where c > 0
   order by c desc, lag_meses limit 1) as mejor_lag_meses,
  (select city from city_sens order by sensibilidad_absoluta desc, city limit 1) as ciudad_mayor_sensibilidad,
  (select store_nbr from (select store_nbr, correlacion_transacciones_ventas as c from store_traffic
     where {FIN('correlacion_transacciones_ventas')}) s order by c desc, store_nbr limit 1) as tienda_mayor_correlacion,
  cast((select count(*) from ticket_classes where clasificacion_ticket = 'Ticket alto') as bigint)
    as cantidad_tiendas_ticket_alto,
  cast((select count(*) from ticket_classes where clasificacion_ticket = 'Ticket bajo') as bigint)
    as cantidad_tiendas_ticket_bajo
"""

# Exported tables and the query that computes each (reference names, export order).
EXPORTED = [
    ("consolidado", "consolidate", 19), ("ventas_por_familia", "sales_by_family", 5),
    ("ventas_por_tienda", "sales_by_store", 5), ("ventas_por_ciudad", "sales_by_city", 3),
    ("ventas_por_provincia", "sales_by_state", 3), ("ventas_por_anio", "sales_by_year", 3),
    ("ventas_por_mes", "sales_by_month", 4), ("feriados_vs_dias_normales", "holiday_vs_normal", 5),
    ("feriados_ventana_tres_dias", "holiday_window", 6),
    ("feriados_sensibilidad_familias", "holiday_sensitivity", 7),
    ("promociones_general", "promo_general", 5), ("promociones_por_familia", "promo_by_family", 8),
    ("petroleo_ventas_mensuales", "oil_monthly", 5), ("petroleo_variaciones_2015_2016", "oil_variation_period", 7),
    ("petroleo_lags", "oil_lag_scan", 3), ("petroleo_sensibilidad_ciudades", "oil_city_sensitivity", 5),
    ("transacciones_ventas_diarias", "traffic_daily", 4), ("transacciones_por_tienda", "ticket_by_store", 8),
    ("transacciones_clasificacion_ticket", "ticket_class", 9),
]

ORACLE.update({
    "oil_top_cities": on_fact("select * from city_sens order by sensibilidad_absoluta desc, city limit 10", "city_sens"),
    "holiday_top_families": on_fact("select * from family_sens order by sensibilidad_absoluta desc, family limit 10", "family_sens"),
    "holiday_first_windows": on_fact(f"select * from ({HOLIDAY_WINDOW}) w order by family, dias_relativo_feriado limit 10"),
    "preview": with_views(PREVIEW, "fact"),
    "distinct_values": on_fact("select distinct city from fact where city is not null order by city limit 10"),
    "headline": on_fact(HEADLINE, "family_sens", "promo_family", "lag_scan", "city_sens", "store_traffic",
                        "ticket_classes"),
    "export_manifest": _union([
        f"select '{table}' as tabla, cast(count(*) as bigint) as filas, {ncols} as columnas "
        f"from ({ORACLE[query]}) t"
        for table, query, ncols in EXPORTED
    ]),
})

# Float columns of each result, rounded for the comparison.
FLOATS = {
    "profile_nulls": "null_pct",
    "impute_median": "dcoilwtico",
    "impute_log": "valor_numerico",
    "gap_fill": "dcoilwtico",
    "gap_fill_bucketed": "dcoilwtico",
    "consolidate": "sales dcoilwtico",
    "sales_by_family": "ventas_totales venta_promedio participacion_porcentual",
    "sales_by_store": "ventas_totales venta_promedio",
    "sales_by_city": "ventas_totales venta_promedio",
    "sales_by_state": "ventas_totales venta_promedio",
    "sales_by_year": "ventas_totales venta_promedio",
    "sales_by_month": "ventas_totales",
    "top_stores": "ventas_totales venta_promedio",
    "bottom_stores": "ventas_totales venta_promedio",
    "top_cities_by_mean": "ventas_totales venta_promedio",
    "top_families": "ventas_totales venta_promedio participacion_porcentual",
    "holiday_vs_normal": "ventas_totales venta_promedio_diaria venta_mediana_diaria",
    "holiday_change": "promedio_feriado promedio_normal cambio_porcentual",
    "holiday_window": "ventas_totales venta_promedio_por_feriado venta_mediana_por_feriado",
    "holiday_sensitivity": "venta_promedio_diaria_feriado venta_promedio_diaria_normal cambio_porcentual sensibilidad_absoluta",
    "holiday_positive": "venta_promedio_diaria_feriado venta_promedio_diaria_normal cambio_porcentual sensibilidad_absoluta",
    "holiday_negative": "venta_promedio_diaria_feriado venta_promedio_diaria_normal cambio_porcentual sensibilidad_absoluta",
    "promo_general": "ventas_totales venta_promedio venta_mediana",
    "promo_by_family": "venta_promedio_con_promocion venta_promedio_sin_promocion diferencia_promedio incremento_porcentual efecto_absoluto",
    "promo_top": "venta_promedio_con_promocion venta_promedio_sin_promocion diferencia_promedio incremento_porcentual efecto_absoluto",
    "promo_negative": "venta_promedio_con_promocion venta_promedio_sin_promocion diferencia_promedio incremento_porcentual efecto_absoluto",
    "promo_smallest": "venta_promedio_con_promocion venta_promedio_sin_promocion diferencia_promedio incremento_porcentual efecto_absoluto",
    "oil_monthly": "ventas_totales precio_petroleo_promedio",
    "oil_correlation": "correlacion",
    "oil_variation_period": "ventas_totales precio_petroleo_promedio variacion_petroleo_pct variacion_ventas_pct",
    "oil_lag_scan": "correlacion",
    "oil_best_lag": "correlacion",
    "oil_city_sensitivity": "correlacion_petroleo_ventas sensibilidad_absoluta",
    "traffic_daily": "ventas_diarias",
    "traffic_correlation": "correlacion",
    "ticket_by_store": "ventas_totales transacciones_promedio_diarias ventas_promedio_diarias correlacion_transacciones_ventas ticket_promedio",
    "ticket_class": "ventas_totales transacciones_promedio_diarias ventas_promedio_diarias correlacion_transacciones_ventas ticket_promedio",
    "ticket_high": "ventas_totales transacciones_promedio_diarias ventas_promedio_diarias correlacion_transacciones_ventas ticket_promedio",
    "ticket_low": "ventas_totales transacciones_promedio_diarias ventas_promedio_diarias correlacion_transacciones_ventas ticket_promedio",
    "traffic_top_stores": "ventas_totales transacciones_promedio_diarias ventas_promedio_diarias correlacion_transacciones_ventas ticket_promedio",
    "preview": "sales dcoilwtico",
    "oil_top_cities": "correlacion_petroleo_ventas sensibilidad_absoluta",
    "holiday_top_families": "venta_promedio_diaria_feriado venta_promedio_diaria_normal cambio_porcentual sensibilidad_absoluta",
    "holiday_first_windows": "ventas_totales venta_promedio_por_feriado venta_mediana_por_feriado",
}


def reported(sql: str, floats: str) -> str:
    return f"select * replace ({', '.join(f'round({c}, 6) as {c}' for c in floats.split())}) from (\n{sql}\n) as result"


ORACLE.update({name: reported(ORACLE[name], floats) for name, floats in FLOATS.items()})
