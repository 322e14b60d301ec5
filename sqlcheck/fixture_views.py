"""DuckDB SQL for the reference-shaped views (FIXTURES.md §3), as CTE bodies.

The oracle strings must stand alone, so every query is prefixed with the views it needs.
"""

from __future__ import annotations

STORES = """
select s.s_suppkey as store_nbr, n.n_name as city, r.r_name as state,
  case when s.s_acctbal < 0 then 'E' when s.s_acctbal < 2500 then 'D' when s.s_acctbal < 5000 then 'C'
       when s.s_acctbal < 7500 then 'B' else 'A' end as type,
  s.s_nationkey as cluster
from supplier s join nation n on s.s_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey
"""

TRAIN = """
select cast(l.l_shipdate as date) as date, l.l_suppkey as store_nbr, p.p_type as family,
  fsum(l.l_extendedprice) as sales,
  cast(sum(case when l.l_discount >= 0.05 then 1 else 0 end) as bigint) as onpromotion
from lineitem l join part p on l.l_partkey = p.p_partkey group by 1, 2, 3
"""

TRANSACTIONS = """
select cast(l_shipdate as date) as date, l_suppkey as store_nbr,
  cast(count(distinct l_orderkey) as bigint) as transactions
from lineitem where extract(day from l_shipdate) <> 13 group by 1, 2
"""

OIL = """
select date, case when extract(day from date) in (2, 10) then null else price end as dcoilwtico
from (select cast(o_orderdate as date) as date,
        fsum(o_totalprice) / count(*) as price
      from orders
      where mod(datediff('day', date '1995-01-01', cast(o_orderdate as date)), 7) not in (0, 6)
      group by 1) t
"""

HOLIDAYS = """
select date, type, locale, locale_name, description, transferred from (
  select distinct cast(o_orderdate as date) as date, 'Holiday' as type, 'National' as locale,
         'ALL' as locale_name, 'Month opener' as description, extract(month from o_orderdate) = 5 as transferred
  from orders where extract(day from o_orderdate) = 1 and extract(month from o_orderdate) in (1, 5, 8, 11)
  union all
  select distinct cast(o_orderdate as date), 'Transfer', 'National', 'ALL', 'Moved opener', false
  from orders where extract(day from o_orderdate) = 4 and extract(month from o_orderdate) = 5
  union all
  select distinct cast(o_orderdate as date), 'Additional', 'National', 'ALL', 'Year end', false
  from orders where extract(day from o_orderdate) in (24, 25) and extract(month from o_orderdate) = 12
  union all
  select distinct cast(o.o_orderdate as date), 'Event', 'Regional', r.r_name, concat('Fair ', r.r_name), false
  from orders o cross join region r
  where extract(day from o.o_orderdate) = 1 and extract(month from o.o_orderdate) = 1 + r.r_regionkey
) u
"""

# Daily price on the calendar of the sales dates: linear interpolation between known
# neighbours, the nearest known value at both edges. Brute force with plain windows.
OIL_FILLED = """
select c.date,
  case
    when k.dcoilwtico is not null then k.dcoilwtico
    when p.d is not null and n.d is not null then
      p.v + (n.v - p.v) * datediff('day', p.d, c.date) / datediff('day', p.d, n.d)
    else coalesce(n.v, p.v)
  end as dcoilwtico
from (select cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date from train) c
left join oil k on k.date = c.date
left join lateral (select o.date as d, o.dcoilwtico as v from oil o
                   where o.dcoilwtico is not null and o.date < c.date order by o.date desc limit 1) p on true
left join lateral (select o.date as d, o.dcoilwtico as v from oil o
                   where o.dcoilwtico is not null and o.date > c.date order by o.date limit 1) n on true
"""

HOLIDAY_ROLLUP = """
select date,
  cast(count(*) as bigint) as cantidad_eventos,
  coalesce(string_agg(distinct type, ', ' order by type), '') as tipos_evento,
  coalesce(string_agg(distinct locale, ', ' order by locale), '') as locales_evento,
  coalesce(string_agg(distinct description, ', ' order by description), '') as descripciones_evento,
  coalesce(bool_or(transferred), false) as evento_transferido,
  coalesce(bool_or(locale = 'National' and type in ('Holiday', 'Additional', 'Bridge', 'Transfer')
                   and not transferred), false) as es_feriado_nacional,
  true as es_feriado_evento
from holidays group by date
"""

FACT = """
select t.date, t.store_nbr, t.family, t.sales, t.onpromotion,
  s.city, s.state, s.type, s.cluster,
  coalesce(x.transactions, 0) as transactions,
  o.dcoilwtico,
  coalesce(h.cantidad_eventos, 0) as cantidad_eventos,
  h.tipos_evento, h.locales_evento, h.descripciones_evento,
  coalesce(h.evento_transferido, false) as evento_transferido,
  coalesce(h.es_feriado_nacional, false) as es_feriado_nacional,
  coalesce(h.es_feriado_evento, false) as es_feriado_evento,
  x.transactions is null as transactions_missing
from train t
left join stores s on s.store_nbr = t.store_nbr
left join transactions x on x.store_nbr = t.store_nbr and x.date = t.date
left join oil_filled o on o.date = t.date
left join holiday_rollup h on h.date = t.date
"""

VIEWS = {
    "stores": STORES,
    "train": TRAIN,
    "transactions": TRANSACTIONS,
    "oil": OIL,
    "holidays": HOLIDAYS,
    "oil_filled": OIL_FILLED,
    "holiday_rollup": HOLIDAY_ROLLUP,
    "fact": FACT,
}

# What each view reads, so a query only carries the CTEs it uses.
DEPENDS = {
    "oil_filled": ("train", "oil"),
    "holiday_rollup": ("holidays",),
    "fact": ("train", "stores", "transactions", "oil_filled", "holiday_rollup"),
}


def with_views(body: str, *names: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    """``WITH`` the named views (and their dependencies, in order) ahead of ``body``."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        for d in DEPENDS.get(n, ()):
            visit(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        visit(n)
    ctes = [f"{n} as ({VIEWS[n].strip()})" for n in ordered]
    ctes += [f"{n} as ({sql.strip()})" for n, sql in extra]
    return "with " + ",\n".join(ctes) + "\n" + body.strip()
