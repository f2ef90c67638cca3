"""Shared common table expressions of the SQL twins."""

from __future__ import annotations

TRAIN_BEFORE = "2000-04-01"  # visits before this day are the training side
LEFT_OUT = "Brand#7"  # the category left out on the training side

# Basket lines, all columns; u = units bought, f = fineline with its sentinel.
BASKETS = """
b as (
  select l_orderkey as visit_number, l_linenumber as line_number, l_partkey as upc,
    cast((case when l_returnflag = 'R' then -1 else 1 end) * cast(ceil(l_quantity / 10) as int) as int) as scan_count,
    o_orderpriority as trip_type, strftime(o_orderdate, '%A') as weekday, cast(o_orderdate as date) as visit_day,
    nullif(p_brand, 'Brand#13') as department, nullif(p_size, 13) as fineline
  from lineitem left join orders on o_orderkey = l_orderkey left join part on p_partkey = l_partkey
),
c as (select *, greatest(scan_count, 0) as u, coalesce(fineline, 9999) as f from b)"""

# Training lines and what is fitted on them.
FITTED = f"""{BASKETS},
tr as (
  select * from c where visit_day < date '{TRAIN_BEFORE}' and department is distinct from '{LEFT_OUT}'
),
dd as (
  select department, cast(row_number() over (order by department nulls last) - 1 as int) as code
  from (select distinct department from tr)
),
ft as (select f, sum(u) as t from tr group by f),
fv as (
  select f, t, cast(row_number() over (order by f) - 1 as int) as idx
  from ft where t > (select quantile_cont(t, 0.3) from ft)
),
dt as (select code, count(*) as t from tr join dd on tr.department is not distinct from dd.department group by code),
dv as (
  select code, t, cast(row_number() over (order by code) - 1 as int) as idx
  from dt where t > (select quantile_cont(t, 0.6) from dt)
),
wd as (
  select weekday, cast(row_number() over (order by weekday) - 1 as int) as code from (select distinct weekday from tr)
),
x as (
  select c.*, coalesce(dd.code, -1) as code from c left join dd on c.department is not distinct from dd.department
)"""


def with_baskets(body: str) -> str:
    return f"with {BASKETS}\n{body}"


def with_fitted(body: str) -> str:
    return f"with {FITTED}{body}"
