"""Queries on basket lines: cleaning, encoding, visit features, category families."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.scalar import fineline_or_sentinel, units, upc_or_sentinel
from tillroll.operators import categories, visits
from tillroll.operators.encode import Dictionary, Vocabulary, fit_dictionary, fit_vocabulary
from tillroll.plans.registry import SQL, query
from tillroll.plans.sql import LEFT_OUT, TRAIN_BEFORE, with_baskets, with_fitted
from tillroll.session import tasks_for
from tillroll.sources.star import basket_lines, category_is_not, line_count, visit_attributes

N_DEPARTMENTS = 24  # codes met in training: 23 named departments and the missing one
N_FINELINES = 35
N_FREQUENT = 10


def training_lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    lines = basket_lines(spark, sf_dir, *dict.fromkeys(("visit_day", "department", *columns)))
    return lines.filter((F.col("visit_day") < F.lit(TRAIN_BEFORE)) & category_is_not("department", LEFT_OUT))


def departments(spark: SparkSession, sf_dir: str) -> Dictionary:
    return fit_dictionary(training_lines(spark, sf_dir), "department")


def finelines(spark: SparkSession, sf_dir: str) -> Vocabulary:
    lines = training_lines(spark, sf_dir, "fineline").withColumn("fineline", fineline_or_sentinel())
    return fit_vocabulary(lines, "fineline", F.sum(units()), 0.3)


def line_tasks(spark: SparkSession, sf_dir: str) -> int:
    return tasks_for(spark, line_count(spark, sf_dir))


# Visit features.


@query(
    "visit_basic",
    with_baskets("""
select visit_number, cast(min(d) as bigint) as "Min", cast(max(d) as bigint) as "Max", cast(avg(d) as double) as "Mean",
  cast(max(d) - min(d) as bigint) as "Range", cast(sum(d) as bigint) as "Sum"
from (select visit_number, department, sum(u) as d from c group by 1, 2) group by 1"""),
)
def visit_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.department_spread(basket_lines(spark, sf_dir, "department"))


@query(
    "visit_flags",
    with_baskets("""
select visit_number, max(case when department is null then 1 else 0 end) as "Null",
  max(case when scan_count < 0 then 1 else 0 end) as "Has_Neg", max(case when f = 9999 then 1 else 0 end) as "Missing"
from c group by 1"""),
)
def visit_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.visit_flags(basket_lines(spark, sf_dir, "department", "fineline"))


@query(
    "visit_distinct_counts",
    with_baskets("""
select visit_number, count(distinct f) as "N_Fineline", count(distinct coalesce(upc, -1)) as "N_Upc",
  count(distinct coalesce(department, '')) as "N_Dep"
from c group by 1"""),
)
def visit_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.distinct_counts(basket_lines(spark, sf_dir, "department", "fineline"))


@query("visit_distinct_counts_approx", SQL["visit_distinct_counts"])
def visit_distinct_counts_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From sketches; visits have few distinct values, for which sketches are exact."""
    return visits.distinct_counts_approx(basket_lines(spark, sf_dir, "department", "fineline"))


@query(
    "visit_ratios",
    with_baskets("""
, d as (
  select visit_number, min(d) as mn, max(d) as mx, avg(d) as me, sum(d) as s
  from (select visit_number, department, sum(u) as d from c group by 1, 2) group by 1
),
n as (
  select visit_number, count(distinct f) as nf, count(distinct coalesce(upc, -1)) as nu,
    count(distinct coalesce(department, '')) as nd, max(case when department is null then 1 else 0 end) as nul,
    max(case when scan_count < 0 then 1 else 0 end) as neg, max(case when f = 9999 then 1 else 0 end) as mis
  from c group by 1
)
select visit_number, cast(mn as bigint) as "Min", cast(mx as bigint) as "Max", cast(me as double) as "Mean",
  cast(mx - mn as bigint) as "Range", nul as "Null", neg as "Has_Neg", mis as "Missing",
  nf as "N_Fineline", nu as "N_Upc", nd as "N_Dep", cast(s as bigint) as "Sum",
  round(nf / nd, 6) as "Ratio_F_D", round(nu / nd, 6) as "Ratio_U_D",
  round(case when mn = 0 then 0.0 else me / mn end, 6) as mean_to_min,
  round(case when me = 0 then 0.0 else mx / me end, 6) as max_to_mean
from d join n using (visit_number)"""),
)
def visit_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = visits.visit_summary(basket_lines(spark, sf_dir, "department", "fineline"))
    ratios = ("Ratio_F_D", "Ratio_U_D", "mean_to_min", "max_to_mean")
    return summary.withColumns({c: F.round(c, 6) for c in ratios})


@query(
    "line_with_visit_totals",
    with_baskets("""
, t as (
  select visit_number, min(d) as mn, max(d) as mx, avg(d) as me, sum(d) as s
  from (select visit_number, department, sum(u) as d from c group by 1, 2) group by 1
)
select visit_number, line_number, upc, scan_count, department, cast(mn as bigint) as "Min", cast(mx as bigint) as "Max",
  cast(me as double) as "Mean", cast(mx - mn as bigint) as "Range", cast(s as bigint) as "Sum"
from c left join t using (visit_number)"""),
)
def line_with_visit_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.lines_with_totals(basket_lines(spark, sf_dir, "department"))


@query("distinct_visits", with_baskets("select distinct visit_number, weekday from c"))
def distinct_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.distinct_visits(basket_lines(spark, sf_dir, "weekday"), "weekday")


@query(
    "first_line_per_visit",
    with_baskets("""
select visit_number, line_number, upc, scan_count, department, fineline from (
  select *, row_number() over (partition by visit_number
    order by line_number, upc, scan_count, department nulls first, fineline nulls first) as r from c) where r = 1"""),
)
def first_line_per_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.first_line(basket_lines(spark, sf_dir, "department", "fineline"), "line_number", "upc")


# Cleaning and encoding.


@query(
    "category_filter_nullsafe",
    with_baskets(f"""
select visit_number, line_number, upc, scan_count, department from c where department is distinct from '{LEFT_OUT}'"""),
)
def category_filter_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return basket_lines(spark, sf_dir, "department").filter(category_is_not("department", LEFT_OUT))


@query(
    "clean_lines",
    with_baskets("""
select visit_number, line_number, coalesce(upc, -1) as upc, f as fineline, scan_count, u as units from c"""),
)
def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return basket_lines(spark, sf_dir, "fineline").select(
        "visit_number",
        "line_number",
        upc_or_sentinel().alias("upc"),
        fineline_or_sentinel().alias("fineline"),
        "scan_count",
        units().alias("units"),
    )


@query("encode_department", with_fitted("select visit_number, line_number, upc, department, code as department_code from x"))
def encode_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = basket_lines(spark, sf_dir, "department").select("visit_number", "line_number", "upc", "department")
    return departments(spark, sf_dir).encode(lines, "department", "department_code")


@query(
    "encode_weekday",
    with_baskets("""
select v.visit_number, v.weekday, w.code as weekday_code
from (select distinct visit_number, weekday from c) v join (
  select weekday, cast(row_number() over (order by weekday) - 1 as int) as code from (select distinct weekday from c)
) w using (weekday)"""),
)
def encode_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = visits.distinct_visits(basket_lines(spark, sf_dir, "weekday"), "weekday")
    return fit_dictionary(days, "weekday").encode(days, "weekday", "weekday_code")


@query(
    "encode_label",
    """
with k as (
  select o_orderpriority as trip_type, cast(row_number() over (order by o_orderpriority) - 1 as int) as label
  from (select distinct o_orderpriority from orders)
)
select o_orderkey as visit_number, trip_type, label, trip_type as decoded,
  cast((select count(*) from k) as int) as n_classes
from orders join k on trip_type = o_orderpriority""",
)
def encode_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = visit_attributes(spark, sf_dir).select("visit_number", "trip_type")
    labels = fit_dictionary(labelled, "trip_type")
    coded = labels.decode(labels.encode(labelled, "trip_type", "label"), "label", "decoded")
    return coded.withColumn("n_classes", F.lit(labels.size))


@query("department_dictionary", with_fitted("select department as value, code from dd"))
def department_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return departments(spark, sf_dir).entries()


@query("vocab_fineline", with_fitted("select f as value, cast(t as bigint) as total, idx from fv"))
def vocab_fineline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finelines(spark, sf_dir).table


@query("vocab_department", with_fitted("select code as value, cast(t as bigint) as total, idx from dv"))
def vocab_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = training_lines(spark, sf_dir)
    return categories.department_vocabulary_codes(lines, fit_dictionary(lines, "department"), 0.6).table


@query(
    "frequent_lines_semi",
    with_fitted("select visit_number, line_number, upc, f as fineline, scan_count from c where f in (select f from fv)"),
)
def frequent_lines_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = basket_lines(spark, sf_dir, "fineline").withColumn("fineline", fineline_or_sentinel())
    return finelines(spark, sf_dir).keep(lines, "fineline")


# Category families.


def _columns(value: str, prefix: str, n: int, cast: str = "bigint") -> str:
    key = "idx" if prefix == "F" else "code"
    return ", ".join(
        f'cast(coalesce(sum(case when {key} = {i} then {value} end), 0) as {cast}) as "{prefix}_{i}"' for i in range(n)
    )


def _family(value: str, prefix: str) -> str:
    return with_fitted(f"select visit_number, {_columns(value, prefix, N_DEPARTMENTS)} from x group by 1")


def _measure(spark: SparkSession, sf_dir: str, measure: str) -> DataFrame:
    tasks = line_tasks(spark, sf_dir)
    cells = categories.category_measure(basket_lines(spark, sf_dir, "department"), measure, tasks=tasks)
    return categories.spread(cells, departments(spark, sf_dir), measure, tasks=tasks)


@query(
    "fineline_counts_long",
    with_fitted("""
select visit_number, idx, cast(sum(u) as bigint) as units from c join fv using (f) group by 1, 2"""),
)
def fineline_counts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = basket_lines(spark, sf_dir, "fineline")
    return categories.fineline_units(lines, finelines(spark, sf_dir)).withColumnRenamed("value", "units")


@query(
    "fineline_pivot",
    with_fitted(f"select visit_number, {_columns('u', 'F', N_FINELINES)} from c left join fv using (f) group by 1"),
)
def fineline_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = basket_lines(spark, sf_dir, "fineline")
    return categories.fineline_columns(lines, finelines(spark, sf_dir), line_tasks(spark, sf_dir))


@query(
    "dept_counts_share",
    with_baskets("""
select visit_number, department, cast(sum(u) as bigint) as value,
  cast(sum(sum(u)) over (partition by visit_number) as bigint) as total,
  round(case when sum(sum(u)) over (partition by visit_number) = 0 then 0.0
    else sum(u) / sum(sum(u)) over (partition by visit_number) end, 6) as share
from c group by 1, 2"""),
)
def dept_counts_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_share(basket_lines(spark, sf_dir, "department")).withColumn("share", F.round("share", 6))


@query("dept_units", _family("u", "D"))
def dept_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measure(spark, sf_dir, "D")


@query("dept_return_units", _family("(case when scan_count < 0 then -scan_count else 0 end)", "D1"))
def dept_return_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measure(spark, sf_dir, "D1")


@query("dept_multi_units", _family("(case when scan_count > 1 then 1 else 0 end)", "D2"))
def dept_multi_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measure(spark, sf_dir, "D2")


@query(
    "dept_repeat_lines",
    with_fitted(f"""
select visit_number, {_columns("n", "D3", N_DEPARTMENTS)}
from (select visit_number, code, f, case when count(*) > 1 then count(*) else 0 end as n from x group by 1, 2, 3)
group by 1"""),
)
def dept_repeat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = line_tasks(spark, sf_dir)
    cells = categories.repeated_lines(basket_lines(spark, sf_dir, "department", "fineline"), tasks=tasks)
    return categories.spread(cells, departments(spark, sf_dir), "D3", tasks=tasks)


@query("dept_sale_lines", _family("(case when scan_count > 0 then 1 else 0 end)", "D4"))
def dept_sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measure(spark, sf_dir, "D4")


@query("dept_return_lines", _family("(case when scan_count < 0 then 1 else 0 end)", "D5"))
def dept_return_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measure(spark, sf_dir, "D5")


_PRESENCE = """
, p as (
  select visit_number, code, case when sum(sum(u)) over (partition by visit_number) > 0 then 1 else 0 end as here
  from x group by visit_number, code
)"""


@query(
    "dept_dummies",
    with_fitted(_PRESENCE + f"select visit_number, {_columns('here', 'D6', N_DEPARTMENTS)} from p group by 1"),
)
def dept_dummies(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = categories.category_presence(basket_lines(spark, sf_dir, "department"))
    return categories.spread(cells, departments(spark, sf_dir), "D6")


@query(
    "dept_pairs",
    with_fitted(
        _PRESENCE
        + """
select a.visit_number, a.code as dept_a, b.code as dept_b, cast(1 as int) as value
from p a join p b on a.visit_number = b.visit_number and a.code < b.code and a.here = 1 and b.here = 1
where a.code in (select code from dv) and b.code in (select code from dv)"""
    ),
)
def dept_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = training_lines(spark, sf_dir)
    dictionary = fit_dictionary(train, "department")
    popular = categories.department_vocabulary_codes(train, dictionary, 0.6)
    return categories.pair_presence(basket_lines(spark, sf_dir, "department"), dictionary, popular)


@query(
    "weekday_onehot",
    with_baskets(
        """
, w as (
  select weekday, cast(row_number() over (order by weekday) - 1 as int) as code from (select distinct weekday from c)
)
select visit_number, """
        + ", ".join(f'cast(max(case when code = {i} then 1 else 0 end) as int) as "Weekday_{i}"' for i in range(7))
        + " from c join w using (weekday) group by 1"
    ),
)
def weekday_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = visits.distinct_visits(basket_lines(spark, sf_dir, "weekday"), "weekday")
    dictionary = fit_dictionary(days, "weekday")
    return visits.weekday_columns(dictionary.encode(days, "weekday", "weekday_code"), dictionary.size)
