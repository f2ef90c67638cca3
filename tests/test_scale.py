"""The ways taken beyond the small-table limit, and hot keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll import session
from tillroll.operators import categories, encode, ranking, visits
from tillroll.operators.features import FeatureModel
from tillroll.operators.folds import bootstrap_draws, stratified_folds


@pytest.fixture
def no_small_tables(monkeypatch):
    monkeypatch.setattr(session, "SMALL_ROWS", 0)
    monkeypatch.setattr(ranking, "SMALL_ROWS", 0)


def test_positions(spark):
    rows = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("x"))
    assert all(r.x == r.position for r in ranking.with_position(rows.repartition(7), "x").collect())


def test_shuffled_ways_agree(spark, basket, no_small_tables):
    d = encode.fit_dictionary(basket, "department")
    coded = d.encode(basket, "department", "code")
    assert sorted((str(r.department), r.code) for r in coded.select("department", "code").distinct().collect()) == [
        ("A", 0), ("B", 1), ("None", 2),
    ]
    assert coded.count() == basket.count()
    rows = spark.createDataFrame([(i, i) for i in range(1, 12)], "f int, u int")
    v = encode.fit_vocabulary(rows, "f", F.sum("u"), 0.3)
    assert v.threshold == 4.0 and v.size == 7
    assert {r.f: r.idx for r in v.index(rows, "f", "idx").collect()} == {f: f - 5 if f > 4 else -1 for f in range(1, 12)}
    assert {r.f for r in v.keep(rows, "f").collect()} == set(range(5, 12))


NUMBERS = {
    "few": [5, 1, 9, 9, 2, 4, 40],
    "one": [3],
    "equal": [2, 2, 2, 2],
    "far apart": [-1e300, 1e-300, 0, 5e-324, 1e300, 1e300, -2.5],
    "many": [((i * 7919) % 1000) ** 2 / 7 for i in range(3000)],
    "skewed": [1] * 500 + [10.0**i for i in range(60)],
}


@pytest.mark.parametrize("name", NUMBERS)
@pytest.mark.parametrize("q", [0.0, 0.3, 0.6, 0.77, 1.0])
def test_quantiles(spark, name, q):
    numbers = [float(x) for x in NUMBERS[name]]
    rows = spark.createDataFrame([(x,) for x in numbers] + [(None,)], "x double")
    assert ranking.quantile(rows, "x", q, len(numbers)) == pytest.approx(float(np.quantile(numbers, q)), rel=1e-12)


@pytest.mark.parametrize("limit", [1000, 10**9])
def test_lines_of_a_hot_visit(spark, limit):
    """A third of all lines in one visit: its lines meet the totals without a shuffle."""
    n = 30_000
    lines = spark.range(0, n, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("visit_number"),
        F.concat(F.lit("d"), (F.col("id") % 5).cast("string")).alias("department"),
        F.lit(1).alias("scan_count"),
    )
    joined = visits.lines_with_totals(lines, hot_lines=limit)
    assert ("Union" in joined._jdf.queryExecution().optimizedPlan().toString()) == (limit == 1000)
    assert joined.count() == n
    hot = joined.filter("visit_number = 0").agg(F.count("*"), F.min("Sum"), F.max("Sum"))
    assert tuple(hot.first()) == (n // 3, n // 3, n // 3)
    assert joined.filter("visit_number <> 0 and Sum <> 1").count() == 0


def test_features_of_a_hot_visit(spark):
    lines = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("visit_number"),
        F.lit("Monday").alias("weekday"),
        (F.col("id") % 1000).alias("upc"),
        F.lit(1).alias("scan_count"),
        F.concat(F.lit("d"), (F.col("id") % 5).cast("string")).alias("department"),
        (F.col("id") % 50).cast("int").alias("fineline"),
    )
    model = FeatureModel.fit(lines)
    row = model.columns(lines).filter("visit_number = 0").first()
    want = visits.visit_summary(lines).filter("visit_number = 0").first()
    assert all(row[c] == pytest.approx(want[c]) for c in want.asDict())
    assert row["Sum"] == 3000 and row["N_Upc"] == 1000


def test_folds_match_ntile(spark):
    rows = spark.range(101).select("id", F.when(F.col("id") < 2, 0).when(F.col("id") % 3 == 0, 1).otherwise(2).alias("y"))
    got = {r.id: r.fold for r in stratified_folds(rows.repartition(5), "id", "y", 3).collect()}
    rows.createOrReplaceTempView("rows_for_folds")
    want = spark.sql("select id, ntile(3) over (partition by y order by id) - 1 as fold from rows_for_folds")
    assert got == {r.id: r.fold for r in want.collect()}


def test_draws(spark):
    rows = spark.range(200).withColumnRenamed("id", "k")
    one = bootstrap_draws(rows.repartition(3), "k", 4, 1014)
    again = bootstrap_draws(rows.repartition(9), "k", 4, 1014)
    key = lambda r: (r["round"], r.k, r.draws)
    assert sorted(map(key, one.collect())) == sorted(map(key, again.collect()))
    per_round = one.groupBy("round").agg(F.sum("draws").alias("n"), F.count("*").alias("distinct")).collect()
    assert [r.n for r in per_round] == [200] * 4
    assert all(100 < r.distinct < 150 for r in per_round)


def test_tasks_grow_with_the_lines(spark, basket, monkeypatch):
    """No task takes more than so many lines, whatever the session's number of tasks; the rows stay the same."""
    model = FeatureModel.fit(basket)
    d = model.departments

    def built():
        tasks = session.tasks_for(spark, basket.count())
        return {
            "profiles": model.profiles(basket).drop("depts", "fines"),
            "entries": model.entries(basket),
            "spread": categories.spread(categories.category_measure(basket, "D", tasks=tasks), d, "D", tasks=tasks),
            "repeats": categories.spread(categories.repeated_lines(basket, tasks=tasks), d, "D3", tasks=tasks),
            "finelines": categories.fineline_columns(basket, model.finelines, tasks),
        }

    rows = lambda df: sorted(str(r) for r in df.collect())
    few = {name: rows(df) for name, df in built().items()}
    monkeypatch.setattr(session, "LINES_PER_TASK", 1)
    for name, df in built().items():
        assert rows(df) == few[name], name
        assert df.rdd.getNumPartitions() == basket.count() > 4, name


def test_tasks_grow_with_the_lines_below_the_sessions_number(spark, basket, monkeypatch):
    """A large number of shuffle partitions is no reason to leave them to adaptive execution, which merges them."""
    monkeypatch.setattr(session, "LINES_PER_TASK", 1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        tasks = session.tasks_for(spark, basket.count())
        model = FeatureModel.fit(basket)
        for df in (model.profiles(basket), categories.category_measure(basket, "D", tasks=tasks)):
            assert df.rdd.getNumPartitions() == tasks == basket.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
