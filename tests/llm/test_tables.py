"""Neighbours, URL filters, the pipeline and the registered queries."""

import datetime

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tests.oracle import connect, duck_rows, spark_rows
from tillroll.llm import forest, queries, urlfilter

SF = "/root/testdata/sf0.001"


def test_forest_recall(spark):
    rows = duckdb.sql("select vec_id, embedding from '/root/testdata/sf0.1/embeddings.parquet'").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {}
    for r in forest.nearest(frame, frame.where("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = []
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        want = ids[np.lexsort((ids, d))[:10]]
        found = sorted(got[ids[i]])
        assert [f[0] for f in found] == list(range(1, 11))
        assert np.allclose([f[2] for f in found], [d[ids == f[1]][0] for f in found], rtol=1e-12)
        hits.append(len(set(want) & {f[1] for f in found}) / 10)
    assert np.mean(hits) >= 0.9


def test_forest_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (3, None), (4, [nan, 1.0]), (5, [0.0, 0.0])]
    rows += [(6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (100, [1.0, 0.0])]
    rows += [(i, [1.0, 0.0]) for i in range(10, 40)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = forest.nearest(frame, frame.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()
    by = {q: [r.vec_id for r in got if r.query_id == q] for q in (0, 100)}
    assert by == {0: [1, *range(10, 19)], 100: [0, 1, *range(10, 18)]}
    assert forest.nearest(frame.limit(0), frame.limit(0)).count() == 0
    assert forest.nearest(frame, frame.where("vec_id = 9")).count() == 0


def brute_nearest(rows, query, k=10):
    """(vec_id, distance) of the k nearest rows of the query's dimension, its own id left out."""
    own, v = query
    near = [(float(np.sqrt(((np.array(x) - v) ** 2).sum())), i) for i, x in rows if i != own and len(x) == len(v)]
    return [(i, d) for d, i in sorted(near)[:k]]


@pytest.mark.parametrize("n", [5, 11, 30, 64, 100, 200])
def test_forest_of_few_rows_is_exact(spark, n, monkeypatch):
    rng = np.random.default_rng(n)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(n)]
    rows += [(1000 + i, rng.normal(size=7).tolist()) for i in range(20)]  # a rare dimension, beside several shards
    rows += [(1000, rng.normal(size=7).tolist()) for _ in range(12)]  # rows that hold the query's own id only
    monkeypatch.setattr(forest, "SHARD_ROWS", 40)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    asked = [r for r in rows[:n] if r[0] % 10 == 0] + rows[n : n + 1]
    queries = spark.createDataFrame(asked, frame.schema)
    got = {}
    for r in forest.nearest(frame, queries).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == sorted(i for i, _ in asked)
    for query in asked:
        want = brute_nearest(rows, query)
        assert [i for i, _ in got[query[0]]] == [i for i, _ in want]
        assert np.allclose([d for _, d in got[query[0]]], [d for _, d in want])


@pytest.mark.parametrize("least", [1, 1024])
def test_forest_meets_enough_distinct_rows(monkeypatch, least):
    monkeypatch.setattr(forest, "LEAST", least)
    x = np.random.default_rng(3).normal(size=(2000, 32))
    built = forest.Forest(x, x.mean(axis=0))
    need = np.full(50, max(10, least, int(forest.SHARE * len(x))) + 1)
    for i, rows in enumerate(built.candidates(x[:50], need)):
        assert i in rows and len(set(rows.tolist())) == len(rows) >= need[i]


def test_url_filter(spark):
    day = lambda m, d=1: datetime.date(2024, m, d)
    captures = [
        ("http://a.example.com/x/y?q=1", day(3), 1),
        ("http://a.example.com/x/y?q=1", day(3), 2),
        ("http://a.example.com/x/y?q=1", day(8), 3),
        ("http://b.example.com/", day(3), 4),
        ("//user@B.Example.com:80/z", day(6), 5),
        (None, day(3), 6),
        ("http://b.example.com/", None, 7),
        ("mailto:x", day(3), 8),
    ]
    entries = [
        ("d:example.com", "block", day(1)),
        ("d:example.com", "remove", day(5)),
        ("d:a.example.com", "allow", day(2)),
        ("p:a.example.com/x", "block", day(3)),
        ("p:a.example.com/x", "allow", day(3)),
        ("p:a.example.com/x", "remove", day(7, 15)),
        ("d:b.example.com", "block", day(6)),
        (None, "block", day(1)),
        ("d:com", "other", day(1)),
        ("d:com", "block", None),
    ]
    left = spark.createDataFrame(captures, "url string, fetched_on date, rule int")
    left = left.withColumnRenamed("rule", "key")
    right = spark.createDataFrame(entries, "key string, action string, listed_on date")
    got = {r.key: (r.decision, r.rule) for r in urlfilter.decide(left, right).collect()}
    block = ("block", "p:a.example.com/x")
    assert got == {
        1: block, 2: block, 3: ("allow", "d:a.example.com"), 4: ("block", "d:example.com"), 5: ("block", "d:b.example.com"),
        6: ("none", None), 7: ("none", None), 8: ("none", None),
    }
    clashing = left.selectExpr("*", "1 as best", "2 as _url", "3 as _day", "4 as month", "5 as decision")
    named = urlfilter.decide(clashing, right)
    assert named.columns == ["url", "fetched_on", "key", "best", "_url", "_day", "month", "decision", "rule", "listed_since"]
    assert {r.key: (r.decision, r.rule) for r in named.where("best = 1 and _url = 2 and _day = 3 and month = 4").collect()} == got
    assert urlfilter.decide(left, right.limit(0)).where("decision <> 'none'").count() == 0
    assert urlfilter.decide(left.limit(0), right).count() == 0


@pytest.mark.parametrize("name", list(queries.SQL))
def test_matches_sql(spark, name):
    columns, rows = spark_rows(queries.QUERIES[name](spark, SF))
    wanted_columns, wanted = duck_rows(connect(SF), queries.SQL[name])
    assert columns == wanted_columns and rows == wanted and rows


def test_native_plan(spark):
    plan = queries.QUERIES["op1_url_filter"](spark, SF)._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF).cache()
        assert docs.columns == columns, name
        assert docs.count() <= kept
        kept = docs.count()
    assert 0.7 * 200 < kept < 200
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == kept
    assert [r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").distinct().orderBy("doc_id").collect()] == sorted(
        r.doc_id for r in docs.select("doc_id").collect()
    )
