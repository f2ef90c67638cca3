"""Probabilities, models and stacking: invariants on small frames."""

import math
import threading

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tillroll.operators import models, probabilities, stacking
from tillroll.operators.ensemble import EnsembleSpec
from tillroll.operators.folds import stratified_folds
from tillroll.operators.scaling import fit_pca, fit_scaler, fit_sparse_pca

LONG = "id bigint, class int, prob double"


@pytest.fixture(scope="module")
def separable(spark):
    """Three well separated classes, 40 rows each, with folds."""
    rng = np.random.default_rng(3)
    rows = [(i, i % 3, [float(x) for x in rng.normal(size=4) * 0.3 + (i % 3) * 2]) for i in range(120)]
    df = spark.createDataFrame(rows, "id bigint, label int, vec array<double>")
    folds = stratified_folds(df, "id", "label", 3).select("id", "fold")
    out = df.join(folds, "id").withColumn("features", array_to_vector("vec")).cache()
    out.count()
    return out


def accuracy(scores, truth):
    best = probabilities.argmax_class(probabilities.to_long(scores), "id")
    hits = best.join(truth.select("id", "label"), "id").agg(F.avg((F.col("best_class") == F.col("label")).cast("int")))
    return hits.first()[0]


def assert_probabilities(scores, n_classes, rows):
    got = scores.collect()
    assert len(got) == rows
    for r in got:
        assert len(r.probs) == n_classes
        assert all(0 <= p <= 1 for p in r.probs) and math.isclose(sum(r.probs), 1, abs_tol=1e-6)


LEARNERS = {
    "logistic": lambda: models.logistic(120, max_iter=20),
    "forest": lambda: models.forest(trees=10, depth=4),
    "extra_trees": lambda: models.ExtraTrees(trees=10, depth=4),
    "net": lambda: models.Network("net", (32,), steps=80, rate=0.02),
    "boosted": lambda: models.Boosted(rounds=5, depth=3, step=0.3, rows=1.0, features=1.0),
    "adaboost": lambda: models.RealAdaBoost(rounds=6, depth=2, rate=0.5),
}


@pytest.mark.parametrize("name", LEARNERS)
def test_models_learn(separable, name):
    scores = LEARNERS[name]().fit(separable, 3)(separable)
    assert_probabilities(scores, 3, 120)
    assert accuracy(scores, separable) > 0.9


@pytest.mark.parametrize("name", ["logistic", "boosted", "adaboost"])
def test_class_missing_in_training(separable, name):
    """Class 1 and the last class are unknown to the model, and keep their places."""
    scores = LEARNERS[name]().fit(separable.filter("label = 0 or label = 2"), 5)(separable)
    assert_probabilities(scores, 5, 120)
    assert all(r.probs[4] < 1e-12 and r.probs[1] < 1e-12 for r in scores.collect())


def test_out_of_fold(separable):
    learners = [models.logistic(80, max_iter=10), models.forest(trees=5, depth=3)]
    scores = stacking.out_of_fold(separable, learners, 3, 3, "id", scale=True, parallelism=2)
    for learner in learners:
        one = scores.filter(F.col("model") == learner.name)
        assert_probabilities(one, 3, 120)
        assert one.select("id").distinct().count() == 120
    assert accuracy(scores.filter("model = 'forest'"), separable) > 0.9


def test_out_of_fold_never_sees_the_row(spark):
    """One class per fold: a model that never met a class gives it nothing."""
    rows = spark.createDataFrame([(i, i % 3, i % 3, [float(i % 3)]) for i in range(30)], "id bigint, label int, fold int, vec array<double>")
    rows = rows.withColumn("features", array_to_vector("vec"))
    scores = stacking.out_of_fold(rows, [models.forest(trees=3, depth=2)], 3, 3, "id")
    matched = scores.join(rows, "id").select(F.element_at("probs", F.col("label") + 1).alias("p"))
    assert [r.p for r in matched.distinct().collect()] == [0.0]


def test_learners_that_fit_all_folds_overlap(separable):
    """The rounds of one run beside the tasks of another; scores stay in the order of the learners."""
    both = threading.Barrier(stacking.RUNS_AT_ONCE, timeout=60)

    class Waits:
        def __init__(self, name):
            self.name = name

        def fit_many(self, train, n_classes, weights):
            both.wait()
            even = F.array_repeat(F.array_repeat(F.lit(1.0 / n_classes), n_classes), len(weights))
            return lambda df: df.withColumn("all_probs", even)

    learners = [Waits("a"), Waits("b")]
    inside, outside = stacking.stack_scores(separable, separable, learners, 3, 3, "id", parallelism=2)
    for scores in (inside, outside):
        assert {(r.model, r["count"]) for r in scores.groupBy("model").count().collect()} == {("a", 120), ("b", 120)}


def test_four_learners_overlap_where_eight_fits_may(separable):
    all_four = threading.Barrier(4, timeout=60)

    class Waits:
        def __init__(self, name):
            self.name = name

        def fit_many(self, train, n_classes, weights):
            all_four.wait()
            even = F.array_repeat(F.array_repeat(F.lit(1.0 / n_classes), n_classes), len(weights))
            return lambda df: df.withColumn("all_probs", even)

    inside, _ = stacking.stack_scores(separable, None, [Waits(name) for name in "abcd"], 3, 3, "id", parallelism=8)
    assert {(r.model, r["count"]) for r in inside.groupBy("model").count().collect()} == {(name, 120) for name in "abcd"}


@pytest.mark.parametrize("name", ["logistic", "forest"])
def test_two_classes_after_an_observation(spark, separable, name):
    """A session that has observed something cannot be sent to tasks, and a summary of two classes holds it."""
    spark.range(3).observe(Observation("seen"), F.count(F.lit(1)).alias("n")).collect()
    two = separable.filter("label < 2")
    assert_probabilities(LEARNERS[name]().fit(two, 2)(two), 2, 80)


def test_bagging(separable):
    train, test = separable.filter("fold <> 0"), separable.filter("fold = 0")
    learner = models.logistic(80, max_iter=10)
    rounds = stacking.round_scores(train, test, learner, 3, "id", 2)
    mean = {r.id: r.probs for r in stacking.mean_of_rounds(rounds, "id", 3).collect()}
    by_row = {}
    for r in rounds.collect():
        by_row.setdefault(r.id, []).append(r.probs)
    assert mean.keys() == by_row.keys()
    assert all(np.allclose(mean[k], np.mean(v, axis=0)) and len(v) == 2 for k, v in by_row.items())
    assert any(not np.allclose(v[0], v[1]) for v in by_row.values())


def test_weights_equal_repeats(separable):
    """Drawn rows count as often as they were drawn, for learners with and without weights."""
    drawn = separable.withColumn("draws", (F.col("id") % 2 + 1).cast("int"))
    repeated = drawn.withColumn("x", F.explode(F.sequence(F.lit(1), "draws"))).drop("x")
    learner = models.logistic(120, c=0.05, max_iter=50)
    a = {r.id: r.probs for r in learner.fit(drawn, 3, weight="draws")(separable).collect()}
    b = {r.id: r.probs for r in learner.fit(repeated, 3)(separable).collect()}
    assert all(np.allclose(a[k], b[k], atol=0.02) for k in a)


def test_repeats_where_weights_are_not_taken(separable):
    drawn = separable.withColumn("draws", (F.col("id") % 2 + 1).cast("int"))
    _, rows = models._weighted(MultilayerPerceptronClassifier(), drawn, "draws")
    assert rows.count() == drawn.agg(F.sum("draws")).first()[0] == 180


def test_blend_argmax_loss(spark):
    one = spark.createDataFrame([(1, 0, 0.5), (1, 1, 0.5), (1, 2, 0.0), (2, 0, 0.2), (2, 1, 0.3), (2, 2, 0.5)], LONG)
    two = spark.createDataFrame([(1, 0, 0.1), (1, 1, 0.9), (1, 2, 0.0), (2, 0, 0.2), (2, 1, 0.3), (2, 2, 0.5)], LONG)
    raw = {(r.id, r["class"]): r.prob for r in probabilities.blend(one, two, "id").collect()}
    assert raw[1, 0] == pytest.approx(0.5**0.784 * 0.1**0.216) and raw[1, 2] == 0
    assert raw[2, 2] == pytest.approx(0.5)
    even = probabilities.blend(one, two, "id", normalise=True).groupBy("id").agg(F.round(F.sum("prob"), 9).alias("s"))
    assert {r.s for r in even.collect()} == {1.0}
    best = {r.id: r.best_class for r in probabilities.argmax_class(one, "id").collect()}
    assert best == {1: 0, 2: 2}
    truth = spark.createDataFrame([(1, 2), (2, 1), (3, 0)], "id bigint, label int")
    loss = probabilities.log_loss(one, truth, "id").first()
    assert loss.n == 3
    assert loss.log_loss == pytest.approx((2 * -math.log(1e-15) - math.log(0.3)) / 3)


def test_alignment(spark):
    long = spark.createDataFrame([(1, 1, 1.0), (2, 0, 0.5), (2, 3, 0.5)], LONG)
    got = {(r.id, r["class"]): r.prob for r in probabilities.align_classes(long, ["id"], 4).collect()}
    assert len(got) == 8 and got[1, 0] == 0 and got[1, 1] == 1 and got[2, 3] == 0.5


def test_scaler_and_pca(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(50, 5)) * [1, 2, 3, 4, 0] + [0, 1, 2, 3, 7]
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id bigint, vec array<double>")
    scaler = fit_scaler(df)
    assert np.allclose(scaler.mean, x.mean(0)) and np.allclose(scaler.deviation[:4], x.std(0)[:4])
    assert scaler.deviation[4] == 1.0
    scaled = scaler.transform(df)
    z = np.array([r.vec for r in scaled.orderBy("id").collect()])
    assert np.allclose(z[:, :4].std(0), 1) and np.allclose(z[:, 4], 0)
    projected = np.array([r.vec for r in fit_pca(scaled, 2).transform(scaled).orderBy("id").collect()])
    _, _, axes = np.linalg.svd(z, full_matrices=False)
    assert np.allclose(np.abs(projected), np.abs(z @ axes[:2].T), atol=1e-6)


def test_sparse_pca_equals_dense(spark):
    rng = np.random.default_rng(5)
    x = np.where(rng.random((60, 6)) < 0.6, 0, rng.normal(size=(60, 6)) * [1, 2, 3, 4, 5, 6])
    rows = [(i, Vectors.sparse(6, {j: float(v) for j, v in enumerate(r) if v}), [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ["id", "features", "vec"])
    dense = fit_scaler(df).transform(df)
    wanted = np.array([r.vec for r in fit_pca(dense, 3).transform(dense).orderBy("id").collect()])
    found = fit_sparse_pca(df, 3).transform(df.drop("vec")).orderBy("id").collect()
    assert np.allclose(np.abs([r.vec for r in found]), np.abs(wanted), atol=1e-8)
    assert found[0].asDict().keys() == {"id", "vec"}
    spread = fit_scaler(df, "features").spread(df).first().features
    assert isinstance(spread, SparseVector) and spread.numNonzeros() == rows[0][1].numNonzeros()


def test_subspace_iteration_finds_the_leading_axes(spark):
    """Fewer columns than features: the subspace of the dense result, from sparse rows."""
    rng = np.random.default_rng(6)
    x = np.where(rng.random((400, 60)) < 0.7, 0, rng.normal(size=(400, 60)) + 3 * rng.normal(size=(400, 3)) @ rng.normal(size=(3, 60)))
    rows = [(i, Vectors.sparse(60, {j: float(v) for j, v in enumerate(r) if v})) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ["id", "features"])
    found = fit_sparse_pca(df, 3)
    scale = np.where(x.std(0) > 0, x.std(0), 1)
    _, _, axes = np.linalg.svd((x - x.mean(0)) / scale, full_matrices=False)
    ours = np.linalg.qr(found.axes * scale[:, None])[0]
    assert np.linalg.svd(ours.T @ axes[:3].T, compute_uv=False).min() > 1 - 1e-6
    got = np.array([r.vec for r in found.transform(df).orderBy("id").collect()])
    assert np.allclose(got, (x - x.mean(0)) @ found.axes, atol=1e-9) and (np.diff(got.var(0)) < 0).all()


def test_ensemble_profiles(spark):
    published, quick = EnsembleSpec.published(100), EnsembleSpec.quick(100)
    assert published.names == quick.names and len(set(published.names)) == 15
    assert published.bagging_rounds == 50 and published.final_trees.rounds == 800 and published.trees[0].rounds == 300
    assert published.guide in published.names


def test_second_level(spark):
    scores = spark.createDataFrame(
        [(1, "a", [0.1, 0.9]), (1, "b", [0.2, 0.8]), (2, "a", [0.3, 0.7]), (2, "b", [0.4, 0.6])],
        "id bigint, model string, probs array<double>",
    )
    near = spark.createDataFrame([(1, 0, 1.0, 2.0, 3.0), (2, 0, 4.0, 5.0, 6.0)], "qid bigint, klass int, d1 double, d3 double, d5 double")
    far = stacking.farthest(near)
    got = {r.id: r.stacked for r in stacking.second_level(scores, near, ["b", "a"], 2, "id", far).collect()}
    assert got[1] == [0.2, 0.8, 0.1, 0.9, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    assert [(r["class"], r.prob) for r in stacking.class_slice(scores, "a").filter("id = 2").orderBy("class").collect()] == [(0, 0.3), (1, 0.7)]
