"""Queries that fit models: stacking, bagging, single models, the whole ensemble.

Models cannot be said in SQL. Where a query has a twin, it checks by SQL what must hold of any
model: each row is scored once per model, in its own fold, by probabilities that sum to 1. The
single models are fitted to a class that the vector tells, and must beat the class shares on
rows they have not seen. Runs of the whole ensemble fit what ``SPEC`` says: the published set,
unless tests put a quick one in its place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.operators import models as m
from tillroll.operators import stacking
from tillroll.operators.encode import fit_dictionary
from tillroll.operators.ensemble import EnsembleSpec
from tillroll.operators.features import only_features, stage_vectors
from tillroll.operators.folds import stratified_folds
from tillroll.operators.neighbors import class_distances
from tillroll.operators.probabilities import argmax_class, blend, log_loss, to_long
from tillroll.operators.scaling import fit_scaler, fit_sparse_pca
from tillroll.plans.features import feature_lines, feature_model
from tillroll.plans.registry import query
from tillroll.plans.sql import TRAIN_BEFORE, with_baskets
from tillroll.plans.vectors import _SPLIT, N_CLASSES, N_FOLDS, split_vectors
from tillroll.session import stage
from tillroll.sources.star import visit_attributes
from tillroll.sources.submission import submission_frame

# Training rows -> what the runs of the whole ensemble fit.
SPEC: Callable[[int], EnsembleSpec] = EnsembleSpec.published


def published_learners(n_rows: int) -> dict:
    """The published models by name, for the queries on single ones."""
    return {
        "logistic": m.logistic(n_rows),
        "forest": m.forest(),
        "net": m.net_learners(n_rows)[0],
        "boosted": m.Boosted(),
        "extra_trees": m.ExtraTrees(),
        "adaboost": m.RealAdaBoost(),
        "final_net": m.final_learners()[1],
    }


# Training rows -> the models of the queries on single ones; tests put short runs in their place.
LEARNERS: Callable[[int], dict] = published_learners


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = split_vectors(spark, sf_dir).withColumn("features", array_to_vector(F.col("vec")))
    train = rows.filter(F.col("side") == "train").select("vec_id", "label", "fold", "vec", "features")
    return train, rows.filter(F.col("side") == "test").select("vec_id", "label", "vec", "features")


AT_ONCE = 8  # independent fits that overlap


def _two_learners(n_rows: int) -> list:
    """Two of the published models, one that wants scaled inputs and one that does not."""
    return [LEARNERS(n_rows)[name] for name in ("logistic", "forest")]


def _shape(probs: str = "probs") -> list:
    total = F.aggregate(probs, F.lit(0.0), lambda acc, x: acc + x)
    return [
        F.size(probs).alias("n_classes"),
        F.round(total, 6).alias("prob_total"),
        F.forall(probs, lambda p: (p >= 0) & (p <= 1)).alias("in_range"),
    ]


def _checked(long: DataFrame, keys: list[str]) -> DataFrame:
    """The probabilities of every row and class: each in 0 to 1, and with which total."""
    total = F.sum("prob").over(Window.partitionBy(*keys))  # one row per class
    in_range = (F.col("prob") >= 0) & (F.col("prob") <= 1)
    return long.select(*keys, "class", in_range.alias("in_range"), F.round(total, 6).alias("prob_total"))


_MODELS = "(select unnest(['logistic', 'forest']) as model)"


@query(
    "stack_oof",
    f"with {_SPLIT} select vec_id, model, cast(c as int) as class, true as in_range, cast(1.0 as double) as prob_total "
    f"from train, {_MODELS}, range({N_CLASSES}) t(c)",
)
def stack_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _sides(spark, sf_dir)
    scores = stacking.out_of_fold(train, _two_learners(train.count()), N_CLASSES, N_FOLDS, "vec_id", parallelism=AT_ONCE)
    return _checked(to_long(scores), ["vec_id", "model"])


_VALID = f"cast({N_CLASSES} as int) as n_classes, cast(1.0 as double) as prob_total, true as in_range"


@query(
    "stack_oof_scaled",
    f"with {_SPLIT} select vec_id, fold, model, {_VALID} from train, {_MODELS}",
)
def stack_oof_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _sides(spark, sf_dir)
    scores = stacking.out_of_fold(train, _two_learners(train.count()), N_CLASSES, N_FOLDS, "vec_id", scale=True, parallelism=AT_ONCE)
    return scores.join(train.select("vec_id", "fold"), "vec_id").select("vec_id", "fold", "model", *_shape())


@query("stack_test", f"with {_SPLIT} select vec_id, model, {_VALID} from test, {_MODELS}")
def stack_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _sides(spark, sf_dir)
    scores = stacking.refit_scores(train, test, _two_learners(train.count()), N_CLASSES, "vec_id", scale=True, parallelism=AT_ONCE)
    return scores.select("vec_id", "model", *_shape())


@query("bootstrap_draws", f"select cast(i as int) as round, count(*) as rows_drawn from embeddings, range({stacking.BAGGING_ROUNDS}) r(i) group by 1")
def bootstrap_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every round draws as many rows as there are."""
    from tillroll.operators import folds
    from tillroll.sources.star import vectors

    draws = folds.bootstrap_draws(vectors(spark, sf_dir), "vec_id", stacking.BAGGING_ROUNDS, stacking.BAGGING_SEED)
    return draws.groupBy("round").agg(F.sum("draws").alias("rows_drawn"))


@query("bagged_probs", f"with {_SPLIT} select vec_id, {_VALID} from test")
def bagged_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _sides(spark, sf_dir)
    net = LEARNERS(train.count())["final_net"]
    return stacking.bagged_scores(train, test, net, N_CLASSES, "vec_id").select("vec_id", *_shape())


TOLD_CLASSES = 4


def _told(rows: DataFrame) -> DataFrame:
    """The vectors with a class that they tell: the signs of their first two components."""
    sign = lambda i: (F.get("vec", i) > 0).cast("int")
    return rows.withColumn("label", 2 * sign(0) + sign(1))


_LEARNT = (
    f"select vec_id, cast(c as int) as class, true as in_range, cast(1.0 as double) as prob_total, true as learnt "
    f"from embeddings, range({TOLD_CLASSES}) t(c)"
)


def _one_model(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Fit on the train side and score every vector. ``learnt``: on the test side the log loss is below that of the
    train side's class shares."""
    train, test = (_told(side) for side in _sides(spark, sf_dir))
    score = LEARNERS(train.count())[name].fit(train, TOLD_CLASSES)
    columns = ["vec_id", "label", "features"]
    scored = stage(to_long(score(train.select(columns).unionByName(test.select(columns)))))
    truth = test.select("vec_id", "label")
    shares = train.groupBy("label").agg((F.count("*") / train.count()).alias("share"))
    by_shares = truth.join(shares, "label", "left").agg(F.avg(-F.log(F.coalesce("share", F.lit(1e-15))))).first()[0]
    learnt = log_loss(scored, truth, "vec_id").first().log_loss < by_shares
    return _checked(scored, ["vec_id"]).withColumn("learnt", F.lit(learnt))


@query("model_lr", _LEARNT)
def model_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_model(spark, sf_dir, "logistic")


@query("model_rf", _LEARNT)
def model_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_model(spark, sf_dir, "forest")


@query("model_mlp", _LEARNT)
def model_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_model(spark, sf_dir, "net")


@query("model_gbt", _LEARNT)
def model_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_model(spark, sf_dir, "boosted")


@query("model_extra_trees", _LEARNT)
def model_extra_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_model(spark, sf_dir, "extra_trees")


@query("model_adaboost", _LEARNT)
def model_adaboost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_model(spark, sf_dir, "adaboost")


# Second level on vectors.


def _second_level(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, EnsembleSpec]:
    """Stacked train and test frames of the ensemble."""
    train, test = _sides(spark, sf_dir)
    spec = SPEC(train.count())
    knn_train, knn_test = stacking.neighbor_scores(train, test, list(spec.ks), N_CLASSES, "vec_id")
    scores = {"train": knn_train, "test": knn_test}
    for learners, scale in ((spec.trees, False), (spec.nets, True)):
        inside, outside = stacking.stack_scores(train, test, learners, N_CLASSES, N_FOLDS, "vec_id", scale, parallelism=AT_ONCE)
        scores = {"train": scores["train"].unionByName(inside), "test": scores["test"].unionByName(outside)}
    sides = {"train": train, "test": test}
    return *_stack_sides(scores, sides, spec.names, spec.guide, N_CLASSES, "vec_id"), spec


def _stack_sides(scores, sides, names, guide, n_classes, key) -> tuple[DataFrame, DataFrame]:
    """Second-level frames of both sides. Distances are taken inside each side, to the
    classes the ``guide`` model predicts there."""
    near = {}
    for side, rows in sides.items():
        predicted = argmax_class(stacking.class_slice(scores[side], guide), key)
        joined = stage(rows.select(key, "vec").join(predicted, key))
        near[side] = stage(class_distances(joined, key, "best_class"))
    far = stacking.farthest(near["train"])
    out = []
    for side, rows in sides.items():
        stacked = stacking.second_level(scores[side], near[side], names, n_classes, key, far)
        out.append(stage(stacked.join(rows.select(key, "label"), key)))
    return out[0], out[1]


@query(
    "level2_matrix",
    f"with {_SPLIT}, b as (select vec_id, label, 'train' as side from train union all select vec_id, label, 'test' from test) "
    f"select vec_id, label, side, cast(15 * {N_CLASSES} + 3 * {N_CLASSES} as int) as width, cast(15.0 as double) as prob_total from b",
)
def level2_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Width and total of the probability block of every stacked row (15 models)."""
    train, test, spec = _second_level(spark, sf_dir)
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    probs = F.slice("stacked", 1, N_CLASSES * len(spec.names))
    total = F.aggregate(probs, F.lit(0.0), lambda acc, x: acc + x)
    return both.select("vec_id", "label", "side", F.size("stacked").alias("width"), F.round(total, 6).alias("prob_total"))


def _final_blend(train, test, key, n_classes, boosted, net, rounds) -> DataFrame:
    """Boosted trees on raw inputs, a bagged net on scaled ones, blended: (key, class, prob)."""
    keep = [key, "label"]
    raw_train = train.select(*keep, array_to_vector("stacked").alias("features"))
    raw_test = test.select(*keep, array_to_vector("stacked").alias("features"))
    scaler = fit_scaler(train, "stacked")
    net_train = train.select(*keep, array_to_vector(scaler.apply("stacked")).alias("features"))
    net_test = test.select(*keep, array_to_vector(scaler.apply("stacked")).alias("features"))
    by_trees = to_long(stage(boosted.fit(raw_train, n_classes)(raw_test).select(key, "probs")))
    by_net = to_long(stacking.bagged_scores(net_train, net_test, net, n_classes, key, rounds))
    return blend(by_trees, by_net, key)


@query(
    "level2_predict",
    f"with {_SPLIT} select vec_id, cast(c as int) as class, true as in_range, true as within_bound from test, range({N_CLASSES}) t(c)",
)
def level2_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blend of every test row and class; the geometric blend of two distributions sums to at most 1."""
    train, test, spec = _second_level(spark, sf_dir)
    blended = _final_blend(train, test, "vec_id", N_CLASSES, spec.final_trees, spec.final_net, spec.bagging_rounds)
    checked = _checked(stage(blended), ["vec_id"])
    within = (F.col("prob_total") > 0) & (F.col("prob_total") <= 1)
    return checked.select("vec_id", "class", "in_range", within.alias("within_bound"))


# The whole job on baskets: features, stacking, second level, blend, one row per visit.

N_TRIP_TYPES = 5


@query(
    "visit_class_probs",
    with_baskets(f"""
select distinct visit_number, cast({N_TRIP_TYPES} as int) as n_classes, true as in_range
from c where visit_day >= date '{TRAIN_BEFORE}'"""),
)
def visit_class_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = visit_submission(spark, sf_dir)
    columns = [c for c in wide.columns if c != "visit_number"]
    ok = F.forall(F.array(*columns), lambda p: (p >= 0) & (p <= 1))
    return wide.select("visit_number", F.lit(len(columns)).alias("n_classes"), ok.alias("in_range"))


@query("visit_submission")
def visit_submission(spark: SparkSession, sf_dir: str, spec_of: Callable[[int], EnsembleSpec] | None = None) -> DataFrame:
    """Blended class probabilities of every test-side visit, one column per trip type."""
    fitted = feature_model(spark, sf_dir)
    visits = visit_attributes(spark, sf_dir)
    lines = feature_lines(spark, sf_dir)
    labels = fit_dictionary(visits, "trip_type")
    coded = labels.encode(visits, "trip_type", "label").select("visit_number", "visit_day", "label")
    is_train = F.col("visit_day") < F.lit(TRAIN_BEFORE)
    key, k = "visit_number", labels.size

    # One build; the log scale follows from it. Features constant on the training side are left out of both.
    built = stage(fitted.entries(lines, visits))
    kept = fitted.varying(built.join(coded.filter(is_train), key, "left_semi"))
    width, log_width = fitted.width(), fitted.width(log=True)
    kept_log = kept + list(range(width, log_width))
    raw = stage_vectors(only_features(built, kept, width).select(key, "entries"), len(kept)).join(coded, key)
    logged = only_features(fitted.logged(built), kept_log, log_width).select(key, "entries")
    logged = stage_vectors(logged, len(kept_log)).join(coded, key)
    folds = stage(stratified_folds(raw.filter(is_train), key, "label", N_FOLDS).select(key, "fold"))
    raw = stage(raw.join(folds, key, "left"))
    logged = stage(logged.join(folds, key, "left"))
    spec = (spec_of or SPEC)(raw.filter(is_train).count())

    # Vote models and distances in the space of principal components of the log features, which stay sparse.
    pca = fit_sparse_pca(logged.filter(is_train), min(spec.components, len(kept_log)))
    space = stage(pca.transform(logged).select(key, "label", "visit_day", "fold", "vec"))
    sides = {"train": space.filter(is_train), "test": space.filter(~is_train)}
    knn_train, knn_test = stacking.neighbor_scores(sides["train"], sides["test"], list(spec.ks), k, key)
    scores = {"train": knn_train, "test": knn_test}

    # Trees on the raw features; nets and logistic regression on the log features, scaled per fold but not centred.
    for rows, learners, scale in ((raw, spec.trees, False), (logged, spec.nets, True)):
        train, test = rows.filter(is_train), rows.filter(~is_train)
        inside, outside = stacking.stack_scores(train, test, learners, k, N_FOLDS, key, scale, centre=False, parallelism=AT_ONCE)
        scores = {"train": scores["train"].unionByName(inside), "test": scores["test"].unionByName(outside)}
    stacked_train, stacked_test = _stack_sides(scores, sides, spec.names, spec.guide, k, key)
    long = _final_blend(stacked_train, stacked_test, key, k, spec.final_trees, spec.final_net, spec.bagging_rounds)
    columns = [f"TripType_{r.value}" for r in labels.table.orderBy("code").collect()]  # one per class
    return submission_frame(long, columns)
