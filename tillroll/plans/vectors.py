"""Queries on vectors: scaling, neighbours, votes, class distances, folds, probabilities."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.scalar import euclidean
from tillroll.operators import ensemble, probabilities
from tillroll.operators.folds import stratified_folds
from tillroll.operators.neighbors import class_distances as distances_by_class
from tillroll.operators.neighbors import nearest, nearest_approx, vote_shares
from tillroll.operators.scaling import fit_pca, fit_scaler
from tillroll.plans.registry import query
from tillroll.session import stage
from tillroll.sources.star import vectors

# Fixed value: the number of folds.
N_FOLDS = 3
VOTE_KS = list(ensemble.VOTE_KS)
HOLDOUT_PARTS = 5  # the last of this many stratified blocks is the test side
N_CLASSES = 10


def split_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with ``side`` (train or test) and ``fold`` (train side only)."""
    rows = vectors(spark, sf_dir)
    blocks = stratified_folds(rows, "vec_id", "label", HOLDOUT_PARTS)
    is_test = F.col("fold") == HOLDOUT_PARTS - 1
    train = stratified_folds(blocks.filter(~is_test), "vec_id", "label", N_FOLDS).select("vec_id", "fold")
    placed = (
        rows.join(blocks.select("vec_id", is_test.alias("is_test")), "vec_id")
        .join(train, "vec_id", "left")
        .select("*", F.when(F.col("is_test"), "test").otherwise("train").alias("side"))
    )
    return stage(placed.drop("is_test"))


_SPLIT = f"""
blocks as (select vec_id, label, embedding::double[] as vec,
  ntile({HOLDOUT_PARTS}) over (partition by label order by vec_id) - 1 as block from embeddings),
test as (select vec_id, label, vec from blocks where block = {HOLDOUT_PARTS - 1}),
train as (select vec_id, label, vec, cast(ntile({N_FOLDS}) over (partition by label order by vec_id) - 1 as int) as fold
  from blocks where block < {HOLDOUT_PARTS - 1})"""

_RANKED = (
    _SPLIT
    + """,
pairs as (
  select 'train' as side, a.vec_id as qid, b.vec_id as rid, b.label, list_distance(a.vec, b.vec) as dist
  from train a join train b on a.fold <> b.fold
  union all
  select 'test', a.vec_id, b.vec_id, b.label, list_distance(a.vec, b.vec) from test a, train b
),
ranked as (select *, row_number() over (partition by qid order by dist, rid) as r from pairs)"""
)
_VOTES = (
    _RANKED
    + f""",
ks as (select unnest({VOTE_KS}) as k),
votes as (select side, qid, k, label, count(*) / k as prob from ranked, ks where r <= k group by side, qid, k, label)"""
)


def votes(spark: SparkSession, sf_dir: str, ks: list[int] = VOTE_KS) -> DataFrame:
    """(side, qid, k, label, prob): train rows vote among the other folds, test rows among
    all train rows. One search with the largest k serves every k."""
    rows = split_vectors(spark, sf_dir)
    train, test = (rows.filter(F.col("side") == s) for s in ("train", "test"))
    inside = nearest(train, train, max(ks), "vec_id", label="label", mode="other", part="fold")
    outside = nearest(test, train, max(ks), "vec_id", label="label")
    return (
        vote_shares(inside, ks)
        .withColumn("side", F.lit("train"))
        .unionByName(vote_shares(outside, ks).withColumn("side", F.lit("test")))
    )


@query(
    "standardize",
    f"""with {_SPLIT},
long as (select vec_id, unnest(range(len(vec))) as dim, unnest(vec) as v from blocks),
stats as (select dim, avg(v) as m, stddev_pop(v) as s from long where vec_id in (select vec_id from train) group by dim)
select vec_id, cast(dim as int) as dim, round((v - m) / case when s = 0 then 1 else s end, 4) as z
from long join stats using (dim)""",
)
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the train side, applied to all vectors."""
    rows = split_vectors(spark, sf_dir)
    scaled = fit_scaler(rows.filter(F.col("side") == "train")).transform(rows)
    return scaled.select("vec_id", F.posexplode("vec").alias("dim", "z")).withColumn("z", F.round("z", 4))


@query(
    "pca_project",
    f"""with {_SPLIT} select vec_id, cast(c as int) as component, true as descending, true as uncorrelated
from blocks, range(least(100, (select max(len(vec)) from blocks))) t(c)""",
)
def pca_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on 100 components (all, if fewer). On the fitted side their variances descend and no two are
    correlated, to 4 digits."""
    rows = split_vectors(spark, sf_dir)
    is_train = F.col("side") == "train"
    train = rows.filter(is_train)
    scaler = fit_scaler(train)
    components = min(100, len(scaler.mean))
    projected = stage(fit_pca(scaler.transform(train), components).transform(scaler.transform(rows)))
    fitted = projected.filter(is_train).select(array_to_vector("vec").alias("v"))
    spread = fitted.select(Summarizer.variance(F.col("v")).alias("s")).first().s.toArray()
    apart = np.abs(Correlation.corr(fitted, "v").first()[0].toArray() - np.eye(components)).max(axis=1) < 1e-4
    descending = np.concatenate([[True], spread[1:] <= spread[:-1]])
    flags = F.array(*[F.struct(F.lit(bool(d)).alias("d"), F.lit(bool(a)).alias("a")) for d, a in zip(descending, apart)])
    long = projected.select("vec_id", F.posexplode("vec").alias("component", "value"))
    flag = F.get(flags, "component")
    return long.select("vec_id", "component", flag["d"].alias("descending"), flag["a"].alias("uncorrelated"))


@query(
    "pca_rotation_norms",
    """with long as (select vec_id, unnest(range(len(embedding))) as dim, unnest(embedding::double[]) as v from embeddings),
stats as (select dim, avg(v) as m, stddev_pop(v) as s from long group by dim)
select vec_id, round(sum(((v - m) / s) * ((v - m) / s)), 4) as norm2 from long join stats using (dim) group by vec_id""",
)
def pca_rotation_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With all components kept the projection is a rotation: norms must not change."""
    rows = vectors(spark, sf_dir)
    scaled = fit_scaler(rows).transform(rows)
    rotated = fit_pca(scaled, len(rows.first().vec)).transform(scaled)
    norm2 = F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x)
    return rotated.select("vec_id", F.round(norm2, 4).alias("norm2"))


_TOP = """with p as (
  select a.vec_id as qid, b.vec_id as rid, list_distance(a.embedding::double[], b.embedding::double[]) as dist
  from embeddings a, embeddings b
),
r as (select *, cast(row_number() over (partition by qid order by dist, rid) as int) as rank from p)
"""


@query("knn_topk", _TOP + "select qid, rid, rank, round(dist, 4) as dist from r where rank <= 10")
def knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(spark, sf_dir)
    return nearest(rows, rows, 10, "vec_id").select("qid", "rid", "rank", F.round("dist", 4).alias("dist"))


@query("knn_topk_cells", _TOP + "select qid, rid, rank, round(dist, 4) as dist from r where rank <= 10")
def knn_topk_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``knn_topk`` with small blocks: many cells, searched in two rounds."""
    rows = vectors(spark, sf_dir)
    return nearest(rows, rows, 10, "vec_id", block_rows=64).select("qid", "rid", "rank", F.round("dist", 4).alias("dist"))


@query(
    "knn_approx_recall",
    "select count(*) * least(10, count(*)) as rows_found, true as recall_reached, true as exact_distances from embeddings",
)
def knn_approx_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approximate search of all vectors in cells of 32 rows: at least 0.9 of the 10 nearest, with exact distances."""
    rows = vectors(spark, sf_dir)
    near = stage(nearest_approx(rows, rows, 10, "vec_id", cell_rows=32, block_rows=512))
    exact = nearest(rows, rows, 10, "vec_id").select("qid", "rid", F.col("dist").alias("true_dist"))
    both = near.join(exact, ["qid", "rid"], "left")
    off = F.coalesce(F.max(F.abs(F.col("dist") - F.col("true_dist"))), F.lit(0.0))
    return both.agg(
        F.count("*").alias("rows_found"),
        (F.count("true_dist") >= 0.9 * F.count("*")).alias("recall_reached"),
        (off < 1e-9).alias("exact_distances"),
    )


@query("vector_distance", _TOP + "select qid, rid, round(dist, 4) as dist from r where rank <= 3")
def vector_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the 3 nearest pairs, measured again as a column expression."""
    rows = vectors(spark, sf_dir).select("vec_id", "vec")
    pairs = nearest(rows, rows, 3, "vec_id").select("qid", "rid")
    left = rows.withColumnsRenamed({"vec_id": "qid", "vec": "a"})
    right = rows.withColumnsRenamed({"vec_id": "rid", "vec": "b"})
    measured = pairs.join(left, "qid").join(right, "rid")
    return measured.select("qid", "rid", F.round(euclidean(F.col("a"), F.col("b")), 4).alias("dist"))


@query(
    "knn_vote",
    f"with {_VOTES} select side, qid, cast(k as int) as k, label, round(prob, 6) as prob from votes",
)
def knn_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes(spark, sf_dir).withColumn("prob", F.round("prob", 6))


@query(
    "class_distances",
    """with p as (
  select a.vec_id as qid, b.vec_id as rid, b.label as klass,
    list_distance(a.embedding::double[], b.embedding::double[]) as dist from embeddings a, embeddings b
),
r as (select *, row_number() over (partition by qid, klass order by dist, rid) as rank from p)
select qid, klass, round(sum(dist) filter (where rank <= 1), 4) as d1, round(sum(dist) filter (where rank <= 3), 4) as d3,
  round(sum(dist), 4) as d5, cast(count(*) as int) as members
from r where rank <= 5 group by 1, 2""",
)
def class_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = distances_by_class(vectors(spark, sf_dir), "vec_id", "label")
    return found.withColumns({c: F.round(c, 4) for c in ("d1", "d3", "d5")})


@query(
    "strat_folds",
    f"""select vec_id, label, cast(ntile({N_FOLDS}) over (partition by label order by vec_id) - 1 as int) as fold
from embeddings""",
)
def strat_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_folds(vectors(spark, sf_dir), "vec_id", "label", N_FOLDS)


@query(
    "visit_folds",
    f"""select o_orderkey as visit_number, o_orderpriority as trip_type,
  cast(ntile({N_FOLDS}) over (partition by o_orderpriority order by o_orderkey) - 1 as int) as fold from orders""",
)
def visit_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillroll.sources.star import visit_attributes

    return stratified_folds(visit_attributes(spark, sf_dir), "visit_number", "trip_type", N_FOLDS)


# Probabilities, from votes at fixed k.


def _model(spark: SparkSession, sf_dir: str, *ks: int) -> DataFrame:
    return votes(spark, sf_dir, list(ks)).withColumnRenamed("label", "class")


_ALIGNED = (
    _VOTES
    + f""",
every as (select distinct side, qid, k, cast(c as int) as label from votes, (select unnest(range({N_CLASSES})) as c)),
aligned as (
  select e.side, e.qid, e.k, e.label, coalesce(v.prob, 0.0) as prob
  from every e left join votes v on v.qid = e.qid and v.k = e.k and v.label = e.label
)"""
)


def _aligned(spark: SparkSession, sf_dir: str, *ks: int) -> DataFrame:
    return probabilities.align_classes(_model(spark, sf_dir, *ks), ["side", "qid", "k"], N_CLASSES)


@query(
    "align_classes",
    f"""with {_ALIGNED} select side, qid, cast(k as int) as k, label as class, round(prob, 6) as prob
from aligned where k = 10""",
)
def align_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aligned(spark, sf_dir, 10).withColumn("prob", F.round("prob", 6))


@query(
    "bag_mean",
    f"""with {_ALIGNED} select side, qid, label as class, round(avg(prob), 6) as prob
from aligned where k in (10, 20, 40) group by 1, 2, 3""",
)
def bag_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean over rounds, the rounds being votes at three k."""
    mean = probabilities.mean_over_rounds(_aligned(spark, sf_dir, 10, 20, 40), ["side", "qid", "class"])
    return mean.withColumn("prob", F.round("prob", 6))


@query(
    "argmax_class",
    f"""with {_VOTES} select qid, label as best_class, round(prob, 6) as best_prob from (
  select *, row_number() over (partition by qid order by prob desc, label) as n from votes where k = 20) where n = 1""",
)
def argmax_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = probabilities.argmax_class(_model(spark, sf_dir, 20), "qid")
    return best.withColumn("best_prob", F.round("best_prob", 6))


_BLEND = (
    _ALIGNED
    + """,
blended as (
  select a.qid, a.label as class, pow(a.prob, 0.784) * pow(b.prob, 0.216) as prob
  from aligned a join aligned b on a.qid = b.qid and a.label = b.label where a.k = 20 and b.k = 80
)"""
)


def _blended(spark: SparkSession, sf_dir: str, normalise: bool) -> DataFrame:
    both = stage(_aligned(spark, sf_dir, 20, 80))
    first, second = (both.filter(F.col("k") == k) for k in (20, 80))
    return probabilities.blend(first, second, "qid", normalise=normalise)


@query("blend_geometric", f"with {_BLEND} select qid, class, round(prob, 6) as prob from blended")
def blend_geometric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blended(spark, sf_dir, normalise=False).withColumn("prob", F.round("prob", 6))


@query(
    "blend_normalised",
    f"""with {_BLEND} select qid, class,
  round(case when sum(prob) over (partition by qid) > 0 then prob / sum(prob) over (partition by qid) else 0.0 end, 6)
  as prob from blended""",
)
def blend_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blended(spark, sf_dir, normalise=True).withColumn("prob", F.round("prob", 6))


@query(
    "log_loss",
    f"""with {_VOTES},
t as (select vec_id as qid, label from embeddings)
select round(avg(-ln(least(greatest(coalesce(v.prob, 0.0), 1e-15), 1 - 1e-15))), 6) as log_loss, count(*) as n
from t left join votes v on v.qid = t.qid and v.label = t.label and v.k = 40""",
)
def log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = vectors(spark, sf_dir).select(F.col("vec_id").alias("qid"), "label")
    return probabilities.log_loss(_model(spark, sf_dir, 40), truth, "qid").withColumn(
        "log_loss", F.round("log_loss", 6)
    )


_TEMPLATE = [f"class_{i}" for i in range(N_CLASSES)]


@query(
    "submission_pivot",
    f"with {_VOTES} select qid as visit_number, "
    + ", ".join(f"round(coalesce(max(prob) filter (where label = {i}), 0.0), 6) as class_{i}" for i in range(N_CLASSES))
    + " from votes where k = 10 and side = 'test' group by 1",
)
def submission_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-side probabilities, one row per key and one column per class."""
    from tillroll.sources.submission import submission_frame

    test = _model(spark, sf_dir, 10).filter(F.col("side") == "test").withColumnRenamed("qid", "visit_number")
    wide = submission_frame(test, _TEMPLATE)
    return wide.select("visit_number", *[F.round(c, 6).alias(c) for c in _TEMPLATE])
