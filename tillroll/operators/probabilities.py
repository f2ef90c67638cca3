"""Class probabilities: long form (key, model, class, prob) and per-row arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.scalar import BLEND_WEIGHTS, geometric_blend


def padded(array: Column, n_classes: int) -> Column:
    """A probability array with zeros for the classes a model never met.

    Labels are encoded once for all models, so a class keeps its position and only the end
    can be missing.
    """
    zeros = F.array_repeat(F.lit(0.0), F.greatest(F.lit(n_classes) - F.size(array), F.lit(0)))
    return F.concat(array, zeros)


def to_long(scores: DataFrame, probs: str = "probs") -> DataFrame:
    """Explode a per-row array into one row per class."""
    rest = [c for c in scores.columns if c != probs]
    return scores.select(*rest, F.posexplode(probs).alias("class", "prob"))


def to_arrays(long: DataFrame, keys: list[str], n_classes: int, klass: str = "class", prob: str = "prob") -> DataFrame:
    """One array per key with all classes in order; classes without a row get 0.

    What is collected per key is one entry per class.
    """
    as_map = F.map_from_entries(F.collect_list(F.struct(F.col(klass).cast("int"), F.col(prob))))
    aligned = F.transform(
        F.sequence(F.lit(0), F.lit(n_classes - 1)), lambda c: F.coalesce(F.element_at("_m", c), F.lit(0.0))
    )
    return long.groupBy(*keys).agg(as_map.alias("_m")).select(*keys, aligned.alias("probs"))


def align_classes(long: DataFrame, keys: list[str], n_classes: int, klass: str = "class") -> DataFrame:
    """Long form with a row for every class, 0 where the model gave none."""
    return to_long(to_arrays(long, keys, n_classes, klass)).withColumnRenamed("class", klass)


def mean_over_rounds(long: DataFrame, keys: list[str], prob: str = "prob") -> DataFrame:
    return long.groupBy(*keys).agg(F.avg(prob).alias(prob))


def argmax_class(long: DataFrame, key: str, klass: str = "class", prob: str = "prob") -> DataFrame:
    """The most probable class per row; the lowest class wins a tie."""
    best = F.max(F.struct(F.col(prob), (-F.col(klass)).alias("c")))
    return long.groupBy(key).agg(best.alias("b")).select(
        key, (-F.col("b.c")).alias("best_class"), F.col(f"b.{prob}").alias("best_prob")
    )


def blend(
    first: DataFrame,
    second: DataFrame,
    key: str,
    klass: str = "class",
    weights: tuple[float, float] = BLEND_WEIGHTS,
    normalise: bool = False,
) -> DataFrame:
    """Weighted geometric blend of two long frames, joined on row and class.

    As it stands the result does not sum to 1 per row; ``normalise`` makes it.
    """
    pair = first.select(key, klass, F.col("prob").alias("p")).join(
        second.select(key, klass, F.col("prob").alias("q")), [key, klass]
    )
    out = pair.select(key, klass, geometric_blend(F.col("p"), F.col("q"), weights).alias("prob"))
    if not normalise:
        return out
    total = F.sum("prob").over(Window.partitionBy(key))  # one row per class
    return out.withColumn("prob", F.when(total > 0, F.col("prob") / total).otherwise(0.0))


def log_loss(long: DataFrame, truth: DataFrame, key: str, klass: str = "class", floor: float = 1e-15) -> DataFrame:
    """One row: mean negative log probability of the true class. A row without a probability
    for its true class counts with the floor."""
    matched = truth.select(key, F.col("label").alias(klass)).join(long.select(key, klass, "prob"), [key, klass], "left")
    p = F.least(F.greatest(F.coalesce("prob", F.lit(0.0)), F.lit(floor)), F.lit(1 - floor))
    return matched.agg(F.avg(-F.log(p)).alias("log_loss"), F.count("*").alias("n"))
