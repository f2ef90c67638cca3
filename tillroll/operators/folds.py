"""Stratified folds and bootstrap draws as columns keyed by row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.ranking import with_position
from tillroll.session import checkpoint, lookup_join


def stratified_folds(df: DataFrame, key: str, label: str, k: int) -> DataFrame:
    """(key, label, fold): contiguous, near-equal blocks inside each label in key order.

    The same folds as ``ntile(k)`` over the label, but a label is never sorted in one task:
    positions come from one global order by (label, key), and a row's rank in its label is
    its position minus the label's first position.
    """
    ranked = with_position(df.select(key, label), label, key)
    labels = checkpoint(ranked.groupBy(label).agg(F.min("position").alias("first"), F.count("*").alias("n")))
    rows = lookup_join(ranked, labels, [label], "inner", labels.count())
    rank = F.col("position") - F.col("first")
    size = F.floor(F.col("n") / k)
    longer = F.col("n") % k  # the first n mod k folds hold one row more
    in_longer = longer * (size + 1)
    fold = F.when(rank < in_longer, F.floor(rank / (size + 1))).otherwise(
        longer + F.floor((rank - in_longer) / F.greatest(size, F.lit(1)))
    )
    return rows.select(key, label, fold.cast("int").alias("fold"))


def bootstrap_draws(df: DataFrame, key: str, rounds: int, seed: int) -> DataFrame:
    """(round, key, draws): N draws with replacement out of N rows, per round.

    Each draw picks a position by a seeded hash, so reruns agree whatever the partitioning.
    Draws are counted per position before they meet the rows.
    """
    rows = with_position(df.select(key), key)
    n = rows.count()
    draws = df.sparkSession.range(n * rounds).select(
        F.floor(F.col("id") / n).cast("int").alias("round"),
        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n)).alias("position"),
    )
    counted = draws.groupBy("round", "position").agg(F.count("*").cast("int").alias("draws"))
    return rows.join(counted, "position").select("round", key, "draws")
