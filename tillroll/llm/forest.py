"""Approximate nearest neighbours in a hash-prefix forest.

Each tree is a sorted array of long hash strings (signs of random projections, first bit foremost). A query descends
to its longest common prefix in every tree, then all trees ascend together, one bit at a time, until the entries below
the common prefix hold enough distinct rows: ``k`` that can be results, ``LEAST`` and the share ``SHARE`` of the shard, the
query's own row not counted. Their exact distances decide, so shards of up to ``LEAST`` rows are searched exactly. The
rows of each dimension are dealt over shards by a hash of the vector; a forest is built of each shard, and every query
visits every shard of its dimension, in blocks. The best of all shards are merged.

Defined results: null, empty and zero vectors and vectors with null or non-finite components take no part, nor do
null ids. Equal rows count once. Of copies of a vector only the ``k`` + 1 smallest ids can be results, so no more are
indexed, which loses none. Vectors are compared with those of their own dimension. Ties go to the smaller id. Other
columns are ignored; without queries or candidates the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import stage

TREES = 64
STRING = 24
SHARE = 0.6
LEAST = 1024
SHARD_ROWS = 8192
QUERY_ROWS = 2048
SEED = 5
# Bound of the rows whose mean is the projections' origin.
SAMPLE_ROWS = 5000


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Distinct (vec_id, vector) rows that take part."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.where(finite & F.exists("vector", lambda x: x != 0)).distinct()


class Forest:
    """Sorted hash strings of the rows of one shard."""

    def __init__(self, x: np.ndarray, origin: np.ndarray, trees: int = TREES, bits: int = STRING) -> None:
        rng = np.random.default_rng(SEED)
        self.x, self.origin, self.trees, self.bits = x, origin, trees, bits
        self.planes = rng.normal(size=(x.shape[1], trees * bits))
        strings = self._strings(x)
        self.order = np.argsort(strings, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(strings, self.order.T, axis=0).T.copy()

    def _strings(self, x: np.ndarray) -> np.ndarray:
        """(rows x trees) hash strings as integers."""
        out = np.zeros((len(x), self.trees), np.int64)
        for at in range(0, len(x), 4096):
            signs = ((x[at : at + 4096] - self.origin) @ self.planes > 0).reshape(-1, self.trees, self.bits)
            out[at : at + 4096] = signs @ (1 << np.arange(self.bits - 1, -1, -1))
        return out

    def candidates(self, queries: np.ndarray, need: np.ndarray):
        """The row numbers that each query compares with: at least ``need`` distinct ones, or all."""
        strings, n = self._strings(queries), len(self.x)
        near = np.zeros((len(queries), n), bool)
        near[need >= n] = True
        todo = np.flatnonzero(need < n)
        for depth in range(self.bits, -1, -1):  # ascend from whole strings
            if not len(todo):
                break
            rest = self.bits - depth
            head = strings[todo] >> rest << rest
            low, high = np.zeros((2, len(todo), self.trees), np.int64)
            for t in range(self.trees):
                low[:, t] = np.searchsorted(self.sorted[t], head[:, t])
                high[:, t] = np.searchsorted(self.sorted[t], head[:, t] + (1 << rest))
            left = np.ones(len(todo), bool)
            for i in np.flatnonzero((high - low).sum(axis=1) >= need[todo]):  # fewer hits cannot be enough rows
                mask = near[todo[i]]
                for t in range(self.trees):
                    mask[self.order[t, low[i, t] : high[i, t]]] = True
                left[i] = mask.sum() < need[todo[i]]
            todo = todo[left]
        for mask in near:
            yield np.flatnonzero(mask)


def best(index: pa.Table, queries: pa.Table, origin: dict[int, np.ndarray], k: int) -> pa.Table:
    """The k nearest of the shard for each query of the block."""
    empty = {"query_id": pa.array([], pa.int64()), "query_key": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
    if not index.num_rows or not queries.num_rows:
        return pa.table(empty)
    matrix = lambda t: t.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
    x, q = matrix(index), matrix(queries)
    ids = index.column("ids").combine_chunks()
    starts, members = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
    forest = Forest(x, origin.get(x.shape[1], x.mean(axis=0)))
    names, keys = queries.column("vec_id").to_numpy(), queries.column("query_key").to_numpy()
    out: list[list[np.ndarray]] = [[], [], [], []]
    # Rows that hold no other id than the query's cannot be results; its own row, at most one, is not counted either.
    only, times = np.unique(members[starts[:-1]][np.diff(starts) == 1], return_counts=True)
    at = np.minimum(np.searchsorted(only, names), max(len(only) - 1, 0))
    barren = np.where(only[at] == names, times[at], 0) if len(only) else np.zeros(len(names), np.int64)
    need = np.maximum(max(k, LEAST, int(np.ceil(SHARE * len(x)))) + 1, k + barren)
    for i, rows in enumerate(forest.candidates(q, need)):
        distance = np.sqrt(((x[rows] - q[i]) ** 2).sum(axis=1))
        if len(rows) > (least := k + barren[i]):
            limit = np.partition(distance, least - 1)[least - 1]
            rows, distance = rows[distance <= limit], distance[distance <= limit]
        sizes = starts[rows + 1] - starts[rows]
        own = np.concatenate([members[starts[r] : starts[r + 1]] for r in rows]) if len(rows) else np.zeros(0, np.int64)
        distance = np.repeat(distance, sizes)
        own, distance = own[own != names[i]], distance[own != names[i]]
        top = np.lexsort((own, distance))[:k]
        for column, value in zip(out, (np.full(len(top), names[i]), np.full(len(top), keys[i]), own[top], distance[top])):
            column.append(value)
    return pa.table({c: pa.array(np.concatenate(v)) for c, v in zip(empty, out)})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, itself left out."""
    rows, asked = usable(vectors, vec_id, embedding), usable(queries, vec_id, embedding)
    copies = Window.partitionBy("vector").orderBy("vec_id")
    index = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    index = stage(index.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    asked = stage(asked.withColumn("query_key", F.xxhash64("vector")))
    shards = stage(index.groupBy(F.size("vector").alias("dim")).agg(F.ceil(F.count("*") / SHARD_ROWS).alias("shards")))
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    sample = index.orderBy(F.xxhash64("vector")).limit(SAMPLE_ROWS).select("vector").collect()
    found: dict[int, list] = {}
    for r in sample:
        found.setdefault(len(r.vector), []).append(r.vector)
    origin = {d: np.mean(v, axis=0) for d, v in found.items()}
    dealt = index.withColumn("dim", F.size("vector")).join(shards, "dim").select(
        "dim", F.pmod(F.xxhash64("vector"), F.col("shards")).alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vector", "ids",
    )
    sent = asked.withColumn("dim", F.size("vector")).join(shards, "dim").select(
        "dim", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"),
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), "vector", "vec_id", "query_key",
    )
    key = ["dim", "shard", "block"]
    near = dealt.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(
        lambda left, right: best(left, right, origin, k), "query_id long, query_key long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
