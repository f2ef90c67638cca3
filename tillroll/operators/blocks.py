"""Training rows as numpy blocks that stay on the executors while a model goes over them many times.

A block holds some thousand rows: labels, a vector of weights per row (one for each of the fits that run at once) and
the entries of the features that differ from the background (the bin of zero, or zero itself). The blocks are written
to the shared folder once; the RDD over them is cached and can be read again after the loss of an executor.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import stage

# Rows of a block at least and at most, and bytes of it when it is spread out.
LEAST_ROWS, MOST_ROWS, BLOCK_BYTES = 256, 4096, 16 << 20
# Thresholds of a feature at most; their places are bytes.
MAX_BINS = 64
# Steps between reliable checkpoints of a state that each step rewrites.
CHECKPOINT_EVERY = 25


def mix(x: np.ndarray | int) -> np.ndarray:
    """A 64-bit mix of 64-bit numbers, the same everywhere."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draw(*parts: np.ndarray | int) -> np.ndarray:
    """Uniform numbers in [0, 1) that depend on ``parts`` (broadcast against each other) and nothing else."""
    h = mix(0)
    for part in parts:
        h = mix(h ^ mix(np.asarray(part).astype(np.uint64)))
    return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def subsets(ids: np.ndarray, n_features: int, share: float, seed: int) -> np.ndarray:
    """For each id a choice of ``ceil(share * n_features)`` features, as flags."""
    n = min(n_features, int(np.ceil(share * n_features)))
    if n == n_features:
        return np.ones((len(ids), n_features), bool)
    rank = draw(seed, np.asarray(ids, np.uint64)[:, None], np.arange(n_features)[None, :])
    out = np.zeros((len(ids), n_features), bool)
    np.put_along_axis(out, np.argpartition(rank, n - 1, axis=1)[:, :n], True, axis=1)
    return out


@dataclass
class Bins:
    """Thresholds by feature; a value's bin is the number of thresholds below it."""

    starts: np.ndarray  # first threshold of each feature, and the end
    cuts: np.ndarray
    zero: np.ndarray = field(init=False)  # the bin of 0

    def __post_init__(self) -> None:
        every = np.arange(len(self.starts) - 1)
        self.zero = self.of(every, np.zeros(len(every)))

    def of(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Bisection of all values at once, each among the thresholds of its feature."""
        low, high = self.starts[feature], self.starts[feature + 1]
        first = low
        while (open_ := low < high).any():
            middle = (low + high) // 2
            below = open_ & (self.cuts[np.minimum(middle, len(self.cuts) - 1)] < value)
            low, high = np.where(below, middle + 1, low), np.where(open_ & ~below, middle, high)
        return (low - first).astype(np.uint8)


def entries_of(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of the numbers that ML vectors in their stored form spell out."""
    indices, values = vectors.field("indices"), vectors.field("values")
    ends = values.offsets.to_numpy()
    sizes = np.diff(ends)
    row = np.repeat(np.arange(len(sizes)), sizes)
    value = values.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sparse = np.diff(indices.offsets.to_numpy()) == sizes
    dense_type = vectors.field("type").to_numpy(zero_copy_only=False) == 1
    if not dense_type.all():
        at = indices.offsets.to_numpy()[:-1][row] + place
        spelt = indices.values.to_numpy(zero_copy_only=False)
        feature = np.where(dense_type[row] | ~sparse[row], place, spelt[np.minimum(at, max(len(spelt) - 1, 0))] if len(spelt) else place)
    else:
        feature = place
    return row, feature.astype(np.int64), value


def _long(df: DataFrame, features: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, feature, value = entries_of(batch.column(0))
            real = value != 0
            yield pa.RecordBatch.from_arrays([pa.array(feature[real]), pa.array(value[real])], ["feature", "value"])

    return df.select(features).mapInArrow(run, "feature long, value double")


def fit_bins(df: DataFrame, n_features: int, features: str = "features", bins: int = MAX_BINS) -> Bins:
    """Quantiles of each feature's non-zero values, with zero apart from what is below and above it. The quantiles are
    merged sketches, one per feature; ``bins`` thresholds a feature are all that reaches the driver."""
    if not 4 <= bins <= 250:
        raise ValueError("from 4 to 250 bins")
    levels = [i / (bins - 3) for i in range(bins - 3)]
    marks = F.percentile_approx("value", levels, 4096).alias("marks")
    rows = _long(df, features).groupBy("feature").agg(marks, F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
    of = {r.feature: r for r in rows}
    starts, cuts = [0], []
    for f in range(n_features):
        own: set[float] = set()
        if f in of:
            own = {float(m) for m in of[f].marks if m < of[f].hi}
            if of[f].lo < 0:
                own.add(-5e-324)
            if of[f].hi > 0:
                own.add(0.0)
        cuts += sorted(own)
        starts.append(len(cuts))
    return Bins(np.array(starts, np.int64), np.array(cuts or [0.0], np.float64))


@dataclass
class Block:
    """``x``: a number per entry (bin or value); entries with the background are left out. ``state``: a learner's own."""

    key: np.ndarray  # uint64, tells rows apart
    label: np.ndarray
    weight: np.ndarray  # (row, fit), whole numbers
    row: np.ndarray
    feature: np.ndarray
    x: np.ndarray
    background: np.ndarray  # by feature
    state: dict = field(default_factory=dict)

    def __len__(self) -> int:
        return len(self.key)

    def spread(self) -> np.ndarray:
        """(row, feature), the background filled in."""
        out = np.repeat(self.background[None, :], len(self), axis=0)
        out[self.row, self.feature] = self.x
        return out

    def with_state(self, **state) -> Block:
        return Block(self.key, self.label, self.weight, self.row, self.feature, self.x, self.background, {**self.state, **state})


def block_of(key, label, weight, vectors: pa.Array, n_features: int, bins: Bins | None) -> Block:
    row, feature, value = entries_of(vectors)
    if bins is None:
        x, background = value, np.zeros(n_features)
    else:
        x, background = bins.of(feature, value), bins.zero
    own = x != background[feature]
    return Block(key, label, weight, row[own].astype(np.int32), feature[own].astype(np.int32), x[own], background)


def width_of(df: DataFrame, features: str = "features") -> int:
    first = df.select(features).first()
    return first[0].size if first else 0


def block_rdd(train: DataFrame, weights: list[str], n_features: int, bins: Bins | None, row_bytes: int = 0) -> tuple[RDD, int]:
    """The cached RDD of the blocks of ``train`` (label, features, weights), and the number of rows. ``row_bytes``: what a
    learner makes of a row, if that is more than the row spread out."""
    spark = train.sparkSession
    width = max(row_bytes, n_features * (8 if bins is None else 1))
    most = int(min(MOST_ROWS, max(LEAST_ROWS, BLOCK_BYTES // max(width, 1))))
    told = [c for c in train.columns if c not in weights and not c.startswith("_")]
    weight = F.array(*[F.col(w).cast("long") for w in weights]) if weights else F.array(F.lit(1).cast("long"))
    rows = stage(train.select(F.xxhash64(*told).alias("key"), F.col("label").cast("int").alias("label"), weight.alias("w"), "features"))
    n = rows.count()
    tasks = max(1, min(2 * spark.sparkContext.defaultParallelism, n // LEAST_ROWS), n // (MOST_ROWS * 64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def blocks(last: bool):
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            for at in range(0, table.num_rows, most):
                part = table.slice(at, most)
                if part.num_rows < most and not last:
                    held.extend(part.to_batches())
                    return
                part = part.to_batches()[0]
                w = part.column("w")
                fits = w.flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                key = part.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
                block = block_of(key, part.column("label").to_numpy(zero_copy_only=False), fits, part.column("features"), n_features, bins)
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], ["block"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= most:
                yield from blocks(False)
        if held:
            yield from blocks(True)

    stored = stage(rows.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(run, "block binary"))
    # One task of the staged files per part; the workers keep what they read.
    return stored.rdd.map(lambda r: pickle.loads(r[0])).persist(StorageLevel.MEMORY_AND_DISK), n


def next_state(rdd: RDD, step, number: int) -> RDD:
    """The blocks after ``step``, cached, and every so often written to the checkpoint folder to cut the lineage."""
    out = rdd.map(step).persist(StorageLevel.MEMORY_AND_DISK)
    if number % CHECKPOINT_EVERY == 0:
        out.checkpoint()
    return out
