"""Arrow batches of bounded size between Spark and the numpy parts of the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.session import stage

# Rows and bytes of one Arrow batch; one row may be larger than the bytes.
ROWS = 1024
BYTES = 16 << 20

Batches = Iterator[pa.RecordBatch]


def map_batches(df: DataFrame, fn: Callable[[Batches], Batches], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with small batches (sets the session's Arrow batch limits)."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES))
    return df.mapInArrow(fn, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column's strings, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def batch_of(**columns: object) -> pa.RecordBatch:
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def keep_batches(docs: DataFrame, keep: Callable[[list[str]], np.ndarray], text: str = "text") -> DataFrame:
    """The rows, all columns as they are, for whose texts ``keep`` says true."""
    at = docs.columns.index(text)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep(texts), pa.bool_()))

    return map_batches(docs, run, docs.schema)


def learnable(doc_id: str = "doc_id"):
    """Column: may the row's label be learnt from? (crc32 of the id as text, mod 4, is not 2)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 != 2, F.lit(False))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def sampled(rows: DataFrame, label: str, bound: int) -> DataFrame:
    """``rows`` (doc_id, text, label, ...) with n: the first ``bound`` of each label in hash order of id and text.

    Rows of equal id and text count once. A hash limit from each label's approximate number of them leaves a little
    more than ``bound`` before they are ranked, so no task ranks more; the numbers are one row per label.
    """
    keyed = rows.withColumn("sample_key", F.xxhash64("doc_id", "text"))
    keys = stage(keyed.select(label, "sample_key"))  # texts are read once for this, and once for the sample itself
    counts = keys.groupBy(label).agg(F.approx_count_distinct("sample_key", 0.01).alias("rows_of_label"))
    place = F.col("sample_key").cast("double") / F.lit(2.0**64) + 0.5
    few = keys.join(F.broadcast(counts), label)
    few = few.where(place * F.col("rows_of_label") <= 1.25 * bound + 200).select(label, "sample_key").distinct()
    order = Window.partitionBy(label).orderBy("sample_key")
    few = few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= bound)
    # Bounded by ``bound`` times the labels.
    return keyed.join(F.broadcast(few), [label, "sample_key"]).dropDuplicates([label, "sample_key"]).drop("sample_key")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Newton's method for logistic regression; the first weight is the intercept.

    With one class only, the intercept alone says the smoothed share.
    """
    w = np.zeros(x.shape[1] + 1)
    n = len(y)
    share = (y.sum() + 0.5) / (n + 1.0) if n else 0.0
    if n == 0 or y.min() == y.max():
        w[0] = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return w
    a = np.hstack([np.ones((n, 1)), x])
    penalty = ridge * np.ones(a.shape[1])
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(hessian, a.T @ (p - y) + penalty * w)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

