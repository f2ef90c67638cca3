"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

A logistic function of whole-text measures gives each document's own evidence. Evidence (the label where it may be
learnt, else the classifier's probability) is added up per path and host. A host's rate is shrunk toward the global
rate and a path's toward its host's, each with a strength that the method of moments takes from the spread between
sites, and without the document's own share. The document's log odds are shifted by its path's log odds against the
global ones.

Defined results: null text is empty text; null host and path are a site of their own. Repeated rows count as often as
they occur; a document with several labels is good if one says so. Without labels the classifier says 1/2. An empty
table gives no rows. Columns besides id, text, host and path are ignored.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import Batches, batch_of, learnable, logistic, map_batches, sigmoid, texts_of
from tillroll.llm.toxicity import labelled_sample
from tillroll.session import lookup_join, stage

# Bound of the fitted sample: labelled rows of each label, in hash order of the id.
ROWS_PER_LABEL = 3000
KEEP = 0.5
# Strength of a prior at most and at least, in documents.
STRENGTHS = (1.0, 1e6)

_KIND = np.zeros(256, np.uint8)  # other bytes, letters included
for _number, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#$%&*+<=>@^_`~{}[]\\", b"|", b"!?", b".,;:", b"\n"), 1):
    _KIND[list(_bytes)] = _number
FEATURES = 15


def measures(text: str) -> list[float]:
    """Shares of kinds of characters, repetition, word shape and length of a whole text."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    words = text.split()
    n = max(len(words), 1)
    kinds = np.bincount(_KIND[raw], minlength=8)[1:] / max(len(raw), 1)
    lines = text.split("\n")
    return [
        *np.sqrt(kinds).tolist(),
        sum(map(operator.eq, words, words[1:])) / n,
        len(set(words)) / n,
        len(set(lines)) / len(lines),
        float(np.log1p(len(words))),
        len(text) / n / 10,
        sum(w.isupper() for w in words) / n,
        float(not words),
        float(len(words) < 20),
    ]


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def probabilities(self, texts: list[str]) -> np.ndarray:
        x = np.array([measures(t) for t in texts]).reshape(len(texts), FEATURES)
        return sigmoid(self.weights[0] + ((x - self.mean) / self.scale) @ self.weights[1:])


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Logistic regression on a bounded sample of learnable labelled rows."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
    sample = labelled_sample(docs, known, "quality", ROWS_PER_LABEL)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = [measures(t) for t in texts_of(batch)]
            yield batch_of(x=pa.array(x, pa.list_(pa.float64())), y=batch.column("y"))

    # Bounded by the sample: FEATURES numbers a row.
    rows = map_batches(sample.select("text", F.col("y").cast("int").alias("y")), run, "x array<double>, y int").collect()
    rows.sort(key=lambda r: (r.y, r.x))
    if not rows:
        return QualityModel(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES + 1))
    x, y = np.array([r.x for r in rows]), np.array([float(r.y > 0) for r in rows])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    return QualityModel(mean, scale, logistic((x - mean) / scale, y, ridge=1.0))


def evidence(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, host, path, own) of each row; ``own`` is the classifier's probability of good quality."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield batch_of(doc_id=batch.column("doc_id"), host=batch.column("host"), path=batch.column("path"), own=model.probabilities(texts_of(batch)))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("host").cast("string").alias("host"), F.col("path").cast("string").alias("path"), "text")
    return map_batches(rows, run, "doc_id long, host string, path string, own double")


def _strength(rates: DataFrame, center: str) -> float:
    """Documents that a prior is worth: method of moments over sites (n, s) around ``center``."""
    n, rate, mean = F.col("n"), F.col("s") / F.col("n"), F.col(center)
    row = rates.agg(
        F.sum(n).alias("n"),
        F.sum(n * (rate - mean) * (rate - mean)).alias("spread"),
        F.sum(mean * (1 - mean)).alias("noise"),
        F.sum(n * mean * (1 - mean)).alias("inside"),
    ).first()
    if not row.n or not row.inside:
        return STRENGTHS[1]
    between = max((row.spread - row.noise) / row.n, 0.0)
    return float(np.clip(row.inside / row.n / between - 1, *STRENGTHS)) if between > 0 else STRENGTHS[1]


def classify(docs: DataFrame, labels: DataFrame, model: QualityModel) -> DataFrame:
    """One row per input row: doc_id, own, site (posterior rate of its path), score, keep.

    ``docs`` has doc_id, host, path and text.
    """
    known = labels.where(learnable()).groupBy("doc_id").agg(F.max(F.col("quality").cast("double")).alias("label"))
    rows = evidence(docs, model).join(known, "doc_id", "left").withColumn("e", F.coalesce("label", "own"))
    rows = stage(rows.na.fill("", ["host", "path"]).select("doc_id", "host", "path", "own", "e"))
    paths = rows.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), F.sum("e").alias("s"))
    paths = stage(paths)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s")).first()
    rate = (total.s + 0.5) / (total.n + 1) if total.n else 0.5
    strong_host = _strength(hosts.select(F.col("hn").alias("n"), F.col("hs").alias("s"), F.lit(rate).alias("center")), "center")
    host_rate = (F.col("hs") + strong_host * rate) / (F.col("hn") + strong_host)
    sites = paths.join(hosts, "host")
    strong_path = _strength(sites.select("n", "s", host_rate.alias("center")), "center")
    # A site with a large part of all rows meets its one row in many tasks.
    sites = stage(sites)
    out = lookup_join(rows, sites, ["host", "path"], "inner", sites.count())
    others_host = (F.col("hs") - F.col("e") + strong_host * rate) / (F.col("hn") - 1 + strong_host)
    site = (F.col("s") - F.col("e") + strong_path * others_host) / (F.col("n") - 1 + strong_path)
    bounded = lambda c: F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), c))
    odds = lambda c: F.log(bounded(c) / (1 - bounded(c)))
    out = out.withColumn("site", site)
    out = out.withColumn("score", 1 / (1 + F.exp(-(odds(F.col("own")) + odds(F.col("site")) - odds(F.lit(rate))))))
    return out.select("doc_id", "own", "site", "score", (F.col("score") >= KEEP).alias("keep"))
