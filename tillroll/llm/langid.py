"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by SGD in numpy.

Subwords are letter n-grams (1 to 3, with word edges) of the lower-cased text, hashed to ``BUCKETS`` rows of an
embedding table. A text is the mean of its rows; a softmax over the languages follows. A part of the fitted sample
is kept back to set the softmax temperature and the score under which a prediction is rejected.

Defined results: null text and text without letters give ``und``, score 0, rejected. Empty input gives an empty
result; with nothing to learn from every text is ``und``. Rows are independent of each other, so repeated rows give
repeated results; columns other than the id, the text and (for learning) the language are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import Batches, batch_of, keep_batches, map_batches, sampled, texts_of

BUCKETS = 1 << 14
DIM = 16
ORDERS = (1, 2, 3)
# Bound of the fitted sample: rows of each language, taken in hash order of the id.
ROWS_PER_LANGUAGE = 300
EPOCHS = 10
RATE = 2.0
# Times RATE: a row of the table sees only its share of a text.
EMBEDDING_RATE = 10.0
BATCH = 32
SEED = 7
# A rejected score is at most this, however sure the kept-back rows are.
REJECT_MOST = 0.5
# Characters handled at once.
SLICE = 1 << 20
UNKNOWN = "und"

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """Code point to its lower-case letter, 0 for all that is no letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.array([ord(c.lower()[0]) if c.isalpha() else 0 for c in map(chr, range(0x110000))], np.uint32)
    return _LETTERS


def _parts(texts: list[str]):
    """(text numbers, strings) groups of about SLICE characters; a longer text is cut where a word ends, if one does."""
    owners, parts, size = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while at < max(len(text), 1):
            end = at + SLICE
            if end < len(text):
                # Between two characters of which one is no letter a cut changes nothing.
                back = next((e for e in range(end, at, -1) if not (text[e].isalpha() and text[e - 1].isalpha())), None)
                end = back or next((e for e in range(end, len(text)) if not (text[e].isalpha() and text[e - 1].isalpha())), len(text))
            part = text[at:end]
            at = max(end, at + 1)
            owners.append(i)
            parts.append(part)
            size += len(part)
            if size >= SLICE:
                yield owners, parts
                owners, parts, size = [], [], 0
    if parts:
        yield owners, parts


def subwords(parts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Starts of the parts in a joined array, and for each order the bucket at each place (BUCKETS: no subword)."""
    joined = "\n" + "\n".join(parts) + "\n\n"
    code = letters()[np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)].astype(np.uint64)
    starts = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])[:-1]]).astype(np.int64)
    n = len(code) - 2
    a, b, c = code[:n], code[1 : n + 1], code[2 : n + 2]
    return starts, [
        _bucket(a, 1, a != 0),
        _bucket(a * np.uint64(0x1000193) + b, 2, (a != 0) | (b != 0)),
        _bucket((a * np.uint64(0x1000193) + b) * np.uint64(0x10000F9) + c, 3, (b != 0) & ((a != 0) | (c != 0))),
    ]


def _bucket(value: np.ndarray, order: int, valid: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        hashed = (value + np.uint64(order << 56)) * _GOLD
    return np.where(valid, (hashed >> np.uint64(50)).astype(np.int32), BUCKETS)


def count_subwords(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their counts."""
    total = np.zeros(BUCKETS + 1, np.int64)
    for _, parts in _parts([text]):
        for buckets in subwords(parts)[1]:
            total += np.bincount(buckets, minlength=BUCKETS + 1)
    ids = np.flatnonzero(total[:BUCKETS])
    return ids, total[ids]


@dataclass
class LanguageModel:
    labels: list[str]
    table: np.ndarray  # BUCKETS + 1 rows (the last is zero) x languages: embedding times softmax weights
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def probabilities(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x languages) probabilities, and how many subwords each text has."""
        k = len(self.labels)
        logits, found = np.zeros((len(texts), k)), np.zeros(len(texts), np.int64)
        for owners, parts in _parts(texts):
            starts, orders = subwords(parts)
            for buckets in orders:
                np.add.at(logits, owners, np.add.reduceat(self.table[buckets], starts, axis=0, dtype=np.float64))
                np.add.at(found, owners, np.add.reduceat(buckets != BUCKETS, starts, dtype=np.int64))
        return softmax((logits / np.maximum(found, 1)[:, None] + self.bias) / self.temperature), found

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        if not self.labels:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        p, found = self.probabilities(texts)
        best = p.argmax(axis=1) if len(texts) else np.zeros(0, int)
        score = np.where(found > 0, p[np.arange(len(texts)), best], 0.0)
        names = [self.labels[i] if f else UNKNOWN for i, f in zip(best, found)]
        return names, score, (found == 0) | (score < self.reject_below)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], names: list[str]) -> LanguageModel:
    """SGD over (buckets, counts) rows; a fifth of them sets temperature and rejection."""
    labels = sorted(set(names))
    if not labels:
        return LanguageModel([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0))
    target = np.searchsorted(labels, names)
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(rows))
    kept, fitted = (order[: len(rows) // 5], order[len(rows) // 5 :]) if len(rows) >= 25 else (order, order)
    k = len(labels)
    emb, out, bias = rng.normal(0, 0.1, (BUCKETS, DIM)), rng.normal(0, 0.3, (DIM, k)), np.zeros(k)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for some in np.array_split(rng.permutation(fitted), max(1, len(fitted) // BATCH)):
            x = np.zeros((len(some), BUCKETS), np.float32)
            for i, r in enumerate(some):
                ids, counts = rows[r]
                x[i, ids] = counts / counts.sum()
            vec = x @ emb
            grad = softmax(vec @ out + bias)
            grad[np.arange(len(some)), target[some]] -= 1
            grad /= len(some)
            back = x.T @ (grad @ out.T)
            out -= rate * vec.T @ grad
            bias -= 0.1 * rate * grad.sum(axis=0)
            emb -= EMBEDDING_RATE * rate * back
    table = np.vstack([emb @ out, np.zeros((1, k))]).astype(np.float32)
    model = LanguageModel(labels, table, bias)
    logits = np.array([(c @ table[i]) / c.sum() for i, c in (rows[r] for r in kept)]) + bias
    truth, at = target[kept], np.arange(len(kept))
    loss = lambda t: -np.log(softmax(logits / t)[at, truth] + 1e-12).mean()
    model.temperature = float(min(np.geomspace(0.05, 20, 61), key=loss))
    p = softmax(logits / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == truth]
    model.reject_below = float(min(REJECT_MOST, np.quantile(right, 0.002))) if len(right) else 0.0
    return model


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Train on a sample of at most ROWS_PER_LANGUAGE rows of each non-null language; texts are used whole."""
    rows = docs.where(F.col(lang).isNotNull())
    rows = rows.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    some = sampled(rows, "lang", ROWS_PER_LANGUAGE)
    seen = map_batches(some.select("lang", "text"), _count_batches, "lang string, ids array<int>, counts array<long>")
    rows = [(np.array(r.ids), np.array(r.counts)) + (r.lang,) for r in seen.collect() if r.ids]
    rows.sort(key=lambda r: (r[2], len(r[0]), int(r[1].sum()), r[0].tobytes(), r[1].tobytes()))
    return train([r[:2] for r in rows], [r[2] for r in rows])


def _count_batches(batches: Batches) -> Batches:
    for batch in batches:
        pairs = [count_subwords(t) for t in texts_of(batch)]
        yield batch_of(
            lang=batch.column("lang"),
            ids=pa.array([p[0] for p in pairs], pa.list_(pa.int32())),
            counts=pa.array([p[1] for p in pairs], pa.list_(pa.int64())),
        )


def identify(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, rejected."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            names, score, rejected = model.predict(texts_of(batch))
            yield batch_of(
                doc_id=batch.column("doc_id"), lang_pred=pa.array(names, pa.string()), score=score, rejected=rejected
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def keep(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents (all columns) whose prediction is not rejected."""
    return keep_batches(docs, lambda texts: ~model.predict(texts)[2])
