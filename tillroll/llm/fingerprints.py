"""Document fingerprints: SimHash of weighted terms, and a search in permuted block tables.

Terms are pairs of neighbouring words (a single word for a text of one word); a term votes with the sum of its words'
lengths, once per occurrence, for or against each of ``BITS`` signed bits. A bit is set where the votes are positive.
Likeness is the cosine that the share of differing bits estimates, from 0 (a right angle or more) to 1.

The search permutes blocks of bits to the front, one table per choice of blocks that must agree within the radius,
joins queries and fingerprints on the front of each table and verifies the distance.

Defined results: null text is empty text; texts without words have the fingerprint of all zeros, and equal texts
equal fingerprints. Rows with a repeated id each get a row (in the order of their texts' hashes, then texts). Null
ids come last in descending order and are all of one range. Other columns are ignored; an empty table gives no rows; of a single document the
next one is itself.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import Batches, batch_of, map_batches, texts_of
from tillroll.session import stage

BITS = 128
# Differing bits that the search of the registered query allows.
RADIUS = 3
# Ranges of ids for each shuffle partition; a range is sorted in one task and takes one document of the next range.
RANGES_PER_PARTITION = 8
_BIT = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64) * 2 - 1
_BYTE = np.arange(BITS // 8) * 256
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)
_EMPTY = np.zeros(BITS // 8, np.uint8)


def _mixed(x: np.ndarray, k: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(_MIX[k])
    return x ^ (x >> np.uint64(29))


def _words(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash and the length of each blank-separated word, over its UTF-8 bytes."""
    raw = np.frombuffer(b" " + text.encode("utf-8", "replace") + b" ", np.uint8)
    blank = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sizes = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1 - starts
    edges = np.append(0, starts)
    place = np.arange(len(raw)) - np.repeat(edges, np.diff(np.append(edges, len(raw))))  # in its word
    value = (raw.astype(np.uint64) + np.uint64(1)) * _powers(int(place.max()) + 1)[place]
    value[blank] = 0
    return _mixed(np.add.reduceat(value, starts), 0), sizes


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.multiply.accumulate(np.full(2 * n, _MIX[0], np.uint64))
    return _POWERS


def votes(text: str) -> np.ndarray:
    """Fingerprint bytes of a text."""
    words, sizes = _words(text)
    if not len(words):
        return _EMPTY
    if len(words) > 1:
        words = words[:-1] * np.uint64(_MIX[2]) + (words[1:] ^ (words[1:] >> np.uint64(17)))
        sizes = sizes[:-1] + sizes[1:]
    bytes_ = np.stack([_mixed(words, 1), _mixed(words, 3)], axis=1).view(np.uint8)
    counts = np.bincount((bytes_ + _BYTE).ravel(), np.repeat(sizes, BITS // 8), minlength=256 * len(_BYTE))
    signed = np.einsum("pv,vb->pb", counts.reshape(-1, 256), _BIT).ravel()
    return np.packbits(signed > 0, bitorder="little")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    share = int(np.bitwise_count(a ^ b).sum()) / BITS
    return max(0.0, float(np.cos(np.pi * share)))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the start of the following one, as far as that goes."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of each row; fingerprint in hex digits."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = pa.array([votes(t).tobytes().hex() for t in texts_of(batch)], pa.string())
            yield batch_of(doc_id=batch.column("doc_id"), fingerprint=found)

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, run, f"doc_id {kind}, fingerprint string")


def _ranges(ids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest id of ranges of about equal size, descending (as many as RANGES_PER_PARTITION says)."""
    parts = RANGES_PER_PARTITION * int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = ids.where("doc_id is not null").repartitionByRange(parts, F.desc("doc_id"))
    bounds = cut.groupBy(F.spark_partition_id().alias("part")).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    rows = sorted(((r.low, r.high) for r in bounds.collect()), reverse=True)  # as many as ranges
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)


def _dealt(docs: DataFrame) -> DataFrame:
    """Rows in ranges of descending ids, each followed by the first document of the next range (``helper``)."""
    low, high = _ranges(docs.select("doc_id"))
    count = max(1, len(low))

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        value = ids.fillna(0).to_numpy().astype(np.int64)
        own = np.searchsorted(-low, -value) if len(low) else np.zeros(len(value), np.int64)
        own = np.where(known, own, count - 1)
        heads = known & (high[np.minimum(own, count - 1)] == value) if len(high) and count > 1 else np.zeros(len(value), bool)
        return pd.Series([[o, -1 - (o - 1) % count] if h else [o] for o, h in zip(own.tolist(), heads.tolist())])

    placed = docs.withColumn("place", F.explode(places("doc_id")))
    helper = F.col("place") < 0
    placed = placed.select(F.when(helper, -1 - F.col("place")).otherwise(F.col("place")).alias("range"), helper.alias("helper"), "doc_id", "text")
    return placed.repartition("range").sortWithinPartitions("range", "helper", F.desc_nulls_last("doc_id"), F.xxhash64("text"), "text")


def compared(docs: DataFrame) -> DataFrame:
    """Per document, against the next one in descending ids (after the last: the first):
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Texts move once, to ranges of ids; a range also gets the first document of the next one.
    """

    def finished(row: tuple, following: str, next_votes: np.ndarray) -> tuple:
        doc_id, text, own = row
        new = edited(text, following)
        other = votes(new)
        digest = hashlib.sha256(new.encode("utf-8", "replace")).hexdigest()
        return doc_id, len(text), digest, own.tobytes().hex(), other.tobytes().hex(), likeness(own, other), likeness(own, next_votes)

    def run(batches: Batches) -> Batches:
        first = held = None  # first row of the range, and the row that waits for its next one
        current = -1
        out: list[tuple] = []
        for batch in batches:
            for part, helper, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("range", "helper", "doc_id", "text"))):
                if part != current:
                    if held:  # a range without a next one: its first document follows
                        out.append(finished(held, first[1], first[2]))
                    current, first, held = part, None, None
                if helper:
                    if held:
                        out.append(finished(held, text, votes(text)))
                    held = None
                    continue
                row = (doc_id, text, votes(text))
                if held:
                    out.append(finished(held, text, row[2]))
                held, first = row, first or row
            yield _rows(out)
            out = []
        if held:
            yield _rows([finished(held, first[1], first[2])])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(
        _dealt(rows),
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    columns = list(zip(*rows)) or [()] * len(names)
    return batch_of(**{n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})


def within(queries: DataFrame, found: DataFrame, radius: int, blocks: int | None = None) -> DataFrame:
    """(query, fingerprint, distance) of all pairs of distinct fingerprints within the radius.

    ``queries`` and ``found`` hold hex fingerprints in a column ``fingerprint``. Of ``blocks`` blocks (default:
    radius + 2) all but ``radius`` agree in one of the tables, each of which has another choice of blocks in front.
    """
    digits = BITS // 4
    blocks = blocks or min(digits, radius + 2)
    if not 0 <= radius < blocks <= digits:
        raise ValueError("the radius must be below the number of blocks")
    edges = [digits * i // blocks for i in range(blocks + 1)]
    # Fronts travel as hashes: a collision only adds a candidate, and the distance decides.
    fronts = [
        F.xxhash64(F.lit(n), *(F.substring("fingerprint", edges[c] + 1, edges[c + 1] - edges[c]) for c in chosen))
        for n, chosen in enumerate(combinations(range(blocks), blocks - radius))
    ]
    tabled = lambda df, name: df.select("fingerprint").where("fingerprint is not null").distinct().select(F.col("fingerprint").alias(name), F.explode(F.array(*fronts)).alias("front"))
    part = lambda c, i: F.conv(F.substring(c, 8 * i + 1, 8), 16, 10).cast("long")
    distance = sum((F.bit_count(part("query", i).bitwiseXOR(part("fingerprint", i))) for i in range(1, BITS // 32)), F.bit_count(part("query", 0).bitwiseXOR(part("fingerprint", 0))))
    pairs = tabled(queries, "query").join(tabled(found, "fingerprint"), "front").withColumn("distance", distance)
    return pairs.where(F.col("distance") <= radius).select("query", "fingerprint", "distance").distinct()


def with_neighbors(rows: DataFrame, asked: Column, radius: int = RADIUS) -> DataFrame:
    """``rows`` (fingerprint, ...) with n_within: for the rows ``asked``, how many rows have a fingerprint within the
    radius of theirs, their own included; null for others. Equal fingerprints are searched once; a front that very many
    of them share is a skewed key of the join with the queries, which Spark splits."""
    kinds = stage(rows.groupBy("fingerprint").agg(F.count("*").alias("n")))
    queries = rows.where(asked).select("fingerprint")
    pairs = within(queries, kinds.select("fingerprint"), radius).join(kinds, "fingerprint")
    found = pairs.groupBy(F.col("query").alias("fingerprint")).agg(F.sum("n").alias("n_within"))
    mine = rows.where(asked).join(found, "fingerprint", "left").select(*rows.columns, "n_within")
    return mine.unionByName(rows.where(~F.coalesce(asked, F.lit(False))).withColumn("n_within", F.lit(None).cast("long")))
