"""SimHash near-dedup with a bit-sliced comparison.

A text's fingerprint has a bit where over half of its shingle hashes have it. Fingerprints within ``radius`` bits are
linked, and linked ones form groups. Equal fingerprints are one node. Two fingerprints within the radius agree in
``BLOCKS - radius`` of ``BLOCKS`` blocks of bits, so each node goes into one bucket per choice of blocks. Within a
bucket the fingerprints stand as bit planes (64 of them, one bit per fingerprint in each); a plane at a time is
compared with many fingerprints, carry-save counters keep the distances, and a block of comparisons is abandoned
once all its distances exceed the radius. A task returns a spanning forest of its links, not all pairs. Buckets over
``BUCKET`` nodes are split into blocks that are compared pairwise in tasks of their own.

Defined results: null text is empty text; a text without words has fingerprint zero, linked like any other; one with
fewer words than a shingle is one shingle. Rows with a repeated id each get a row. A null id is grouped too, but
names no group; a group of null ids only has a null name. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import Batches, batch_of, map_batches, texts_of
from tillroll.llm.components import components
from tillroll.session import stage

SEED = 42
SHINGLE = 3
RADIUS = 3
BLOCKS = 5
# Nodes of a bucket that one task compares with each other; larger buckets are split into blocks of about this size.
BUCKET = 8192
# Small buckets are compared together up to so many nodes; queries compared at once.
TOGETHER, QUERIES = 512, 256

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_BYTE = np.arange(8) * 256


def shingle_hashes(text: str, words: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of the ASCII-lower-cased words."""
    found = text.encode("utf-8", "replace").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    starts = list(accumulate((len(w) + 1 for w in found), initial=0))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[words:])), np.uint64, len(found) - words + 1)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    if not len(hashes):
        return 0
    bytes_ = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((bytes_ + _BYTE).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits(2 * counts.ravel() > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint(text: str, words: int = SHINGLE) -> int:
    return majority(shingle_hashes(text, words))


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of each row, the id as it is; fp is the fingerprint as a signed long."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in texts_of(batch)], np.uint64)
            yield batch_of(doc_id=batch.column("doc_id"), fp=fps.view(np.int64))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, fp long")


def near(planes: np.ndarray, queries: np.ndarray, size: int, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(query number, lane) pairs within the radius, of queries against ``size`` fingerprints as bit planes.

    ``planes`` is 64 x words of uint64. Counters of ``width`` bits start so high that they overflow just when a
    distance exceeds the radius.
    """
    width = int(radius).bit_length()
    live = np.arange(len(queries))
    shape = (len(queries), planes.shape[1])
    start, full = (1 << width) - 1 - radius, ~np.uint64(0)
    counter = [np.full(shape, full * np.uint64(start >> b & 1), np.uint64) for b in range(width)]
    over = np.zeros(shape, np.uint64)
    for bit in range(64):
        ones = np.uint64(0) - (queries[live] >> np.uint64(bit) & np.uint64(1))
        carry = planes[bit][None, :] ^ ones[:, None]
        for c in counter:  # carry-save: add one where the bits differ
            kept = c & carry
            c ^= carry
            carry = kept
        over |= carry
        if bit >= 15 and bit % 8 == 7:
            open_ = (over != full).any(axis=1)
            if not open_.any():
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            if open_.sum() * 2 <= len(live):
                live, over, counter = live[open_], over[open_], [c[open_] for c in counter]
    lanes = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little", count=size)
    q, lane = np.nonzero(lanes)
    return live[q], lane


def bit_planes(fps: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    # Lanes beyond the last stay unset; they are cut off when pairs are read.
    padded = np.zeros((64, -(-packed.shape[1] // 8) * 8), np.uint8)
    padded[:, : packed.shape[1]] = packed
    return padded.view(np.uint64)


def forest(fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each fingerprint a representative of those it is linked with, over links among these."""
    label = np.arange(len(fps))
    planes = bit_planes(fps)
    for at in range(0, len(fps), QUERIES):
        q, lane = near(planes, fps[at : at + QUERIES], len(fps), radius)
        q = q + at
        ahead = lane > q
        _join(label, q[ahead], lane[ahead])
    return label


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the linked classes; labels point to their class's least place."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def _compare(radius: int):
    """Links of the buckets of a task, whose rows come sorted by bucket."""

    def links(key: np.ndarray, fp: np.ndarray, node: np.ndarray):
        first = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(first) - 1
        size = np.bincount(group)
        many = size[group] > 1
        fp, node, size = fp[many], node[many], size[size > 1]
        ends, begin = np.cumsum(size).tolist(), 0
        for i, end in enumerate(ends):  # whole buckets together, up to TOGETHER nodes
            if i + 1 < len(ends) and ends[i + 1] - begin <= TOGETHER:
                continue
            label = forest(fp[begin:end], radius)
            linked = np.flatnonzero(label != np.arange(end - begin))
            yield node[begin:end][linked], node[begin:end][label[linked]]
            begin = end

    def run(batches: Batches) -> Batches:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def out(parts):
            for a, b in parts:
                if len(a):
                    yield batch_of(a=a, b=b)

        for batch in batches:
            key = np.array(batch.column("task").to_pylist())
            held.append((key, batch.column("fp").to_numpy().view(np.uint64), batch.column("node").to_numpy()))
            rows += len(key)
            if rows < 4 * BUCKET:
                continue
            key, fp, node = (np.concatenate(c) for c in zip(*held))
            cut = len(key) - int((key == key[-1]).sum())
            if cut:
                yield from out(links(key[:cut], fp[:cut], node[:cut]))
            held, rows = [(key[cut:], fp[cut:], node[cut:])], len(key) - cut
        if rows:
            yield from out(links(*(np.concatenate(c) for c in zip(*held))))

    return run


def bucketed(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(bucket, fp, node): each node once per choice of the blocks that must agree."""
    edges = [round(64 * i / BLOCKS) for i in range(BLOCKS + 1)]
    block = [F.shiftrightunsigned("fp", a).bitwiseAND((1 << (b - a)) - 1) for a, b in zip(edges, edges[1:])]
    keys = []
    for number, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - radius)):
        key = F.lit(number).cast("long")
        for c in chosen:
            key = F.shiftleft(key, edges[c + 1] - edges[c]).bitwiseOR(block[c])
        keys.append(key)
    return nodes.select(F.explode(F.array(*keys)).alias("bucket"), "fp", "node")


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) links that connect just those nodes (fp, node) that links within the radius connect."""
    if not 0 < radius < BLOCKS:
        raise ValueError(f"the radius must be 1 to {BLOCKS - 1}")
    rows = bucketed(nodes, radius)
    large = stage(rows.groupBy("bucket").agg(F.ceil(F.count("*") / BUCKET).cast("int").alias("blocks")).where("blocks > 1"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.concat_ws("/", F.least("own", j), F.greatest("own", j)))
    split = rows.join(large, "bucket").withColumn("own", own).select("bucket", "fp", "node", F.explode(others).alias("pair"))
    rows = rows.join(large, "bucket", "left_anti").withColumn("pair", F.lit(""))
    tasks = rows.unionByName(split).select(F.concat_ws(":", "bucket", "pair").alias("task"), "fp", "node")
    tasks = tasks.repartition("task").sortWithinPartitions("task")
    return map_batches(tasks, _compare(radius), "a long, b long").distinct()


def groups(docs: DataFrame, words: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fp, fingerprint (16 hex digits), component_id (least doc_id of its group)."""
    rows = stage(fingerprints(docs, words))
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(nodes.select("fp", F.col("fp").alias("node")), radius))
    # A component is named by its least document afterwards; null ids have no say.
    named = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", F.coalesce("component", "fp").alias("component"), "least")
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(names, "component").select("fp", "component_id")
    out = rows.join(named, "fp")
    return out.select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, words: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents with one row of each group kept: of the least id, then of the least hash of the text; all columns
    stay. Ids do not join what fingerprints keep apart: rows with one id and unlike texts are of different groups. A null
    id comes last, so a group of null ids keeps a row too.
    """
    names: list[str] = []
    while len(names) < 3:
        names.append(next(n for i in range(len(docs.columns) + 3) if (n := f"name_{i}") not in (*docs.columns, *names)))
    zero = F.lit(0).cast(docs.schema["doc_id"].dataType)
    name = dict(zip(names, (F.col("doc_id").isNull(), F.coalesce("doc_id", zero), F.xxhash64(F.coalesce("text", F.lit(""))))))
    named = docs.withColumns(name)
    found = groups(named.select(F.struct(*names).alias("doc_id"), "text"), words, radius)
    kept = found.select("component_id.*").distinct()
    return named.join(kept, names, "left_semi").dropDuplicates(names).drop(*names)
