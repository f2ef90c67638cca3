"""Spelling variants: words one edit apart, found by probing edits against Bloom filters.

Words are counted over all documents. For each word length there is a blocked Bloom filter (a word's bits lie in one
block of 512); filters are built by OR-ing blocks in Spark and broadcast. Tasks probe the edits of their words against
the filter of the edit's length; only positives become strings and shuffle to the join with the vocabulary, which
removes false ones. An edit's hash comes from prefix sums of its word's hash, so probing makes no strings.

A word and its near word find each other once: the longer one deletes, and of two of one length the lesser one
replaces; the other direction follows from the join. Broadcasts are bounded: filters beyond ``PASS_BYTES`` are cut
into shards by hash, and words are probed once per group of shards.

Null text has no words; a null id counts as ''. Repeated rows count again, other columns are ignored, and an empty table
has no words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import Batches, batch_of, map_batches
from tillroll.session import stage

MIN_LENGTH = 5
MIN_COUNT = 3
DAMAGE = 97  # of so many runs, one loses a character
# Distinct words a task counts before it hands them on.
HELD = 400_000
BITS_PER_WORD = 16
LANES = 8  # of 64 bits: a block
# Filters broadcast at once.
PASS_BYTES = 64 << 20
# Words of a task, and probes of one numpy step.
TASK_WORDS = 20_000
_STEP = 1 << 21

# The characters of words as Latin-1 bytes, one each; the rest is blanked and A-Z lower-cased.
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))
_LETTERS = np.array([b for b in range(256) if _WORD_BYTES[b] == b != 0x20], np.int64)


def damaged(prefix: int, run: bytes) -> bytes:
    """The run (Latin-1), less one character where its checksum says so. ``prefix``: checksum of the id and colon."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def words_of(doc_id: object, text: str) -> Counter:
    """Counts of the words of a document, short ones left out."""
    out: Counter = Counter()
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(text.encode("latin-1", "replace").translate(_WORD_BYTES).split()).items():
        word = damaged(prefix, run)
        if len(word) >= MIN_LENGTH:
            out[word] += n
    return out


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words with enough occurrences over all documents."""

    def run(batches: Batches) -> Batches:
        counts: Counter = Counter()

        def flush():
            items = list(counts.items())
            counts.clear()
            for at in range(0, len(items), 65536):
                words, n = zip(*items[at : at + 65536])
                yield batch_of(word=pa.array([w.decode("latin-1") for w in words], pa.string()), n=pa.array(n, pa.int64()))

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if text:
                    counts.update(words_of(doc_id, text))
            if len(counts) > HELD:
                yield from flush()
        yield from flush()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    partial = map_batches(rows, run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# Hashes: a letter's number times a power of an odd base by place, summed up, then mixed.

_BASE, _MIX_A, _MIX_B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX_A
    h = (h ^ (h >> np.uint64(27))) * _MIX_B
    return h ^ (h >> np.uint64(31))


_NUMBER = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)


def weighted(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of words of one length (word, place): the terms of their hashes, and the powers of the base by place."""
    powers = np.multiply.accumulate(np.full(words.shape[1] + 1, _BASE, np.uint64))
    return _NUMBER[words] * powers[: words.shape[1]], powers


@dataclass(frozen=True)
class Shape:
    """Filters by word length: blocks of a shard and number of shards. Shards are numbered over all lengths."""

    lengths: dict[int, tuple[int, int, int]]  # length: (first shard, shards, blocks of each)

    def place(self, length: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard and block of words with raw hash ``h``."""
        first, shards, blocks = self.lengths[length]
        m = mixed(h ^ _MIX_B)
        return first + (m % np.uint64(shards)).astype(np.int64), ((m >> np.uint64(24)) % np.uint64(blocks)).astype(np.int64)


def bit(h: np.ndarray, lane: int) -> np.ndarray:
    """The one bit a word has in a lane of its block."""
    return np.uint64(1) << (mixed(h) >> np.uint64(6 * lane) & np.uint64(63))


def shape_of(counts: dict[int, int], pass_bytes: int = PASS_BYTES) -> Shape:
    lengths, first = {}, 0
    most = max(pass_bytes // (8 * LANES), 1)
    for length, n in sorted(counts.items()):
        blocks = -(-n * BITS_PER_WORD // (64 * LANES))
        shards = -(-blocks // most)
        lengths[length] = (first, shards, -(-blocks // shards))
        first += shards
    return Shape(lengths)


def passes_of(shape: Shape, pass_bytes: int = PASS_BYTES) -> list[dict[int, int]]:
    """Groups of shards (shard: its blocks) that are broadcast together."""
    out: list[dict[int, int]] = [{}]
    for first, shards, blocks in shape.lengths.values():
        for shard in range(first, first + shards):
            if out[-1] and (sum(out[-1].values()) + blocks) * 8 * LANES > pass_bytes:
                out.append({})
            out[-1][shard] = blocks
    return [p for p in out if p]


def _by_length(words: list[str]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length: (places in the list, letters by word and place)."""
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    return {
        int(n): (at, codes[starts[at][:, None] + np.arange(n)])
        for n in np.unique(sizes)
        for at in (np.flatnonzero(sizes == n),)
    }


def filter_blocks(vocab: DataFrame, shape: Shape) -> DataFrame:
    """(shard, block, lane0, ...): the blocks that hold a word."""
    lanes = [f"lane{i}" for i in range(LANES)]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for length, (_, letters) in _by_length(batch.column("word").to_pylist()).items():
                h = weighted(letters)[0].sum(1, dtype=np.uint64)
                shard, block = shape.place(length, h)
                bits = {name: bit(h, i).view(np.int64) for i, name in enumerate(lanes)}
                yield batch_of(shard=shard, block=block, **bits)

    rows = map_batches(vocab.select("word"), run, "shard long, block long, " + ", ".join(f"{x} long" for x in lanes))
    return rows.groupBy("shard", "block").agg(*[F.bit_or(x).alias(x) for x in lanes])


class Filters:
    """The blocks of a group of shards, as they are broadcast."""

    def __init__(self, shape: Shape, blocks: dict[int, int], rows: pa.Table) -> None:
        self.shape = shape
        self.first = np.full(max(blocks, default=0) + 2, -1, np.int64)  # a shard's first block here
        at = 0
        for shard, n in blocks.items():
            self.first[shard] = at
            at += n
        self.lanes = np.zeros((LANES, at), np.uint64)
        shard, block = (rows.column(c).to_numpy() for c in ("shard", "block"))
        for i in range(LANES):
            self.lanes[i, self.first[shard] + block] = rows.column(f"lane{i}").to_numpy().view(np.uint64)

    def holds(self, length: int, h: np.ndarray) -> np.ndarray:
        """Places in ``h`` (raw hashes of strings of one length) that the filters may hold."""
        if length not in self.shape.lengths:
            return np.zeros(0, np.int64)
        shard, block = self.shape.place(length, h)
        first = self.first[np.minimum(shard, len(self.first) - 1)]
        left = np.flatnonzero(first >= 0)
        block = first[left] + block[left]
        for i in range(LANES):
            hit = self.lanes[i, block] & bit(h[left], i) != 0
            left, block = left[hit], block[hit]
        return left


def probe(words: list[str], filters: Filters, letters: np.ndarray = _LETTERS) -> list[tuple[int, str]]:
    """(place of the word, edit) for edits that the filters may hold: characters deleted, or replaced by greater ones."""
    out = []
    for length, (at, codes) in _by_length(words).items():
        step = max(1, _STEP // (length * len(letters)))
        for lo in range(0, len(at), step):
            own, some = at[lo : lo + step], codes[lo : lo + step]
            terms, powers = weighted(some)
            whole = terms.sum(1, dtype=np.uint64)
            # A deletion moves what follows one place back; of equal neighbours the first one goes.
            upto = np.cumsum(terms, axis=1, dtype=np.uint64)
            shorter = upto - terms + (whole[:, None] - upto) * _BACK
            first = np.ones(some.shape, bool)
            first[:, 1:] = some[:, 1:] != some[:, :-1]
            word, place = np.nonzero(first)
            for x in filters.holds(length - 1, shorter[word, place]).tolist():
                w, p = int(word[x]), int(place[x])
                raw = some[w].tobytes()
                out.append((int(own[w]), (raw[:p] + raw[p + 1 :]).decode("latin-1")))
            # A replacement changes one term; long words take their places in turn.
            wide = max(1, _STEP // (len(some) * len(letters)))
            for left in range(0, length, wide):
                greater = letters[None, None, :] > some[:, left : left + wide, None]
                word, place, new = np.nonzero(greater)
                place, new = place + left, letters[new]
                changed = whole[word] - terms[word, place] + _NUMBER[new] * powers[place]
                for x in filters.holds(length, changed).tolist():
                    w, p = int(word[x]), int(place[x])
                    raw = some[w].tobytes()
                    out.append((int(own[w]), (raw[:p] + bytes([new[x]]) + raw[p + 1 :]).decode("latin-1")))
    return out


def near_pairs(vocab: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(word, n, near, near_n), both ways, of words one edit apart. ``vocab`` (word, n) should be staged."""
    spark = vocab.sparkSession
    by_length = vocab.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n"))
    # Lengths are few: d of them take d * d / 2 characters of distinct words. Letters are at most 90.
    counts = {int(r.length): int(r.n) for r in by_length.collect()}
    shape = shape_of(counts, pass_bytes)
    blocks = stage(filter_blocks(vocab, shape))
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().collect()
    letters = np.array(sorted(ord(r.c) for r in letters), np.int64)
    tasks = max(spark.sparkContext.defaultParallelism, -(-sum(counts.values()) // TASK_WORDS))
    dealt = vocab.repartition(tasks, "word")
    found = None
    for group in passes_of(shape, pass_bytes):
        rows = blocks.where(F.col("shard").between(min(group), max(group))).toArrow()
        sent = spark.sparkContext.broadcast(Filters(shape, group, rows))

        def run(batches: Batches, sent=sent) -> Batches:
            for batch in batches:
                words = batch.column("word").to_pylist()
                hits = probe(words, sent.value, letters)
                at = pa.array([i for i, _ in hits], pa.int64())
                yield batch_of(word=batch.column("word").take(at), n=batch.column("n").take(at), near=pa.array([e for _, e in hits], pa.string()))

        part = map_batches(dealt, run, "word string, n long, near string")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "word string, n long, near string")
    exact = found.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    back = F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return exact.select(F.explode(F.array(F.struct("word", "n", "near", "near_n"), back)).alias("p")).select("p.*")


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the last form from each word that has one. Each pass doubles the way; a form has at least twice
    its word's count, so a way is shorter than 63 forms and six passes end it."""
    ways = stage(links.select("word", F.col("form").alias("root")))
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stage(ways.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not further.where("moved").limit(1).count():
            return ways
        ways = further.drop("moved")


def group(docs: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    vocab = stage(vocabulary(docs))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_pairs(vocab, pass_bytes).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = vocab.join(near, "word", "left")
    larger = -F.col("best.less") >= 2 * F.col("n")
    rows = stage(
        rows.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(larger, F.col("best.near")).alias("form"),
            F.when(larger, -F.col("best.less")).alias("form_n"),
        )
    )
    found = rows.join(roots(rows.where("form is not null")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
