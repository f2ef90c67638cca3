"""Best-fit decreasing packing of whole documents.

Each document's ids, followed by a document end, stay together; only a document longer than a window is cut, into whole
windows and one shorter piece, its first. A whole window is a sequence of its own. The shorter pieces, longest first,
each go to the open sequence with the least room that still holds them. A segment tree over remaining capacities finds
it in logarithmic time.

The order of pieces of one length does not matter, so the driver runs the placement over the histogram (one number per
length below the window): pieces of a length meet the sequences of one capacity as a run of ranks. That is the same
placement as piece by piece, and its size depends on the window only. A piece learns its rank within its length from a
count per task and length; nothing is ordered in one task.

Null text counts as empty: such a document is its end alone. Rows with repeated or null ids are packed as rows of their
own; columns besides id and text are ignored; an empty table has no pieces.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm import bytebpe
from tillroll.llm.batches import Batches, batch_of, map_batches, texts_of
from tillroll.session import stage

WINDOW = 2048
END_ID = 0
# Bits of a rank or of a number within a task.
_BITS = 40


class Capacities:
    """Segment tree over remaining capacities 0 to ``window``; each node knows how many open sequences lie below it."""

    def __init__(self, window: int) -> None:
        self.width = 1 << window.bit_length()
        self.count = [0] * (2 * self.width)

    def add(self, capacity: int, sequences: int) -> None:
        at = self.width + capacity
        while at:
            self.count[at] += sequences
            at >>= 1

    def tightest(self, length: int) -> int | None:
        """The least capacity of an open sequence that holds ``length``."""
        at = self.width + length
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
        while at < self.width:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        return at - self.width


@dataclass
class Plan:
    """Runs of pieces of one length: ``each`` to a sequence, from ``offset`` on, in sequences from ``sequence`` on."""

    keys: np.ndarray  # length << _BITS | first rank, sorted
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        at = np.searchsorted(self.keys, (length << _BITS) | rank, side="right") - 1
        index = rank - (self.keys[at] & ((1 << _BITS) - 1))
        return self.sequence[at] + index // self.each[at], self.offset[at] + index % self.each[at] * length


def solve(histogram: np.ndarray, window: int = WINDOW) -> Plan:
    """Best-fit decreasing over a histogram of lengths below ``window`` (index: length; 0 is unused)."""
    open_ = Capacities(window)
    runs: dict[int, list[tuple[int, int]]] = {}  # capacity: (first sequence, how many)
    placed: list[tuple[int, int, int, int]] = []
    sequences = 0

    def keep(capacity: int, first: int, many: int) -> None:
        if many and capacity:
            runs.setdefault(capacity, []).append((first, many))
            open_.add(capacity, many)

    for length in np.flatnonzero(histogram[1:])[::-1].tolist():
        length += 1
        left, rank = int(histogram[length]), 0
        while left:
            capacity = open_.tightest(length)
            if capacity is None:
                capacity = window
                each = capacity // length
                first, many = sequences, -(-left // each)
                sequences += many
            else:
                # The tightest sequence stays so after a piece of this length: it takes as many as it holds.
                each = capacity // length
                first, many = runs[capacity].pop()
                open_.add(capacity, -many)
            full, rest = divmod(min(left, many * each), each)
            placed.append((length << _BITS | rank, first, each, window - capacity))
            keep(capacity - each * length, first, full)
            if rest:
                keep(capacity - rest * length, first + full, 1)
            used = full + bool(rest)
            keep(capacity, first + used, many - used)
            rank += full * each + rest
            left -= full * each + rest
    placed.sort()
    columns = zip(*placed) if placed else ((), (), (), ())
    return Plan(*(np.array(c, np.int64) for c in columns), sequences)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encoded(docs: DataFrame, tokenizer: tuple[str, str, str], window: int = WINDOW) -> DataFrame:
    """A row per document: the checks of its pieces, the length of a shorter first piece (0: none) and that piece's
    rank among those of its length in the task."""

    def run(batches: Batches) -> Batches:
        model = bytebpe.load(*tokenizer)
        part, whole = TaskContext.get().partitionId(), 0
        ranks = np.zeros(window, np.int64)
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("short", "rank", "whole_before", "crcs")}
            for ids in model.encode_batch(texts_of(batch)):
                ids = np.append(ids, np.array([END_ID], ids.dtype))
                full, short = divmod(len(ids), window)
                cuts = [*([0] if short else []), *range(short, len(ids) + 1, window)]
                values = (short, int(ranks[short]), whole, [_crc(ids[a:b]) for a, b in zip(cuts, cuts[1:])])
                for column, value in zip(out.values(), values):
                    column.append(value)
                ranks[short] += 1
                whole += full
            yield batch_of(
                doc_id=batch.column("doc_id"),
                part=pa.array([part] * batch.num_rows, pa.int64()),
                **{c: pa.array(v, pa.list_(pa.int64()) if c == "crcs" else pa.int64()) for c, v in out.items()},
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, part long, short long, rank long, whole_before long, crcs array<long>"
    return map_batches(docs.select("doc_id", "text"), run, schema)


def pack(docs: DataFrame, tokenizer: tuple[str, str, str], window: int = WINDOW) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` names a tokenizers file, its rank file and its splitting pattern.
    """
    rows = stage(encoded(docs, tokenizer, window))
    cells = rows.where("short > 0").groupBy("short", "part").agg(F.count("*").alias("n"))
    order = Window.partitionBy("short").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select("short", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    histogram = np.zeros(window, np.int64)
    for r in cells.groupBy("short").agg(F.sum("n").alias("n")).collect():  # below window rows
        histogram[r.short] = r.n
    plan = solve(histogram, window)

    def place(batches: Batches) -> Batches:
        for batch in batches:
            get = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "short", "rank", "whole_before")}
            crcs = batch.column("crcs")
            pieces = np.diff(crcs.offsets.to_numpy())
            owner = np.repeat(np.arange(batch.num_rows), pieces)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            short = get["short"][owner]
            first = (piece == 0) & (short > 0)
            cut = piece - (short > 0)  # place among the whole windows
            sequence = ((get["part"][owner] + 1) << _BITS) | (get["whole_before"][owner] + cut)
            offset = np.zeros(len(owner), np.int64)
            if first.any():
                sequence[first], offset[first] = plan.place(short[first], get["rank"][owner][first])
            yield batch_of(
                doc_id=batch.column("doc_id").take(pa.array(owner)), piece=piece.astype(np.int32),
                start=np.where(first, 0, short + cut * window), length=np.where(first, short, window),
                ids_crc32=crcs.flatten(), sequence_id=sequence, offset=offset,
            )

    placed = rows.join(before, ["short", "part"], "left").withColumn("rank", F.col("rank") + F.coalesce("before", F.lit(0)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        placed.select("doc_id", "part", "short", "rank", "whole_before", "crcs"),
        place,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
