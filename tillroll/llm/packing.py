"""Sequence packing by non-negative least squares over length combinations.

Each document's ids, followed by a document end, are cut into whole windows and one remainder. The remainders'
histogram (one bin per length below the window) is all the driver sees. Combinations of two or three lengths that
fill a window exactly are enumerated; non-negative least squares finds repeat counts that explain the histogram; they
are rounded down and kept feasible. Remainders beyond the counts are packed greedily, longest first, each cut where
its window is full. Only the last window is padded.

Pieces are placed by their rank within their length: a count per task and length gives each task its offset, so a
length that holds a third of all rows is no single task's work.

Null text counts as empty: such a document is its end alone. Repeated ids are packed as rows of their own; columns
besides id and text are ignored; an empty table has no pieces.
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

WINDOW = 1024
END_ID = 0
# Lengths that make up combinations of three: the most frequent ones.
FREQUENT = 48
SWEEPS = 200
# Windows filled by whole pieces are numbered by task, above those of combinations and residuals.
_TASK = 40


def combinations(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[int, ...]]:
    """Lengths, two or three, that fill the window; all occur in the histogram (indexed by length)."""
    have = set(np.flatnonzero(histogram).tolist())
    out = {(a, window - a) for a in have if a <= window - a and window - a in have}
    often = sorted(sorted(have, key=lambda v: (-histogram[v], v))[:FREQUENT])
    for i, b in enumerate(often):
        for c in often[i:]:
            if window - b - c in have:
                out.add(tuple(sorted((window - b - c, b, c))))
    return sorted(out)


def least_squares(columns: list[tuple[int, ...]], histogram: np.ndarray) -> list[float]:
    """Repeat counts x >= 0 with least squared error of (lengths used by x) - histogram, by coordinate descent."""
    left = histogram.astype(float).tolist()
    sparse = [[(v, float(c.count(v))) for v in sorted(set(c))] for c in columns]
    square = [sum(m * m for _, m in s) for s in sparse]
    x = [0.0] * len(columns)
    scale = max(float(histogram.max(initial=0)), 1.0)
    for _ in range(SWEEPS):
        moved = 0.0
        for j, s in enumerate(sparse):
            step = max(-x[j], sum(m * left[v] for v, m in s) / square[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for v, m in s:
                    left[v] -= m * step
        if moved < 1e-3 * scale / 1000:
            break
    return x


@dataclass
class Plan:
    """Where the remainders go, by length and rank among those of the length."""

    window: int
    keys: np.ndarray  # length << 40 | first rank, sorted: runs of ranks that share a slot of a combination
    ends: np.ndarray  # first rank after the run
    sequence: np.ndarray  # sequence of the run's first rank
    offset: np.ndarray  # in the sequence
    covered: np.ndarray  # by length: ranks that combinations take
    base: np.ndarray  # by length: place of the first other rank in the residual stream
    residual: int  # first residual sequence

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each remainder; a residual one may reach into the next sequence."""
        at = np.searchsorted(self.keys, (length << 40) | rank, side="right") - 1
        if len(self.keys):
            slot = np.maximum(at, 0)
            inside = (at >= 0) & (self.keys[slot] >> 40 == length) & (rank < self.ends[slot])
            sequence = np.where(inside, self.sequence[slot] + rank - (self.keys[slot] & ((1 << 40) - 1)), 0)
            offset = np.where(inside, self.offset[slot], 0)
        else:
            inside, sequence, offset = np.zeros(len(length), bool), np.zeros_like(length), np.zeros_like(length)
        stream = self.base[length] + (rank - self.covered[length]) * length
        sequence = np.where(inside, sequence, self.residual + stream // self.window)
        return sequence, np.where(inside, offset, stream % self.window)


def solve(histogram: np.ndarray, window: int = WINDOW) -> Plan:
    """The plan of a histogram of remainders (index: length, 0 unused)."""
    columns = combinations(histogram, window)
    wanted = least_squares(columns, histogram)
    left, used = histogram.astype(np.int64).copy(), np.zeros(window, np.int64)
    left[0] = 0
    runs: list[tuple[int, int, int, int]] = []
    sequence = 0
    for j in sorted(range(len(columns)), key=lambda j: (-wanted[j], columns[j])):
        lengths = columns[j]
        # Whole repeats; what rounding leaves over goes to the residuals.
        count = min([int(wanted[j] + 1e-6), *(int(left[v]) // lengths.count(v) for v in set(lengths))])
        if count <= 0:
            continue
        offset = 0
        for v in lengths:
            runs.append(((v << 40) | int(used[v]), int(used[v]) + count, sequence, offset))
            used[v] += count
            left[v] -= count
            offset += v
        sequence += count
    runs.sort()
    columns_of = list(zip(*runs)) if runs else [(), (), (), ()]
    keys, ends, sequences, offsets = (np.array(c, np.int64) for c in columns_of)
    lengths = np.arange(window)
    sizes = (left * lengths)[::-1]
    base = (np.cumsum(sizes) - sizes)[::-1]  # longest first
    return Plan(window, keys, ends, sequences, offsets, used, base, sequence)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encoded(docs: DataFrame, tokenizer: tuple[str, str, str], window: int = WINDOW) -> DataFrame:
    """A row per document: checks of its whole windows, and its remainder with its rank in the task."""

    def run(batches: Batches) -> Batches:
        model = bytebpe.load(*tokenizer)
        part, row, whole = TaskContext.get().partitionId(), 0, 0
        ranks = np.zeros(window, np.int64)
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("row", "doc_tokens", "crcs", "whole_before", "rem", "rank", "rem_crc", "rem_ids")}
            for ids in model.encode_batch(texts_of(batch)):
                ids = np.append(ids, np.array([END_ID], ids.dtype))
                full, rem = divmod(len(ids), window)
                rest = ids[full * window :]
                values = (row, len(ids), [_crc(ids[i * window : (i + 1) * window]) for i in range(full)], whole, rem, int(ranks[rem]), _crc(rest), rest.astype("<u4" if ids.dtype.itemsize == 4 else "<u2").tobytes())
                for column, value in zip(out.values(), values):
                    column.append(value)
                ranks[rem] += 1
                row += 1
                whole += full
            yield batch_of(
                doc_id=batch.column("doc_id"),
                part=pa.array([part] * batch.num_rows, pa.int64()),
                **{c: pa.array(v, pa.list_(pa.int64()) if c == "crcs" else pa.binary() if c == "rem_ids" else pa.int64()) for c, v in out.items()},
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        docs.select("doc_id", "text"),
        run,
        f"doc_id {kind}, part long, row long, doc_tokens long, crcs array<long>, whole_before long, rem long, rank long, rem_crc long, rem_ids binary",
    )


def pack(docs: DataFrame, tokenizer: tuple[str, str, str], window: int = WINDOW) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` names a tokenizers file, its rank file and its splitting pattern.
    """
    rows = stage(encoded(docs, tokenizer, window))
    cells = rows.where("rem > 0").groupBy("rem", "part").agg(F.count("*").alias("n"))
    order = Window.partitionBy("rem").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select("rem", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    histogram = np.zeros(window, np.int64)
    for r in cells.groupBy("rem").agg(F.sum("n").alias("n")).collect():  # at most window rows
        histogram[r.rem] = r.n
    plan = solve(histogram, window)
    kind = docs.schema["doc_id"].dataType.simpleString()
    piece = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def place(batches: Batches) -> Batches:
        for batch in batches:
            get = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "row", "doc_tokens", "whole_before", "rem", "rank", "rem_crc")}
            full = get["doc_tokens"] // window
            owner = np.repeat(np.arange(batch.num_rows), full)
            index = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full)
            crcs = batch.column("crcs").flatten().to_numpy(zero_copy_only=False)
            sequence = ((get["part"][owner] + 1) << _TASK) | (get["whole_before"][owner] + index)
            parts = [(owner, index * window, np.full(len(owner), window), crcs, sequence, np.zeros(len(owner), np.int64))]
            rest = np.flatnonzero(get["rem"] > 0)
            rem = get["rem"][rest]
            sequence, offset = plan.place(rem, get["rank"][rest])
            head = np.minimum(rem, window - offset)
            start, cut = full[rest] * window, head < rem
            parts.append((rest, start, head, np.where(cut, -1, get["rem_crc"][rest]), sequence, offset))
            tail = rest[cut]
            parts.append((tail, (start + head)[cut], (rem - head)[cut], np.full(len(tail), -1), sequence[cut] + 1, np.zeros(len(tail), np.int64)))
            owner, start, length, crc, sequence, offset = (np.concatenate(c) for c in zip(*parts))
            yield batch_of(
                doc_id=batch.column("doc_id").take(pa.array(owner)), start=start, length=length, ids_crc32=crc,
                doc_tokens=get["doc_tokens"][owner], sequence_id=sequence, offset=offset, part=get["part"][owner], row=get["row"][owner],
            )

    def check(batches: Batches) -> Batches:
        for batch in batches:
            values = []
            width = "<u2" if narrow else "<u4"
            starts, lengths = (batch.column(c).to_pylist() for c in ("start", "length"))
            for raw, start, length in zip(batch.column("rem_ids").to_pylist(), starts, lengths):
                values.append(_crc(np.frombuffer(raw, width)[start % window : start % window + length]))
            columns = {c: batch.column(c) for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")}
            columns["ids_crc32"] = pa.array(values, pa.int64())
            yield batch_of(**{c: columns[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")})

    narrow = bytebpe.load(*tokenizer).kind.itemsize == 2
    placed = rows.drop("rem_ids").join(before, ["rem", "part"], "left").withColumn("rank", F.col("rank") + F.coalesce("before", F.lit(0)))
    placed = placed.select("doc_id", "part", "row", "doc_tokens", "crcs", "whole_before", "rem", "rank", "rem_crc")
    pieces = stage(map_batches(placed, place, piece + ", part long, row long"))
    whole = pieces.where("ids_crc32 >= 0").drop("part", "row")
    cut = pieces.where("ids_crc32 < 0").join(rows.select("part", "row", "rem_ids"), ["part", "row"])
    return whole.unionByName(map_batches(cut.drop("part", "row"), check, piece))
