"""SentencePiece encoding and decoding by vectorised merge rounds over flat symbol arrays.

Words are cut where no piece of the model can reach across. The words that were not met before are encoded together:
one flat array of symbols, the rank of each adjacent pair, the minimum rank per word by a segmented reduction, then
all leftmost merges of that rank in every word at once, and compaction, until no pair is left in any word. Where a
merge makes a pair of lower rank, later merges of the word wait for the next round, so the result is that of one
merge at a time. Symbols that are no piece become bytes.

Null text counts as empty; empty text has no ids. Rows are independent; repeated rows repeat; columns besides id and
text are ignored. Only BPE models with identity normalisation, a dummy prefix and byte fallback are taken; others
raise ``ValueError``.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import Batches, batch_of, map_batches, texts_of
from tillroll.llm.words import WordStore, code_points, groups, ranges

SPACE = "▁"
NO_PAIR = np.int64(1 << 40)
_SHIFT = 21  # symbols are fewer than 2 ** 21


class PieceModel:
    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("a BPE model with identity normalisation is needed")
        if not (norm.add_dummy_prefix and norm.escape_whitespaces) or 6 not in kinds or kinds & {4, 5}:
            raise ValueError("a model with dummy prefix, escaped blanks and byte fallback is needed")
        self.pieces = [p.piece for p in model.pieces]
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        self.kind = np.dtype(np.uint16 if len(self.pieces) <= 65536 else np.uint32)
        self.bytes = np.zeros(256, np.int64)
        self.raw: list[bytes] = [p.piece.replace(SPACE, " ").encode() if p.type == 1 else b"" for p in model.pieces]
        self.is_byte = np.array([p.type == 6 for p in model.pieces])
        for i, p in enumerate(model.pieces):
            if p.type == 6:
                self.bytes[int(p.piece[3:5], 16)] = i
                self.raw[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == 2:
                self.raw[i] = model.trainer_spec.unk_surface.encode()
        # Symbols: pieces by id, then other characters of pieces, then (per call) characters unknown to the model.
        symbols = dict(normal)
        for piece in normal:
            for c in piece:
                if c not in symbols:
                    symbols[c] = len(self.pieces) + len(symbols)
        self.symbols = symbols
        self.first_other = max(symbols.values(), default=0) + 1
        order = {s: i for i, s in enumerate(sorted({p.score for p in model.pieces if p.type == 1}, reverse=True))}
        keys, ranks, merged = [], [], []
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append((left << _SHIFT) | right)
                    ranks.append(order[model.pieces[i].score])
                    merged.append(i)
        at = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[at]
        self.ranks, self.merged = np.array(ranks, np.int64)[at], np.array(merged, np.int64)[at]
        # Symbol of each character; one that no piece holds is a symbol of its own.
        self.of_char = np.arange(0x110000, dtype=np.int64) + self.first_other
        for c, i in symbols.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in normal):
            raise ValueError("no piece may hold a blank inside")
        # A word starts at a run of blanks; characters of no longer piece stand alone.
        joined = {c for p in normal if len(p) > 1 for c in p}
        self.alone = np.array([ord(c) for c in "\n\t\r" if c not in joined], np.uint32)
        ends = np.cumsum([len(r) for r in self.raw])
        self.raw_sizes = np.array([len(r) for r in self.raw])
        self.raw_starts, self.raw_bytes = ends - self.raw_sizes, np.frombuffer(b"".join(self.raw), np.uint8)
        digits = [f"{i},".encode() for i in range(len(self.pieces))]
        self.number_sizes = np.array([len(d) for d in digits])
        self.number_starts = np.cumsum(self.number_sizes) - self.number_sizes
        self.number_bytes = np.frombuffer(b"".join(digits), np.uint8)
        self.store = WordStore(self.encode_words, self.kind)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs."""
        key = (left << _SHIFT) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_PAIR), np.where(hit, self.merged[at], -1)

    def encode_words(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all (non-empty) words in turn, and how many each has."""
        sym, word = self.of_char[codes], np.repeat(np.arange(len(sizes)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, new = self._ranked(sym, word)
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(starts, len(sym)))
            least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            ended = least == NO_PAIR
            if ended.any():  # compaction
                done.append((word[ended], sym[ended]))
                live = ~ended
                sym, word, rank, new, least = sym[live], word[live], rank[live], new[live], least[live]
                if not len(sym):
                    break
            take = self._leftmost(rank == least)
            at = np.flatnonzero(take)
            # Pairs that each merge makes while those to its right have not happened yet.
            before, after = at - 1, at + 2
            inside = (before >= 0) & (word[np.maximum(before, 0)] == word[at])
            left = np.where(take[np.maximum(at - 2, 0)] & (at >= 2), new[np.maximum(at - 2, 0)], sym[np.maximum(before, 0)])
            lower = inside & (self._pairs(left, new[at])[0] < least[at])
            within = (after < len(sym)) & (word[np.minimum(after, len(sym) - 1)] == word[at])
            lower |= within & (self._pairs(new[at], sym[np.minimum(after, len(sym) - 1)])[0] < least[at])
            if lower.any():  # of each word, keep merges up to its first that makes a lower pair
                past = np.cumsum(lower) - lower
                firsts = np.flatnonzero(np.concatenate([[True], word[at][1:] != word[at][:-1]]))
                base = np.repeat(past[firsts], np.diff(np.append(firsts, len(at))))
                at = at[past == base]
            sym[at] = new[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            sym, word, rank, new = sym[keep], word[keep], rank[keep], new[keep]
            touched = place[at]
            marked = np.zeros(len(sym), bool)
            marked[touched] = marked[np.maximum(touched - 1, 0)] = True
            touched = np.flatnonzero(marked)
            rank[touched], new[touched] = self._ranked(sym, word, touched)
        owner, ids = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
        by = np.argsort(owner, kind="stable")
        owner, ids = owner[by], ids[by]
        if (ids >= len(self.pieces)).any():
            owner, ids = self._as_bytes(owner, ids)
        return ids, np.bincount(owner, minlength=len(sizes))

    def _ranked(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray | None = None):
        """Rank and merged symbol of the pairs that begin at the places."""
        at = np.arange(len(sym)) if at is None else at
        after = np.minimum(at + 1, len(sym) - 1)
        rank, new = self._pairs(sym[at], sym[after])
        apart = (at + 1 >= len(sym)) | (word[at] != word[after])
        return np.where(apart, NO_PAIR, rank), new

    @staticmethod
    def _leftmost(found: np.ndarray) -> np.ndarray:
        """Of overlapping finds (neighbouring places), the leftmost ones that do not overlap."""
        at = np.flatnonzero(found)
        if not len(at):
            return found
        first = np.concatenate([[True], np.diff(at) > 1])
        run = at - at[np.flatnonzero(first)[np.cumsum(first) - 1]]
        out = np.zeros_like(found)
        out[at[run % 2 == 0]] = True
        return out

    def _as_bytes(self, owner: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes in the place of symbols that are no piece."""
        others = np.flatnonzero(ids >= len(self.pieces))
        names = {i: s for s, i in self.symbols.items() if len(s) == 1 and i >= len(self.pieces)}
        name = lambda i: names[i] if i < self.first_other else chr(i - self.first_other)
        raw = {i: self.bytes[list(name(i).encode("utf-8", "replace"))] for i in np.unique(ids[others]).tolist()}
        sizes = np.ones(len(ids), np.int64)
        sizes[others] = [len(raw[i]) for i in ids[others].tolist()]
        out, starts = np.repeat(ids, sizes), np.cumsum(sizes) - sizes
        for at, i in zip(starts[others].tolist(), ids[others].tolist()):
            out[at : at + len(raw[i])] = raw[i]
        return np.repeat(owner, sizes), out

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray] = []
        for first, last in groups(texts):
            some = [SPACE + t if t else "" for t in texts[first:last]]
            codes = code_points("".join(some)).copy()
            codes[codes == ord(" ")] = ord(SPACE)
            heads = np.cumsum([0] + [len(t) for t in some])
            begins = np.zeros(len(codes) + 1, bool)
            begins[heads] = True
            blank, alone = codes == ord(SPACE), np.isin(codes, self.alone)
            begins[1:-1] |= (blank[1:] & ~blank[:-1]) | alone[1:] | alone[:-1]
            begins[-1] = False
            starts = np.flatnonzero(begins)
            ids, counts = self.store.look_up(codes, starts)
            total = np.concatenate([[0], np.cumsum(counts)])
            cuts = total[np.searchsorted(starts, heads)]
            out += [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def numbers(self, ids: np.ndarray) -> bytes:
        """The ids in decimals, joined by commas."""
        at = ids.astype(np.int64)
        return self.number_bytes[ranges(self.number_starts[at], self.number_sizes[at])].tobytes()[:-1]

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, bytes put together, without the dummy prefix."""
        at = ids.astype(np.int64)
        whole = self.raw_bytes[ranges(self.raw_starts[at], self.raw_sizes[at])].tobytes()
        try:
            text = whole.decode()
        except UnicodeDecodeError:  # bytes that form no character become U+FFFD, each alone
            text = "".join(self._runs(ids))
        return text[1:] if len(ids) and self.pieces[int(ids[0])].startswith(SPACE) else text

    def _runs(self, ids: np.ndarray):
        edges = np.flatnonzero(np.diff(self.is_byte[ids])) + 1
        for part in np.split(ids, edges):
            data = b"".join([self.raw[i] for i in part.tolist()])
            at = 0
            while at < len(data):
                for size in (1, 2, 3, 4):
                    try:
                        char = data[at : at + size].decode()
                        break
                    except UnicodeDecodeError:
                        char = ""
                yield char or "�"
                at += size if char else 1


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    """The model of a file, once per Python worker."""
    return PieceModel(path)


def tokenize(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids (array of int), decoded text."""

    def run(batches: Batches) -> Batches:
        model = load(path)
        for batch in batches:
            ids = model.encode_batch(texts_of(batch))
            yield batch_of(
                doc_id=batch.column("doc_id"),
                ids=pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
                decoded=pa.array([model.decode(i) for i in ids], pa.string()),
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {kind}, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``tokenize``, but hashes of the ids and the decoded text (taken in the task) instead of them."""

    def run(batches: Batches) -> Batches:
        model = load(path)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            found = model.encode_batch(texts_of(batch))
            yield batch_of(
                doc_id=batch.column("doc_id"),
                n_tokens=pa.array([len(i) for i in found], pa.int64()),
                ids_sha256=pa.array([sha(model.numbers(i)) for i in found], pa.string()),
                decoded_sha256=pa.array([sha(model.decode(i).encode()) for i in found], pa.string()),
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
