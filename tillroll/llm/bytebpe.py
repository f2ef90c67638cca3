"""Byte-level BPE ids of texts, exactly those of a tokenizers file, with words encoded once per Python worker.

Words are cut before blanks and line ends that follow another character: no token of the file's splitting pattern
reaches over such a place. Texts with other white space or with a special token's string are encoded whole.
"""

from __future__ import annotations

import base64
import json
from functools import lru_cache

import numpy as np

from tillroll.llm.words import WordStore, code_points, groups

# White space that pattern dialects may treat in different ways.
ODD_SPACE = [*range(0x09, 0x0A), *range(0x0B, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200E), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]


class ByteBpe:
    """``path`` is a tokenizers file; ``ranks`` holds the same vocabulary as ranks and ``pattern`` splits texts."""

    def __init__(self, path: str, ranks: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f).get("added_tokens", [])]
        with open(ranks, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encode_word = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
        self.kind = np.dtype(np.uint16 if self.whole.get_vocab_size() <= 65536 else np.uint32)
        self.odd = np.zeros(0x110000, bool)
        self.odd[ODD_SPACE] = True
        self.store = WordStore(self._encode, self.kind)

    def _encode(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text, ends = codes.tobytes().decode("utf-32-le", "replace"), np.cumsum(sizes).tolist()
        found = [self.encode_word(text[a:b]) for a, b in zip([0, *ends], ends)]
        return np.array([i for f in found for i in f], np.int64), np.array([len(f) for f in found], np.int64)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for first, last in groups(texts):
            some = texts[first:last]
            odd = [any(s in t for s in self.special) for t in some]
            codes = code_points("".join(some))
            heads = np.cumsum([0] + [len(t) for t in some])
            strange = np.flatnonzero(self.odd[codes])
            for i in np.unique(np.searchsorted(heads, strange, side="right") - 1).tolist():
                odd[i] = True
            begins = np.zeros(len(codes) + 1, bool)
            begins[heads] = True
            begins[-1] = False
            blank = (codes == 0x20) | (codes == 0x0A)
            begins[1:-1] |= blank[1:] & ~blank[:-1]
            starts = np.flatnonzero(begins)
            ids, counts = self.store.look_up(codes, starts)
            total = np.concatenate([[0], np.cumsum(counts)])
            cuts = total[np.searchsorted(starts, heads)]
            for t, o, a, b in zip(some, odd, cuts, cuts[1:]):
                whole = self.whole.encode(t, add_special_tokens=False).ids if o else None
                out.append(ids[a:b] if whole is None else np.array(whole, self.kind))
        return out


@lru_cache(maxsize=2)
def load(path: str, ranks: str, pattern: str) -> ByteBpe:
    """The tokenizer of a file, once per Python worker."""
    return ByteBpe(path, ranks, pattern)
