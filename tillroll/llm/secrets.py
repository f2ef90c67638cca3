"""Secret scan: fixed patterns, plus character Markov models of random strings and of ordinary identifiers.

Base patterns (leftmost, non-overlapping per kind; a match that is too short is dropped after it was consumed):
assignments of passwords and the like, access key ids, long hexadecimal strings. Beside them every run of at least
``RUN`` key characters outside base spans, not digits alone, is scored by the log-likelihood ratio of two first-order character
models, per character, and reported as kind ``random`` above a threshold. Of a run with ``=`` or ``/`` only the neighbouring
parts are reported whose ratios lift their sum above the threshold, or the whole if its mean alone is above. The models are trained from labelled
samples: the values that base patterns find and drawn random strings on the one side, words of identifier characters
outside base spans on the other. These words carry no label and may be keys, so the identifier model is the second part
of a mixture with the random one: a word counts as far as it is not random. The threshold is that of held-back ordinary
words joined to long identifiers, so keys among the words do not move it.

Spans are code point offsets, end exclusive. Null text counts as empty; empty text has no spans. Rows are
independent; repeated rows repeat; columns besides id and text are ignored. Without any text to learn from, the
identifier model is uniform.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import Batches, batch_of, map_batches, sampled, texts_of

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
# The words an assignment must hold, to skip texts without any.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")

# Shortest run of key characters that the models judge.
RUN = 16
KEY_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = np.full(256, -1, np.int16)
_CODE[np.frombuffer(KEY_CHARACTERS.encode(), np.uint8)] = np.arange(len(KEY_CHARACTERS))
_IN_RUN = _CODE >= 0
_RUNS = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % RUN)
STATES = len(KEY_CHARACTERS)
# Characters that end a part of a run; the next one follows as at a start.
_EDGE = np.isin(np.arange(STATES), [KEY_CHARACTERS.index(c) for c in "=/"])
_PARTS = re.compile(r"[^=/]+|[=/]")
SMOOTHING, BACKING = 0.5, 5.0
# Bound of the fitted sample: documents in hash order of id and text.
SAMPLE_DOCS = 2000
DRAWN = 4000
SEED = 11
# Steps of the mixture fit; the share of random words it starts from and stays above.
STEPS, SHARE = 6, 1e-3
JOINS = ("_", "-", "/", "=", "")
# Least log-likelihood ratio per character, and the share of kept-back identifiers that may pass.
LEAST_RATIO = 0.5
FALSE_SHARE = 1e-3
# Bounds of the fitted sample: strings of one label, characters of one of them, and words of one document (in hash order).
STRINGS, STRING, WORDS = 20_000, 200, 200

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and kind."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    # A hexadecimal span lies in a run of key characters.
    for start, run in key_runs(text):
        for m in HEX.finditer(run):
            if m.end() - m.start() >= HEX_LEAST:
                out.append((start + m.start(), 2, start + m.end()))
    return sorted(out)


def key_runs(text: str) -> list[tuple[int, str]]:
    """(code point offset, run) of the maximal runs of key characters with RUN or more of them."""
    raw = text.encode("utf-8", "replace")
    if len(raw) < RUN:
        return []
    breaks = np.flatnonzero(~_IN_RUN[np.frombuffer(raw, np.uint8)])
    edges = np.concatenate([[-1], breaks, [len(raw)]])
    # Code points up to each byte, where they are not the bytes themselves.
    points = None if len(raw) == len(text) else np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    out = []
    for i in np.flatnonzero(np.diff(edges) > RUN):
        start, end = int(edges[i]) + 1, int(edges[i + 1])
        out.append((start if points is None else int(points[start]), raw[start:end].decode()))
    return out


def covered(spans: list[Span]) -> list[tuple[int, int]]:
    """What spans cover, as disjoint ranges in order. ``spans`` are sorted by start."""
    out: list[tuple[int, int]] = []
    for start, _, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def meeting(ranges: list[tuple[int, int]], places: Iterable[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """For each of the disjoint ``places``, in order, the ``ranges`` that it meets: one sweep over both."""
    first = 0
    for start, end in places:
        while first < len(ranges) and ranges[first][1] <= start:
            first += 1
        last = first
        while last < len(ranges) and ranges[last][0] < end:
            last += 1
        yield ranges[first:last]
        first = max(first, last - 1)  # the last one may reach into the next place


def _codes(run: str) -> np.ndarray:
    return _CODE[np.frombuffer(run.encode(), np.uint8)]


def _before(codes: np.ndarray) -> np.ndarray:
    """The state before each character of a run: the character before, or a start."""
    out = np.concatenate([[STATES], codes[:-1]]).astype(np.int64)
    out[1:][_EDGE[codes[:-1]]] = STATES
    return out


def _heaviest(parts: list[tuple[int, int]], over: np.ndarray) -> list[tuple[int, int]]:
    """The maximal segments of positive weight over neighbouring parts (Ruzzo and Tompa), by the cumulated weights."""
    out: list[tuple[int, int, int]] = []  # with the number of the last segment that starts lower, -1 without one
    for start, end in parts:
        if over[end] <= over[start]:
            continue
        while True:
            j = len(out) - 1
            while j >= 0 and over[out[j][0]] >= over[start]:
                j = out[j][2]
            if j < 0 or over[out[j][1]] >= over[end]:
                break
            start = out[j][0]
            del out[j:]
        out.append((start, end, j))
    return [(start, end) for start, end, _ in out]


@dataclass
class SecretModel:
    ratio: np.ndarray  # log-likelihood ratio of each transition, the first row from the start
    threshold: float

    def ratios(self, run: str) -> np.ndarray:
        """Log-likelihood ratio of each of the run's characters, over 0 where random is likelier."""
        codes = _codes(run)
        return self.ratio[_before(codes), codes]

    def value(self, run: str) -> float:
        return float(self.ratios(run).mean())

    def random_parts(self, run: str) -> list[tuple[int, int]]:
        """(start, end) of what is random in a run."""
        if len(run) < RUN or run.isdigit():
            return []
        over = np.concatenate([[0.0], np.cumsum(self.ratios(run) - self.threshold)])
        whole = [(0, len(run))] if over[-1] > 0 else []
        if "=" not in run and "/" not in run:
            return whole
        found = []
        for start, end in _heaviest([m.span() for m in _PARTS.finditer(run)], over):
            start, end = end - len(run[start:end].lstrip("=/")), start + len(run[start:end].rstrip("=/"))
            if not run[end:].strip("="):  # padding
                end = len(run)
            if end - start >= RUN and not run[start:end].isdigit():
                found.append((start, end))
        return found or whole

    def spans(self, text: str) -> list[Span]:
        base = base_spans(text)
        found = []
        runs = key_runs(text)
        for (at, run), met in zip(runs, meeting(covered(base), [(at, at + len(run)) for at, run in runs])):
            edges, end = [], at  # what base spans leave of the run
            for start, stop in met:
                edges.append((end, start))
                end = stop
            for start, stop in (*edges, (end, at + len(run))):
                found += [(start + a, 3, start + b) for a, b in self.random_parts(run[start - at : max(stop, start) - at])]
        return sorted(base + found)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


class Encoded:
    """The transitions of many strings in flat arrays."""

    def __init__(self, strings: list[str]) -> None:
        codes = _codes("".join(strings)).astype(np.int64)
        size = np.array([len(s) for s in strings], np.int64)
        self.count, self.owner, self.to = len(strings), np.repeat(np.arange(len(strings)), size), codes
        self.of = _before(codes) if len(codes) else codes
        self.of[np.cumsum(size) - size] = STATES  # no string is empty

    def transitions(self, weight: np.ndarray) -> np.ndarray:
        flat = np.bincount(self.of * STATES + self.to, weight[self.owner], (STATES + 1) * STATES)
        return flat.reshape(STATES + 1, STATES)

    def totals(self, ratio: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, ratio[self.of, self.to], self.count)


def _logs(total: np.ndarray) -> np.ndarray:
    single = total.sum(axis=0) + SMOOTHING
    total = total + BACKING * single / single.sum()  # unseen transitions fall back to how frequent a character is
    return np.log(total / total.sum(axis=1, keepdims=True))


def _joined(words: list[str], rng: np.random.Generator) -> list[str]:
    """DRAWN identifiers of RUN or more characters, made of the words."""
    out = []
    for i in range(DRAWN if words else 0):
        least, join, some, long = int(rng.integers(RUN, 48)), JOINS[i % len(JOINS)], [], 0
        while long < least:
            word = words[int(rng.integers(len(words)))]
            some.append(word if join else word[0].upper() + word[1:])
            long += len(word) + len(join)
        run = join.join(some)
        out.append(run if len(run) >= RUN else run + join)
    return out


def train(random_runs: list[str], plain_runs: list[str]) -> SecretModel:
    """Two smoothed transition tables; the threshold from ordinary words kept back."""
    rng = np.random.default_rng(SEED)
    alphabets = [KEY_CHARACTERS[:62], KEY_CHARACTERS[:64], KEY_CHARACTERS[52:62] + "abcdef", KEY_CHARACTERS[:26] + KEY_CHARACTERS[52:62]]
    drawn = [
        "".join(rng.choice(list(alphabets[i % len(alphabets)]), int(rng.integers(RUN, 48)))) for i in range(DRAWN)
    ]
    clean = lambda runs: [r for r in (re.sub(r"[^A-Za-z0-9+/_=-]", "", r)[:STRING] for r in runs) if r]
    random_runs, plain_runs = clean(random_runs) + drawn, sorted(clean(plain_runs))
    fitted, kept = plain_runs[0::4] + plain_runs[1::4] + plain_runs[2::4], plain_runs[3::4]
    random, inside = Encoded(random_runs), Encoded(fitted)
    random_logs = _logs(random.transitions(np.ones(random.count)))
    digits = np.array([r.isdigit() for r in fitted], bool)
    doubt, share = np.zeros(inside.count), SHARE  # how likely a word is random
    for _ in range(STEPS):
        ratio = random_logs - _logs(inside.transitions(1 - doubt))
        odds = inside.totals(ratio) + np.log(share / (1 - share))
        doubt = np.where(digits, 0, 1 / (1 + np.exp(-np.clip(odds, -50, 50))))
        share = min(max(SHARE, float(doubt.mean()) if len(doubt) else 0), 0.5)
    ordinary = [r for r, d in zip(fitted, doubt) if d < 0.5]
    joined = Encoded(_joined(ordinary, rng))
    ratio = random_logs - _logs(inside.transitions(1 - doubt) + joined.transitions(np.ones(joined.count)))
    model = SecretModel(ratio, LEAST_RATIO)
    odds = Encoded(kept).totals(ratio) + np.log(share / (1 - share))
    ordinary = [r for r, o in zip(kept, odds) if o < 0]
    runs = [r for r in ordinary if len(r) >= RUN and not r.isdigit()] + _joined(ordinary, rng)
    if runs:
        model.threshold = max(LEAST_RATIO, float(np.quantile([model.value(r) for r in runs], 1 - FALSE_SHARE)))
    return model


_WORD = re.compile(r"[A-Za-z0-9_][A-Za-z0-9_-]{3,}")


def _samples(batches: Batches) -> Batches:
    """(label, string): the values base patterns find, and identifier runs that meet no base span."""
    for batch in batches:
        labels, strings = [], []
        for text in texts_of(batch):
            spans = base_spans(text)
            for start, kind, end in spans:
                value = text[start:end]
                labels.append(True)
                strings.append((ASSIGN.match(value)[2] if kind == 0 else value)[:STRING])
            places = [m.span() for m in _WORD.finditer(text)]
            free = {text[a:b][:STRING] for (a, b), met in zip(places, meeting(covered(spans), places)) if not met}
            words = sorted(free, key=lambda w: (zlib.crc32(w.encode()), w))[:WORDS]
            labels += [False] * len(words)
            strings += words
        yield batch_of(secret=pa.array(labels, pa.bool_()), run=pa.array(strings, pa.string()))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> SecretModel:
    """Train on the strings of SAMPLE_DOCS documents (at most STRINGS strings of each label, in hash order)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.lit(0).alias("label"))
    some = sampled(rows, "label", SAMPLE_DOCS)
    strings = map_batches(some.select("text"), _samples, "secret boolean, run string").distinct()
    taken = {
        label: [r.run for r in strings.where(F.col("secret") == label).orderBy(F.xxhash64("run"), "run").limit(STRINGS).collect()]
        for label in (True, False)
    }
    return train(taken[True], taken[False])


def scan(docs: DataFrame, model: SecretModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id and its spans (kind, start, end), by start and kind."""

    def run(batches: Batches) -> Batches:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in model.spans(t)] for t in texts_of(batch)
            ]
            yield batch_of(doc_id=batch.column("doc_id"), spans=pa.array(spans, kind))

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    return map_batches(rows, run, schema)


def redact(docs: DataFrame, model: SecretModel, mark: str = "[secret]") -> DataFrame:
    """The documents with the text of every span replaced by ``mark``; overlapping spans are replaced as one."""
    at = docs.columns.index("text")

    def clean(text: str | None) -> str | None:
        spans = model.spans(text or "")
        if not spans:
            return text
        out, last = [], 0
        for start, _, end in spans:
            if start >= last:
                out += [text[last:start], mark]
            last = max(last, end)
        return "".join(out) + text[last:]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = pa.array([clean(t) for t in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [texts if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names
            )

    return map_batches(docs, run, docs.schema)


def digest(spans: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] != "random")
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
