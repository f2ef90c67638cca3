"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five small transducers read the words of a clause: insult, threat, target (who is meant), negation and reported
speech. Their product is one automaton whose outputs are events (plain, targeted, negated or reported insult;
threat) with the weight of the insult that fired them. A clause matches if it has events; a document is scored from
its matched clauses by a logistic function. The insult words and word stems and their weights are learnt from the
labels, as is the logistic function; the closed word classes are fixed.

Defined results: null and empty texts score as a text without matched clauses. With no learnable label of a kind the
score is the smoothed share of toxic labels. Rows are independent; repeated rows repeat; columns besides id and text
are ignored; a document with several labels counts as toxic if one says so.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import Batches, batch_of, keep_batches, learnable, logistic, map_batches, sampled, sigmoid, texts_of
from tillroll.session import stage

# Bound of the fitted sample: labelled rows of each label, in hash order of the id.
ROWS_PER_LABEL = 4000
# Bound of the learnt lexicon.
LEXICON = 4096
STEMS = range(3, 9)
THRESHOLD = 0.3
# Words a negation, a target or a threat reaches.
REACH = 3
CACHE = 300_000

# The closed word classes of the grammar.
TARGETS = "you your yours u ur they them he she him her du dich dir ihr euch sie tu te toi vous ils elles tú vosotros ustedes ellos".split()
NEGATIONS = "not no never nobody without isn aren wasn don doesn nicht kein keine nie ohne pas jamais sans ni nunca sin".split()
REPORTS = "said says say told wrote writes called quoted quote claimed reported sagte schrieb nannte dit écrit appelé dijo escribió llamó".split()
THREATS = "kill hurt destroy beat shoot stab burn attack die töten schlagen vernichten tuer frapper détruire matar golpear destruir".split()

OTHER, TARGET, NEGATION, REPORT, THREAT, INSULT, QUOTE = range(7)
PLAIN, TARGETED, NEGATED, REPORTED, THREATENED = range(5)
_TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n\"“”„«»]")
_WORD = re.compile(r"[^\W\d_]+")
_ENDS = frozenset(".!?;\n")


# Each transducer maps (state, class of the word) to (next state, is it active at this word?).
def _fading(trigger: int):
    """Active for REACH words after a word of the class."""
    return lambda state, kind: (REACH if kind == trigger else max(state - 1, 0), state > 0)


def _reporting(state: int, kind: int) -> tuple[int, bool]:
    """Active from a reporting word to the clause's end, and between quotation marks (2)."""
    if kind == QUOTE:
        return (0 if state == 2 else 2), False
    return (max(state, 1) if kind == REPORT else state), state > 0


TRANSDUCERS = (_fading(NEGATION), _reporting, _fading(TARGET), _fading(THREAT), _fading(INSULT))


def compose() -> list[list[tuple[int, int]]]:
    """The product automaton: for each reached state and word class, the next state and the event (-1: none)."""
    numbers: dict[tuple, int] = {(0,) * len(TRANSDUCERS): 0}
    todo, table = list(numbers), []
    for state in todo:
        row = []
        for kind in range(7):
            steps = [t(s, kind) for t, s in zip(TRANSDUCERS, state)]
            after = tuple(s for s, _ in steps)
            negated, reported, targeted, threatened, insulted = (on for _, on in steps)
            event = -1
            if kind == INSULT:
                event = REPORTED if reported else NEGATED if negated else TARGETED if targeted else PLAIN
            elif kind == TARGET and threatened and not (negated or reported):
                event = THREATENED
            elif kind == TARGET and insulted and not (negated or reported):
                event = TARGETED
            if after not in numbers:
                numbers[after] = len(numbers)
                todo.append(after)
            row.append((numbers[after], event))
        table.append(row)
    return table


AUTOMATON = compose()
FEATURES = 9


def word_grams(word: str) -> list[str]:
    """The whole word (marked by $) and its proper stems."""
    return [word + "$", *(word[:k] for k in STEMS if k < len(word))]


@dataclass
class Grammar:
    lexicon: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))

    def __post_init__(self) -> None:
        self._known: dict[str, tuple[int, float]] = {}
        self._closed: dict[str, tuple[int, float]] = {'"': (QUOTE, 0.0)} | {q: (QUOTE, 0.0) for q in "“”„«»"}
        for words, kind in ((REPORTS, REPORT), (NEGATIONS, NEGATION), (TARGETS, TARGET), (THREATS, THREAT)):
            self._closed |= {w: (kind, 0.0) for w in words}

    def __getstate__(self):
        return {"lexicon": self.lexicon, "weights": self.weights}

    def __setstate__(self, state) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def classify(self, word: str) -> tuple[int, float]:
        found = self._known.get(word)
        if found is None:
            weight = max((self.lexicon.get(g, 0.0) for g in word_grams(word)), default=0.0)
            found = (INSULT, weight) if weight > 0 else self._closed.get(word, (OTHER, 0.0))
            if len(self._known) >= CACHE:
                self._known.clear()
            self._known[word] = found
        return found

    def clauses(self, text: str) -> list[list[tuple[int, float]]]:
        """The events (kind, weight) of each matched clause."""
        classify = self.classify
        text = text.lower()
        if not any(classify(w)[0] in (INSULT, THREAT) for w in set(_WORD.findall(text))):
            return []
        out, events, state, insult = [], [], 0, 0.0
        for token in _TOKEN.findall(text):
            if token in _ENDS:
                if events:
                    out.append(events)
                events, state, insult = [], 0, 0.0
                continue
            kind, weight = classify(token)
            insult = weight or insult
            state, event = AUTOMATON[state][kind]
            if event >= 0:
                events.append((event, 1.0 if event == THREATENED else weight or 0.5 * insult))
        if events:
            out.append(events)
        return out

    def features(self, text: str) -> list[float]:
        clauses = self.clauses(text)
        if not clauses:
            return [0.0] * FEATURES
        mass = [0.0] * 5
        strengths = []
        for events in clauses:
            for kind, weight in events:
                mass[kind] += weight
                strengths.append(weight)
        strengths.sort(reverse=True)
        return [
            strengths[0],
            strengths[1] if len(strengths) > 1 else 0.0,
            strengths[2] if len(strengths) > 2 else 0.0,
            *np.log1p(mass).tolist(),
            float(np.log1p(len(clauses))),
        ]

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(len(texts), FEATURES)
        return sigmoid(self.weights[0] + x @ self.weights[1:])


def lexicon(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Weights of grams: the lower bound of the log ratio of their document rates, where above 1."""
    if not toxic or not clean:
        return {}
    out = {}
    for gram, (bad, good) in counts.items():
        if bad >= 2:
            ratio = np.log((bad + 0.5) / (toxic + 1)) - np.log((good + 0.5) / (clean + 1))
            weight = ratio - 1.64 * np.sqrt(1 / (bad + 0.5) + 1 / (good + 0.5))
            if weight > 1:
                out[gram] = float(weight)
    best = sorted(out, key=lambda g: (-out[g] * counts[g][0], g))[:LEXICON]
    return {g: out[g] for g in best}


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, text, y, fold) of at most ``bound`` learnable rows of each label; fold 0 or 1 in halves.

    An id with several labels has the greatest. Rows of equal id and text count once.
    """
    known = labels.where(learnable() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    # No more labels than these are needed, as each stands for a row at least.
    known = sampled(known.withColumn("text", F.lit("")), "y", 2 * bound).select("doc_id", "y")
    rows = stage(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id"))
    return stage(sampled(rows, "y", bound).select("doc_id", "text", "y", (F.col("n") % 2).alias("fold")))


def _gram_counts(batches: Batches) -> Batches:
    """Documents of each (gram, fold, label), added up over the task."""
    total: Counter = Counter()

    def flush():
        keys = list(total)
        yield batch_of(
            gram=pa.array([k[0] for k in keys], pa.string()),
            fold=pa.array([k[1] for k in keys], pa.int32()),
            y=pa.array([k[2] for k in keys], pa.int32()),
            n=pa.array(total.values(), pa.int64()),
        )
        total.clear()

    for batch in batches:
        for text, y, fold in zip(texts_of(batch), batch.column("y").to_pylist(), batch.column("fold").to_pylist()):
            grams = {g for w in set(_WORD.findall(text.lower())) for g in word_grams(w)}
            total.update((g, fold, y) for g in grams)
            if len(total) > 10 * CACHE:
                yield from flush()
    yield from flush()


def fit(docs: DataFrame, labels: DataFrame) -> Grammar:
    """Learn the lexicon from a bounded sample of labelled rows; the logistic function from the halves kept back.

    Each half is scored with the lexicon of the other, so the logistic function sees weights as they are on new text.
    """
    sample = labelled_sample(docs, labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")), "toxic", ROWS_PER_LABEL)
    totals = Counter()
    for r in sample.groupBy("y", "fold").count().collect():
        totals[(int(r.fold), int(r.y > 0))] += r["count"]
    counted = map_batches(sample.select("text", "y", "fold"), _gram_counts, "gram string, fold int, y int, n long")
    cell = lambda f, y: F.sum(F.when((F.col("fold") == f) & (F.col("y") == y), F.col("n")).otherwise(0))
    grams = counted.groupBy("gram").agg(*(cell(f, y).alias(f"n{f}{y}") for f in (0, 1) for y in (0, 1)))
    bad, good = F.col("n01") + F.col("n11"), F.col("n00") + F.col("n10")
    n_bad, n_good = totals[(0, 1)] + totals[(1, 1)], totals[(0, 0)] + totals[(1, 0)]
    # The lexicon of either half holds few grams beyond these; four times its bound go to the driver at most.
    ratio = F.log((bad + 0.5) / (n_bad + 1)) - F.log((good + 0.5) / (n_good + 1))
    weight = ratio - 1.64 * F.sqrt(1 / (bad + 0.5) + 1 / (good + 0.5))
    best = grams.where(bad >= 2).withColumn("w", weight).where("w > 0.5").orderBy(F.desc(F.col("w") * bad), "gram")
    rows = best.limit(4 * LEXICON).collect()
    both = {r.gram: (r.n01 + r.n11, r.n00 + r.n10) for r in rows}
    grammar = Grammar(lexicon(both, n_bad, n_good))
    halves = [
        Grammar(lexicon({r.gram: (r[f"n{f}1"], r[f"n{f}0"]) for r in rows}, totals[(f, 1)], totals[(f, 0)]))
        for f in (0, 1)
    ]

    def measure(batches: Batches) -> Batches:
        for batch in batches:
            folds = batch.column("fold").to_pylist()
            x = [halves[1 - f].features(t) for t, f in zip(texts_of(batch), folds)]
            yield batch_of(x=pa.array(x, pa.list_(pa.float64())), y=batch.column("y"))

    # Bounded by the sample: FEATURES numbers a row.
    seen = map_batches(sample.select("text", "fold", F.col("y").cast("int").alias("y")), measure, "x array<double>, y int").collect()
    seen.sort(key=lambda r: (r.y, r.x))
    grammar.weights = logistic(np.array([r.x for r in seen]).reshape(len(seen), FEATURES), np.array([float(r.y > 0) for r in seen]))
    return grammar


def score(docs: DataFrame, grammar: Grammar, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, score, predicted (score >= THRESHOLD), clauses matched."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = texts_of(batch)
            s = grammar.scores(texts)
            yield batch_of(doc_id=batch.column("doc_id"), score=s, predicted=(s >= THRESHOLD).astype(np.int32))

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, run, f"doc_id {kind}, score double, predicted int")


def keep(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """The documents (all columns) that score below THRESHOLD."""
    return keep_batches(docs, lambda texts: grammar.scores(texts) < THRESHOLD)
