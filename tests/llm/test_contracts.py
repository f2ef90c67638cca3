"""Columns, types and ranges of the registered queries, and scores of the learnt operators against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import langid, quality, queries, toxicity
from tillroll.session import ship

SF = "/root/testdata/sf0.001"
# The columns that each contract names.
CONTRACTS = {
    "op2_simhash_neardup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op3_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op5_nearest": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op6_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op7_secrets": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op8_sentencepiece": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op10_fingerprints": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op11_divergence": {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"},
    "op12_bestfit": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op13_variants": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
}


@pytest.mark.parametrize("name", CONTRACTS)
def test_columns_of_the_contract(spark, name):
    df = queries.QUERIES[name](spark, SF)
    kinds = dict(df.dtypes)
    assert {c: kinds.get(c) for c in CONTRACTS[name]} == CONTRACTS[name]
    rows = df.collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if "held_out" in kinds:
        assert len(rows) == docs.count()
        for r in rows:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    if name == "op3_toxicity":
        assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    if name == "op4_language_id":
        assert {r.lang_pred for r in rows} <= {r.lang for r in docs.select("lang").distinct().collect()} | {"und"}
    if name in ("op6_packing", "op12_bestfit"):
        ends = Counter()
        for r in rows:
            ends[r.doc_id] += r.length
        assert len(ends) == docs.count() and max(r.offset + r.length for r in rows) <= (1024 if name == "op6_packing" else 2048)


def test_probabilities_equal_a_dense_softmax():
    rng = np.random.default_rng(1)
    names = ["aa", "bb", "cc"]
    table = np.vstack([rng.normal(size=(langid.BUCKETS, 3)).astype(np.float32), np.zeros((1, 3), np.float32)])
    model = langid.LanguageModel(names, table, rng.normal(size=3), temperature=0.7, reject_below=0.5)
    texts = ["", "12 !?", "one two three", "ñandú über Straße", "x", "шум мир дом " * 50, "a b c d"]
    got, found = model.probabilities(texts)
    for text, p, n in zip(texts, got, found):
        ids, counts = langid.count_subwords(text)
        logits = sum((c * table[i].astype(float) for i, c in zip(ids, counts)), np.zeros(3)) / max(int(counts.sum()), 1)
        z = np.exp((logits + model.bias) / 0.7)
        assert n == counts.sum() and np.allclose(p, z / z.sum(), atol=1e-6)
    pred, score, rejected = model.predict(texts)
    for p, n, name, s, r in zip(got, found, pred, score, rejected):
        assert (name, s) == ((names[p.argmax()], p.max()) if n else ("und", 0.0)) and r == (s < 0.5 or not n)


def hand_events(grammar, text):
    """The clauses' events by plain counters instead of a product automaton."""
    out, events = [], []
    since = dict.fromkeys((toxicity.NEGATION, toxicity.TARGET, toxicity.THREAT, toxicity.INSULT), 99)
    reporting = quoted = False
    last = 0.0
    for token in re.findall(r"[^\W\d_]+|[.!?;\n\"“”„«»]", text.lower()):
        if token in ".!?;\n":
            out += [events] if events else []
            events, reporting, quoted, last = [], False, False, 0.0
            since = dict.fromkeys(since, 99)
            continue
        kind, weight = grammar.classify(token)
        last = weight or last
        on = {k: v < toxicity.REACH for k, v in since.items()}
        # A report begins to hold at its own word; a quotation mark opens or closes and is no part of what it holds.
        if kind == toxicity.QUOTE:
            quoted = not quoted
            reporting = False
            held = False
        else:
            reporting = reporting or kind == toxicity.REPORT
            held = quoted or reporting
        free = not (on[toxicity.NEGATION] or held)
        if kind == toxicity.INSULT:
            event = toxicity.REPORTED if held else toxicity.NEGATED if on[toxicity.NEGATION] else toxicity.TARGETED if on[toxicity.TARGET] else toxicity.PLAIN
            events.append((event, weight or 0.5 * last))
        elif kind == toxicity.TARGET and on[toxicity.THREAT] and free:
            events.append((toxicity.THREATENED, 1.0))
        elif kind == toxicity.TARGET and on[toxicity.INSULT] and free:
            events.append((toxicity.TARGETED, weight or 0.5 * last))
        since = {k: 0 if k == kind else v + 1 for k, v in since.items()}
    return out + ([events] if events else [])


def test_automaton_equals_counters():
    grammar = toxicity.Grammar({"idiot$": 4.0, "scumm": 2.0})
    rng = random.Random(5)
    words = ["idiot", "scummy", "you", "not", "kill", "the", "cat", ".", ";", "never", "they", "house", "hurt", "a", "said", '"']
    for _ in range(3000):
        text = " ".join(rng.choices(words, k=rng.randint(0, 14)))
        assert grammar.clauses(text) == hand_events(grammar, text), text


def strength(n, s, center):
    n, rate, center = (np.asarray(x, float) for x in (n, np.asarray(s) / np.asarray(n), center))
    center = np.broadcast_to(center, n.shape)
    inside = (n * center * (1 - center)).sum()
    between = max(((n * (rate - center) ** 2).sum() - (center * (1 - center)).sum()) / n.sum(), 0)
    low, high = quality.STRENGTHS
    return float(np.clip(inside / n.sum() / between - 1, low, high)) if between > 0 else high


def test_posteriors_equal_the_formula(spark):
    ship(spark)
    rng = random.Random(7)
    words = "the river runs past an old stone house and nobody minds it at all".split()
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30))), f"h{min(rng.randrange(4), rng.randrange(4))}", f"p{rng.randrange(3)}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    marks = spark.createDataFrame([(i, int(rng.random() < 0.3 + 0.2 * (i % 3))) for i in range(0, 200, 2)], "doc_id long, quality int")
    model = quality.QualityModel(np.zeros(quality.FEATURES), np.ones(quality.FEATURES), np.linspace(-0.2, 0.3, quality.FEATURES + 1))
    own = model.probabilities([r[1] for r in rows])
    label = {r.doc_id: r.quality for r in marks.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    e = np.array([label.get(r[0], p) for r, p in zip(rows, own)], float)
    hosts, paths = np.array([r[2] for r in rows]), np.array([r[2] + "/" + r[3] for r in rows])
    rate = (e.sum() + 0.5) / (len(e) + 1)
    of = lambda keys: {k: ((keys == k).sum(), e[keys == k].sum()) for k in set(keys)}
    by_host, by_path = of(hosts), of(paths)
    strong_host = strength(*zip(*by_host.values()), rate)
    host_rate = {k: (s + strong_host * rate) / (n + strong_host) for k, (n, s) in by_host.items()}
    strong_path = strength(*zip(*by_path.values()), [host_rate[k.split("/")[0]] for k in by_path])
    got = {r.doc_id: r for r in quality.classify(docs, marks, model).collect()}
    logit = lambda p: np.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    for i, (doc_id, *_) in enumerate(rows):
        (hn, hs), (n, s) = by_host[hosts[i]], by_path[paths[i]]
        host = (hs - e[i] + strong_host * rate) / (hn - 1 + strong_host)
        site = (s - e[i] + strong_path * host) / (n - 1 + strong_path)
        score = 1 / (1 + np.exp(-(logit(own[i]) + logit(site) - logit(rate))))
        assert got[doc_id].site == pytest.approx(site) and got[doc_id].score == pytest.approx(score)
        assert got[doc_id].keep == (got[doc_id].score >= quality.KEEP)
