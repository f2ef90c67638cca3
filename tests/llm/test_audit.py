"""Divergence, best-fit packing and spelling variants against brute force, and their edge cases."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillroll.llm import bestfit, divergence, variants
from tillroll.session import ship

BYTES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
CLASHING = "doc_id long, text string, lang string, source string, term string, n int, rank string, part double, short int, word int"


def table(spark, rows):
    """doc_id, text, lang, source beside columns whose names the operators use."""
    ship(spark)
    return spark.createDataFrame([(*r, "x", 1, "y", 2.0, 3, 4) for r in rows], CLASHING)


# Divergence.


def brute_divergence(rows, least=10, top=10):
    docs = [(r[2] or "", r[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or ""))) for r in rows]
    held, counts, totals = Counter(), defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        held.update((lang, t) for t in set(terms))
        counts[lang, source].update(terms)
        totals[lang].update(terms)
    out = set()
    for lang in totals.keys() | {d[0] for d in docs}:
        kept = [t for t in totals[lang] if held[lang, t] >= least]
        v = len(kept)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[k] for k in kept) + 2 * v) for t in kept}
        p = {s: share(counts[lang, s]) for l, s in counts if l == lang}
        q = share(totals[lang])
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in p:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in p if o != s]
            terms = [(-f(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item, -value, i) for i, (value, item) in enumerate(found, 1)}
    return out


def invented(seed, n, words=60, sources=12):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdeéßЖ", k=rng.randint(1, 6))) for _ in range(words)]
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "de", None]), f"s{min(rng.randrange(sources), rng.randrange(sources))}"
        lo = int(source[1:]) * 3
        text = " ".join(rng.choice([str.upper, str])(w) for w in rng.choices(vocab[lo : lo + 40], k=rng.randint(0, 30)))
        rows.append((i, text, lang, source))
    return rows


@pytest.mark.parametrize("rows_, columns", [(256, 1024), (3, 7), (2, 16)])
def test_divergence_equals_brute_force(spark, monkeypatch, rows_, columns):
    """Also with many small tiles."""
    for name, value in (("ROWS", rows_), ("COLUMNS", columns)):
        monkeypatch.setattr(divergence, name, value)
    rows = invented(1, 300)
    rows += [(900, None, "en", "s1"), (901, "", None, None), (902, "1 2 3", "xx", "a"), (903, "lonely words", "xx", "b"), (1, "Twice twice", "en", "s1"), (1, "Twice twice", "en", "s1"), (None, "naïve ideas " * 20000, "de", "long")]
    got = [tuple(r) for r in divergence.audit(table(spark, rows)).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_divergence(rows)


def test_divergence_of_no_rows(spark):
    assert divergence.audit(table(spark, [])).collect() == []


@pytest.mark.parametrize("k, leaf", [(2, 1), (2, 4), (4, 2)])
def test_joint_walk_prices_empty_quadrants(monkeypatch, k, leaf):
    monkeypatch.setattr(divergence, "K", k)
    monkeypatch.setattr(divergence, "LEAF", leaf)
    rng = np.random.default_rng(5)
    columns = 37
    for rows_a, rows_b, share in ((5, 9, 0.02), (3, 3, 0.5), (1, 11, 0.0)):
        sides = []
        height = divergence.height_of(rows_a, rows_b, columns)
        for rows in (rows_a, rows_b):
            m = np.where(rng.random((rows, columns)) < share, rng.integers(1, 50, (rows, columns)), 0)
            m[:, 20:33] = 0
            sides.append((m, divergence.Tree(*np.nonzero(m), m[np.nonzero(m)], rows, columns, height), m.sum(1) + 2 * columns))
        (ma, a, da), (mb, b, db) = sides
        p, q = (1 + 10**9 * (m + 2) // d[:, None] for m, d in ((ma, da), (mb, db)))
        wanted = ((p[:, None] - q[None]) ** 2 // (p[:, None] + q[None])).sum(-1)
        assert (divergence.pair_values(a, b, da, db) == wanted).all()
        front, empty = divergence.walk(a, b)
        assert len(front[0]) < -(-rows_a // leaf) * -(-rows_b // leaf) * -(-columns // leaf) and empty.max() >= 13 // leaf


def test_shares_are_exact():
    counts, denominators = [0, 7, 10**13, 3 * 10**14], [3, 10**15 + 7, 3 * 10**13 + 11, 8 * 10**15 + 1]
    got = divergence.shares(np.array(counts), np.array(denominators))
    assert got.tolist() == [1 + 10**9 * (c + 2) // d for c, d in zip(counts, denominators)]


# Best-fit packing.


def brute_best_fit(lengths, window):
    """Room left in each sequence, document by document."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(window - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    window = [16, 64, 100][seed % 3]
    lengths = rng.integers(1, window, 800) if seed < 3 else np.minimum(rng.geometric(0.08, 900), window - 1)
    histogram = np.bincount(lengths, minlength=window)
    plan = bestfit.solve(histogram, window)
    taken = defaultdict(list)
    for length in np.unique(lengths):
        ranks = np.arange(histogram[length])
        for s, o in zip(*(x.tolist() for x in plan.place(np.full(len(ranks), length), ranks))):
            taken[s].append((o, int(length)))
    assert sorted(taken) == list(range(plan.sequences))
    for pieces in taken.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(window - sum(n for _, n in x) for x in taken.values()) == brute_best_fit(lengths.tolist(), window)


def test_tightest_capacity():
    rng = random.Random(2)
    for window in (1, 7, 8, 31):
        tree, have = bestfit.Capacities(window), Counter()
        for _ in range(300):
            c = rng.randint(0, window)
            step = -1 if have[c] and rng.random() < 0.6 else 1
            have[c] += step
            tree.add(c, step)
            n = rng.randint(0, window)
            assert tree.tightest(n) == min((x for x in have if have[x] and x >= n), default=None)


def test_best_fit_pieces(spark):
    rows = [(1, "The cat sat on the mat", "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, "lorem ipsum dolor " * 5000, "en", "b"), (5, "same row", "en", "b"), (5, "same row", "en", "b"), (None, "no id", "de", "c")]
    rows += [(10 + i, "word " * (i % 97), "en", "d") for i in range(400)]
    library = Tokenizer.from_file(BYTES[0])
    ids = {i: library.encode(r[1] or "", add_special_tokens=False).ids + [0] for i, r in enumerate(rows)}
    wanted = Counter()
    window = 64
    for i, r in enumerate(rows):
        short = len(ids[i]) % window
        cuts = [*([0] if short else []), *range(short, len(ids[i]) + 1, window)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            wanted[r[0], piece, a, b - a, zlib.crc32(np.array(ids[i][a:b], "<u4").tobytes())] += 1
    got = bestfit.pack(table(spark, rows).repartition(5), BYTES, window).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == wanted
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= window
    lengths = [r.length for r in got]
    whole = lengths.count(window)
    assert len(by) == whole + len(brute_best_fit([n for n in lengths if n < window], window))
    assert bestfit.pack(table(spark, []), BYTES).collect() == []


# Spelling variants.


def brute_words(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    words = brute_words(rows)
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def misspelt(seed, n):
    rng = random.Random(seed)
    letters = "aabcdeéÿ×÷Àß"
    base = ["".join(rng.choices(letters, k=rng.randint(4, 9))) for _ in range(40)] + ["aaaaaa", "aaaaa", "aaaab"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 40)):
            w = base[min(rng.randrange(len(base)), rng.randrange(len(base)))]
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]])
            words.append(rng.choice([w, w, w.capitalize() if w[0].isascii() else w]))
        rows.append((i, rng.choice([" ", ", ", "Ж", "9", "\xa0"]).join(words), "en", "a"))
    return rows


@pytest.mark.parametrize("pass_bytes", [64 << 20, 64])
def test_variants_equal_brute_force(spark, pass_bytes):
    """Also with one block to a broadcast."""
    rows = misspelt(3, 500) + [(None, "nulls nulls nulls", "en", "a"), (7, None, None, None), (8, "", "en", "a")]
    rows += [(9, "again again again", "en", "a")] * 2 + [(5000, "x" * 3000 + " " + "x" * 2999 + " averylongtext" * 20000, "en", "a")] * 3
    got = [tuple(r) for r in variants.group(table(spark, rows), pass_bytes).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_variants(rows)


def test_variants_of_no_rows(spark):
    assert variants.group(table(spark, [])).collect() == []


def test_filters_hold_every_word():
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("abcdefgh", k=rng.randint(5, 8))) for _ in range(3000)})
    shape = variants.shape_of(Counter(map(len, words)), 1 << 10)
    groups = variants.passes_of(shape, 1 << 10)
    assert len(groups) > 3 and all(sum(g.values()) * 64 <= 1 << 10 for g in groups)
    lanes = {}
    for n, (_, codes) in variants._by_length(words).items():
        h = variants.weighted(codes)[0].sum(1, dtype=np.uint64)
        for s, b, x in zip(*shape.place(n, h), h):
            lanes.setdefault((int(s), int(b)), []).append(x)
    held = 0
    for group in groups:
        keys = [k for k in lanes if k[0] in group]
        columns = {"shard": [k[0] for k in keys], "block": [k[1] for k in keys]}
        for i in range(variants.LANES):
            bits = [np.bitwise_or.reduce(variants.bit(np.array(lanes[k], np.uint64), i)) for k in keys]
            columns[f"lane{i}"] = np.array(bits, np.uint64).view(np.int64)
        import pyarrow as pa

        filters = variants.Filters(shape, group, pa.table(columns))
        for n, (_, codes) in variants._by_length(words).items():
            held += len(filters.holds(n, variants.weighted(codes)[0].sum(1, dtype=np.uint64)))
    assert held == len(words)
