"""Text operators against brute force and the libraries, and their edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import batches, bytebpe, fingerprints, langid, neardup, packing, pieces, quality, secrets, toxicity
from tillroll.llm.components import components
from tillroll.session import ship

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
# Null and empty texts, repeated rows, a null id, a very long text; clashing column names beside them.
LONG = "lorem ipsum dolor sit amet " * 8000
ROWS = [
    (1, "The cat sat on the mat and it purred all day long", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, LONG, "en", "b"),
    (5, "The cat sat on the mat and it purred all day long", "en", "b"),
    (5, "The cat sat on the mat and it purred all day long", "en", "b"),
    (None, "ein Text ohne Nummer, password = hunter2secret", "de", "c"),
    (7, " \t\n ", "de", "c"),
    (8, "word", "de", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    rows = [(*r, i, "x", float(i)) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, fp int, rank string, n double")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, None, 1), (5, 1, 1), (5, 1, 1)], "doc_id long, quality int, toxic int")


def noise(n, seed=3):
    rng = random.Random(seed)
    parts = ["a", "aa", "the", "ing", " ", "  ", "\n", "\t", "▁", "é", "ß", "梦", "😀", "12", "'s", "<s>", "...", "\xa0", "\x00", "AB"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_pieces_equal_the_library():
    model, library = pieces.load(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = noise(3000) + ["a" * 3000, "ab" * 2000, " " * 500, "".join(random.Random(1).choices("etaoinsr", k=5000))]
    got, want = model.encode_batch(texts), library.encode(texts)
    assert [g.tolist() for g in got] == want
    assert [model.decode(g) for g in got] == library.decode(want)
    assert [model.numbers(g).decode() for g in got if len(g)] == [",".join(map(str, w)) for w in want if w]
    rng = random.Random(2)
    for _ in range(1000):  # any ids, broken bytes among them
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(3, 32000)]) for _ in range(rng.randint(1, 9))]
        assert model.decode(np.array(ids)) == library.decode(ids)


def test_pieces_rows(docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sorted((r.ids_sha256, r.decoded_sha256, r.n_tokens) for r in pieces.digests(docs, PIECES).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = [library.encode(t or "") for _, t, *_ in ROWS]
    assert got == sorted((sha(",".join(map(str, i))), sha(library.decode(i)), len(i)) for i in ids)
    assert pieces.tokenize(docs.limit(0), PIECES).count() == 0


def test_byte_ids_equal_the_library():
    model, library = bytebpe.load(*BYTES), Tokenizer.from_file(BYTES[0])
    texts = noise(3000, 4) + ["x <|endoftext|> y", LONG[:9000]]
    assert [g.tolist() for g in model.encode_batch(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing(docs, spark):
    library = Tokenizer.from_file(BYTES[0])
    for frame in (docs, docs.limit(0)):
        rows, window = packing.pack(frame, BYTES, 64).collect(), 64
        want = {}
        for r in frame.select("doc_id", "text").collect():
            want.setdefault(r.doc_id, []).append(library.encode(r.text or "", add_special_tokens=False).ids + [0])
        total = sum(len(i) for v in want.values() for i in v)
        assert sum(r.length for r in rows) == total
        for r in rows:
            part = np.array(want[r.doc_id][0][r.start : r.start + r.length], "<u4")
            assert zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(want[r.doc_id][0])
        by = {}
        for r in rows:
            by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        padding = 0
        for spans in by.values():
            at = 0
            for offset, length in sorted(spans):
                assert offset == at
                at += length
            assert at <= window
            padding += window - at
        assert padding < window


def test_least_squares_plan():
    rng = np.random.default_rng(0)
    for histogram in (rng.integers(0, 50, 256), np.eye(256, dtype=int)[100] * 999, np.zeros(256, int)):
        histogram[0] = 0
        plan = packing.solve(histogram, 256)
        length = np.repeat(np.arange(256), histogram)
        rank = np.concatenate([np.arange(h) for h in histogram]) if len(length) else length
        sequence, offset = plan.place(length, rank)
        taken = set()
        for s, o, n in zip(sequence.tolist(), offset.tolist(), length.tolist()):
            cells = {(s + (o + i) // 256, (o + i) % 256) for i in range(n)}
            assert not cells & taken
            taken |= cells
        used = len({s for s, _ in taken})
        assert used == -(-int(length.sum()) // 256)


def brute_spans(text):
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(pattern, text, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def test_secret_spans(docs):
    rng = random.Random(5)
    bits = ["token", "=", ":", " ", "secret", "ab", "é", "AKIA", "ABCDEF0123456789", "deadbeef01234567", "api_KEY", '"', "xyz789", "ſecret"]
    model = secrets.train([], ["ordinary_name", "another_identifier", "some_longer_words"] * 20)
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 20)))
        assert secrets.base_spans(text) == brute_spans(text)
        spans = model.spans(text)
        assert set(brute_spans(text)) <= set(spans) and spans == sorted(spans)
    found = secrets.scan(docs, secrets.fit(docs))
    rows = secrets.digest(found).where("doc_id is null").collect()
    assert rows[0].n_assign == 1 and found.count() == len(ROWS)
    empty = secrets.digest(found).where("doc_id = 3").first()
    assert (empty.base_sha256, empty.spans) == (hashlib.sha256(b"").hexdigest(), "")
    clean = secrets.redact(docs, model)
    assert clean.columns == docs.columns and clean.where("doc_id is null").first().text == "ein Text ohne Nummer, [secret]"
    assert secrets.scan(docs.limit(0), secrets.fit(docs.limit(0))).count() == 0


def test_markov_models_tell_random_from_names():
    rng = np.random.default_rng(1)
    names = ["".join(rng.choice(list("etaoinshrdlu_"), 20)) for _ in range(400)]
    model = secrets.train([], names)
    keys = ["".join(rng.choice(list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz23456789"), 32)) for _ in range(100)]
    assert np.mean([model.value(k) > model.threshold for k in keys]) > 0.95
    assert np.mean([model.value(n) > model.threshold for n in names]) < 0.02


KEY = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")


@pytest.mark.parametrize("every", [100, 20])  # keys in 1% and 5% of the documents
def test_keys_in_the_fitted_documents_do_not_hide_others(spark, every):
    rng = np.random.default_rng(every)
    key = lambda n=40: "".join(rng.choice(KEY, n))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    planted = {r.doc_id: key() for r in docs[::every]}
    rows = [(r.doc_id, f"{r.text} {planted[r.doc_id]}" if r.doc_id in planted else r.text) for r in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = secrets.fit(frame)
    found = {r.doc_id for r in secrets.scan(frame, model).where("exists(spans, s -> s.kind = 'random')").collect()}
    assert len(found & set(planted)) >= 0.99 * len(planted) and len(found - set(planted)) <= 0.01 * len(rows)
    assert np.mean([bool(model.spans(f"see {key()} here")) for _ in range(300)]) > 0.99


def test_keys_joined_to_words_are_found_alone(spark):
    rng = np.random.default_rng(8)
    model = secrets.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    draw = lambda n, some=KEY: "".join(rng.choice(some, n))
    cases = {
        "named": lambda: ("some_ordinary_words_and_the_name_of_a_thing=", draw(40), ""),
        "path": lambda: ("files/of/ordinary/people/and/things/under/", draw(20), ""),
        "inside": lambda: ("files/of/ordinary/", draw(24), "/and/other/things/with/names"),
        "padded": lambda: ("the_ordinary_value=", draw(30) + "==", ""),
        "beside hex": lambda: ("the " + draw(32, list("0123456789abcdef")), "Z" + draw(31, KEY[:26]), ""),
    }
    for name, case in cases.items():
        hits = []
        for _ in range(100):
            before, key, after = case()
            hits.append((len(before), 3, len(before) + len(key)) in model.spans(before + key + after))
        assert np.mean(hits) >= 0.95, (name, np.mean(hits))
    for ordinary in ("files/of/ordinary/people/and/other/things", "the_ordinary_value=some_other_ordinary_words"):
        assert not model.spans(ordinary)


def test_heaviest_segments_weigh_most():
    rng = np.random.default_rng(2)
    for _ in range(200):
        weights = rng.normal(size=12)
        over = np.concatenate([[0], np.cumsum(weights)])
        found = secrets._heaviest([(i, i + 1) for i in range(12)], over)
        sums = [over[j] - over[i] for i in range(12) for j in range(i + 1, 13)]
        assert max((over[b] - over[a] for a, b in found), default=0) == pytest.approx(max(0, *sums))
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))


def test_fingerprint_bits():
    for text in [t or "" for _, t, *_ in ROWS[:4]] + noise(200, 6):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert neardup.fingerprint(text) == want


def close_sets(fps, radius):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(int(fps[i]) ^ int(fps[j])).count("1") <= radius:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def planted(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 12).astype(np.uint64)
    out = {0}
    while len(out) < n:
        fp = int(rng.choice(base))
        for b in rng.choice(64, int(rng.integers(0, 7)), replace=False):
            fp ^= 1 << int(b)
        out.add(fp)
    return np.array(sorted(out), np.uint64)


def test_bit_sliced_comparison():
    fps = planted(500, 1)
    for radius in (1, 2, 3, 4):
        q, lane = neardup.near(neardup.bit_planes(fps), fps, len(fps), radius)
        want = {(i, j) for i in range(len(fps)) for j in range(len(fps)) if bin(int(fps[i]) ^ int(fps[j])).count("1") <= radius}
        assert set(zip(q.tolist(), lane.tolist())) == want
    label = neardup.forest(fps)
    assert label.tolist() == close_sets(fps, 3)


@pytest.mark.parametrize("bucket", [8192, 40])
def test_links_connect_what_is_close(spark, monkeypatch, bucket):
    monkeypatch.setattr(neardup, "BUCKET", bucket)  # 40: buckets are split into blocks
    fps = planted(400, 2)
    nodes = spark.createDataFrame([(int(v), i) for i, v in enumerate(fps.view(np.int64))], "fp long, node long")
    found = {r.node: r.component for r in components(neardup.links(nodes)).collect()}
    assert [found.get(i, i) for i in range(len(fps))] == close_sets(fps, 3)


def test_neardup_rows(docs, spark):
    rows = neardup.groups(docs).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert by[1].component_id == by[5].component_id == 1
    assert by[2].fingerprint == by[3].fingerprint == by[7].fingerprint == "0" * 16 and by[7].component_id == 2
    kept = neardup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "4", "8", "None"]
    assert neardup.groups(docs.limit(0)).count() == 0
    # A row without id and text takes no document's place.
    bare = spark.createDataFrame([(42, "some words stand here alone"), (None, None), (None, ""), (43, "entirely other words of another text")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in neardup.deduplicate(bare).collect()) == ["42", "43", "None"]


def near_texts():
    """Two texts that differ in their last word and by one to three bits."""
    body = " ".join(f"word{i}" for i in range(60))
    first = f"{body} end"
    for i in range(1000):
        other = f"{body} end{i}"
        if 0 < (int(neardup.fingerprint(first)) ^ int(neardup.fingerprint(other))).bit_count() <= 3:
            return first, other


NEAR = near_texts()


def test_neardup_null_ids_name_nothing(spark):
    """Near texts of which one has no id; a group without any id."""
    rows = [(1, NEAR[0]), (None, NEAR[1]), (None, "alone among others here"), (None, "alone among others here")]
    found = neardup.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in found if r.component_id) == [("1", 1), ("None", 1)]
    assert [r.doc_id for r in found if r.component_id is None] == [None, None]


def test_deduplicate_does_not_join_by_id(spark):
    """Unlike texts of one id all stay; of near texts one does, whatever their ids."""
    rows = [(9, "all these words are of the first text"), (9, "others make up what the second one says"), (9, NEAR[0]), (3, NEAR[1]), (None, NEAR[0]), (9, NEAR[0])]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, name_0 int")
    kept = sorted((r.doc_id, r.text) for r in neardup.deduplicate(docs).collect())
    assert kept == sorted([(3, NEAR[1]), (9, rows[0][1]), (9, rows[1][1])])


def test_sample_takes_rows_not_ids(spark):
    """One id on thousands of rows, one text on thousands, a label of few rows."""
    rows = [(7, f"text {i}", "en") for i in range(5000)] + [(i, f"der Text {i}", "de") for i in range(700)] + [(1, "same", "fr")] * 4000 + [(None, f"x {i}", None) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    taken = batches.sampled(docs.where("lang is not null"), "lang", 300).collect()
    count = {lang: [r.n for r in taken if r.lang == lang] for lang in ("en", "de", "fr")}
    assert sorted(count["en"]) == sorted(count["de"]) == list(range(1, 301)) and count["fr"] == [1]
    assert set(taken[0].asDict()) == {"doc_id", "text", "lang", "n"}
    labels = spark.createDataFrame([(7, 1), (8, 0), (None, 1)], "doc_id long, toxic int")
    some = toxicity.labelled_sample(docs, labels, "toxic", 100).collect()
    assert [r.y for r in some if r.doc_id == 7] == [1] * (100 if zlib.crc32(b"7") % 4 != 2 else 0)


def brute_random(model, text):
    """Spans of the whole text by looking at every base span for every run."""
    base = secrets.base_spans(text)
    found = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", text, re.ASCII):
        free = [not any(s <= i < e for s, _, e in base) for i in range(m.start(), m.end())]
        at = 0
        while at < len(free):
            end = at
            while end < len(free) and free[end]:
                end += 1
            if end > at:
                run = text[m.start() + at : m.start() + end]
                found += [(m.start() + at + a, 3, m.start() + at + b) for a, b in model.random_parts(run)]
            at = end + 1
    return sorted(base + found)


def test_one_sweep_equals_all_spans():
    rng = random.Random(6)
    model = secrets.train([], ["ordinary_names", "and_other_words", "some_more_words_here"])
    key = lambda n: "".join(rng.choices("ABCDEFabcdef0123456789xyzXYZ", k=n))
    makers = [lambda: f"password={key(12)}", lambda: f"é{key(40)}", lambda: key(30).lower(), lambda: f"token: '{key(9)}/{key(30)}'", lambda: "AKIA" + key(20).upper(), lambda: f"a/{key(20)}=secret={key(8)}", lambda: "ordinary words", lambda: "0123456789abcdef" * 3]
    for _ in range(200):
        text = "".join(rng.choice(makers)() + rng.choice([" ", "", "\n", "="]) for _ in range(rng.randint(0, 12)))
        assert model.spans(text) == brute_random(model, text)


def test_long_texts_take_linear_time():
    import time

    model = secrets.train([], ["ordinary_names"])
    text = " ".join(f"password=abcdef{i} é some_identifier_number_{i}" for i in range(100_000))
    began = time.time()
    assert len([s for s in model.spans(text) if s[1] == 0]) == 100_000
    assert time.time() - began < 30


def test_word_store_is_bounded():
    """Long words are not remembered; short ones only up to the number of ids."""
    from tillroll.llm import words

    store = words.WordStore(lambda codes, sizes: (codes.copy(), sizes.copy()), np.uint32)
    rng = random.Random(1)
    texts = [["".join(rng.choices("abc", k=rng.choice([3, 60, 65, 4000]))) for _ in range(30)] for _ in range(20)]
    for some in texts:
        codes = words.code_points("".join(some))
        starts = np.cumsum([0] + [len(w) for w in some[:-1]])
        ids, counts = store.look_up(codes, starts)
        assert (ids == codes).all() and counts.tolist() == [len(w) for w in some]
    assert len(store.ids) <= 20 * 30 * 60


def test_a_cut_of_a_long_text_changes_no_subword(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choices("abcdeé  ,", k=5000)) + "x" * 700 + " end of it"
    whole = langid.count_subwords(text)
    monkeypatch.setattr(langid, "SLICE", 100)
    cut = langid.count_subwords(text)
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist()


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (None, 4), (70, 80), (70, 80)], "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {i: 0 for i in range(61)} | {70: 70, 80: 70}


def test_edited_fingerprints(docs, spark):
    rows = [(i, t) for i, t in enumerate(noise(300, 8) + ["same text here"] * 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints.compared(frame).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        third = len(text) // 3
        new = text[: len(text) - third] + following[:third]
        row = got[i]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        a, b, c = (fingerprints.votes(t) for t in (text, new, following))
        assert (row.fingerprint, row.edited_fingerprint) == (a.tobytes().hex(), b.tobytes().hex())
        assert (row.near_edited, row.near_next) == (fingerprints.likeness(a, b), fingerprints.likeness(a, c))
    assert fingerprints.compared(docs).count() == len(ROWS)
    assert fingerprints.compared(docs.limit(0)).count() == 0
    one = fingerprints.compared(docs.where("doc_id = 1")).first()
    assert one.near_next == 1.0


def test_block_tables_find_all_within(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 256, 16)
    prints = []
    for _ in range(150):
        bits = np.unpackbits(base.astype(np.uint8))
        bits[rng.choice(128, int(rng.integers(0, 8)), replace=False)] ^= 1
        prints.append(np.packbits(bits).tobytes().hex())
    found = spark.createDataFrame([(p,) for p in prints] + [(None,)], "fingerprint string")
    queries = found.limit(40)
    asked = {r.fingerprint for r in queries.collect() if r.fingerprint}
    got = {(r.query, r.fingerprint, r.distance) for r in fingerprints.within(queries, found, 4).collect()}
    distance = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    assert got == {(a, b, distance(a, b)) for a in asked for b in set(prints) if distance(a, b) <= 4}


def test_neighbors_are_counted(spark):
    rng = np.random.default_rng(9)
    base = np.unpackbits(rng.integers(0, 256, 16).astype(np.uint8))
    rows = []
    for i in range(120):
        bits = base.copy()
        bits[rng.choice(128, int(rng.integers(0, 5)), replace=False)] ^= 1
        rows.append((i if i % 7 else None, np.packbits(bits).tobytes().hex()))
    frame = spark.createDataFrame(rows + rows[:3], "doc_id long, fingerprint string")
    got = fingerprints.with_neighbors(frame, F.col("doc_id") % 10 == 1).collect()
    prints = [int(r[1], 16) for r in rows + rows[:3]]
    assert len(got) == len(prints)
    for r in got:
        wanted = sum((p ^ int(r.fingerprint, 16)).bit_count() <= fingerprints.RADIUS for p in prints)
        assert r.n_within == (wanted if r.doc_id is not None and r.doc_id % 10 == 1 else None)


def test_languages(docs, spark):
    rng = random.Random(0)
    made = {"xx": "abc abd bca cab", "yy": "ñoñ ñin oño", "zz": "шум дом мир"}
    rows = [(i, " ".join(rng.choices(made[k].split(), k=20)), k) for i, k in enumerate(list(made) * 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(frame)
    got = {r.doc_id: r for r in langid.identify(frame, model).collect()}
    assert all(got[i].lang_pred == k and not got[i].rejected for i, _, k in rows)
    names, score, rejected = model.predict(["", "123 !?", "шум мир дом"])
    assert names == ["und", "und", "zz"] and score[:2].tolist() == [0, 0] and rejected.tolist() == [True, True, False]
    assert langid.identify(docs, model).count() == len(ROWS)
    none = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.keep(docs, model).columns == docs.columns
    long = "шум " * (langid.SLICE // 2)
    assert model.predict([long])[0] == ["zz"]


def test_grammar_events():
    grammar = toxicity.Grammar({"idiot$": 4.0, "scumm": 2.0})
    kinds = lambda t: [[k for k, _ in c] for c in grammar.clauses(t)]
    assert kinds("An idiot. Nothing here") == [[toxicity.PLAIN]]
    assert kinds("you are an idiot") == [[toxicity.TARGETED]]
    assert kinds("he was not an idiot") == [[toxicity.NEGATED]]
    assert kinds("someone said idiot") == [[toxicity.REPORTED]]
    assert kinds('the word "idiot" is old') == [[toxicity.REPORTED]]
    assert kinds("i will kill you") == [[toxicity.THREATENED]]
    assert kinds("not here. scummy idiot") == [[toxicity.PLAIN, toxicity.PLAIN]]
    assert kinds("") == [] and grammar.features("") == [0.0] * toxicity.FEATURES


def test_toxicity_is_learnt(docs, labels, spark):
    rng = random.Random(1)
    plain = [" ".join(rng.choices("alpha beta gamma delta house river stone".split(), k=12)) for _ in range(400)]
    texts = [(i, t + (". what a vilewordly thing and vileworden" if i % 5 == 0 else "")) for i, t in enumerate(plain)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i, _ in texts], "doc_id long, quality int, toxic int")
    grammar = toxicity.fit(frame, marks)
    got = {r.doc_id: r.predicted for r in toxicity.score(frame, grammar).collect()}
    assert got == {i: int(i % 5 == 0) for i, _ in texts}
    assert toxicity.keep(frame, grammar).count() == 320
    few = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, few).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    none = toxicity.fit(docs.limit(0), labels.limit(0))
    assert {round(r.score, 3) for r in toxicity.score(docs, none).collect()} == {0.0}


def test_quality(docs, labels, spark):
    rng = random.Random(2)
    good = "the river runs past an old stone house and nobody minds it at all".split()
    rows = []
    for i in range(400):
        junk = i % 4 == 0
        text = " ".join([rng.choice(good)] * 30 if junk else rng.choices(good, k=30))
        rows.append((i, text, f"h{i % 3}", f"p{i % 5}", int(not junk)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, host string, path string, quality int")
    marks = frame.select("doc_id", "quality")
    model = quality.fit(frame, marks)
    got = {r.doc_id: r for r in quality.classify(frame.drop("quality"), marks, model).collect()}
    assert len(got) == 400 and all(got[r[0]].keep == bool(r[4]) for r in rows)
    assert all(0 <= r.site <= 1 for r in got.values())
    sites = docs.select("doc_id", "text", docs.source.alias("host"), docs.lang.alias("path"))
    assert quality.classify(sites, labels, quality.fit(sites, labels)).count() == len(ROWS)
    none = quality.fit(sites.limit(0), labels.limit(0))
    assert {r.own for r in quality.classify(sites, labels.limit(0), none).collect()} == {0.5}
    assert quality.classify(sites.limit(0), labels, none).count() == 0
