"""How far the sources of a language differ in the words they use, over a K-squared quadtree of counts.

The matrix of a language has its sources as rows and its kept terms as columns. It is cut into tiles of bounded rows
and columns; the nonzero cells of a tile make a K-squared tree: a quadrant without a count is one bit, and only
nonzero leaves hold numbers. Two trees are walked jointly for all pairs of their rows. Where both quadrants are empty,
their cells all have the same price, which is multiplied and not visited; leaves with a count are computed cell by
cell. The language's totals are a tree of one row, walked against the sources to find what marks each.

Numbers are exact integers: a share is a long division in steps of 1,000, right below 9e15 occurrences a language.

Null text, language or source counts as ''. Every row is a document, repeated ids included; other columns are ignored.
A source without terms, or a language that keeps none, still has its pairs. An empty table has no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.batches import Batches, batch_of, map_batches
from tillroll.session import lookup_join, stage

K = 4  # a node has K * K quadrants
LEAF = 8  # rows and columns of a leaf
ROWS = 256  # sources of a tile's side, about
COLUMNS = 1024  # terms of a tile, about
MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
# Distinct terms a task counts before it hands them on.
HELD = 400_000
# Leaf pairs computed at once.
_CHUNK = 2048

# Lower-cases A-Z, keeps other letters and all bytes above ASCII, blanks the rest.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_TERM_BYTES).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs), summed up; term '' stands for the group itself, with zeros."""

    def flush(counts: dict, held: dict) -> Batches:
        for (lang, source), found in counts.items():
            items = [(t, n, held[lang, source][t]) for t, n in found.items()] + [(b"", 0, 0)]
            for at in range(0, len(items), 65536):
                terms, n, docs_ = zip(*items[at : at + 65536])
                yield batch_of(
                    lang=pa.array([lang] * len(terms), pa.string()),
                    source=pa.array([source] * len(terms), pa.string()),
                    term=pa.array(terms, pa.binary()).cast(pa.string()),
                    n=pa.array(n, pa.int64()),
                    docs=pa.array(docs_, pa.int64()),
                )
        counts.clear()
        held.clear()

    def run(batches: Batches) -> Batches:
        counts: dict[tuple, Counter] = {}
        held: dict[tuple, Counter] = {}
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lang", "source", "text"))
            for lang, source, text in zip(*columns):
                words, key = terms_of(text), (lang, source)
                if key not in counts:
                    counts[key], held[key] = Counter(), Counter()
                counts[key].update(words)
                held[key].update(set(words))
            if sum(map(len, counts.values())) > HELD:
                yield from flush(counts, held)
        yield from flush(counts, held)

    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    partial = map_batches(docs.select(*plain, text), run, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, denominators: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / denominator), exactly."""
    rest, out = counts + 2, 0
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // denominators
        rest = rest % denominators
    return out + 1


def prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Tree:
    """K-squared tree of the nonzero cells of a matrix of ``rows`` x ``columns``.

    ``bits[l]`` has K * K places per node of level l; a set bit's rank is the child's number on the next level.
    ``leaves`` are dense; one empty leaf follows them, so that node -1 is an empty one.
    """

    def __init__(self, row: np.ndarray, column: np.ndarray, count: np.ndarray, rows: int, columns: int, height: int) -> None:
        self.rows, self.columns, self.height = rows, columns, height
        code = np.zeros(len(row), np.int64)
        for level in range(height):
            side = LEAF * K ** (height - 1 - level)
            code = code * K * K + row // side % K * K + column // side % K
        nodes, at = np.unique(code, return_inverse=True)
        self.leaves = np.zeros((len(nodes) + 1, LEAF, LEAF), np.int64)
        self.leaves[at, row % LEAF, column % LEAF] = count
        self.bits: list[np.ndarray] = []
        for _ in range(height):
            above = np.unique(nodes // (K * K))
            bits = np.zeros(max(len(above), 1) * K * K, bool)
            bits[np.searchsorted(above, nodes // (K * K)) * K * K + nodes % (K * K)] = True
            self.bits.append(bits)
            nodes = above
        self.bits.reverse()
        self.rank = [np.cumsum(b) - 1 for b in self.bits]
        self.root = 0 if len(row) else -1

    def child(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        at = np.maximum(node, 0) * K * K + quadrant
        return np.where((node >= 0) & self.bits[level][at], self.rank[level][at], -1)


def height_of(*sizes: int) -> int:
    """Levels above the leaves that cover all sizes."""
    height = 0
    while LEAF * K**height < max(sizes):
        height += 1
    return height


def walk(a: Tree, b: Tree) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Leaf pairs (leaf of a, leaf of b, row block of a, of b, column block) with a count, and for each pair of rows
    the number of columns in quadrants that are empty on both sides."""
    empty = np.zeros((a.rows, b.rows), np.int64)
    one = lambda v: np.array([v], np.int64)
    front = (one(a.root), one(b.root), one(0), one(0), one(0))
    i, k, j = (x.ravel() for x in np.meshgrid(*[np.arange(K)] * 3, indexing="ij"))
    for level in range(a.height + 1):
        side = LEAF * K ** (a.height - level)
        if level:
            na, nb, ra, rb, c = (np.repeat(x, K**3) for x in front)
            di, dk, dj = (np.tile(x, len(front[0])) for x in (i, k, j))
            front = (a.child(level - 1, na, di * K + dj), b.child(level - 1, nb, dk * K + dj), ra * K + di, rb * K + dk, c * K + dj)
        na, nb, ra, rb, c = front
        inside = (ra * side < a.rows) & (rb * side < b.rows) & (c * side < a.columns)
        void = inside & (na < 0) & (nb < 0)
        tally = np.zeros((-(-a.rows // side), -(-b.rows // side)), np.int64)
        np.add.at(tally, (ra[void], rb[void]), np.minimum(side, a.columns - c[void] * side))
        empty += np.repeat(np.repeat(tally, side, 0)[: a.rows], side, 1)[:, : b.rows]
        front = tuple(x[inside & ~void] for x in front)
    return front, empty


def _padded(values: np.ndarray) -> np.ndarray:
    return np.concatenate([values, np.ones(-len(values) % LEAF, np.int64)])


def leaf_shares(a: Tree, b: Tree, da: np.ndarray, db: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Chunks of leaf pairs: row block of a, of b, column block, counts of a, shares of a and of b (pair, row, column)."""
    front, _ = walk(a, b)
    da, db = (_padded(d).reshape(-1, LEAF) for d in (da, db))
    for at in range(0, len(front[0]), _CHUNK):
        na, nb, ra, rb, c = (x[at : at + _CHUNK] for x in front)
        yield ra, rb, c, a.leaves[na], shares(a.leaves[na], da[ra][:, :, None]), shares(b.leaves[nb], db[rb][:, :, None])


def pair_values(a: Tree, b: Tree, da: np.ndarray, db: np.ndarray) -> np.ndarray:
    """Sum of the prices over all columns, for each row of ``a`` and of ``b``; ``da``, ``db``: denominators by row."""
    _, empty = walk(a, b)
    zeros = [shares(np.zeros_like(d), d) for d in (da, db)]
    full = np.zeros([-(-n // LEAF) * LEAF for n in (a.rows, b.rows)], np.int64)
    blocks = full.reshape(full.shape[0] // LEAF, LEAF, full.shape[1] // LEAF, LEAF).transpose(0, 2, 1, 3)
    for ra, rb, c, _, p, q in leaf_shares(a, b, da, db):
        real = c[:, None] * LEAF + np.arange(LEAF) < a.columns
        cells = prices(p[:, :, None, :], q[:, None, :, :]) * real[:, None, None, :]
        np.add.at(blocks, (ra, rb), cells.sum(-1))
    return full[: a.rows, : b.rows] + empty * prices(zeros[0][:, None], zeros[1][None, :])


def marking_terms(a: Tree, total: Tree, da: np.ndarray, dt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, price) of the cells of ``a`` with a count whose share is above the language's."""
    parts = []
    for ra, _, c, counts, p, q in leaf_shares(a, total, da, np.array([dt], np.int64)):
        q = q[:, :1, :]
        at, row, column = np.nonzero((counts > 0) & (p > q))
        parts.append((ra[at] * LEAF + row, c[at] * LEAF + column, prices(p, q)[at, row, column]))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _tile(key: tuple, table: pa.Table) -> pa.Table:
    """All pairs of a tile's sources over its terms; on the diagonal also the terms that mark them."""
    names = ("source", "term", "block", "n", "total", "group_n", "kept", "lang_n", "width")
    get = {c: table.column(c).combine_chunks() for c in names}
    lang, _, first, second = (k.as_py() for k in key)
    is_group = np.array(get["term"].is_null())
    number = lambda c, at: get[c].to_numpy(zero_copy_only=False)[at].astype(np.int64)
    kept, lang_n, width = (int(number(c, is_group)[0]) for c in ("kept", "lang_n", "width"))
    cells = np.flatnonzero(~is_group)
    coded = get["term"].take(pa.array(cells)).dictionary_encode()
    column, terms = coded.indices.to_numpy(zero_copy_only=False), np.array(coded.dictionary.to_pylist(), object)
    # Terms of many sources first, those that none of these sources has last: empty quadrants gather.
    order = np.argsort(-np.bincount(column, minlength=len(terms)), kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    terms, column = terms[order], place[column]

    block = number("block", slice(None))
    n_of = number("n", slice(None))
    sides, trees = [], []
    for b in dict.fromkeys((first, second)):
        groups = np.flatnonzero(is_group & (block == b))
        groups = groups[np.argsort(-number("group_n", groups), kind="stable")]
        sides.append((b, get["source"].take(pa.array(groups)), number("group_n", groups) + 2 * kept))
    height = height_of(width, 1, *(len(s[1]) for s in sides))
    for b, sources, _ in sides:
        mine = cells[block[cells] == b]
        row = pc.index_in(get["source"].take(pa.array(mine)), value_set=sources).to_numpy(zero_copy_only=False)
        trees.append(Tree(row, column[block[cells] == b], n_of[mine], len(sources), width, height))
    (_, left, dl), (_, right, dr) = sides[0], sides[-1]
    left, right = (np.array(names.to_pylist(), object) for names in (left, right))
    values = pair_values(trees[0], trees[-1], dl, dr) if width else np.zeros((len(left), len(right)), np.int64)
    out: dict[str, list] = {"source": [], "part": [], "item": [], "value": []}
    x, y = np.nonzero(np.triu(np.ones_like(values), 1) if first == second else np.ones_like(values))
    out["source"] += left[x].tolist()
    out["item"] += right[y].tolist()
    out["value"] += values[x, y].tolist()
    out["part"] += ["pair"] * len(x)
    if first == second and len(terms):
        totals = np.zeros(len(terms), np.int64)
        totals[column] = number("total", cells)
        total = Tree(np.zeros(len(terms), np.int64), np.arange(len(terms)), totals, 1, width, height)
        row, at, value = marking_terms(trees[0], total, dl, lang_n + 2 * kept)
        by_name = np.argsort(np.argsort(terms))  # code-point order, which is that of UTF-8
        order = np.lexsort((by_name[at], -value, row))
        row, at, value = row[order], at[order], value[order]
        first_of_row = np.searchsorted(row, row)
        best = np.arange(len(row)) - first_of_row < TOP
        out["source"] += left[row[best]].tolist()
        out["item"] += terms[at[best]].tolist()
        out["value"] += value[best].tolist()
        out["part"] += ["term"] * int(best.sum())
    return pa.table(
        {
            "lang": pa.array([lang] * len(out["item"]), pa.string()),
            **{c: pa.array(out[c], pa.int64() if c == "value" else pa.string()) for c in ("source", "part", "item", "value")},
        }
    )


def tiles(docs: DataFrame) -> DataFrame:
    """Rows of the tiles (lang, stripe, first, second): one per source, with null term, and one per cell."""
    cells = stage(term_counts(docs))
    # One shuffle of the cells by term; a term has a row per source at most.
    of_term = Window.partitionBy("lang", "term")
    summed = cells.where("term <> ''").withColumns({"total": F.sum("n").over(of_term), "held": F.sum("docs").over(of_term)})
    counted = stage(summed.where(F.col("held") >= MIN_DOCS).select("lang", "source", "term", "n", "total"))
    kept = counted.select("lang", "term", "total").distinct()
    sizes = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_n"))
    groups = cells.where("term = ''").select("lang", "source")
    langs = groups.groupBy("lang").agg(F.count("*").alias("groups")).join(sizes, "lang", "left").fillna(0, ["kept", "lang_n"])
    langs = langs.withColumn("stripes", F.greatest(F.ceil(F.col("kept") / COLUMNS), F.lit(1)).cast("long"))
    langs = stage(langs.withColumn("blocks", F.ceil(F.col("groups") / ROWS).cast("long")).drop("groups"))
    n_langs = langs.count()
    summed = counted.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = groups.join(summed, ["lang", "source"], "left").fillna(0, ["group_n"])

    zero = F.lit(0).cast("long")
    block = F.pmod(F.xxhash64("source"), F.col("blocks"))
    every = lambda n: F.explode(F.sequence(zero, F.col(n) - 1))
    heads = lookup_join(groups, langs, ["lang"], "inner", n_langs).withColumn("block", block).withColumn("stripe", every("stripes"))
    stripe = F.pmod(F.xxhash64("term"), F.col("stripes"))
    widths = lookup_join(kept, langs.select("lang", "stripes"), ["lang"], "inner", n_langs).groupBy("lang", stripe.alias("stripe"))
    heads = heads.join(widths.agg(F.count("*").alias("width")), ["lang", "stripe"], "left").fillna(0, ["width"])
    heads = heads.withColumns({"term": F.lit(None).cast("string"), "n": zero, "total": zero})
    body = lookup_join(counted, langs, ["lang"], "inner", n_langs).withColumn("block", block)
    body = body.withColumns({"stripe": stripe, "group_n": zero, "width": zero})
    columns = ["lang", "stripe", "block", "blocks", "source", "term", "n", "total", "group_n", "kept", "lang_n", "width"]
    rows = heads.select(columns).unionByName(body.select(columns)).withColumn("other", every("blocks"))
    rows = rows.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    return rows.drop("blocks", "other")


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources, and the terms that mark a source."""
    found = (
        tiles(docs)
        .groupBy("lang", "stripe", "first", "second")
        .applyInArrow(_tile, "lang string, source string, part string, item string, value long")
    )
    found = stage(found)
    summed = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = summed.select("lang", ways.alias("way"), "part", "value").select("lang", "way.source", "part", "way.item", "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    terms = found.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= TOP)
    return pairs.withColumn("rank", rank).unionByName(terms)
