"""Jaccard join of word n-grams by an R-tree over count vectors.

A document's set holds the fingerprints of its distinct n-grams. Hashed into GROUPS groups, a set becomes a point, its counts by group; two
sets share at most the sum of the lesser counts, so R-tree pages and points whose bound is too low are never compared. What passes is
verified on the texts.

Points are dealt to trees by prefix filtering, which is exact: in any fixed order of n-grams, two sets that link share one of the first
n - ceil(0.8 n) + 1 of each. The order puts n-grams seen often last, so trees stay small and a passage that many documents share deals
hardly anyone. Copies of a set are one node. Trees of the same nodes count once. First, each node is verified against one leader of its
trees only (no more pairs than nodes), and linked nodes are contracted; then the trees are searched for pairs of nodes that aren't connected yet. Trees
with more than BLOCK points are searched block by block. Sets and n-grams are told apart by 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import SPACE, TO_LOWER, Fingerprints, chunks, gather, in_batches, mix, stretches, table, unused, utf8, words, written
from quern.llm.components import components

#: Least dimensions of a point, which pages have, points of an R-tree page, points of a block of a large tree.
GROUPS, PAGE, BLOCK = 64, 32, 512
#: Counts that stand for this many n-grams or more, in whole points and in those folded to GROUPS.
FULL, FLAT_FULL = 15, 65_535
#: N-grams that a batch holds in at least this many texts, and in this part of its texts, are counted as frequent; so many are broadcast.
OFTEN, PART, FREQUENT = 4, 0.01, 200_000
ROUNDS = 3


def _word_prints(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and row of each word. A long text goes by stretches that end behind a blank, so what is held at once is little more than
    the result, eight bytes for a word."""
    if len(offs) > 2:
        low = TO_LOWER[buf]
        s, e, row = words(low, offs)
        return (Fingerprints(low, 61).of(s, e) if len(s) else np.zeros(0, np.uint64)), row
    parts = [np.zeros(0, np.uint64)]
    for lo, hi in stretches(buf, 0, len(buf), SPACE):
        low = TO_LOWER[buf[lo:hi]]
        s, e, _ = words(low, np.array([0, len(low)]))
        if len(s):
            parts.append(Fingerprints(low, 61).of(s, e))
    word = np.concatenate(parts)
    return word, np.zeros(len(word), np.int64)


def shingles(buf: np.ndarray, offs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and fingerprint of the distinct n-grams of each text, by row and fingerprint; of a text of fewer words, the whole sequence is one."""
    word, row = _word_prints(buf, offs)
    if not len(word):
        return row, word
    rows = len(offs) - 1
    rng = np.random.default_rng(62)
    factor = rng.integers(1, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if rows == 1 and len(word) >= n:
        f = np.zeros(len(word) - n + 1, np.uint64)
        for k in range(n):
            f += word[k : len(word) - n + 1 + k] * factor[k]
        f = mix(f)
        f.sort()
        f = f[np.append(True, f[1:] != f[:-1])]
        return np.zeros(len(f), np.int64), f
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    at = np.flatnonzero(np.arange(len(word)) - first[row] <= count[row] - n)
    f = np.zeros(len(at), np.uint64)
    for k in range(n):
        f += word[at + k] * factor[k]
    f, r = mix(f), row[at]
    few = np.flatnonzero((count > 0) & (count < n))
    if len(few):
        place = np.arange(len(word)) - first[row]
        part = np.isin(row, few)
        sums = np.zeros(rows, np.uint64)
        np.add.at(sums, row[part], word[part] * factor[place[part]])
        f, r = np.concatenate([f, mix(sums[few] + count[few].astype(np.uint64))]), np.concatenate([r, few])
    order = np.lexsort((f, r))
    f, r = f[order], r[order]
    new = np.append(True, (f[1:] != f[:-1]) | (r[1:] != r[:-1])) if len(f) else np.zeros(0, bool)
    return r[new], f[new]


def _frequent(n: int):
    """N-grams that are frequent in a batch, with the number of its texts that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = utf8(batch.column("text"))
            f = [shingles(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], n)[1] for i, j in chunks(offs)]
            f, c = np.unique(np.concatenate(f) if f else np.zeros(0, np.uint64), return_counts=True)
            often = c >= max(OFTEN, PART * len(batch))
            yield pa.record_batch([f[often].view(np.int64), c[often]], ["f", "c"])

    return run


def groups_of(size: np.ndarray) -> np.ndarray:
    """Groups for sets of these sizes: the power of two up to the size, at least GROUPS, so that few n-grams share a group. As groups are the
    last bits of the fingerprints, a point of more groups folds into one of fewer."""
    return np.left_shift(1, np.maximum(np.floor(np.log2(np.maximum(size, 1))), np.log2(GROUPS)).astype(np.int64))


def _sets(n: int, percent: int, shared):
    """Of each text: node (fingerprint of its set), size, count vector, and the n-grams of its prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value  # sorted n-grams and their frequency classes
        for batch in batches:
            buf, offs = utf8(batch.column("text"))
            for i, j in chunks(offs):
                r, f = shingles(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], n)
                rows = j - i
                size = np.bincount(r, minlength=rows)
                node = np.zeros(rows, np.uint64)
                np.add.at(node, r, mix(f + np.uint64(0x5BD1E995)))
                node = mix(node + size.astype(np.uint64))
                groups = groups_of(size)
                at = np.cumsum(groups) - groups
                vec = np.bincount(at[r] + (f & (groups[r] - 1).astype(np.uint64)).astype(np.int64), minlength=int(groups.sum()))
                vec = np.minimum(vec, FULL).astype(np.uint8)
                vec = vec[::2] | vec[1::2] << 4  # two counts to a byte
                wide = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer((np.append(at, groups.sum()) // 2).astype(np.int32).tobytes()), pa.py_buffer(vec.tobytes())])
                flat = np.minimum(np.bincount(r * GROUPS + (f & np.uint64(GROUPS - 1)).astype(np.int64), minlength=rows * GROUPS), FLAT_FULL).astype(np.uint16)
                flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * GROUPS), rows, [None, pa.py_buffer(flat.tobytes())]).cast(pa.binary())
                cls = np.zeros(len(f), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, f), len(known) - 1)
                    cls = np.where(known[at] == f, rank[at], 0)
                order = np.lexsort((f, cls, r))
                place = np.arange(len(r)) - np.repeat(np.cumsum(size) - size, size)
                keep = place < np.repeat(size + -(-percent * size // 100) * -1 + 1, size)
                cuts = np.concatenate([[0], np.cumsum(np.bincount(r[keep], minlength=rows))]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(cuts), pa.array(f[order][keep].view(np.int64)))
                yield pa.record_batch([batch.column("doc_id")[i:j], batch.column("kid")[i:j], node.view(np.int64), size, wide, flat, tokens], ["doc_id", "kid", "node", "n", "vec", "flat", "tokens"])

    return run


def _verify(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = utf8(batch.column("text_a")), utf8(batch.column("text_b"))
            for i, j in chunks(one[1] + two[1]):
                sets = []
                for buf, offs in (one, two):
                    sets.append(shingles(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], n))
                r, f = np.concatenate([sets[0][0], sets[1][0]]), np.concatenate([sets[0][1], sets[1][1]])
                order = np.lexsort((f, r))
                r, f = r[order], f[order]
                both = np.bincount(r[1:][(r[1:] == r[:-1]) & (f[1:] == f[:-1])], minlength=j - i)
                either = np.bincount(r, minlength=j - i) - both
                linked = np.flatnonzero((100 * both >= percent * either) & (both > 0))
                own = batch.slice(i, j - i).select(["u", "v"]).take(pa.array(linked))
                yield own

    return run


class RTree:
    """Points in pages of PAGE, packed by sorting and tiling, each page with its least and largest counts and sizes."""

    def __init__(self, points: Points):
        vec, size = points.flat, points.size
        order = np.argsort(size, kind="stable")
        tile = max(PAGE, int(np.ceil(np.sqrt(len(order) / PAGE))) * PAGE)
        main = vec.var(0).argmax() if len(vec) else 0
        self.order = np.concatenate([order[i : i + tile][np.argsort(vec[order[i : i + tile], main], kind="stable")] for i in range(0, len(order), tile)]) if len(order) else order
        self.points, self.size = points, size[self.order]
        self.first = np.arange(0, len(order), PAGE)
        self.high = np.maximum.reduceat(vec[self.order], self.first) if len(order) else vec
        self.small, self.large = (f.reduceat(self.size, self.first) if len(order) else self.size for f in (np.minimum, np.maximum))

    def page(self, k: int) -> slice:
        return slice(int(self.first[k]), int(self.first[k]) + PAGE)


def near_pairs(a: RTree, b: RTree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices (into the trees' input) of the pairs whose bound allows a link: of two sets that link, the shared part is at least
    percent / (100 + percent) of the summed sizes, and the sizes differ by no more than percent."""
    need = percent / (100 + percent) - 1e-9
    for k in range(len(a.first)):
        bound = np.minimum(a.high[k], b.high).sum(1)
        pages = np.flatnonzero((bound >= need * (a.small[k] + b.small)) & (100 * a.large[k] >= percent * b.small) & (100 * b.large >= percent * a.small[k]))
        own = a.order[a.page(k)]
        for page in pages:
            if a is b and page < k:
                continue
            other = b.order[b.page(page)]
            i, j = np.repeat(own, len(other)), np.tile(other, len(own))
            near = bounded(a.points, b.points, i, j, percent) >= 0
            if near.any():
                yield i[near], j[near]


class Points:
    """Points of sets, whole and folded to GROUPS dimensions, with the sets' sizes. Points of as many groups lie in one matrix."""

    def __init__(self, vec: list[bytes], size: np.ndarray):
        self.size = size
        self.groups = np.array([2 * len(v) for v in vec], np.int64)
        self.place = np.zeros(len(vec), np.int64)
        self.whole: dict[int, np.ndarray] = {}
        self.flat = np.zeros((len(vec), GROUPS), np.int64)
        for g in np.unique(self.groups).tolist():
            own = np.flatnonzero(self.groups == g)
            self.place[own] = np.arange(len(own))
            packed = np.frombuffer(b"".join(vec[k] for k in own), np.uint8)
            self.whole[g] = np.stack([packed & FULL, packed >> 4], 1).reshape(-1, g)
            counts = self.whole[g].reshape(-1, g // GROUPS, GROUPS)
            self.flat[own] = np.where((counts == FULL).any(1), size[own][:, None], counts.sum(1, dtype=np.int64))

    def folded(self, g: int, rows: np.ndarray, to: int) -> np.ndarray:
        m = self.whole[g][self.place[rows]]
        return m if g == to else np.where((f := m.reshape(-1, g // to, to)).max(1) == FULL, FULL, np.minimum(f.sum(1, dtype=np.int64), FULL)).astype(np.uint8)


def bounded(a: Points, b: Points, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """The most that the sets i of a and j of b can share, or -1 where this, or their sizes, allow no link."""
    out = np.full(len(i), -1, np.int64)
    x, y = a.size[i], b.size[j]

    def keep(pairs: np.ndarray, shared: np.ndarray) -> None:
        near = shared * (100 + percent) >= percent * (x[pairs] + y[pairs])
        out[pairs] = np.where(near, shared, -1)

    ok = np.flatnonzero(100 * np.minimum(x, y) >= percent * np.maximum(x, y))
    for k in range(0, len(ok), 1 << 13):
        p = ok[k : k + (1 << 13)]
        keep(p, np.minimum(a.flat[i[p]], b.flat[j[p]]).sum(1))
    left = np.flatnonzero((out >= 0) & (np.maximum(a.groups[i], b.groups[j]) > GROUPS))
    kinds = a.groups[i[left]] << 32 | b.groups[j[left]]
    for kind in np.unique(kinds).tolist():
        own, ga, gb = left[kinds == kind], kind >> 32, kind & 0xFFFFFFFF
        g = min(ga, gb)
        step = max(1, (1 << 21) // max(ga, gb))
        for k in range(0, len(own), step):
            p = own[k : k + step]
            least = np.minimum(a.folded(ga, i[p], g), b.folded(gb, j[p], g))
            keep(p, np.where((least == FULL).any(1), np.minimum(x[p], y[p]), least.sum(1, dtype=np.int64)))
    return out


def _bound_filter(percent: int):
    """Pairs node, other (with their sizes and folded points) that may link, with their bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            (x, a), (y, b) = ((batch.column(f"n_{s}").to_numpy(), np.frombuffer(b"".join(batch.column(f"flat_{s}").to_pylist()), np.uint16).reshape(n, GROUPS)) for s in "ab")
            least = np.minimum(a, b)
            shared = np.where((least == FLAT_FULL).any(1), np.minimum(x, y), least.sum(1, dtype=np.int64))
            bound = np.where(shared * (100 + percent) >= percent * (x + y), shared, -1)
            keep = pa.array(np.flatnonzero(bound >= 0))
            yield pa.record_batch([batch.column("node").take(keep), batch.column("other").take(keep), pa.array(bound).take(keep)], ["node", "other", "bound"])

    return run


def _search(percent: int):
    """Streams trees in order (rows of one tree, or of two blocks of one, are neighbours) and yields pairs of nodes of different components."""

    def pairs_of(a: np.ndarray, b: np.ndarray):
        if len(a):
            yield np.stack([np.maximum(a, b), np.minimum(a, b)])

    def small(node, root, points, starts, counts):
        """All pairs within each of many trees of a page at most."""
        end = np.repeat(starts + counts, counts)
        at = gather(starts, counts)
        for k in range(0, len(at), 1 << 13):
            i = np.repeat(at[k : k + (1 << 13)], (end - at - 1)[k : k + (1 << 13)])
            j = gather(at[k : k + (1 << 13)] + 1, (end - at - 1)[k : k + (1 << 13)])
            apart = root[i] != root[j]
            i, j = i[apart], j[apart]
            near = bounded(points, points, i, j, percent) >= 0
            yield from pairs_of(node[i[near]], node[j[near]])

    def large(node, root, size, vec, block, lo, hi):
        parts = [np.flatnonzero(block == x) for x in np.unique(block)]
        if lo != hi and len(parts) < 2:
            return
        trees = [RTree(Points([vec[k] for k in p], size[p])) for p in parts]
        x, y = (0, 0) if lo == hi else (0, 1)
        for i, j in near_pairs(trees[x], trees[y], percent):
            i, j = parts[x][i], parts[y][j]
            apart = root[i] != root[j]
            yield from pairs_of(node[i[apart]], node[j[apart]])

    def found(t: pa.Table):
        """Pairs of a table of whole trees, as often as trees hold them."""
        node, root, size, block, token, lo, hi = (t.column(c).to_numpy() for c in ("node", "root", "n", "block", "token", "lo", "hi"))
        vec = t.column("vec").to_pylist()
        new = (token[1:] != token[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
        starts = np.append(0, np.flatnonzero(new) + 1)
        counts = np.diff(np.append(starts, len(t)))
        paged = (counts <= PAGE) & (lo[starts] == hi[starts])
        yield from small(node, root, Points(vec, size), starts[paged], counts[paged])
        for a, c in zip(starts[~paged].tolist(), counts[~paged].tolist(), strict=True):
            p = slice(a, a + c)
            yield from large(node[p], root[p], size[p], vec[a : a + c], block[p], lo[a], hi[a])

    def whole(t: pa.Table):
        """Pairs of a table of whole trees, once; of very many, once for each million."""
        held, n = [], 0
        for pair in found(t) if len(t) else ():
            held.append(pair)
            n += pair.shape[1]
            if n >= 1 << 20:
                held = [np.unique(np.concatenate(held, 1), axis=1)]
                n = held[0].shape[1]
                if n >= 1 << 19:
                    yield pa.record_batch(list(held[0]), ["u", "v"])
                    held, n = [], 0
        if n:
            yield pa.record_batch(list(np.unique(np.concatenate(held, 1), axis=1)), ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the tree that may go on
        key = None
        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("head", "token", "lo", "hi")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            if key is not None and (keys[:, 0] != key).any():
                yield from whole(pa.Table.from_batches(held))
                held = []
            last = int(cuts[-1]) if len(cuts) else 0
            if last:
                yield from whole(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
            key = keys[:, -1]
        if held:
            yield from whole(pa.Table.from_batches(held))

    return run


def _linked(pairs: DataFrame, texts: DataFrame, n: int, percent: int, name: str) -> DataFrame:
    """The pairs u, v whose texts' sets link."""
    a = texts.select(F.col("node").alias("u"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("v"), F.col("text").alias("text_b"))
    both = pairs.join(a, "u").join(b, "v").select("u", "v", "text_a", "text_b")
    return written(in_batches(both).mapInArrow(_verify(n, percent), "u long, v long"), name)


def _rooted(cand: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Adds root to rows with node."""
    if roots is None:
        return cand.withColumn("root", F.col("node"))
    return cand.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _leaders(cand: DataFrame, points: DataFrame, round_: int, percent: int) -> DataFrame:
    """u, v: each node with one leader of its trees at most. A tree's leaders are its nodes of least and largest hash; of those in other
    components than the node, whose bound allows a link, it gets the one of the best bound."""
    hashed = cand.withColumn("h", F.xxhash64("node", F.lit(round_)))
    pick = F.struct("h", "node", "root")
    of_tree = hashed.groupBy("token").agg(F.min(pick).alias("first"), F.max(pick).alias("last"))
    met = cand.join(of_tree, "token").select("node", "root", F.explode(F.array("first", "last")).alias("l"))
    pairs = met.where("l.root <> root").select("node", F.col("l.node").alias("other")).distinct()
    a = points.select("node", F.col("n").alias("n_a"), F.col("flat").alias("flat_a"))
    b = points.select(F.col("node").alias("other"), F.col("n").alias("n_b"), F.col("flat").alias("flat_b"))
    both = pairs.join(a, "node").join(b, "other").where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").select("node", "other", "n_a", "n_b", "flat_a", "flat_b")
    near = in_batches(both).mapInArrow(_bound_filter(percent), "node long, other long, bound long")
    best = near.groupBy("node").agg(F.max_by("other", F.struct("bound", "other")).alias("other"))
    return best.select(F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v")).distinct()


def _kid(doc_id: Column, text: Column) -> Column:
    """What tells rows apart: a fingerprint of id and text."""
    return F.xxhash64(doc_id, text)


def linked_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_shingles and component_id of each row: the size of its set, and the least doc_id that links reach.

    Words are runs of other bytes than 0x20 and 0x09-0x0D, after lower-casing A-Z. Two documents link when 100 * shared >= percent * united.
    Null text counts as empty; documents without words link with nothing, and their component is their own id. Repeated rows are documents of
    one set. A component takes no id from null ids; rows with null ids get the component's id, null if it has none. Texts of any length count
    whole; an empty table gives an empty result; further columns are ignored.
    """
    return _components(docs, n, percent, id_col, text_col, rounds).drop("kid")


def _components(docs: DataFrame, n: int, percent: int, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """linked_components(), with kid."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("kid", _kid(F.col("doc_id"), F.col("text")))
    often = in_batches(rows.select("text")).mapInArrow(_frequent(n), "f long, c long").groupBy("f").agg(F.sum("c").alias("c"))
    got = often.orderBy(F.desc("c"), "f").limit(FREQUENT).collect()  # bounded by FREQUENT
    known, count = np.array([r.f for r in got], np.int64).view(np.uint64), np.array([r.c for r in got], np.int64)
    order = np.argsort(known)
    shared = spark.sparkContext.broadcast((known[order], np.ceil(np.log2(count[order] + 1)).astype(np.int64)))
    sets = in_batches(rows).mapInArrow(_sets(n, percent, shared), "doc_id long, kid long, node long, n long, vec binary, flat binary, tokens array<long>")
    sets = written(sets, "sets")
    tokens = sets.where("n > 0").select("node", F.explode("tokens").alias("token"))
    trees = tokens.groupBy("token").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("token")
    cand = written(tokens.join(written(trees, "trees"), "token").select("token", "node").distinct(), "met")
    cand = written(_distinct_trees(cand), "trees-once")
    chosen = cand.select("node").distinct()
    points = written(sets.select("node", "n", "vec", "flat").join(chosen, "node", "left_semi").dropDuplicates(["node"]), "points")
    keys = sets.groupBy("node").agg(F.min("kid").alias("kid")).join(chosen, "node")
    texts = written(rows.join(keys, "kid").select("node", "text").dropDuplicates(["node"]), "texts")
    roots, links = None, spark.createDataFrame([], "u long, v long")
    for k in range(rounds):
        links = links.unionByName(_linked(_leaders(_rooted(cand, roots), points, k, percent), texts, n, percent, f"links-{k}"))
        roots = components(links, f"round-{k}")
        cand = written(_open(_rooted(cand, roots)).select("token", "node"), f"open-{k}")
    links = links.unionByName(_linked(_pairs(_rooted(cand, roots), points, percent), texts, n, percent, "links"))
    roots = components(links, "all")
    full = sets.where("n > 0").select("doc_id", "kid", "n", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = full.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = full.join(least, "root").select("doc_id", "kid", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(sets.where("n = 0").select("doc_id", "kid", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs (doc_id, text and others) whose doc_id is the least of their component; all columns stay, whatever their names.

    A row is told by its id and its text, so of rows that share an id only those go whose text is linked with one of a lesser id. Rows without
    words, rows with null ids, and rows that share the least id of their component all stay. Null texts count as empty. An empty table gives
    an empty result.
    """
    found = _components(docs, n, percent).where("doc_id <> component_id").select("doc_id", "kid").distinct()
    gone, key, own = (unused(docs, c) for c in ("gone", "gone_kid", "own_kid"))
    marked = docs.withColumn(own, _kid(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))))
    left = marked.join(found.toDF(gone, key), (F.col("doc_id").cast("long") == F.col(gone)) & (F.col(own) == F.col(key)), "left_anti")
    return left.select(*(marked[c] for c in docs.columns))


def _open(cand: DataFrame) -> DataFrame:
    """Rows of the trees that still hold more than one component, with a tree's number of nodes."""
    trees = cand.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("m"))
    return cand.join(trees.where("a <> b").select("token", "m"), "token")


def _distinct_trees(cand: DataFrame) -> DataFrame:
    """Of trees with the same nodes, as near copies give by the dozen, one stays. Sets of nodes are told apart by their number and two hashes."""
    sets = cand.groupBy("token").agg(F.count("*").alias("m"), *(F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in (0, 1)))
    return cand.join(sets.groupBy("m", "x0", "x1").agg(F.min("token").alias("token")).select("token"), "token")


def _pairs(cand: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """u, v: all pairs of nodes of different components that share a tree and whose bound allows a link.

    Near copies share many trees. Trees are dealt by their head, the node of most trees among theirs, so that most trees of near copies meet
    in one task, which names a pair once. A head has no more trees than its prefix has n-grams; of trees of more than BLOCK nodes, pairs of
    blocks are dealt apart, the same blocks for all such trees of a head.
    """
    rows = _open(cand)
    degree = rows.groupBy("node").agg(F.count("*").alias("degree"))
    trees = rows.join(degree, "node").groupBy("token").agg(F.max(F.struct("degree", "node")).getField("node").alias("head"), F.first("m").alias("m"))
    most = trees.groupBy("head").agg(F.ceil(F.max("m") / BLOCK).cast("long").alias("most"))
    trees = trees.join(most, "head").select("token", "head", F.when(F.col("m") <= BLOCK, F.lit(1).cast("long")).otherwise(F.col("most")).alias("blocks"))
    rows = rows.join(trees, "token").join(points.select("node", "n", "vec"), "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("head", "token", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "block", "node", "root", "n", "vec")
    dealt = rows.repartition("head", "lo", "hi").sortWithinPartitions("head", "lo", "hi", "token")
    return in_batches(dealt).mapInArrow(_search(percent), "u long, v long").distinct()


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_components(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS grams FROM w),
n AS (SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles FROM sets),
s AS (SELECT doc_id, unnest(grams) AS gram FROM sets),
often AS (SELECT gram FROM s GROUP BY gram HAVING count(*) > 1),
few AS (SELECT doc_id, gram FROM s SEMI JOIN often USING (gram)),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM few a JOIN few b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n_shingles + y.n_shingles - shared)),
reach AS (SELECT doc_id, doc_id AS other FROM n UNION SELECT doc_id, b FROM reach JOIN links ON a = other)
SELECT doc_id, n_shingles, component_id FROM n JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""
