"""Hard negatives of anchors by a Voronoi-partitioned join of nearest neighbours.

The largest inner product is the nearest neighbour once vectors are lengthened: with M the largest norm, x gets the further component sqrt(M^2 - |x|^2) and an
anchor the component 0, so |q - x|^2 = |q|^2 + M^2 - 2 q.x. Pivots part this space into cells. Each anchor, and in a first round each row, belongs to the
cell of its nearest pivot; what an anchor finds at home bounds what it still needs. By the triangle inequality a row can serve an anchor of a cell only if
its distance from the cell's pivot lies within the cell's bounds, so a second round sends each row to such cells alone, where the join is exact.

A cell's anchors are dealt into groups and the rows sent to it into chunks, both by hash and bounded; a task holds one group and streams one chunk past it.
Of each anchor and band of scores a chunk keeps the first few, and these are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.common import in_batches, table, written

#: Scale of the integers that components become.
SCALE = 256
#: Most pivots, which are broadcast; anchors of a pivot, of a group, and rows of a chunk, each as expected of a hash.
PIVOTS, PER_PIVOT, GROUP, CHUNK = 256, 128, 256, 4096
#: Rows multiplied at once.
SLICE = 512
#: Labels are told apart by so many classes where bounds are concerned.
CLASSES = 16
#: Scores up to this are exact as sums of doubles.
EXACT = 1 << 52
FAR = (1 << 62) - 1
BANDS = "array<struct<band:bigint,lo:bigint,hi:bigint>>"


def quantised(x: Column) -> Column:
    """floor(256 x) of each component, as doubles."""
    return F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("double"))


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, label, v of the rows that take part: those whose id, label, vector and components are all there and finite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull()).where(F.coalesce(finite, F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.transform(F.col(vector), lambda v: v.cast("double")).alias("v"))


def _packed(dims: int):
    """Vectors as bytes of doubles, with zeros behind short ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("v")
            offsets, flat = x.offsets.to_numpy(), x.values.to_numpy(zero_copy_only=False)
            lengths = np.diff(offsets)
            m = np.zeros((len(batch), dims))
            row = np.repeat(np.arange(len(batch)), lengths)
            m[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat[offsets[0] : offsets[-1]]
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array([r.tobytes() for r in m], pa.binary()), pa.array((m * m).sum(1))], ["vec_id", "label", "v", "norm2"])

    return run


def _matrix(col: pa.Array, dims: int) -> np.ndarray:
    """The rows of a column of packed vectors."""
    return np.frombuffer(b"".join(col.to_pylist()), np.float64).reshape(len(col), dims) if dims else np.zeros((len(col), 0))


def _nearest(pivots: np.ndarray, lift2: float):
    """Adds cell, the nearest pivot's number, and far, the distance from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _distances(_matrix(batch.column("v"), pivots.shape[1]), pivots, lift2)
            cell = d.argmin(1)
            yield pa.record_batch([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])], [*batch.schema.names, "cell", "far"])

    return run


def _distances(x: np.ndarray, pivots: np.ndarray, lift2: float) -> np.ndarray:
    """Distances of lengthened rows from the pivots. lift2: M^2 for rows, 0 for anchors, whose further component is 0."""
    norms = (x * x).sum(1)
    lifted = np.maximum(lift2 - norms, 0) if lift2 else 0
    square = np.maximum(norms[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T, 0)
    return np.sqrt(square + (lifted[:, None] if lift2 else 0))


def _routed(pivots: np.ndarray, lift2: float, nearest: np.ndarray, farthest: np.ndarray, classes: bool):
    """A row for each vector and cell whose bounds it is within. nearest, farthest: by cell, and by class of the label if classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _distances(_matrix(batch.column("v"), pivots.shape[1]), pivots, lift2)
            which = batch.column("class").to_numpy() if classes else np.zeros(len(batch), np.int64)
            slack = 1e-9 * (1 + d + lift2**0.5)
            rows, cells = np.nonzero((d >= nearest[:, which].T - slack) & (d <= farthest[:, which].T + slack))
            for lo in range(0, max(1, len(rows)), 1 << 14):
                part = slice(lo, lo + (1 << 14))
                yield pa.record_batch([*batch.take(pa.array(rows[part])).columns, pa.array(cells[part].astype(np.int32))], [*batch.schema.names, "cell"])

    return run


def _products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of integers held as doubles. Cauchy and Schwarz bound what comes up in between, so if the bound is small doubles do."""
    most = np.sqrt((anchors * anchors).sum(1).max(initial=0) * (rows * rows).sum(1).max(initial=0))
    if most < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    if most >= FAR:
        raise OverflowError("inner products of these vectors don't fit into 64 bits")
    return anchors.astype(np.int64) @ rows.T.astype(np.int64)


class _Best:
    """The first k rows of each of n bands, by falling score and rising id, held as flat arrays: band, score, id."""

    def __init__(self, n: int, k: int):
        self.k, self.flat, self.kth = k, [np.zeros(0, np.int64)] * 3, np.full(n, -FAR, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray, ok: np.ndarray) -> None:
        """scores, ok: bands by rows; ids: of the rows."""
        scores = np.where(ok, scores, -FAR - 1)
        least = self.kth
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        r, c = np.nonzero(scores >= least[:, None])
        if not len(r):
            return
        band, score, other = (np.concatenate(x) for x in zip(self.flat, (r, scores[r, c], ids[c]), strict=True))
        by = np.lexsort((other, -score, band))
        band, score, other = band[by], score[by], other[by]
        rank = np.arange(len(band)) - np.searchsorted(band, band)
        keep = rank < self.k
        last = rank == self.k - 1
        self.kth[band[last]] = score[last]
        self.flat = [band[keep], score[keep], other[keep]]


def _joined(dims: int, k: int, same: bool):
    """In each cell, group and chunk the anchors (tag 0) come first, then the rows (tag 1) that stream past them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, group = None, [], None

        def begun() -> tuple:
            b = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            bands = b.column("bands")
            at = np.repeat(np.arange(len(b)), np.diff(bands.offsets.to_numpy()))
            number, least, most = (c.to_numpy() for c in bands.flatten().flatten())
            return _matrix(b.column("v"), dims), at, b.column("vec_id").to_numpy()[at], b.column("label").to_numpy()[at], number, least, most, _Best(len(at), k)

        def done():
            ids, number, (band, score, other) = group[2], group[4], group[7].flat
            return pa.record_batch([pa.array(x) for x in (ids[band], number[band], other, score)], ["anchor_id", "band", "other_id", "score"])

        for batch in batches:
            place = [batch.column(c).to_numpy() for c in ("cell", "grp", "chunk", "tag")]
            cuts = np.flatnonzero(np.any([np.diff(x) != 0 for x in place], axis=0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(batch)], strict=True):
                if lo == hi:
                    continue
                if (here := tuple(x[lo] for x in place[:3])) != key:
                    if group is not None:
                        yield done()
                    key, held, group = here, [], None
                if place[3][lo] == 0:
                    held.append(batch.slice(lo, hi - lo))
                    continue
                if not held:
                    continue
                group = group or begun()
                v, at, ids, labels, _, least, most, best = group
                for i in range(lo, hi, SLICE):
                    part = batch.slice(i, min(SLICE, hi - i))
                    rid, rlabel = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
                    scores = _products(v, _matrix(part.column("v"), dims))[at]
                    ok = (scores >= least[:, None]) & (scores <= most[:, None]) & ((labels[:, None] == rlabel[None, :]) == same)
                    best.add(scores, rid, ok & (ids[:, None] != rid[None, :]) if same else ok)
        if group is not None:
            yield done()

    return run


class Search:
    """Rows dealt for exact searches. rows: vec_id, label, v (see usable(), maybe quantised); anchors: which of them ask, as a condition on vec_id.

    Anchors that share an id stand for one, the least by label and vector. All other rows count as they are, those that repeat an id too. Short vectors
    are as if they ended with zeros. Inner products beyond 62 bits raise OverflowError."""

    def __init__(self, rows: DataFrame, anchors: Column, pivots: int = PIVOTS, per_pivot: int = PER_PIVOT, group: int = GROUP, chunk: int = CHUNK):
        self.group = group
        self.dims = dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
        packed = in_batches(rows).mapInArrow(_packed(dims), "vec_id long, label long, v binary, norm2 double")
        self.rows = written(packed.withColumn("class", F.pmod(F.xxhash64("label"), F.lit(CLASSES)).cast("int")), "vectors")
        asking = written(self.rows.where(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "v", "class", "norm2")).alias("a")).select("vec_id", "a.*"), "asking")
        n, most = self.rows.agg(F.count("*"), F.max("norm2")).first()
        self.lift2, self.chunks = most or 0.0, max(1, -(-n // chunk))
        count = max(1, min(pivots, -(-asking.count() // per_pivot)))
        chosen = asking.orderBy(F.xxhash64("vec_id"), "vec_id").limit(count).collect()  # pivots rows at most
        self.pivots = np.frombuffer(b"".join(r["v"] for r in chosen), np.float64).reshape(len(chosen), dims) if chosen else np.zeros((1, dims))
        placed = in_batches(asking).mapInArrow(_nearest(self.pivots, 0.0), f"{', '.join(f'{c} {t}' for c, t in asking.dtypes)}, cell int, far double")
        self.anchors = written(placed, "anchors")

    def _join(self, asked: DataFrame, sent: DataFrame, k: int, same: bool) -> DataFrame:
        """asked: anchors with their bands; sent: rows with the cell that each goes to. anchor_id, band, other_id, score, rank of the first k."""
        sizes = F.broadcast(asked.groupBy("cell").agg(F.ceil(F.count("*") / self.group).cast("int").alias("groups")))  # a row for each pivot at most
        part = lambda m, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), m).cast("int")
        every = lambda m: F.explode(F.sequence(F.lit(0), m - 1))
        bands = asked.join(sizes, "cell").select("cell", part(F.col("groups"), 2).alias("grp"), every(F.lit(self.chunks)).alias("chunk"), F.lit(0).alias("tag"), "vec_id", "label", "v", "bands")
        rows = sent.join(sizes, "cell").select("cell", every(F.col("groups")).alias("grp"), part(F.lit(self.chunks), 1).alias("chunk"), F.lit(1).alias("tag"), "vec_id", "label", "v", F.lit(None).cast(BANDS).alias("bands"))
        dealt = bands.unionByName(rows).repartition("cell", "grp", "chunk").sortWithinPartitions("cell", "grp", "chunk", "tag")
        found = in_batches(dealt).mapInArrow(_joined(self.dims, k, same), "anchor_id long, band long, other_id long, score long")
        order = Window.partitionBy("anchor_id", "band").orderBy(F.desc("score"), "other_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)  # k rows of each chunk come here

    def _bounds(self, asked: DataFrame, classes: bool) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest distance from each pivot, by class of labels if classes, at which a row can serve an anchor of the cell."""
        distance = lambda score: F.sqrt(F.greatest(F.col("norm2") + self.lift2 - 2 * score.cast("double"), F.lit(0.0)))
        each = asked.select("cell", "class" if classes else F.lit(0).alias("class"), "far", "norm2", F.explode("bands").alias("b"))
        outer = F.when(F.col("b.lo") <= -FAR, F.lit(float("inf"))).otherwise(distance(F.col("b.lo")) + F.col("far"))
        inner = F.when(F.col("b.hi") >= FAR, F.lit(0.0)).otherwise(distance(F.col("b.hi")) - F.col("far"))
        shape = (len(self.pivots), CLASSES if classes else 1)
        nearest, farthest = np.full(shape, np.inf), np.full(shape, -np.inf)
        for r in each.where("b.lo <= b.hi").groupBy("cell", "class").agg(F.min(inner).alias("a"), F.max(outer).alias("z")).collect():  # pivots times classes rows at most
            nearest[r["cell"], r["class"]], farthest[r["cell"], r["class"]] = r["a"], r["z"]
        return nearest, farthest

    def best(self, bands: DataFrame, k: int, same: bool, name: str) -> DataFrame:
        """anchor_id, band, other_id, score, rank: the first k rows, by falling score and rising id, whose score is in an anchor's band, of the anchor's label
        (same; the anchor itself aside) or of other labels. bands: vec_id, band, lo, hi, a few for each anchor; -FAR and FAR are no bounds."""
        asked = written(self.anchors.join(bands.groupBy("vec_id").agg(F.collect_list(F.struct("band", "lo", "hi")).alias("bands")), "vec_id"), f"{name}-bands")
        kinds = ", ".join(f"{c} {t}" for c, t in self.rows.dtypes)
        home = in_batches(self.rows).mapInArrow(_nearest(self.pivots, self.lift2), f"{kinds}, cell int, far double")
        last = self._join(asked, home, k, same).where(F.col("rank") == k)
        kth = last.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.map_from_entries(F.collect_list(F.struct("band", "score"))).alias("kth"))
        # what is found at home in full needs no lower score than its last one
        raised = F.transform("bands", lambda b: F.struct(b["band"].alias("band"), F.greatest(b["lo"], F.try_element_at("kth", b["band"])).alias("lo"), b["hi"].alias("hi")))
        asked = written(asked.join(kth, "vec_id", "left").withColumn("bands", raised).drop("kth"), f"{name}-raised")
        sent = in_batches(self.rows).mapInArrow(_routed(self.pivots, self.lift2, *self._bounds(asked, same), same), f"{kinds}, cell int")
        return self._join(asked, sent, k, same)


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, **sizes) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: of each anchor's first positives (rows of its label), the first
    negatives (rows of other labels) whose score is from low to high per cent of the positive's.

    Rows come first by falling inner product, ties by rising id. An anchor without positives, or a positive without such negatives, gives no rows.
    rows: vec_id, label, v with whole numbers as doubles; sizes go to Search()."""
    search = Search(rows, anchors, **sizes)
    any_score = [F.lit(x).cast("long").alias(c) for c, x in (("band", 0), ("lo", -FAR), ("hi", FAR))]
    liked = written(search.best(search.anchors.select("vec_id", *any_score), positives, True, "positives"), "positives")
    p = F.col("score")
    lo, hi = F.ceil(p * low / F.lit(100.0)), F.floor(p * high / F.lit(100.0))  # close; the whole numbers decide, below
    lo = F.when((lo - 1) * 100 >= p * low, lo - 1).when(lo * 100 < p * low, lo + 1).otherwise(lo)
    hi = F.when((hi + 1) * 100 <= p * high, hi + 1).when(hi * 100 > p * high, hi - 1).otherwise(hi)
    bands = liked.select(F.col("anchor_id").alias("vec_id"), F.col("rank").cast("long").alias("band"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi")).where("lo <= hi")
    found = search.best(bands, negatives, False, "negatives")
    to = liked.select("anchor_id", F.col("rank").cast("long").alias("band"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(to, ["anchor_id", "band"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all vectors whose id is divisible by 100, among all vectors; every seventh id's label is changed first."""
    rows = usable(table(spark, sf_dir, "embeddings"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), quantised(F.col("v")).alias("v")), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH v AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
 FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
s AS (SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same, CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * o.v[i])) AS BIGINT) AS score
 FROM v a JOIN v o ON a.vec_id % 100 = 0 AND (a.label <> o.label OR a.vec_id <> o.vec_id)),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, p.other_id AS positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INT) AS rank, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n USING (anchor_id) WHERE NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score QUALIFY rank <= 10
"""
