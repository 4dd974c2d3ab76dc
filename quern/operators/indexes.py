"""Indexes for retrieval: an inverted file of vectors, and postings of words with positions and block maxima.

Both are tables that Spark writes and reads: a search reads the cells or words that it asks for, not the vectors or texts.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators.retrieval import K1, POOL, B

#: Most cells of a vector index, whose centres are broadcast; vectors that the centres are fitted on, as expected of a hash; words of a block of postings.
CELLS, FITTED, BLOCK = 4096, 100_000, 1024
#: Vectors and queries, as expected of a hash, that a task compares at once, and queries of one product of matrices.
PART, ASKED, STRIP = 8192, 8192, 256
#: A word: letters and digits; what parts words. Characters whose words are listed at once, words of a segment, which a task
#: holds, and rows of postings that are handed on at once. In a segment, LETTERS characters weigh a word at least, and a text LIGHTEST words.
_WORD, _GAP = re.compile(r"[^\W_]+"), re.compile(r"[\W_]")
STRETCH, SEGMENT, ROWS = 1 << 20, 1 << 21, 1 << 12
LETTERS, LIGHTEST = 16, 16


class VectorIndex:
    """Vectors by the nearest of some centres, which k-means finds. path holds cells (cell, n, centre, radius) and postings (key, vector, by cell).

    Distances are those of vectors scaled to length 1, so that nearest means most similar by cosine; vectors of zeros stay as they are, their cosine is 0.
    Null vectors aren't held."""

    def __init__(self, spark: SparkSession, path: str):
        kinds = spark.read.parquet(f"{path}/kinds").schema  # an index of nothing has no files of postings
        self.postings = spark.read.schema(kinds).parquet(f"{path}/postings")
        rows = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()  # CELLS rows at most
        self.cells = np.array([r["cell"] for r in rows], np.int64)
        self.sizes = np.array([r["n"] for r in rows], np.int64)
        self.radii = np.array([r["radius"] for r in rows])
        self.centres = np.array([r["centre"] for r in rows]).reshape(len(rows), len(rows[0]["centre"]) if rows else 0)

    @staticmethod
    def unit(vector: Column) -> Column:
        x = vector.cast("array<double>")
        norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v))
        return F.when(norm > 0, F.transform(x, lambda v: v / norm)).otherwise(x)

    @classmethod
    def build(cls, vectors: DataFrame, key: str, vector: str, path: str, cells: int | None = None, fitted: int = FITTED, seed: int = 7) -> VectorIndex:
        """Centres are fitted on a sample by hash of about fitted rows; every row is put into a cell. cells: the square root of the number of rows, if not given."""
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        spark = vectors.sparkSession
        rows = vectors.where(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).alias("vector"), array_to_vector(cls.unit(F.col(vector))).alias("features"))
        n = rows.count()
        k = max(1, min(CELLS, cells or round(n**0.5)))
        sample = rows.where(F.pmod(F.xxhash64("key"), F.lit(max(1, n // fitted))) == 0) if n > fitted else rows
        if n:
            model = KMeans(k=k, seed=seed, maxIter=10, initSteps=2).fit(sample.select("features"))
            centres = np.array(model.clusterCenters())
        else:
            centres = np.zeros((1, 1))

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = b.column("u")
                m = x.values.to_numpy()[x.offsets[0].as_py() :][: len(b) * centres.shape[1]].reshape(len(b), -1)
                square = np.maximum((m * m).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2 * m @ centres.T, 0)
                at = square.argmin(1)
                yield pa.record_batch([b.column("key"), b.column("vector"), pa.array(at.astype(np.int32)), pa.array(np.sqrt(square[np.arange(len(b)), at]))], ["key", "vector", "cell", "far"])

        schema = T.StructType([*(f for f in rows.schema.fields if f.name != "features"), T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType())])
        placed = vectors.where(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).alias("vector"), cls.unit(F.col(vector)).alias("u")).mapInArrow(nearest, schema)
        spark.createDataFrame([], T.StructType([*schema.fields[:2], schema["far"], schema["cell"]])).write.mode("overwrite").parquet(f"{path}/kinds")
        # by ranges of cell and hash, so that a cell with many rows goes to several tasks and files
        placed.repartitionByRange("cell", F.xxhash64("key")).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/postings")
        told = spark.read.schema(schema).parquet(f"{path}/postings").groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius"))
        centre = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>")
        told.join(centre, "cell").write.mode("overwrite").parquet(f"{path}/cells")
        return cls(spark, path)

    def _routed(self, queries: DataFrame, choose, extra: list[str]) -> DataFrame:
        """A row for each query and cell that choose (distances from the centres, the query's extra columns) picks."""
        cells, centres = self.cells, self.centres

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows, picked = [], []
                extras = [b.column(c).to_pylist() for c in extra]
                for i, q in enumerate(b.column("query").to_pylist()):
                    q = np.array(q, np.float64)
                    norm = np.sqrt((q * q).sum())
                    far = np.sqrt(np.maximum(((q / norm if norm else q) - centres) ** 2, 0).sum(1))
                    got = choose(far, *(x[i] for x in extras))
                    rows += [i] * len(got)
                    picked += cells[got].tolist()
                at = pa.array(rows, pa.int64())
                yield pa.record_batch([b.column("qid").take(at), b.column("query").take(at), *(b.column(c).take(at) for c in extra), pa.array(picked, pa.int32())], ["qid", "query", *extra, "cell"])

        kinds = {f.name: f for f in queries.schema.fields}
        return queries.mapInArrow(run, T.StructType([*(kinds[c] for c in ("qid", "query", *extra)), T.StructField("cell", T.IntegerType())]))

    def _first(self, routed: DataFrame, n: int) -> DataFrame:
        """The n best of each query in routed (qid, query, cell; maybe kth, a score that others need to reach). Cells are laid together, and long ones cut by
        hash, to parts of about PART vectors; a task compares a part with about ASKED queries, so a query goes to a part once, however many cells it asks for."""
        splits = np.maximum(1, -(-self.sizes // PART))
        bases, base, filled = [], -1, PART
        for size, split in zip(self.sizes.tolist(), splits.tolist(), strict=True):
            if split > 1 or filled + size > PART:
                base, filled = base + 1, 0
            bases.append(base)
            base, filled = base + split - 1, PART if split > 1 else filled + size
        spark = self.postings.sparkSession
        where = F.broadcast(spark.createDataFrame(list(zip(self.cells.tolist(), bases, splits.tolist(), strict=True)), "cell int, base int, split int"))
        kinds = {f.name: f for f in [*routed.schema.fields, *self.postings.schema.fields]}
        kth = F.col("kth") if "kth" in kinds else F.lit(None).cast("double")
        blocks = -(-max(1, routed.select("qid").distinct().count()) // ASKED)
        asked = routed.withColumn("kth", kth).join(where, "cell").select("qid", "query", "kth", "cell", F.explode(F.sequence("base", F.col("base") + F.col("split") - 1)).alias("part"))
        block = F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int")
        asked = asked.groupBy("qid", "part").agg(F.first("query").alias("query"), F.first("kth").alias("kth"), F.collect_list("cell").alias("cells")).withColumn("block", block)
        part = F.col("base") + F.pmod(F.xxhash64("key"), F.col("split")).cast("int")
        held = self.postings.join(where, "cell").select("key", "vector", "cell", part.alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        schema = T.StructType([kinds["qid"], kinds["key"], T.StructField("score", T.DoubleType())])
        best = asked.groupBy("part", "block").cogroup(held.groupBy("part", "block")).applyInArrow(_nearest(n), schema)
        rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "key"))
        return best.withColumn("rank", rank).where(F.col("rank") <= n)

    def search(self, queries: DataFrame, n: int = POOL, share: float | None = None) -> DataFrame:
        """qid, key, score, rank of the n vectors most similar to each query (qid, query), ties by lesser key. share: only the nearest cells are read, up to that
        part of all vectors (one cell at least). Without share the result is exact: a second round reads all cells that may hold a better one than the
        n-th of the first, by their centres and radii."""
        if not len(self.cells):
            return queries.select("qid", F.lit(None).cast(self.postings.schema["key"].dataType).alias("key"), F.lit(0.0).alias("score"), F.lit(1).alias("rank")).where("false")
        sizes, radii = self.sizes, self.radii
        most = max(1.0, (share or 0) * sizes.sum())

        def near(far: np.ndarray) -> np.ndarray:
            order = np.argsort(far, kind="stable")
            read = np.cumsum(sizes[order])
            return order[: max(1, int(np.searchsorted(read, most, "right")))] if share else order[: int(np.searchsorted(read, n)) + 1]

        first = self._first(self._routed(queries, near, []), n)
        if share:
            return first
        last = first.where(F.col("rank") == n).select("qid", F.col("score").alias("kth"))
        known = queries.join(last, "qid", "left")

        def may(far: np.ndarray, kth: float | None) -> np.ndarray:
            best = 1 - np.maximum(far - radii, 0) ** 2 / 2  # of vectors of length 1; for one of zeros the true score, 0, is at most as much
            return np.flatnonzero(np.maximum(best, 0) + 1e-9 >= kth) if kth is not None else np.arange(len(far))

        return self._first(self._routed(known, may, ["kth"]), n)


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    return np.array(vectors.to_pylist(), np.float64)


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in the order of the components as retrieval.dot() does, so that equal vectors have equal scores wherever they lie."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def _nearest(n: int):
    """qid, key, score of the n best of a part's vectors for each query, of the cells that it asks for. A product of matrices finds those that may be among
    them, by a margin above its rounding; only these are scored and ordered."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        names = ["qid", "key", "score"]
        if not len(asked) or not len(held):
            return pa.Table.from_arrays([asked.column("qid")[:0], held.column("key")[:0], pa.array([], pa.float64())], names)
        v, q = _matrix(held.column("vector")), _matrix(asked.column("query"))
        far_v, far_q = np.sqrt(_dots(v, v)), np.sqrt(_dots(q, q))
        unit = lambda x, norm: x / np.where(norm > 0, norm, 1)[:, None]
        uv, uq = unit(v, far_v).T, unit(q, far_q)
        cells, code = np.unique(held.column("cell").to_numpy(), return_inverse=True)
        listed = asked.column("cells").combine_chunks()
        wanted = np.zeros((len(q), len(cells)), bool)
        of = np.repeat(np.arange(len(q)), np.diff(listed.offsets.to_numpy()))
        flat = listed.flatten().to_numpy()
        at = np.minimum(np.searchsorted(cells, flat), len(cells) - 1)
        there = cells[at] == flat  # a hash may leave a part without some cell's vectors
        wanted[of[there], at[there]] = True
        kth = asked.column("kth").to_numpy()  # null: not a number
        found = []
        for lo in range(0, len(q), STRIP):
            near = uq[lo : lo + STRIP] @ uv
            near[~wanted[lo : lo + STRIP][:, code]] = -np.inf
            least = np.fmax(np.partition(near, -n, axis=1)[:, -n] if len(v) > n else np.full(len(near), -np.inf), kth[lo : lo + STRIP])
            i, j = np.nonzero((near >= least[:, None] - 1e-9) & (near > -np.inf))
            dot, norm = np.empty(len(i)), far_v[j] * far_q[lo + i]
            for k in range(0, len(i), 1 << 16):
                dot[k : k + (1 << 16)] = _dots(v[j[k : k + (1 << 16)]], q[lo + i[k : k + (1 << 16)]])
            score = np.where(norm > 0, dot / np.where(norm > 0, norm, 1), 0.0)
            rows = pa.table({"q": lo + i, "key": held.column("key").take(pa.array(j)), "score": score}).sort_by([("q", "ascending"), ("score", "descending"), ("key", "ascending")])
            first = np.searchsorted(rows.column("q").to_numpy(), rows.column("q").to_numpy())
            found.append(rows.take(pa.array(np.flatnonzero(np.arange(len(rows)) - first < n))))
        out = pa.concat_tables(found)
        return pa.Table.from_arrays([asked.column("qid").take(out.column("q")), out.column("key"), out.column("score")], names)

    return run


def _words(text: str) -> Iterator[list[str]]:
    """The words of a text, listed for a stretch of it at a time."""
    lo = 0
    while lo < len(text):
        gap = _GAP.search(text, lo + STRETCH)
        hi = gap.start() if gap else len(text)
        yield _WORD.findall(text, lo, hi)
        lo = hi


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = sum(len(w) for i in range(len(batch)) for w in _words(batch.column("text")[i].as_py()))
        yield pa.record_batch([pa.array([len(batch)], pa.int64()), pa.array([words], pa.int64())], ["docs", "words"])


def _inverted(words: list[pa.Array], keys: list[pa.Array], sizes: list[int], mean: float, block: int) -> Iterator[pa.RecordBatch]:
    """Postings of a segment: of texts with these keys and numbers of words, whose words follow each other."""
    if not any(map(len, words)):
        return
    listed = pa.concat_arrays(words).dictionary_encode()
    vocabulary = listed.dictionary
    order = pc.sort_indices(vocabulary).to_numpy()
    code = np.empty(len(order), np.int32)
    code[order] = np.arange(len(order), dtype=np.int32)
    n = np.array(sizes, np.int32)
    term = code[listed.indices.to_numpy()]
    doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
    place = (np.arange(len(term)) - np.repeat(np.cumsum(n, dtype=np.int64) - n, n)).astype(np.int32)
    at = np.argsort(term, kind="stable")  # by term, text and place
    term, doc, place = term[at], doc[at], place[at]
    first = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])))
    places = pa.ListArray.from_arrays(pa.array(np.append(first, len(term)), pa.int32()), pa.array(place))
    term, doc = term[first], doc[first]
    impact = TextIndex.impact(np.diff(np.append(first, len(place))), n[doc], mean)
    at = np.lexsort((-impact, term))
    term, impact = term[at], impact[at]
    entries = [pa.concat_arrays(keys).take(pa.array(doc[at])), pa.array(n[doc[at]]), places.take(pa.array(at))]
    rank = np.arange(len(term)) - np.searchsorted(term, term)
    head = np.flatnonzero(rank % block == 0)
    lists = pa.ListArray.from_arrays(pa.array(np.append(head, len(term)), pa.int32()), pa.StructArray.from_arrays(entries, ["key", "n", "places"]))
    out = pa.record_batch([vocabulary.take(pa.array(order[term[head]])), pa.array((rank[head] // block).astype(np.int32)), pa.array(impact[head]), lists], ["term", "block", "best", "entries"])
    for lo in range(0, len(out), ROWS):
        yield out.slice(lo, ROWS)


def _segments(mean: float, block: int, most: int):
    """Postings of a task's texts, a segment of about most words after another, of fewer where words are long or texts short; a text lies in one segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, keys, sizes, held = [], [], [], 0
        for batch in batches:
            since = 0
            for i in range(len(batch)):
                text = batch.column("text")[i].as_py()
                said = [pa.array(w, pa.string()) for w in _words(text)]
                words += said
                sizes.append(sum(map(len, said)))
                held += max(sizes[-1], len(text) // LETTERS, LIGHTEST)
                if held >= most:
                    yield from _inverted(words, [*keys, batch.column("key").slice(since, i + 1 - since)], sizes, mean, block)
                    words, keys, sizes, held, since = [], [], [], 0, i + 1
            keys.append(batch.column("key").slice(since))
        yield from _inverted(words, keys, sizes, mean, block)

    return run


class TextIndex:
    """Words with their places in texts, by segments of neighbouring texts, so that no posting moves when they are built. path holds postings (term, block,
    best, entries: key, n, places; of each segment a term's entries by falling impact, BLOCK to a block, best being the largest), terms (term, docs, best)
    and a row of figures (docs, mean).

    A word is a run of letters and digits, in lower case; its impact in a text is its BM25 score there without the word's rarity. Keys tell texts apart; null
    texts count as empty."""

    def __init__(self, spark: SparkSession, path: str):
        self.postings, self.terms = spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/terms")
        self.docs, self.mean = spark.read.parquet(f"{path}/figures").first()

    @classmethod
    def build(cls, texts: DataFrame, key: str, text: str, path: str, block: int = BLOCK, segment: int = SEGMENT) -> TextIndex:
        """Texts are read twice: impacts need the mean number of words, and it is cheaper to count words twice than to move their places."""
        spark = texts.sparkSession
        rows = texts.select(F.col(key).alias("key"), F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text"))
        count = rows.select("text").mapInArrow(_counted, "docs long, words long").agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("words"), F.lit(0)).alias("words"))
        count.select("docs", (F.col("words") / F.when(F.col("docs") > 0, F.col("docs"))).alias("mean")).write.mode("overwrite").parquet(f"{path}/figures")  # one row
        _, mean = spark.read.parquet(f"{path}/figures").first()
        entry = T.StructType([rows.schema["key"], T.StructField("n", T.IntegerType()), T.StructField("places", T.ArrayType(T.IntegerType()))])
        schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("block", T.IntegerType()), T.StructField("best", T.DoubleType()), T.StructField("entries", T.ArrayType(entry))])
        placed = rows.mapInArrow(_segments(mean or 1.0, block, segment), schema)
        # a segment is sorted by term; of its small row groups and their pages, readers skip those that can't hold a term
        placed.write.mode("overwrite").option("parquet.block.size", 1 << 24).parquet(f"{path}/postings")
        stored = spark.read.schema(schema).parquet(f"{path}/postings")
        stored.groupBy("term").agg(F.sum(F.size("entries")).alias("docs"), F.max("best").alias("best")).repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/terms")
        return cls(spark, path)

    @staticmethod
    def impact(tf, n, mean: float):
        """Of columns or of arrays."""
        return tf * (K1 + 1) / (tf + K1 * (1 - B + B * n / mean))

    def _weighed(self, postings: DataFrame, first: int | None = None) -> DataFrame:
        """term, key, impact of all entries, or of the first ones of each block."""
        entries = F.slice("entries", 1, first) if first else F.col("entries")
        return postings.select("term", F.explode(entries).alias("e")).select("term", "e.key", self.impact(F.size("e.places"), F.col("e.n"), self.mean or 1.0).alias("impact"))

    def top(self, terms: list[str], n: int = POOL) -> DataFrame:
        """key, score of the n texts with the best BM25 scores of the terms, ties by lesser key.

        The n-th best impact of any one term bounds the n-th best score from below. Terms whose best scores together stay below that bound can't bring a
        text in by themselves, so candidates come from the other terms alone, and of these only from blocks whose best score, with the best of all
        other terms, reaches the bound. The candidates' scores are then summed over all terms."""
        terms = list(dict.fromkeys(t.lower() for t in terms))
        found = {r["term"]: r for r in self.terms.where(F.col("term").isin(terms)).collect()}  # as many rows as terms are asked for
        idf = {t: float(np.log(1 + (self.docs - r["docs"] + 0.5) / (r["docs"] + 0.5))) for t, r in found.items()}
        best = {t: idf[t] * found[t]["best"] for t in found}
        if not found:
            return self.postings.select(F.explode("entries").alias("e")).select("e.key", F.lit(0.0).alias("score")).limit(0)
        mine = self.postings.where(F.col("term").isin(list(found)))
        place = F.row_number().over(Window.partitionBy("term").orderBy(F.desc("impact")))
        heads = self._weighed(mine.where("block = 0"), n).withColumn("place", place).where(F.col("place") <= n).where(F.col("place") == n).collect()  # one row a term
        bound = max((r["impact"] * idf[r["term"]] for r in heads), default=0.0) * (1 - 1e-9)
        weak, total = set(), 0.0
        for t in sorted(found, key=best.get):
            total += best[t]
            if total >= bound:
                break
            weak.add(t)
        strong = [t for t in found if t not in weak]
        rare = F.create_map(*(F.lit(x) for t in found for x in (t, idf[t])))
        whole = sum(best.values())
        least = F.create_map(*(F.lit(x) for t in strong for x in (t, (bound - (whole - best[t])) / idf[t] * (1 - 1e-9) if idf[t] > 0 else 0.0)))
        candidates = self._weighed(mine.where(F.col("term").isin(strong)).where(F.col("best") >= least[F.col("term")])).select("key").distinct()
        scores = self._weighed(mine).join(candidates, "key", "left_semi").groupBy("key", "term").agg(F.max(rare[F.col("term")] * F.col("impact")).alias("s"))
        # summed in the order of the terms, so that equal texts have equal scores
        parts = scores.groupBy("key").pivot("term", list(found)).agg(F.max("s")).na.fill(0.0)
        score = functools.reduce(Column.__add__, (F.col(f"`{t}`") for t in terms if t in found), F.lit(0.0))
        return parts.select("key", score.alias("score")).where("score > 0").orderBy(F.desc("score"), "key").limit(n)

    def phrase(self, said: str) -> DataFrame:
        """key, n of the texts that hold a phrase, and how often: words that follow each other, "*" standing for any one word, and word* for any word that
        begins so. Places are intersected; a phrase without words is held nowhere."""
        pieces = re.findall(r"[^\W_]+\*?|\*", said.lower())
        asked = [(i, p) for i, p in enumerate(pieces) if p != "*"]
        if not asked:
            return self.postings.select(F.explode("entries").alias("e")).select("e.key", F.lit(0).cast("long").alias("n")).limit(0)
        fits = lambda p: F.startswith("term", F.lit(p[:-1])) if p.endswith("*") else F.col("term") == p
        mine = self.postings.where(functools.reduce(Column.__or__, (fits(p) for _, p in asked)))
        rows = mine.select("term", F.explode("entries").alias("e")).select("term", "e.key", "e.n", "e.places")
        begins = lambda i, p: F.flatten(F.collect_list(F.when(fits(p), F.transform("places", lambda x: x - i)))).alias(f"p{i}")
        placed = rows.groupBy("key", "n").agg(*(begins(i, p) for i, p in asked))
        common = functools.reduce(F.array_intersect, (F.col(f"p{i}") for i, _ in asked))
        inside = F.filter(F.array_distinct(common), lambda x: (x >= 0) & (x + len(pieces) <= F.col("n")))
        return placed.select("key", F.size(inside).cast("long").alias("n")).where("n > 0")
