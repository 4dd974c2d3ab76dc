"""Quality by a factorisation machine.

Features are hashed words (a normalised bag), statistics of structure, and the text's length as its metadata. Besides a weight, each has a
short vector; products of vectors weigh pairs of features. The sum over all pairs is had in linear time, as half the square of the sum less
the sum of the squares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import CHUNK, SPACE, TO_LOWER, Fingerprints, chunks, in_batches, stretches, table, utf8, words
from quern.llm.labelled import remainder, sample

#: Buckets of hashed words, length of the vectors, documents of each class in the training sample.
BUCKETS, RANK, PER_CLASS = 1 << 14, 8, 2000
STATS = 18


def _class(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


UPPER, LOWER, DIGIT = _class(bytes(range(65, 91))), _class(bytes(range(97, 123))), _class(bytes(range(48, 58)))
SPACES, MARKS, ODD = _class(b" \t\r\n\x0b\x0c"), _class(b".,;:!?'\"()-"), _class(b"#$%&*|<>{}[]\\^_~=+@/`")
HIGH, SHOUT, LINE = _class(bytes(range(128, 256))), _class(b"!?"), _class(b"\n")
KINDS = (UPPER, LOWER, DIGIT, SPACES, MARKS, ODD, HIGH, SHOUT, LINE)


class _Words:
    """What a stretch of whole words says of its rows: counts, and its distinct words with how often they occur."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        n = len(offs) - 1
        low = TO_LOWER[buf]
        s, e, row = words(low, offs)
        self.count = np.bincount(row, minlength=n)
        self.sums = np.zeros((n, 5))  # of the words' lengths, of repeats of the word before, of three odd kinds of words
        self.prints = np.zeros(0, np.uint64)
        self.row, self.word, self.times = row, self.prints, np.zeros(0, np.int64)
        if not len(s):
            return
        self.prints = prints = Fingerprints(low, 21).of(s, e)
        again = (prints[1:] == prints[:-1]) & (row[1:] == row[:-1])
        shouted = (e - s > 2) & UPPER[buf[s]] & UPPER[buf[np.minimum(s + 1, len(buf) - 1)]]
        kinds = np.minimum(e - s, 40), np.append(False, again), ODD[buf[e - 1]], shouted, (e - s == 1) & ODD[buf[s]]
        for k, x in enumerate(kinds):
            self.sums[:, k] = np.bincount(row, x, n)
        order = np.lexsort((prints, row))
        row, prints = row[order], prints[order]
        at = np.flatnonzero(np.append(True, (prints[1:] != prints[:-1]) | (row[1:] != row[:-1])))
        self.row, self.word, self.times = row[at], prints[at], np.diff(np.append(at, len(order)))


def _tally(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each row the number of bytes of each kind and of words, their sums; and rows, words and numbers of the distinct words, by row. A long
    text goes by stretches that end behind a blank; what is held of all is a word's fingerprint and number."""
    n = len(offs) - 1
    kinds = np.zeros((n, 9))
    if n > 1 or len(buf) <= 2 * CHUNK:
        row_of = np.repeat(np.arange(n), np.diff(offs))
        for k, kind in enumerate(KINDS):
            kinds[:, k] = np.bincount(row_of[kind[buf]], minlength=n)
        w = _Words(buf, offs)
        return kinds, w.count, w.sums, w.row, w.word, w.times
    count, sums, last = np.zeros(1, np.int64), np.zeros((1, 5)), None
    word, times, held, more = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def merged():
        every = np.concatenate([word, *(h.word for h in held)])
        order = np.argsort(every)
        first = np.flatnonzero(np.append(True, every[order][1:] != every[order][:-1])) if len(every) else np.zeros(0, np.int64)
        total = np.concatenate([times, *(h.times for h in held)])[order]
        return every[order][first], np.add.reduceat(total, first) if len(first) else total

    for lo, hi in stretches(buf, 0, len(buf), SPACE):
        kinds += [[np.count_nonzero(kind[buf[lo:hi]]) for kind in KINDS]]
        w = _Words(buf[lo:hi], np.array([0, hi - lo]))
        count, sums = count + w.count, sums + w.sums
        if len(w.prints):
            sums[0, 1] += last is not None and w.prints[0] == last
            last = w.prints[-1]
        held.append(w)
        more += len(w.word)
        if more > max(len(word), CHUNK):
            word, times = merged()
            held, more = [], 0
    word, times = merged()
    return kinds, count, sums, np.zeros(len(word), np.int64), word, times


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, buckets and values of hashed words, by row; and a row of statistics for each text. Words that share a bucket add up, so a text has
    no more values than there are buckets, however long it is."""
    n = len(offs) - 1
    size = np.maximum(np.diff(offs), 1).astype(float)
    kinds, count, sums, r, f, times = _tally(buf, offs)
    many = np.maximum(count, 1)
    stats = np.zeros((n, STATS))
    stats[:, 0], stats[:, 1:10], stats[:, 10] = np.log1p(np.diff(offs)) / 10, kinds / size[:, None], np.log1p(count) / 10
    stats[:, 11:16] = sums / many[:, None]
    stats[:, 11] /= 10
    if not len(r):
        return r, np.zeros(0, np.int64), np.zeros(0), stats
    stats[:, 16] = np.bincount(r, minlength=n) / many
    stats[:, 17] = np.bincount(r, times.astype(float) ** 2, n) / many**2
    value = np.log1p(times)
    value /= np.sqrt(np.bincount(r, value**2, n))[r]
    key = r * BUCKETS + (f >> np.uint64(40)).astype(np.int64) % BUCKETS
    order = np.argsort(key, kind="stable")
    at = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    key = key[order][at]
    return key // BUCKETS, key % BUCKETS, np.add.reduceat(value[order], at), stats


class Machine:
    """Weights and vectors of the buckets, then of the statistics; statistics are standardised."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.bias, self.w = 0.0, np.zeros(BUCKETS + STATS)
        self.v = rng.normal(0, 0.01, (BUCKETS + STATS, RANK))
        self.mean, self.scale = np.zeros(STATS), np.ones(STATS)
        self.fit = False

    def joined(self, r, c, x, stats):
        """One sparse matrix of words and statistics, by row."""
        n = len(stats)
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        rows = np.concatenate([r, np.repeat(np.arange(n), STATS)])
        cols = np.concatenate([c, np.tile(np.arange(BUCKETS, BUCKETS + STATS), n)])
        vals = np.concatenate([x, z.ravel()])
        order = np.argsort(rows, kind="stable")
        return rows[order], cols[order], vals[order]

    def raw(self, rows, cols, vals, n):
        """Score before the logistic function, and the sums of vectors."""
        cuts = np.searchsorted(rows, np.arange(n))
        xv = self.v[cols] * vals[:, None]
        sums = np.add.reduceat(xv, cuts) if len(rows) else np.zeros((n, RANK))
        squares = np.add.reduceat((xv * xv).sum(1), cuts) if len(rows) else np.zeros(n)
        return self.bias + np.bincount(rows, self.w[cols] * vals, n) + 0.5 * ((sums * sums).sum(1) - squares), sums

    def score(self, r, c, x, stats):
        if not self.fit:
            return np.full(len(stats), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.raw(*self.joined(r, c, x, stats), len(stats))[0], -30, 30)))

    def train(self, docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], y: np.ndarray, prior: float, epochs: int = 12, batch: int = 128, rate: float = 0.02, decay: float = 1e-5) -> None:
        """docs: buckets, values, statistics. Adam on the log-loss, with classes weighed so that label 1 has the share prior."""
        n = len(docs)
        if not 0 < y.sum() < n:
            return
        stats = np.array([d[2] for d in docs])
        self.mean, self.scale = stats.mean(0), stats.std(0) + 1e-6
        cost = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
        rng = np.random.default_rng(2)
        state = [[np.zeros_like(p), np.zeros_like(p)] for p in (self.w, self.v)]
        t = 0
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(n), max(1, n // batch)):
                t += 1
                k = len(part)
                r = np.repeat(np.arange(k), [len(docs[i][0]) for i in part])
                rows, cols, vals = self.joined(r, np.concatenate([docs[i][0] for i in part]), np.concatenate([docs[i][1] for i in part]), stats[part])
                z, sums = self.raw(rows, cols, vals, k)
                g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) * cost[part] / k
                self.bias -= rate * g.sum()
                used, at = np.unique(cols, return_inverse=True)
                gx = g[rows] * vals
                gw = np.bincount(at, gx, len(used)) + decay * self.w[used]
                full = gx[:, None] * (sums[rows] - self.v[cols] * vals[:, None])
                gv = np.stack([np.bincount(at, full[:, f], len(used)) for f in range(RANK)], 1) + decay * self.v[used]
                for p, grad, (m, v) in ((self.w, gw, state[0]), (self.v, gv, state[1])):
                    m[used], v[used] = 0.9 * m[used] + 0.1 * grad, 0.99 * v[used] + 0.01 * grad * grad
                    p[used] -= rate * (m[used] / (1 - 0.9**t)) / (np.sqrt(v[used] / (1 - 0.99**t)) + 1e-8)
        self.fit = True


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offs = utf8(batch.column("text"))
        for i, j in chunks(offs):
            r, c, x, stats = features(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            cuts = pa.array(np.searchsorted(r, np.arange(j - i + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(c, pa.int32())), pa.ListArray.from_arrays(cuts, pa.array(x, pa.float64()))]
            wide = pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i + 1) * STATS, STATS, dtype=np.int32)), pa.array(stats.ravel()))
            yield pa.record_batch([batch.column("y")[i:j], *lists, wide], ["y", "cols", "vals", "stats"])


def trained(docs: DataFrame, labels: DataFrame, label: str, where, per_class: int = PER_CLASS) -> Machine:
    """A machine from at most per_class documents of each class; only their features come to the driver."""
    got = in_batches(sample(docs, labels, label, where, per_class)).mapInArrow(_extract, "y int, cols array<int>, vals array<double>, stats array<double>").collect()
    got.sort(key=lambda r: (r.y, r.stats, r.cols))
    machine = Machine()
    shares = {r.y: r.n for r in labels.where(where).groupBy(F.col(label).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    prior = shares.get(1, 0) / max(1, shares.get(0, 0) + shares.get(1, 0))
    machine.train([(np.array(r.cols, np.int64), np.array(r.vals), np.array(r.stats)) for r in got], np.array([r.y for r in got]), prior)
    return machine


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine: Machine = shared.value
        for batch in batches:
            buf, offs = utf8(batch.column("text"))
            for i, j in chunks(offs):
                score = machine.score(*features(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]))
                yield pa.record_batch([batch.column("doc_id")[i:j], pa.array(score)], ["doc_id", "score"])

    return run


def scored(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of each row.

    Null texts score as empty ones do; rows with null or repeated ids are scored like others; further columns are ignored; whole texts count;
    an empty table gives an empty result. A machine without labels of both classes scores 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return in_batches(rows).mapInArrow(_score(shared), "doc_id long, score double")


def judged(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of each row, by a machine trained on the labels outside one fold of crc32(doc_id).

    Rows with null ids are scored and not held out; rows that repeat, and null, empty and long texts, as scored() has it; a score equal to the threshold is
    predicted 1. Labels of unknown or null ids count for nothing. An empty table gives an empty result; without labels of both classes all score 0.5."""
    out = scored(docs, trained(docs, labels, "quality", remainder("doc_id", folds) != fold))
    return out.select("doc_id", F.coalesce(remainder("doc_id", folds) == fold, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
