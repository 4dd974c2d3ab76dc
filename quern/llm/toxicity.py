"""Toxicity by multiple-instance learning.

Only documents are labelled, yet it is sentences that offend. A sentence scores by a logistic model over hashed words and word beginnings;
a document scores by noisy-or over its sentences, and the model is trained through the noisy-or from document labels. Sentences without any
feature that the model knows score 0, so a long clean text gathers no toxicity from its length. High-scoring sentences are located.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import CHUNK, TO_LOWER, Fingerprints, chunks, in_batches, stretches, table, utf8, words
from quern.llm.labelled import remainder, sample

#: Documents of each class in the training sample, features kept, and least documents and lift of a feature.
PER_CLASS, FEATURES, LEAST_DOCS, LIFT = 3000, 4096, 6, 8.0
#: Bytes of the word beginnings that are features besides whole words.
BEGINNINGS = (4, 5, 6)
LETTERS = np.ones(256, bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
STOPS = np.zeros(256, bool)
STOPS[[*b".!?\n\r"]] = True


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature, its row, its sentence (numbered through all rows) and its word's first byte."""
    low = TO_LOWER[buf]
    s, e, row = words(low, offs, LETTERS)
    if not len(s):
        return np.zeros(0, np.uint64), row, row, s
    prints = Fingerprints(low, 11)
    sentence = np.cumsum(STOPS[low])[s] + row  # a row's end is a stop as well
    got, place = [prints.of(s, e)], [np.arange(len(s))]
    for n in BEGINNINGS:
        longer = np.flatnonzero(e - s > n)
        got.append(prints.of(s[longer], s[longer] + n) + np.uint64(n))
        place.append(longer)
    place = np.concatenate(place)
    return np.concatenate(got), row[place], sentence[place], s[place]


class Model:
    """Known features in ascending order, their weights, and the bias of a sentence."""

    def __init__(self, known: np.ndarray, weights: np.ndarray | None = None, bias: float = -4.0):
        self.known, self.weights, self.bias = known, np.zeros(len(known)) if weights is None else weights, bias

    def instances(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (sentence, feature) pairs by sentence: sentence, its row, index of the feature, a byte of the sentence. A long text goes
        by stretches that end between words; a sentence may go on in the next one."""
        if len(offs) > 2 or len(buf) <= 2 * CHUNK:
            return self._once(*self._known(*features(buf, offs)))
        found, stops = [(np.zeros(0, np.int64),) * 4], 0
        for lo, hi in stretches(buf, 0, len(buf), LETTERS):
            sentence, row, i, at = self._once(*self._known(*features(buf[lo:hi], np.array([0, hi - lo]))))
            found.append((sentence + stops, row, i, at + lo))
            stops += int(np.count_nonzero(STOPS[buf[lo:hi]]))
        return self._once(*(np.concatenate(x) for x in zip(*found, strict=True)))

    def _known(self, f, row, sentence, at):
        if not len(self.known) or not len(f):
            return (np.zeros(0, np.int64),) * 4
        i = np.minimum(np.searchsorted(self.known, f), len(self.known) - 1)
        hit = np.flatnonzero(self.known[i] == f)
        return sentence[hit], row[hit], i[hit], at[hit]

    def _once(self, sentence, row, i, at):
        _, first = np.unique(sentence * np.int64(max(1, len(self.known))) + i, return_index=True)
        return sentence[first], row[first], i[first], at[first]

    def sentences(self, buf, offs):
        """Row, a byte and probability of each sentence with known features."""
        sentence, row, i, at = self.instances(buf, offs)
        if not len(sentence):
            return row, at, np.zeros(0)
        first = np.flatnonzero(np.append(True, sentence[1:] != sentence[:-1]))
        z = np.add.reduceat(self.weights[i], first) + self.bias
        return row[first], at[first], 1 / (1 + np.exp(-z))

    def train(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, steps: int = 400, rate: float = 0.1, decay: float = 3e-4) -> None:
        """rows: of each document, the sentence number and feature of its pairs. Gradient descent (Adam) on the noisy-or's log-loss; classes weigh alike."""
        n, base = len(rows), 0
        sent, feat, doc_of = [], [], []
        for d, (s, f) in enumerate(rows):
            own, s = np.unique(s, return_inverse=True)
            sent.append(s + base)
            feat.append(f)
            doc_of.append(np.full(len(own), d))
            base += len(own)
        if not base or not 0 < y.sum() < n:
            return
        sent, feat, doc_of = np.concatenate(sent), np.concatenate(feat), np.concatenate(doc_of)
        cost = np.where(y == 1, 0.5 / y.sum(), 0.5 / (n - y.sum()))
        theta = np.append(self.weights, self.bias)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for t in range(1, steps + 1):
            z = np.bincount(sent, theta[feat], base) + theta[-1]
            p = 1 / (1 + np.exp(-z))
            total = np.bincount(doc_of, np.logaddexp(0, z), n)  # minus the log of the chance that no sentence offends
            slope = np.where(y == 1, -1 / np.maximum(np.expm1(total), 1e-6), 1.0) * cost
            dz = slope[doc_of] * p
            g = np.append(np.bincount(feat, dz[sent], len(self.weights)), dz.sum()) + decay * np.append(theta[:-1], 0)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-10)
        self.weights, self.bias = theta[:-1], float(theta[-1])


def _present(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and rows, each pair once, by feature."""
    found = []
    for lo, hi in stretches(buf, 0, len(buf), LETTERS) if len(offs) == 2 else [(0, len(buf))]:
        f, row, _, _ = features(buf[lo:hi], offs if len(offs) > 2 else np.array([0, hi - lo]))
        order = np.lexsort((row, f))
        f, row = f[order], row[order]
        once = np.append(True, (f[1:] != f[:-1]) | (row[1:] != row[:-1])) if len(f) else np.zeros(0, bool)
        found.append((f[once], row[once]))
    if len(found) == 1:
        return found[0]
    f = np.unique(np.concatenate([f for f, _ in found])) if found else np.zeros(0, np.uint64)
    return f, np.zeros(len(f), np.int64)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class with each feature, counted within the batch."""
    for batch in batches:
        buf, offs = utf8(batch.column("text"))
        y = batch.column("y").to_numpy()
        for i, j in chunks(offs):
            f, row = _present(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            own = y[i:j][row]
            first = np.flatnonzero(np.append(True, f[1:] != f[:-1])) if len(f) else np.zeros(0, np.int64)
            ones = np.add.reduceat(own, first) if len(f) else first
            both = np.diff(np.append(first, len(f)))
            yield pa.record_batch([f[first].view(np.int64), ones.astype(np.int64), (both - ones).astype(np.int64)], ["f", "ones", "zeros"])


def _pairs(known: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(known)
        for batch in batches:
            buf, offs = utf8(batch.column("text"))
            for i, j in chunks(offs):
                sentence, row, feat, _ = model.instances(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                cuts = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x, pa.int64())) for x in (sentence, feat)]
                yield pa.record_batch([batch.column("y")[i:j], *lists], ["y", "sentences", "features"])

    return run


def trained(docs: DataFrame, labels: DataFrame, label: str, where, per_class: int = PER_CLASS) -> Model:
    """A model from at most per_class documents of each class. What comes to the driver is bounded by it and FEATURES."""
    rows = sample(docs, labels, label, where, per_class)
    sizes = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    counts = in_batches(rows).mapInArrow(_gathered, "f long, ones long, zeros long").groupBy("f").agg(F.sum("ones").alias("a"), F.sum("zeros").alias("b"))
    lift = (F.col("a") / n1) / ((F.col("b") + 0.5) / n0)
    best = counts.where((F.col("a") >= LEAST_DOCS) & (lift >= LIFT)).orderBy(F.desc(F.col("a") * F.log(lift)), "f").limit(FEATURES)
    known = np.sort(np.array([r.f for r in best.select("f").collect()], np.int64).view(np.uint64))
    model = Model(known)
    got = in_batches(rows).mapInArrow(_pairs(known), "y int, sentences array<long>, features array<long>").collect()
    order = sorted(got, key=lambda r: (r.y, r.sentences, r.features))  # not by task, so that the model is the same each time
    model.train([(np.array(r.sentences, np.int64), np.array(r.features, np.int64)) for r in order], np.array([r.y for r in order], np.int64))
    return model


def _keep(shared, threshold: float):
    """Batches without the rows that score threshold or more, all columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            buf, offs = utf8(batch.column("text"))
            for i, j in chunks(offs):
                row, _, p = model.sentences(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                score = -np.expm1(np.bincount(row, np.log1p(-np.minimum(p, 1 - 1e-12)), j - i))
                yield batch.slice(i, j - i).filter(pa.array(score < threshold))

    return run


def kept(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows of docs (with a column text) whose texts score less than threshold, with all their columns, whatever their names; null and empty
    texts, and texts without known features, score 0 and stay. Rows are judged one by one, so repeated rows, repeated ids and null ids stay or
    go by their texts alone. An empty table gives an empty result; long texts count whole and are read by stretches."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return in_batches(docs).mapInArrow(_keep(shared, threshold), docs.schema)


def _score(shared, offending: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            buf, offs = utf8(batch.column("text"))
            for i, j in chunks(offs):
                b, o = buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                row, at, p = model.sentences(b, o)
                score = -np.expm1(np.bincount(row, np.log1p(-np.minimum(p, 1 - 1e-12)), j - i))
                found = [[] for _ in range(j - i)]
                bad = np.flatnonzero(p >= offending)
                stops = np.flatnonzero(STOPS[b]) if len(bad) else bad
                for k in bad.tolist():
                    r, here = int(row[k]), int(at[k])
                    next_ = int(np.searchsorted(stops, here))
                    start = max(int(o[r]), int(stops[next_ - 1]) + 1 if next_ else 0)
                    end = min(int(o[r + 1]), int(stops[next_]) if next_ < len(stops) else len(b))
                    found[r].append({"start": start - int(o[r]), "end": end - int(o[r]), "score": float(p[k])})
                yield pa.record_batch([batch.column("doc_id")[i:j], pa.array(np.clip(score, 0, 1) + 0.0), pa.array(found, span)], ["doc_id", "score", "offending"])

    return run


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", offending: float = 0.5) -> DataFrame:
    """doc_id, score (0 to 1) and the offending sentences (byte spans and their scores) of each row.

    Null or empty texts, and texts without known features, score 0. Rows with null or repeated ids are scored like others; further columns are
    ignored; whole texts count, sentence by sentence; an empty table gives an empty result. A model without labelled rows scores 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return in_batches(rows).mapInArrow(_score(shared, offending), "doc_id long, score double, offending array<struct<start:int,end:int,score:double>>")


def judged(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted, n_offending (sentences) of each row, by a model trained on the labels outside one fold of crc32(doc_id).

    Rows with null ids are scored and not held out; rows that repeat, and null, empty and long texts, as scored() has it; a score equal to the threshold is
    predicted 1. Labels of unknown or null ids count for nothing. An empty table gives an empty result; without labelled rows all score 0."""
    model = trained(docs, labels, "toxic", remainder("doc_id", folds) != fold)
    out = scored(docs, model)
    return out.select("doc_id", F.coalesce(remainder("doc_id", folds) == fold, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
