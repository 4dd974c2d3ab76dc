"""URL filters: rules by host and path, and for other URLs a ratio of character language models.

Two variable-order Markov models, of accepted and of rejected URLs, each smooth their estimates from the longest context down (Witten-Bell
interpolation). A URL's score is the difference of the two log-likelihoods divided by its length; the threshold is calibrated on URLs that
the models haven't seen. The rules label the URLs from which the models learn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import A_TO_Z, LOWER, Fingerprints, chunks, in_batches, table, utf8, written

#: Host, path and verdict of the rules that op6 applies; fixed values.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: Longest context in bytes; rows of the model tables up to which they are broadcast (larger ones are joined); scores are calibrated in such steps.
ORDER, BROADCAST_ROWS, STEP = 5, 1 << 20, 1e-3


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; path: then up to "?", "#" or the end. Else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, A_TO_Z, LOWER), path


def ruled(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Adds host, path, rule (host and path of the longest rule that fits, else null) and ruling (its verdict, else null)."""
    host, path = host_and_path(F.col("url"))
    out = urls.withColumns({"host": host, "path": path})
    rule = ruling = F.lit(None).cast("string")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the longest is asked first
        fits = ((F.col("host") == h) | F.endswith(F.col("host"), F.lit("." + h))) & F.startswith(F.col("path"), F.lit(p))
        rule, ruling = F.when(fits, h + p).otherwise(rule), F.when(fits, verdict).otherwise(ruling)
    return out.withColumns({"rule": rule, "ruling": ruling})


class Markov:
    """Counts of all contexts up to ORDER bytes and of the bytes that follow, as sorted fingerprints."""

    def __init__(self, urls: list[bytes]):
        grams, contexts = [], []
        buf, offs = _joined(urls)
        for n in range(ORDER + 1):
            gram, context = _slices(buf, offs, n)
            grams.append(gram)
            contexts.append(context)
        self.grams, self.gram_counts = np.unique(np.concatenate(grams), return_counts=True)
        pairs = np.unique(np.stack([np.concatenate(contexts), np.concatenate(grams)]), axis=1)
        self.contexts, self.kinds = np.unique(pairs[0], return_counts=True)
        _, self.context_counts = np.unique(np.concatenate(contexts), return_counts=True)

    @classmethod
    def of(cls, grams: tuple[np.ndarray, np.ndarray], contexts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Markov:
        """From sorted fingerprints and their counts."""
        out = cls([])
        (out.grams, out.gram_counts), (out.contexts, out.context_counts, out.kinds) = grams, contexts
        return out

    @staticmethod
    def _found(keys, values, wanted):
        if not len(keys):
            return np.zeros(len(wanted))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], 0).astype(float)

    def log(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Log-probability of each byte, and of each end."""
        p = np.full(len(buf), 1 / 256)
        for n in range(ORDER + 1):
            gram, context = _slices(buf, offs, n)
            c, total, kinds = self._found(self.grams, self.gram_counts, gram), self._found(self.contexts, self.context_counts, context), self._found(self.contexts, self.kinds, context)
            p = np.where(total > 0, (c + kinds * p) / np.maximum(total + kinds, 1), p)
        return np.log(p)


def _joined(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    buf = np.frombuffer(b"".join(u + b"\n" for u in urls), np.uint8)
    sizes = np.array([len(u) + 1 for u in urls], np.int64)
    return buf, np.concatenate([[0], np.cumsum(sizes)])


def _slices(buf: np.ndarray, offs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of each byte with n bytes before it, and of these n alone; before its start a URL has fewer, which counts as a context too."""
    prints = Fingerprints(buf, 31)
    at = np.arange(len(buf))
    start = np.maximum(np.repeat(offs[:-1], np.diff(offs)), at - n)
    size = (at - start).astype(np.uint64) | np.uint64(n << 8)
    return prints.of(start, at + 1) + size, prints.of(start, at) ^ (size << np.uint64(32))


def calibrated(scores: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The threshold that keeps most of the good and catches most of the bad, of which each score has so many."""
    values, at = np.unique(scores, return_inverse=True)
    good, bad = (np.bincount(at, x, len(values)) for x in (good, bad))
    cuts = np.concatenate([values[:1] - 1e-9, (values[1:] + values[:-1]) / 2, values[-1:] + 1e-9])
    kept = 1 - np.append(0, np.cumsum(good)) / good.sum()
    caught = np.append(0, np.cumsum(bad)) / bad.sum()
    return float(np.median(cuts[kept + caught >= (kept + caught).max() - 1e-12]))


class Ratio:
    """Models of accepted and rejected URLs and the calibrated threshold; with URLs of one kind only, every score is 0 and allowed."""

    def __init__(self, accepted: list[bytes], rejected: list[bytes]):
        self.models, self.threshold = None, 0.0
        if not accepted or not rejected:
            return
        folds = [[u for i, u in enumerate(x) if (i % 4 == 3) == held] for x in (accepted, rejected) for held in (False, True)]
        self.models = Markov(folds[0] or accepted), Markov(folds[2] or rejected)
        good, bad = self.scores(folds[1] or accepted), self.scores(folds[3] or rejected)
        self.threshold = calibrated(np.concatenate([good, bad]), np.repeat([1, 0], [len(good), len(bad)]), np.repeat([0, 1], [len(good), len(bad)]))

    def scores(self, urls: list[bytes]) -> np.ndarray:
        if self.models is None or not urls:
            return np.zeros(len(urls))
        buf, offs = _joined(urls)
        a, b = (m.log(buf, offs) for m in self.models)
        return np.add.reduceat(a - b, offs[:-1]) / np.diff(offs)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio: Ratio = shared.value
        for batch in batches:
            urls = ["" if u is None else u for u in batch.column("url").to_pylist()]
            _, offs = utf8(batch.column("url"))
            score = [ratio.scores([u.encode() for u in urls[i:j]]) for i, j in chunks(offs)]
            yield pa.record_batch([*batch.columns, pa.array(np.concatenate(score) if score else np.zeros(0))], [*batch.schema.names, "score"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """gram, context, a and b: how often accepted and rejected URLs have it, added up by chunks."""
    for batch in batches:
        urls, good = ["" if u is None else u for u in batch.column("url").to_pylist()], np.array(batch.column("good").to_pylist(), bool)
        for i, j in chunks(utf8(batch.column("url"))[1]):
            buf, offs = _joined([u.encode() for u in urls[i:j]])
            own = np.repeat(good[i:j], np.diff(offs))
            gram, context = (np.concatenate(x) for x in zip(*(_slices(buf, offs, n) for n in range(ORDER + 1)), strict=True))
            grams, first, at = np.unique(gram, return_index=True, return_inverse=True)
            n = [np.bincount(at, np.tile(x, ORDER + 1), len(grams)).astype(np.int64) for x in (own, ~own)]
            yield pa.record_batch([pa.array(x) for x in (grams.view(np.int64), context[first].view(np.int64), *n)], ["gram", "context", "a", "b"])


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, at, n, gram and context of each byte of each URL."""
    for batch in batches:
        urls, keys = ["" if u is None else u for u in batch.column("url").to_pylist()], batch.column("key")
        for i, j in chunks(utf8(batch.column("url"))[1], 1 << 14):
            buf, offs = _joined([u.encode() for u in urls[i:j]])
            row = pa.array(np.repeat(np.arange(i, j), np.diff(offs)))
            for n in range(ORDER + 1):
                gram, context = _slices(buf, offs, n)
                columns = [keys.take(row), *(pa.array(x) for x in (np.arange(len(buf)), np.full(len(buf), n), gram.view(np.int64), context.view(np.int64)))]
                yield pa.record_batch(columns, ["key", "at", "n", "gram", "context"])


def _by_join(urls: DataFrame, grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """urls with their scores, by joins with the model tables."""
    key = F.md5(F.coalesce("url", F.lit("")))
    pieces = in_batches(urls.select(key.alias("key"), F.coalesce("url", F.lit("")).alias("url")).distinct()).mapInArrow(_sliced, "key string, at long, n long, gram long, context long")
    found = pieces.join(grams.drop("context"), "gram", "left").join(contexts, "context", "left").na.fill(0)
    steps = found.groupBy("key", "at").agg(F.array_sort(F.collect_list(F.struct("n", "a", "b", "ta", "tb", "ka", "kb"))).alias("s"))

    def p(m):
        step = lambda p, x: F.when(x["t" + m] > 0, (x[m] + x["k" + m] * p) / (x["t" + m] + x["k" + m])).otherwise(p)
        return F.log(F.aggregate("s", F.lit(1 / 256), step))

    scores = steps.select("key", (p("a") - p("b")).alias("d")).groupBy("key").agg(F.avg("d").alias("score"))
    return urls.withColumn("key", key).join(scores, "key").drop("key")


def _scorer(known: DataFrame):
    """From url and good of all ruled URLs: a function that adds score, and the threshold."""
    spark = known.sparkSession
    known = written(known.withColumn("held", F.pmod(F.xxhash64("url"), F.lit(4)) == 3), "urls")
    sizes = {(r.good, r.held): r["count"] for r in known.groupBy("good", "held").count().collect()}
    if len({good for good, _ in sizes}) < 2:
        return lambda urls: urls.withColumn("score", F.lit(0.0)), 0.0
    part = lambda held: F.expr(" OR ".join(f"(good = {g} AND {f'held = {held}' if (g, held) in sizes else 'true'})" for g in (True, False)))
    counted = in_batches(known.where(part(False)).select("url", "good")).mapInArrow(_counted, "gram long, context long, a long, b long")
    grams = written(counted.groupBy("gram", "context").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "grams")
    kinds = [F.count_if(F.col(m) > 0).alias("k" + m) for m in "ab"]
    contexts = written(grams.groupBy("context").agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"), *kinds), "contexts")
    if grams.count() <= BROADCAST_ROWS:  # contexts are never more
        g, c = ({n: np.asarray(x.column(n)) for n in x.column_names} for x in (grams.toArrow(), contexts.toArrow()))
        ratio = Ratio([], [])
        ratio.models = tuple(_model(g, c, m) for m in "ab")
        shared = spark.sparkContext.broadcast(ratio)
        add = lambda urls: in_batches(urls).mapInArrow(_score(shared), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema) + ", score double")
    else:
        add = lambda urls: _by_join(urls, grams, contexts)
    steps = add(known.where(part(True)).select("url", "good")).groupBy(F.round(F.col("score") / STEP).alias("s")).agg(F.count_if("good").alias("a"), F.count_if(~F.col("good")).alias("b")).collect()
    return add, calibrated(np.array([r.s * STEP for r in steps]), np.array([r.a for r in steps]), np.array([r.b for r in steps]))


def _model(g: dict, c: dict, m: str) -> Markov:
    def ordered(keys, *values):
        keys = keys.view(np.uint64)
        keep = values[0] > 0
        order = np.argsort(keys[keep])
        return tuple(x[keep][order] for x in (keys, *values))

    return Markov.of(ordered(g["gram"], g[m]), ordered(c["context"], c["t" + m], c["k" + m]))


def filtered(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, url, host, path, rule, verdict ("allow" or "block") and score of each row.

    rules: host, path, verdict. A rule fits its host and all subdomains if the path starts with its path; the longest wins; where none fits,
    the models decide: "allow" at the threshold or above. They learn from all different URLs with a ruling, of any length; a quarter of these, by
    hash, is left for the threshold.
    Null URLs, and URLs without "://", have an empty host and path; the models judge them as they are, null as empty. Repeated rows, null ids
    and further columns change nothing; an empty table gives an empty result.
    """
    urls = ruled(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")), rules)
    known = urls.where(F.col("ruling").isNotNull()).select("url", (F.col("ruling") == "allow").alias("good")).distinct()
    add, threshold = _scorer(known)
    scored = add(urls.select("page_id", "url", "host", "path", "rule", "ruling"))
    by_model = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select("page_id", "url", "host", "path", "rule", F.coalesce("ruling", by_model).alias("verdict"), "score")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")
