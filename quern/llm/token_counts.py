"""Token counts by a map-side two-tier lookup.

A compact table of frequent pre-tokens and their numbers of tokens is broadcast; what it misses is encoded once for each worker and kept
in a cache of bounded size. No pre-token is ever shuffled. The frequent table comes from all texts: each task counts its words in a table of
bounded size and passes on those that make up at least a SHARE of its words, so what meets is a short list from each task. The table changes
no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.bpe import PATTERN, lists, vocabulary
from quern.llm.common import Fingerprints, chunks, in_batches, stretches, table, utf8

#: Rows of the broadcast table, part of a task's words that makes one frequent there, words that a task counts at once, pre-tokens in a
#: worker's cache and the longest of them, pre-tokens looked up at once.
FREQUENT, SHARE, COUNTED, CACHE, CACHED_LENGTH, LOOKED_UP = 32_768, 1 / 65_536, 1 << 18, 400_000, 64, 1 << 18
#: Kinds of bytes: blanks, letters (and whatever isn't ASCII), digits, others.
KIND = np.full(256, 3, np.int8)
KIND[[*range(9, 14), 32]] = 0
KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
KIND[48:58] = 2
BLANK = KIND == 0


class Counts:
    """Numbers of tokens of whole texts by one tokenizer file."""

    def __init__(self, path: str, frequent: dict[str, int] | None = None):
        self.frequent = frequent or {}
        self.cached: dict[str, int] = dict(self.frequent)
        self.pieces = self.cut = self.sp = None
        if path.endswith(".model"):
            import sentencepiece

            self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        import json

        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer") and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
            self.pieces = regex.compile(PATTERN).findall
            self.cut = regex.compile("|".join(regex.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"])))) if added else None

    def lengths(self, texts: list[str]) -> list[int]:
        """Numbers of tokens by the library itself, without the offsets that its other call works out."""
        return list(map(len, self.tok.encode_batch_fast(texts, add_special_tokens=False)))

    def words(self, text: str) -> Iterator[list[str] | int]:
        """Lists of pre-tokens of a text, and 1 for each special string."""
        parts = self.cut.split(text) if self.cut and self.cut.search(text) else [text]
        for k, part in enumerate(parts):
            if k:
                yield 1
            yield from lists(self.pieces, part)

    def of(self, texts: list[str]) -> list[int]:
        if self.sp:
            return [len(x) for x in self.sp.encode(texts, num_threads=1)]
        if not self.pieces:
            return self.lengths(texts)
        total, held, size = [0] * len(texts), [], 0
        for i, text in enumerate(texts):
            for words in self.words(text):
                if isinstance(words, int):
                    total[i] += words
                    continue
                held.append((i, words))
                size += len(words)
                if size > LOOKED_UP:
                    self._add(held, total)
                    held, size = [], 0
        self._add(held, total)
        return total

    def _add(self, held: list[tuple[int, list[str]]], total: list[int]) -> None:
        needed = set().union(*(w for _, w in held))
        if len(self.cached) + len(needed) > CACHE + len(self.frequent):
            self.cached = dict(self.frequent)
        missed = list(needed.difference(self.cached))
        for i in range(0, len(missed), 20_000):
            part = missed[i : i + 20_000]
            self.cached.update(zip(part, self.lengths(part), strict=True))
        for i, words in held:
            total[i] += sum(map(self.cached.__getitem__, words))
        for w in missed:  # long ones hardly recur, so the cache is bounded in bytes, too
            if len(w) > CACHED_LENGTH:
                del self.cached[w]


class _Table:
    """Words and their numbers, the rarer half of which goes whenever there are more than COUNTED of them."""

    def __init__(self):
        self.counts: dict[bytes, int] = {}
        self.all = 0

    def add(self, buf: np.ndarray, offs: np.ndarray) -> None:
        """Runs of bytes of a kind count as words, each with the blank before it."""
        kind, heads = KIND[buf], np.zeros(len(buf) + 1, bool)
        heads[offs] = True
        s = np.flatnonzero(np.append(True, kind[1:] != kind[:-1]) | heads[:-1]) if len(buf) else np.zeros(0, np.int64)
        e = np.append(s[1:], len(buf))
        word = kind[s] > 0
        s, e = s[word], e[word]
        s = s - ((s > 0) & (buf[s - 1] == 32) & ~heads[s])
        short = e - s <= CACHED_LENGTH
        s, e = s[short], e[short]
        if not len(s):
            return
        self.all += len(s)
        _, first, n = np.unique(Fingerprints(buf, 71).of(s, e), return_index=True, return_counts=True)
        raw, counts = buf.tobytes(), self.counts
        for a, b, c in zip(s[first].tolist(), e[first].tolist(), n.tolist(), strict=True):
            w = raw[a:b]
            counts[w] = counts.get(w, 0) + c
        if len(counts) > COUNTED:
            self.counts = dict(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: COUNTED // 2])


def _heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frequent words of a task and their numbers."""
    found = _Table()
    for batch in batches:
        buf, offs = utf8(batch.column("text"))
        for i, j in chunks(offs):
            if j - i > 1:
                found.add(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            else:
                for lo, hi in stretches(buf, int(offs[i]), int(offs[j]), BLANK):
                    found.add(buf[lo:hi], np.array([0, hi - lo]))
    often = {w: n for w, n in found.counts.items() if n >= max(2, SHARE * found.all)}
    yield pa.record_batch([pa.array(list(often), pa.binary()), pa.array(list(often.values()), pa.int64())], ["word", "n"])


def frequent_words(docs: DataFrame, path: str, text_col: str = "text") -> dict[str, int]:
    """The FREQUENT most common words of all texts that are pre-tokens, with their numbers of tokens. At most FREQUENT rows come to the driver."""
    counts = Counts(path)
    if not counts.pieces:
        return {}
    rows = in_batches(docs.select(F.col(text_col).cast("string").alias("text"))).mapInArrow(_heavy, "word binary, n long")
    best = rows.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").collect()
    words = [w for r in best if counts.pieces(w := bytes(r.word).decode("utf-8", "replace")) == [w]]
    return dict(zip(words, counts.lengths(words), strict=True))


_loaded: dict[str, Counts] = {}


def _count(path: str, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counts = _loaded.get(path)
        if counts is None or counts.frequent != frequent.value:
            counts = _loaded[path] = Counts(path, frequent.value)
        for batch in batches:
            _, offs = utf8(batch.column("text"))
            for i, j in chunks(offs):
                n = counts.of(["" if t is None else t for t in batch.column("text")[i:j].to_pylist()])
                yield pa.record_batch([batch.column("doc_id")[i:j], batch.column("n_bytes")[i:j], pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of each row.

    path: a file of the tokenizers (.json) or sentencepiece (.model) library that every executor can read; no begin, end or added special
    tokens, padding or truncation. Null text counts as empty: 0 bytes and tokens. Null and repeated ids stay; further columns are ignored; an
    empty table gives an empty result; whole texts count, long ones in pieces that end where pre-tokens do. Files other than byte-level BPE are counted text by text.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_words(rows, path))
    rows = rows.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    counted = in_batches(rows).mapInArrow(_count(path, frequent), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary())
