"""Byte-level BPE encoding by speculation, and decoding.

For each new pre-token a greedy longest match over the vocabulary proposes tokens; a vectorised check tests every adjacent pair for
compatibility, that is, whether merging the two tokens' bytes alone gives back just these two; only pre-tokens with a failing pair are
merged exactly. Pre-tokens recur, so each worker keeps what it has encoded in a cache of bounded size, and whole batches of documents are
put together from it by array operations. Special strings inside texts become their tokens, as the tokenizers library does by default.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import chunks, gather, in_batches, table, utf8

#: The pattern by which byte-level tokenizers of this kind cut texts; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens that a worker remembers, and the longest of them in characters; longer ones are encoded each time.
CACHE, CACHED_LENGTH = 300_000, 64
#: Characters of text that are encoded at once; pieces end where a pre-token does.
PIECE = 1 << 20
BORDER = regex.compile(r"\S(?=\s)")


def lists(find, part: str) -> Iterator[list[str]]:
    """Pre-tokens of a text, a list for each piece. Only a long text is cut, where a space or line end follows something else: a pre-token ends
    there."""
    at = 0
    while len(part) - at > PIECE:
        m = BORDER.search(part, at + PIECE)
        if not m:
            break
        yield find(part, at, m.end())
        at = m.end()
    if at < len(part):
        yield find(part, at)


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """A byte-level vocabulary with its merges, as arrays. Token numbers inside are ranks: bytes first, then merges by priority."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer") or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("ignore_merges"):
            raise ValueError("only byte-level BPE files without normalizer and prefix space are handled")
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        by_text = {chr_: i for i, chr_ in enumerate(sorted(letters, key=letters.get))}
        self.bytes = [bytes([i]) for i in range(256)]
        self.left, self.right = [list(range(256)) for _ in range(2)]
        self.pairs: dict[tuple[int, int], int] = {}
        for a, b in merges:
            pair, new = (by_text[a], by_text[b]), by_text.setdefault(a + b, len(self.bytes))
            if new < len(self.bytes) and self.pairs.get(pair) != new:
                raise ValueError(f"two merges give {a + b!r}; a token's number stands for its merge's priority here, so such files aren't handled")
            if new == len(self.bytes):
                self.bytes.append(raw(a + b))
                self.left.append(pair[0])
                self.right.append(pair[1])
            self.pairs.setdefault(pair, new)
        self.out = np.array([vocab[t] for t in sorted(by_text, key=by_text.get)], np.int32)
        self.left, self.right = np.array(self.left, np.int64), np.array(self.right, np.int64)
        keys = np.array([a << 32 | b for a, b in self.pairs], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_new = keys[order], np.array(list(self.pairs.values()), np.int64)[order]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.find = regex.compile(PATTERN).findall
        # For the greedy match: only tokens that merging their own bytes gives.
        whole = {b: i for i, b in enumerate(self.bytes) if len(b) < 3 or self.merged(b) == [i]}
        self._trie(whole)
        # For decoding, by the ids of the file.
        last = max([*map(int, self.out), *self.special.values()])
        texts = [b""] * (last + 1)
        for rank, i in enumerate(self.out):
            texts[i] = self.bytes[rank]
        for text, i in self.special.items():
            texts[i] = text.encode()
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(texts), np.uint8)
        self._forget()

    def _trie(self, whole: dict[bytes, int]) -> None:
        nodes, ends, keys, to = {b"": 0}, [-1], [], []
        for text in sorted(whole):
            at = 0
            for i in range(1, len(text) + 1):
                node = nodes.get(text[:i])
                if node is None:
                    node = nodes[text[:i]] = len(ends)
                    ends.append(-1)
                    keys.append(at << 8 | text[i - 1])
                    to.append(node)
                at = node
            ends[at] = whole[text]
        order = np.argsort(keys)
        self.edges, self.to, self.ends = np.array(keys, np.int64)[order], np.array(to, np.int64)[order], np.array(ends, np.int64)

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.words = self.used = 0
        self.flat, self.word_start, self.word_size = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def merged(self, text: bytes) -> list[int]:
        """Exact merging: again and again the pair of the best priority, all its occurrences from left to right."""
        ids = list(text)
        while len(ids) > 1:
            best = min((self.pairs.get(p, 1 << 40) for p in zip(ids, ids[1:])), default=1 << 40)
            if best == 1 << 40:
                break
            out, i, a, b = [], 0, self.left[best], self.right[best]
            while i < len(ids):
                if i + 1 < len(ids) and ids[i] == a and ids[i + 1] == b:
                    out.append(best)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def merged_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """merged() of many texts in step: tokens one after another, and the text of each. Every round merges, in each text that isn't done,
        the leftmost pair of the best priority; a merge never makes a better pair than itself, so this is the order of merged()."""
        sizes = np.array([len(t) for t in texts], np.int64)
        tok = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
        own = np.repeat(np.arange(len(texts)), sizes)
        done_tok, done_own = [], []
        new = np.full(len(tok), 1 << 40, np.int64)
        near = np.flatnonzero(own[1:] == own[:-1])
        new[near] = self._merge(tok[near], tok[near + 1])
        while len(tok):
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            best = np.minimum.reduceat(new, first)
            counts = np.diff(np.append(first, len(tok)))
            over = np.repeat(best >= 1 << 40, counts)
            if over.any():
                done_tok.append(tok[over])
                done_own.append(own[over])
                tok, own, new, best, counts = tok[~over], own[~over], new[~over], best[best < 1 << 40], counts[best < 1 << 40]
                if not len(tok):
                    break
            hits = np.flatnonzero(new == np.repeat(best, counts))
            at = hits[np.append(True, own[hits][1:] != own[hits][:-1])]
            tok[at] = new[at]
            keep = np.ones(len(tok), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # one token went before each later place
            tok, own, new = tok[keep], own[keep], new[keep]
            for p in (at, at[at > 0] - 1):
                inside = (p + 1 < len(tok)) & (own[np.minimum(p + 1, len(tok) - 1)] == own[p])
                new[p[~inside]] = 1 << 40
                q = p[inside]
                new[q] = self._merge(tok[q], tok[q + 1])
        if not done_tok:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        tok, own = np.concatenate(done_tok), np.concatenate(done_own)
        order = np.argsort(own, kind="stable")
        return tok[order], own[order]

    def _merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that each pair merges to, or a large number."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_new[at], 1 << 40)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the bytes of each pair of tokens, merged together, give back the two.

        Follows both tokens back in time, always undoing the later merge: were a pair of parts that touched at some moment mergeable before
        one of them was merged further, it would have been merged then, across the border.
        """
        a, b = a.copy(), b.copy()
        good = np.ones(len(a), bool)
        todo = np.arange(len(a))
        limit = np.full(len(a), 1 << 39, np.int64)  # merges below it came before the moment looked at
        while len(todo):
            x, y, l = a[todo], b[todo], limit[todo]
            bad = self._merge(x, y) < l
            good[todo[bad]] = False
            undo_x = x > y  # of equal merges the left one came first, so the right one is undone first
            leaf = np.where(undo_x, x, y) < 256
            go = ~bad & ~leaf
            todo, x, y, undo_x = todo[go], x[go], y[go], undo_x[go]
            limit[todo] = np.where(undo_x, x, y + 1)
            a[todo] = np.where(undo_x, self.right[x], x)
            b[todo] = np.where(undo_x, y, self.left[y])
        return good

    def speculate(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the greedy longest match of each text, one after another, and the text of each. All texts advance at once."""
        sizes = np.array([len(t) for t in texts], np.int64)
        buf = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
        stop = np.cumsum(sizes)
        pos, own = stop - sizes, np.flatnonzero(sizes)
        found, whose = [], []
        while len(own):
            node, at, end, best = np.zeros(len(own), np.int64), pos[own].copy(), stop[own], np.zeros(len(own), np.int64)
            after, alive = at.copy(), np.arange(len(own))
            while len(alive):
                key = node[alive] << 8 | buf[at[alive]]
                i = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
                ok = self.edges[i] == key
                alive, i = alive[ok], i[ok]
                node[alive] = self.to[i]
                at[alive] += 1
                e = self.ends[node[alive]]
                hit = alive[e >= 0]
                best[hit], after[hit] = e[e >= 0], at[hit]
                alive = alive[at[alive] < end[alive]]
            found.append(best)
            whose.append(own)
            pos[own] = after
            own = own[after < end]
        found, whose = np.concatenate(found), np.concatenate(whose)
        order = np.argsort(whose, kind="stable")
        return found[order], whose[order]

    def encode_words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens (not empty) one after another, and the number of each one's."""
        tokens, whose = self.speculate(texts)
        near = np.flatnonzero(whose[1:] == whose[:-1])
        failed = np.unique(whose[near[~self.compatible(tokens[near], tokens[near + 1])]])
        if len(failed):
            exact, where = self.merged_all([texts[i] for i in failed])
            lost = np.zeros(len(texts), bool)
            lost[failed] = True
            kept = ~lost[whose]
            tokens = np.concatenate([tokens[kept], exact])
            whose = np.concatenate([whose[kept], failed[where]])
            order = np.argsort(whose, kind="stable")
            tokens, whose = tokens[order], whose[order]
        return self.out[tokens], np.bincount(whose, minlength=len(texts))

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if not new:
            return
        for lo in range(0, len(new), 1 << 16):
            part = new[lo : lo + (1 << 16)]
            ids, sizes = self.encode_words([w.encode() for w in part])
            n, end = self.words, self.used + len(ids)
            while end > len(self.flat):
                self.flat = np.concatenate([self.flat, self.flat])
            while n + len(part) > len(self.word_start):
                self.word_start, self.word_size = np.concatenate([self.word_start] * 2), np.concatenate([self.word_size] * 2)
            self.flat[self.used : end] = ids
            stops = np.cumsum(sizes)
            self.word_start[n : n + len(part)], self.word_size[n : n + len(part)] = self.used + stops - sizes, sizes
            self.known.update(zip(part, range(n, n + len(part)), strict=True))
            self.words, self.used = n + len(part), end

    def pieces(self, text: str) -> Iterator[list[str] | int]:
        """Lists of pre-tokens, and ids of special strings between them."""
        for k, part in enumerate(self.cut.split(text)) if self.cut else [(0, text)]:
            if k % 2:
                yield self.special[part]
            else:
                yield from lists(self.find, part)


    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of each text's."""
        plan, needed = [], set()
        for text in texts:
            own = list(self.pieces(text))
            for x in own:
                if isinstance(x, list):
                    needed.update(x)
            plan.append(own)
        if len(self.known) + len(needed) > CACHE:
            self._forget()
        self._learn(needed)
        ids, counts = [], []
        for own in plan:
            n = 0
            for x in own:
                if isinstance(x, list):
                    k = np.fromiter(map(self.known.__getitem__, x), np.int64, len(x))
                    got = self.flat[gather(self.word_start[k], self.word_size[k])]
                else:
                    got = np.array([x], np.int32)
                ids.append(got)
                n += len(got)
            counts.append(n)
        for w in [w for w in needed if len(w) > CACHED_LENGTH]:  # long ones don't recur; their place in the arrays stays until these are forgotten
            del self.known[w]
        return np.concatenate(ids) if ids else np.zeros(0, np.int32), np.array(counts, np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids."""
        sizes = self.sizes[ids]
        data = self.blob[gather(self.starts[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return [data[a:b] for a, b in zip(ends, ends[1:])]


_loaded: dict[str, Bpe] = {}


def loaded(path: str) -> Bpe:
    """One vocabulary for each worker and file."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def _texts(bpe: Bpe, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.array([t.decode("utf-8", "replace") for t in bpe.decode(ids, counts)], pa.string())


def _encode(path: str, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            _, offs = utf8(batch.column("text"))
            for i, j in chunks(offs):
                ids, counts = bpe.encode(["" if t is None else t for t in batch.column("text")[i:j].to_pylist()])
                stops = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                cols = [batch.column("doc_id")[i:j], pa.ListArray.from_arrays(pa.array(stops), pa.array(ids, pa.int32()))]
                yield pa.record_batch([*cols, *([_texts(bpe, ids, counts)] if decode else [])], ["doc_id", "ids", "text"][: 2 + decode])

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            col = batch.column("ids")
            counts = np.diff(col.offsets.to_numpy()).astype(np.int64)
            yield pa.record_batch([batch.column("doc_id"), col, _texts(bpe, col.flatten().to_numpy(), counts)], ["doc_id", "ids", "text"])

    return run


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """doc_id and ids of each row, and with decode also the text that the ids decode to, in one pass; ids are as the tokenizers library gives them without added special tokens, padding or truncation.

    path: a byte-level BPE file of that library, readable by every executor. Null text counts as empty and has no ids; null and repeated ids
    stay as they are; further columns are ignored; whole texts of any length are encoded, in pieces that end where pre-tokens do.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return in_batches(rows).mapInArrow(_encode(path, decode), "doc_id long, ids array<int>" + ", text string" * decode)


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the text of the ids, special tokens included. Bytes that aren't UTF-8 give U+FFFD; no ids, or null, an empty text."""
    rows = rows.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return in_batches(rows).mapInArrow(_decode(path), "doc_id long, ids array<int>, text string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row of docs (doc_id, text). Null texts count as empty: no tokens, and the digests
    of nothing. Repeated rows and null ids give rows of their own; further columns are ignored; an empty table gives an empty result; texts of
    any length are encoded whole."""
    both = encoded(docs, path, decode=True)
    said = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(said, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"), vocabulary())
