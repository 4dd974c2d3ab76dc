"""Benchmark decontamination.

Seeds that an item and a document share put an item-sized window on the document: eight equal bytes anywhere, or four and four with one byte
changed, left out or put in between, if the bytes around them are alike, too. Window and item are embedded by the CGK random
walk, which turns edit distance into Hamming distance: at each step a byte is written, and a random function of step and byte decides
whether the walk goes on to the next. Repeated bit-sampling LSH then compares a few sampled places of several walks; windows that agree with
their item in any repetition are verified by the exact edit distance. A document is contaminated by an item when some part of it lies within
edit distance (1 - similarity) * length of the item.

Items of more than SEGMENT bytes are looked for by segments: of an item with no more than a share of edits, some segment has no more than that
share. Items of fewer than SHORT bytes, too short for edits to mean anything, count where they stand exactly, as whole words.

Both are compared in bytes, with A-Z lower-cased and runs of white space taken for one space.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import CHUNK, SPACE, TO_LOWER, chunks, gather, in_batches, stretches, table, unused, utf8

#: Walks, repetitions for each walk and places sampled for each repetition. What they let pass and what they find is measured in README and tested.
WALKS, REPEATS, PLACES = 16, 32, 4
#: Bytes around texts that may be looked at, seeds looked at together, windows embedded together (in steps of their walks), the first four of
#: eight bytes.
PAD, HITS, STEPS, FOUR = 32, 1 << 15, 1 << 24, np.uint64(0xFFFFFFFF)
#: The 64 bytes of an item around a seed may have so many times the share of edits that the whole item may.
UNEVEN = 1.7
#: Seeds inside a run of equal bytes that are looked at besides its first.
APART = 32
#: Bytes below which an item counts only where it stands exactly, most bytes of a segment, bytes of items that one pass over the documents looks for.
SHORT, SEGMENT, BLOCK_BYTES = 24, 2048, 4 << 20
#: Bytes of words: digits, letters, and whatever isn't ASCII.
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def normalised(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets of the normal form, and each byte's place in buf."""
    low = TO_LOWER[buf]
    white = SPACE[low]
    keep = ~white
    keep[1:] |= ~white[:-1]
    keep[offs[:-1][offs[:-1] < len(buf)]] = True
    low[white] = 32
    at = np.flatnonzero(keep)
    return low[keep], np.searchsorted(at, offs), at


def long_form(buf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Normal form of one long text and the places of its bytes in buf, by stretches."""
    blank = False
    for lo, hi in stretches(buf, 0, len(buf), SPACE):
        out, _, at = normalised(buf[lo:hi], np.array([0, hi - lo]))
        skip = int(blank and len(out) > 0 and out[0] == 32)  # a run of white space that began in the stretch before
        blank = bool(out[-1] == 32) if len(out) else blank
        yield out[skip:], at[skip:] + lo


def places(buf: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where the bytes of the normal form with these numbers, in ascending order, stand in buf."""
    out, before = np.full(len(wanted), len(buf), np.int64), 0
    for part, at in long_form(buf):
        own = (wanted >= before) & (wanted < before + len(part))
        out[own] = at[wanted[own] - before]
        before += len(part)
    return out


def words_at(buf: np.ndarray) -> np.ndarray:
    """For each place, from PAD before buf to PAD behind it, the eight bytes from there on, as one number; zeros stand around buf."""
    padded = np.zeros(len(buf) + 2 * PAD + 8, np.uint8)
    padded[PAD : PAD + len(buf)] = buf
    return np.ndarray((len(buf) + 2 * PAD,), "<u8", padded, 0, (1,))


def skipping(eight: np.ndarray) -> np.ndarray:
    """Of what words_at() gives: the four bytes from each place on, then, one byte left out, four more."""
    out = eight & FOUR
    out[:-5] |= eight[5:] << np.uint64(32)
    return out


def equal_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the eight bytes are equal."""
    x, low = a ^ b, np.uint64(0x7F7F7F7F7F7F7F7F)
    zero = ~(((x & low) + low) | x | low)
    return ((zero >> np.uint64(7)) * np.uint64(0x0101010101010101)) >> np.uint64(56)


def edit_distances(item: bytes, text: bytes) -> np.ndarray:
    """For each end in text, the least edit distance between the item and a part of the text ending there (bit-parallel dynamic programming)."""
    m = len(item)
    masks: dict[int, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, out = full, 0, m, np.empty(len(text) + 1, np.int64)
    out[0] = m
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        diagonal = ((((eq & up) + up) ^ up) | eq | down) & full
        right_up, right_down = down | (full & ~(diagonal | up)), up & diagonal
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
        right_up, right_down = right_up << 1 & full, right_down << 1 & full
        up, down = right_down | (full & ~(diagonal | down | right_up)), right_up & (diagonal | down)
        out[j] = score
    return out


def piece_distances(pieces: np.ndarray, free: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """For each row, the least edit distance between 64 bytes and any part of a text; free bytes equal all. As edit_distances(), by rows."""
    one, top = np.uint64(1), np.uint64(63)
    up, down = np.full(len(pieces), 2**64 - 1, np.uint64), np.zeros(len(pieces), np.uint64)
    score = np.full(len(pieces), 64)
    least = score.copy()
    for j in range(texts.shape[1]):
        eq = np.packbits((pieces == texts[:, j, None]) | free, axis=1, bitorder="little").view("<u8")[:, 0]
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right_up, right_down = down | ~(diagonal | up), up & diagonal
        score += (right_up >> top).astype(np.int64) - (right_down >> top).astype(np.int64)
        right_up, right_down = right_up << one, right_down << one
        up, down = right_down | ~(diagonal | down | right_up), right_up & (diagonal | down)
        np.minimum(least, score, out=least)
    return least


class Items:
    """Normal forms of benchmark items; their segments, with seeds; and short ones."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = 0.8):
        by_text: dict[bytes, list] = {}
        for item_id, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            low = b"".join(bytes(part) for part, _ in long_form(raw)).strip(b" ")
            if len(low) >= SHORT or WORD[np.frombuffer(low, np.uint8)].any():
                by_text.setdefault(low, []).append(item_id)
        self.texts = sorted(by_text, key=len)
        self.ids = [by_text[t] for t in self.texts]
        self.share = 1 - similarity
        lengths = np.array([len(t) for t in self.texts], np.int64)
        self.limits = np.where(lengths < SHORT, 0, np.floor(lengths * self.share + 1e-9)).astype(np.int64)
        self.reach = int((lengths + self.limits).max(initial=0)) + 2 * PAD
        self.shorts = self._shorts()
        long = [t for t in self.texts if len(t) >= SHORT]
        cuts = [np.linspace(0, len(t), -(-len(t) // SEGMENT) + 1).astype(np.int64) for t in long]
        self.item = np.repeat(np.arange(len(self.texts) - len(long), len(self.texts)), [len(c) - 1 for c in cuts])
        self.offset = np.concatenate([c[:-1] for c in cuts]) if long else np.zeros(0, np.int64)
        self.sizes = np.concatenate([np.diff(c) for c in cuts]) if long else np.zeros(0, np.int64)
        self.allowed = np.floor(self.sizes * self.share + 1e-9).astype(np.int64)
        self.buf = np.frombuffer(b"".join(long), np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.eight = words_at(self.buf)
        self.first = PAD + self.starts
        at = [gather(self.first, self.sizes - width + 1) for width in (8, 9)]
        keys = np.concatenate([self.eight[at[0]], skipping(self.eight)[at[1]]])
        self.shift = np.uint64(64 - min(24, max(16, len(keys).bit_length() + 4)))
        h = self._bucket(keys)
        order = np.argsort(h, kind="stable")
        self.keys, self.places = keys[order], np.concatenate(at)[order].astype(np.int32)
        self.widths = np.repeat(np.array([8, 9], np.int8), [len(at[0]), len(at[1])])[order]
        count = np.bincount(h, minlength=1 << (64 - int(self.shift)))
        self.used, self.begin = count > 0, np.concatenate([[0], np.cumsum(count)]).astype(np.int32)

    def _bucket(self, eight: np.ndarray) -> np.ndarray:
        return ((eight * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _shorts(self) -> list[tuple]:
        """Of each length below SHORT: texts as three numbers of eight bytes, sorted by the first, masks of these, and the texts' numbers."""
        out = []
        for size in sorted({len(t) for t in self.texts if len(t) < SHORT}):
            own = np.array([i for i, t in enumerate(self.texts) if len(t) == size])
            eights = np.frombuffer(b"".join(self.texts[i].ljust(SHORT, b"\0") for i in own), "<u8").reshape(-1, 3)
            order = np.argsort(eights[:, 0], kind="stable")
            masks = [(1 << 8 * min(8, max(0, size - 8 * k))) - 1 for k in range(3)]
            out.append((size, eights[order], np.array(masks, np.uint64), own[order]))
        return out

    def exact(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, item and start of the short items that stand in the texts as whole words."""
        got = [np.zeros((3, 0), np.int64)]
        eight = words_at(buf) if self.shorts and len(buf) else None
        solid = np.concatenate([[False], WORD[buf], [False]])
        for size, texts, masks, item in self.shorts if eight is not None else ():
            keys = eight[PAD : PAD + len(buf)] & masks[0]
            lo, hi = np.searchsorted(texts[:, 0], keys), np.searchsorted(texts[:, 0], keys, "right")
            at = np.flatnonzero(hi > lo)
            k, at = gather(lo[at], hi[at] - lo[at]), np.repeat(at, hi[at] - lo[at])
            for n in (1, 2):
                ok = eight[at + PAD + 8 * n] & masks[n] == texts[k, n]
                k, at = k[ok], at[ok]
            r = np.searchsorted(offs, at, "right") - 1
            ends = np.frombuffer(b"".join(self.texts[i][:1] + self.texts[i][-1:] for i in item), np.uint8).reshape(-1, 2)
            inner = (at > offs[r]) & solid[at] & WORD[ends[k, 0]]
            outer = (at + size < offs[r + 1]) & solid[np.minimum(at + size + 1, len(buf) + 1)] & WORD[ends[k, 1]]
            ok = (at + size <= offs[r + 1]) & ~inner & ~outer
            got.append(np.stack([r[ok], item[k[ok]], at[ok]]))
        return tuple(np.concatenate(got, 1))

    def windows(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row, segment and start of the windows that seeds point to, with the start and the end of the region that a match may take."""
        found = [np.zeros((5, 0), np.int64)]
        if len(buf) and len(self.sizes):
            eight = words_at(buf)
            heads = np.zeros(len(buf) + 1, bool)
            heads[offs] = True
            for keys, width in ((eight, 8), (skipping(eight), 9)):
                h = self._bucket(keys[PAD : PAD + len(buf)])
                at = np.flatnonzero(self.used[h])
                lo, hi = self.begin[h[at]].astype(np.int64), self.begin[h[at] + 1].astype(np.int64)
                for i, j in chunks(np.concatenate([[0], np.cumsum(hi - lo)]), HITS):
                    n = hi[i:j] - lo[i:j]
                    k, place = gather(lo[i:j], n), np.repeat(at[i:j], n)
                    hit = self.keys[k] == keys[place + PAD]
                    k, place = k[hit], place[hit]
                    found.append(self._alike(eight, offs, heads, place, width, self.places[k].astype(np.int64), self.widths[k].astype(np.int64)))
        seeds = np.concatenate(found, 1)
        near = [self._near(buf, *seeds[1:, i : i + HITS][[0, 2, 3]]) for i in range(0, seeds.shape[1], HITS)]
        r, item, start = seeds[:3, np.concatenate(near)] if near else seeds[:3]
        if len(r):
            r, item, start = np.unique(np.stack([r, item, start]), axis=1)
        return r, item, start, np.maximum(offs[r], start - self.allowed[item]), np.minimum(offs[r + 1], start + self.sizes[item] + self.allowed[item])

    def _alike(self, eight: np.ndarray, offs: np.ndarray, heads: np.ndarray, at: np.ndarray, width: int, place: np.ndarray, item_width: np.ndarray) -> np.ndarray:
        """Row, item and start of the windows, and place in text and item, of those seeds whose surroundings, too, are alike: of up to 16 bytes on each side half are equal,
        counted by eights that may be shifted a little. Of a longer run of equal bytes the first seed counts, and those that stand at every APART-th
        byte of the segment: where the run begins, the bytes before it may be a large edit."""
        apart = np.where(item_width == 8, -1, 4)
        ok = (item_width != width) | ((eight[at + PAD + apart] ^ self.eight[place + apart]) & np.uint64(255) != 0) | ((apart < 0) & heads[at])
        ok |= (place - self.first[np.searchsorted(self.first, place, "right") - 1]) % APART == 0
        at, place, item_width = at[ok], place[ok], item_width[ok]
        score = np.zeros(len(at), np.uint64)
        for reach, shifts in ((8, 2), (16, 3)):
            for text_off, item_off in ((width + reach - 8, item_width + reach - 8), (-reach, -reach)):
                own, best = self.eight[place + item_off], np.zeros(len(at), np.uint64)
                for shift in range(-shifts, shifts + 1):
                    np.maximum(best, equal_bytes(own, eight[at + PAD + text_off + shift]), out=best)
                score += best
            item = np.searchsorted(self.first, place, "right") - 1
            left = place - self.first[item]
            ok = 2 * score.astype(np.int64) >= np.minimum(left, reach) + np.minimum(self.sizes[item] - left - item_width, reach) - 2 * (reach == 8)
            at, place, item_width, item, left, score = at[ok], place[ok], item_width[ok], item[ok], left[ok], score[ok]
        r = np.searchsorted(offs, at, "right") - 1
        ok = at + width <= offs[r + 1]
        return np.stack([r, item, np.clip(at - left, offs[r], offs[r + 1]), at, left])[:, ok]

    def _near(self, buf: np.ndarray, item: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Whether the 64 bytes of the item around the seed are, by edit distance, near the text there."""
        skip = np.clip(left - 28, 0, np.maximum(0, self.sizes[item] - 64))
        place = skip[:, None] + np.arange(64)
        own = self.buf[np.minimum(self.starts[item][:, None] + place, len(self.buf) - 1)]
        text = buf[np.clip((at - left + skip - 16)[:, None] + np.arange(96), 0, len(buf) - 1)]
        limit = np.ceil(UNEVEN * self.share * np.minimum(64, self.sizes[item]))
        return piece_distances(own, place >= self.sizes[item][:, None], text) <= limit

    def found(self, parts: Iterator[tuple[np.ndarray, np.ndarray, int, int]]) -> dict[tuple[int, int], tuple]:
        """By row and item: distance, first and last end of the best match, in normalised bytes from the row's start.

        parts: normal forms and offsets of rows, the number of the first of them, and where in it the part starts."""
        best: dict[tuple[int, int], tuple] = {}
        held, regions, kept, size = [], [], [], 0
        for part in parts:
            buf, offs, row, base = part
            for r, item, at in zip(*(x.tolist() for x in self.exact(buf, offs)), strict=True):
                at += base - int(offs[r])
                match = (0, at, at + len(self.texts[item]))
                best[row + r, item] = min(match, best.get((row + r, item), match))
            r, item, start, lo, hi = self.windows(buf, offs)
            if not len(r):
                continue
            regions.append(buf[gather(lo, hi - lo)])
            held.append(np.stack([np.full(len(r), len(kept)), r, item, start - lo, hi - lo, start]))
            kept.append(part)
            size += len(regions[-1])
            if size > 1 << 23:
                self._verified(kept, np.concatenate(regions), np.concatenate(held, 1), best)
                held, regions, kept, size = [], [], [], 0
        if held:
            self._verified(kept, np.concatenate(regions), np.concatenate(held, 1), best)
        return best

    def _verified(self, parts: list[tuple], buf: np.ndarray, held: np.ndarray, best: dict) -> None:
        part, row, segment, shift, size, start = held
        end = np.cumsum(size)
        begin = end - size
        good = np.zeros(len(row), bool)
        for i in range(0, len(row), 1 << 11):
            p = slice(i, i + (1 << 11))
            near = sampled(buf, begin[p] + shift[p], end[p], self.sizes[segment[p]])
            asked, which = np.unique(segment[p], return_inverse=True)  # of the items only those that seeds point to are embedded
            own = sampled(self.buf, self.starts[asked], self.starts[asked] + self.sizes[asked], self.sizes[asked])
            good[p] = (near == own[which]).all(2).any(1)
        spans: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
        for n in np.flatnonzero(good).tolist():
            item, at = int(self.item[segment[n]]), int(start[n] - self.offset[segment[n]])
            offs, limit = parts[part[n]][1], int(self.limits[item])
            own = max(int(offs[row[n]]), at - limit), min(int(offs[row[n] + 1]), at + len(self.texts[item]) + limit)
            spans.setdefault((int(part[n]), int(row[n]), item), []).append(own)
        for (n, r, item), regions in spans.items():
            text, (own, offs, first, base) = self.texts[item], parts[n]
            key, joined = (first + r, item), []  # regions that overlap count as one
            for a, b in sorted(regions):
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(b, joined[-1][1])
                else:
                    joined.append([a, b])
            for a, b in joined:
                if best.get(key, (1,))[0] == 0:
                    break
                region = own[a:b].tobytes()
                at = region.find(text)
                if at >= 0:
                    match = (0, at, at + len(text))
                else:
                    d = edit_distances(text, region)
                    stop = int(d.argmin())
                    if d[stop] > self.limits[item]:
                        continue
                    match = (int(d[stop]), stop - int(edit_distances(text[::-1], region[max(0, stop - 2 * len(text)) : stop][::-1]).argmin()), stop)
                shift = a - int(offs[r]) + base
                match = (match[0], match[1] + shift, match[2] + shift)
                best[key] = min(match, best.get(key, match))


@functools.cache
def _walks() -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each walk: random functions of step and byte, taken over and over, and the sampled places as parts of the walk's length."""
    rng = np.random.default_rng(51)
    return [(rng.integers(0, 2, (1024, 256)).astype(np.int8), rng.random((REPEATS, PLACES))) for _ in range(WALKS)]


def sampled(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sampled places of the embeddings of windows of the given sizes, as far as their text goes: windows x repetitions x places.

    Places are drawn as parts of the walk's length, so that a window is sampled where its item is. Windows of like sizes go together.
    """
    out = np.zeros((len(starts), WALKS * REPEATS, PLACES), np.uint8)
    padded = np.append(buf, np.uint8(0))
    order = np.argsort(sizes, kind="stable")
    i = 0
    while i < len(order):
        j = i + 1
        while j < len(order) and (j + 1 - i) * 2 * int(sizes[order[j]]) <= STEPS:
            j += 1
        own = order[i:j]
        size = sizes[own]
        stop, steps = np.minimum(starts[own] + size, ends[own]), int(2 * size[-1])
        seen = np.empty((steps, len(own)), np.uint8)
        for w, (moves, parts) in enumerate(_walks()):
            at = starts[own].copy()
            for k in range(steps):
                byte = padded[np.where(at < stop, at, len(buf))]
                seen[k] = byte
                at += moves[k % 1024][byte]
            step = np.minimum((parts[None] * 2 * size[:, None, None]).astype(np.int64), 2 * size[:, None, None] - 1)
            out[own, w * REPEATS : (w + 1) * REPEATS] = seen[step, np.arange(len(own))[:, None, None]]
        i = j
    return out


def _parts(raw: np.ndarray, offs: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Normal forms of the texts, for Items.found(); a long text comes in parts that overlap by reach on either side."""
    for i, j in chunks(offs):
        own = raw[offs[i] : offs[j]]
        if j - i > 1 or len(own) <= 2 * CHUNK:
            yield *normalised(own, offs[i : j + 1] - offs[i])[:2], i, 0
            continue
        whole = np.concatenate([part for part, _ in long_form(own)])
        step = max(CHUNK, 2 * reach)
        for at in range(0, len(whole), step):
            first, last = max(0, at - reach), min(len(whole), at + step + reach)
            yield whole[first:last], np.array([0, last - first]), i, first


def _marked(shared, text_col: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            raw, offs = utf8(batch.column(text_col))
            rows: list[list] = [[] for _ in range(len(batch))]
            found: dict[int, list] = {}
            for (row, item), match in sorted(items.found(_parts(raw, offs, items.reach)).items()):
                found.setdefault(row, []).append((item, *match))
            for row, matches in found.items():
                wanted = np.unique([x for _, _, a, b in matches for x in (a, b - 1)])
                at = dict(zip(wanted.tolist(), places(raw[offs[row] : offs[row + 1]], wanted).tolist(), strict=True))
                for item, distance, a, b in matches:
                    rows[row] += [{"item_id": x, "distance": distance, "start": at[a], "end": at[b - 1] + 1 if b > a else at[a]} for x in items.ids[item]]
            yield pa.record_batch([*batch.columns, pa.array(rows, kind)], [*batch.schema.names, name])

    return run


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """Items, the shorter ones first, by blocks of bounded bytes: what is broadcast at once doesn't grow with the benchmark."""
    block, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("t <> ''")
    for r in rows.orderBy(F.octet_length("t"), "i", "t").toLocalIterator():
        block.append((r.i, r.t))
        size += len(r.t.encode())
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _passes(docs: DataFrame, benchmark: DataFrame, similarity: float, chain: bool) -> list[tuple[DataFrame, str]]:
    """docs with a column of matches, and its name, for each block of the benchmark; chained, each pass gets what the one before left."""
    from pyspark.sql import types as T

    out, spark, name = [], docs.sparkSession, unused(docs, "hits")
    span = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), *(T.StructField(n, T.IntegerType()) for n in ("distance", "start", "end"))]))
    for block in _blocks(benchmark, "item_id", "text"):
        shared = spark.sparkContext.broadcast(Items(block, similarity))
        marked = in_batches(docs).mapInArrow(_marked(shared, "text", name), T.StructType([*docs.schema.fields, T.StructField(name, span)]))
        out.append((marked, name))
        if chain:
            docs = marked.where(F.size(name) == 0).drop(name)
    return [(docs, name)] if chain else out


def contaminations(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """doc_id, item_id, distance, start and end (bytes of the text) of the best match of each item that contaminates a document.

    docs: doc_id, text; benchmark: item_id, text; further columns are ignored. Null and empty texts match nothing; items of fewer than SHORT
    normalised bytes match only as they are, as whole words, and not at all without a letter or digit. Each row of docs gives rows of its
    own, repeated ones too; null ids stay null; items that repeat a text are all named; of equal matches the first counts. An empty table on
    either side gives an empty result. Whole texts of any length are searched, long ones in overlapping parts; items of any length, too.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = [m.where(F.size(h) > 0).select("doc_id", F.explode(h).alias("h")).select("doc_id", "h.*") for m, h in _passes(rows, benchmark, similarity, False)]
    empty = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance int, start int, end int")
    return functools.reduce(DataFrame.unionByName, found) if found else empty


def decontaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of docs that no item contaminates, with all their columns, whatever their names; as in contaminations(), rows are judged one by
    one, so repeated rows and ids and null ids stay or go by their texts; null and empty texts stay; an empty benchmark leaves all."""
    return _passes(docs, benchmark, similarity, True)[0][0]


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
