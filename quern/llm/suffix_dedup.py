"""Removal of repeated byte strings by a sparse, range-partitioned suffix array.

A string of min_bytes bytes that starts in two places also holds, in both, the same anchor: the place of the smallest hash among its
slices of ANCHOR bytes. So only suffixes at anchors are sorted first, one for about every 70 bytes. Sampled splitters range-partition
them by their leading token (the fingerprint of the anchor's bytes) and next token (that of all bytes of the windows which the anchor
stands for); each bucket sorts itself by multikey quicksort and compares neighbours, and the first and last suffix of each bucket are
compared across boundaries. The sort key ends with the row's hash and the place in it, so that splitters also cut runs of equal suffixes: a passage that a
third of all documents share spreads over many buckets. An anchor whose next token repeats repeats with all its windows; one whose leading
token alone repeats is contested, and its windows, one suffix for each start, go through the same sort. Tokens are fingerprints: two
different windows are taken for equal only if two independent fingerprints of them, of 96 bits together, agree.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.common import CHUNK, Fingerprints, chunks, gather, in_batches, mix, table, utf8, written

#: Bytes of a slice whose hash may make it an anchor. Longer slices give more anchors but fewer contested windows.
ANCHOR = 256
#: Kinds of a suffix: no token repeats, the leading one does, both do; the last stands for equal ones where the leading token is contested.
EMPTY, GRAM, FULL, CHOSEN = 0, 1, 2, 3
#: Places of a text whose ranges are joined at once.
STARTS = 1 << 14
#: Bytes of documents for each bucket of anchors, and windows for each bucket of these: one worker sorts a bucket whole.
BUCKET_BYTES, BUCKET_WINDOWS = 256 << 20, 1 << 21


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, by running minima of blocks from both ends."""
    n = len(v)
    x = np.concatenate([v, np.full(-n % w, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    after = np.minimum.accumulate(x, axis=1).ravel()
    before = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(before[: n - w + 1], after[w - 1 : n])


def _pieces(buf: np.ndarray, offs: np.ndarray, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, offsets, rows and their start in the row, a chunk at a time; pieces of a row longer than a chunk overlap."""
    for i, j in chunks(offs):
        lo, hi = int(offs[i]), int(offs[j])
        if j - i > 1 or hi - lo <= 2 * CHUNK:
            yield buf[lo:hi], offs[i : j + 1] - lo, np.arange(i, j), np.zeros(j - i, np.int64)
        else:
            for at in range(lo, hi, CHUNK):
                part = buf[at : min(hi, at + CHUNK + overlap)]
                yield part, np.array([0, len(part)]), np.array([i]), np.array([at - lo])
                if at + CHUNK + overlap >= hi:
                    break


def anchors(buf: np.ndarray, offs: np.ndarray, size: int, anchor: int) -> Iterator[tuple[np.ndarray, ...]]:
    """row, first and last window start in the row, leading token, next token of each anchor of windows of size bytes."""
    width = size - anchor + 1
    for b, o, rows, base in _pieces(buf, offs, size - 1):
        if len(b) < size:
            continue
        prints, other = Fingerprints(b, 1), Fingerprints(b, 2)
        n = len(b) - anchor + 1
        values = (prints.of(slice(0, n), slice(anchor, len(b) + 1)) & np.uint64(0xFFFFFFFFFF000000)) | np.arange(n, dtype=np.uint64)
        least = (_sliding_min(values, width) & np.uint64(0xFFFFFF)).astype(np.int64)
        lengths = np.diff(o)
        starts = gather(o[:-1], np.maximum(lengths - size + 1, 0))  # of the windows that end in their row
        if not len(starts):
            continue
        row = np.repeat(np.arange(len(lengths)), np.maximum(lengths - size + 1, 0))
        at = least[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(starts)) - 1
        s1, s2, a, r = starts[first], starts[last], at[first], row[first]
        gram = prints.of(a, a + anchor)
        tail = mix(other.of(s1, s2 + size) + (a - s1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (s2 - a).astype(np.uint64))
        yield rows[r], s1 - o[r] + base[r], s2 - o[r] + base[r], gram, tail


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _anchor_batches(size: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = utf8(batch.column("text"))
            ids, kids = batch.column("did").to_numpy(), batch.column("kid").to_numpy()
            for row, s1, s2, gram, tail in anchors(buf, offs, size, anchor):
                cols = [_signed(gram), _signed(tail), ids[row], kids[row], s1.astype(np.int32), s2.astype(np.int32)]
                yield pa.record_batch(cols, ["lead", "tail", "did", "kid", "s1", "s2"])

    return run


def _window_batches(size: int):
    """Every window of the contested ranges of a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = utf8(batch.column("text"))
            ids, kids, spans = batch.column("did").to_numpy(), batch.column("kid").to_numpy(), batch.column("spans")
            for i in range(len(batch)):
                own = spans[i].values
                s1, s2 = own.field("s1").to_numpy().astype(np.int64), own.field("s2").to_numpy().astype(np.int64)
                order = np.argsort(s1)
                s1, s2 = s1[order], s2[order]
                b, ends = buf[offs[i] : offs[i + 1]], np.maximum.accumulate(s2)
                lo = 0
                while lo < len(s1):  # ranges that lie within one chunk
                    hi = max(lo + 1, int(np.searchsorted(ends, s1[lo] + CHUNK, "right")))
                    at = int(s1[lo])
                    part = b[at : int(s2[lo:hi].max()) + size]
                    one, two = Fingerprints(part, 3), Fingerprints(part, 4)
                    s = np.unique(gather(s1[lo:hi] - at, s2[lo:hi] - s1[lo:hi] + 1))
                    for k in range(0, len(s), 1 << 16):
                        p = s[k : k + (1 << 16)]
                        start = p + at
                        cols = [_signed(one.of(p, p + size)), (two.of(p, p + size) >> np.uint64(32)).astype(np.int64), np.full(len(p), ids[i]), np.full(len(p), kids[i]), start.astype(np.int32), start.astype(np.int32)]
                        yield pa.record_batch(cols, ["lead", "tail", "did", "kid", "s1", "s2"])
                    lo = hi

    return run


def multikey_order(lead: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Order by the first token; runs of equal first tokens are sorted on by the second."""
    order = np.argsort(lead)
    first = lead[order]
    tied = np.zeros(len(order), bool)
    same = first[1:] == first[:-1]
    tied[1:] |= same
    tied[:-1] |= same
    t = np.flatnonzero(tied)
    if len(t):
        run = np.cumsum(np.append(True, first[t][1:] != first[t][:-1]))
        order[t] = order[t][np.lexsort((tail[order[t]], run))]
    return order


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts one bucket and compares neighbours. The first and last suffix come back as edges, with their tokens, whatever they are."""
    got = list(batches)
    if not got or not sum(len(b) for b in got):
        return
    t = pa.Table.from_batches(got)
    del got
    lead, tail = t.column("lead").to_numpy(), t.column("tail").to_numpy()
    order = multikey_order(lead, tail)
    lead, tail = lead[order], tail[order]
    n = len(order)
    by_lead, by_tail = lead[1:] == lead[:-1], (lead[1:] == lead[:-1]) & (tail[1:] == tail[:-1])
    kind = np.zeros(n, np.int8)
    for same, value in ((by_lead, GRAM), (by_tail, FULL)):
        hit = np.zeros(n, bool)
        hit[1:] |= same
        hit[:-1] |= same
        kind[hit] = value
    # Contested windows may equal windows of a suffix that repeats as a whole, so one of its copies is compared on with them.
    group = np.cumsum(np.append(True, ~by_lead)) - 1
    starts = np.append(True, ~by_tail)
    several = np.bincount(group, weights=starts) > 1
    several[[0, -1]] = True  # these may go on in other buckets
    kind[starts & (kind == FULL) & several[group]] = CHOSEN
    edge = np.full(n, -1, np.int8)
    edge[-1], edge[0] = 1, 0
    keep = np.flatnonzero((kind != EMPTY) | (edge >= 0))
    rows = t.select(["did", "kid", "s1", "s2"]).take(pa.array(order[keep]))
    bucket = np.full(len(keep), TaskContext.get().partitionId(), np.int32)
    out = rows.append_column("kind", pa.array(kind[keep])).append_column("edge", pa.array(edge[keep])).append_column("bucket", pa.array(bucket))
    at_edge = edge[keep] >= 0
    for name, col in (("lead", lead), ("tail", tail)):
        out = out.append_column(name, pa.array(col[keep], mask=~at_edge))
    yield from out.combine_chunks().to_batches(max_chunksize=1 << 16)


def _ranged(suffixes: DataFrame, least: int) -> DataFrame:
    """Buckets by sampled splitters: as many as the session's shuffles have partitions, or least if that is more."""
    by = ("lead", "tail", "kid", "s1")
    enough = least <= int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return suffixes.repartitionByRange(*by) if enough else suffixes.repartitionByRange(least, *by)


def compared(suffixes: DataFrame, name: str, least: int = 1) -> DataFrame:
    """did, kid, s1, s2, kind of the suffixes whose tokens repeat: FULL or CHOSEN if both tokens do, GRAM if only the leading one. They are
    sorted in least buckets or more."""
    buckets = in_batches(_ranged(suffixes, least)).mapInArrow(
        _bucket, "did long, kid long, s1 int, s2 int, kind tinyint, edge tinyint, bucket int, lead long, tail long"
    )
    buckets = written(buckets, name)
    inner = buckets.where("edge < 0").select("did", "kid", "s1", "s2", "kind")
    # Two rows of each bucket at most, so the window is as small as the number of buckets.
    w = Window.orderBy("bucket", "edge")
    same_lead = [F.coalesce(f("lead").over(w) == F.col("lead"), F.lit(False)) for f in (F.lag, F.lead)]
    same_tail = [F.coalesce((f("lead").over(w) == F.col("lead")) & (f("tail").over(w) == F.col("tail")), F.lit(False)) for f in (F.lag, F.lead)]
    kind = F.when((F.col("kind") >= FULL) | same_tail[0] | same_tail[1], CHOSEN).when((F.col("kind") == GRAM) | same_lead[0] | same_lead[1], GRAM).otherwise(EMPTY)
    edges = buckets.where("edge >= 0").withColumn("kind", kind.cast("tinyint")).where(f"kind <> {EMPTY}").select("did", "kid", "s1", "s2", "kind")
    return inner.unionByName(edges)


def _cut(size: int):
    """Removes what the windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = utf8(batch.column("text"))
            spans, out = batch.column("spans"), []
            for i in range(len(batch)):
                b = buf[offs[i] : offs[i + 1]]
                if not spans[i].is_valid or not len(spans[i].values):
                    out.append((len(b), 0, [], b.tobytes()))
                    continue
                own = spans[i].values
                change = np.zeros(len(b) + 1, np.int32)
                np.add.at(change, own.field("s1").to_numpy(), 1)
                np.add.at(change, own.field("s2").to_numpy() + size, -1)
                gone = np.cumsum(change[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                out.append((len(b), int(gone.sum()), [{"start": int(x), "end": int(y)} for x, y in turns.reshape(-1, 2)], b[~gone].tobytes()))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.binary()]
            cols = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], k) for k in kinds]
            yield pa.record_batch([batch.column("doc_id"), *cols], ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return run


def _merged(gap: int):
    """Ranges of a row's starts, sorted; those that lie no more than gap apart become one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("s1", pa.int32()), ("s2", pa.int32())])
        for batch in batches:
            spans, cuts, firsts, lasts = batch.column("spans"), [0], [], []
            for i in range(len(batch)):
                own = spans[i].values
                s1, s2 = own.field("s1").to_numpy(), own.field("s2").to_numpy()
                order = np.argsort(s1)
                s1, end = s1[order], np.maximum.accumulate(s2[order])
                first = np.flatnonzero(np.append(True, s1[1:] > end[:-1] + gap))
                firsts.append(s1[first])
                lasts.append(end[np.append(first[1:], len(s1)) - 1])
                cuts.append(cuts[-1] + len(first))
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int32), pa.int32()) for x in (firsts, lasts)], fields=list(kind))
            yield pa.record_batch([batch.column("did"), batch.column("kid"), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat)], ["did", "kid", "spans"])

    return run


def _of_rows(spans: DataFrame, gap: int) -> DataFrame:
    """did, kid and the ranges of starts of each row. A long text that repeats as a whole has a range for each byte; they are joined within
    STARTS places first, so that no group holds more than these, and a row little more than its separate ranges."""
    blocks = spans.groupBy("did", "kid", F.expr(f"s1 div {STARTS}").alias("block")).agg(F.collect_set(F.struct("s1", "s2")).alias("spans"))
    joined = in_batches(blocks.select("did", "kid", "spans")).mapInArrow(_merged(gap), "did long, kid long, spans array<struct<s1:int,s2:int>>")
    return joined.groupBy("did", "kid").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 400, anchor: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, spans (removed runs, byte offsets), kept (the remaining bytes).

    Removes each byte covered by a string of min_bytes bytes that also starts anywhere else, in the same document or another; overlaps
    count; strings are judged on the input. Texts are UTF-8 bytes; null counts as empty, and texts shorter than min_bytes lose nothing.
    Rows repeated with their id, and null ids, count as documents of their own. An empty table gives an empty result; further columns are
    ignored. Texts of any length are handled in pieces. The number of buckets grows with the bytes of the texts and with the contested
    windows, so that the part one worker sorts does not.
    """
    anchor = anchor or max(1, min(ANCHOR, min_bytes * 16 // 25))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("did", F.coalesce("doc_id", F.lit(-sys.maxsize - 1))).withColumn("kid", F.xxhash64("doc_id", "text"))
    keys = "lead long, tail long, did long, kid long, s1 int, s2 int"
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    kinds = compared(in_batches(rows.select("did", "kid", "text")).mapInArrow(_anchor_batches(min_bytes, anchor), keys), "anchors", -(-size // BUCKET_BYTES))
    open_kinds = kinds.where(f"kind IN ({GRAM}, {CHOSEN})")
    several = open_kinds.agg(F.sum(F.expr("cast(s2 AS long) - s1 + 1"))).first()[0] or 0
    contested = _of_rows(open_kinds, 1)
    windows = in_batches(rows.select("did", "kid", "text").join(contested, ["did", "kid"]).select("did", "kid", "text", "spans")).mapInArrow(_window_batches(min_bytes), keys)
    repeated = _of_rows(kinds.unionByName(compared(windows, "windows", -(-several // BUCKET_WINDOWS))).where(f"kind >= {FULL}"), min_bytes)
    cut = rows.join(repeated, ["did", "kid"], "left").select("doc_id", "text", "spans")
    return in_batches(cut).mapInArrow(_cut(min_bytes), "doc_id long, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = without_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
