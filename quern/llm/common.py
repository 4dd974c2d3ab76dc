"""What the corpus operators share: Arrow text as byte buffers, vectorised fingerprints, written tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.sources.interim import drop_written, shared_dir, written  # noqa: F401

#: Bytes that the vectorised code handles at once; its arrays hold eight bytes or more for each.
CHUNK = 1 << 18
#: Bytes of an Arrow batch that goes to a worker at once.
BATCH_BYTES = 8 << 20

A_TO_Z, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col):
    """Lower-cases A-Z only. Pure ASCII texts take the fast path, where lower() does just that."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, A_TO_Z, LOWER))


def in_batches(df: DataFrame) -> DataFrame:
    """df, for mapInArrow. Sees to it that batches are bounded by bytes, not by rows alone: ten thousand rows of long texts wouldn't fit."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = df.sparkSession.conf.get(key, None)
    if now is None or now.startswith("-") or not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BATCH_BYTES:
        df.sparkSession.conf.set(key, str(BATCH_BYTES))
    return df


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null counts as empty."""
    col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"").cast(pa.large_binary())
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64)[col.offset : col.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def unused(df: DataFrame, name: str) -> str:
    """The name, longer by underscores as long as df has a column of that name, upper and lower case aside."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def chunks(offs: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about size bytes each; a longer row comes alone."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = j


def stretches(buf: np.ndarray, lo: int, hi: int, ends: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """buf[lo:hi] in stretches of about size bytes that end behind a byte of the class ends, where there is one; one stretch if it's short."""
    while hi - lo > 2 * size:
        at = lo + size
        while at < hi and not len(hit := np.flatnonzero(ends[buf[at : min(hi, at + size)]])):
            at += size
        stop = at + int(hit[0]) + 1 if at < hi else hi
        yield lo, stop
        lo = stop
    if lo < hi:
        yield lo, hi


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Fingerprints:
    """Polynomial fingerprints, modulo 2^64, of any slice of a buffer in constant time. Each byte stands for a random value."""

    _tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, buf: np.ndarray, seed: int):
        n = len(buf)
        rng = np.random.default_rng(seed)
        values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        base = int(rng.integers(1 << 40, 1 << 62)) * 8 + 5
        have = Fingerprints._tables.get(seed)
        if have is None or len(have[0]) <= n:
            size = max(n + 1, CHUNK + 4096)
            up, down = np.full(size, base % (1 << 64), np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            have = np.multiply.accumulate(up), np.multiply.accumulate(down)
            if size <= 2 * CHUNK:
                Fingerprints._tables[seed] = have
        up, self.down = have
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[buf] * up[:n], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        """start, end: arrays, or slices of the same length."""
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32


def words(buf: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the runs of bytes that are no white space."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~space[buf]
    begins, ends = np.empty(n, bool), np.empty(n, bool)
    begins[0], ends[-1] = solid[0], solid[-1]
    np.logical_and(solid[1:], ~solid[:-1], out=begins[1:])
    np.logical_and(solid[:-1], ~solid[1:], out=ends[:-1])
    cuts = offs[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]  # where a row ends and another begins
    begins[cuts] |= solid[cuts]
    ends[cuts - 1] |= solid[cuts - 1]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(offs, s, "right") - 1
