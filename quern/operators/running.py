"""Running sums and positions within keys, where one key may hold most rows.

A window function gives all rows of a key to one task. Here rows are dealt by ranges of key and order, each range sums up its own rows, and the
sum of a key that goes on from one range to the next is handed over: one number for each range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.sources.interim import written


def changes(batch: pa.RecordBatch, keys: list[str], last: tuple | None) -> tuple[np.ndarray, tuple]:
    """Where a row's key differs from the row's before it, and the last row's key; last: the key before the batch. Nulls equal each other."""
    n = len(batch)
    new = np.zeros(n, bool)
    for k in keys:
        codes = pc.dictionary_encode(batch.column(k), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    new[0] = last is None or last != tuple(batch.column(k)[0].as_py() for k in keys)
    return new, tuple(batch.column(k)[n - 1].as_py() for k in keys)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """A table for each run of rows with equal keys, however the runs lie across batches."""
    last, held = None, []
    for batch in batches:
        if not len(batch):
            continue
        new, last = changes(batch, keys, last)
        cuts = [0, *(i for i in np.flatnonzero(new) if i), len(batch)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if new[lo] and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _local(keys: list[str], sums: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, at, head = TaskContext.get().partitionId(), None, 0, True
        carried = dict.fromkeys(sums, 0)
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            new, last = changes(batch, keys, last)
            new[0] &= at > 0  # a range's first row opens nothing: its key may have begun in an earlier range
            first = np.maximum.accumulate(np.where(new, np.arange(n), -1))  # -1: the key goes on from the batch before
            heads = (first < 0) & head
            head = bool(heads[-1])
            columns = []
            for s in sums:
                x = batch.column(s).to_numpy(zero_copy_only=False).astype(np.int64)
                before = np.cumsum(x) - x
                out = before - np.where(first >= 0, before[np.maximum(first, 0)], -carried[s])
                carried[s] = int(out[-1] + x[-1])
                columns.append(pa.array(out))
            where = [pa.array(np.full(n, part, np.int64)), pa.array(np.arange(at, at + n)), pa.array(heads)]
            at += n
            yield pa.record_batch([*batch.columns, *columns, *where], [*batch.schema.names, *(f"_before{s}" for s in sums), "_part", "_at", "_head"])

    return run


def running(df: DataFrame, keys: list[str], order: list[Column], sums: dict[str, Column], position: str | None = None) -> DataFrame:
    """df with, for each name in sums, the sum of the column over the rows before in its key, by order; position: the number of those rows.

    Nulls in a summed column count as 0; rows equal in keys and order come in any order, so order should tell rows apart. Without keys all rows
    are one run. The rows are written once, as the hand-over needs what the ranges hold; broadcast is a row for each range.
    """
    values = {f"_s{i}": F.coalesce(c.cast("long"), F.lit(0)) for i, c in enumerate(sums.values())} | ({"_s": F.lit(1).cast("long")} if position else {})
    names = dict(zip(values, [*sums, *([position] if position else [])], strict=True))
    ranks = {f"_o{i}": c for i, c in enumerate(order)}
    rows = df.withColumns(values)
    dealt = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order) if keys or ranks else rows.coalesce(1)
    new = [*(f"_before{s}" for s in values), "_part", "_at"]
    schema = T.StructType([*dealt.schema.fields, *(T.StructField(c, T.LongType()) for c in new), T.StructField("_head", T.BooleanType())])
    local = written(dealt.mapInArrow(_local(keys, list(values)), schema), "running")

    # one row for each range: its first and last key, whether these are one run, and the sums at its end
    key = F.struct(*keys, F.lit(0)) if keys else F.struct(F.lit(0))
    ends = F.struct(*(F.col(f"_before{s}") + F.col(s) for s in values))
    told = local.groupBy("_part").agg(F.min_by(key, "_at").alias("first"), F.max_by(key, "_at").alias("last"), F.max_by("_head", "_at").alias("one"), F.max_by(ends, "_at").alias("ends"))
    offsets, open_key, so_far = [], None, ()
    for r in sorted(told.collect(), key=lambda r: r["_part"]):
        onward = open_key is not None and tuple(r["first"]) == open_key
        if onward:
            offsets.append((r["_part"], *so_far))
        so_far = tuple(a + b for a, b in zip(so_far, r["ends"], strict=True)) if onward and r["one"] else tuple(r["ends"])
        open_key = tuple(r["last"])
    handed = df.sparkSession.createDataFrame(offsets, ", ".join(["_part long", *(f"_off{s} long" for s in values)]))
    both = local.join(F.broadcast(handed), "_part", "left")
    total = {names[s]: F.col(f"_before{s}") + F.when(F.col("_head"), F.coalesce(f"_off{s}", F.lit(0))).otherwise(0) for s in values}
    return both.withColumns(total).select(*df.columns, *total)
