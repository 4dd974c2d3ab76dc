"""Greedy batches under a budget.

Whether a row opens a batch depends on the batches before, so no window frame expresses it. Keys with few rows are dealt by key, sorted within partitions,
and streamed through a fold that keeps two numbers. A key with many rows spreads over tasks instead. With the running sum of sizes, the row that opens the
next batch after one opened by row i is the first whose sum exceeds that before i plus the budget, which a binary search finds; from any row, pointer
doubling leads to the last batch that its block of rows opens. A block's first batch can only be opened within one budget of its start, so these few rows
tell all that later blocks need; a chain through them, one block after another, gives each block the batch that is open when it begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import text as X
from quern.operators.running import grouped, running

#: Rows above which a key is spread over blocks, and rows of a block; characters of joined texts that are handed on at once.
LONG, BLOCK, SLICE = 1 << 15, 1 << 13, 1 << 20


def _fold(budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, number, used, rows = object(), 0, 0, 0
        for batch in batches:
            ids = np.empty(len(batch), np.int64)
            keys, sizes = batch.column("_key").to_pylist(), batch.column("_size").to_pylist()
            for i, (k, size) in enumerate(zip(keys, sizes, strict=True)):
                if k != key:
                    key, number, used, rows = k, 0, 0, 0
                elif rows and used + size > budget:
                    number, used, rows = number + 1, 0, 0
                used, rows = used + size, rows + 1
                ids[i] = number
            yield pa.record_batch([*batch.columns, pa.array(ids)], [*batch.schema.names, "batch_id"])

    return run


def _pack(key: str, text: str, budget: int):
    """key, batch_id and the joined text of each batch of sorted rows (also _size), by the same rule as _fold()'s: a task holds one batch and a slice of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, number, used, held, kind = object(), 0, 0, [], None
        keys, ids, texts, size = [], [], [], 0

        def close() -> None:
            nonlocal size
            keys.append(last)
            ids.append(number)
            texts.append("".join(held))
            size += used

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(keys, kind), pa.array(ids, pa.int64()), pa.array(texts, pa.string())], [key, "batch_id", "text"])

        for batch in batches:
            kind = batch.schema.field(key).type
            for k, said, n in zip(*(batch.column(c).to_pylist() for c in (key, text, "_size")), strict=True):
                if held and (k != last or used + n > budget):
                    close()
                    number, used, held = number + 1, 0, []
                    if size > SLICE:
                        yield out()
                        keys, ids, texts, size = [], [], [], 0
                if k != last:
                    last, number = k, 0
                used += n
                held.append(said or "")
        if held:
            close()
        if keys:
            yield out()

    return run


def _next(before: np.ndarray, ends: np.ndarray, budget: int) -> np.ndarray:
    """Of each row the one that opens the next batch if it opens one itself; the number of rows if that lies behind the block."""
    return np.maximum(np.arange(1, len(ends) + 1), np.searchsorted(ends, before + budget, "right"))


def _sums(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    before = block.column("_before").to_numpy()
    return before, before + block.column("_size").to_numpy()


def _exits(budget: int):
    """For each row of a block that may open its first batch: the running sum at its end, the sum that the block's last batch reaches to, and how many
    batches the block opens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in grouped(batches, ["_key", "_block"]):
            before, ends = _sums(block)
            n = len(ends)
            jump, count, last = np.append(_next(before, ends, budget), n), np.append(np.ones(n, np.int64), 0), np.arange(n + 1)
            while (jump < n).any():  # twice as far each time
                count, last, jump = count + count[jump], np.where(jump < n, last[jump], last), jump[jump]
            may = np.flatnonzero((before <= before[0] + budget) & (ends > before))
            may = may[:0] if block.column("_block")[0].as_py() == 0 else may
            may = np.union1d([0], may)
            at = pa.array(may)
            yield pa.record_batch([block.column("_key").combine_chunks().take(at), block.column("_block").combine_chunks().take(at), pa.array(ends[may]), pa.array(before[last[may]] + budget), pa.array(count[may])], ["_key", "_block", "_end", "_reach", "_count"])

    return run


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block of a key, in order: the sum that the batch open at its start reaches to, and the number of batches opened before."""
    for block, first in _blocks(batches):
        if first:
            reach, opened = -1, 0
        yield pa.record_batch([block.column("_key")[:1].combine_chunks(), block.column("_block")[:1].combine_chunks(), pa.array([reach], pa.int64()), pa.array([opened], pa.int64())], ["_key", "_block", "_reach", "_opened"])
        i = int(np.searchsorted(block.column("_end").to_numpy(), reach, "right"))
        if i < len(block):
            reach, opened = block.column("_reach")[i].as_py(), opened + block.column("_count")[i].as_py()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, bool]]:
    for block in grouped(batches, ["_key", "_block"]):
        yield block, block.column("_block")[0].as_py() == 0  # every key has a first block


def _numbered(budget: int):
    """Adds batch_id to the rows of each block, from what is open when it begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in grouped(batches, ["_key", "_block"]):
            before, ends = _sums(block)
            to = _next(before, ends, budget)
            opens = np.zeros(len(ends), np.int64)
            i = int(np.searchsorted(ends, block.column("_reach")[0].as_py(), "right"))
            while i < len(ends):
                opens[i] = 1
                i = to[i]
            ids = block.column("_opened")[0].as_py() - 1 + np.cumsum(opens)
            yield from block.drop_columns(["_reach", "_opened"]).append_column("batch_id", pa.array(ids)).combine_chunks().to_batches()

    return run


def _long_batches(rows: DataFrame, order: list[str], budget: int, block: int) -> DataFrame:
    """greedy_batches() of rows (_key, _size, all others) that come in blocks: no task holds more than some blocks, however many rows a key has."""
    summed = running(rows, ["_key"], [F.col(c) for c in order], {"_before": F.col("_size")}, "_pos").withColumn("_block", F.floor(F.col("_pos") / block))
    place, by = ["_key", "_block"], ["_key", "_block", "_pos"]
    kind = rows.schema["_key"]
    long_ = lambda *names: [T.StructField(n, T.LongType()) for n in names]
    dealt = summed.select(*by, "_before", "_size").repartition(*place).sortWithinPartitions(*by)
    exits = dealt.mapInArrow(_exits(budget), T.StructType([kind, *long_("_block", "_end", "_reach", "_count")]))
    chained = exits.repartition("_key").sortWithinPartitions("_key", "_block", "_end").mapInArrow(_chain, T.StructType([kind, *long_("_block", "_reach", "_opened")]))
    starts = chained.select(F.col("_key").alias("_k"), F.col("_block").alias("_b"), "_reach", "_opened")  # a row for each block
    both = summed.join(starts, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_block") == F.col("_b"))).drop("_k", "_b")
    dealt = both.repartition(*place).sortWithinPartitions(*by)
    schema = T.StructType([*(f for f in dealt.schema.fields if f.name not in ("_reach", "_opened")), *long_("batch_id")])
    return dealt.mapInArrow(_numbered(budget), schema).drop("_before", "_pos", "_block")


def _sized(df: DataFrame, key: str, size: Column, long: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """df with _key and _size; of it the rows of keys up to long rows, and, if there are any, those of longer ones."""
    rows = df.withColumns({"_key": F.col(key), "_size": F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0))})
    many = rows.groupBy("_key").agg(F.count("*").alias("_n")).where(F.col("_n") > long).select(F.col("_key").alias("_many"))
    if many.isEmpty():
        return rows, rows, None
    on = F.col("_key").eqNullSafe(F.col("_many"))
    return rows, rows.join(many, on, "left_anti"), rows.join(many, on, "left_semi")


def greedy_batches(df: DataFrame, key: str, order: list[str], size: Column, budget: int, long: int = LONG, block: int = BLOCK) -> DataFrame:
    """Adds batch_id, from 0 on for each key: a row opens a batch if the open one isn't empty and would exceed the budget (1 at least).

    Null sizes, and those below 0, count as 0; a null key is a key; rows equal in key and order come in any order. Keys of more than long rows go in blocks,
    the others by a fold, with the same result; whether there are any such keys is looked up first."""
    budget = max(1, budget)
    rows, few, many = _sized(df, key, size, long)
    whole = T.StructType([*rows.schema.fields, T.StructField("batch_id", T.LongType())])
    out = few.repartition("_key").sortWithinPartitions("_key", *order).mapInArrow(_fold(budget), whole)
    if many is not None:
        out = out.unionByName(_long_batches(many, order, budget, block))
    return out.drop("_key", "_size")


def packed_rows(sentences: DataFrame, key: str, order: str, text: str, size: int, long: int = LONG, block: int = BLOCK) -> DataFrame:
    """key, id, text: neighbouring sentences, a row each, joined without separator while they fit into size characters; one that is too long stays whole.
    As segments.packed_sentences(), for documents that are too long for one row. Sentences of keys up to long rows are moved once and joined by the fold."""
    size = max(1, size)
    rows, few, many = _sized(sentences.select(key, order, text), key, F.length(text), long)
    schema = T.StructType([rows.schema[key], T.StructField("batch_id", T.LongType()), T.StructField("text", T.StringType())])
    packed = few.repartition("_key").sortWithinPartitions("_key", order).select(key, text, "_size").mapInArrow(_pack(key, text, size), schema)
    if many is not None:
        each = F.array_sort(F.collect_list(F.struct(order, text)))  # size characters at most, or one sentence
        batched = _long_batches(many, [order], size, block).groupBy(key, "batch_id")
        packed = packed.unionByName(batched.agg(F.array_join(F.transform(each, lambda r: r[text]), "").alias("text")))
    return packed.select(key, (F.col("batch_id") + 1).alias("id"), "text")


def stripped_length(*cols: str) -> Column:
    total = F.lit(0)
    for c in cols:
        total = total + F.length(X.strip(F.coalesce(F.col(c), F.lit(""))))
    return total


def batch_stats(batched: DataFrame, key: str, size: Column) -> DataFrame:
    """Of each key: batches, most rows in one, most characters in one; a key without rows has none, so totals start from 0."""
    per = batched.groupBy(key, "batch_id").agg(F.count("*").alias("n"), F.sum(size).alias("chars"))
    return per.groupBy(key).agg(F.count("*").alias("batches"), F.coalesce(F.max("n"), F.lit(0)).alias("max_rows"), F.coalesce(F.max("chars"), F.lit(0)).alias("max_chars"))
