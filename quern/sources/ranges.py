"""Matches in large log files, read by ranges of bytes: one file spreads over as many tasks as it has ranges.

A match belongs to the range that it begins in. Whether a range begins inside a match can be told from what lies before: a match holds no line end but within
the white space behind its first word, so the search starts behind the last line end that doesn't follow such a beginning, and finds what a search of the
whole file finds. A match is taken to be no longer than 64 KB. What reaches beyond a range, and the surroundings of matches, are read on from there.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quern.operators.progress import AROUND, NEARBY, STEP
from quern.operators.running import running
from quern.sources.interim import written

#: Bytes of a range, and of what is read at once before or behind it; tasks that short ranges are dealt to at least.
RANGE, STEP_BYTES, TASKS = 32 << 20, 1 << 16, 64


class Span(NamedTuple):
    path: str
    start: int
    end: int
    size: int


class Spans(InputPartition):
    """Ranges that follow each other, read by one task: a task for each short range would take longer to start than to read."""

    def __init__(self, spans: list[Span]):
        super().__init__(spans)
        self.spans = spans


def dealt(spans: list[Span], size: int) -> list[Spans]:
    """Tasks of ranges of up to size bytes: RANGE bytes to a task, fewer where there would be less than TASKS tasks."""
    each = max(1, min(RANGE // size, -(-len(spans) // TASKS)))
    return [Spans(spans[i : i + each]) for i in range(0, len(spans), each)]


def _file(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def clear(read: Callable[[int, int], bytes], at: int) -> int:
    """The last place at or before at that no match covers: behind a line end that no match holds, or the file's start."""
    low = at
    while low > 0:
        high, low = low, max(0, low - STEP_BYTES)
        first = max(0, low - AROUND)  # some bytes more, to see what a line end follows
        before = read(first, high)
        for m in reversed(list(re.finditer(rb"[\r\n]", before))):
            said = before[: m.end()].rstrip()
            seen = len(said) >= 6 or first == 0  # the beginning of a match, if there is one, is whole
            if first + m.end() > low and seen and not said.endswith(b"steps:"):
                return first + m.end()
    return 0


def matches(read: Callable[[int, int], bytes], start: int, end: int, size: int) -> Iterator[tuple[int, re.Match, bytes]]:
    """Place, match and surroundings of each match that begins in a range. read(a, b): the file's bytes."""
    base = clear(read, start)
    upto = min(size, end + STEP_BYTES)
    data = read(base, upto)
    at = 0
    while True:
        m = re.compile(STEP).search(data, at)
        if m is None or base + m.start() >= end:
            return
        if m.end() == len(data) and upto < size:  # it may go on
            more = min(size, upto + STEP_BYTES)
            data, upto = data + read(upto, more), more
            continue
        at = m.end()
        if base + m.start() >= start:
            yield base + m.start(), m, read(max(0, base + m.start() - AROUND), min(size, base + m.end() + AROUND))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        given = {k.lower(): v for k, v in options.items()}
        self.path, self.pattern = given["path"], given.get("pattern", "*")
        self.bytes = max(1, int(given.get("rangebytes", RANGE)))

    def partitions(self) -> list[Spans]:
        from pyarrow import fs

        at, path = _file(self.path)
        info = at.get_file_info(path)
        found = [info] if info.type == fs.FileType.File else at.get_file_info(fs.FileSelector(path, recursive=True))
        scheme = self.path[: self.path.index(path)] if path in self.path else ""
        spans = []
        for f in sorted((f for f in found if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, self.pattern)), key=lambda f: f.path):
            spans += [Span(scheme + f.path, a, min(f.size, a + self.bytes), f.size) for a in range(0, f.size, self.bytes)]
        return dealt(spans, self.bytes) or [Spans([])]

    def read(self, partition: Spans) -> Iterator[pa.RecordBatch]:
        for span in partition.spans:
            yield from self._of(span)

    def _of(self, span: Span) -> Iterator[pa.RecordBatch]:
        at, path = _file(span.path)
        with at.open_input_file(path) as f:
            rows = []
            for place, m, context in matches(lambda a, b: f.read_at(b - a, a), span.start, span.end, span.size):
                near = [re.findall(p, context) for p in NEARBY.values()]
                rows.append((span.path, place, int(m[1]), int(m[2]), float(m[3]), *(float(v[-1]) if v else None for v in near)))
                if len(rows) >= 4096:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)


SCHEMA = "path string, place long, step long, total long, loss double, sec_per_step double, runtime double, ts double"
_KINDS = [("path", pa.string()), ("place", pa.int64()), ("step", pa.int64()), ("total", pa.int64()), *((n, pa.float64()) for n in ("loss", "sec_per_step", "runtime", "ts"))]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, k) for x, (_, k) in zip(zip(*rows, strict=True), _KINDS, strict=True)], [n for n, _ in _KINDS])


class LogRanges(DataSource):
    """Step lines of log files. Options: path (a file or a folder, of any store that Arrow knows), pattern (of file names), rangeBytes."""

    @classmethod
    def name(cls) -> str:
        return "log_ranges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def log_matches(spark: SparkSession, path: str, pattern: str = "*.wandb", range_bytes: int = RANGE) -> DataFrame:
    """As progress.log_matches() of whole files, with place, the byte that a match begins at; nth counts the matches of a file over all its ranges."""
    spark.dataSource.register(LogRanges)
    found = spark.read.format("log_ranges").option("path", path).option("pattern", pattern).option("rangeBytes", range_bytes).load()
    found = written(found, "matches")  # to deal them by ranges of place, they are read twice; the logs aren't
    return running(found, ["path"], [F.col("place")], {}, "nth").select("path", F.col("nth").cast("int").alias("nth"), *(n for n, _ in _KINDS[1:]))
