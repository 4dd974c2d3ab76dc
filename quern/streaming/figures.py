"""Figures that a stream keeps of each key: its latest record, the exact median of a value, and its tier as it stays unused.

State is bounded: one record, one count for each different value (values are rounded to a resolution, so there are as many as its range has steps), and one
time. A timer per key tells when it has been unused for long.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000


class Figures(StatefulProcessor):
    """Rows key, at (milliseconds), id, value; emits for each key of a batch: key, n, latest_at, latest_id, latest_value, median."""

    def __init__(self, resolution: float):
        self.resolution = resolution

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "at long, id long, value double")
        self.bins = handle.getMapState("bins", "bin long", "n long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803  names that Spark gives
        best = tuple(self.latest.get()) if self.latest.exists() else None
        new: Counter[int] = Counter()
        for r in rows:
            best = max(best or (r["at"], r["id"], r["value"]), (r["at"], r["id"], r["value"]), key=lambda x: x[:2])
            if r["value"] is not None:
                new[round(r["value"] / self.resolution)] += 1
        self.latest.update(best)
        counts = Counter({k[0]: v[0] for k, v in self.bins.iterator()})
        for b, n in new.items():
            counts[b] += n
            self.bins.updateValue((b,), (counts[b],))
        yield Row(key=key[0], n=sum(counts.values()), latest_at=best[0], latest_id=best[1], latest_value=best[2], median=self._median(counts))

    def _median(self, counts: Counter) -> float | None:
        n, seen, middle = sum(counts.values()), 0, []
        for b in sorted(counts):
            middle += [b] * ((seen <= (n - 1) // 2 < seen + counts[b]) + (seen <= n // 2 < seen + counts[b]))
            seen += counts[b]
        return sum(middle) / 2 * self.resolution if middle else None

    def close(self) -> None:
        pass


class Tiers(StatefulProcessor):
    """Rows key, at (milliseconds, the event time); emits key, tier, since: HOT with a key's first use and when it is used again, WARM and COLD when it has
    stayed unused for so many days. What a batch brings is taken in order, so how uses are dealt over batches makes no difference."""

    def __init__(self, warm_days: int, cold_days: int):
        self.after = [("WARM", warm_days * DAY_MS), ("COLD", cold_days * DAY_MS)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long, told int")

    def _told(self, key, at: int, told: int, until: int) -> tuple[list[Row], int]:
        """The tiers that a key last used at some time reaches before another time, but for those told already."""
        out = []
        for i, (tier, wait) in enumerate(self.after):
            if i >= told and at + wait <= until:
                out.append(Row(key=key[0], tier=tier, since=at + wait))
                told = i + 1
        return out, told

    def _wait(self, at: int, told: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
        if told < len(self.after):
            self.handle.registerTimer(at + self.after[told][1])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        at, told = tuple(self.last.get()) if self.last.exists() else (None, 0)
        for now in sorted(r["at"] for r in rows):
            if at is None:
                yield Row(key=key[0], tier="HOT", since=now)
            elif now > at:
                reached, told = self._told(key, at, told, now - 1)
                yield from reached
                if told:
                    yield Row(key=key[0], tier="HOT", since=now)
            else:  # of a time before the last use
                continue
            at, told = now, 0
        self.last.update((at, told))
        self._wait(at, told)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        at, told = tuple(self.last.get())
        reached, told = self._told(key, at, told, expiredTimerInfo.getExpiryTimeInMs())
        self.last.update((at, told))
        if told < len(self.after):
            self.handle.registerTimer(at + self.after[told][1])
        yield from reached

    def close(self) -> None:
        pass


def _with_rocks(spark: SparkSession, run: Callable[[], None]) -> None:
    """Runs a stream with the state store that keeps several states and timers for a key."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        run()
    finally:
        spark.conf.set(PROVIDER, before) if before is not None else spark.conf.unset(PROVIDER)


def kept_figures(rows: DataFrame, key: str, at: str, id_: str, value: str, out: str, checkpoint: str, resolution: float = 0.01) -> None:
    """Goes through what a stream has; out gets, with the number of the batch, the figures of the keys that a batch has touched. at: milliseconds."""
    kind = dict(rows.dtypes)[key]
    given = rows.selectExpr(f"{key} AS key", f"{at} AS at", f"{id_} AS id", f"{value} AS value")
    figures = given.groupBy("key").transformWithState(Figures(resolution), f"key {kind}, n long, latest_at long, latest_id long, latest_value double, median double", "Update", "None")
    _saved(figures, out, checkpoint)


def kept_tiers(rows: DataFrame, key: str, ts: str, out: str, checkpoint: str, warm_days: int, cold_days: int, late: str = "0 seconds") -> None:
    """Goes through what a stream has; out gets the tiers that keys reach, with the number of the batch. A tier is told once the watermark has passed it."""
    kind = dict(rows.dtypes)[key]
    timed = rows.selectExpr(f"{key} AS key", f"CAST({ts} AS timestamp) AS time").withWatermark("time", late)
    given = timed.selectExpr("key", "time", "unix_millis(time) AS at")
    tiers = given.groupBy("key").transformWithState(Tiers(warm_days, cold_days), f"key {kind}, tier string, since long", "Append", "EventTime")
    _saved(tiers, out, checkpoint)


def _saved(stream: DataFrame, out: str, checkpoint: str) -> None:
    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    def run() -> None:
        query = stream.writeStream.foreachBatch(save).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()

    _with_rocks(stream.sparkSession, run)
