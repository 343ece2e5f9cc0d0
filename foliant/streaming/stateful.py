"""Stateful stream operators: keep-best, signed changes of cells, and retries, one state a key in the state store.

The state store is RocksDB, which holds state on disk and writes its changes to the checkpoint. Every operator clears its
state by timers, so that a key that has been quiet leaves nothing behind; what was put out for it stays right, because sinks
compare orders once more (see foliant.upserts).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _keyed(stream: DataFrame, key: str):
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
    return stream.groupBy(key)


class _Quiet(StatefulProcessor):
    """Clears the state of keys that have had no row for `quiet` milliseconds of event time; 0 keeps it.

    A late row moves no timer back: the timer stands `quiet` after the latest row so far.
    """

    quiet = 0
    time = ""

    def _touch(self, rows: list, timers) -> None:
        if self.quiet and rows:
            own = max(int(getattr(r, self.time).timestamp() * 1000) for r in rows) + self.quiet
            old = [t for t in self.handle.listTimers()]
            if not old or own > max(old):
                for t in old:
                    self.handle.deleteTimer(t)
                self.handle.registerTimer(max(own, timers.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


class _Best(_Quiet):
    def __init__(self, score: str, order: str, quiet: int, time: str) -> None:
        self.score, self.order, self.quiet, self.time = score, order, quiet, time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("best", "score double, first long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best, top, seen = self.state.get(), None, []  # None without one: one call to the store less
        for r in rows:
            own = getattr(r, self.score), getattr(r, self.order)
            if self.quiet:
                seen.append(r)
            if own[0] is not None and (best is None or (own[0], -own[1]) > (best[0], -best[1])):
                best, top = own, r
        self._touch(seen, timerValues)
        if top is not None:
            self.state.update((float(best[0]), int(best[1])))
            yield top


def keep_best_stream(stream: DataFrame, key: str, score: str, order: str, *, time: str = "", quiet_ms: int = 0) -> DataFrame:
    """The best row so far of every key that a batch has rows of: by score, the earliest by `order` on ties. The last one that
    is put out for a key is the batch's `keep_best`. Rows without a score are left out; `order` is a whole number.

    Without quiet_ms this is a built-in aggregation, partial before its shuffle and without Python; with it, keys have timers,
    and a row is put out only as it becomes the best.

    quiet_ms: event time (`time`, which needs a watermark) after which a key that has no rows is forgotten; a later row of
    it is put out again if it is the best of those after.
    """
    if quiet_ms:
        return _keyed(stream, key).transformWithState(_Best(score, order, quiet_ms, time), stream.schema, "Update", "EventTime")
    rows = stream.where(F.col(f"`{score}`").isNotNull())
    whole = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    best = F.max_by(whole, F.struct(F.col(f"`{score}`"), -F.col(f"`{order}`")))
    return _keyed(rows, key).agg(best.alias("__row")).select("__row.*")


class _Changes(_Quiet):
    def __init__(self, order: str, cell: list[str], quiet: int, time: str) -> None:
        self.order, self.cell, self.quiet, self.time = order, cell, quiet, time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("now", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = self.state.get()
        before, seen = now, []
        for r in rows:
            if self.quiet:
                seen.append(r)
            if now is None or getattr(r, self.order) > now[0]:
                now = (getattr(r, self.order), *(getattr(r, c) for c in self.cell))
        self._touch(seen, timerValues)
        if now is not before:
            self.state.update(tuple(now))
            if before is None or tuple(before[1:]) != tuple(now[1:]):
                if before is not None:
                    yield Row(**dict(zip(self.cell, before[1:], strict=True)), n=-1)
                yield Row(**dict(zip(self.cell, now[1:], strict=True)), n=1)


def cell_changes(stream: DataFrame, key: str, order: str, cell: list[str]) -> DataFrame:
    """Signed changes (cell columns, n) of counts: when a key's row changes, its old cell loses one and its new one gains one.

    A row counts if its `order` is above that of all rows of its key before; equal orders keep the first. Summed up, the
    changes are the counts of all keys' last rows, after any sequence of rows.
    """
    kinds = {f.name: f.dataType for f in stream.schema.fields}
    processor = _Changes(order, cell, 0, "")
    fields = StructType()
    for c in cell:
        fields = fields.add(c, kinds[c])
    state = StructType().add("order", kinds[order])
    for c in cell:
        state = state.add(c, kinds[c])
    processor.schema = state
    return _keyed(stream, key).transformWithState(processor, fields.add("n", "long"), "Update", "None")


class _Retries(StatefulProcessor):
    """tries, status and the time of the next try of each task."""

    def __init__(self, most: int, backoff: int, forget: int) -> None:
        self.most, self.backoff, self.forget = most, backoff, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("task", "tries int, status string, due long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        tries, status, due = self.state.get() if self.state.exists() else (0, "pending", 0)
        for r in sorted(rows, key=lambda r: r.order):
            if status != "pending":
                break  # success and other failures are final
            tries += 1
            at = int(r.time.timestamp() * 1000)
            status, due = r.outcome, 0
            if r.outcome == "no_record" and tries <= self.most:
                status, due = "pending", at + (self.backoff << (tries - 1))
        for t in [t for t in self.handle.listTimers()]:
            self.handle.deleteTimer(t)
        self.handle.registerTimer(max(due or timerValues.getCurrentWatermarkInMs() + self.forget, timerValues.getCurrentWatermarkInMs() + 1))
        self.state.update((tries, status, due))
        yield Row(title=key[0], tries=tries, status=status, due=due or None, event="outcome")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists():
            tries, status, due = self.state.get()
            if status == "pending":
                yield Row(title=key[0], tries=tries, status=status, due=due, event="due")
            else:
                self.state.clear()

    def close(self) -> None:
        pass


def retry_stream(outcomes: DataFrame, *, most: int = 2, backoff_ms: int = 60_000, forget_ms: int = 86_400_000) -> DataFrame:
    """title, tries, status, due (milliseconds) and event of tasks, from a stream of (title, order, outcome, time).

    Outcomes of a task count by `order` within a batch. 'no_record' is tried again, `most` times, each after twice the time
    of the one before: its task is pending, and when the time has come an event 'due' asks for the try. Success and other
    failures are final; finished tasks are forgotten. `time` needs a watermark, which is the clock.
    """
    return _keyed(outcomes, "title").transformWithState(_Retries(most, backoff_ms, forget_ms), "title string, tries int, status string, due long, event string", "Update", "EventTime")


def with_millis(stream: DataFrame, time: str, late: str) -> DataFrame:
    """A stream whose column of time is a timestamp with a watermark."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
