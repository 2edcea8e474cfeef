"""The run guard as a stream over rows that come late and out of order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from ..workers import ready

OUTPUT = "run string, seq long, reason string"
#: A run's counters, the earliest time in ms at which it is woken, whether rows wait by slot too, and the rows that wait here.
STATE = "streak long, processed long, failed long, done boolean, wake long, by_slot boolean, rows binary"
FRESH = (0, 0, 0, False, None, False, b"")
#: Rows of a run that wait beside its counters; when they are more they go into slots.
HELD = 1 << 16
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Kinds that count; a row waits as its time, its place and the number of its kind.
KINDS = {"throttle": 0, "stored": 1, "plain": 1, "completed": 2, "skipped": 2, "failed": 3}
ROW = np.dtype([("us", "<i8"), ("seq", "<i8"), ("code", "i1")])


def first_stop(rows: np.ndarray, streak: int, processed: int, failed: int) -> tuple[tuple[int, str] | None, tuple[int, int, int]]:
    """Where a stop rule first holds in rows of a run, and its counters after them. Rows are counted by time, then place."""
    rows = rows[np.lexsort((rows["seq"], rows["us"]))]
    throttles = streak + np.cumsum(rows["code"] == 0)
    streaks = throttles - np.maximum.accumulate(np.where(rows["code"] == 1, throttles, 0))
    done, bad = processed + np.cumsum(rows["code"] >= 2), failed + np.cumsum(rows["code"] == 3)
    throttled, failures = streaks >= 3, (bad >= 3) & (bad * 10 > done)
    at = np.flatnonzero(throttled | failures)
    stop = (int(rows["seq"][at[0]]), "throttled" if throttled[at[0]] else "failures") if len(at) else None
    return stop, (int(streaks[-1]), int(done[-1]), int(bad[-1]))


class _Guard(StatefulProcessor):
    """A run's rows wait until the watermark has passed the end of their slot of time, so nothing can come before them any more.

    Each call to the state store costs more than many rows do. So a run that has few rows keeps them beside its counters, in one value, and
    is woken at the end of its first slot only; HELD rows or more are dealt to their slots, which are read one at a time.
    """

    def __init__(self, slot_us: int) -> None:
        self.slot_us = slot_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE)
        self.waiting = handle.getMapState("waiting", "slot long", "rows binary")

    def _wake(self, wake: int | None, slot: int) -> int:
        """The run's next time, no later than the end of a slot."""
        over = (slot + 1) * self.slot_us // 1000
        if wake is not None and wake <= over:
            return wake
        self.handle.registerTimer(over)
        return over

    def _deal(self, rows: np.ndarray) -> None:
        slots = rows["us"] // self.slot_us
        for slot in np.unique(slots).tolist():
            before = bytes(self.waiting.getValue((slot,))[0]) if self.waiting.containsKey((slot,)) else b""
            self.waiting.updateValue((slot,), (before + rows[slots == slot].tobytes(),))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        streak, processed, failed, done, wake, by_slot, held = self.state.get() or FRESH
        stopped, parts, n, first = key[0] is None or done, [bytes(held)], len(held) // ROW.itemsize, None
        for batch in rows:  # read to the end, whatever comes of it
            counted = batch["code"].to_numpy() >= 0
            if stopped or not counted.any():
                continue
            new = np.empty(int(counted.sum()), ROW)
            for name in ROW.names:
                new[name] = batch[name].to_numpy()[counted]
            least = int(new["us"].min()) // self.slot_us
            first = least if first is None else min(first, least)
            parts.append(new.tobytes())
            n += len(new)
            if n > HELD:
                self._deal(np.frombuffer(b"".join(parts), ROW))
                parts, n, by_slot = [], 0, True
        if first is not None:
            self.state.update((streak, processed, failed, False, self._wake(wake, first), by_slot, b"".join(parts)))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Every slot that is over, in order; a timer whose slots an earlier one has counted finds nothing."""
        streak, processed, failed, done, wake, by_slot, held = self.state.get() or FRESH
        if done:
            return iter(())
        over, counts, stop = timerValues.getCurrentWatermarkInMs() * 1000 // self.slot_us, (streak, processed, failed), None
        rows = np.frombuffer(bytes(held), ROW)
        slots = rows["us"] // self.slot_us
        left = rows[slots >= over]
        later = slots[slots >= over].tolist()
        if by_slot:
            known = {k[0] for k in list(self.waiting.keys())}
            later += [x for x in known if x >= over]
            for slot in sorted({x for x in known if x < over}.union(slots[slots < over].tolist())):
                there = bytes(self.waiting.getValue((slot,))[0]) if slot in known else b""
                stop, counts = first_stop(np.concatenate((np.frombuffer(there, ROW), rows[slots == slot])), *counts)
                if stop:
                    break
                if slot in known:
                    self.waiting.removeKey((slot,))
            by_slot = any(x >= over for x in known)
        elif len(left) < len(rows):
            stop, counts = first_stop(rows[slots < over], *counts)
        if stop:
            self.waiting.clear()
            self.state.update((*counts, True, None, False, b""))
            return iter([pd.DataFrame([(key[0], *stop)], columns=["run", "seq", "reason"])])
        self.state.update((*counts, False, self._wake(None, min(later)) if later else None, by_slot, left.tobytes()))
        return iter(())

    def close(self) -> None:
        pass


def stream_guard(log: DataFrame, delay: str = "10 minutes", slot_seconds: int = 60) -> DataFrame:
    """(run, seq, reason) of a stream log(run, seq, kind, at): where each run first must stop, its rows counted by time and then by place.

    Rows may come in any order as long as none falls behind the latest time of earlier micro-batches, of whichever run, by more than delay;
    Spark leaves out those that do and counts them in the query's progress. A stop is given once the watermark has passed the end of its slot
    of slot_seconds, so a stream that ends needs a row of a later time: a row without a run, a place or a counted kind only moves the
    watermark. A row without a time counts nowhere. A run holds the slots that are not over; a task has one slot of one run and HELD rows in memory. The session's state
    store becomes RocksDB, which timers need.
    """
    ready(log.sparkSession)
    log.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    at, seq = F.col("at").cast("timestamp"), F.col("seq").cast("long")
    code = F.coalesce(*[F.when((F.col("kind") == k) & at.isNotNull() & seq.isNotNull(), n) for k, n in KINDS.items()], F.lit(-1))
    rows = log.select("run", at.alias("at"), F.coalesce(F.unix_micros(at), F.lit(0)).alias("us"), F.coalesce(seq, F.lit(0)).alias("seq"), code.cast("byte").alias("code"))
    return rows.withWatermark("at", delay).groupBy("run").transformWithStateInPandas(_Guard(slot_seconds * 1_000_000), OUTPUT, "append", "EventTime")


def run_to_table(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Everything that is there now, into a table in memory; for tests and small results."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
