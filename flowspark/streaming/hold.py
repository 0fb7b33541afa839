"""Hold times of alert rules on a stream of evaluated conditions, with event-time timers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.series import SECOND
from ..session import ship_package

_STATE = "since bigint, firing boolean, last bigint, timer bigint, waiting binary"
_NONE = np.iinfo(np.int64).min
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def hold_stream(
    points: DataFrame,
    *,
    for_s: float,
    silent_s: float | None = None,
    delay: str = "1 minute",
    forget_s: float = 86_400,
    by: Sequence[str] = ("rule", "series"),
) -> DataFrame:
    """Transitions ``(by, since_us, us, state, condition)`` of ``(by, us, condition)`` points.

    Points wait until the watermark, ``delay`` behind the newest point of all keys, has
    passed them, and are then taken in the order of their time. A true stretch turns
    ``firing`` at its first point at least ``for_s`` after its start and ``resolved`` at the
    next false one. With ``silent_s``, a key that stays silent longer resolves that
    long after its last point; a timer sees to it even if no point ever follows. Points
    at or behind the watermark in force when they arrive come out as ``late`` with their
    condition and change nothing. Points of one time are one: true if any of them is; NULL is false.

    The state of a key is its open stretch and the points still waiting, so it is bounded by
    the delay; it is dropped ``forget_s`` after the last point. All of a batch's points of a key are
    handled at once, without a loop over them. Needs the RocksDB state store, which is set here.
    """
    spark = points.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    keys = list(by)
    out = ", ".join(f"{k} string" for k in keys) + ", since_us bigint, us bigint, state string, condition boolean"
    rows = points.withColumn("_at", F.timestamp_micros("us")).withWatermark("_at", delay)
    # without the time column the operator drops nothing by itself: late points are for the processor to tell
    rows = rows.select(*[F.col(k).cast("string") for k in keys], "us", F.coalesce("condition", F.lit(False)).alias("condition"))
    processor = Hold(keys, int(for_s * SECOND), None if silent_s is None else int(silent_s * SECOND), int(forget_s * SECOND))
    return rows.groupBy(*keys).transformWithStateInPandas(processor, out, "append", "eventTime")


class Hold(StatefulProcessor):
    def __init__(self, keys: list[str], reach: int, silent: int | None, forget: int) -> None:
        self.keys, self.reach, self.silent, self.forget = keys, reach, silent, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("hold", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        us, on = [], []
        for b in rows:
            late = b[b.us <= passed] if passed > 0 else b.iloc[:0]
            if len(late):
                yield self._rows(key, None, late.us, "late", late.condition)
            kept = b.drop(late.index)
            us.append(kept.us.to_numpy(np.int64))
            on.append(kept.condition.to_numpy(bool))
        yield from self._advance(key, passed, np.concatenate(us), np.concatenate(on))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        yield from self._advance(key, passed, np.zeros(0, np.int64), np.zeros(0, bool), expiredTimerInfo.getExpiryTimeInMs())

    def close(self) -> None: ...

    def _rows(self, key, since, us, state: str, condition) -> pd.DataFrame:
        columns = dict(zip(self.keys, key))
        since = pd.array([None] * len(us), "Int64") if since is None else pd.array(since, "Int64")
        rest = {"since_us": since, "us": np.asarray(us), "state": state, "condition": np.asarray(condition, bool)}
        return pd.DataFrame({**{k: [v] * len(us) for k, v in columns.items()}, **rest})

    def _advance(self, key, passed: int, us: np.ndarray, on: np.ndarray, expired: int | None = None) -> Iterator[pd.DataFrame]:
        """Take in new points, handle those that the watermark has passed, and set the next timer."""
        since, firing, last, timer, waiting = self.state.get() if self.state.exists() else (None, False, None, None, b"")
        n = len(waiting) // 9
        us = np.concatenate([np.frombuffer(waiting, np.int64, n), us])
        on = np.concatenate([np.frombuffer(waiting, bool, n, 8 * n), on])
        if len(us):  # one point per time
            us, at = np.unique(us, return_inverse=True)
            on = np.bincount(at, on, len(us)) > 0
        ready = us <= passed
        if ready.any():
            found, since, firing, last = transitions(us[ready], on[ready], since, firing, last, self.reach, self.silent)
            for state, (begin, time) in found.items():
                if len(time):
                    yield self._rows(key, begin, time, state, np.full(len(time), state == "firing"))
            us, on = us[~ready], on[~ready]
        if since is not None and self.silent is not None and last + self.silent <= passed:
            if firing:
                yield self._rows(key, [since], [last + self.silent], "resolved", [False])
            since, firing = None, False
        due = [int(us[0])] if len(us) else []
        if since is not None and self.silent is not None:
            due.append(last + self.silent)
        elif since is None and last is not None:
            due.append(last + self.forget)
        new = -(-min(due) // 1000) if due else None
        if timer is not None and timer not in (new, expired):
            self.handle.deleteTimer(timer)
        if since is None and not len(us) and last is not None and last + self.forget <= passed:
            self.state.clear()
            return
        if new is not None and new != timer:
            self.handle.registerTimer(new)
        self.state.update((since, firing, last, new, us.tobytes() + on.tobytes()))


def transitions(t: np.ndarray, on: np.ndarray, since: int | None, firing: bool, last: int | None, reach: int, silent: int | None):
    """What points in the order of their time bring about, and the state after them.

    ``since`` is the start of the open stretch, ``last`` the time of the point before.
    """
    before = np.concatenate([[t[0] if last is None else last], t[:-1]])
    was_on = np.concatenate([[since is not None], on[:-1]])
    gap = (t - before > silent) if silent is not None else np.zeros(len(t), bool)
    begins = on & (~was_on | gap)
    starts = np.maximum.accumulate(np.concatenate([[_NONE if since is None else since], np.where(begins, t, _NONE)]))
    start, start_before = starts[1:], starts[:-1]
    held = on & (start > _NONE)
    held[held] = t[held] - start[held] >= reach
    was_held = np.concatenate([[firing], held[:-1]])
    first = held & (begins | ~was_held)
    ended = was_on & (~on | gap) & was_held
    over = np.where(gap, before + (silent or 0), t)
    found = {"firing": (start[first], t[first]), "resolved": (start_before[ended], over[ended])}
    return found, int(start[-1]) if on[-1] else None, bool(held[-1]), int(t[-1])
