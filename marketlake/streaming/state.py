"""Keyed stream operators with timers: absence as a row (X6, X7) and alert suppression.

Each is a `StatefulProcessor` for `transformWithStateInPandas`.  State is a few numbers per key in the
session's state store; a timer, not a new row, ends a silence or a low rate, so a key that stops sending is reported
without any input of its own.  Rows of a key in one micro-batch are handled together: bound them by the source's
limits per trigger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import schemas
from ..session import share_package

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_state_store(spark: SparkSession) -> None:
    """Timers and typed state need the RocksDB provider; a provider that the session names is left as it is."""
    name = "spark.sql.streaming.stateStore.providerClass"
    if "HDFSBackedStateStoreProvider" in spark.conf.get(name, "HDFSBackedStateStoreProvider"):
        spark.conf.set(name, ROCKSDB)


def _us(column: pd.Series) -> np.ndarray:
    return column.to_numpy().astype("datetime64[us]").astype(np.int64)


def _times(us: list[int]) -> np.ndarray:
    return np.asarray(us, np.int64).astype("datetime64[us]")


class Silence(StatefulProcessor):
    """Says that a key has been silent for longer than the threshold, and when it speaks again.

    In event time a timer runs out when the watermark, which other keys move, has passed the last row plus the
    threshold; in processing time when the clock has.  Gaps between rows of one micro-batch are reported too, so the
    result does not depend on how rows are dealt to micro-batches, as long as they are not late.
    """

    def __init__(self, key: str, ts: str, threshold_s: float, event_time: bool = True):
        self.key, self.ts, self.threshold, self.event_time = key, ts, int(threshold_s * 1_000_000), event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("last", "seen_us long, silent boolean")

    def _rows(self, key, found: list[tuple[str, int, int]]) -> Iterator[pd.DataFrame]:
        if found:
            kind, seen, at = zip(*found, strict=True)
            yield pd.DataFrame({self.key: key[0], "kind": kind, "last_seen": _times(seen), "at": _times(at)})

    def _heard(self, seen: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.state.update((seen, False))
        self.handle.registerTimer((seen + self.threshold) // 1000 + 1)

    def _moments(self, rows: Iterator[pd.DataFrame]) -> np.ndarray:
        """The times that can border a gap: the first and last of each stretch of the threshold's length."""
        ends: dict[int, tuple[int, int]] = {}
        for pdf in rows:
            us = pd.Series(_us(pdf[self.ts].dropna()))
            for b, lo, hi in us.groupby(us // self.threshold).agg(["min", "max"]).itertuples():
                a = ends.get(b, (lo, hi))
                ends[b] = (min(a[0], lo), max(a[1], hi))
        return np.unique([x for pair in ends.values() for x in pair]).astype(np.int64)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.event_time:
            times = self._moments(rows).tolist()
        else:
            times = [timerValues.getCurrentProcessingTimeInMs() * 1000] if sum(map(len, rows)) else []
        last, silent = (self.state.get() if self.state.exists() else (None, False))
        found = []
        for t in times:
            if last is not None and t <= last:
                continue
            if last is not None and t - last > self.threshold:
                if not silent:
                    found.append(("silent", last, last + self.threshold))
                silent = True
            if silent:
                found.append(("back", last, t))
            last, silent = t, False
        if times and last is not None and (not self.state.exists() or last != self.state.get()[0]):
            self._heard(last)
        yield from self._rows(key, found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            seen, silent = self.state.get()
            if not silent:
                self.state.update((seen, True))
                yield from self._rows(key, [("silent", seen, seen + self.threshold)])

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._heard(int(_us(initialState[self.ts])[0]))

    def close(self) -> None:
        pass


class LowRate(StatefulProcessor):
    """Says that a key has sent fewer than `least` rows in the last `for_s` seconds, and when it no longer does.

    Rows are counted by steps of `step_s` of event time; at the end of each step that the watermark has passed the
    steps of the last `for_s` seconds are added up, the first time when the key has been known for so long.  The counts kept
    are for_s / step_s numbers a key.
    """

    def __init__(self, key: str, ts: str, least: int, for_s: int, step_s: int):
        if for_s % step_s:
            raise ValueError("for_s must be a multiple of step_s")
        self.key, self.ts, self.least, self.steps, self.step = key, ts, least, for_s // step_s, step_s * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "step long", "n long")
        self.state = handle.getValueState("at", "next_step long, low boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found: dict[int, int] = {}
        for pdf in rows:
            step, n = np.unique(_us(pdf[self.ts].dropna()) // self.step, return_counts=True)
            for s, c in zip(step.tolist(), n.tolist(), strict=True):
                found[s] = found.get(s, 0) + c
        if not found:
            return iter(())
        known = self.state.exists()
        nxt, low = self.state.get() if known else (0, False)
        for s, n in found.items():
            if not known or nxt < 0 or s >= nxt - self.steps + 1:
                self.counts.updateValue((s,), ((self.counts.getValue((s,))[0] if self.counts.containsKey((s,)) else 0) + n,))
        if not known:
            nxt = min(found) + self.steps - 1
        elif nxt < 0:  # asleep since a window without any row
            nxt = min(found)
        if not known or self.state.get()[0] != nxt:
            self.state.update((nxt, low))
            self._wake(nxt)
        return iter(())

    def _wake(self, step: int) -> None:
        """A timer at the end of `step`."""
        self.handle.registerTimer((step + 1) * self.step // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        nxt, low = self.state.get()
        counts = {k[0]: v[0] for k, v in self.counts.iterator()}
        out = []
        # all steps that have ended by now; a window without rows needs no further look until new ones come
        while nxt >= 0 and (nxt + 1) * self.step // 1000 <= timerValues.getCurrentWatermarkInMs():
            n = sum(c for s, c in counts.items() if nxt - self.steps < s <= nxt)
            if (n < self.least) != low:
                low = not low
                out.append(("low" if low else "back", n, (nxt + 1) * self.step))
            for s in [s for s in counts if s <= nxt - self.steps + 1]:
                counts.pop(s)
                self.counts.removeKey((s,))
            nxt = -1 if n == 0 and not any(s > nxt for s in counts) else nxt + 1
        self.state.update((nxt, low))
        if nxt >= 0:
            self._wake(nxt)
        if out:
            kind, n, at = zip(*out, strict=True)
            yield pd.DataFrame({self.key: key[0], "kind": kind, "rows": np.asarray(n, np.int64), "at": _times(at)})

    def close(self) -> None:
        pass


class Suppress(StatefulProcessor):
    """Marks which alerts of a key are sent: the first, and then the first after each window's end.

    The open window's end is the key's only state.  The store forgets it `keep_s` after it was written, so keys that no longer
    alert leave nothing behind; an alert that comes later than that, of a window still open, is sent again rather than lost.
    """

    def __init__(self, keep_s: float):
        self.keep_ms = int(keep_s * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.expires = handle.getValueState("expires", "expires_us long", self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["ts", "alert_id"], kind="stable")
        ts = _us(pdf["ts"])
        ttl = np.array([schemas.ALERT_TTL_SECONDS.get(s, schemas.ALERT_TTL_DEFAULT) for s in pdf["severity"]], np.int64) * 1_000_000
        sent = ttl <= 0
        windowed = np.flatnonzero(~sent)
        expires = self.expires.get()[0] if self.expires.exists() else None
        # from one alert that is sent to the next: the first at or after the window's end
        i = 0 if expires is None else int(np.searchsorted(ts[windowed], expires))
        while i < len(windowed):
            at = windowed[i]
            sent[at] = True
            expires = int(ts[at] + ttl[at])
            i = max(i + 1, int(np.searchsorted(ts[windowed], expires)))
        if expires is not None:
            self.expires.update((expires,))
        yield pdf.assign(sent=sent)[["alert_key", "alert_id", "ts", "severity", "sent"]]

    def close(self) -> None:
        pass


def _applied(df: DataFrame, key: str, processor: StatefulProcessor, out: str, time_mode: str, initial: DataFrame | None = None) -> DataFrame:
    with_state_store(df.sparkSession)
    share_package(df.sparkSession)
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=out, outputMode="Append", timeMode=time_mode,
        initialState=None if initial is None else initial.groupBy(key))


def silence_stream(rows: DataFrame, key: str = "stream", ts: str = "ts_event", threshold_s: float = 120, delay: str = "10 seconds",
                   expected: DataFrame | None = None) -> DataFrame:
    """(key, kind, last_seen, at) when a key has sent nothing for `threshold_s` of event time ('silent') and when it does again
    ('back').  `expected` (key, ts) names keys that count as heard at that time, so one that never sends is reported too."""
    return _applied(rows.select(key, ts).withWatermark(ts, delay), key, Silence(key, ts, threshold_s),
                    f"{key} string, kind string, last_seen timestamp, at timestamp", "EventTime", expected)


def heartbeat_stream(beats: DataFrame, key: str = "stream", ts: str = "ts_event", threshold_s: float = 60) -> DataFrame:
    """As `silence_stream` by the clock: a key from which nothing has come for `threshold_s` is reported, even if no key sends."""
    return _applied(beats.select(key, ts), key, Silence(key, ts, threshold_s, event_time=False),
                    f"{key} string, kind string, last_seen timestamp, at timestamp", "ProcessingTime")


def low_rate_stream(rows: DataFrame, key: str = "stream", ts: str = "ts_event", rate: float = 0.1, for_s: int = 120, step_s: int = 60,
                    delay: str = "10 seconds") -> DataFrame:
    """(key, kind, rows, at) when a key's rate falls below `rate` rows a second over `for_s` seconds ('low'), and when it is back."""
    return _applied(rows.select(key, ts).withWatermark(ts, delay), key, LowRate(key, ts, int(np.ceil(rate * for_s)), for_s, step_s),
                    f"{key} string, kind string, rows long, at timestamp", "EventTime")


def coverage_alerts(receipts: DataFrame, start=None, streams=schemas.STREAMS, minutes: int = 5, delay: str = "1 minute") -> DataFrame:
    """Streams that have had no receipt for `minutes`; with `start`, the expected streams count from then on."""
    expected = None
    if start is not None:
        expected = receipts.sparkSession.createDataFrame([(s, start) for s in streams], "stream string, max_ts timestamp")
    return silence_stream(receipts, "stream", "max_ts", minutes * 60, delay, expected)


def suppress_stream(alerts: DataFrame, keep_s: float = max(schemas.ALERT_TTL_SECONDS.values()) + 3600) -> DataFrame:
    """Alerts (alert_key, alert_id, ts, severity) -> with `sent`.

    State that expires by the clock keeps a query busy with empty micro-batches; a run with the trigger availableNow ends
    only where spark.sql.streaming.noDataMicroBatches.enabled is false."""
    return _applied(alerts, "alert_key", Suppress(keep_s), "alert_key string, alert_id long, ts timestamp, severity string, sent boolean",
                    "ProcessingTime")
