"""Stateful processors: identity, continuity and health of an epoch; windows closed by event time."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DELIVERIES = "epoch long, seq long, record long, verdict string, cause string, frames long, gaps long, backwards long, breaks long, health string"
#: How long a record's content is remembered after its last delivery, in event time; it is looked for once a day.
EXPIRY_MS, DAY_MS = 7 * 86_400_000, 86_400_000


class Deliveries(StatefulProcessor):
    """Verdict of every delivery of one epoch, cause of the first of each record, and the epoch's health so far.

    Batch forms: ``order.identity_verdict``, then ``continuity_causes`` and ``epoch_health`` over
    what is unseen. State: record, content hash and time of its last delivery, forgotten once the
    watermark is ``expiry_ms`` beyond that, by a timer at the end of the day on which the oldest is due; the
    last counter and greatest cursor; four counts. Records are a list that is read once a trigger and
    appended to, as each access to a state is a message to the JVM; a record's last entry counts. A trigger's rows of a key are put in order of seq; triggers must
    arrive in that order.
    """

    def __init__(self, expiry_ms: int = EXPIRY_MS):
        self.expiry_ms = expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.records = handle.getListState("records", "record long, content string, at_ms long")
        self.seen = handle.getValueState("seen", "counter long, last long")
        self.counts = handle.getValueState("counts", "frames long, gaps long, backwards long, breaks long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        counter, last = self.seen.get() if self.seen.exists() else (None, None)
        frames, gaps, backwards, breaks = self.counts.get() if self.counts.exists() else (0, 0, 0, 0)
        out = []
        known_before = {r: (content, at) for r, content, at in self.records.get()}
        data = pd.concat(list(rows)).sort_values("seq", kind="stable")
        times = data["at"].astype("datetime64[ms]").astype("int64")
        fresh: dict[int, tuple[str, int]] = {}
        for at, seq, record, content, c, kind, first, end, previous in zip(times, *(data[x] for x in ("seq", "record", "content", "counter", "kind", "first", "last", "previous")), strict=True):
            held = fresh.get(record) or known_before.get(record)
            known = held[0] if held else None
            verdict = "unseen" if known is None else "duplicate" if known == content else "conflict"
            fresh[record] = (content, int(at)) if known is None else (known, max(held[1], int(at)))
            cause = None
            if verdict == "unseen":
                cause = _cause(counter, last, c, kind, first, end, previous)
                if kind != "lifecycle" and not pd.isna(end):
                    last = int(end) if last is None else max(last, int(end))
                counter = int(c)
                frames += cause != "lifecycle"
                gaps, backwards, breaks = gaps + (cause == "gap_proven"), backwards + (cause == "backwards"), breaks + (cause == "local_break")
            health = "stale" if gaps + backwards + breaks else "healthy" if frames else "awaiting_bootstrap"
            out.append((key[0], seq, record, verdict, cause, frames, gaps, backwards, breaks, health))
        _append(self.records, [(int(r), *v) for r, v in fresh.items()])
        due = self._due(fresh)
        if not known_before or due < self._due(known_before):  # else a timer no later than this is there
            self.handle.registerTimer(due)
        self.seen.update((counter, last))
        self.counts.update((frames, gaps, backwards, breaks))
        yield pd.DataFrame(out, columns=[f.split()[0] for f in DELIVERIES.split(", ")])

    def _due(self, records: dict[int, tuple[str, int]]) -> int:
        """The end of the first day on which one of the records is to be forgotten."""
        return ((min(at for _, at in records.values()) + self.expiry_ms) // DAY_MS + 1) * DAY_MS

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        held = {r: (content, at) for r, content, at in self.records.get()}
        held = {r: v for r, v in held.items() if v[1] + self.expiry_ms > now}
        self.records.clear()
        if held:
            _append(self.records, [(r, *v) for r, v in held.items()])
            self.handle.registerTimer(self._due(held))
        yield pd.DataFrame([], columns=[f.split()[0] for f in DELIVERIES.split(", ")])

    def close(self) -> None:
        pass


#: Entries of a list state in one message.
CHUNK = 10_000


def _append(state: Any, entries: list[tuple]) -> None:
    for i in range(0, len(entries), CHUNK):
        state.appendList(entries[i : i + CHUNK])


def _cause(counter: int | None, seen: int | None, c: int, kind: str, first: int, end: int, previous: int) -> str:
    """The tests of ``order.continuity_causes``, in the same order."""
    if counter is not None and c != counter + 1:
        return "local_break"
    if kind in ("lifecycle", "unsequenced"):
        return kind
    if seen is None or kind == "snapshot":
        return "bootstrap"
    if end <= seen:
        return "backwards"
    return "gap_proven" if (first - 1 if pd.isna(previous) else previous) > seen else "continuous"


def deliveries(stream: DataFrame, delay: str, expiry_ms: int = EXPIRY_MS) -> DataFrame:
    """``stream``: epoch, seq, at (timestamp), record, content, counter, kind, first, last, previous. Rows later than ``delay`` are for ``windows.split_late``."""
    keyed = stream.withWatermark("at", delay).groupBy("epoch")
    return keyed.transformWithStateInPandas(Deliveries(expiry_ms), outputStructType=DELIVERIES, outputMode="append", timeMode="eventTime")


WINDOWS = "tape string, window_start long, valid_lanes long, state string"


class Barrier(StatefulProcessor):
    """Windows of a tape that commit in ascending order, closed by event-time timers.

    A window is ready at its end if all ``expected`` lanes delivered, else when the last of them
    does, else at the deadline, then incomplete. It commits once no window before it waits. State:
    lanes of each window that hasn't committed. Input is one row a lane and window (at in UTC).
    """

    def __init__(self, expected: int, period_us: int, deadline_us: int):
        self.expected, self.period, self.deadline = expected, period_us, deadline_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "window_start long", "lanes string, state string")

    def _state(self, start: int, lanes: str, now_us: int) -> str:
        end = start + self.period
        if now_us < end:
            return "open"
        return "complete" if len(lanes.split("\x1f")) >= self.expected else "waiting" if now_us < end + self.deadline else "incomplete"

    def _commits(self, tape: Any, now_us: int) -> pd.DataFrame:
        out = []
        for (start,), (lanes, _) in sorted((tuple(k), tuple(v)) for k, v in self.windows.iterator()):
            state = self._state(start, lanes, now_us)
            if state not in ("complete", "incomplete"):
                break
            out.append((tape, start, len(lanes.split("\x1f")), state))
        for _, start, _, _ in out:
            self.windows.removeKey((start,))
        return pd.DataFrame(out, columns=["tape", "window_start", "valid_lanes", "state"])

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for data in rows:
            for start, lanes in data.groupby("window_start")["lane"]:
                start = int(start)
                held = self.windows.getValue((start,))[0].split("\x1f") if self.windows.containsKey((start,)) else []
                if not held:
                    for at in (start + self.period, start + self.period + self.deadline):
                        self.handle.registerTimer(at // 1000 - 1)  # a timer fires once the watermark is beyond it
                self.windows.updateValue((start,), ("\x1f".join(sorted({*held, *lanes})), "open"))
        yield self._commits(key[0], timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield self._commits(key[0], timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass


def committed_windows(receipts: DataFrame, expected: int, period_us: int, deadline_us: int, delay: str = "0 seconds") -> DataFrame:
    """``receipts``: tape, lane, window_start (microseconds), at (timestamp)."""
    keyed = receipts.withWatermark("at", delay).groupBy("tape")
    return keyed.transformWithStateInPandas(Barrier(expected, period_us, deadline_us), outputStructType=WINDOWS, outputMode="append", timeMode="eventTime")
