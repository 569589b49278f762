"""A trigger's rows of a key cost a fixed number of messages to the state store, not one a row."""

import pandas as pd
from pyspark.sql import Row

from ticktide.streaming import sessions, windows


class State:
    def __init__(self, calls):
        self.calls, self.held = calls, []

    def exists(self):
        return bool(self.held)

    def get(self):
        self.calls.append("get")
        return iter(self.held)

    def update(self, value):
        self.calls.append("update")

    def appendList(self, values):
        self.calls.append("append")
        self.held += values


class Handle:
    def __init__(self):
        self.calls = []

    def getValueState(self, name, schema):
        return State(self.calls)

    getListState = getValueState

    def registerTimer(self, at):
        self.calls.append("timer")


def test_messages_do_not_grow_with_the_rows():
    seen = []
    for n in (10, 500):
        handle, processor = Handle(), sessions.Deliveries()
        processor.init(handle)
        at = pd.to_datetime(pd.Series(range(n)) * 86_400_000, unit="ms")
        rows = pd.DataFrame({"seq": range(n), "at": at, "record": range(n), "content": "x", "counter": range(n), "kind": "range", "first": range(n), "last": range(n), "previous": range(n)})
        assert len(next(processor.handleInputRows((1,), iter([rows]), None))) == n
        seen.append(handle.calls)
    assert seen[0] == seen[1] and seen[0].count("timer") == 1


class Value(State):
    def get(self):
        self.calls.append("get")


class ValueHandle(Handle):
    def getValueState(self, name, schema):
        return Value(self.calls)


def test_a_book_is_one_message_each_way_and_rows_are_no_frames():
    seen = []
    for n in (10, 500):
        handle, processor = ValueHandle(), windows.Books()
        processor.init(handle)
        rows = [Row(pos=i, kind="book" if i == 0 else "delta", price=float(i), size=1.0) for i in range(n)]
        out = list(processor.handleInputRows((1,), iter(rows), None))
        assert len(out) == n and tuple(out[-1]) == (1, n - 1, n, float(n), 0.0)
        seen.append(handle.calls)
    assert seen[0] == seen[1] == ["get", "update"]


def test_causes_are_one_message_each_way_and_rows_are_no_frames():
    handle, processor = ValueHandle(), windows.Continuity()
    processor.init(handle)
    rows = [Row(event_id=i, counter=i, kind="range", first=i, last=i, previous=None if i % 2 else i - 1) for i in range(50)]
    out = list(processor.handleInputRows((1,), iter(reversed(rows)), None))
    assert [r.cause for r in out] == ["bootstrap"] + ["continuous"] * 49 and handle.calls == ["get", "update"]
