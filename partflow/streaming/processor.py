"""``transformWithState`` processor that runs a machine per key (the Row form: most
keys see one or two rows per micro-batch, where building pandas frames per key would
cost more than the work).

State per key: one value state holding the machine's small state as JSON, and one list
state for rows a machine collects (JN3 wheels): appended one by one, never rewritten.
The machine clock is in microseconds (the event times' own resolution); the earliest
pending deadline is an event-time timer at its millisecond. When the timer fires, every
deadline up to the end of the watermark's millisecond is settled: input is cut into
micro-batches on millisecond borders, so nothing later can still come for that
millisecond. Rows of a key arriving in one micro-batch are sorted by ``(ts_us, seq)``
first, so the output doesn't depend on how the input was cut into micro-batches.
"""

from __future__ import annotations

import json

from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from partflow.streaming.machines import Machine, drive, expire

STATE_SCHEMA = T.StructType([T.StructField("json", T.StringType())])
ITEM_SCHEMA = T.StructType([T.StructField("v", T.StringType())])
OUTPUT_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("ts_us", T.LongType()),
    T.StructField("value", T.StringType()),
])


class _ListItems:
    def __init__(self, ls):
        self.ls = ls

    def get(self) -> list[str]:
        return [r[0] for r in self.ls.get()] if self.ls.exists() else []

    def append(self, v: str) -> None:
        self.ls.appendValue((v,))

    def clear(self) -> None:
        self.ls.clear()


class MachineProcessor(StatefulProcessor):
    """``time_mode``: ``EventTime`` (arrival column ``ts_us``, timers on the watermark)
    or ``ProcessingTime`` (arrival = the batch's processing time, rows in ``seq``
    order; timers on the wall clock), as the reference. ``ttl_ms`` optionally expires
    state not updated for that long (processing time); off by default, as the
    reference keeps unmatched rows for ever."""

    def __init__(self, machine: Machine, time_mode: str = "EventTime",
                 ttl_ms: int | None = None):
        self.machine, self.time_mode, self.ttl_ms = machine, time_mode, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.st = handle.getValueState("st", STATE_SCHEMA, self.ttl_ms)
        self.items = _ListItems(handle.getListState("items", ITEM_SCHEMA, self.ttl_ms))

    def _load(self) -> dict:
        got = self.st.get()  # one call; None when the key has no state
        return json.loads(got[0]) if got else {}

    def _finish(self, key: str, st: dict, outs):
        due = self.machine.next_deadline(st)
        want = None if due is None else due // 1000
        have = st.pop("_timer", None)
        if want != have:
            if have is not None:
                self.handle.deleteTimer(have)
            if want is not None:
                self.handle.registerTimer(want)
        if self.machine.idle(st):
            self.st.clear()
        else:
            st["_timer"] = want
            self.st.update((json.dumps(st),))
        for t, v in outs:
            yield Row(key=key, ts_us=t, value=v)

    def _now_ms(self, timerValues) -> int:
        if self.time_mode == "ProcessingTime":
            return timerValues.getCurrentProcessingTimeInMs()
        return timerValues.getCurrentWatermarkInMs()

    def handleInputRows(self, key, rows, timerValues):
        if self.time_mode == "ProcessingTime":
            now = timerValues.getCurrentProcessingTimeInMs() * 1000
            arrivals = sorted((now, r.seq, r.side, r.value) for r in rows)
        else:
            arrivals = sorted((r.ts_us, r.seq, r.side, r.value) for r in rows)
        st = self._load()
        outs = drive(self.machine, st, self.items, arrivals)
        yield from self._finish(key[0], st, outs)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        st = self._load()
        st.pop("_timer", None)  # this timer is gone once fired
        upto = max(expiredTimerInfo.getExpiryTimeInMs(), self._now_ms(timerValues)) * 1000 + 999
        outs = expire(self.machine, st, self.items, upto)
        yield from self._finish(key[0], st, outs)

    def close(self) -> None:
        pass
