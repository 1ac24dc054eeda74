"""Per-key state machines of the stateful operators.

A machine sees one key's arrivals in time order and decides what to emit; it owns no
I/O. ``partflow.streaming.processor`` runs it inside ``transformWithState``
(state in the RocksDB state store, deadlines as event-time timers).

Arrivals are ``(t_ms, seq, side, payload)``; payloads are JSON texts passed through
untouched, outputs are ``(t_ms, json_text)``. Time is processed one instant at a time;
within an instant the order follows the tie rules of SURVEY §2.11:

* a deadline at ``t`` fires before arrivals at ``t`` (a match needs the other arrival
  strictly before first arrival + wait);
* right-side rows at ``t`` count as already there for a left row at ``t``;
* rows of equal time go by ``seq``; a waiting row replaced by a newer one of the same
  side keeps the first deadline and takes the newer value (D-6).
"""

from __future__ import annotations

import json
from collections.abc import Iterable

Arrival = tuple[int, int, str, str]
Out = tuple[int, str]


def obj(**fields) -> str:
    """A JSON object whose ``str`` values are already JSON texts (payloads)."""
    parts = []
    for k, v in fields.items():
        if v is None:
            enc = "null"
        elif isinstance(v, str):
            enc = v
        elif isinstance(v, list):
            enc = "[" + ",".join(v) + "]"
        else:
            enc = json.dumps(v)
        parts.append(f'"{k}":{enc}')
    return "{" + ",".join(parts) + "}"


class PyItems:
    """In-memory list store with the interface of the processor's list state."""

    def __init__(self):
        self.v: list[str] = []

    def get(self) -> list[str]:
        return list(self.v)

    def append(self, x: str) -> None:
        self.v.append(x)

    def clear(self) -> None:
        self.v = []


class Machine:
    keeps_state = False  # True: state never empties (last-N, latest value, ...)

    def next_deadline(self, st: dict) -> int | None:
        return None

    def instant(self, st: dict, items, t: int, rows: list[Arrival]) -> list[Out]:
        raise NotImplementedError

    def idle(self, st: dict) -> bool:
        return not self.keeps_state and not any(v is not None for v in st.values())


def drive(m: Machine, st: dict, items, arrivals: Iterable[Arrival]) -> list[Out]:
    """Feed time-ordered arrivals, firing every deadline that falls before them."""
    outs: list[Out] = []
    batch: list[Arrival] = []
    for a in arrivals:
        if batch and a[0] != batch[0][0]:
            outs += _at(m, st, items, batch[0][0], batch)
            batch = []
        batch.append(a)
    if batch:
        outs += _at(m, st, items, batch[0][0], batch)
    return outs


def _at(m, st, items, t, rows):
    outs = expire(m, st, items, t - 1)
    return outs + m.instant(st, items, t, rows)


def expire(m: Machine, st: dict, items, upto: int) -> list[Out]:
    """Fire every deadline at or before ``upto`` (a timer or the watermark)."""
    outs: list[Out] = []
    while (d := m.next_deadline(st)) is not None and d <= upto:
        outs += m.instant(st, items, d, [])
    return outs


class WaitJoin(Machine):
    """JN1 (``full``), JN2/JN6 (``left``), JN3 (``collect``) and JN5 (``full`` with no
    wait: ``within_ms=None``, lone rows never leave).

    full:    either side waits for the other; a pair leaves at once, a lone side at
             its deadline.
    left:    left rows wait; right rows are only stored (last wins) and never trigger
             output; a left row finding a right row leaves at once with it.
    collect: right rows are collected; a left row finding exactly ``expected`` leaves
             at once with them, otherwise at its deadline with all collected so far.
    Collected/stored right rows are consumed by the row that leaves with them. ``numbered``
    outputs say whether they leave on an arrival (``now``) and in which order of their instant
    (``at``; 0 at a deadline). With ``keep`` a right row expires that long after its arrival."""

    def __init__(self, mode: str, within_ms: int | None, left: str = "left",
                 right: str = "right", expected: int | None = None, numbered: bool = False,
                 keep: int | None = None):
        self.mode, self.T, self.L, self.R, self.expected = mode, within_ms, left, right, expected
        self.numbered, self.keep = numbered, keep

    def _right(self, st, items, at):
        """The waiting right row (or rows) that has not expired by ``at``."""
        if self.mode == "collect":
            if self.keep is None:
                return items.get()
            rows = [x.split("|", 1) for x in items.get()]
            return [v for t, v in rows if int(t) + self.keep > at]
        gone = self.keep is not None and st.get("r") is not None and st["rt"] + self.keep <= at
        return None if gone else st.get("r")

    def _obj(self, at: int, **fields) -> str:
        return obj(**fields, now=at > 0, at=at) if self.numbered else obj(**fields)

    def next_deadline(self, st):
        return st.get("wd")

    def _lone(self, st, t):
        return (t, self._obj(0, **{self.L: st.get("w") if st.get("ws") == self.L else None,
                                   self.R: st.get("w") if st.get("ws") == self.R else None}))

    def _wait(self, st, side, val, t):
        if st.get("w") is not None:
            st["w"] = val  # newer value, first deadline kept
        else:
            st["w"], st["ws"] = val, side
            st["wd"] = None if self.T is None else t + self.T

    def instant(self, st, items, t, rows):
        out: list[Out] = []
        if st.get("wd") is not None and st["wd"] <= t:
            wd = st["wd"]
            if self.mode == "full":
                out.append(self._lone(st, wd))
            elif self.mode == "left":
                out.append((wd, self._obj(0, **{self.L: st["w"],
                                                self.R: self._right(st, items, wd)})))
                st["r"] = st["rt"] = None
            else:
                got = self._right(st, items, wd)
                out.append((wd, self._obj(0, **{self.L: st["w"], self.R: got, "n": len(got)})))
                items.clear()
                st["n"] = None
            st["w"] = st["ws"] = st["wd"] = None
        if self.mode == "full":
            for _, _, side, val in rows:
                if st.get("w") is not None and st.get("ws") != side:
                    pair = {self.L: val if side == self.L else st["w"],
                            self.R: val if side == self.R else st["w"]}
                    out.append((t, self._obj(len(out) + 1, **pair)))
                    st["w"] = st["ws"] = st["wd"] = None
                else:
                    self._wait(st, side, val, t)
            return out
        for _, _, side, val in rows:  # right rows of this instant come first
            if side != self.R:
                continue
            if self.mode == "left":
                st["r"] = val
                if self.keep is not None:
                    st["rt"] = t
            else:
                items.append(val if self.keep is None else f"{t}|{val}")
                st["n"] = (st.get("n") or 0) + 1
        for _, _, side, val in rows:
            if side != self.L:
                continue
            if self.mode == "left" and self._right(st, items, t) is not None:
                out.append((t, self._obj(len(out) + 1, **{self.L: val, self.R: st["r"]})))
                st["r"] = st["rt"] = None
            elif self.mode == "collect" and self.expected == (
                    (st.get("n") or 0) if self.keep is None
                    else len(self._right(st, items, t))):
                got = self._right(st, items, t)
                out.append((t, self._obj(len(out) + 1,
                                         **{self.L: val, self.R: got, "n": len(got)})))
                items.clear()
                st["n"] = None
            else:
                self._wait(st, self.L, val, t)
        return out

    def idle(self, st):
        return st.get("w") is None and st.get("r") is None and not st.get("n")


class Assembly(Machine):
    """JN8: body ⋈ engine (JN1) ⟕ remote control (JN2) ⟕ wheels (JN3) for one sku,
    chained inside one key: a car leaving one stage at ``t`` enters the next at ``t``.
    Output: the car with its parts, wheels, wheel count and situation (``policy``
    ``code`` or ``documented``, SURVEY D-1)."""

    def __init__(self, within_ms: int, expected: int = 4, policy: str = "code"):
        self.T, self.expected, self.policy = within_ms, expected, policy

    def next_deadline(self, st):
        ds = [d for d in (st.get("d1"), st.get("d2"), st.get("d3")) if d is not None]
        return min(ds) if ds else None

    def _situation(self, car, n):
        if self.policy == "code":
            if n == 0:
                return "MISSING_WHEELS"
            return "MISSING_REMOTE_CONTROL" if car.get("remote") is None else "AWAITING_PRICE"
        for part, sit in (("body", "MISSING_BODY"), ("engine", "MISSING_ENGINE"),
                          ("remote", "MISSING_REMOTE_CONTROL")):
            if car.get(part) is None:
                return sit
        return "MISSING_WHEELS" if n == 0 else "AWAITING_PRICE"

    def _final(self, car, items, t):
        wheels = items.get()
        items.clear()
        return (t, obj(body=car.get("body"), engine=car.get("engine"),
                       remote=car.get("remote"), wheels=wheels, n_wheels=len(wheels),
                       situation=json.dumps(self._situation(car, len(wheels)))))

    def instant(self, st, items, t, rows):
        T, out = self.T, []
        if st.get("d3") is not None and st["d3"] <= t:           # JN3 deadline
            out.append(self._final(st["c3"], items, st["d3"]))
            st["c3"] = st["d3"] = st["n"] = None
        to3 = []
        if st.get("d2") is not None and st["d2"] <= t:           # JN2 deadline
            to3.append(dict(st["c2"], remote=st.get("r")))
            st["c2"] = st["d2"] = st["r"] = None
        to2 = []
        if st.get("d1") is not None and st["d1"] <= t:           # JN1 deadline
            to2.append({st["s1"]: st["w1"]})
            st["w1"] = st["s1"] = st["d1"] = None
        for _, _, side, val in rows:                              # JN1 arrivals
            if side not in ("body", "engine"):
                continue
            if st.get("w1") is not None and st["s1"] != side:
                to2.append({side: val, st["s1"]: st["w1"]})
                st["w1"] = st["s1"] = st["d1"] = None
            elif st.get("w1") is not None:
                st["w1"] = val
            else:
                st["w1"], st["s1"], st["d1"] = val, side, t + T
        for _, _, side, val in rows:                              # JN2 right rows
            if side == "remote":
                st["r"] = val
        for car in to2:                                           # JN2 left rows
            if st.get("r") is not None:
                to3.append(dict(car, remote=st["r"]))
                st["r"] = None
            elif st.get("c2") is not None:
                st["c2"] = car
            else:
                st["c2"], st["d2"] = car, t + T
        for _, _, side, val in rows:                              # JN3 right rows
            if side == "wheel":
                items.append(val)
                st["n"] = (st.get("n") or 0) + 1
        for car in to3:                                           # JN3 left rows
            if (st.get("n") or 0) == self.expected:
                out.append(self._final(car, items, t))
                st["n"] = None
            elif st.get("c3") is not None:
                st["c3"] = car
            else:
                st["c3"], st["d3"] = car, t + T
        return out

    def idle(self, st):
        return all(st.get(k) is None for k in ("w1", "c2", "r", "c3")) and not st.get("n")


class Latest(Machine):
    """JN4: each side keeps its latest value for ever; every arrival emits once both
    sides have one."""
    keeps_state = True

    def __init__(self, left: str = "left", right: str = "right"):
        self.L, self.R = left, right

    def instant(self, st, items, t, rows):
        out = []
        for _, seq, side, val in rows:
            st[side] = val
            if st.get(self.L) is not None and st.get(self.R) is not None:
                out.append((t, obj(left=st[self.L], right=st[self.R], seq=seq)))
        return out


class LastN(Machine):
    """AG2: the newest ``n`` values, oldest first, emitted on every arrival."""
    keeps_state = True

    def __init__(self, n: int):
        self.n = n

    def instant(self, st, items, t, rows):
        out = []
        for _, seq, _, val in rows:
            st["vals"] = (st.get("vals") or [])[-(self.n - 1):] + [val] if self.n > 1 else [val]
            out.append((t, obj(vals=list(st["vals"]), seq=seq)))
        return out


class First(Machine):
    """AG5: flags the first arrival of the key."""
    keeps_state = True

    def instant(self, st, items, t, rows):
        out = []
        for _, seq, _, val in rows:
            out.append((t, obj(row=val, first=not st.get("seen"), seq=seq)))
            st["seen"] = True
        return out


class RunningCount(Machine):
    """AG1 per input: the key's running total, emitted on every arrival (``keyBy(word)
    .sum(1)``)."""
    keeps_state = True

    def instant(self, st, items, t, rows):
        out = []
        for _, seq, _, _ in rows:
            st["n"] = (st.get("n") or 0) + 1
            out.append((t, obj(n=st["n"], seq=seq)))
        return out
