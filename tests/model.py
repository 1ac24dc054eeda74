"""Test-only reference model of job A's assembly (JN1 -> JN2 -> JN3) as a discrete-event
simulation: arrivals, timers and hand-overs between stages are events in one priority
queue ordered by (time, class, sequence). The classes encode the tie rules: at one
instant, timers fire before arrivals (a match needs an arrival strictly before the
deadline) and right-side rows come before the cars they may join (rows at or before a
car's time count as already there). Timers are kept, never deleted: a stale timer
is skipped when its stage no longer waits with that deadline."""

from __future__ import annotations

import heapq
import itertools

# event classes, in the order they are handled within one instant
T3, T2, T1, BE, RC, CAR2, WH, CAR3 = range(8)


def simulate(arrivals, T, expected=4, policy="code"):
    """arrivals: (t, seq, side, id) for one key. Returns [(t, out_dict)]."""
    counter = itertools.count()
    q = []
    for t, seq, side, pid in arrivals:
        cls = {"body": BE, "engine": BE, "remote": RC, "wheel": WH}[side]
        heapq.heappush(q, (t, cls, seq, next(counter), (side, pid)))
    s1 = None          # (side, id, deadline)
    s2 = None          # (car, deadline)
    rc = None
    s3 = None          # (car, deadline)
    wheels = []
    out = []

    def push(t, cls, payload):
        heapq.heappush(q, (t, cls, -1, next(counter), payload))

    def final(car, t):
        nonlocal wheels
        n = len(wheels)
        if policy == "code":
            sit = ("MISSING_WHEELS" if n == 0 else
                   "MISSING_REMOTE_CONTROL" if car.get("remote") is None else "AWAITING_PRICE")
        else:
            sit = ("MISSING_BODY" if car.get("body") is None else
                   "MISSING_ENGINE" if car.get("engine") is None else
                   "MISSING_REMOTE_CONTROL" if car.get("remote") is None else
                   "MISSING_WHEELS" if n == 0 else "AWAITING_PRICE")
        out.append((t, dict(body=car.get("body"), engine=car.get("engine"),
                            remote=car.get("remote"), wheels=list(wheels), situation=sit)))
        wheels = []

    while q:
        t, cls, _, _, payload = heapq.heappop(q)
        if cls == T1:
            if s1 and s1[2] == t:
                push(t, CAR2, {s1[0]: s1[1]})
                s1 = None
        elif cls == T2:
            if s2 and s2[1] == t:
                push(t, CAR3, dict(s2[0], remote=rc))
                s2, rc = None, None
        elif cls == T3:
            if s3 and s3[1] == t:
                final(s3[0], t)
                s3 = None
        elif cls == BE:
            side, pid = payload
            if s1 and s1[0] != side:
                push(t, CAR2, {side: pid, s1[0]: s1[1]})
                s1 = None
            elif s1:
                s1 = (s1[0], pid, s1[2])
            else:
                s1 = (side, pid, t + T)
                push(t + T, T1, None)
        elif cls == RC:
            rc = payload[1]
        elif cls == CAR2:
            if rc is not None:
                push(t, CAR3, dict(payload, remote=rc))
                rc = None
            elif s2:
                s2 = (payload, s2[1])
            else:
                s2 = (payload, t + T)
                push(t + T, T2, None)
        elif cls == WH:
            wheels.append(payload[1])
        elif cls == CAR3:
            if len(wheels) == expected:
                final(payload, t)
            elif s3:
                s3 = (payload, s3[1])
            else:
                s3 = (payload, t + T)
                push(t + T, T3, None)
    return out
