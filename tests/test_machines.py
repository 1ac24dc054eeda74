"""T2/T3: the hand-written cases of FIXTURES.md §3 on the per-key machines (the logic
the streaming processors run)."""

import json

from partflow.streaming.machines import (Assembly, First, LastN, Latest, PyItems, WaitJoin,
                                         drive, expire)

S = 1_000_000  # one second on the machine clock (µs)


def run(machine, arrivals, until=10**15):
    st, items = {}, PyItems()
    out = drive(machine, st, items, sorted(arrivals, key=lambda a: (a[0], a[1])))
    out += expire(machine, st, items, until)
    return [(t, json.loads(v)) for t, v in out]


def p(x):
    return json.dumps({"id": x})


def test_pair_before_deadline():
    out = run(WaitJoin("full", 5 * S, "body", "engine"),
              [(0, 0, "body", p("b")), (4_999_000, 1, "engine", p("e"))])
    assert out == [(4_999_000, {"body": {"id": "b"}, "engine": {"id": "e"}})]


def test_at_deadline_no_match():
    out = run(WaitJoin("full", 5 * S, "body", "engine"),
              [(0, 0, "body", p("b")), (5 * S, 1, "engine", p("e"))])
    assert out == [(5 * S, {"body": {"id": "b"}, "engine": None}),
                   (10 * S, {"body": None, "engine": {"id": "e"}})]


def test_replacement_keeps_first_deadline():
    out = run(WaitJoin("full", 5 * S, "body", "engine"),
              [(0, 0, "body", p("A")), (3 * S, 1, "body", p("B"))])
    assert out == [(5 * S, {"body": {"id": "B"}, "engine": None})]


def test_remote_early_during_late():
    m = WaitJoin("left", 5 * S, "car", "remote")
    car = (10 * S, 1, "car", p("c"))
    assert run(m, [(8 * S, 0, "remote", p("r")), car])[0] == (
        10 * S, {"car": {"id": "c"}, "remote": {"id": "r"}})
    assert run(m, [(12 * S, 0, "remote", p("r")), car])[0] == (
        15 * S, {"car": {"id": "c"}, "remote": {"id": "r"}})
    assert run(m, [(16 * S, 0, "remote", p("r")), car])[0] == (
        15 * S, {"car": {"id": "c"}, "remote": None})


def test_remote_alone_never_leaves():
    assert run(WaitJoin("left", 5 * S, "car", "remote"), [(1, 0, "remote", p("r"))]) == []


def _wheels(times):
    return [(t * S, i, "wheel", p(f"w{i}")) for i, t in enumerate(times)]


def test_four_wheels_early():
    out = run(WaitJoin("collect", 5 * S, "car", "wheel", 4),
              _wheels([1, 2, 3, 4]) + [(5 * S, 9, "car", p("c"))])
    assert out[0][0] == 5 * S and out[0][1]["n"] == 4


def test_five_wheels_wait():
    out = run(WaitJoin("collect", 5 * S, "car", "wheel", 4),
              _wheels([1, 2, 3, 4, 5]) + [(6 * S, 9, "car", p("c"))])
    assert out[0][0] == 11 * S and out[0][1]["n"] == 5


def test_two_wheels_then_none_and_no_wheels():
    m = WaitJoin("collect", 5 * S, "car", "wheel", 4)
    out = run(m, _wheels([1, 2]) + [(3 * S, 9, "car", p("c"))])
    assert out[0][0] == 8 * S and out[0][1]["n"] == 2
    out = run(m, [(3 * S, 9, "car", p("c"))])
    assert out[0][0] == 8 * S and out[0][1]["n"] == 0


def test_assembly_situations():
    m = Assembly(5 * S, 4, "code")
    out = run(m, [(0, 0, "body", p("b")), (1 * S, 0, "engine", p("e")),
                  (2 * S, 0, "remote", p("r"))] + _wheels([0, 0, 0, 1]))
    # The pair forms at 1 s; the remote arrives at 2 s, during the car's wait at the
    # remote stage, so the car leaves that stage at its deadline (6 s), when all four
    # wheels are there.
    assert out == [(6 * S, {"body": {"id": "b"}, "engine": {"id": "e"},
                            "remote": {"id": "r"}, "wheels": [{"id": f"w{i}"} for i in range(4)],
                            "n_wheels": 4, "situation": "AWAITING_PRICE"})]
    doc = run(Assembly(5 * S, 4, "documented"), [(0, 0, "engine", p("e"))])
    assert doc[0][1]["situation"] == "MISSING_BODY"
    code = run(Assembly(5 * S, 4, "code"), [(0, 0, "engine", p("e"))])
    assert code[0][1]["situation"] == "MISSING_WHEELS"


def test_last_three():
    out = run(LastN(3), [(i, i, "tag", json.dumps(x)) for i, x in enumerate("ABCde")])
    assert [o[1]["vals"] for o in out] == [["A"], ["A", "B"], ["A", "B", "C"],
                                           ["B", "C", "d"], ["C", "d", "e"]]


def test_latest_and_first():
    out = run(Latest("l", "r"), [(1, 1, "l", "1"), (2, 2, "l", "2"), (3, 3, "r", "3"),
                                 (4, 4, "l", "4")])
    assert [(o[1]["left"], o[1]["right"]) for o in out] == [(2, 3), (4, 3)]
    out = run(First(), [(1, 1, "x", "1"), (2, 2, "x", "2")])
    assert [o[1]["first"] for o in out] == [True, False]
