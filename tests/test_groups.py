"""The state step works on groups of drivers: what waits is small, is written seldom, and drivers do not mix."""

import random

import numpy as np
import pandas as pd
import pytest

from stintlab.streaming import lap_order
from stintlab.streaming.lap_order import pack_entry, run_lengths, unpack_entry
from tests.test_lap_order import Clock, Driver


class Group(Driver):
    """Several drivers of one group; rows are (driver, lap, at, up, event)."""

    def send(self, rows):
        frame = pd.DataFrame(rows, columns=["driver", "lap", "at", "up", "event"])
        for out in self.step.handleInputRows((1,), iter([frame]), Clock(0)):
            self.out += list(out.itertuples(index=False, name=None))

    def of(self, driver):
        return [(e, n) for e, n in self.out if e.split()[0] == driver]


@pytest.mark.parametrize("seed", range(10))
@pytest.mark.parametrize("size", [1, 7, 256])
def test_each_driver_of_a_group_is_counted_alone(monkeypatch, seed, size):
    monkeypatch.setattr(lap_order, "_ENTRY_LAPS", size)
    rng = random.Random(seed)
    laps = {d: [n for n in range(1, 30) if rng.random() < 0.9] for d in "ABCD"}  # some never come
    up = {(d, n): rng.random() < 0.7 for d in laps for n in laps[d]}
    order = list(up)
    rng.shuffle(order)
    group = Group()
    while order:
        part, order = order[:17], order[17:]
        group.send([(d, n, 1000 * n, up[d, n], f"{d} {n}") for d, n in part])
    group.watermark(10**9)
    for d in laps:
        want = run_lengths(np.array([up[d, n] for n in laps[d]]), 0)
        assert group.of(d) == [(f"{d} {n}", int(w)) for n, w in zip(laps[d], want)]
    assert not group.step.waiting


def test_a_group_of_drivers_makes_one_entry_and_one_timer():
    group = Group()
    group.send([(f"D{k}", n, 1000, True, f"D{k} {n}") for n in (2, 3, 4) for k in range(50)])
    assert len(group.step.waiting) == 1 and group.handle.timers == {1000} and not group.out
    group.watermark(1000)
    assert len(group.out) == 150 and group.of("D7") == [("D7 2", 1), ("D7 3", 2), ("D7 4", 3)]


def test_an_entry_is_written_back_once_half_of_it_has_left():
    group, written = Group(), []
    group.send([(d, 2, 1000, True, f"{d} 2") for d in "ABCDEF"])
    update = group.step.waiting.updateValue
    group.step.waiting.updateValue = lambda key, value: (written.append(key), update(key, value))
    group.send([("A", 1, 1000, True, "A 1"), ("B", 1, 1000, True, "B 1")])
    assert not written and group.of("A") == [("A 1", 1), ("A 2", 2)]
    group.send([("C", 1, 1000, True, "C 1")])
    assert written == [(0,)]
    group.send([(d, 1, 1000, False, f"{d} 1") for d in "DEF"])
    assert not group.step.waiting and len(group.out) == 12 and group.of("F") == [("F 1", 0), ("F 2", 1)]


def test_a_forgotten_driver_leaves_no_laps_behind():
    group = Group(idle=5000)
    group.send([("A", 2, 1000, True, "A 2"), ("B", 2, 90000, True, "B 2"), ("C", 2, 90000, True, "C 2")])
    group.send([("A", 1, 1000, True, "A 1")])
    group.watermark(50000)  # A is forgotten, B and C still wait
    assert [list(r)[0] for r in unpack_entry(*group.step.waiting[(0,)])] == ["B", "C"]
    group.send([("A", 1, 60000, True, "A 1")])
    assert group.of("A") == [("A 1", 1), ("A 2", 2), ("A 1", 1)]


def test_a_timer_that_finds_nothing_due_reads_no_laps():
    group = Group()
    group.send([("A", 2, 1000, True, "A 2"), ("B", 5, 99000, True, "B 5")])
    group.step._entries = lambda: pytest.fail("read")
    assert list(group.step.handleExpiredTimer((1,), Clock(500), Clock(500))) == []


def test_what_waits_is_small():
    events = [f'{{"0":2024,"1":1,"2":"Race 1","3":"D7","4":{n},"5":{n / 7},"6":"SOFT","7":"INSUFFICIENT_DATA"}}' for n in range(200)]
    rows = [("2024|1|D7", n, 1000, n % 2 == 0, e) for n, e in enumerate(events)]
    size, packed = pack_entry(rows)
    assert unpack_entry(size, packed) == rows
    assert len(packed) < 0.25 * sum(len(e) for e in events)
