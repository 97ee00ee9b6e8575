"""The state step by itself: what waits is bounded, and every order of arrival gives the batch counters."""

import random

import numpy as np
import pandas as pd
import pytest

from stintlab.streaming.lap_order import LapOrder, ready_laps, run_lengths


class Value:
    def __init__(self):
        self.now = None

    def get(self):
        return self.now

    def update(self, value):
        self.now = value

    def clear(self):
        self.now = None


class Map(dict):
    def iterator(self):
        return iter(list(self.items()))

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


class Handle:
    """State and timers of one key."""

    def __init__(self):
        self.timers = set()

    def getValueState(self, name, schema):
        return Value()

    def getMapState(self, name, key, value):
        return Map()

    def registerTimer(self, at):
        self.timers.add(at)


class Clock:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at

    getExpiryTimeInMs = getCurrentWatermarkInMs


def batch(rows):
    return pd.DataFrame(rows, columns=["lap", "at", "up", "event"]).astype({"lap": "float64" if any(r[0] is None for r in rows) else "int64"})


class Driver:
    def __init__(self, idle=None):
        self.step, self.handle, self.out = LapOrder(idle), Handle(), []
        self.step.init(self.handle)

    def send(self, rows):
        for frame in self.step.handleInputRows(("k",), iter([batch(rows)]), Clock(0)):
            self.out += list(frame.itertuples(index=False, name=None))

    def watermark(self, at):
        for due in sorted(t for t in self.handle.timers if t <= at):
            self.handle.timers.discard(due)
            for frame in self.step.handleExpiredTimer(("k",), Clock(at), Clock(due)):
                self.out += list(frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("seed", range(30))
def test_any_order_within_the_lateness(seed):
    rng = random.Random(seed)
    laps = [n for n in range(1, 61) if rng.random() < 0.9]  # some never come
    up = {n: rng.random() < 0.7 for n in laps}
    # Each lap is up to 8 places late; the watermark follows ten laps behind the newest.
    order = sorted(laps, key=lambda n: n + rng.uniform(0, 8))
    driver, seen, most = Driver(), 0, 0
    while order:
        n = rng.randint(1, 6)
        part, order = order[:n], order[n:]
        driver.send([(n, 1000 * n, up[n], str(n)) for n in part])
        seen = max(seen, *part)
        driver.watermark(1000 * (seen - 10))
        most = max(most, len(driver.step.waiting))
    driver.watermark(10**9)
    want = run_lengths(np.array([up[n] for n in laps]), 0)
    assert driver.out == [(str(n), int(w)) for n, w in zip(laps, want)]
    assert most <= 20 and not driver.step.waiting


def test_laps_in_order_never_wait():
    driver = Driver()
    for n in range(1, 40, 3):
        driver.send([(k, 1000 * k, True, str(k)) for k in (n + 1, n, n + 2)])
        assert not driver.step.waiting and not driver.handle.timers
    assert driver.out[-1] == ("39", 39)


def test_repeats_late_and_unnumbered_laps_are_not_lost():
    driver = Driver()
    driver.send([(1, 0, True, "a"), (1, 0, True, "b"), (None, 0, False, "c"), (3, 3000, True, "d"), (3, 3000, True, "e")])
    assert [e for e, _ in driver.out] == ["c", "a", "b"]
    driver.watermark(3000)
    assert driver.out[-2:] == [("d", 3), ("e", 4)]
    driver.send([(2, 2000, False, "f"), (4, 4000, True, "g")])
    assert driver.out[-2:] == [("f", 0), ("g", 1)]


def test_only_idle_drivers_are_dropped():
    driver = Driver(idle=5000)
    driver.send([(1, 1000, True, "a")])
    driver.send([(2, 4000, True, "b")])
    driver.watermark(6500)
    assert driver.step.place.get() is not None
    driver.watermark(9000)
    assert driver.step.place.get() is None


def test_ready_laps():
    assert ready_laps(np.array([1, 2, 2, 3, 5, 6]), 0) == 4
    assert ready_laps(np.array([4, 9]), 7) == 1
    assert ready_laps(np.array([], dtype=np.int64), 3) == 0
