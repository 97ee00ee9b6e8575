"""Laps of each driver in lap order, whatever the order and the batch they arrive in.

State per driver and race: the last lap counted, the run of HIGH laps ending there, and the laps that
wait because one before them is missing. A lap that follows the last one is passed on at once, with all
that waited for it. A gap ends when the watermark reaches a lap behind it: what is missing by then is
given up. State is thus bounded by the laps of the drivers within the lateness allowed for. Drivers are
dealt to groups, and the state of a group is read and written at once.
"""

from __future__ import annotations

from collections.abc import Container, Iterable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stintlab.schemas import LIVE_KEYS
from stintlab.sources.shipping import ship_package

_LAP = "lap_number"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Settings without which state of several parts cannot be kept.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": _ROCKS,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# An event time no event has; it ties a condition to the event time.
_BEFORE_ALL = "0001-01-02"


def run_lengths(up: np.ndarray, before: int) -> np.ndarray:
    """Length of the run of True ending at each place, given the run just before the first."""
    place = np.arange(1, len(up) + 1)
    last_break = np.maximum.accumulate(np.where(up, -before, place))
    return np.where(up, place - last_break, 0)


def ready_count(laps: Iterable[int], last: int) -> int:
    """How many of some sorted laps follow the last one, or each other, without a gap."""
    n = 0
    for lap in laps:
        if lap > last + 1:
            break
        n, last = n + 1, max(last, lap)
    return n


def ready_laps(laps: np.ndarray, last: int) -> int:
    """ready_count of an array."""
    return ready_count(laps.tolist(), last)


# What the count needs of an event, and the event itself; the driver may be left out if there is one.
_DRIVER, _FIELDS = "driver", ["lap", "at", "up", "event"]
# Laps that wait in one entry of the state at most.
_ENTRY_LAPS = 256
# Groups that drivers are dealt to. State is kept by group, so a checkpoint goes on with the number it began with.
GROUPS = 4096
# An entry: laps that wait, those of a driver in lap order, repeats of a lap in order of arrival.
_ENTRY = pa.schema(
    [("driver", pa.string()), ("lap", pa.int64()), ("at", pa.int64()), ("up", pa.bool_()), ("event", pa.string())]
)
_CODEC = "zstd"


def pack_entry(rows: list[tuple]) -> tuple[int, bytes]:
    """(driver, lap, at, up, event) rows as one compressed value, and its size before: events of a race are much alike."""
    columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), _ENTRY)]
    body = pa.record_batch(columns, schema=_ENTRY).serialize()
    return body.size, pa.compress(body, codec=_CODEC, asbytes=True)


def unpack_entry(size: int, packed: bytes) -> list[tuple]:
    """The rows of pack_entry."""
    body = pa.decompress(bytes(packed), decompressed_size=size, codec=_CODEC)
    return list(zip(*[c.to_pylist() for c in pa.ipc.read_record_batch(body, _ENTRY).columns]))


@dataclass(slots=True)
class _Place:
    """How far a driver has got: last lap, run, laps that wait, and when the driver counts as gone."""

    last: int = 0
    run: int = 0
    held: int = 0
    gone_at: int = -1


_PLACE = [f.name for f in fields(_Place)]


class LapOrder(StatefulProcessor):
    """Counts the run of HIGH laps of each driver of a group in lap order.

    Laps without a number, and laps that come after their place was given up, count when they arrive. A call
    is for a group of drivers, as calls and requests to the state cost more than laps do. What waits is kept
    by batch, many laps to an entry, compressed. A lap that has left is known by its number, as no lap waits
    up to the last of its driver; so an entry stays as it is until half of it has left.
    """

    def __init__(self, idle_ms: int | None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Next entry, first time at which a lap that waits is due, and the places of the drivers.
        place = "serial bigint, due bigint, drivers array<string>, " + ", ".join(f"{f} array<bigint>" for f in _PLACE)
        self.place = handle.getValueState("place", place)
        self.waiting = handle.getMapState("waiting", "serial bigint", "size bigint, laps binary")

    def _places(self) -> tuple[dict[str, _Place], int, int | None]:
        serial, due, drivers, *fields = self.place.get() or (0, None, [], *[[] for _ in _PLACE])
        return {d: _Place(*values) for d, *values in zip(drivers, *fields)}, serial, due

    def _update(self, places: dict[str, _Place], serial: int, due: int | None) -> None:
        if places:
            fields = [[getattr(p, f) for p in places.values()] for f in _PLACE]
            self.place.update((serial if due is not None else 0, due, list(places), *fields))
        else:
            self.place.clear()

    def _entries(self) -> dict[int, list[tuple]]:
        return {int(serial): unpack_entry(*value) for (serial,), value in self.waiting.iterator()}

    @staticmethod
    def _held(entries: dict[int, list[tuple]], places: dict[str, _Place], drivers: Container[str]) -> dict[str, list[tuple]]:
        """(lap, entry, place in it, at, up, event) of the laps of some drivers that wait, by driver in lap order."""
        found: dict[str, list[tuple]] = {}
        for serial, rows in entries.items():
            for i, (driver, lap, at, up, event) in enumerate(rows):
                if driver in drivers and lap > places[driver].last:
                    found.setdefault(driver, []).append((lap, serial, i, at, up, event))
        for rows in found.values():
            rows.sort(key=lambda r: r[:3])
        return found

    def _release(self, entries: dict[int, list[tuple]], places: dict[str, _Place], every: bool = False) -> int | None:
        """Remove entries of which nothing waits, and write back those of which half has left, or with every any.

        The first time at which a lap that still waits is due.
        """
        due = None
        for serial, rows in entries.items():
            left = [r for r in rows if r[1] > places[r[0]].last]
            if not left:
                self.waiting.removeKey((serial,))
                continue
            due = min([r[2] for r in left] if due is None else [due, *[r[2] for r in left]])
            if len(left) <= len(rows) // 2 or every and len(left) < len(rows):
                self.waiting.updateValue((serial,), pack_entry(left))
        return due

    @staticmethod
    def _pass_on(rows: list[tuple], place: _Place, events: list, runs: list) -> None:
        last, run = place.last, place.run
        for lap, _, _, _, up, event in rows:
            run = run + 1 if up else 0
            events.append(event)
            runs.append(run)
            last = last if lap is None else max(last, lap)
        place.last, place.run = last, run

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        places, serial, due = self._places()
        unknown: dict[str, list[tuple]] = {}
        new: dict[str, list[tuple]] = {}
        n = 0
        for part in rows:
            drivers = part[_DRIVER].tolist() if _DRIVER in part else [""] * len(part)
            for driver, lap, at, up, event in zip(drivers, *[part[c].tolist() for c in _FIELDS]):
                if lap is None or lap != lap:
                    unknown.setdefault(driver, []).append((None, serial, n, int(at), bool(up), event))
                else:
                    new.setdefault(driver, []).append((int(lap), serial, n, int(at), bool(up), event))
                n += 1
        events, runs, fresh, timers = [], [], [], set()
        came = dict.fromkeys([*unknown, *new])
        for driver in came:
            places.setdefault(driver, _Place())
        entries = self._entries() if any(places[d].held for d in came) else {}
        held = self._held(entries, places, came)
        for driver in came:
            place, laps = places[driver], [*new.get(driver, []), *held.get(driver, [])]
            self._pass_on(unknown.get(driver, []), place, events, runs)
            laps.sort(key=lambda r: r[:3])
            if self.idle_ms and laps:
                place.gone_at = max(place.gone_at, max(r[3] for r in laps) + self.idle_ms)
                timers.add(place.gone_at)
            cut = ready_count((r[0] for r in laps), place.last)
            self._pass_on(laps[:cut], place, events, runs)
            place.held = len(laps) - cut
            fresh += [(driver, lap, at, up, event) for lap, entry, _, at, up, event in laps[cut:] if entry == serial]
        if entries:
            due = self._release(entries, places)
        for first in range(0, len(fresh), _ENTRY_LAPS):
            self.waiting.updateValue((serial,), pack_entry(fresh[first : first + _ENTRY_LAPS]))
            serial += 1
        if fresh:
            ats = {r[2] for r in fresh}
            timers |= ats
            due = min(ats) if due is None else min(due, *ats)
        for at in sorted(timers):
            self.handle.registerTimer(at)
        self._update(places, serial, due)
        if events:
            yield pd.DataFrame({"event": events, "consecutive_high": runs})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        places, serial, due = self._places()
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        entries = self._entries() if due is not None and due <= now else {}
        events, runs = [], []
        for driver, rows in self._held(entries, places, places).items():
            lap = max((r[0] for r in rows if r[3] <= now), default=None)
            if lap is not None:
                cut = sum(r[0] <= lap for r in rows)
                cut += ready_count((r[0] for r in rows[cut:]), max(places[driver].last, lap))
                self._pass_on(rows[:cut], places[driver], events, runs)
                places[driver].held = len(rows) - cut
        gone = {d for d, p in places.items() if self.idle_ms and 0 <= p.gone_at <= now and not p.held}
        if gone and due is not None:
            entries = entries or self._entries()
        if entries:
            # Of a driver who is forgotten, no lap that has left may stay in an entry.
            due = self._release(entries, places, every=bool(gone))
        if entries or gone:
            self._update({d: p for d, p in places.items() if d not in gone}, serial, due)
        if events:
            yield pd.DataFrame({"event": events, "consecutive_high": runs})

    def close(self) -> None:
        pass


def timed(events: DataFrame, lateness: str) -> DataFrame:
    """Events with their time as a timestamp, `_at`, and a watermark that far behind the newest.

    Heartbeats, events without a driver, move the watermark and go no further. The condition speaks of
    the event time too, or the optimizer would drop them before the watermark has seen them.
    """
    marked = events.withColumn("_at", F.col("event_time").try_cast("timestamp")).withWatermark("_at", lateness)
    has_driver = F.coalesce(F.col("driver_code"), F.lit("")) != F.lit("")
    return marked.filter(F.when(F.col("_at") < F.lit(_BEFORE_ALL).cast("timestamp"), F.lit(False)).otherwise(has_driver))


def track_runs(events: DataFrame, idle: str | None = None) -> DataFrame:
    """Streaming twin of add_consecutive_high: events, as `timed` gives them, with the run counted in lap order.

    Events leave in lap order per driver, later than they came if an earlier lap was missing. One whose
    time cannot be read waits, if it has to, for the next move of the watermark. With idle set, the state
    of a driver unseen for that many milliseconds of event time is dropped.
    """
    ship_package(events.sparkSession)
    for name, value in STATE_SETTINGS.items():
        events.sparkSession.conf.set(name, value)
    up = F.coalesce((F.col("risk_status") == "HIGH") & F.col("clean_lap"), F.lit(False))
    names = [c for c in events.columns if c != "_at"]
    at = F.coalesce(F.unix_millis("_at"), F.lit(0))
    # Year and round are numbers, so only a driver's own name can hold the mark between them.
    driver = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in LIVE_KEYS[:2]], LIVE_KEYS[2])
    # Python sees what the count needs; the event itself waits and passes as one text, its fields by number.
    short = [F.col(c).alias(str(i)) for i, c in enumerate(names)]
    packed = events.select(
        F.pmod(F.xxhash64(*LIVE_KEYS), F.lit(GROUPS)).alias("drivers"), driver.alias(_DRIVER),
        F.col(_LAP).alias("lap"), at.alias("at"), up.alias("up"), F.to_json(F.struct(*short)).alias("event"),
    )
    counted = packed.groupBy("drivers").transformWithStateInPandas(
        LapOrder(int(idle) if idle else None), "event string, consecutive_high bigint", "append", "EventTime"
    )
    schema = events.select(*short).schema
    found = [F.col("e").getField(str(i)).alias(c) for i, c in enumerate(names)]
    return counted.select(F.from_json("event", schema).alias("e"), "consecutive_high").select(*found, "consecutive_high")
