"""Keyed event-time folds: what a key remembers, and what each event makes of it.

A fold is plain Python on one event at a time. ``step`` takes the state and the
event, ``expire`` is told that time has passed ``now``, and ``deadline`` names the
last instant the state is waiting for. Times are epoch microseconds. ``after`` gives what
the keys of a finite history remember at its end, by the batch engine, so that a
stream can begin there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.automaton import Step, chain
from tidemark.plans.timers import NONE, step as timer_step


class Fold:
    state_ddl = ""
    out_ddl = ""

    def start(self) -> tuple:
        raise NotImplementedError

    def step(self, state: tuple, at: int, tie: int, row) -> tuple[tuple, list[tuple]]:
        raise NotImplementedError

    def deadline(self, state: tuple) -> int | None:
        return None

    def expire(self, state: tuple, now: int) -> tuple[tuple, list[tuple]]:
        return state, []

    def after(self, history: DataFrame, keys: Sequence[str], ts: str, tie: str) -> DataFrame:
        raise NotImplementedError(f"{type(self).__name__} cannot begin from a history")


class Jump(Fold):
    """Alert when a value differs from the last one by more than ``limit``. A null value is
    silent, and so is the one after it (or it is compared with 0.0, as the first one is)."""

    state_ddl = "last double"
    out_ddl = "tie long, last double, current double"

    def __init__(self, value: str, limit: float, first_from_zero: bool = False):
        self.value, self.limit = value, limit
        self.first = 0.0 if first_from_zero else None

    def start(self):
        return (self.first,)

    def step(self, state, at, tie, row):
        last, now = self.first if state[0] is None else state[0], row[self.value]
        alert = None not in (last, now) and abs(last - now) > self.limit
        return (now,), [(tie, last, now)] if alert else []

    def after(self, history, keys, ts, tie):
        return history.groupBy(*keys).agg(F.max_by(self.value, F.struct(ts, tie)).alias("last"))


class _Timer(Fold):
    """State: timer start and tie, opens so far, last open, then the subclass's own."""

    def __init__(self, span_us: int):
        self.span = span_us

    def deadline(self, state):
        return None if (state[0], state[1]) == NONE else state[0] + self.span

    def expire(self, state, now):
        end = self.deadline(state)
        if end is None or now <= end:
            return state, []
        return (*NONE, 0, 0, *state[4:]), self.expired(state)

    def event(self, state, at, tie, opens):
        timer, owner = timer_step((state[0], state[1]), at, tie, opens, self.span)
        n = state[2] + 1 if owner == (state[0], state[1]) else 1
        return (*timer, n, at) if timer != NONE else (*NONE, 0, 0)


class Rise(_Timer):
    """A rise starts a timer, a fall stops it, expiry alerts. A null value is neither, and
    the one after it is compared with 0.0, as the first one is."""

    state_ddl = "start long, start_tie long, opens long, last_open long, value double"
    out_ddl = "start long, alert_at long"

    def __init__(self, value: str, span_us: int):
        super().__init__(span_us)
        self.value = value

    def start(self):
        return (*NONE, 0, 0, 0.0)

    def expired(self, state):
        return [(state[0], state[0] + self.span)]

    def step(self, state, at, tie, row):
        now, last = row[self.value], 0.0 if state[4] is None else state[4]
        timer = state[:4] if now is None or now == last else self.event(state, at, tie, now > last)
        return (*timer, now), []


class Burst(_Timer):
    """More than ``limit`` failures in one timer, none of it stopped by a success. A null
    kind is neither."""

    state_ddl = "start long, start_tie long, opens long, last_open long"
    out_ddl = "first_fail long, last_fail long, fails long"

    def __init__(self, kind: str, limit: int, span_us: int):
        super().__init__(span_us)
        self.kind, self.limit = kind, limit

    def start(self):
        return (*NONE, 0, 0)

    def expired(self, state):
        return [(state[0], state[3], state[2])] if state[2] > self.limit else []

    def step(self, state, at, tie, row):
        if row[self.kind] is None:
            return state, []
        return self.event(state, at, tie, row[self.kind] == "fail"), []


class AdjacentRun(Fold):
    """Adjacent events of the given kinds, first to last in less than ``within``."""

    state_ddl = "kinds array<string>, times array<long>"
    out_ddl = "first_at long, last_at long"

    def __init__(self, kind: str, steps: Sequence[str], within_us: int):
        self.kind, self.steps, self.within = kind, list(steps), within_us

    def start(self):
        return ([], [])

    def step(self, state, at, tie, row):
        n = len(self.steps)
        kinds = [*state[0], row[self.kind]][-n:]
        times = [*state[1], at][-n:]
        hit = kinds == self.steps and at - times[0] < self.within
        return (kinds, times), [(times[0], at)] if hit else []


class Sequences(Fold):
    """Matches of a pattern of steps in less than ``within``: the unfinished ones, oldest first,
    each with the place that it has come to. A null kind leads nowhere."""

    state_ddl = "times array<long>, ties array<long>, places array<int>"
    out_ddl = "first_tie long, first_at long, last_at long"

    def __init__(self, kind: str, steps: Sequence[Step], within_us: int):
        self.kind, self.within = kind, within_us
        self.chain = chain(steps)

    def start(self):
        return ([], [], [])

    def deadline(self, state):
        return state[0][0] + self.within - 1 if state[0] else None

    def expire(self, state, now):
        gone = sum(1 for t in state[0] if now >= t + self.within)
        return tuple(list(x[gone:]) for x in state), []

    def step(self, state, at, tie, row):
        kept, made = [], []
        for begun, owner, place in [*zip(*state), (at, tie, 0)]:
            kinds, relaxed = self.chain[place]
            if row[self.kind] in kinds:
                place += 1
            elif not relaxed or not place:
                continue
            if place < len(self.chain):
                kept.append((begun, owner, place))
            else:
                made.append((owner, begun, at))
        return tuple(map(list, zip(*kept))) if kept else self.start(), made


class FollowedBy(Fold):
    """Every ``begin`` with the first later ``end`` in less than ``within``."""

    state_ddl = "ties array<long>, times array<long>"
    out_ddl = "tie long, end_at long, status string"

    def __init__(self, kind: str, begin: str, end: str, within_us: int):
        self.kind, self.begin, self.end, self.within = kind, begin, end, within_us

    def start(self):
        return ([], [])

    def deadline(self, state):
        return state[1][0] + self.within - 1 if state[1] else None

    def expire(self, state, now):
        gone = sum(1 for t in state[1] if now >= t + self.within)
        late = [(tie, None, "timeout") for tie in state[0][:gone]]
        return (list(state[0][gone:]), list(state[1][gone:])), late

    def step(self, state, at, tie, row):
        if row[self.kind] == self.begin:
            return ([*state[0], tie], [*state[1], at]), []
        if row[self.kind] == self.end:
            return ([], []), [(t, at, "pay success") for t in state[0]]
        return state, []


class OrderOutcome(Fold):
    """The outcome of every create and pay. A create that is not paid in time is reported as
    soon as its time is over, and remembered for ``keep`` more, so that its pay can still be
    told from one without a create. Other kinds of events are nothing."""

    state_ddl = "tie long, at long, reported boolean"
    out_ddl = "tie long, status string"

    def __init__(self, kind: str, within_us: int, keep_us: int):
        self.kind, self.within, self.keep = kind, within_us, keep_us

    def start(self):
        return (*NONE, False)

    def deadline(self, state):
        if state[:2] == NONE:
            return None
        # a pay at create + within is too late
        return state[1] + self.within - 1 + (self.keep if state[2] else 0)

    def expire(self, state, now):
        out = []
        end = self.deadline(state)
        if end is not None and now > end and not state[2]:
            out, state = [(state[0], "pay timeout")], (*state[:2], True)
            end = self.deadline(state)
        return (self.start() if end is not None and now > end else state), out

    def step(self, state, at, tie, row):
        if row[self.kind] not in ("create", "pay"):
            return state, []
        opened = state[:2] != NONE
        late = [(state[0], "pay timeout")] if opened and not state[2] else []
        if row[self.kind] == "create":
            return (tie, at, False), late
        if not opened:
            return self.start(), [(tie, "paid without create")]
        if at - state[1] < self.within:
            return self.start(), [(tie, "pay successfully")]
        return self.start(), [*late, (tie, "paid but timed out")]


class ClickFilter(Fold):
    """Per UTC day: ``limit`` passes, one warning, then nothing."""

    state_ddl = "day long, seen long"
    out_ddl = "tie long, tag string"
    DAY = 86_400_000_000

    def __init__(self, limit: int):
        self.limit = limit

    def start(self):
        return (-1, 0)

    def step(self, state, at, tie, row):
        day = at // self.DAY
        seen = state[1] + 1 if state[0] == day else 1
        tags = ["pass"] if seen <= self.limit else ["warning"] if seen == self.limit + 1 else []
        return (day, min(seen, self.limit + 2)), [(tie, tag) for tag in tags]

    def after(self, history, keys, ts, tie):
        day = F.call_function("div", F.unix_micros(ts), F.lit(self.DAY)).alias("day")
        days = history.groupBy(*keys, day).agg(F.least(F.count(F.lit(1)), F.lit(self.limit + 2)).alias("seen"))
        return days.groupBy(*keys).agg(F.max("day").alias("day"), F.max_by("seen", "day").alias("seen"))


class Rolling(Fold):
    """Count and mean over the last rows; a null value is not counted."""

    state_ddl = "recent array<double>"
    out_ddl = "tie long, cnt long, mean double"

    def __init__(self, value: str, preceding: int):
        self.value, self.size = value, preceding + 1

    def start(self):
        return ([],)

    def step(self, state, at, tie, row):
        recent = [*state[0], row[self.value]][-self.size:]
        there = [v for v in recent if v is not None]
        return (recent,), [(tie, len(there), sum(there) / len(there) if there else None)]


class TopTwo(Fold):
    """The two highest values, reported whenever they change; nulls come last."""

    state_ddl = "best array<double>, version long"
    out_ddl = "version long, rank int, value double"

    def __init__(self, value: str):
        self.value = value

    def start(self):
        return ([], 0)

    def step(self, state, at, tie, row):
        both = [*state[0], row[self.value]]
        best = sorted(both, key=lambda v: (v is not None, v or 0.0), reverse=True)[:2]
        if best == list(state[0]):
            return state, []
        version = state[1] + 1
        padded = (best + [None])[:2]
        return (best, version), [(version, i + 1, v) for i, v in enumerate(padded)]


class CountLog(Fold):
    """Changelog of a running count: take back the old row, add the new one."""

    state_ddl = "cnt long"
    out_ddl = "op string, cnt long"

    def start(self):
        return (0,)

    def step(self, state, at, tie, row):
        old, new = state[0], state[0] + 1
        return (new,), ([("-", old)] if old else []) + [("+", new)]

    def after(self, history, keys, ts, tie):
        return history.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
