"""State processors: latest join with expiry, enrichment, and the monitoring loop.

Rows are held until the watermark passes them and are then taken in order of time, so a
stream gives what the batch operators give, in whatever order its files come.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType


class OrderedProcessor(StatefulProcessor):
    """Holds rows above the watermark; apply(state, row) gives the next state and output rows.

    A key has one timer, at its earliest row held. When it expires, all rows that the
    watermark has passed are taken in order, and the timer moves to the earliest that is
    left, so that held rows are read and written once a batch. Time is the column at_ms
    that process() adds, so no time zone plays a part.
    """

    state_schema = ""
    start: tuple = ()

    def __init__(self, input_schema: StructType, ts: str = "ts"):
        self.input_schema, self.ts = input_schema, ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", self.input_schema)
        self.state = handle.getValueState("state", self.state_schema)
        self.next = handle.getValueState("next", "at long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        rows = [tuple(row) for row in rows]
        at = self.input_schema.fieldNames().index("at_ms")
        self.pending.appendList(rows)
        self._wake(min(row[at] for row in rows) + 1)
        return iter([])

    def _wake(self, at: int) -> None:
        """Sets the key's timer, unless it is due earlier already."""
        known = self.next.get()[0] if self.next.exists() else None
        if known is None or at < known:
            if known is not None:
                self.handle.deleteTimer(known)
            self.handle.registerTimer(at)
            self.next.update((at,))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        names = self.input_schema.fieldNames()
        rows = [Row(*names)(*r) for r in self.pending.get()]
        due = sorted((r for r in rows if r["at_ms"] < now), key=self.order)
        left = [r for r in rows if r["at_ms"] >= now]
        self.pending.clear()
        self.next.clear()
        if left:
            self.pending.put([tuple(r) for r in left])
            self._wake(min(r["at_ms"] for r in left) + 1)
        state = tuple(self.state.get()) if self.state.exists() else self.start
        taken = set()
        for row in due:
            same = self.identity(row)
            if same is None or same not in taken:
                state, out = self.apply(state, row)
                yield from out
            taken.add(same)
        self.state.update(state)

    def order(self, row: Row) -> tuple:
        return (row["at_ms"],)

    def identity(self, row: Row) -> tuple | None:
        """What tells rows of a key apart, if a source may give a row twice."""
        return None

    def apply(self, state: tuple, row: Row) -> tuple[tuple, list[Row]]:
        raise NotImplementedError

    def close(self) -> None:
        pass


class LatestJoinProcessor(OrderedProcessor):
    """Newest left and right value of a key, emitted on either's update; rows: key, ts, side, value, snapshot.

    A right side that misses two snapshots is wiped: `tick` rows mark each snapshot.
    """

    state_schema = "left string, left_ts timestamp, right string, right_ts timestamp, missed int"
    start = (None, None, None, None, 0)
    output = "key string, ts timestamp, left string, right string, wiped boolean"

    def order(self, row: Row) -> tuple:
        return (row["at_ms"], {"left": 0, "right": 1, "tick": 2}[row.side])

    def apply(self, state: tuple, row: Row) -> tuple[tuple, list[Row]]:
        left, left_ts, right, right_ts, missed = state
        if row.side == "tick":
            if right_ts is None:
                return state, []
            if missed + 1 > 2:  # its own snapshot's tick and two more
                out = [Row(key=row.key, ts=row.ts, left=left, right=None, wiped=True)] if left_ts else []
                return (left, left_ts, None, None, 0), out
            return (left, left_ts, right, right_ts, missed + 1), []
        if row.side == "left":
            left, left_ts = row.value, row.ts
        else:
            right, right_ts, missed = row.value, row.ts, 0
        out = [Row(key=row.key, ts=min(left_ts, right_ts), left=left, right=right, wiped=False)] if left_ts and right_ts else []
        return (left, left_ts, right, right_ts, missed), out


class EnrichProcessor(OrderedProcessor):
    """Facts with the last present value of each attribute; rows: key, ts, kind (0 attribute, 1 fact), id, name, value."""

    state_schema = "held map<string,string>, seen boolean"
    start = ({}, False)
    output = "key string, ts timestamp, id long, held map<string,string>, enriched boolean"

    def order(self, row: Row) -> tuple:
        return (row["at_ms"], row.kind)

    def apply(self, state: tuple, row: Row) -> tuple[tuple, list[Row]]:
        held, seen = state
        if row.kind == 0:
            return ({**held, row.name: row.value}, True), []
        return state, [Row(key=row.key, ts=row.ts, id=row.id, held=held, enriched=seen)]


class HealthOverProcessor(OrderedProcessor):
    """The streaming form of health.health_over_sql(): the last n rows of a line in a ring, with sums that leave out nulls; rows: key, ts, id, reInit, uas."""

    state_schema = "last array<struct<reInit:int,uas:int>>"
    start = ([],)
    output = "key string, ts timestamp, id long, cnt long, sum_reinit long, sum_uas long"

    def __init__(self, input_schema: StructType, n: int = 3, max_reinit: int = 60, max_uas: int = 18000):
        super().__init__(input_schema)
        self.n, self.max_reinit, self.max_uas = n, max_reinit, max_uas

    def order(self, row: Row) -> tuple:
        return (row["at_ms"], row.id)

    def apply(self, state: tuple, row: Row) -> tuple[tuple, list[Row]]:
        last = [*(tuple(x) for x in state[0] or []), (row.reInit, row.uas)][-self.n :]
        total = lambda i: sum(present) if (present := [x[i] for x in last if x[i] is not None]) else None
        few, short = total(0), total(1)
        if len(last) < self.n or few is None or short is None or few > self.max_reinit or short > self.max_uas:
            return (last,), []
        return (last,), [Row(key=row.key, ts=row.ts, id=row.id, cnt=len(last), sum_reinit=few, sum_uas=short)]


class GateProcessor(OrderedProcessor):
    """The streaming form of health.watch_gate(): events of lines that are switched on at their time; rows as of tagged_events()."""

    state_schema = "flag boolean"
    start = (False,)
    output = "key string, ts timestamp, id long, reInit int, uas int, up boolean"

    def order(self, row: Row) -> tuple:
        return (row["at_ms"], row.kind, bool(row.flag), row.id or 0)

    def apply(self, state: tuple, row: Row) -> tuple[tuple, list[Row]]:
        if row.kind == 0:
            return (bool(row.flag),), []
        return state, [Row(key=row.key, ts=row.ts, id=row.id, reInit=row.reInit, uas=row.uas, up=row.up)] if state[0] else []


class MonitorLoopProcessor(OrderedProcessor):
    """Gate, pattern and feedback in one state; rows: key, ts, kind (0 toggle, 1 event), id, flag, reInit, uas, up, held.

    A toggle starts with the rows in held (health.seed_toggles() finds them in a history
    table), oldest first, or with none.
    """

    state_schema = "flag boolean, held array<struct<reInit:int,uas:int,up:boolean>>"
    start = (False, [])
    output = "key string, ts timestamp, id long"

    def __init__(self, input_schema: StructType, n: int, m: int, max_reinit: int, max_uas: int):
        super().__init__(input_schema)
        self.n, self.m, self.max_reinit, self.max_uas = n, m, max_reinit, max_uas

    def order(self, row: Row) -> tuple:
        return (row["at_ms"], row.kind, bool(row.flag), row.id or 0)

    def identity(self, row: Row) -> tuple:
        return (row["at_ms"], row.kind, row.flag, row.id)

    def apply(self, state: tuple, row: Row) -> tuple[tuple, list[Row]]:
        flag, held = state
        if row.kind == 0:
            return (row.flag, [tuple(h) for h in row.held or []][-self.n :]), []
        if not flag:
            return state, []
        held = [*(tuple(h) for h in held), (row.reInit or 0, row.uas or 0, bool(row.up))][-self.n :]
        last = held[-self.m :]
        up = len(held) == self.n and sum(h[0] for h in held) < self.max_reinit and sum(h[1] for h in last) < self.max_uas and all(h[2] for h in last)
        if up:  # the match switches the line off
            return (False, []), [Row(key=row.key, ts=row.ts, id=row.id)]
        return (True, held), []


def process(stream: DataFrame, processor: OrderedProcessor, lateness: str, key: str = "key", ts: str = "ts") -> DataFrame:
    """Runs a processor over the stream by key."""
    stream = stream.withColumn("at_ms", F.unix_millis(F.col(ts).cast("timestamp")))
    processor.input_schema = stream.schema
    rows = stream.withWatermark(ts, lateness).groupBy(key)
    return rows.transformWithState(processor, StructType.fromDDL(processor.output), "Append", "EventTime")


def tagged_events(events: DataFrame, toggles: DataFrame, key: str) -> DataFrame:
    """Events and toggles, with held if seeded, as one stream for MonitorLoopProcessor."""
    kind = "array<struct<reInit:int,uas:int,up:boolean>>"
    null = lambda t: F.lit(None).cast(t)
    held = F.col("held").cast(kind) if "held" in toggles.columns else null(kind)
    facts = events.select(F.col(key).cast("string").alias("key"), "ts", F.lit(1).alias("kind"), F.col("event_id").alias("id"), null("boolean").alias("flag"), "reInit", "uas", F.col("ifOperStatus").alias("up"), null(kind).alias("held"))
    switches = toggles.select(F.col(key).cast("string").alias("key"), "ts", F.lit(0).alias("kind"), null("long").alias("id"), "flag", null("int").alias("reInit"), null("int").alias("uas"), null("boolean").alias("up"), held.alias("held"))
    return facts.unionByName(switches)
