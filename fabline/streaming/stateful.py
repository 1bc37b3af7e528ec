"""Event-time ordered keyed state machines on typed state (W2, W3, W5-W8, S3, A1).

``OrderedFold`` is the base: rows wait in entries of a map state until the watermark reaches them, an event-time
timer set for the earliest waiting row wakes the key, and due rows are applied in ``(ts_us, seq)`` order to a
typed value state. What a key gets in a micro-batch is sorted and cut into entries, of two rows where it gets few and of
``ENTRY_ROWS`` where it gets very many, so calls to the state grow far slower than a hot key's rows. A micro-batch therefore
writes its own rows and removes the due ones; rows that go on waiting are not written again, but for those that share an
entry with a due one. Where keys are very many and have few rows each, ``GroupedFold`` keeps groups of them under one key of the state. Due entries are unpacked one after the other in time order, never all at once. Neither the cut into micro-batches nor the order of rows within the delay matters; the step functions
are those of the batch operators. State needs the RocksDB provider (``use_rocksdb``).

PySpark gathers what all timers of a task emit, one dict a row, before it writes any of it. So a timer emits its rows packed,
up to ``PACKED_ROWS`` in a value, and ``run_ordered`` unpacks them behind the state, value by value.

* ``delta_trigger_live``: the delta trigger keyed by key *and window*, since a window starts anew: a key with very many
  rows is spread over its windows, and a window's state goes when the watermark has passed its end.
* ``alarms_live``: cool-down alarms whose START is sent by a timer when it is due, also without a further reading.
* ``export_live``: full export batches per series, out of a list state that is flushed at ``batch`` rows.
* ``lifecycle_live``: the material lifecycle with an allow-list that changes by control messages, started from a table.
* ``daily_quality_live``: daily counts that follow arriving files.
* ``split_late``: on-time and late rows of a running stream as two tables.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections import namedtuple
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from fabline.functions import codes as C
from fabline.operators.aggs import daily_counts
from fabline.operators.anomaly import cooldown_spec
from fabline.operators.fold import FoldSpec
from fabline.operators.lifecycle import ALLOW_TOPIC, LIFE_STATE, LIFECYCLE_TOPICS, LIVE_SPEC, REMOVE_TOPIC
from fabline.operators.triggers import delta_input, delta_output, delta_spec, mean_change, watermark_late, window_ms, window_seconds

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Typed state needs the RocksDB provider; a running query keeps the one it was started with."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


@contextmanager
def state_partitions(spark: SparkSession, most: int) -> Iterator[None]:
    """Queries started inside have no more than ``most`` state partitions; a query keeps the settings it is started with."""
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(partitions), most)))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


@dataclass
class TypedState:
    """A fold's state as columns: ``pack(state)`` gives the tuple that ``unpack`` turns back."""
    schema: str
    pack: Callable[[object], tuple] = tuple
    unpack: Callable[[tuple], object] = list


SORTED_ROWS = 16_384  # arriving rows of a key that are sorted together
ENTRY_ROWS = SORTED_ROWS // 32
OPEN_ENTRIES = 32  # waiting entries unpacked together
PACKED_ROWS = 4096  # rows that leave a key in one value
_place = itemgetter(0)


def _names(schema: str) -> list[str]:
    return [f.name for f in T._parse_datatype_string(schema).fields]


class OrderedFold(StatefulProcessor):
    """A ``FoldSpec`` over a stream's rows in event-time order; see the module. ``rows`` is the schema of what a row brings."""

    least_entry = 2  # rows of an entry at least

    def __init__(self, spec: FoldSpec, state: TypedState, rows: str, keys: list[str], idle_ms: int | None = None):
        self.spec, self.state, self.rows, self.idle_ms = spec, state, rows, idle_ms
        self.cols, self.held_cols, self.held_schema = _names(rows), _names(state.schema), state.schema
        self.out, self.packed = Row(*keys, *_names(spec.out_schema)), Row("packed")

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", self.held_schema)
        self.waiting = handle.getMapState("waiting", "ts_us long, n long", "last_us long, n_rows long, rows binary")
        self.clock = handle.getValueState("clock", "arrived long, timer long")
        self.input = namedtuple("Input", self.cols)

    def close(self) -> None:
        pass

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.held.update(tuple(initialState[c] for c in self.held_cols))

    def _wake(self, arrived: int, timer: int | None, at: int | None) -> None:
        """Note the number of rows so far and set the timer for ``at``, unless an earlier one is set."""
        if at is not None and (timer is None or at < timer):
            self.handle.registerTimer(at)
            timer = at
        self.clock.update((arrived, timer))

    def _store(self, rows: list, n: int) -> None:
        """One entry of sorted rows; ``n`` is the arrival number of a row that only this entry holds."""
        self.waiting.updateValue((rows[0][0][0], n), (rows[-1][0][0], len(rows), pickle.dumps(rows, pickle.HIGHEST_PROTOCOL)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        arrived, timer = self.clock.get() or (0, None)
        first, at = None, None
        rows = iter(rows)
        while some := list(islice(rows, SORTED_ROWS)):
            if at is None:
                names = list(some[0].__fields__)
                at, ts, seq = [names.index(c) for c in self.cols], names.index("ts_us"), names.index("seq")
            place = [((r[ts], r[seq] is not None, r[seq] or 0, n), tuple([r[i] for i in at])) for n, r in enumerate(map(tuple, some), arrived)]
            place.sort(key=_place)
            size = max(self.least_entry, -(-len(place) // 32))
            for lo in range(0, len(place), size):
                self._store(place[lo:lo + size], arrived + lo)
            arrived += len(place)
            first = place[0][0][0] if first is None else min(first, place[0][0][0])
        self._wake(arrived, timer, None if first is None else first // 1000 + 1)
        return iter(())

    def _due(self, entries: list, now: int, left: list) -> Iterator[tuple]:
        """Rows of the entries up to ``now`` (microseconds) in order; entries hold sorted rows and come by their first time.
        Rows after ``now`` go to ``left``, with their entry's number."""
        held: list = []
        for lo in range(0, len(entries), OPEN_ENTRIES):
            for (_, n), (last, _, packed) in entries[lo:lo + OPEN_ENTRIES]:
                rows = pickle.loads(packed)
                if last > now:
                    left.append((n, [r for r in rows if r[0][0] > now]))
                    rows = [r for r in rows if r[0][0] <= now]
                held.extend(rows)
            held.sort(key=_place)
            until, ready = entries[lo + OPEN_ENTRIES][0][0] if lo + OPEN_ENTRIES < len(entries) else None, len(held)
            if until is not None:
                ready = bisect_left(held, until, key=lambda r: r[0][0])
            for _, v in islice(held, ready):
                yield self.input(*v)
            del held[:ready]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        rows = map(tuple, self.expired(key, timerValues, expiredTimerInfo))
        while some := list(islice(rows, PACKED_ROWS)):
            yield self.packed(pickle.dumps(some, pickle.HIGHEST_PROTOCOL))

    def expired(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """What a timer emits, row by row."""
        arrived, timer = self.clock.get() or (0, None)
        now = timerValues.getCurrentWatermarkInMs()
        if timer is None or expiredTimerInfo.getExpiryTimeInMs() != timer:
            return  # an earlier timer has done its work
        entries, next_us = [], None
        for k, v in self.waiting.iterator():
            if k[0] <= now * 1000:
                entries.append((tuple(k), tuple(v)))
            elif next_us is None or k[0] < next_us:
                next_us = k[0]
        entries.sort(key=_place)
        if entries:
            left: list = []
            yield from self.apply(key, self._due(entries, now * 1000, left), now)
            for k, _ in entries:
                self.waiting.removeKey(k)
            for n, rows in left:
                self._store(rows, n)
                next_us = rows[0][0][0] if next_us is None else min(next_us, rows[0][0][0])
        self._rest(key, now, arrived, None if next_us is None else next_us // 1000 + 1, bool(entries))

    def _rest(self, key, now: int, arrived: int, at: int | None, applied: bool) -> None:
        """Set the next timer, for the earliest waiting row (``at``) or the end of a key without any."""
        if at is not None:
            self._wake(arrived, None, at)
        elif applied or not self.done(key, now):
            self._wake(arrived, None, self.lifetime(key, now))
        else:
            self.clock.clear()
            self.held.clear()

    def apply(self, key, rows: Iterable, now: int) -> Iterator[Row]:
        """Apply due rows, which come in order."""
        held = self.held.get()
        held = self.spec.init() if held is None else self.state.unpack(held)
        for r in rows:
            held, emitted = self.spec.step(held, r)
            for o in emitted or ():
                yield self.out(*key, *o)
        if held is not None:
            self.held.update(self.state.pack(held))

    def lifetime(self, key, now: int) -> int | None:
        """When a key without waiting rows is forgotten."""
        return None if self.idle_ms is None else now + self.idle_ms

    def done(self, key, now: int) -> bool:
        return True


class GroupedFold(OrderedFold):
    """A fold of very many keys with few rows each. The state is keyed by groups of keys (``groups`` of ``run_ordered``): a call to
    it costs as much as some ten rows, and its calls follow the groups and their entries, not the keys. A row brings its key
    as the column ``of``. A group's folds are one value: key -> (state, watermark when it was last applied)."""

    least_entry = ENTRY_ROWS

    def __init__(self, spec: FoldSpec, state: TypedState, rows: str, of: str, idle_ms: int | None = None):
        super().__init__(spec, state, rows, [of], idle_ms)
        self.of, self.of_at, self.held_schema = of, self.cols.index(of), "folds binary"

    def _folds(self) -> dict:
        held = self.held.get()
        return {} if held is None else pickle.loads(held[0])

    def _keep(self, folds: dict) -> None:
        self.held.update((pickle.dumps(folds, pickle.HIGHEST_PROTOCOL),))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._keep({r[self.of]: (tuple(r[c] for c in self.held_cols), None) for r in initialState["folds"]})

    def apply(self, key, rows, now: int) -> Iterator[tuple]:
        folds, new = self._folds(), {}
        for r in rows:
            k = r[self.of_at]
            if k in new:
                held = new[k]
            else:
                held = self.state.unpack(folds[k][0]) if k in folds else self.spec.init()
            new[k], emitted = self.spec.step(held, r)
            for o in emitted or ():
                yield (k, *o)
        folds.update((k, (self.state.pack(held), now)) for k, held in new.items() if held is not None)
        self._keep(folds)

    def _rest(self, key, now: int, arrived: int, at: int | None, applied: bool) -> None:
        if self.idle_ms is not None:
            folds = self._folds()
            ends = {k: last + self.idle_ms for k, (_, last) in folds.items() if last is not None}
            gone = {k for k, end in ends.items() if end <= now}
            if gone and at is not None:  # a key with waiting rows stays
                gone -= {v[self.of_at] for _, (_, _, packed) in self.waiting.iterator() for _, v in pickle.loads(packed)}
            if gone:
                self._keep({k: v for k, v in folds.items() if k not in gone})
            at = min((end for end in [*ends.values(), at] if end is not None and end > now), default=at)
        self._wake(arrived, None, at)


def run_ordered(rows: DataFrame, keys: list[str], processor: OrderedFold, delay: str, ts: str = "ts", seq: str = "seq",
                initial: DataFrame | None = None, groups: int | None = None) -> DataFrame:
    """Rows (keys, ts, ts_us, seq, the processor's columns) through a processor; rows without a time are left out
    (``without_time`` gives them), rows later than ``delay`` are dropped by the watermark (``split_late`` keeps them).
    ``initial`` is a table of keys and state columns that a new query starts from; a restarted one has its own state.
    A ``GroupedFold`` takes the keys dealt into ``groups``, a number that a checkpoint goes on with."""
    use_rocksdb(rows.sparkSession)
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    cols = dict.fromkeys([*keys, ts, "ts_us", seq, *processor.cols])
    timed = rows.where(F.col(ts).isNotNull()).select(*cols).withColumnRenamed(seq, "seq").withWatermark(ts, delay)
    start, by = None if initial is None else initial.select(*keys, *_names(processor.state.schema)), keys
    if groups:
        by, group = ["__group"], F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int").alias("__group")
        timed = timed.select("*", group)
        start = None if start is None else start.groupBy(group).agg(F.collect_list(F.struct(*start.columns)).alias("folds"))
    start = None if start is None else start.groupBy(*by)
    packed = timed.groupBy(*by).transformWithState(processor, "packed binary", "Append", "EventTime", start)
    return packed.mapInArrow(_unpacker(f"{kinds}, {processor.spec.out_schema}"), f"{kinds}, {processor.spec.out_schema}")


def _unpacker(schema: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ``schema`` out of packed values, a batch of up to about two values' rows at a time."""
    fields = T._parse_datatype_string(schema).fields
    names, kinds = [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]

    def table(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def unpack(batches):
        rows: list = []
        for batch in batches:
            for value in batch.column(0):
                rows.extend(pickle.loads(value.as_py()))
                if len(rows) >= PACKED_ROWS:
                    yield table(rows)
                    rows = []
        if rows:
            yield table(rows)

    return unpack


def without_time(rows: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows of a stream that no watermark can ever reach, for a side table."""
    return rows.where(F.col(ts).isNull())


# --- W2 ---------------------------------------------------------------------
TRIGGER_STATE = "window long, ax double, ay double, az double, ets long, es long, ex double, ey double, ez double"
TRIGGER_ROWS = "ts_us long, seq long, x double, y double, z double, rolling boolean"


class WindowFold(OrderedFold):
    """A fold keyed by (key, window start): its state goes when the watermark has passed the window's end."""

    def __init__(self, *args, window_us: int, **kw):
        super().__init__(*args, **kw)
        self.window_us = window_us

    def lifetime(self, key, now: int) -> int:
        return max((key[1] + self.window_us) // 1000, now) + 1

    def done(self, key, now: int) -> bool:
        return now * 1000 >= key[1] + self.window_us


def delta_trigger_live(stream: DataFrame, delay: str, key: str = "key", ts: str = "ts", seq: str = "seq",
                       window: str = window_ms(C.WINDOW_MS), threshold: float = C.DELTA_THRESHOLD,
                       level_limit: float = C.VIBRATION_LIMIT, rolling: str | None = "rolling", delta_fn=mean_change) -> DataFrame:
    """The delta trigger over a stream: a reading that fires leaves as soon as the watermark reaches it, not when its
    window closes. Same rows as ``delta_trigger`` for readings that are no later than ``delay``."""
    us = int(window_seconds(window) * 1_000_000)
    spec = delta_spec(us, threshold, level_limit, delta_fn)
    rows = delta_input(stream, key, ts, seq, rolling).withColumn("in_window", (F.floor(F.col("ts_us") / us) * us).cast("bigint"))
    keys = [key, "in_window"]
    out = run_ordered(rows, keys, WindowFold(spec, TypedState(TRIGGER_STATE), TRIGGER_ROWS, keys, window_us=us), delay)
    return delta_output(out, key, us)


# --- W4 / W5 / S11 ----------------------------------------------------------
ALARM_OUT = "event string, seq long, at_us long, alarm_us long, restart_us long, streak long"


class AlarmFold(OrderedFold):
    """Trigger and cool-down of one key. An alarm leaves as ``stop`` with the reading that raises it; its ``start`` is an
    entry of a map state until the watermark reaches the restart time, where its own timer sends it."""

    def __init__(self, window_us: int, threshold: float, level_limit: float, change_limit: float | None, cooldown_us: int,
                 alarm_over: int, key: str, idle_ms: int | None):
        trigger, cooldown = delta_spec(window_us, threshold, level_limit), cooldown_spec(cooldown_us, alarm_over)
        limit = level_limit / 2.0 if change_limit is None else change_limit
        fired_row = namedtuple("Fired", cooldown.in_cols)

        def step(state, r):
            first, second = state
            first, fired = trigger.step(first, r)
            out = []
            for _, fire_seq, _, ts_us, x, y, z, change, _, _, rolling in fired or ():
                bad = rolling and (abs(x) + abs(y) + abs(z)) / 3.0 < level_limit and change < limit
                second, alarms = cooldown.step(second, fired_row(ts_us=ts_us, fire_seq=fire_seq, bad=bad))
                out.extend(("stop", a[0], a[1], *a[1:]) for a in alarms or ())
            return [first, second], out

        width = len(_names(TRIGGER_STATE))
        state = TypedState(f"{TRIGGER_STATE}, streak long, until long",
                           lambda s: (*(s[0] or [None] * width), *s[1]),
                           lambda t: [None if t[0] is None else list(t[:width]), list(t[width:])])
        super().__init__(FoldSpec(lambda: [trigger.init(), cooldown.init()], step, trigger.in_cols, ALARM_OUT), state,
                         TRIGGER_ROWS, [key], idle_ms)

    def init(self, handle) -> None:
        super().init(handle)
        self.starts = handle.getMapState("starts", "restart_us long, seq long", "alarm_us long, streak long")

    def apply(self, key, rows, now: int) -> Iterator[Row]:
        for o in super().apply(key, rows, now):
            self.starts.updateValue((o.restart_us, o.seq), (o.alarm_us, o.streak))
            self.handle.registerTimer(o.restart_us // 1000 + 1)
            yield o

    def expired(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from super().expired(key, timerValues, expiredTimerInfo)
        now = timerValues.getCurrentWatermarkInMs()
        for (restart_us, seq), (alarm_us, streak) in list(self.starts.iterator()):
            if restart_us <= now * 1000:
                self.starts.removeKey((restart_us, seq))
                yield self.out(*key, "start", seq, restart_us, alarm_us, restart_us, streak)


def alarms_live(readings: DataFrame, delay: str, key: str = "key", window: str = window_ms(C.WINDOW_MS),
                threshold: float = C.DELTA_THRESHOLD, level_limit: float = C.VIBRATION_LIMIT, change_limit: float | None = None,
                cooldown_s: float = C.COOLDOWN_S, alarm_over: int = C.ALARM_STREAK, idle: str | None = None) -> DataFrame:
    """Live alarms: ``key, event (stop or start), seq, ts, alarm_ts, restart_ts, streak``; ``ts`` is when the event is due."""
    us = int(window_seconds(window) * 1_000_000)
    fold = AlarmFold(us, threshold, level_limit, change_limit, int(cooldown_s * 1_000_000), alarm_over, key,
                     int(window_seconds(idle) * 1000) if idle else None)
    out = run_ordered(delta_input(readings, key, "ts", "seq", "rolling"), [key], fold, delay)
    return out.select(key, "event", "seq", F.timestamp_micros("at_us").alias("ts"), F.timestamp_micros("alarm_us").alias("alarm_ts"),
                      F.timestamp_micros("restart_us").alias("restart_ts"), "streak")


def live_commands(events: DataFrame) -> DataFrame:
    """Motor control messages of live alarm events, each at its time: ``z``, ``p`` on stop, ``m``, ``s`` on start."""
    payloads = F.when(F.col("event") == "stop", F.array(F.lit("z"), F.lit("p"))).otherwise(F.array(F.lit("m"), F.lit("s")))
    return events.select(F.lit(C.ROLLING_CONTROL).alias("topic"), F.explode(payloads).alias("payload"), "ts", "seq")


# --- W7 ---------------------------------------------------------------------
def asof_live(rows: DataFrame, key: str, spec: FoldSpec, delay: str, idle: str | None = None) -> DataFrame:
    """Latest state per key attached to readings, in event-time order over both kinds of row (see ``stream.ASOF_SPEC``)."""
    kinds = "seq long, ts_us long, x double, y double, z double, is_motor boolean, state boolean"
    state = TypedState("state boolean", lambda s: (s,), lambda t: t[0])
    return run_ordered(rows, [key], OrderedFold(spec, state, kinds, [key], int(window_seconds(idle) * 1000) if idle else None), delay)


# --- W6 / W8 ----------------------------------------------------------------
ID_GROUPS = 2048  # groups of material ids in a stream's state
ID_PARTITIONS = ID_GROUPS // 16  # state partitions worth having for them; each costs a commit in every micro-batch


def lifecycle_live(msgs: DataFrame, state: DataFrame, delay: str, predictions: DataFrame | None = None, idle: str | None = None,
                   groups: int | None = None) -> DataFrame:
    """Lifecycle of materials over a stream of material and control messages: ``id`` and the actions.

    ``msgs`` is ``seq, ts, id, topic, payload``; messages of ``ALLOW_TOPIC`` and ``REMOVE_TOPIC`` change the allow-list while
    the stream runs, in time order with the others. ``state`` (see ``lifecycle_state``) is what a new stream starts from: the
    allow-list, or all that a batch has left. A null id is an id that is never allowed. Ids lie in ``groups`` of the state
    (``ID_GROUPS``); a checkpoint goes on with the number it was begun with.
    """
    m = msgs.where(F.col("topic").isin(*LIFECYCLE_TOPICS, ALLOW_TOPIC, REMOVE_TOPIC)).select(
        "id", "seq", "ts", "topic", F.when(F.col("topic") == ALLOW_TOPIC, F.col("payload")).alias("payload"))
    m = (m.withColumn("prediction", F.lit(None).cast("string")) if predictions is None
         else m.join(predictions.select("seq", "prediction"), "seq", "left"))
    rows = "ts_us long, seq long, id string, topic string, payload string, prediction string"
    fold = GroupedFold(LIVE_SPEC, TypedState(LIFE_STATE), rows, "id", int(window_seconds(idle) * 1000) if idle else None)
    return run_ordered(m.withColumn("ts_us", F.unix_micros("ts")), ["id"], fold, delay, initial=state, groups=groups or ID_GROUPS)


# --- S3 ---------------------------------------------------------------------
class ExportFold(OrderedFold):
    """Rows of a series gather in a list state and leave as a batch when it is full; what has gathered is only added to."""

    def __init__(self, batch: int, key: str, rows: str):
        self.batch = batch
        out = f"batch_no long, rn long, {rows}"
        super().__init__(FoldSpec(lambda: 0, None, _names(rows), out), TypedState("n long", lambda n: (n,), lambda t: t[0]), rows, [key])

    def init(self, handle) -> None:
        super().init(handle)
        self.open = handle.getListState("open", self.rows)

    def apply(self, key, rows, now: int) -> Iterator[Row]:
        n = (self.held.get() or (0,))[0]
        kept = n % self.batch  # rows of the open batch that the state holds
        fresh: list = []
        for r in rows:
            fresh.append(tuple(r))
            n += 1
            if n % self.batch == 0:
                gathered = [tuple(r) for r in self.open.get()] + fresh if kept else fresh
                for k, r in enumerate(gathered):
                    yield self.out(*key, n // self.batch - 1, n - self.batch + k + 1, *r)
                if kept:
                    self.open.clear()
                kept, fresh = 0, []
        if fresh:
            self.open.appendList(fresh)
        self.held.update((n,))


def export_live(rows: DataFrame, delay: str, series: str = "series", batch: int = C.EXPORT_BATCH) -> DataFrame:
    """Full export batches of a live series stream, in ``(ts, seq)`` order: ``series, batch_no, rn, seq, ts, quality, datapoints``."""
    kinds = "ts_us long, seq long, quality string, datapoints string"
    out = run_ordered(rows.withColumn("ts_us", F.unix_micros("ts")), [series], ExportFold(batch, series, kinds), delay)
    return out.select(series, "batch_no", "rn", "seq", F.timestamp_micros("ts_us").alias("ts"), "quality", "datapoints")


def write_micro_batches(stream: DataFrame, out: str, checkpoint: str, available_now: bool = True):
    """Each micro-batch as a folder ``micro=<number>`` that is written over when the micro-batch runs again."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/micro={number}")

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if available_now else w).start()


# --- A1 / S9 ----------------------------------------------------------------
DAILY = "day string, good bigint, defect1 bigint, defect2 bigint, year string"


DAY_PARTITIONS = 32  # most state partitions of the daily counts, which hold a few numbers a day
YEAR_TASKS = 16  # tasks that merge and write days, a year in one of them


def daily_quality_live(records: DataFrame, out: str, checkpoint: str, day: str = "day", available_now: bool = True):
    """Daily counts (``DAILY``) that follow arriving files.

    The counts are the stream's state, and a micro-batch replaces the days that it has touched: files of other years are
    not written, and old input is never read again. A repeated micro-batch writes the same totals. A null day
    is a day, in the year ``none``.

    Every task of a stage with state sends the driver a metric for every state partition, so what a micro-batch sends grows
    with their square. Input tasks add up their rows by day before the state gets them, so the state has no more than
    ``DAY_PARTITIONS``, fewer if the session has fewer shuffle partitions; a checkpoint goes on with the number it was begun
    with. New and stored days meet in one shuffle by year. The stored files are replaced when all tasks that read them are done.
    """
    def replace(batch: DataFrame, number: int) -> None:
        columns = ["day", C.GOOD, C.DEFECT1, C.DEFECT2]
        days = batch.withColumnRenamed(day, "day").select(*columns, F.lit(True).alias("__new"))
        if number:
            old = batch.sparkSession.read.schema(DAILY).parquet(out)
            days = days.unionByName(old.select(*columns, F.lit(False).alias("__new")))
        year = F.coalesce(F.substring("day", 1, 4), F.lit("none"))
        seen = [F.max("__new").over(Window.partitionBy(*by)) for by in (["year"], ["year", "day"])]
        merged = (days.withColumn("year", year).repartition(YEAR_TASKS, "year").select("*", seen[0].alias("__touched"), seen[1].alias("__newest"))
                  .where(F.col("__touched") & (F.col("__new") == F.col("__newest"))).select(*columns, "year"))
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year").parquet(out))

    spark = records.sparkSession
    use_rocksdb(spark)
    w = daily_counts(records, day).writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint).outputMode("update")
    w = w.trigger(availableNow=True) if available_now else w
    with state_partitions(spark, DAY_PARTITIONS):
        return w.start()


# --- W3 ---------------------------------------------------------------------
def split_late(stream: DataFrame, out: str, checkpoint: str, ts: str = "ts", arrival: str = "seq", delay_ms: int = 0,
               available_now: bool = True):
    """On-time and late rows of a running stream as two tables, ``<out>/on_time`` and ``<out>/late``; every row is in one.

    Rows arrive micro-batch by micro-batch and in ``arrival`` order inside one. A row is late if its time lies more than
    ``delay_ms`` before the newest one that arrived before it. The newest time so far is a table of one row a micro-batch;
    a micro-batch reads the one before and writes its own folders over, so a repeated one changes nothing.
    """
    def split(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        before = None
        if number:
            before = session.read.schema("newest timestamp").parquet(f"{out}/newest/micro={number - 1}").first()["newest"]
        flagged = watermark_late(batch, ts, arrival, delay_ms, newest=before).persist()
        try:
            for name, keep in (("on_time", ~F.col("is_late")), ("late", F.col("is_late"))):
                flagged.where(keep).drop("is_late").write.mode("overwrite").parquet(f"{out}/{name}/micro={number}")
            (flagged.agg(F.greatest(F.max(ts).cast("timestamp"), F.lit(before).cast("timestamp")).alias("newest")).coalesce(1)
             .write.mode("overwrite").parquet(f"{out}/newest/micro={number}"))
        finally:
            flagged.unpersist()

    w = stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
