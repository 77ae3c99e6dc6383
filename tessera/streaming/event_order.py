"""K3/K5 in event time: keyed operators that see each key's rows in order.

A row waits in its key's list state until the watermark passes its time; then
an event-time timer lets all rows of the key that are due leave in the order of
(time, id). So neither the split into micro-batches nor the order of arrival
inside the watermark's delay changes a result, and it equals the batch
operator's. A row that comes after the watermark has passed its time is late:
it is dropped, as if it had never come. Rows within the delay before the
stream's last time leave when later rows (of any key) move the watermark on.

State for each key: the rows of one delay, and one number (the last accepted
time, or rows seen). A micro-batch's rows of a key are appended one Arrow batch
at a time; what is due is held while it is put in order, so that
``maxFilesPerTrigger`` bounds it. State lives in RocksDB, which the operator
sets in the session: Spark's timers and list states need it.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_MICROS = "event_micros"  # (names with a leading underscore do not reach the processor)
#: rows of one value of the list state
STATE_ROWS = 10_000
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _InOrder(StatefulProcessor):
    """``step(seen, micros) -> (seen, value or None)`` decides on each row in
    order; a value that isn't None sends the row (and the value, if ``extra``)."""

    def __init__(self, schema: T.StructType, id_col: str, step: Callable, extra: str | None):
        self.step, self.extra = step, extra
        self.names = schema.fieldNames()  # without the time, with its microseconds
        self.at, self.by = self.names.index(_MICROS), self.names.index(id_col)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "rows binary")  # a value for each Arrow batch
        self.seen = handle.getValueState("seen", "seen long")

    def _wake(self, micros: int) -> None:
        self.handle.registerTimer(-(-micros // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        first = None
        for pdf in rows:
            pdf = pdf[self.names][pdf[_MICROS] > passed]
            if len(pdf):
                columns = [[None if v is None or v != v else v for v in pdf[c].tolist()] for c in self.names]
                self.pending.appendValue((pickle.dumps([*zip(*columns)]),))
                least = int(pdf[_MICROS].min())
                first = least if first is None else min(first, least)
        if first is not None:
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        due, rest = [], []
        for value in self.pending.get():
            for row in pickle.loads(value[0]):
                (due if row[self.at] <= passed else rest).append(row)
        if not due:  # another timer of the same rows came first
            return
        if rest:
            self.pending.put([(pickle.dumps(rest[a : a + STATE_ROWS]),) for a in range(0, len(rest), STATE_ROWS)])
            self._wake(min(r[self.at] for r in rest))
        else:
            self.pending.clear()
        due.sort(key=lambda r: (r[self.at], r[self.by]))
        seen = self.seen.get()[0] if self.seen.exists() else None
        out = []
        for row in due:
            seen, value = self.step(seen, row[self.at])
            if value is not None:
                out.append((*row, value) if self.extra else row)
        self.seen.update((int(seen),))
        if out:
            yield pd.DataFrame(out, columns=[*self.names, *([self.extra] if self.extra else [])])

    def close(self) -> None:
        pass


def in_event_order(stream: DataFrame, key: str, ts: str, id_col: str, delay: str, step: Callable, extra: str | None = None) -> DataFrame:
    """Rows of ``stream`` that ``step`` sends, each key's in event order. ``step``
    gets what it returned last (None at first) and a row's time in microseconds.
    Rows without a key or a time take no part."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    kind = stream.schema[ts].dataType.simpleString()
    # times go as microseconds, whatever the session's time zone
    rows = stream.where(f"`{key}` is not null and `{ts}` is not null").withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    rows = rows.withColumn(_MICROS, F.unix_micros(ts))
    own = T.StructType([f for f in rows.schema.fields if f.name != ts])
    sent = T.StructType([*own.fields, *([T.StructField(extra, T.LongType())] if extra else [])])
    out = rows.groupBy(key).transformWithStateInPandas(_InOrder(own, id_col, step, extra), sent, "append", "EventTime")
    out = out.withColumn(ts, F.timestamp_micros(_MICROS).cast(kind))
    return out.select(*stream.columns, *([extra] if extra else []))


def throttle_in_order(stream: DataFrame, key: str, ts: str, id_col: str, gap_seconds: int, delay: str) -> DataFrame:
    """K3: per key, accept a row only when at least the gap has passed since the
    last accepted one, in event time."""
    gap = int(gap_seconds) * 1_000_000

    def step(last, micros):
        ok = last is None or micros - last >= gap
        return (micros, True) if ok else (last, None)

    return in_event_order(stream, key, ts, id_col, delay, step)


def every_nth_in_order(stream: DataFrame, key: str, ts: str, id_col: str, n: int, delay: str) -> DataFrame:
    """K5: positions 0, n, 2n, ... of every key in event order, with ``rn`` (from 1)."""

    def step(seen, micros):
        seen = seen or 0
        return seen + 1, seen + 1 if seen % n == 0 else None

    return in_event_order(stream, key, ts, id_col, delay, step, extra="rn")
