"""Keyed state on streams: the streaming forms of the per-key batch transforms.

The keys of a stream are dealt out over buckets, and a processor is called for a
bucket, not for each key: a call and a look at the state cost far more than a row.
Rows reach it as an iterator and are taken one by one. Versions and visits are ordered
within a micro-batch; across micro-batches the order is that of arrival. The repair of
visitor flags needs all rows of a device before the first goes out, so its streaming
form keeps its state in tables (``streaming/stored.py``).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.columns import flag
from millrace.operators.users import RETURN_DAYS

_DAY_MS = 86_400_000

#: Buckets of keys. A micro-batch reads all that is held for the buckets it touches.
#: The number is fixed at the first start of a stream, like that of its state partitions.
BUCKETS = 4096
#: Pieces of a bucket's state that are written before they are merged into one.
PIECES = 8


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("_bucket")


class _Held:
    """What is held for the keys of the bucket at hand.

    A micro-batch adds a piece with the keys it changed, so it writes no more than
    these; a later piece counts.
    """

    def __init__(self, handle: StatefulProcessorHandle):
        self.pieces, self.count = handle.getListState("held", "piece binary"), 0

    def load(self) -> dict:
        held: dict = {}
        self.count = 0
        for (piece,) in self.pieces.get():
            held.update(pickle.loads(piece))
            self.count += 1
        return held

    def add(self, changed: dict, held: dict) -> None:
        """Store what has changed since ``load``; ``held`` is all there is with it."""
        if self.count < PIECES:
            self.pieces.appendValue((pickle.dumps(changed),))
        else:
            self.replace(held)

    def replace(self, held: dict) -> None:
        if held:
            self.pieces.put([(pickle.dumps(held),)])
        else:
            self.pieces.clear()


class _DayVisits(StatefulProcessor):
    """Remembers the newest day of each key; emits the first row of a newer day."""

    def __init__(self, keys: Sequence[str], columns: Sequence[str], names: Sequence[str], forget: bool):
        self.keys, self.columns = [names.index(k) for k in keys], [names.index(c) for c in columns]
        self.out, self.ts, self.day, self.forget = [*columns, "_away"], names.index("ts"), names.index("_day"), forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, _Held(handle)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        firsts: dict = {}
        for row in rows:
            at = (tuple([row[i] for i in self.keys]), row[self.day])
            if at not in firsts or row[self.ts] < firsts[at][self.ts]:
                firsts[at] = tuple(row)
        visit, held, changed = Row(*self.out), self.held.load(), {}
        for (who, day), row in sorted(firsts.items(), key=lambda found: found[0][1]):
            last = held.get(who)
            if last is None or day > last:
                held[who] = changed[who] = day
                yield visit(*[row[i] for i in self.columns], None if last is None else day - last)
        if changed:
            self.held.add(changed, held)
            for day in set(changed.values()) if self.forget else ():
                self.handle.registerTimer((day + 1) * _DAY_MS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        past = expiredTimerInfo.getExpiryTimeInMs()
        self.held.replace({who: day for who, day in self.held.load().items() if (day + 1) * _DAY_MS > past})
        return iter([])

    def close(self) -> None:
        pass


def day_visits(
    df: DataFrame, keys: Sequence[str], width: str, order: Sequence[str] = ("ts",), carry: Sequence[str] = (),
    forget: bool = False,
) -> DataFrame:
    """First row of each key on each day, with ``first_ever`` and ``is_back``.

    Rows are first reduced to the earliest of each key and window, by an
    aggregate that starts before the shuffle; the keyed state sees one row per
    key and window however busy the key is, and sees windows in order. Times
    become the last instant of their window, which is as good for counts per
    window. ``forget`` lets a key go after its day; leave it off where
    first-ever or returning keys are asked for.
    """
    first = F.min(F.struct(*order, *carry)).alias("_first")
    reduced = df.groupBy(*keys, F.window(order[0], width).alias("_win")).agg(first)
    rows = reduced.select(*keys, F.window_time("_win").alias("ts"), *[F.col("_first")[c].alias(c) for c in carry])
    schema = T.StructType([*rows.schema.fields, T.StructField("_away", T.IntegerType())])
    dealt = rows.select("*", F.unix_date(F.to_date("ts")).alias("_day"), _bucket(keys))
    processor = _DayVisits(keys, rows.columns, dealt.columns, forget)
    visits = dealt.groupBy("_bucket").transformWithState(processor, schema, "Append", "EventTime", eventTimeColumnName="ts")
    back = F.coalesce(F.col("_away") > RETURN_DAYS, F.lit(False))
    return visits.select(
        *rows.columns, flag(F.col("_away").isNull()).alias("first_ever"), flag(back).alias("is_back")
    )


class _LastVersion(StatefulProcessor):
    """Remembers the newest version of each key; a new one cancels it.

    Every row goes out as it comes, and with it the negated copy of whichever
    of it and the newest so far is older. So each version but the newest is
    cancelled once, in any order of arrival within the micro-batch, and one row
    is held for a key however many there are.
    """

    def __init__(self, key: str, order: Sequence[str], amounts: Sequence[str], schema: T.StructType, windowed: bool):
        self.key, self.order, self.amounts, self.schema, self.windowed = key, list(order), list(amounts), schema, windowed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = _Held(handle)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        names = self.schema.names
        width, mine = len(names), names.index(self.key)
        places = [names.index(c) for c in self.order]
        amounts = {names.index(c) for c in self.amounts}
        signed = Row(*names, "sign")
        at = names.index("_ms") if self.windowed else None
        closed = timerValues.getCurrentWatermarkInMs() if self.windowed else None

        def place(row):
            return [(row[i] is not None, row[i]) for i in places]

        def cancel(row):
            if at is None or row[at] > closed:
                yield signed(*[-v if i in amounts and v is not None else v for i, v in enumerate(row)], -1)

        held, newest = self.held.load(), {}
        for row in rows:
            row = tuple(row)[:width]
            yield signed(*row, 1)
            last = newest.get(row[mine])
            if last is None:
                # What earlier micro-batches left is older than all of this one.
                if row[mine] in held:
                    yield from cancel(held[row[mine]])
                newest[row[mine]] = row
            elif place(row) >= place(last):
                yield from cancel(last)
                newest[row[mine]] = row
            else:
                yield from cancel(row)
        if newest:
            self.held.add(newest, {**held, **newest})

    def close(self) -> None:
        pass


def revision_changes(
    df: DataFrame, key: str, order: Sequence[str], amounts: Sequence[str], windowed: str | None = None
) -> DataFrame:
    """Every version, and the negated copy of the version it replaces.

    ``windowed`` names the event time for window sums to follow. A negated copy
    behind the watermark is then left out: its window has been reported.
    """
    rows = df.withColumn("_ms", F.unix_millis(windowed)) if windowed else df
    schema = T.StructType([*rows.schema.fields, T.StructField("sign", T.IntegerType(), False)])
    processor = _LastVersion(key, order, amounts, rows.schema, windowed is not None)
    grouped = rows.withColumn("_bucket", _bucket([key])).groupBy("_bucket")
    if windowed:
        signed = grouped.transformWithState(processor, schema, "Append", "EventTime", eventTimeColumnName=windowed)
        return signed.drop("_ms")
    return grouped.transformWithState(processor, schema, "Append", "None")
