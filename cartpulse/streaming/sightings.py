"""Sums and exact distinct counts of a stream in one pass over its events.

A keyed processor remembers who was seen in an hour of a group and passes on what a
micro-batch adds: sums, and one for every visitor seen for the first time. A plain
aggregation behind it adds these up, so the source is read and decoded once.

Events are first combined per Arrow batch into one row per group, hour and visitor, which
is the map-side step that a keyed processor lacks: a visitor with a third of all events
reaches its state as one row per batch. The visitors of an hour are spread over parts,
so a group with a third of all visitors is worked on by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Parts over which the visitors of one group and hour are spread.
PARTS = 8


def combined(shares: DataFrame, by: list[str], sums: list[str], newest: list[str]) -> DataFrame:
    """``shares`` with the ``sums`` of equal ``by`` added up and the greatest of each of
    ``newest``, within each Arrow batch."""
    columns = [*by, *sums, *newest]
    schema = shares.select(*columns).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = pa.Table.from_batches([batch]).group_by(by, use_threads=False).aggregate(
                [*((c, "sum") for c in sums), *((c, "max") for c in newest)])
            names = {f"{c}_sum": c for c in sums} | {f"{c}_max": c for c in newest}
            held = held.rename_columns([names.get(c, c) for c in held.column_names])
            yield from held.select(columns).cast(batch.schema).to_batches()

    return shares.select(*columns).mapInArrow(run, schema)


class _FirstSightings(StatefulProcessor):
    """Adds up the rows of one group, hour and part, and counts its new visitors.

    With an event time, the visitors of an hour are forgotten once the watermark has
    passed the hour's end.
    """

    def __init__(self, visitors: str, measures: list[str], by: list[str], forget: bool):
        self.visitors, self.measures, self.by, self.forget = visitors, measures, by, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "visitor string", "times int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        sums: list = [None] * len(self.measures)
        met: set[str] = set()
        for row in rows:
            if row["_visitor"] is not None:
                met.add(row["_visitor"])
            for at, name in enumerate(self.measures):
                value = row[name]
                if value is not None:
                    sums[at] = value if sums[at] is None else sums[at] + value
        fresh = [v for v in met if not self.seen.containsKey((v,))]
        for visitor in fresh:
            self.seen.updateValue((visitor,), (1,))
        hour = key[len(self.by)]
        if self.forget and fresh and hour is not None:
            closed = hour + timedelta(hours=1) - datetime(1970, 1, 1)
            self.handle.registerTimer(closed // timedelta(milliseconds=1))
        yield Row(**dict(zip([*self.by, "hour"], key)), **dict(zip(self.measures, sums)),
                  **{self.visitors: len(fresh)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        yield from ()

    def close(self) -> None:
        pass


def with_first_sightings(shares: DataFrame, by: list[str], sums: list[str], visitors: str,
                         visitor: str, parts: int = PARTS,
                         watermark: str | None = None) -> DataFrame:
    """Per micro-batch what events add to the ``sums`` of each group ``by`` and ``hour``,
    with the first sightings of each ``visitor`` counted as ``visitors``.

    ``shares`` has one row per event, with its ``event_time``, an instant. A row whose
    visitor is null counts no one. With a ``watermark``, the visitors of an hour are
    forgotten when it has passed the hour, and later events, or events without a time, are
    not counted at all.
    """
    renamed = shares.withColumn("_visitor", F.col(visitor))
    if watermark is None:
        held = combined(renamed, [*by, "hour", "_visitor"], sums, [])
    else:
        held = combined(renamed.where("event_time is not null"),
                        [*by, "hour", "_visitor"], sums, ["event_time"])
        held = held.withWatermark("event_time", watermark)
    # rows without a visitor are dealt by their sums, which is as good as any
    part = F.pmod(F.xxhash64(F.coalesce("_visitor", F.to_json(F.struct(*sums)))), F.lit(parts))
    schema = T.StructType([
        *(held.schema[c] for c in [*by, "hour", *sums]), T.StructField(visitors, T.LongType())])
    return held.withColumn("_part", part).groupBy(*by, "hour", "_part").transformWithState(
        _FirstSightings(visitors, sums, [*by], watermark is not None), schema, "Update",
        "None" if watermark is None else "EventTime")
