"""Checkout-to-purchase rates that stand out, told as soon as their hour has closed."""

from __future__ import annotations

import statistics
from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from cartpulse.functions import kpis
from cartpulse.operators.decisions import scored_rates
from cartpulse.sources.serving import append_changelog
from cartpulse.streaming.rollups import each_batch


class _Trailing(StatefulProcessor):
    """Puts each closed hour of a segment beside those of the trailing hours, which it
    keeps as a ring of at most ``hours`` rates."""

    def __init__(self, by: list[str], hours: int):
        self.by, self.hours = by, hours

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getValueState(
            "ring", "held array<struct<hour:timestamp_ntz,rate:double>>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [(r["hour"], r["rate"]) for r in self.ring.get()[0]] if self.ring.exists() else []
        # a batch closes hours in any order; later batches close later ones
        for row in sorted(rows, key=lambda r: r["hour"]):
            hour, hours = row["hour"], timedelta(hours=self.hours)
            held = [(h, r) for h, r in held if h >= hour - hours]
            rates = [r for _, r in held if r is not None]
            yield Row(
                **dict(zip(self.by, key)), hour=hour, checkout_starts=row["checkout_starts"],
                purchases=row["purchases"], rate=row["rate"],
                previous_rate=next((r for h, r in held if h == hour - timedelta(hours=1)), None),
                trailing_mean=statistics.fmean(rates) if rates else None,
                trailing_stddev=statistics.stdev(rates) if len(rates) > 1 else None)
            held.append((hour, row["rate"]))
        self.ring.update((held,))

    def close(self) -> None:
        pass


def start_rate_anomalies(events: DataFrame, by: list[str], out: str, checkpoint: str,
                         watermark: str = "30 minutes", k: float = 2.0, trailing_hours: int = 24,
                         every: str | None = None) -> StreamingQuery:
    """The rows of `cartpulse.operators.decisions.rate_anomalies`, each written once, when
    the watermark has passed its hour. Later events, and events without a time, are not
    counted. State per segment: its open hours and the trailing closed ones."""
    timed = events.withColumn("event_time", kpis.utc_instant(F.col("event_time")))
    kind = F.col("event_type")
    closed = timed.withWatermark("event_time", watermark).groupBy(
        *by, F.window("event_time", "1 hour")).agg(
        F.count_if(kind == "checkout_start").alias("checkout_starts"),
        F.count_if(kind == "purchase").alias("purchases"))
    rates = closed.select(
        *by, kpis.utc_wall_clock(F.col("window.start")).alias("hour"), "checkout_starts",
        "purchases", kpis.checkout_to_purchase_rate(
            F.col("purchases"), F.col("checkout_starts")).alias("rate"))
    schema = T.StructType([*rates.schema, *(T.StructField(c, T.DoubleType()) for c in (
        "previous_rate", "trailing_mean", "trailing_stddev"))])
    beside = rates.groupBy(*by).transformWithState(
        _Trailing(by, trailing_hours), schema, "Append", "None")

    def append(batch: DataFrame, batch_id: int) -> None:
        append_changelog(scored_rates(batch, by, k).hint("rebalance"), out, batch_id)

    return each_batch(beside.writeStream.outputMode("append"), append, checkpoint, every)
