"""Rollups that stay current while events arrive.

Every query writes its changed rows per micro-batch to a changelog folder
(`cartpulse.sources.serving`); `latest_version` of it is the current table.

Exact distinct counts do not collect users in a state row: a first sighting of
(group, hour, user) is found in state of its own, spread over all partitions, and adds
1 to the same plain sum as every other measure (`cartpulse.streaming.sightings`), in
one pass over the events. Only hours that a watermark closes take two passes: there
sightings are found by deduplication, first within a salt, which spreads one user's
many events over many tasks, and then on what is left.

Start the streams from a `cartpulse.session.streaming_session`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from cartpulse.functions import kpis
from cartpulse.operators import rollups, visitors
from cartpulse.schemas import (
    CAMPAIGN_KEYS, CART_STAGES, DEVICE_SOURCE_KEYS, FUNNEL_KEYS, MARKETING_STAGES,
)
from cartpulse.sources.serving import BATCH_ID, append_changelog
from cartpulse.streaming.sightings import with_first_sightings

SALTS = 256


@dataclass(frozen=True)
class Kind:
    """What is counted for one kind of events."""

    keys: list[str]
    counters: dict[str, str]             # counter -> stage
    amounts: dict[str, tuple[str, str]]  # sum -> (stage, column)
    visitors: tuple[str, str, str]       # distinct count, stage, column


KINDS = {
    "marketing": Kind(
        CAMPAIGN_KEYS, dict(zip(rollups.MARKETING_COUNTERS, MARKETING_STAGES)),
        {"impression_cost": ("impression", "cost"), "click_cost": ("click", "cost"),
         "revenue": ("purchase", "revenue")},
        ("unique_visitors", "impression", "user_id")),
    "cart": Kind(
        FUNNEL_KEYS, dict(zip(rollups.CART_COUNTERS, CART_STAGES)),
        {"revenue": ("purchase", "revenue")},
        ("unique_sessions", "page_view", "session_id")),
}


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def counted(events: DataFrame, kind: Kind, time: str, who: Column,
             *more: Column) -> DataFrame:
    """One row per event with its share of every measure."""
    stage = F.col("event_type")
    return events.select(
        *kind.keys, time,
        *[F.coalesce((stage == s).cast("long"), _long(0)).alias(name)
          for name, s in kind.counters.items()],
        *[kpis.value_when(stage == s, F.col(column)).alias(name)
          for name, (s, column) in kind.amounts.items()],
        who.alias(kind.visitors[0]), *more,
    )


def _rollup(events: DataFrame, kind: Kind, time: str, by: list[str], exact: bool,
            *more: Column, forget: str | None = None) -> DataFrame:
    """All measures of ``events`` grouped by ``by``; ``time`` is the hour's column.

    ``forget`` is the watermark after which exact visitors are forgotten.
    """
    name, stage, visitor = kind.visitors
    visit = (F.col("event_type") == stage) & F.col(visitor).isNotNull()
    if exact:
        at = kpis.utc_instant(F.col("event_time")).alias("event_time")
        shares = counted(events, kind, time, F.when(visit, F.col(visitor)), at)
        rows = with_first_sightings(shares, kind.keys, [*kind.counters, *kind.amounts], name,
                                    visitor=name, watermark=forget)
        distinct = F.sum(name)
    else:
        rows = counted(events, kind, time, F.when(visit, F.struct(time, visitor)))
        distinct = F.approx_count_distinct(name)
    return rows.groupBy(*by).agg(
        *more, *[F.sum(c).alias(c) for c in kind.counters], distinct.alias(name),
        *[F.sum(c).alias(c) for c in kind.amounts])


def _first_sightings(events: DataFrame, kind: Kind, time: str) -> DataFrame:
    """One row per visitor of a group and hour that counts the visitor and nothing else."""
    name, stage, visitor = kind.visitors
    salt = F.pmod(F.xxhash64("event_id", "event_time"), F.lit(SALTS)).alias("salt")
    seen = events.where((F.col("event_type") == stage) & F.col(visitor).isNotNull()).select(
        *kind.keys, time, visitor, salt)
    return seen.dropDuplicates().drop("salt").dropDuplicates().select(
        *kind.keys, time,
        *[_long(0).alias(c) for c in kind.counters],
        *[F.lit(None).cast("double").alias(c) for c in kind.amounts],
        _long(1).alias(name),
    )


def _closed_windows(events: DataFrame, kind: Kind) -> DataFrame:
    """All measures by key and ``window``, with exact visitors. Deduplication and windows
    share the watermark here, which costs a second pass over the events."""
    name = kind.visitors[0]
    rows = counted(events, kind, "window", _long(0)).unionByName(
        _first_sightings(events, kind, "window"))
    return rows.groupBy(*kind.keys, "window").agg(
        *[F.sum(c).alias(c) for c in [*kind.counters, name, *kind.amounts]])


def _deduplicated(events: DataFrame, dedup: str | None, watermarked: bool = False) -> DataFrame:
    """Drops events whose ``dedup`` id was seen before. Events without an id are all
    kept. Copies have nothing to salt by but the input partition they arrive in."""
    if dedup is None:
        return events
    marked = events.withColumns({
        "_id": F.coalesce(F.col(dedup), F.expr("uuid()")),
        "_salt": F.spark_partition_id() % SALTS,
    })
    if watermarked:
        once = marked.dropDuplicatesWithinWatermark(["_id", "_salt"])
        return once.dropDuplicatesWithinWatermark(["_id"]).drop("_id", "_salt")
    return marked.dropDuplicates(["_id", "_salt"]).dropDuplicates(["_id"]).drop("_id", "_salt")


def _start(rows: DataFrame, keys: list[str], out: str, checkpoint: str, mode: str,
           every: str | None) -> StreamingQuery:
    """``every`` is the live trigger interval; without it all available input is
    processed and the query ends. The checkpoint resumes where it left off."""

    def append(batch: DataFrame, batch_id: int) -> None:
        # Without merging there would be one small file per state partition.
        append_changelog(batch.hint("rebalance", *[F.col(k) for k in keys]), out, batch_id)

    return each_batch(rows.writeStream.outputMode(mode), append, checkpoint, every)


def each_batch(writer: DataStreamWriter, process: Callable[[DataFrame, int], None],
               checkpoint: str, every: str | None) -> StreamingQuery:
    """Starts a query that hands every micro-batch to ``process`` with adaptive
    execution on, which Spark switches off for the stateful part of the plan."""

    def adaptive(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        planned = conf.get("spark.sql.adaptive.enabled")
        conf.set("spark.sql.adaptive.enabled", "true")
        try:
            process(batch, batch_id)
        finally:
            conf.set("spark.sql.adaptive.enabled", planned)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (writer.foreachBatch(adaptive).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


def start_campaign_performance(events: DataFrame, out: str, checkpoint: str,
                               dedup: str | None = None, exact_visitors: bool = True,
                               every: str | None = None, forget: str | None = None,
                               in_tables: bool = False) -> StreamingQuery:
    """Campaign rollup with all KPIs, updated by every event however late it is.

    ``exact_visitors=False`` estimates ``unique_visitors`` (5% standard deviation)
    with a small sketch per campaign instead of the state of first sightings. With
    ``forget``, a watermark, that state is bounded: the visitors of an hour go once the
    watermark has passed it, and later events are not counted. ``in_tables`` keeps the exact
    sightings as `each_campaign_change` does, without a call per visitor.
    """
    if in_tables:
        if forget is not None or not exact_visitors:
            raise ValueError("tables hold the exact visitors of all hours")

        def append(batch: DataFrame, batch_id: int) -> None:
            append_changelog(batch.hint("rebalance", *CAMPAIGN_KEYS), out, batch_id)

        return each_campaign_change(events, append, checkpoint, dedup, every)
    rows = campaign_totals(events, dedup, exact_visitors, forget)
    return _start(rows, CAMPAIGN_KEYS, out, checkpoint, "update", every)


def campaign_totals(events: DataFrame, dedup: str | None = None, exact_visitors: bool = True,
                    forget: str | None = None) -> DataFrame:
    """The rows of `start_campaign_performance` as a stream."""
    timed = _deduplicated(events, dedup).withColumn("hour", rollups.hour())
    totals = _rollup(timed, KINDS["marketing"], "hour", CAMPAIGN_KEYS, exact_visitors,
                     F.min("hour").alias("start_date"), F.max("hour").alias("last_updated"),
                     forget=forget)
    return rollups.with_campaign_kpis(totals)


def each_campaign_change(events: DataFrame, process: Callable[[DataFrame, int], None],
                         checkpoint: str, dedup: str | None = None,
                         every: str | None = None) -> StreamingQuery:
    """Hands the campaigns that a micro-batch changed to ``process``, with all KPIs.

    A batch adds what its hours add to the totals that the batch before left in the
    checkpoint, one row per campaign, and leaves its own. A replay replaces them.
    """
    timed = _deduplicated(events, dedup).withColumn("hour", rollups.hour())
    kind, path = KINDS["marketing"], f"{checkpoint}/hours/totals"
    sums = [*kind.counters, kind.visitors[0], *kind.amounts]

    def write(added: DataFrame, stored: Stored, batch_id: int) -> None:
        spark = added.sparkSession
        rows = added.select(
            *CAMPAIGN_KEYS, F.col("hour").alias("start_date"), F.col("hour").alias("last_updated"),
            *sums, _long(batch_id).alias("newest"))
        if batch_id > 0:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(
                f"{path}/{BATCH_ID}={batch_id - 1}"))
        totals = rows.groupBy(*CAMPAIGN_KEYS).agg(
            F.min("start_date").alias("start_date"),
            *[F.max(c).alias(c) for c in ("last_updated", "newest")],
            *[F.sum(c).alias(c) for c in sums])
        append_changelog(totals, path, batch_id)
        current = spark.read.schema(totals.schema).parquet(f"{path}/{BATCH_ID}={batch_id}")
        process(rollups.with_campaign_kpis(current.where(F.col("newest") == batch_id)), batch_id)

    return _start_hour_tables(timed, kind, write, checkpoint, every)


def start_visitor_sketches(events: DataFrame, out: str, checkpoint: str,
                           every: str | None = None) -> StreamingQuery:
    """One sketch of users per campaign and hour, updated by every event however late;
    `cartpulse.operators.visitors` merges the newest ones to any time and campaigns."""
    return _start(visitors.hourly_sketches(events), [*CAMPAIGN_KEYS, "hour"], out, checkpoint,
                  "update", every)


def start_cart_funnel(events: DataFrame, out: str, checkpoint: str, dedup: str | None = None,
                      every: str | None = None) -> StreamingQuery:
    """Funnel rollup with all stage rates."""
    rows = rollups.cart_funnel_from_events(_deduplicated(events, dedup))
    return _start(rows, FUNNEL_KEYS, out, checkpoint, "update", every)


def start_hourly(events: DataFrame, kind: str, out: str, checkpoint: str,
                 watermark: str | None = None, dedup: str | None = None,
                 exact_visitors: bool = True, every: str | None = None) -> StreamingQuery:
    """Hourly metrics of ``marketing`` or ``cart`` events.

    Without a watermark every hour stays open for late events. With one, an hour
    is written once, when the watermark has passed its end, and its state is
    dropped; events later than that are not counted.
    """
    counted = KINDS[kind]
    if watermark is None:
        timed = _deduplicated(events, dedup).withColumn("hour", rollups.hour())
        if exact_visitors:
            return _start_open_hours(timed, counted, out, checkpoint, every)
        rows = _rollup(timed, counted, "hour", [*counted.keys, "hour"], exact_visitors)
        return _start(rows, counted.keys, out, checkpoint, "update", every)
    timed = events.withColumn("event_time", kpis.utc_instant(F.col("event_time")))
    timed = _deduplicated(timed.withWatermark("event_time", watermark), dedup, watermarked=True)
    windowed = timed.withColumn("window", F.window("event_time", "1 hour"))
    closed = _closed_windows(windowed, counted) if exact_visitors else _rollup(
        windowed, counted, "window", [*counted.keys, "window"], False)
    rows = closed.withColumn("hour", kpis.utc_wall_clock(F.col("window.start"))).drop("window")
    return _start(rows, counted.keys, out, checkpoint, "append", every)


#: Writes rows as a table by day and batch, and reads those of the batch's days.
Stored = Callable[[DataFrame, str], DataFrame]


def _start_hour_tables(timed: DataFrame, kind: Kind,
                       write: Callable[[DataFrame, Stored, int], None], checkpoint: str,
                       every: str | None) -> StreamingQuery:
    """Hours with exact visitors, without a call per visitor: whom a batch saw in an hour lies
    as a plain table by day and batch in the checkpoint.

    Visitors that no earlier batch saw are the difference of two tables. ``write`` gets what
    the batch adds to each hour. Only the days of a batch are read. A replay replaces what
    the batch had written, so it changes nothing.
    """
    from cartpulse.streaming.days import _by_day    # which itself builds on this module

    name, stage, visitor = kind.visitors
    keys, sums = [*kind.keys, "hour"], [*kind.counters, *kind.amounts]
    visit = (F.col("event_type") == stage) & F.col(visitor).isNotNull()
    shares = counted(timed, kind, "hour", F.when(visit, F.col(visitor)))

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def stored(rows: DataFrame, table: str) -> DataFrame:
            """The rows of the batch's days, of this and earlier batches."""
            path = f"{checkpoint}/hours/{table}"
            dated = _by_day(rows, "hour").withColumn(BATCH_ID, F.lit(batch_id).cast("long"))
            dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "day", BATCH_ID).parquet(path)
            full = T.StructType([*rows.schema, T.StructField("day", T.DateType()),
                                 T.StructField(BATCH_ID, T.LongType())])
            written = spark.read.schema(full).parquet(path).where(F.col(BATCH_ID) <= batch_id)
            days = written.where(F.col(BATCH_ID) == batch_id).agg(F.collect_set("day")).scalar()
            return written.where(F.array_contains(days, F.col("day")))

        now, earlier = F.col(BATCH_ID) == batch_id, F.col(BATCH_ID) < batch_id
        seen = stored(batch.groupBy(*keys, name).agg(*[F.sum(c).alias(c) for c in sums]), "seen")
        met = seen.where(F.col(name).isNotNull())
        fresh = met.where(now).select(*keys, name).subtract(met.where(earlier).select(*keys, name))
        shares_of_batch = seen.where(now).select(*keys, *sums, _long(0).alias(name)).unionByName(
            fresh.select(*keys, *[F.lit(None).cast(seen.schema[c].dataType).alias(c)
                                  for c in sums], _long(1).alias(name)))
        write(shares_of_batch.groupBy(*keys).agg(
            *[F.sum(c).alias(c) for c in [*sums, name]]), stored, batch_id)

    return each_batch(shares.writeStream, process, checkpoint, every)


def _start_open_hours(timed: DataFrame, kind: Kind, out: str, checkpoint: str,
                      every: str | None) -> StreamingQuery:
    """Hours with exact visitors; the rows of an hour are the sum of what all batches added
    to it, which lies by day and batch as well."""
    keys = [*kind.keys, "hour"]

    def write(rows: DataFrame, stored: Stored, batch_id: int) -> None:
        added = stored(rows, "added")
        totals = added.groupBy(*keys).agg(
            *[F.sum(c).alias(c) for c in [*kind.counters, kind.visitors[0], *kind.amounts]],
            F.max(BATCH_ID).alias("newest")).where(F.col("newest") == batch_id).drop("newest")
        append_changelog(totals.hint("rebalance", *[F.col(k) for k in kind.keys]), out, batch_id)

    return _start_hour_tables(timed, kind, write, checkpoint, every)


def start_snapshot_latest(snapshots: DataFrame, kind: str, out: str, checkpoint: str,
                          every: str | None = None) -> StreamingQuery:
    """Highest counters per key of ``campaign`` or ``cart`` snapshots."""
    latest, keys = {"campaign": (rollups.campaign_snapshot_latest, CAMPAIGN_KEYS),
                    "cart": (rollups.cart_snapshot_latest, DEVICE_SOURCE_KEYS)}[kind]
    return _start(latest(snapshots), keys, out, checkpoint, "update", every)


def run_available(query: StreamingQuery) -> None:
    """Wait until a query started without ``every`` has processed what is there."""
    query.awaitTermination()
