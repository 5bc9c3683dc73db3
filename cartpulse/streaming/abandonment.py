"""Carts left behind, told once it is certain whether their owner came back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartpulse.functions import kpis
from cartpulse.sources.serving import append_changelog
from cartpulse.streaming.rollups import each_batch

_OPEN = """user_id string, session_id string, hour timestamp_ntz, told boolean,
first_at timestamp_ntz, last_at timestamp_ntz, carted int, bought int"""
_KEYS = ["user_id", "session_id", "hour", "told"]


def _arrived(batch: DataFrame) -> DataFrame:
    """One row per event of a known user, like those of a session and hour."""
    kind = F.col("event_type")
    return batch.where("user_id is not null and event_time is not null").select(
        "user_id", "session_id", kpis.hour_of(F.col("event_time")).alias("hour"),
        F.lit(False).alias("told"), F.col("event_time").alias("first_at"),
        F.col("event_time").alias("last_at"),
        F.coalesce((kind == "add_to_cart").cast("int"), F.lit(0)).alias("carted"),
        F.coalesce((kind == "purchase").cast("int"), F.lit(0)).alias("bought"))


def _told(held: DataFrame, over: DataFrame, hours: int) -> DataFrame:
    """The abandoned carts among the sessions that are ``over``, and whether their users
    came back: the first and last event of a session's hour tell that an event lies within
    ``hours`` of another session's end."""
    events = held.where("user_id is not null").select(
        "user_id", F.explode(F.array("first_at", "last_at")).alias("at"),
        F.lit(1).alias("event"), F.lit(None).cast("string").alias("session_id"))
    ends = over.where("carted = 1 and bought = 0").select(
        "user_id", F.col("last_at").alias("at"), F.lit(0).alias("event"), "session_id")
    micros = F.unix_micros(kpis.utc_instant(F.col("at")))
    after = Window.partitionBy("user_id").orderBy("micros").rangeBetween(
        1, hours * 3600 * 1_000_000)
    return events.unionByName(ends).withColumn("micros", micros).withColumn(
        "returned", F.coalesce(F.sum("event").over(after) > 0, F.lit(False))).where(
        "event = 0").select("user_id", "session_id", F.col("at").alias("left_at"), "returned")


def start_abandoned_carts(events: DataFrame, out: str, checkpoint: str,
                          watermark: str = "30 minutes", hours: int = 48,
                          every: str | None = None) -> StreamingQuery:
    """One row per abandoned cart of a known user: when it was left, and whether the user
    came back within ``hours`` (>= 1), once the watermark has passed that time.

    The definitions are those of `cartpulse.operators.decisions.return_rate`. Events are
    reduced to one row per session and hour, which lie as a plain table in the checkpoint
    until no session of their user can be answered by them; a batch is put together with
    it as a table. A batch reads what the one before left and writes its own, so a replay
    changes nothing. A session that goes on after it was given out counts as a new one;
    events later than the watermark, and events without a time, are not seen.
    """
    delay, within = F.expr(f"INTERVAL {watermark}"), F.make_dt_interval(F.lit(0), F.lit(hours))

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def kept(rows: DataFrame, name: str) -> DataFrame:
            # two places in turn: a replay finds what the batch before left
            path = f"{checkpoint}/carts/{name}-{batch_id % 2}"
            rows.write.mode("overwrite").parquet(path)
            return spark.read.schema(rows.schema).parquet(path)

        rows = _arrived(batch)
        if batch_id:
            before = spark.read.schema(_OPEN).parquet(
                f"{checkpoint}/carts/open-{(batch_id - 1) % 2}")
            mark = before.agg(F.max("last_at") - delay).scalar()
            rows = rows.where(F.coalesce(F.col("last_at") > mark, F.lit(True))).unionByName(before)
        held = kept(rows.groupBy(*_KEYS).agg(
            F.min("first_at").alias("first_at"), *[F.max(c).alias(c) for c in (
                "last_at", "carted", "bought")]), "held")
        newest = held.agg(F.max("last_at")).scalar()
        sessions = kept(held.where("not told").groupBy("user_id", "session_id").agg(
            *[F.max(c).alias(c) for c in ("last_at", "carted", "bought")]).withColumn(
            "over", F.col("last_at") + within < newest - delay), "sessions")
        append_changelog(_told(held, sessions.where("over"), hours).hint("rebalance"),
                         out, batch_id)

        awaited = sessions.where("not over").groupBy("user_id").agg(
            F.min("last_at").alias("oldest"))
        over = sessions.where("over").select(
            F.col("user_id").alias("user"), F.col("session_id").alias("session"),
            F.lit(True).alias("now"))
        is_over = (F.col("user_id") == F.col("user")) & F.col("session_id").eqNullSafe(
            F.col("session"))
        needed = held.join(awaited, "user_id").join(over, is_over, "left").withColumn(
            "told", F.col("told") | F.coalesce("now", F.lit(False))).where(
            "not told or last_at >= oldest").select(*held.columns)
        # a row of nobody remembers the time
        clock = held.agg(F.max("last_at").alias("last_at")).select(*[
            {"told": F.lit(True), "last_at": F.col("last_at")}.get(
                f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in held.schema])
        kept(needed.unionByName(clock), "open")

    return each_batch(events.writeStream, process, checkpoint, every)


def return_rate(carts: DataFrame) -> DataFrame:
    """Share of users with an abandoned cart who came back, from the stream's rows."""
    users = carts.groupBy("user_id").agg(F.max("returned").alias("returned"))
    return users.agg(
        F.count("*").alias("users_with_abandoned_cart"),
        F.count_if("returned").alias("returning_users"),
    ).withColumn("return_rate", kpis.percent(
        F.col("returning_users"), F.col("users_with_abandoned_cart")))
