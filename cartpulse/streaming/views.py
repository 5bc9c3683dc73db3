"""Insight views that follow the stream and a budget table that may change under it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cartpulse.operators import insights
from cartpulse.schemas import CAMPAIGN_KEYS
from cartpulse.sources.serving import BATCH_ID, append_changelog, latest_version, read_changelog
from cartpulse.streaming.rollups import each_campaign_change

Budgets = Callable[[SparkSession], DataFrame]


def start_campaign_insights(events: DataFrame, budgets: Budgets, base: str, checkpoint: str,
                            every: str | None = None) -> StreamingQuery:
    """Keeps ``base``/changelog and ``base``/view current.

    Every micro-batch adds the campaigns it changed to the changelog, and joins the current
    campaigns with the budgets as they are then: ``budgets`` reads them anew, so a change
    of the table shows with the next batch. The view holds campaigns, not events; each batch
    replaces its own version of it, so a replay changes nothing.
    """
    changelog, view = f"{base}/changelog", f"{base}/view"

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        append_changelog(batch, changelog, batch_id)
        versions = read_changelog(spark, changelog, batch.schema).where(f"{BATCH_ID} <= {batch_id}")
        current = latest_version(versions, CAMPAIGN_KEYS)
        append_changelog(insights.campaign_insights(current, budgets(spark)), view, batch_id)

    return each_campaign_change(events, process, checkpoint, every=every)


def read_view(spark: SparkSession, base: str) -> DataFrame:
    """The view as the newest batch wrote it."""
    versions = read_changelog(spark, f"{base}/view")
    newest = versions.agg({BATCH_ID: "max"}).scalar()
    return versions.where(versions[BATCH_ID] == newest).drop(BATCH_ID)
