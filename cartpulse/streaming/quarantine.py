"""Lines that do not decode, kept for inspection beside the stream that skips them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartpulse.sources.events import CORRUPT, corrupt_rows, parse_json
from cartpulse.sources.serving import BATCH_ID
from cartpulse.streaming.rollups import each_batch


def start_quarantine(lines: DataFrame, schema: T.StructType, out: str, checkpoint: str,
                     every: str | None = None) -> StreamingQuery:
    """Writes the lines of a raw stream (`read_lines`) that `read_events` leaves out,
    unchanged, as text below ``out``. A replayed batch replaces itself."""
    corrupt = corrupt_rows(parse_json(lines, schema)).withColumnRenamed(CORRUPT, "value")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").text(f"{out}/{BATCH_ID}={batch_id}")

    return each_batch(corrupt.writeStream, keep, checkpoint, every)
