"""What a stream's checkpoint remembers beside what the stream has published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.sources.serving import latest_version, read_changelog


def aggregation_state(spark: SparkSession, checkpoint: str, keys: list[str],
                      names: dict[int, str], operator: int = 0) -> DataFrame:
    """Keys and buffers of a streaming aggregation as its checkpoint holds them.

    ``names`` gives the buffers to return, by their position in the aggregation.
    """
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    size = len(state.schema["value"].dataType.fields)
    # buffers share names, so they are told by position
    flat = state.select("key.*", F.inline(F.array("value"))).toDF(
        *keys, *[f"buffer_{at}" for at in range(size)])
    return flat.select(*keys, *[F.col(f"buffer_{at}").alias(n) for at, n in names.items()])


def compared(spark: SparkSession, checkpoint: str, changelog: str, keys: list[str],
             names: dict[int, str], operator: int = 0) -> DataFrame:
    """Per key the remembered and the published values, and whether all agree.

    Keys only one side has appear with nulls on the other and do not agree, so state that
    was lost in a restart shows as well as rows that were not published.
    """
    state = aggregation_state(spark, checkpoint, keys, names, operator).alias("s")
    rows = latest_version(read_changelog(spark, changelog), keys).alias("p")
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
    agree = F.lit(True)
    for name in names.values():
        agree = agree & F.col(f"s.{name}").eqNullSafe(F.col(f"p.{name}"))
    return state.join(rows, same, "full").select(
        *[F.coalesce(f"s.{k}", f"p.{k}").alias(k) for k in keys],
        *[F.col(f"s.{n}").alias(f"state_{n}") for n in names.values()],
        *[F.col(f"p.{n}").alias(f"published_{n}") for n in names.values()],
        agree.alias("agree"))
