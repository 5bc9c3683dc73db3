"""JSON event and snapshot streams from topics or files, batch or streaming."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartpulse import schemas

CORRUPT = "_corrupt_record"
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


@dataclass(frozen=True)
class Topic:
    """A Kafka topic, replayed from its earliest offset unless told otherwise."""

    servers: str
    name: str
    starting: str = "earliest"
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    options: dict[str, str] = field(default_factory=dict)  # e.g. security settings

    def read_options(self, streaming: bool) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.name,
            "startingOffsets": self.starting,
            **self.options,
        }
        if streaming and self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        return options

    def write_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, "topic": self.name, **self.options}


def parse_json(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Decode one JSON object per ``value`` into the declared columns.

    Missing keys become NULL and unknown keys are ignored. A line that is no
    JSON object, or has a field that does not convert, keeps its text in
    ``_corrupt_record``; `good_rows` and `corrupt_rows` tell the two apart. NULL and
    blank lines give no row; `blank_rows` has them, so that the three add up to the lines.
    """
    wire = T.StructType(
        [T.StructField(schemas.WIRE_NAMES.get(f.name, f.name), f.dataType) for f in schema]
        + [T.StructField(CORRUPT, T.StringType())]
    )
    value = F.col("value").cast("string")
    decoded = F.from_json(value, wire, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # Unnesting a one-element array keeps later filters above the decoder. A plain
    # projection would be repeated inside them and decode every line twice.
    once = F.inline(F.array(F.struct(decoded.alias("row"))))
    rows = lines.where(~_is_blank()).select(value.alias("value"), once)
    columns = [F.col("row")[schemas.WIRE_NAMES.get(f.name, f.name)].alias(f.name) for f in schema]
    corrupt = F.when(F.col("row").isNull(), F.col("value")).otherwise(F.col("row")[CORRUPT])
    return rows.select(*columns, corrupt.alias(CORRUPT))


def _is_blank() -> Column:
    return F.trim(F.coalesce(F.col("value").cast("string"), F.lit(""))) == ""


def blank_rows(lines: DataFrame) -> DataFrame:
    """The raw lines that hold nothing and so are neither good nor corrupt."""
    return lines.where(_is_blank())


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_lines(spark: SparkSession, source: str | Topic, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw JSON lines as one ``value`` column; existing data is replayed first."""
    reader = spark.readStream if streaming else spark.read
    if isinstance(source, Topic):
        return reader.format("kafka").options(**source.read_options(streaming)).load()
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(source)


def _read(spark, schema, source, streaming, max_files_per_trigger) -> DataFrame:
    lines = read_lines(spark, source, streaming, max_files_per_trigger)
    return good_rows(parse_json(lines, schema))


def read_events(spark: SparkSession, kind: str, source: str | Topic, streaming: bool = False,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """``marketing`` or ``cart`` events from a folder of JSON lines or a topic."""
    return _read(spark, schemas.EVENTS[kind], source, streaming, max_files_per_trigger)


def read_snapshots(spark: SparkSession, kind: str, source: str | Topic, streaming: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """``campaign`` or ``cart`` pre-aggregated snapshots, as `read_events`."""
    return _read(spark, schemas.SNAPSHOTS[kind], source, streaming, max_files_per_trigger)


def to_lines(df: DataFrame) -> DataFrame:
    """Each row as one JSON object in ``value``; NULL columns are left out."""
    columns = [F.col(c).alias(schemas.WIRE_NAMES.get(c, c)) for c in df.columns]
    return df.select(F.to_json(F.struct(*columns), {"timestampNTZFormat": _MICROS}).alias("value"))


def publish(df: DataFrame, target: str | Topic) -> None:
    """Append every row as one message to a topic or a folder of JSON lines."""
    publish_lines(to_lines(df), target)


def publish_lines(lines: DataFrame, target: str | Topic) -> None:
    """Append ready-made messages, one per ``value``."""
    if isinstance(target, Topic):
        lines.write.format("kafka").options(**target.write_options()).save()
    else:
        lines.write.mode("append").text(target)
