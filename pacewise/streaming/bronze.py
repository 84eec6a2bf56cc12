"""Stream -> bronze ingestion (L1: A1, A2, A11, I1-I5).

The source yields Kafka-shaped records (``value`` = the JSON event, ``timestamp`` = broker
time). Parsing is permissive: a record that is not JSON becomes an all-NULL row, a bad field
becomes NULL alone; bronze keeps both (silver drops NULL event ids). No dedup in the stream:
duplicates must reach bronze.

The sink is ``foreachBatch``: each micro-batch is written with a *static* overwrite into its
own folder ``stream_tag=<tag>/batch_id=<n>/ingest_date=<d>/``. A batch replayed after a crash
replaces itself (even if the replay happens on another day), so the table holds each record
once, and the folder is plain Parquet that batch jobs may later erase or compact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, StringType, StructField, StructType, TimestampType

from pacewise.functions import utc_day
from pacewise.schemas import BRONZE_SCHEMA, EVENT_COLUMNS, LAYOUT_COLUMNS, conform
from pacewise.session import ensure_utc
from pacewise.sources import fs
from pacewise.sources.tables import Table

# Parse contract of the payload. Timestamps arrive as UTC ISO-8601 strings (possibly with an
# offset), so they are parsed as instants and stored as UTC wall clock.
PAYLOAD_SCHEMA = StructType([
    StructField(n, TimestampType() if n == "event_ts" else StringType(), True) for n in EVENT_COLUMNS
])
# A landed record in the shape of a Kafka message.
ENVELOPE_SCHEMA = StructType([
    StructField("key", StringType(), True),
    StructField("value", StringType(), True),
    StructField("timestamp", TimestampType(), True),
])

RECORD_SCHEMA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("timestamp", TimestampType(), True),
])


def kafka_source(spark: SparkSession, bootstrap: str, topic: str = "ad_events",
                 starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topic as a stream (A1). Needs the Kafka connector on the classpath.

    ``max_offsets_per_trigger`` bounds a micro-batch (a backlog after downtime is drained in
    bounded batches instead of one huge one).
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def file_source(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None, kind: str = "json") -> DataFrame:
    """Landed envelopes as a stream; same columns as the Kafka source uses below.

    JSON envelopes hold key and value as strings; Parquet ones as bytes, as Kafka's records do.
    """
    reader = spark.readStream.schema(ENVELOPE_SCHEMA if kind == "json" else RECORD_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(kind).load(landing_dir)


def parse(raw: DataFrame) -> DataFrame:
    """Envelope -> 12-column bronze rows."""
    parsed = (raw.select(F.from_json(F.col("value").cast("string"), PAYLOAD_SCHEMA).alias("e"),
                         F.col("timestamp").cast("timestamp_ntz").alias("kafka_ts"))
              .select("e.*", "kafka_ts")
              .withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))
              .withColumn("ingest_ts", F.current_timestamp().cast("timestamp_ntz")))
    return conform(parsed, BRONZE_SCHEMA)


def batch_table(bronze: Table, tag: str, batch_id: int) -> Table:
    """The folder of one micro-batch, partitioned by ingest day."""
    layout = StructType([LAYOUT_COLUMNS["bronze"]["ingest_date"]])
    return Table(f"{bronze.path}/stream_tag={tag}/batch_id={batch_id}", BRONZE_SCHEMA,
                 ("ingest_date",), layout, (("ingest_date", lambda: utc_day("ingest_ts")),),
                 bronze.cluster_by, f"{bronze.name}[{tag}/{batch_id}]", bronze.lookup_by)


def write_batch(bronze: Table, df: DataFrame, tag: str, batch_id: int) -> int:
    """Static overwrite of exactly this batch's folder (idempotent on replay); the rows written."""
    return batch_table(bronze, tag, batch_id).write(df, mode="overwrite")


def start(spark: SparkSession, raw: DataFrame, bronze: Table, checkpoint: str, tag: str,
          processing_time: str | None = "10 seconds", available_now: bool = False,
          on_batch: Callable[[DataFrame, int], object] | None = None, name: str | None = None) -> StreamingQuery:
    """Start the ingestion.

    ``on_batch`` gets each batch as bronze holds it, after it was written; a batch whose ``on_batch`` failed
    is replayed as a whole, so it must bear being called again.

    Batch ids restart at 0 when a checkpoint is lost, which would overwrite earlier batches of
    the same tag; so a missing checkpoint with existing data for ``tag`` is refused.
    """
    ensure_utc(spark)  # instants become UTC wall clock in ``parse``
    if not fs.exists(spark, f"{checkpoint}/offsets") and fs.has_data_files(
            spark, f"{bronze.path}/stream_tag={tag}"):
        raise RuntimeError(f"checkpoint {checkpoint} missing but bronze already holds stream_tag={tag}; "
                           "start with a new tag")

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        write_batch(bronze, batch_df, tag, batch_id)
        if on_batch:
            on_batch(batch_table(bronze, tag, batch_id).read(spark), batch_id)

    writer = (parse(raw).writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(sink))
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


LANDED_ROWS = 250_000  # rows of a landed file, about: some tens of MB as plain JSON


def landing_files(events: DataFrame, batches: int = 4) -> int:
    """Files of about ``LANDED_ROWS`` rows at most, as many in each of ``batches`` micro-batches."""
    return batches * max(1, -(-events.count() // (batches * LANDED_ROWS)))


def land_envelopes(events: DataFrame, landing_dir: str, files: int | None = 4, broken: Column | None = None,
                   kind: str = "json") -> None:
    """Write bronze-shaped rows as JSON envelopes (the file stand-in for the topic), with
    UTC ISO-8601 timestamps at microsecond precision, as a producer would send them.

    The payload of a ``broken`` row ends too early, as of a record cut off. Without ``files`` the input's
    own partitions are the files; else rows go to files by hash of all their columns, before the payload is
    made: a shuffle of the columns alone, that sorts nothing. JSON files are compressed.
    """
    if files:
        events = events.repartition(files, F.xxhash64(*events.columns))
    fields = [F.col(c).cast("timestamp").alias(c) if c == "event_ts" else F.col(c) for c in EVENT_COLUMNS]
    payload = F.to_json(F.struct(*fields), {"timestampFormat": ISO_UTC})
    if broken is not None:
        payload = F.when(broken, F.substring(payload, F.lit(1), F.length(payload) - 2)).otherwise(payload)
    rows = events.select(F.col("user_id").alias("key"), payload.alias("value"), F.col("kafka_ts").cast("timestamp").alias("timestamp"))
    if kind != "json":
        rows = rows.withColumns({c: F.col(c).cast("binary") for c in ("key", "value")})
    writer = rows.write.mode("overwrite").format(kind)
    (writer.option("timestampFormat", ISO_UTC).option("compression", "gzip") if kind == "json" else writer).save(landing_dir)
