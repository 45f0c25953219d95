"""Kafka event source.

Subscribes to topics and yields ``value`` as UTF-8 text with its
``topic, partition, offset, timestamp``.  Offsets are never committed to
Kafka; the query checkpoint is the source of truth, and the ledger
(:mod:`daybook.sources.ledger`) can seed ``startingOffsets`` for a new
checkpoint.  Without stored offsets the query starts at the latest offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.sources.ledger import OffsetLedger


def kafka_options(bootstrap_servers: str, topics: list[str] | str,
                  starting_offsets: str | None = None,
                  max_offsets_per_trigger: int | None = None,
                  min_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> dict[str, str]:
    """Options for ``spark.readStream.format("kafka")``.

    ``starting_offsets`` is ``"latest"`` (default), ``"earliest"`` or a JSON
    string naming every partition (``-1`` latest, ``-2`` earliest); a query
    checkpoint, when present, wins over it.  ``max_offsets_per_trigger``
    bounds a micro-batch; ``min_partitions`` splits large Kafka partitions
    across more Spark tasks.
    """
    topic_list = topics if isinstance(topics, str) else ",".join(topics)
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic_list,
        "startingOffsets": starting_offsets or "latest",
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update(extra or {})
    return opts


def kafka_rows(df: DataFrame) -> DataFrame:
    """Kafka source rows -> ``value`` (text), ``topic, partition, offset``,
    ``timestamp`` and ``ingest_ts`` (the record timestamp)."""
    return df.select(F.col("value").cast("string").alias("value"), "topic", "partition",
                     "offset", "timestamp", F.col("timestamp").alias("ingest_ts"))


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming Kafka source (needs the Kafka connector on the classpath)."""
    return kafka_rows(spark.readStream.format("kafka").options(**options).load())


def resume_stream(spark: SparkSession, bootstrap_servers: str, topics: list[str] | str,
                  ledger: OffsetLedger, partitions: dict[str, int] | None = None,
                  read=read_kafka_stream, **options) -> DataFrame:
    """Open the stream where the ledger says the group stopped, or at the
    latest offsets when it says nothing.  A query checkpoint, when present,
    wins over both.  ``read`` opens the source from its options."""
    start = ledger.resume_from(partitions)
    return read(spark, kafka_options(bootstrap_servers, topics, start, **options))
