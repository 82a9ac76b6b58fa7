"""Log-line sources: text files (batch and stream), socket and Kafka streams.

Every source yields one column ``value STRING``, one row per line, so the
same parser and reports serve batch and streaming.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import LOG_LINE


def read_logs(spark: SparkSession, path) -> DataFrame:
    """SRC-1: batch text scan, one row per line.

    Text files split by bytes; a floor on the number of splits (the reference
    asked for 10) is the session's ``spark.sql.files.minPartitionNum``, which
    the command line sets for its own session.
    """
    return spark.read.text(path)


def kafka_options(bootstrap_servers: str, topics, group_id: str | None = None,
                  min_partitions: int | None = None, starting_offsets: str | None = None,
                  extra: dict | None = None) -> dict:
    """SRC-3 option set: several topics, a consumer group, a parallelism floor."""
    topic_list = topics if isinstance(topics, str) else ",".join(topics)
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic_list}
    if group_id:
        opts["kafka.group.id"] = group_id
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if starting_offsets:
        opts["startingOffsets"] = starting_offsets
    opts.update(extra or {})
    return opts


def read_log_stream(spark: SparkSession, source: str = "text", path: str | None = None,
                    max_files_per_trigger: int | None = None, host: str = "localhost",
                    port: int | None = None, kafka: dict | None = None,
                    options: dict | None = None) -> DataFrame:
    """Streaming lines.

    * ``text``  – new files in ``path`` (tests use this with ``availableNow``);
    * ``socket`` – SRC-2, ``host:port`` (needs a listening feeder);
    * ``kafka`` – SRC-3, options from :func:`kafka_options`; keeps the message
      value only, as text.  Needs the Kafka connector on the classpath.
    """
    reader = spark.readStream
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    if source == "text":
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.schema(LOG_LINE).format("text").load(path)
    if source == "socket":
        if port is None:
            raise ValueError("socket source needs a port")
        return reader.format("socket").option("host", host).option("port", str(port)).load()
    if source == "kafka":
        for key, value in (kafka or {}).items():
            reader = reader.option(key, value)
        return reader.format("kafka").load().select(F.col("value").cast("string").alias("value"))
    raise ValueError(f"unknown log source {source!r}")


def write_lines(lines: DataFrame, path: str, value_col: str = "value", mode: str = "append") -> None:
    """SNK-10 / SNK-2: write lines (formatted log lines, rejected lines) as text."""
    lines.select(value_col).write.mode(mode).text(path)


def write_lines_kafka(lines: DataFrame, bootstrap_servers: str, topic: str,
                      value_col: str = "value") -> None:
    """SNK-10: publish lines to a Kafka topic (needs the Kafka connector)."""
    (lines.select(F.col(value_col).cast("string").alias("value")).write.format("kafka")
          .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())
