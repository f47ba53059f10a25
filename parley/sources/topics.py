"""Keyed message topics on Kafka or, without a broker, on folders.

Rows are ``(topic, key, value)``. Kafka routes each row by its ``topic`` column
and a folder is partitioned by it, so one write serves several topics.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parley.schemas import TOPIC_ROW

RAW = "raw"
PROCESSED = "processed"
DEAD_LETTERS = "dead_letters"


@dataclass(frozen=True)
class KafkaTopics:
    """Topics on a broker. The Kafka connector jar must be on the class path."""

    servers: str
    retries: int = 5

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        return self._rows(self._source(spark.read, topic).load())

    def stream(self, spark: SparkSession, topic: str, max_per_trigger: int | None = None) -> DataFrame:
        """``max_per_trigger`` bounds a micro-batch in messages; without it all that has come is one."""
        source = self._source(spark.readStream, topic)
        source = source.option("maxOffsetsPerTrigger", max_per_trigger) if max_per_trigger else source
        return self._rows(source.load())

    def write(self, df: DataFrame) -> None:
        self._sink(df.write).save()

    def write_stream(self, df: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        return _trigger(self._sink(df.writeStream).option("checkpointLocation", checkpoint), available_now).start()

    def _source(self, reader, topic: str):
        return (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
        )

    def _sink(self, writer):
        return (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("kafka.acks", "all")
            .option("kafka.retries", self.retries)
        )

    @staticmethod
    def _rows(df: DataFrame) -> DataFrame:
        return df.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic")


@dataclass(frozen=True)
class FolderTopics:
    """Topics in a folder of a shared file system.

    A folder has one writer: streamed and batch-written files are not mixed,
    because a streaming sink lists only the files of its own log.
    """

    folder: str

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        return spark.read.schema(TOPIC_ROW).parquet(self.folder).filter(F.col("topic") == topic)

    def stream(self, spark: SparkSession, topic: str, max_per_trigger: int | None = None) -> DataFrame:
        """``max_per_trigger`` bounds a micro-batch in files; without it all that has come is one."""
        source = spark.readStream.schema(TOPIC_ROW)
        source = source.option("maxFilesPerTrigger", max_per_trigger) if max_per_trigger else source
        return source.parquet(self.folder).filter(F.col("topic") == topic)

    def write(self, df: DataFrame) -> None:
        df.select("key", "value", "topic").write.partitionBy("topic").mode("append").parquet(self.folder)

    def write_stream(self, df: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        sink = (
            df.select("key", "value", "topic")
            .writeStream.format("parquet")
            .partitionBy("topic")
            .option("path", self.folder)
            .option("checkpointLocation", checkpoint)
        )
        return _trigger(sink, available_now).start()


def _trigger(sink, available_now: bool):
    return sink.trigger(availableNow=True) if available_now else sink.trigger(processingTime="1 second")
