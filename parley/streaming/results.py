"""Arrival-driven results and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parley.operators.leads import ingest_results
from parley.operators.monitoring import metric_sketches, sketched_windows
from parley.session import exists, read_note, write_note, written
from parley.sources.keyed import BUCKETS, KeyedTable, buckets_in
from parley.sources.outputs import output_objects, outputs_of


def stream_results(
    spark: SparkSession, path: str, log: str, checkpoint: str, max_files: int = 1000, available_now: bool = True
) -> StreamingQuery:
    """Parses output files as they arrive and appends them to a result log.

    ``ingest_results(leads, spark.read.parquet(log), at)`` then gives the leads;
    ``stream_lead_results`` keeps a stored table of them up to date instead.
    """
    sink = (
        outputs_of(arriving_objects(spark, path, max_files))
        .writeStream.format("parquet")
        .option("path", log)
        .option("checkpointLocation", checkpoint)
    )
    sink = sink.trigger(availableNow=True) if available_now else sink.trigger(processingTime="1 second")
    return sink.start()


def lead_table(spark: SparkSession, path: str, leads: DataFrame, buckets: int = BUCKETS) -> KeyedTable:
    """A stored table of the leads that have a request, laid out by request id, for ``stream_lead_results``."""
    table = KeyedTable.create(spark, path, leads.schema, ["sagemaker_request_id", "_id"], buckets, ["sagemaker_request_id"])
    table.write(leads.where(F.col("sagemaker_request_id").isNotNull()), 0)
    return table


def apply_results(table: KeyedTable, outputs: DataFrame, version: int, at: Column, stats: str | None = None) -> None:
    """Sets the results of one batch of ``outputs`` on their leads, as a version of the table.

    Only the buckets of the batch's requests are read and only the leads it
    answers are written. A replay writes the same version again.
    """
    spark = outputs.sparkSession
    with written(outputs) as outputs:
        answers = outputs.where("request_id is not null and result is not null")
        near = table.read(spark, buckets_in(table.with_bucket(answers.select(F.col("request_id").alias("sagemaker_request_id")))), version)
        updated, counts = ingest_results(near, outputs, at, answered_only=True)
        table.write(updated, version)
        if stats:
            counts.write.mode("overwrite").parquet(f"{stats}/version={version}")


def stream_lead_results(
    objects: DataFrame, table: KeyedTable, checkpoint: str, at: Column | None = None, stats: str | None = None, available_now: bool = True
) -> StreamingQuery:
    """Applies output objects (key, body) to the stored leads as they arrive.

    A micro-batch is a version of the table. The first version of a checkpoint
    is noted beside it, so a restarted stream repeats its own versions and a
    new one goes on behind all others. The table has one such stream at a time.
    """
    spark = objects.sparkSession
    note = f"{checkpoint.rstrip('/')}-first-version"
    if not exists(spark, note):
        write_note(spark, note, str(max(table.versions(spark), default=-1) + 1))
    first = int(read_note(spark, note))
    at = F.current_timestamp() if at is None else at

    def ingest(batch: DataFrame, batch_id: int) -> None:
        apply_results(table, outputs_of(batch), first + batch_id, at, stats)

    sink = objects.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint)
    sink = sink.trigger(availableNow=True) if available_now else sink.trigger(processingTime="1 second")
    return sink.start()


def arriving_objects(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Output files as a stream of (key, body)."""
    files = spark.readStream.option("wholetext", "true").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files)
    return output_objects(files.text(path))


def stream_metric_windows(
    events: DataFrame, ts: str, value: str, width: str, late: str, stats=("sum", "avg"), by: tuple[str, ...] = ()
) -> DataFrame:
    """Monitoring series over a stream; a window is final once it is ``late`` old.

    Percentiles come from quantile sketches, the state of a window being of fixed size; a batch gives exact ones.
    """
    return sketched_windows(stream_metric_sketches(events, ts, value, width, late, by), stats, by)


def stream_metric_sketches(events: DataFrame, ts: str, value: str, width: str, late: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Sketched windows over a stream, to be stored and put together to wider ones by ``merge_sketches``."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return metric_sketches(timed, ts, value, width, by)
