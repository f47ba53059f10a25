"""Store to topics to store, in one bounded run."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.text import Names
from parley.schemas import DEFAULT_SYSTEM_PROMPT
from parley.sources.topics import DEAD_LETTERS, PROCESSED, RAW, FolderTopics
from parley.streaming.etl import log_failures, run_extract, stream_load, stream_transform


@dataclass(frozen=True)
class EtlLayout:
    """Where a run keeps its topics and checkpoints (``root``, one per run) and
    the store and status log that runs share."""

    root: str
    raw: object
    transformed: object
    store: str
    status_log: str

    @classmethod
    def folders(cls, root: str, store: str | None = None, status_log: str | None = None) -> EtlLayout:
        return cls(
            root,
            FolderTopics(f"{root}/raw"),
            FolderTopics(f"{root}/transformed"),
            store or f"{root}/processed",
            status_log or f"{root}/status",
        )

    @property
    def stats(self) -> str:
        return f"{self.root}/stats"

    @property
    def rejects(self) -> str:
        return f"{self.root}/load_rejects"

    def checkpoint(self, phase: str) -> str:
        return f"{self.root}/checkpoints/{phase}"


def read_status_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def run_etl(
    spark: SparkSession,
    docs: DataFrame,
    layout: EtlLayout,
    system: str = DEFAULT_SYSTEM_PROMPT,
    parallel: bool = False,
    names: Names = None,
    max_per_trigger: int | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Extract, transform, load; returns ``published, transformed, failed, dlq, loaded, inserted, skipped``.

    Extracted are the documents still pending after the status log, or those that
    meet ``where``. ``parallel`` runs both streams at the same time. Nothing
    extracted ends the run early with zeros. ``max_per_trigger`` bounds a
    micro-batch (messages of a broker, files of a folder). Messages that cannot be
    loaded end up below ``load_rejects`` and count as failed and as dead letters.
    """
    published = run_extract(docs, layout.raw, f"{layout.status_log}/extract", log_root=layout.status_log, where=where)
    counts = ("published", "transformed", "failed", "dlq", "loaded", "inserted", "skipped")
    if published == 0:
        return spark.range(1).select(*[F.lit(0).cast("bigint").alias(n) for n in counts])

    raw = layout.raw.stream(spark, RAW, max_per_trigger)
    transform = stream_transform(raw, layout.transformed, layout.checkpoint("transform"), system, names=names)
    load = None
    try:
        if parallel:
            # A folder can be followed once its first files are there.
            while transform.isActive and not transform.recentProgress:
                time.sleep(0.1)
        else:
            transform.awaitTermination()
        if transform.exception() is None:
            load = stream_load(
                layout.transformed.stream(spark, PROCESSED, max_per_trigger),
                layout.store,
                layout.checkpoint("load"),
                layout.rejects,
                f"{layout.status_log}/load",
                layout.stats,
                available_now=not parallel,
            )
        transform.awaitTermination()
        if parallel:
            load.processAllAvailable()
        else:
            load.awaitTermination()
    finally:
        # A failed transform is raised above; neither stream outlives the run.
        for running in (transform, load):
            if running is not None and running.isActive:
                running.stop()

    dead = layout.transformed.read(spark, DEAD_LETTERS)
    log_failures(dead, f"{layout.status_log}/failed")
    n_ok = layout.transformed.read(spark, PROCESSED).agg(F.count(F.lit(1))).scalar()
    n_dead = dead.agg(F.count(F.lit(1))).scalar()
    n_lost = spark.read.parquet(layout.rejects).agg(F.count(F.lit(1))).scalar()
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("loaded", "inserted", "skipped")]
    return (
        spark.read.parquet(layout.stats)
        .agg(*sums)
        .select(
            F.lit(published).cast("bigint").alias("published"),
            n_ok.alias("transformed"),
            (n_dead + n_lost).alias("failed"),
            (n_dead + n_lost).alias("dlq"),
            "loaded",
            "inserted",
            "skipped",
        )
    )
