"""Stored tables with a key: rows in hash buckets, changes as versions beside them.

A version is a folder with a subfolder per bucket. A row counts with its newest
version, so a change writes only the rows that differ, a look-up reads only the
buckets of the keys it wants, and no file is ever changed in place.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.operators.merges import COUNTS, FAILED, INSERTED, UPDATED, latest_per_key, plan_upsert
from parley.session import cut_lineage, exists, file_system, read_note, write_note

BUCKETS = 64
LAYOUT = "_layout.json"


def bucket_of(keys: list[str] | tuple[str, ...], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def buckets_in(rows: DataFrame) -> list[int]:
    """The values of ``bucket`` in ``rows``: never more than the table has buckets."""
    return sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())


@dataclass(frozen=True)
class KeyedTable:
    """A table at ``path`` with one row per key.

    ``buckets`` is chosen once, so that a bucket of the full table fits a task.
    ``bucket_by`` are the key columns that look-ups give; by default all.
    A version is complete when its folder holds the mark of a finished write;
    a write that failed is not seen, and doing it again replaces it.
    """

    path: str
    keys: tuple[str, ...]
    schema: T.StructType
    buckets: int
    bucket_by: tuple[str, ...]

    @classmethod
    def create(
        cls, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = BUCKETS, bucket_by: list[str] | None = None
    ) -> KeyedTable:
        layout = {"keys": keys, "buckets": buckets, "bucket_by": bucket_by or keys, "schema": schema.json()}
        write_note(spark, f"{path}/{LAYOUT}", json.dumps(layout))
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> KeyedTable:
        layout = json.loads(read_note(spark, f"{path}/{LAYOUT}"))
        schema = T.StructType.fromJson(json.loads(layout["schema"]))
        return cls(path, tuple(layout["keys"]), schema, layout["buckets"], tuple(layout["bucket_by"]))

    def versions(self, spark: SparkSession) -> list[int]:
        """Complete versions, oldest first; one folder each."""
        fs, at = file_system(spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]
        found = sorted(int(n.partition("=")[2]) for n in names if n.startswith("version="))
        return [v for v in found if exists(spark, f"{self.folder(v)}/_SUCCESS")]

    def folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def stored(self, spark: SparkSession, buckets: list[int] | None = None, before: int | None = None) -> DataFrame:
        """All stored rows with ``version`` and ``bucket``, superseded ones included; other buckets' files are not read."""
        versions = [v for v in self.versions(spark) if before is None or v < before]
        schema = T.StructType([*self.schema.fields, T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType())])
        if not versions:
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).option("basePath", self.path).parquet(*[self.folder(v) for v in versions])
        return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))

    def read(self, spark: SparkSession, buckets: list[int] | None = None, before: int | None = None) -> DataFrame:
        """Each key's newest row, of versions before ``before`` if given."""
        rows = self.stored(spark, buckets, before).drop("bucket")
        if len(self.versions(spark)) > 1:
            rows = latest_per_key(rows, list(self.keys), "version")
        return rows.select(*self.schema.names)

    def with_bucket(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", bucket_of(self.bucket_by, self.buckets))

    def write(self, rows: DataFrame, version: int, parts: int = 1) -> None:
        """Stores ``rows``, one per key, as ``version``; doing it again replaces that version.

        ``parts`` is the number of files of a bucket, for the first load of a large table.
        """
        placed = self.with_bucket(rows.select(*self.schema.names))
        part = F.pmod(F.xxhash64(F.lit(1), *self.keys), F.lit(parts))
        dealt = placed.repartition("bucket", part) if parts > 1 else placed.repartition("bucket")
        dealt.write.partitionBy("bucket").mode("overwrite").parquet(self.folder(version))

    def replace(self, source: DataFrame, version: int, order: str) -> None:
        """Puts the latest source row of each key in place of the stored one. Nothing stored is read."""
        self.write(latest_per_key(source, list(self.keys), order), version)

    def upsert(self, source: DataFrame, version: int, overwrite: bool = False, dry_run: bool = False) -> dict[str, int]:
        """Merges ``source`` in and returns ``inserted, updated, skipped, failed``.

        Only the buckets of its keys are read, and only rows that are new or, with
        ``overwrite``, differ are written. Of source rows with one key the
        smallest counts; a row without a whole key fails. A replay sees what the
        first run saw, unless the table was compacted in between: then its rows
        still do not win over the compacted ones, but its counts may differ.
        """
        spark = source.sparkSession
        placed = cut_lineage(self.with_bucket(source.select(*self.schema.names)))
        whole = F.lit(True)
        for k in self.keys:
            whole = whole & F.col(k).isNotNull()
        target = self.read(spark, buckets_in(placed.where(whole)), version)
        plan = plan_upsert(target, placed.where(whole).drop("bucket"), list(self.keys), overwrite)
        lost = placed.where(~whole).select(*self.keys, F.lit(FAILED).alias("action"))
        # Written: an observation beside the delta would be lost when nothing changes and the delta's plan is emptied.
        decided = plan.where("action is not null").select(*self.keys, "new", "action")
        decided = cut_lineage(decided.unionByName(lost, allowMissingColumns=True))
        counts = decided.agg(*[F.count_if(F.col("action") == a).alias(a) for a in COUNTS]).first().asDict()
        if not dry_run:
            self.write(decided.where(F.col("action").isin(INSERTED, UPDATED)).select(*self.keys, "new.*"), version)
        return counts

    def set_values(self, keys: DataFrame, values: dict[str, Column], version: int) -> None:
        """Sets columns of the rows whose ``bucket_by`` columns are among those of ``keys``."""
        spark = keys.sparkSession
        wanted = cut_lineage(self.with_bucket(keys.select(*self.bucket_by).distinct()))
        hit = self.read(spark, buckets_in(wanted), version).join(wanted.drop("bucket"), list(self.bucket_by), "left_semi")
        self.write(hit.select(*self.schema.names).withColumns(values), version)

    def compact(self, spark: SparkSession, most: int = 8) -> list[int]:
        """Rewrites buckets that lie in more than ``most`` versions; returns these buckets.

        Their newest rows become a new version before the old files go, so that
        a reader finds the same rows before, between and after.
        """
        held: dict[int, list[int]] = {}
        for v in self.versions(spark):
            fs, at = file_system(spark, self.folder(v))
            for s in fs.listStatus(at):
                name = s.getPath().getName()
                if name.startswith("bucket="):
                    held.setdefault(int(name.partition("=")[2]), []).append(v)
        full = sorted(b for b, versions in held.items() if len(versions) > most)
        if full:
            self.write(self.read(spark, full), max(self.versions(spark)) + 1)
            for b in full:
                for v in held[b]:
                    fs, at = file_system(spark, f"{self.folder(v)}/bucket={b}")
                    fs.delete(at, True)
        return full
