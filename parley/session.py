"""Session helpers: shared folder for cut lineage and a builder for local runs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder. On a cluster a
    missing setting is an error, because a machine-local folder would be lost
    with its machine.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc.getCheckpointDir() is None:
        # Executors of local-cluster are processes of their own and may share no folder.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="parley-"))
    return sc.getCheckpointDir().rstrip("/")


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path of ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small file of text; one that exists already is an error."""
    fs, at = file_system(spark, path)
    stream = fs.create(at, False)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_note(spark: SparkSession, path: str) -> str:
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder for a written intermediate table."""
    return f"{shared_dir(spark)}/parley/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Lost executors then cost no recompute. Unlike a checkpoint the table is
    computed once, is read by column, and has a size the optimizer can see. It is
    removed when the application ends.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    fs, at = file_system(df.sparkSession, path)
    fs.deleteOnExit(at)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def written(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back by column, for work that goes over it several times.

    The table is removed at the end of the block, so a stream that does this for each batch leaves nothing behind.
    """
    path = scratch_path(df.sparkSession, "batch")
    fs, at = file_system(df.sparkSession, path)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        fs.delete(at, True)
