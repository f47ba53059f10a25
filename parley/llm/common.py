"""Helpers shared by the operators: written tables, Python columns in bounded chunks, word memos."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.session import scratch_path

# A chunk of rows handed to Python code at once holds about this many bytes of text.
CHUNK_BYTES = 2 << 20
# Entries one worker keeps of what it worked out for a word; further words are worked out anew.
MEMO_ENTRIES = 600_000


class Scratch:
    """Intermediate tables in the shared folder, which survive lost executors.

    ``write`` computes a frame once and returns the written table; ``drop``
    removes a table that nothing reads any more. Tables that a result still
    reads stay until the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def write(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = path
        self._file_system(path).deleteOnExit(self._path(path))
        return table

    def drop(self, table: DataFrame) -> None:
        path = self.paths.pop(id(table))
        self._file_system(path).delete(self._path(path), True)

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _file_system(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def utf8(column) -> object:
    """The text's bytes; a null text counts as empty."""
    return F.coalesce(column.cast("binary"), F.lit(b""))


def utf8_length(text: str) -> object:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")


def chunks(batch: pa.RecordBatch, column: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of about ``limit`` bytes in a binary column; a longer value is a slice of its own."""
    start, held = 0, 0
    sizes = pc.binary_length(batch.column(column)).to_pylist()
    for i, size in enumerate(sizes):
        if held and held + (size or 0) > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size or 0
    if start < len(sizes):
        yield batch.slice(start)


def with_python_columns(
    df: DataFrame, source, fields: list[T.StructField], make: Callable[[], Callable[[list[bytes]], list]]
) -> DataFrame:
    """``df`` with columns that Python code works out from the binary column ``source``.

    ``make`` runs once per task and returns a function from a list of values
    to one list per field. Columns of ``df`` with the name of a field are replaced.
    """
    names = {f.name for f in fields}
    kept = df.select(*[c for c in df.columns if c not in names], source.alias("__source"))
    passed = kept.drop("__source")
    schema = T.StructType([*passed.schema.fields, *fields])
    last = len(kept.columns) - 1
    types = [to_arrow(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in chunks(batch, last):
                made = work(part.column(last).to_pylist())
                arrays = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:last], *arrays], names=schema.names)

    return kept.mapInArrow(run, schema)


def to_arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


class Memo:
    """What a worker worked out for words so far; ``batch`` works out a list of new words."""

    def __init__(self, batch: Callable[[list], list], entries: int = MEMO_ENTRIES):
        self.known, self.batch, self.entries = {}, batch, entries

    def over(self, texts: list[list]) -> dict:
        """A table with every word of ``texts``."""
        new = set().union(*texts).difference(self.known)
        if not new:
            return self.known
        new = sorted(new)
        made = dict(zip(new, self.batch(new), strict=True))
        if len(self.known) + len(made) <= self.entries:
            self.known.update(made)
            return self.known
        return Both(made, self.known)


class Both(dict):
    """A small table before a large one."""

    def __init__(self, small: dict, large: dict):
        super().__init__(small)
        self.large = large

    def __missing__(self, key):
        return self.large[key]
