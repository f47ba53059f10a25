"""Document store: any Spark format or table, with filter documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.schemas import ETL_PENDING

_COMPARE = {
    "$gte": lambda c, v: c >= v,
    "$gt": lambda c, v: c > v,
    "$lte": lambda c, v: c <= v,
    "$lt": lambda c, v: c < v,
    "$exists": lambda c, v: c.isNotNull() if v else c.isNull(),
}


def filter_doc(spec: dict) -> Column:
    """Column of a filter document: equality and ``$gte $gt $lte $lt $exists``.

    An empty document accepts everything. The result is a plain predicate, which
    Spark pushes to the scan.
    """
    terms = []
    for field, wanted in spec.items():
        c = F.col(field)
        if isinstance(wanted, dict):
            unknown = set(wanted) - set(_COMPARE)
            if unknown:
                raise ValueError(f"unknown operators: {sorted(unknown)}")
            terms += [_COMPARE[op](c, v) for op, v in wanted.items()]
        else:
            terms.append(c.isNull() if wanted is None else c == wanted)
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def read_store(spark: SparkSession, path: str, spec: dict | None = None, fmt: str = "parquet") -> DataFrame:
    """Documents that meet the filter; without one, those still pending."""
    spec = {"etl_status": ETL_PENDING} if spec is None else spec
    return spark.read.format(fmt).load(path).filter(filter_doc(spec))


def pending(df: DataFrame, status: str = ETL_PENDING) -> DataFrame:
    return df.filter(F.col("etl_status") == status)


def unassigned(df: DataFrame, status: str) -> DataFrame:
    """Rows of a status that belong to no training run yet."""
    return df.filter((F.col("etl_status") == status) & F.col("training_run_id").isNull())
