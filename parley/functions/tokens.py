"""Training-array scalars over token id arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.schemas import IGNORE_LABEL, MAX_SEQ_LENGTH


def truncate(ids: Column, max_len: int = MAX_SEQ_LENGTH) -> Column:
    return F.slice(ids, 1, max_len)


def prompt_mask(ids: Column, prompt_len: Column, max_len: int = MAX_SEQ_LENGTH) -> Column:
    """Labels: ids with the prompt set to the ignored value, cut to ``max_len``."""
    return F.transform(
        truncate(ids, max_len), lambda x, i: F.when(i < prompt_len, F.lit(IGNORE_LABEL)).otherwise(x)
    )


def supervised_tokens(labels: Column) -> Column:
    return F.size(F.filter(labels, lambda x: x != IGNORE_LABEL)).cast("bigint")
