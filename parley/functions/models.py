"""Optional model hooks. Both load their model once per Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import functions as F


def person_names(load: Callable[[], Callable[[str], list[str]]]):
    """Iterator UDF ``text -> ARRAY<STRING>`` around a person recogniser.

    ``load`` runs once per worker and returns a function from a text to the
    person names in it. Feed the result to :func:`parley.functions.text.mask_names`.
    """

    @F.pandas_udf("array<string>")
    def names(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = load()
        for texts in batches:
            yield texts.map(lambda t: [] if t is None else list(find(t)))

    return names


def chat_tokenize(load: Callable[[], Callable[[list[dict], bool], list[int]]]):
    """Iterator UDF ``conversations -> STRUCT<full_ids, prompt_len>``.

    ``load`` runs once per worker and returns ``encode(messages, add_generation_prompt)``.
    """

    @F.pandas_udf("struct<full_ids:array<int>,prompt_len:int>")
    def tokenize(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = load()
        for rows in batches:
            full, prompt = [], []
            for row in rows:
                messages = [dict(m) for m in row]
                full.append(encode(messages, False))
                prompt.append(len(encode(messages[:-1], True)))
            yield pd.DataFrame({"full_ids": full, "prompt_len": prompt})

    return tokenize
