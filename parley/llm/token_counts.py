"""Token counts of a SentencePiece BPE model, merging many words at once on ragged arrays."""

from __future__ import annotations

import functools
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import Memo, utf8, with_python_columns
from parley.llm.ragged import PairTable

SPACE = "\u2581"


class PieceCounter:
    """Counts the tokens of words with the pieces and scores of a model file.

    A pair of symbols merges if their joined text is a piece; the best score
    goes first, the leftmost of equals. All new words of a chunk merge in step.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n = model.get_piece_size()
        usual = [
            i for i in range(self.n)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))
        ]
        self.pieces = {model.id_to_piece(i): i for i in usual}
        # Rank 0 is the best score; equal scores are told apart only by their place in the text.
        scores = sorted({model.get_score(i) for i in usual}, reverse=True)
        at = {s: r for r, s in enumerate(scores)}
        rank = {i: at[model.get_score(i)] for i in usual}
        self.byte_fallback = any(model.is_byte(i) for i in range(self.n))
        pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for text, i in self.pieces.items():
            for k in range(1, len(text)):
                a, b = self.pieces.get(text[:k]), self.pieces.get(text[k:])
                if a is not None and b is not None:
                    pairs[a, b] = (rank[i], i)
        self.table = PairTable(pairs, self.n)
        # A word ends where a blank follows another character: no piece holds such a pair.
        if any(SPACE in t.lstrip(SPACE) for t in self.pieces):
            raise ValueError("pieces reach across words in this model")

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each word: symbols that survive, or the bytes of a character outside the pieces."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        kinds, kind = np.unique(codes, return_inverse=True)
        chars = [chr(c) for c in kinds.tolist()]
        ids = np.array([self.pieces.get(c, -1) for c in chars], np.int64)
        cost = np.array([len(c.encode()) if c not in self.pieces and self.byte_fallback else 1 for c in chars], np.int64)
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        symbol, place = self.table.merge(ids[kind], word)
        weight = np.where(symbol < 0, cost[kind[place]], 1)
        return np.bincount(word[place], weights=weight, minlength=len(words)).astype(np.int64)

    @functools.cached_property
    def memo(self) -> Memo:
        """Words, as bytes with the blanks before them, and their counts."""
        return Memo(lambda new: self.count([w.decode().replace(" ", SPACE) for w in new]).tolist())

    def words(self, text: bytes) -> list[bytes]:
        """The text's words with the blanks before them; one blank stands before the whole text."""
        if not text:
            return []
        if b"  " in text or text[:1] == b" " or text[-1:] == b" " or SPACE_BYTES in text:
            return WORDS.findall((b" " + text).replace(SPACE_BYTES, b" "))
        first, *rest = text.split(b" ")
        return [b" " + first, *(b" " + w for w in rest)]

    def counts(self, texts: list[bytes]) -> list[int]:
        parts = [self.words(t) for t in texts]
        table = self.memo.over(parts)
        return [sum(map(table.__getitem__, p)) for p in parts]


SPACE_BYTES = SPACE.encode()
WORDS = re.compile(rb" +[^ ]+| +$")


@functools.lru_cache(maxsize=4)
def load(path: str) -> PieceCounter:
    """One model per worker process."""
    return PieceCounter(path)


def with_token_counts(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of each whole text as the model's library gives them.

    No begin, end or other special token is added, and their strings in a text
    are ordinary text. Null and empty texts have no tokens. Rows and further
    columns stay as they are; a column named ``out`` is replaced.
    """
    return with_python_columns(
        docs, utf8(F.col(text)), [T.StructField(out, T.LongType())], lambda: lambda x: [load(path).counts(x)]
    )
