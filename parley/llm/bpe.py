"""Byte-level BPE: texts are cut where no token can reach across, and the fragments encoded on their own."""

from __future__ import annotations

import functools
import json
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import Memo, utf8, with_python_columns
from parley.llm.ragged import PairTable

# No text holds this byte.
MARK = b"\xff"
# Fragments of the commonest form, whose words can be told without the vocabulary's own splitter:
# a line end, a blank with Latin letters, punctuation other than an apostrophe.
PLAIN = re.compile("(\n?)( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")
WHITE = b"\t\n\x0b\x0c\r "
# Bytes before the last byte of every white-space character above ASCII: U+0085 and U+00A0; U+1680; U+2000 and so on.
MAYBE_WHITE = bytes([0xC2, 0x9A, 0x80, 0x81])


def printable_bytes() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves; the other bytes, in
    order, have the characters from U+0100 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level BPE vocabulary, as read from a ``tokenizers`` file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if spec["normalizer"] is not None or spec["pre_tokenizer"]["type"] != "ByteLevel" or model.get("ignore_merges"):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        self.split_words = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.of_char = printable_bytes()
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        as_bytes = {t: bytes(self.of_char[c] for c in t) for t in model["vocab"]}
        size = 1 + max([*model["vocab"].values(), *self.special.values()])
        self.tokens: list[bytes] = [b""] * size
        for t, i in model["vocab"].items():
            self.tokens[i] = as_bytes[t]
        for t, i in self.special.items():
            self.tokens[i] = t
        self.single = np.zeros(256, np.int64)
        for i, t in enumerate(self.tokens):
            if len(t) == 1:
                self.single[t[0]] = i
        pairs: dict[tuple[int, int], tuple[int, int]] = {}
        vocab = model["vocab"]
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.table = PairTable(pairs, size)
        # never[a, b]: no token holds byte a directly before byte b.
        self.never = np.ones((256, 256), bool)
        for t in as_bytes.values():
            raw = np.frombuffer(t, np.uint8)
            self.never[raw[:-1], raw[1:]] = False
        # Of these, the cuts between a word and the white space after it also keep the words on
        # both sides as they are: no word goes on past it, and none looks back beyond it.
        white = np.zeros(256, bool)
        white[list(WHITE)] = True
        black = ~white
        black[:32] = black[127] = False
        self.cut = (self.never & black[:, None] & white[None, :]).ravel()
        self.maybe = np.zeros(256, bool)
        self.maybe[list(MAYBE_WHITE)] = True

    def fragments(self, text: bytes) -> list[bytes]:
        """``text`` cut wherever a byte pair is in no token and the words around do not depend on each other."""
        if len(text) < 2:
            return [text] if text else []
        raw = np.frombuffer(text, np.uint8)
        at = np.flatnonzero(self.cut[raw[:-1].astype(np.uint16) << 8 | raw[1:]])
        last = raw[at]
        wide = last >= 0x80
        if wide.any():
            at = at[~(wide & self.maybe[raw[at - 1]])]
        ends = (at + 1).tolist()
        return [text[s:e] for s, e in zip([0, *ends], [*ends, len(text)])]

    def words(self, fragment: bytes) -> list[bytes]:
        """The fragment's words as the vocabulary's pattern splits them."""
        text = fragment.decode()
        plain = PLAIN.fullmatch(text)
        if plain:
            return [w.encode() for w in plain.groups() if w]
        return [bytes(map(self.of_char.__getitem__, w)) for w, _ in self.split_words(text)]

    def encode_fragments(self, fragments: list[bytes]) -> list[bytes]:
        """The ids of each fragment, packed. All fragments' words merge in step, cut further at pairs no token holds."""
        words = [[] if f[:1] == MARK else self.words(f) for f in fragments]
        flat = [w for own in words for w in own]
        raw = np.frombuffer(b"".join(flat), np.uint8)
        packed = [b""] * len(fragments)
        if len(raw):
            lengths = np.fromiter(map(len, flat), np.int64, len(flat))
            begins = np.zeros(len(raw), bool)
            begins[np.cumsum(lengths) - lengths] = True
            begins[1:] |= self.never[raw[:-1], raw[1:]]
            ids, place = self.table.merge(self.single[raw], np.cumsum(begins))
            ends = np.cumsum([sum(map(len, own)) for own in words])
            cuts = (np.searchsorted(place, ends) * 4).tolist()
            data = ids.astype("<u4").tobytes()
            packed = [data[s:e] for s, e in zip([0, *cuts], cuts)]
        return [
            np.array([self.special[f[1:]]], "<u4").tobytes() if f[:1] == MARK else p for f, p in zip(fragments, packed)
        ]

    @functools.cached_property
    def memo(self) -> Memo:
        return Memo(self.encode_fragments)

    def parts(self, text: bytes) -> list[bytes]:
        """Fragments of a text; strings of special tokens are fragments of their own, behind a mark."""
        if not any(t in text for t in self.special):
            return self.fragments(text)
        out: list[bytes] = []
        for i, piece in enumerate(self.special_text.split(text)):
            out += [MARK + piece] if i % 2 else self.fragments(piece)
        return out

    @functools.cached_property
    def special_text(self) -> re.Pattern:
        longest_first = sorted(self.special, key=len, reverse=True)
        return re.compile(b"(" + b"|".join(map(re.escape, longest_first)) + b")")

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, packed."""
        parts = [self.parts(t) for t in texts]
        table = self.memo.over(parts)
        return [b"".join(map(table.__getitem__, p)) for p in parts]

    def decode(self, packed: list[bytes]) -> list[str]:
        """The text of each packed list of ids; bytes that are no UTF-8 become U+FFFD."""
        tokens = self.tokens.__getitem__
        return [
            b"".join(map(tokens, np.frombuffer(p or b"", "<u4").tolist())).decode("utf-8", "replace") for p in packed
        ]


@functools.lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    """One vocabulary per worker process."""
    return ByteBpe(path)


def with_ids(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text, packed as little-endian unsigned 32-bit integers.

    They are what the library gives without added special tokens, truncation
    or padding. Null and empty texts have no ids. Rows and further columns stay
    as they are; a column named ``out`` is replaced.
    """
    return with_python_columns(
        docs, utf8(F.col(text)), [T.StructField(out, T.BinaryType())], lambda: lambda x: [load(path).encode(x)]
    )


def with_text(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of each packed list of ids, special tokens included; null ids give an empty text."""
    return with_python_columns(
        docs, F.col(ids), [T.StructField(out, T.StringType())], lambda: lambda x: [load(path).decode(x)]
    )


def n_ids(ids: str) -> Column:
    return (F.octet_length(F.col(ids)) / 4).cast("long")
