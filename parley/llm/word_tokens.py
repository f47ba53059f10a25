"""Token ids as the ``tokenizers`` library gives them, one word at a time.

Words of usual letters, digits and marks are merged in step on ragged arrays;
the library sees the others.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

from parley.llm.common import Memo
from parley.llm.ragged import PairTable

# Fixed values of the supported vocabularies: their splitter, their word end, their marks of special tokens.
SPLITTER = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
WORD_END = "</w>"
SPECIAL = b"<|"
# Printable ASCII, its white space, and the letters of Latin-1, Latin Extended-A and Cyrillic that lower-case to one
# letter each: composition leaves such texts as they are, and the splitter's classes are plain ranges.
USUAL = re.compile("[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u0400-\u045f]*")
PARTS = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f\u0430-\u045f]+|[0-9]|"
    "[^\\sa-z0-9\u00df-\u00f6\u00f8-\u017f\u0430-\u045f]+"
)


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class PartMerger:
    """Ids of the splitter's parts by the vocabulary's merges; a part's last byte carries the word end."""

    def __init__(self, model: dict):
        ids, letters = model["vocab"], byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.last = np.array([ids[c + WORD_END] for c in letters], np.int64)
        pairs = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(model["merges"])}
        self.table = PairTable(pairs, max(ids.values()) + 1)

    def encode(self, parts: list[str]) -> list[bytes]:
        parts = [p.encode() for p in parts]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        codes = np.frombuffer(b"".join(parts), np.uint8)
        symbol, part = self.inner[codes], np.repeat(np.arange(len(parts)), sizes)
        ends = np.cumsum(sizes) - 1
        symbol[ends] = self.last[codes[ends]]
        symbol, place = self.table.merge(symbol, part)
        to = 4 * np.cumsum(np.bincount(part[place], minlength=len(parts)))
        ids = symbol.astype("<u4").tobytes()
        return [ids[a:b] for a, b in zip([0, *to[:-1].tolist()], to.tolist())]


class WordTokenizer:
    """A vocabulary that drops white space, so that a text's ids are its words' ids in a row.

    Words are what ASCII white space parts; the library sees each new word
    once. This holds for vocabularies whose normalizer and splitter look at
    nothing beyond white space, which is checked on loading.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        splits = [p for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"]
        drops = [p for p in splits if p["behavior"] == "Removed" and p["invert"] and "[^\\s" in p["pattern"]["Regex"]]
        strips = any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        if not drops or strips or any(re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
            raise ValueError(f"{path} does not treat words one by one")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merger = PartMerger(spec["model"]) if self._mergeable(spec, drops[0]) else None

    @staticmethod
    def _mergeable(spec: dict, split: dict) -> bool:
        """Whether the file's steps are those that ``PARTS`` and ``PartMerger`` carry out."""
        model, kinds = spec["model"], [n["type"] for n in spec["normalizer"]["normalizers"]]
        return (
            kinds == ["NFC", "Replace", "Lowercase"]
            and split["pattern"]["Regex"] == SPLITTER
            and model["end_of_word_suffix"] == WORD_END
            and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix"))
            and all(SPECIAL.decode() in t["content"] for t in spec["added_tokens"])
        )

    @functools.cached_property
    def memo(self) -> Memo:
        return Memo(self.encode_words)

    @functools.cached_property
    def parts(self) -> Memo:
        return Memo(self.merger.encode)

    def split(self, text: bytes) -> list[str] | None:
        """A usual text's parts, lower-cased; None if the library has to see the text."""
        if self.merger is None or SPECIAL in text:
            return None
        text = text.decode()
        return PARTS.findall(text.lower()) if USUAL.fullmatch(text) else None

    def encode_others(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        return self.encode_each(words, self.encode_others)

    def encode_each(self, texts: list[bytes], others) -> list[bytes]:
        """The ids of each text: usual ones by their parts, the rest by ``others``."""
        split = [self.split(t) for t in texts]
        known = self.parts.over([p for p in split if p is not None]) if self.merger else {}
        rest = iter(others([t for t, p in zip(texts, split) if p is None]))
        return [next(rest) if p is None else b"".join(map(known.__getitem__, p)) for p in split]

    def encode_by_words(self, texts: list[bytes]) -> list[bytes]:
        parts = [t.split() for t in texts]
        table = self.memo.over(parts)
        return [b"".join(map(table.__getitem__, p)) for p in parts]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return self.encode_each(texts, self.encode_by_words)


@functools.lru_cache(maxsize=4)
def load(path: str) -> WordTokenizer:
    """One vocabulary per worker process."""
    return WordTokenizer(path)
