"""License notices: exact phrases, and short notices with a few errors."""

from __future__ import annotations

import bisect
import functools
import heapq
import re

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import utf8, with_python_columns

# Phrases that stand for a license wherever their words follow each other.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Short notices, found with up to a tenth of their characters in error.
NOTICES = {
    "under the mit license": "mit",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "creative commons attribution sharealike": "cc-by-sa",
    "under the gnu general public license version 2": "gpl-2",
    "under the gnu general public license version 3": "gpl-3",
    "under the gnu lesser general public license": "lgpl",
    "under the gnu affero general public license": "agpl-3",
    "mozilla public license version 2 0": "mpl-2",
    "eclipse public license version 2 0": "epl-2",
    "redistribution and use in source and binary forms": "bsd",
    "released into the public domain": "public-domain",
}
# Bytes that belong to words once A-Z is lower case; all others part them.
WORD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
SPAN = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("end_word", T.LongType()),
        T.StructField("edits", T.IntegerType()),
        T.StructField("similarity", T.DoubleType()),
        T.StructField("exact_phrase", T.BooleanType()),
    ]
)


class Notice:
    """A notice, the errors it may have, and seeds of which an occurrence holds at least one unchanged.

    k errors leave one of k + 1 parts of the notice as it is (pigeonhole), so
    a text without any of the parts cannot hold the notice.
    """

    def __init__(self, text: str, label: str, share: float):
        self.label, self.size = label, len(text)
        self.edits = int(len(text) * share)
        bounds = [len(text) * i // (self.edits + 1) for i in range(self.edits + 2)]
        self.parts = [text[s:e] for s, e in zip(bounds, bounds[1:])]
        self.offsets = bounds[:-1]
        self.seeds = [(s, p.encode()) for s, p in zip(bounds, self.parts)]
        self.pattern = regex.compile(f"(?b)(?:{regex.escape(text, special_only=True)}){{e<={self.edits}}}")

    def find(self, line: bytes) -> list[tuple[int, int, int]]:
        """(begin, end, errors) of each occurrence in ``line``, without blanks at its ends."""
        starts = []
        for offset, seed in self.seeds:
            at = line.find(seed)
            while at >= 0:
                starts.append(at - offset)
                at = line.find(seed, at + 1)
        windows: list[list[int]] = []
        for at in sorted(starts):
            # Errors before the seed move it by that many characters of up to four bytes.
            slack = 4 * self.edits + 1
            lo, hi = max(0, at - slack), min(len(line), at + self.size + slack)
            if windows and lo <= windows[-1][1]:
                windows[-1][1] = max(windows[-1][1], hi)
            else:
                windows.append([lo, hi])
        out = []
        for lo, hi in windows:
            while lo and line[lo] & 0xC0 == 0x80:
                lo -= 1
            while hi < len(line) and line[hi] & 0xC0 == 0x80:
                hi += 1
            part, seen, at = line[lo:hi].decode(), 0, lo
            for start, end, errors in self.matches(part):
                at += len(part[seen:start].encode())
                found = part[start:end].encode()
                seen = end
                out.append((at + len(found) - len(found.lstrip()), at + len(found.rstrip()), errors))
                at += len(found)
        return out

    def matches(self, part: str) -> list[tuple[int, int, int]]:
        """(begin, end, errors) by place: the best match, then the best beside it, and so on, as weaker ones may stand before it.

        Stretches of a few notice lengths that overlap by one are searched on
        their own, and again only where a match found since cuts them, so the
        work grows with the length of ``part``.
        """
        slack, step = 4 * self.edits + 1, 4 * self.size
        starts = {m.start() - offset for offset, seed in zip(self.offsets, self.parts) for m in re.finditer(re.escape(seed), part)}
        best: list[tuple] = []

        def search(lo: int, hi: int) -> None:
            if hi - lo < self.size - self.edits or all(part.find(p, lo, hi) < 0 for p in self.parts):
                return
            m = self.pattern.search(part, lo, hi)
            if m:
                heapq.heappush(best, (sum(m.fuzzy_counts), m.start(), m.end(), lo, hi))

        lo, hi = 0, 0
        for at in sorted(starts):
            if at >= lo + slack + step or not hi:
                if hi:
                    search(lo, hi)
                lo = max(0, at - slack)
            hi = min(len(part), at + self.size + slack)
        search(lo, hi)
        taken: list[tuple[int, int, int]] = []
        while best:
            errors, start, end, lo, hi = heapq.heappop(best)
            i = bisect.bisect_right(taken, (start, len(part), 0))
            over = [t for t in taken[max(0, i - 1) : i + 1] if t[0] < end and start < t[1]]
            if not over:
                taken.insert(i, (start, end, errors))
                over = [taken[i]]
            search(lo, min(hi, over[0][0]))
            search(max(lo, over[0][1]), hi)
        return taken


class Scanner:
    def __init__(self, phrases: dict[str, str], notices: dict[str, str], share: float):
        self.phrases = [(f" {p} ".encode(), label, len(p.split())) for p, label in phrases.items()]
        self.notices = [Notice(t, label, share) for t, label in notices.items()]

    def scan(self, text: bytes) -> tuple[int, list[tuple]]:
        """The number of words, and spans sorted by place."""
        words = text.lower().translate(WORD).split()
        line = b" " + b" ".join(words) + b" "
        spans, blanks = [], None
        for phrase, label, size in self.phrases:
            at = line.find(phrase)
            while at >= 0:
                blanks = places(line) if blanks is None else blanks
                first = int(np.searchsorted(blanks, at))
                spans.append((label, first, first + size, 0, 1.0, True))
                at = line.find(phrase, at + 1)
        for notice in self.notices:
            for begin, end, errors in notice.find(line):
                blanks = places(line) if blanks is None else blanks
                # Blank number i stands before word i.
                first, end_word = (int(np.searchsorted(blanks, x)) for x in (begin, end))
                spans.append((notice.label, first - 1, end_word, errors, 1 - errors / notice.size, False))
        return len(words), closest(spans)


def places(line: bytes) -> np.ndarray:
    return np.flatnonzero(np.frombuffer(line, np.uint8) == 32)


def closest(spans: list[tuple]) -> list[tuple]:
    """Spans by place, without near ones that overlap a closer one of another label."""
    spans = sorted(spans, key=lambda s: (s[1], s[2], s[0], not s[5]))
    widest = max((s[2] - s[1] for s in spans), default=0)
    out = []
    for i, s in enumerate(spans):
        beaten, j = False, i
        while j > 0 and spans[j - 1][1] > s[1] - widest:
            j -= 1
        while not s[5] and not beaten and j < len(spans) and spans[j][1] < s[2]:
            o = spans[j]
            beaten = o[0] != s[0] and o[2] > s[1] and (o[4], o[2] - o[1], s[0]) > (s[4], s[2] - s[1], o[0])
            j += 1
        if not beaten:
            out.append(s)
    return out


@functools.lru_cache(maxsize=4)
def scanner(phrases: tuple, notices: tuple, share: float) -> Scanner:
    return Scanner(dict(phrases), dict(notices), share)


def with_licenses(
    docs: DataFrame,
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    share: float = 0.1,
) -> DataFrame:
    """``docs`` with n_words and license_spans, for whole texts.

    A span has its label, the words from first_word up to end_word, the
    characters in error and the similarity (1 less the share of errors), and
    whether it is an exact phrase. Words are runs of digits, letters a-z (A-Z
    lower-cased) and characters above ASCII; phrases and notices are compared
    with the words joined by blanks, so punctuation and line ends do not
    count. ``share`` of a notice's characters may be inserted, lost or
    replaced. Null and empty texts have no words and no spans; columns of these names are replaced.
    """
    key = tuple(phrases.items()), tuple(notices.items()), share

    def make():
        find = scanner(*key)

        def run(texts):
            found = [find.scan(t) for t in texts]
            return [[n for n, _ in found], [s for _, s in found]]

        return run

    fields = [T.StructField("n_words", T.LongType()), T.StructField("license_spans", T.ArrayType(SPAN))]
    return with_python_columns(docs, utf8(F.col(text)), fields, make)


def label_columns(spans: str = "license_spans") -> dict:
    """Columns that sum up a document's spans."""
    base = F.filter(spans, lambda s: s["exact_phrase"])
    starts = F.transform(base, lambda s: s["first_word"])
    labels = lambda x: F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda s: s["label"]))), ",")
    return {
        "n_base": F.size(base).cast("long"),
        "first_word": F.array_min(starts),
        "last_word": F.array_max(starts),
        "base_labels": labels(base),
        "labels": labels(F.col(spans)),
        "score": F.coalesce(F.array_max(F.transform(spans, lambda s: s["similarity"])), F.lit(0.0)),
    }
