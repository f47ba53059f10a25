"""Syncmer fingerprints: against plain code, and the odd inputs."""

import random

import numpy as np
import pytest

from parley.llm import fingerprints
from parley.llm.fingerprints import K, S, anchors, likeness, mixed, neighbours, syncmers, unpack


def plain_places(text):
    inner = [int(mixed(np.frombuffer(text[i : i + S], "<u8"))[0]) for i in range(len(text) - S + 1)]
    w = K - S + 1
    return [i for i in range(len(text) - K + 1) if min(inner[i : i + w]) in (inner[i], inner[i + w - 1])]


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdéß", k=rng.randint(2, 9))) for _ in range(n))


@pytest.mark.parametrize("text", [words(200, 1).encode(), b"a" * 300, b"ab" * 100, words(20, 2).encode()[:K], b"xy " * 40])
def test_syncmers_are_those_with_the_least_at_an_edge(text):
    at, _ = syncmers(np.frombuffer(text, np.uint8))
    assert at.tolist() == plain_places(text)
    assert (np.diff(at) <= K - S).all()


def test_blocks_do_not_change_the_anchors(monkeypatch):
    text = words(500, 3).encode()
    whole = anchors(text)
    monkeypatch.setattr(fingerprints, "BLOCK", 64)
    assert np.array_equal(anchors(text), whole)


def test_anchors_depend_on_nothing_around_them():
    body = words(100, 4).encode()
    inside = set((anchors(body) >> 8).tolist())
    around = set((anchors(words(30, 5).encode() + body + words(30, 6).encode()) >> 8).tolist())
    assert inside <= around


def test_likeness():
    a, b = words(300, 7).encode(), words(300, 8).encode()
    assert likeness(anchors(a), anchors(a)) == 1.0 and likeness(anchors(a), anchors(b)) == 0.0
    moved = b"new words at the start " + a
    assert likeness(anchors(a), anchors(moved)) > 0.9
    half = a[: len(a) // 2] + b[len(b) // 2 :]
    assert 0.2 < likeness(anchors(a), anchors(half)) < 0.5
    none = anchors(b"")
    assert likeness(none, none) == 1.0 and likeness(none, anchors(a)) == 0.0
    assert likeness(anchors(b"short"), anchors(b"short")) == 1.0 and likeness(anchors(b"short"), anchors(b"other")) == 0.0


def test_texts_of_one_to_two_kmers_have_anchors_of_their_own():
    """Some of these hold no syncmer; they are neither empty nor alike, and near copies still meet."""
    bodies = [(n, words(40, 1000 + 50 * n + i).encode()) for n in range(K, 2 * K - S + 2) for i in range(6)]
    texts = [body[:n] for n, body in bodies]
    bare = [t for t in texts if not len(syncmers(np.frombuffer(t, np.uint8))[0])]
    assert len(bare) > 50 and max(map(len, bare)) < 2 * K - S - 1
    made = [anchors(t) for t in texts]
    assert all(len(a) for a in made) and len({a.tobytes() for a in made}) == len(texts)
    for t, a, b in zip(texts, made, made[1:]):
        at, hashes = syncmers(np.frombuffer(t, np.uint8))
        assert likeness(a, a) == 1.0 and likeness(a, b) == 0.0 and likeness(a, anchors(b"")) == 0.0
        assert set(hashes.tolist()) <= set((a >> 8).tolist()) and len(a) <= len(at) + 1
    near = [likeness(anchors(body[:n]), anchors(body[: n + 3])) for n, body in bodies if K + 10 <= n < 2 * K - S - 5]
    assert sum(x > 0 for x in near) > 0.85 * len(near)


def plain(rows):
    """Expected (id, n, edited) in order, each with its next document's text."""
    import hashlib

    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()), reverse=True)
    out = []
    for i, (d, t) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        out.append((d, len(t), t[: len(t) - half] + following[:half], t, following))
    return out


def checked(got, rows):
    expected = plain(rows)
    assert sorted((str(r.doc_id), r.n_chars, r.edited) for r in got) == sorted((str(e[0]), e[1], e[2]) for e in expected)
    for r, e in zip(sorted(got, key=lambda r: (str(r.doc_id), r.edited)), sorted(expected, key=lambda e: (str(e[0]), e[2]))):
        own, other, following = anchors(e[3].encode()), anchors(e[2].encode()), anchors(e[4].encode())
        assert np.array_equal(unpack(r.fingerprint), own) and np.array_equal(unpack(r.edited_fingerprint), other)
        assert (r.near_edited, r.near_next) == (likeness(own, other), likeness(own, following))


@pytest.mark.parametrize("size", [1 << 24, 2000])
def test_neighbours_equal_plain_code(spark, monkeypatch, size):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", size)
    rng = random.Random(11)
    texts = [words(rng.randint(0, 40), i) for i in range(120)]
    rows = list(zip(rng.sample(range(-500, 10**6), 120), texts))
    rows += [(2_000_000, None), (2_000_001, ""), (-1000, "日本語😀" * 500), (None, "no id"), (None, "nor this"), (7, "x"), (7, "x"), (7, "y" * 9)]
    df = spark.createDataFrame([(*r, "t", True) for r in rows], "doc_id long, text string, digest string, guest boolean")
    checked(neighbours(df.repartition(5)).collect(), rows)


def test_single_and_empty(spark):
    schema = "doc_id long, text string"
    assert neighbours(spark.createDataFrame([], schema)).count() == 0
    checked(neighbours(spark.createDataFrame([(1, "abcdef")], schema)).collect(), [(1, "abcdef")])


def test_query_on_the_table(spark):
    import hashlib

    from conftest import SF
    from parley.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in QUERIES["op9_syncmer_fingerprints"](spark, SF).collect()}
    for d, n, edited, own, following in plain(rows):
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_next == likeness(anchors(own.encode()), anchors(following.encode()))
