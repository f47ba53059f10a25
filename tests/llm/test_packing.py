"""Packing: every id in its place, sequences full, and the odd inputs."""

import random
import struct
from itertools import combinations

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parley.llm.packing import fullest, pack, pack_documents, plan_bins, sequences, slots, with_pieces
from parley.llm.word_tokens import load

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_fullest_equals_all_combinations():
    rng = random.Random(2)
    for _ in range(200):
        lengths = sorted({rng.randint(1, 25) for _ in range(rng.randint(1, 6))}, reverse=True)
        counts = [rng.randint(1, 3) for _ in lengths]
        room = rng.randint(0, 60)
        flat = [n for n, c in zip(lengths, counts) for _ in range(c)]
        best = max(sum(c) for k in range(len(flat) + 1) for c in combinations(flat, k) if sum(c) <= room)
        used = fullest(room, lengths, counts)
        assert sum(n * k for n, k in used.items()) == best
        assert all(k <= counts[lengths.index(n)] for n, k in used.items())


def test_plan_uses_every_length_once_and_few_bins():
    rng = random.Random(4)
    histogram = {rng.randint(1, 4096): rng.choice([1, 2, 5, 100_000, 10**9]) for _ in range(900)}
    bins = plan_bins(histogram)
    used = {}
    for parts, times in bins:
        assert sum(n * k for n, k in parts.items()) <= 4096
        for n, k in parts.items():
            used[n] = used.get(n, 0) + k * times
    assert used == histogram
    total = sum(n * c for n, c in histogram.items())
    large = sum(c for n, c in histogram.items() if n > 2048)
    assert sum(t for _, t in bins) <= 1.05 * max(-(-total // 4096), large) + 1
    assert sum(r[2] for r in slots(bins)) == sum(histogram.values())
    assert plan_bins({}) == []


TEXTS = [None, "", " ", "a", "a", "The  QUICK brown\nfox!", "x <|endoftext|> y", "it's Ünïcode 　\x1c ΣΑΣ 12 é", "word " * 9000, "a" * 3000]


def checked(rows, texts):
    """Rows of pieces with ids against the library; sequences without gaps."""
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for i, text in texts.items():
        expected = library.encode(text or "", add_special_tokens=False).ids + [1]
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(expected) // 4096)))
        for r in pieces:
            own = expected[r.start : r.start + r.length]
            assert list(struct.unpack(f"<{r.length}I", r.ids)) == own and len(own) == min(4096, len(expected) - 4096 * r.piece)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    return len(by_sequence)


def test_pieces_and_places(spark):
    texts = dict(enumerate(TEXTS * 20))
    df = spark.createDataFrame([(i, t, 5, "z") for i, t in texts.items()], "doc_id long, text string, offset int, shard string")
    packed = pack_documents(df.repartition(7), PATH)
    rows = packed.collect()
    n = checked(rows, texts)
    total = sum(r.length for r in rows)
    assert n <= -(-total // 4096) + 1
    whole = sequences(packed).collect()
    assert sum(len(r.ids) for r in whole) == 4 * total and len(whole) == n


def test_empty_table_and_repeated_ids(spark):
    schema = "doc_id long, text string"
    assert pack_documents(spark.createDataFrame([], schema), PATH).count() == 0
    same = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b"), (1, "a b")], schema)
    rows = pack_documents(same, PATH).collect()
    assert sorted(r.offset for r in rows) == [0, 3, 6, 9] and len({r.sequence_id for r in rows}) == 1


def test_words_one_by_one_equal_the_library():
    library = Tokenizer.from_file(PATH)
    rng = random.Random(9)
    letters = [*"aAbéÉßΣİ1 2 \t\n\x0b'’.,!́ 　\u0085\x1c😀日", "<|endoftext|>", "'s ", "<|startoftext|>", " '"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(3000)]
    got = load(PATH).encode([t.encode() for t in texts])
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [list(struct.unpack(f"<{len(g) // 4}I", g)) for g in got] == expected


def test_query_on_the_table(spark):
    from conftest import SF
    from parley.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pack(with_pieces(docs, PATH).cache()).collect()
    n = checked(rows, texts)
    got = QUERIES["op5_best_fit_packing"](spark, SF)
    total, largest = got.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert largest == n and n <= total // 4096 + 2
    import zlib

    crc = {(r.doc_id, r.piece): (r.start, r.length, zlib.crc32(r.ids)) for r in rows}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.collect()} == crc
