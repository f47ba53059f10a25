"""Byte BPE and piece counts: against the libraries, and the odd inputs."""

import random
import struct

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parley.llm import bpe, token_counts
from parley.llm.common import Memo
from parley.llm.ragged import PairTable

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  a", "a  ", "\n\n", "a\n\nB", "ab" * 3000, "a" * 5000, " " * 3000, "é" * 700, "=-" * 500, " \n" * 400,
    "<|endoftext|>", "x <|endoftext|>  y<|endoftext|>", "<s> </s>", "▁a ▁", "don't we'll I'm 'tis ''s", "\x00\x1c\x7f",
    "a b 　c\u0085  d  ", "日本語 テスト 😀🏽", "ﬁ２ İ ẞ", "1234567890 12,3.4", "word " * 4000,
]


def mixed(n, seed):
    rng = random.Random(seed)
    letters = [*"aabcdeest  \n\n\t'’.,!?0123ÉéßñА日 　 \u0085 ▁\x1c", "<|endoftext|>", "'s", " the", "ing", "   ", "--"]
    return ["".join(rng.choices(letters, k=rng.randint(0, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    return ODD + mixed(1500, 7)


def frame(spark, texts):
    rows = [(i, t, "x", 0) for i, t in enumerate(texts)] + [(None, "again", None, None)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int").repartition(4)


def test_ids_and_round_trip_equal_the_library(spark, texts):
    library = Tokenizer.from_file(BYTE)
    encoded = bpe.with_ids(frame(spark, texts), BYTE)
    rows = bpe.with_text(encoded, BYTE).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        ids = list(struct.unpack(f"<{len(r.ids) // 4}I", r.ids))
        expected = library.encode(r.text or "", add_special_tokens=False).ids
        assert ids == expected
        assert r.decoded == library.decode(expected, skip_special_tokens=False)


def test_counts_equal_the_library(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for r in token_counts.with_token_counts(frame(spark, texts), PIECE).collect():
        assert r.n_tokens == len(library.encode(r.text or ""))


def test_fragments_join_to_the_text_and_cut_only_where_no_token_reaches():
    vocabulary = bpe.load(BYTE)
    for text in mixed(300, 3):
        parts = vocabulary.fragments(text.encode())
        assert b"".join(parts) == text.encode()
        assert all(vocabulary.never[a[-1], b[0]] for a, b in zip(parts, parts[1:]))
    held = {t[k : k + 2] for t in vocabulary.tokens[:50256] for k in range(len(t) - 1)}
    assert not any(vocabulary.never[a, b] for a, b in held)


def test_merges_in_step_equal_merges_one_by_one():
    import numpy as np

    rng = random.Random(1)
    pairs, n = {}, 60
    for new in range(5, n):
        pairs.setdefault((rng.randrange(new), rng.randrange(new)), (rng.randrange(40), new))
    table = PairTable(pairs, n)
    words = [[rng.randrange(-1, 5) for _ in range(rng.randint(1, 30))] for _ in range(400)]
    flat = np.array([s for w in words for s in w])
    got, place = table.merge(flat, np.repeat(np.arange(len(words)), [len(w) for w in words]))
    expected = []
    for w in words:
        w = list(w)
        while True:
            known = [(pairs[p][0], i) for i, p in enumerate(zip(w, w[1:])) if p in pairs]
            if not known:
                break
            i = min(known)[1]
            w[i : i + 2] = [pairs[w[i], w[i + 1]][1]]
        expected += w
    assert got.tolist() == expected and (np.diff(place) > 0).all()


def test_memo_answers_beyond_its_size():
    memo = Memo(lambda new: [len(w) for w in new], entries=2)
    assert [memo.over([["a", "bb", "ccc"]])[w] for w in ("a", "bb", "ccc")] == [1, 2, 3]
    assert not memo.known and memo.over([["a"]])["a"] == 1 and memo.over([["a", "bb", "cc", "d"]])["a"] == 1


def test_empty_tables(spark):
    df = frame(spark, []).where("false")
    assert bpe.with_text(bpe.with_ids(df, BYTE), BYTE).count() == 0
    assert token_counts.with_token_counts(df, PIECE).count() == 0


def test_queries_equal_the_libraries_on_the_table(spark):
    from conftest import SF
    from parley.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    library, pieces = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = {r.doc_id: r for r in QUERIES["op2_bpe_round_trip"](spark, SF).collect()}
    sha = {r.doc_id: r.s for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.sha2("text", 256).alias("s")).collect()}
    counts = {r.doc_id: r for r in QUERIES["op3_token_counts"](spark, SF).collect()}
    assert got.keys() == docs.keys() == counts.keys()
    for i, text in docs.items():
        assert got[i].n_tokens == len(library.encode(text).ids) and got[i].decoded_sha256 == sha[i]
        n = len(pieces.encode(text))
        assert (counts[i].n_bytes, counts[i].n_tokens, counts[i].over_limit) == (len(text.encode()), n, n > 4096)
