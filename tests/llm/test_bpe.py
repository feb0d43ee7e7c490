from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from dossier.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(3)
    alphabet = ["a", "B", "'s", "'", "'ll", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "7", "42", "!", "?!", "é", "ß", "漢", "🙂", "​", "<|endoftext|>"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 900))) for _ in range(40)]
    return texts + ["", " " * 500, "\n" * 300, "x" * 700, "'" * 300, "'s" * 200, "word " * 200, " \n" * 200, "a" + " " * 300 + "b"]


@pytest.mark.parametrize("size,overlap", [(64, 24), (100, 40), (33, 32)])
def test_chunked_encoding_equals_whole(encoding, size, overlap):
    for t in odd_texts():
        assert bpe.encode_text(t, PATH, public_tokenizers.PATTERN, size, overlap) == encoding.encode_ordinary(t), repr(t)


def test_chunks_need_room():
    with pytest.raises(ValueError):
        bpe.chunks("abc", 100, 8)


def test_encode_and_decode(spark, docs_of, corpus, encoding):
    rows = corpus + [(200 + i, t) for i, t in enumerate(odd_texts())] + [(300, corpus[-4][1]), (300, corpus[-4][1]), (None, "null key " * 60)]
    coded = bpe.encode(docs_of(rows), PATH, public_tokenizers.PATTERN, size=200, overlap=64)
    assert coded.columns[:7] == docs_of([]).columns
    back = bpe.decode(coded, PATH, public_tokenizers.PATTERN).collect()
    assert len(back) == len(rows)
    for r in back:
        assert r["ids"] == encoding.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    digests = {(r["doc_id"], r["ids_sha256"], r["decoded_sha256"], r["n_tokens"]) for r in bpe.digests(coded, PATH, public_tokenizers.PATTERN).collect()}
    want = set()
    for i, t in rows:
        ids = encoding.encode_ordinary(t or "")
        want.add((i, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), len(ids)))
    assert digests == want


def test_long_runs_neither_crash_nor_differ(encoding):
    for t in (" " * 1_000_000, "\n" * 1_000_000, "a " + " " * 1_000_000 + "b", "x" * 200_000, " \n" * 300_000 + "end"):
        ids = bpe.encode_text(t, PATH, public_tokenizers.PATTERN)
        assert b"".join(encoding.decode_single_token_bytes(i) for i in ids) == t.encode()
    for run in (" ", "\n", " \n\u3000"):  # as the encoder itself, where it still copes
        t = "What a" + run * (40_000 // len(run)) + "!gap" + run * 100
        split = bpe._tokenizer(PATH, public_tokenizers.PATTERN)[2]
        assert bpe.encode_piece(t, encoding, split) == encoding.encode_ordinary(t) == bpe.encode_text(t, PATH, public_tokenizers.PATTERN)


def test_columns_with_clashing_names(spark, encoding):
    docs = spark.createDataFrame([(1, "some text", "x", 3, "y")], "doc_id long, text string, ids string, __bpe_key int, c0 string")
    row = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    assert row.columns == ["doc_id", "text", "__bpe_key", "c0", "ids"]
    assert tuple(row.first()) == (1, "some text", 3, "y", encoding.encode_ordinary("some text"))
    assert bytes(bpe.decode(row.withColumn("decoded", row["c0"]), PATH, public_tokenizers.PATTERN).first()["decoded"]) == b"some text"


def test_empty_table(docs_of):
    assert bpe.encode(docs_of([]), PATH, public_tokenizers.PATTERN).count() == 0
