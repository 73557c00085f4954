"""Packing: exact round trip of ids, cuts and sequence lengths."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tierwise.llm import packing

TEXTS = [
    "Hello world. It's a test\nof lines\n\n and  spaces \t tabs ",
    None,
    "",
    " ",
    "one\ntwo three's 12 34,56 <|endoftext|> x y \u0085z",
    "word " * 9000 + "end",
    "a" * 4000,
    "Éréier enquêeau de, les\nla vioi menteux ‑ naïve 東京 😀 ok",
    "x " * 2047,
    "dup text here", "dup text here",
] + [f"doc number {i} has " + "some words " * (i * 7 % 300) for i in range(120)]


@pytest.fixture(scope="module")
def packed(spark):
    rows = [(i, t, "extra") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(2)
    return packing.pack(docs, packing.tokenizer_file()).collect()


@pytest.fixture(scope="module")
def ids():
    t = Tokenizer.from_file(packing.tokenizer_file())
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], dtype="<u4") for x in TEXTS]


def test_each_id_lies_in_exactly_one_piece(packed, ids):
    pieces = defaultdict(list)
    for r in packed:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(range(len(TEXTS)))
    for doc, rows in pieces.items():
        at = 0
        for r in sorted(rows, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[doc])
            assert r["ids_crc32"] == zlib.crc32(ids[doc][at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids[doc])


def test_sequences_are_gapless_and_need_no_padding(packed):
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["sequence_length"]))
    for rows in sequences.values():
        at = 0
        for offset, length, _ in sorted(rows):
            assert offset == at
            at += length
        assert at == rows[0][2] and at <= 2048 and at & (at - 1) == 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs, packing.tokenizer_file()).count() == 0


def test_cache_limit_does_not_change_ids(ids):
    e = packing.Encoder(packing.tokenizer_file(), limit=3)
    for t, want in zip(TEXTS, ids):
        assert e(t or "") == want[:-1].tobytes()


@pytest.mark.parametrize(
    "text",
    [
        "plain words, and stops. Here! (there) it's 3 o'clock...",
        "line one\nline two.\nÉté naïf ŵ ɐɐ Ω!? don't.'s a.b, x..",
        "a <|endoftext|> b",
        "tab\there  two spaces \n\n end ",
        "\nleading",
        "trailing\n",
        "日本語 テキスト。 ١٢٣, ab1. _x_ ſt ŉ. K Å.",
    ],
)
def test_ids_are_the_plain_tokenizer_call(text):
    from tokenizers import Tokenizer

    from tierwise.llm.packing import Encoder, tokenizer_file

    plain = Tokenizer.from_file(tokenizer_file()).encode(text, add_special_tokens=False).ids
    encode = Encoder(tokenizer_file(), limit=3)
    got = encode(text)
    assert [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == plain
    assert encode(text) == got


def test_ids_of_whole_documents(spark):
    from tokenizers import Tokenizer

    from tierwise.llm.packing import Encoder, tokenizer_file

    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    plain, encode = Tokenizer.from_file(tokenizer_file()), Encoder(tokenizer_file())
    for text in texts:
        ids = plain.encode(text, add_special_tokens=False).ids
        assert encode(text) == b"".join(i.to_bytes(4, "little") for i in ids)
