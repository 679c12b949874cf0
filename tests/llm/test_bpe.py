"""Encoding and decoding against the tokenizers library."""

import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.Vocabulary(open(PATH, encoding="utf-8").read())


def awkward():
    rng = random.Random(6)
    texts = ["", " ", "  \n\n x", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "don't DON'T", "\x1c\x85\u2028 \ufeff"]
    texts += ["a" * 5000, "漢字" * 800, "é😀\u0300" * 50, "x1y2 " * 30000, "\x00\x01", "".join(rng.choice("abcdeé漢 ") for _ in range(3000))]
    return texts


def same(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


def test_awkward_texts():
    for text in awkward():
        same(text)


def test_every_character_splits_alike():
    split = LIBRARY.pre_tokenizer.pre_tokenize_str
    for code in [*range(0xD800), *range(0xE000, 0x110000)]:
        text = f"a{chr(code)}1{chr(code)}! {chr(code)} "
        assert OWN.words(text) == [text[a:b] for _, (a, b) in split(text)], hex(code)


def test_scan_and_heap_agree():
    rng = random.Random(8)
    for _ in range(300):
        raw = "".join(rng.choice("abcdetinghé ") for _ in range(rng.randrange(1, 300))).encode()
        assert OWN._scan(raw) == OWN._heap(raw)


def test_ids_that_are_none():
    assert OWN.decode([None, -1, 10**6, OWN.byte_ids[65], OWN.byte_ids[0xFF]]) == "A\ufffd"


def test_tables(spark):
    rows = [(k, text) for k, text in enumerate([*awkward(), None])] + [(None, "x"), (0, "again"), (0, "again")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"ids": F.lit("clash"), "_text": F.lit(1)})
    encoded = bpe.encode(frame, PATH)
    expected = [(k, LIBRARY.encode(text or "", add_special_tokens=False).ids) for k, text in rows]
    assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=str) == sorted(expected, key=str)
    decoded = bpe.decode(encoded, PATH).collect()
    assert sorted(map(tuple, decoded), key=str) == sorted(((k, text or "") for k, text in rows), key=str)
    assert bpe.decode(bpe.encode(frame.limit(0), PATH), PATH).collect() == []


def test_one_pass_equals_two(spark):
    rows = [(k, t) for k, t in enumerate([*awkward(), None])] + [(0, "again"), (None, "no id")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"ids": F.lit(1), "decoded": F.lit("clash")})
    both = bpe.decode(bpe.encode(frame, PATH, carry=["doc_id", "text"]).withColumnRenamed("text", "given"), PATH, carry=["doc_id", "given", "ids"])
    found = bpe.round_trip(frame, PATH, carry=["doc_id", "text"])
    assert sorted(map(repr, map(tuple, found.select("doc_id", "text", "ids", "decoded").collect()))) == sorted(map(repr, map(tuple, both.collect())))
    assert bpe.round_trip(frame.limit(0), PATH).collect() == []
