"""Fill-in-the-middle texts against plain slicing, and their texts again."""

import random
import re
from hashlib import sha256

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import fill_in_middle as fim
from tidemark.llm import queries

SCHEMA = "doc_id bigint, text string, form string, n bigint, output string, _text string, _id bigint"


def plain(doc_id, text, rate=100, spm=50):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexes = sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexes[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(part) for part in (lines[:a], lines[a:b], lines[b:]))
    form = "spm" if h[3] % 100 < spm else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(lines), form, len(prefix), len(middle), output


def digest(text):
    return sha256(text.encode()).hexdigest()


@given(st.integers(0, 10**6), st.text(st.sampled_from("ab\n\r<P>SMé😀 "), max_size=60))
def test_one_text(doc_id, text):
    lines, form, prefix, middle, output = fim.transformed(text.encode(), doc_id)
    assert (lines, form, prefix, middle, output.decode()) == plain(doc_id, text)
    assert fim.restored(bytes(output), form).decode() == text


@given(st.binary(max_size=40), st.binary(max_size=40), st.integers(1, 9))
def test_rotation(left, right, swapped):
    before, fim.SWAPPED = fim.SWAPPED, swapped
    try:
        buffer = bytearray(b"#" + left + right + b"#")
        fim.rotate(buffer, 1, 1 + len(left), 1 + len(left) + len(right))
    finally:
        fim.SWAPPED = before
    assert buffer == b"#" + right + left + b"#"


def awkward():
    rng = random.Random(2)
    texts = [None, "", "\n", "\n\n", "a", "a\n", "é😀\nb", "<P>", "a<M>b\n", "<P<S", "line\r\n" * 40, "x" * 200_000, "y\n" * 150_000]
    texts += ["".join(rng.choice("ab\n é<") for _ in range(rng.randrange(80))) for _ in range(150)]
    return [*enumerate(texts), (3, "a"), (None, "a\nb\nc"), (None, "a\nb\nc")]


def test_query_equals_plain(spark, tmp_path):
    rows = awkward()
    frame = spark.createDataFrame([(i, t, "clash", 0, "clash", "clash", 5) for i, t in rows], SCHEMA)
    frame.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    expected = []
    for i, text in rows:
        *facts, output = plain(i, text or "")
        expected.append((i, *facts, digest(output), digest(text or "")))
    found = map(tuple, queries.op13_fill_in_middle(spark, str(tmp_path)).collect())
    assert sorted(found, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("rate,spm", [(0, 50), (30, 0), (70, 100)])
def test_shares(spark, rate, spm):
    rows = [(k, f"{k}\nb\nc") for k in range(300)]
    made = fim.transform(spark.createDataFrame(rows, "doc_id bigint, text string"), rate=rate, spm=spm)
    assert {tuple(r) for r in made.collect()} == {(k, *plain(k, t, rate, spm)) for k, t in rows}
    texts = fim.restore(made)
    assert {tuple(r) for r in texts.collect()} == set(rows)


def test_empty_table(spark):
    made = fim.transform(spark.createDataFrame([], SCHEMA))
    assert made.collect() == [] and fim.restore(made.withColumn("x", F.lit(1))).collect() == []
