"""Groups of equal texts against a dictionary."""

import hashlib
import random

from pyspark.sql import functions as F

from tidemark.llm import exact_dedup

SCHEMA = "doc_id bigint, text string"


def awkward():
    rng = random.Random(7)
    bases = ["", "a", "é" * 40, "x" * 64, "x" * 65, "x" * 256, "x" * 320, "x" * 321, "long " * 30000]
    rows = [(k, rng.choice(bases) + rng.choice(["", "", "y", "\x00", "é"])) for k in range(400)]
    rows += [(1000 + k, "copy of one text, long enough for the second digit " * 9) for k in range(300)]
    return rows + [(2000, None), (None, None), (None, "a"), (None, "only null ids"), (None, "only null ids"), (2001, "r"), (2001, "r")]


def test_equals_dictionary(spark):
    groups = {}
    for doc_id, text in awkward():
        groups.setdefault(text or "", []).append(doc_id)
    expected = []
    for text, ids in groups.items():
        largest = max((i for i in ids if i is not None), default=None)
        digest, kept = hashlib.sha256(text.encode()).hexdigest(), False
        for doc_id in ids:
            stays = doc_id == largest and not kept  # one of the rows that have the largest id
            kept = kept or stays
            expected.append((doc_id, largest, len(ids), stays, digest))
    frame = spark.createDataFrame(awkward(), SCHEMA).withColumns({"kept": F.lit(3), "_group": F.lit(1), "_rest": F.lit(2)})
    result = exact_dedup.exact_groups(frame, {"sha": F.sha2(F.coalesce("text", F.lit("")), 256)})
    assert sorted(map(tuple, result.collect()), key=str) == sorted(expected, key=str)


def test_narrow_digits_give_the_same(spark):
    frame = spark.createDataFrame(awkward()[:200], SCHEMA)
    narrow, wide = (exact_dedup.exact_groups(frame, first_digit=n).collect() for n in (1, 10**6))
    assert sorted(narrow, key=str) == sorted(wide, key=str)


def test_empty_table(spark):
    assert exact_dedup.exact_groups(spark.createDataFrame([], SCHEMA)).collect() == []
