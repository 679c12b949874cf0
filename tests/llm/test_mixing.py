"""The mix against a plain computation, with null, empty, tied and repeated rows."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing

SCHEMA = "doc_id bigint, text string, source string"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def half_up(number):
    return math.floor(number + 0.5)


def plain(rows):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, open_ = {}, set(order)
    rest = 1.5 * sum(sizes.values())
    while open_:  # the excess above the stops goes to the others, again and again
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * sizes[s]}
        target |= {s: 2.0 * sizes[s] for s in full} or share
        if not full:
            break
        rest -= sum(2.0 * sizes[s] for s in full)
        open_ -= full
    result, before = [], {}

    def place(row):
        key = hashlib.md5(f"{mixing.SEED}{'' if row[0] is None else f':{row[0]}'}".encode()).hexdigest()
        return key, row[0] is not None, row[0] or 0, words(row[1])

    for doc_id, text, source in sorted(rows, key=place):
        size, goal, all_of = words(text), half_up(target[source]), sizes[source]
        epochs = goal // all_of if all_of else 0
        at = before.get(source, 0)
        before[source] = at + size
        taken = epochs * size + max(0, min(size, goal - epochs * all_of - at))
        result.append((doc_id, size, all_of, round(target[source], 6), taken))
    return sorted(result, key=str)


def awkward():
    rng = random.Random(3)
    rows = [(k, "w x " * rng.randrange(40) + "\n", f"s{rng.randrange(9)}") for k in range(300)]
    rows += [(k, "one two three", "hot") for k in range(300, 500)] + [(k, None, "empty") for k in range(500, 505)]
    rows += [(600, "a b c", None), (600, "a b c", None), (600, "a b c", None), (None, "x y", None), (None, None, "é")]
    rows += [(601, "word " * 20000, "long"), (602, "\x0b\x0c \t\r\n", "blank"), (603, "é ü 漢字", "é"), (604, "z", "Z")]
    return rows


def test_equals_plain_computation(spark):
    frame = spark.createDataFrame(awkward(), SCHEMA).withColumns({"size": F.lit("clash"), "_key": F.lit(0), "target": F.lit(1)})
    result = sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mixing.mix(frame).collect()), key=str)
    assert result == plain(awkward())


def test_targets_are_met_exactly(spark):
    frame = spark.createDataFrame([row for row in awkward() if row[2]], SCHEMA)
    mixed = mixing.mix(frame, carry={"source": F.col("source")})
    for row in mixed.groupBy("source", "target").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size")).collect():
        assert row.taken == half_up(row.target)
    assert mixed.filter("taken > 2 * size").count() == 0


def test_reruns_agree(spark):
    frame = spark.createDataFrame(awkward(), SCHEMA)
    first, second = (sorted(mixing.mix(f).collect(), key=str) for f in (frame, frame.repartition(5).orderBy(F.rand())))
    assert first == second


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("taken, parts", [(7, ["a b\tc", "a b\tc", "a"]), (6, ["a b\tc"] * 2), (2, ["a b"]), (0, [])])
def test_documents_are_cut_at_words(spark, taken, parts):
    frame = spark.createDataFrame([(1, "a b\tc")], "doc_id bigint, text string")
    result = mixing.taken_documents(frame, F.lit(taken), F.lit(3))
    assert sorted(row.text for row in result.collect()) == sorted(parts)
