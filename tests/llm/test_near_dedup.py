"""Components against all pairs, with small blocks so that every path is taken."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, near_dedup

SCHEMA = "doc_id bigint, text string"


def awkward():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(4000)]
    rows = []
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 20, 60, 150]))]
        for _ in range(rng.choice([2, 5, 40])):
            words = list(base)
            for _ in range(rng.randrange(5)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows), rng.choice([" ", "\n", " \t"]).join(words).replace("w1", rng.choice(["w1", "W1"]))))
    rows += [(len(rows) + k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 50)))) for k in range(60)]
    rows += [(900 + k, text) for k, text in enumerate([None, "", " \t", "one", "ONE", "one two", "one  two", "one two three", "É x y", "é x y"])]
    return rows + [(None, "one two"), (None, rows[0][1]), (5, rows[5][1]), (950, "same id"), (950, "another text"), (960, "long " * 30000 + "a b c")]


def shingles(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
    return {tuple(words[k : k + 3]) for k in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)} - {()}


def plain(rows):
    sets = [shingles(text) for _, text in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 85 * (len(sets[a]) + len(sets[b]) - shared):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc_id, _), g in zip(rows, group, strict=True):
        least[g] = min((x for x in (least.get(g), doc_id) if x is not None), default=None)
    return sorted(((d, len(s), least[g], d == least[g]) for (d, _), s, g in zip(rows, sets, group, strict=True)), key=str)


@pytest.mark.parametrize("block,long_set", [(1000, 4096), (30, 4096), (6, 4096), (40, 3)])
def test_equals_all_pairs(spark, block, long_set, monkeypatch):
    monkeypatch.setattr(near_dedup, "LONG_SET", long_set)
    frame = spark.createDataFrame(awkward(), SCHEMA).withColumns({"row": F.lit("clash"), "digest": F.lit(1), "kept": F.lit(2)})
    found = near_dedup.near_groups(frame, block=block, carry={"row": F.col("row")})
    assert {r["row"] for r in found.select("row").distinct().collect()} == {"clash"}
    result = sorted(map(tuple, found.drop("row").collect()), key=str)
    assert [pair for pair in zip(result, plain(awkward()), strict=True) if pair[0] != pair[1]] == []


def test_thresholds_follow_the_posterior():
    least = near_dedup.least_matches(85, 1e-6)
    assert least == sorted(least) and all(0 < m < 0.85 * near_dedup.BATCH * (k + 1) for k, m in enumerate(least))


def test_empty_table(spark):
    assert near_dedup.near_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_texts_under_one_id_are_not_paired(spark):
    rows = [(None if k % 2 else 1, f"text {k // 4}") for k in range(400)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    full = near_dedup.sketches(documents).withColumn("content", F.col("_carried._content"))
    numbers = [F.col("row").alias("id"), F.lit(0).alias("family"), F.lit(1).alias("size")]
    wanted = full.dropDuplicates(["digest"]).select(*numbers, "doc_id", "content", "digest")
    texts = near_dedup._texts(documents, wanted)
    assert texts.select("id").distinct().count() == 100 and texts.count() == 200


@pytest.mark.parametrize("edges_at_once", [3, 1 << 20])
def test_components_of_paths_stars_and_repeated_links(spark, monkeypatch, edges_at_once):
    monkeypatch.setattr(common, "EDGES_AT_ONCE", edges_at_once)
    rng = random.Random(5)
    path = list(range(100, 160))
    rng.shuffle(path)
    links = [*zip(path, path[1:], strict=False), *((7, n) for n in range(200, 260)), *((n, 3) for n in range(230, 290))]
    links += [(rng.randrange(1000, 1060), rng.randrange(1000, 1060)) for _ in range(40)] + [(5, 5), (2, 1), (1, 2), (2, 1)]
    least = {n: n for link in links if link[0] != link[1] for n in link}
    for _ in least:
        for a, b in links:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    frame = spark.createDataFrame(links, "a bigint, b bigint").repartition(5)
    assert sorted(map(tuple, common.components(frame, "test").collect())) == sorted(least.items())
    assert common.components(frame.limit(0), "test").count() == 0
