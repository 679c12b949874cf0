"""Nearest neighbours against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import vptree

SCHEMA = "vec_id bigint, embedding array<float>"


def awkward():
    rng = random.Random(1)
    rows = [(k, [rng.gauss(0, 1) * (1 + k % 5) for _ in range(6)]) for k in range(700)]
    rows += [(1000 + k, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for k in range(250)]  # one very common vector
    rows += [(2000, None), (2001, []), (2002, [0.0] * 6), (2003, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2004, [float("nan")] * 6)]
    return rows + [(2005, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (2007, [9.0] * 6), (2007, [9.0] * 6)] + [
        (2020, [1.0] * 5), (2021, [2.0] * 5), (40, [0.5] * 6), (40, [0.25] * 6), (60, [7.0])  # other lengths, ids of queries again
    ]


def plain(rows, queries, k):
    """Of all rows, those of the query's length; `queries` are their ids."""
    usable = [
        (i, np.array(v, np.float32).astype(float))
        for i, v in rows
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    result = []
    for at, (q, own) in enumerate(usable):
        if q in queries:
            others = [(i, v) for n, (i, v) in enumerate(usable) if n != at and len(v) == len(own)]
            scores = sorted((-vptree.products(own, v[None])[0], i) for i, v in others)[:k]
            result += [(q, rank, i, -score) for rank, (score, i) in enumerate(scores, 1)]
    return sorted(result)


@pytest.mark.parametrize("shard_rows", [100, 10**6])
def test_factor_one_is_exact(spark, shard_rows, monkeypatch):
    monkeypatch.setattr(vptree, "LEAF", 16)
    frame = spark.createDataFrame(awkward(), SCHEMA).withColumns({"vector": F.lit("clash"), "shard": F.lit(0), "score": F.lit(0)})
    vectors = vptree.usable(frame)
    found = vptree.search(vptree.index(vectors, shard_rows), vectors.filter("vec_id % 20 = 0"), 20)
    queries = {i for i, _ in awkward() if i is not None and i % 20 == 0}
    assert sorted(map(tuple, found.collect())) == plain(awkward(), queries, 20)


def test_clustered_vectors_leave_most_cells_out(spark, monkeypatch):
    monkeypatch.setattr(vptree, "LEAF", 16)
    rng = random.Random(8)
    middles = [[rng.gauss(0, 20) for _ in range(6)] for _ in range(30)]
    # a third of all rows are copies of one vector
    rows = [(k, middles[0] if k % 3 == 0 else [x + rng.gauss(0, 0.2) for x in rng.choice(middles)]) for k in range(2400)]
    vectors, sent = vptree.usable(spark.createDataFrame(rows, SCHEMA)), []
    met = vptree._met
    monkeypatch.setattr(vptree, "_met", lambda index, asked, *more: sent.append(asked.count()) or met(index, asked, *more))
    index = vptree.index(vectors, 40)
    found = vptree.search(index, vectors.filter("vec_id % 20 = 0"), 20)
    assert sorted(map(tuple, found.collect())) == plain(rows, range(0, 2400, 20), 20)
    sizes = index.trees.groupBy("cell").count().collect()
    assert max(r["count"] for r in sizes) > 10, "a cell with a third of all rows fills many shards"
    first, further = sent
    assert first == 120 and further < 0.35 * first * (len(sizes) - 1)


def test_smaller_factors_find_most(spark):
    vectors = vptree.usable(spark.createDataFrame(awkward()[:700], SCHEMA))
    found = vptree.search(vptree.index(vectors), vectors.filter("vec_id % 20 = 0"), 20, factor=0.8).collect()
    expected = {row[:1] + row[2:3] for row in plain(awkward()[:700], range(0, 700, 20), 20)}
    assert len({(r.query_id, r.vec_id) for r in found} & expected) >= 0.9 * len(expected)


def test_fewer_candidates_than_asked(spark):
    vectors = vptree.usable(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [2.0, 0.0])], SCHEMA))
    found = vptree.search(vptree.index(vectors), vectors.filter("vec_id = 0"), 20)
    assert sorted(map(tuple, found.collect())) == [(0, 1, 2, 2.0), (0, 2, 1, 0.5)]


def test_rows_that_share_an_id_are_all_candidates(spark):
    rows = [(20, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [5.0, 0.0])]
    vectors = vptree.usable(spark.createDataFrame(rows, SCHEMA))
    found = vptree.search(vptree.index(vectors), vectors.filter("vec_id % 20 = 0"), 20)
    assert sorted(map(tuple, found.collect())) == [(20, 1, 1, 5.0), (20, 2, 1, 1.0)]


def test_empty_table(spark):
    vectors = vptree.usable(spark.createDataFrame([], SCHEMA))
    assert vptree.search(vptree.index(vectors), vectors, 20).collect() == []


@pytest.mark.parametrize("shard_rows", [100, 10**6])
def test_ties_of_different_vectors_go_by_id(spark, shard_rows, monkeypatch):
    monkeypatch.setattr(vptree, "LEAF", 16)
    rng = random.Random(4)
    rows = [(k, [float(rng.choice([-1, 0, 1])) for _ in range(8)]) for k in range(600)]  # few values of products, many vectors
    rows = [(k, v) for k, v in rows if any(v)] + [(600, [1.0] + [0.0] * 7)]
    vectors = vptree.usable(spark.createDataFrame(rows, SCHEMA))
    found = vptree.search(vptree.index(vectors, shard_rows), vectors.filter("vec_id % 20 = 0"), 20)
    assert sorted(map(tuple, found.collect())) == plain(rows, [i for i, _ in rows if i % 20 == 0], 20)
