"""Segments against all segments, and scores on held-out rows."""

import random
import zlib

import pytest
from compare import TESTDATA
from pyspark.sql import functions as F

from tidemark.llm import queries, toxicity


@pytest.mark.parametrize("seed", range(40))
def test_maximal_segments(seed):
    """No maximal segment lies in a better one, and the best of all is among them."""
    rng = random.Random(seed)
    scores = [rng.choice([-0.5, -0.5, -0.5, 1.0, 2.5, -1.5]) for _ in range(40)]
    hits = [(k, s) for k, s in enumerate(scores) if s != -0.5]
    found = toxicity.maximal_segments(hits, 0.5)
    spans = {(a, b): sum(scores[a:b]) for a in range(40) for b in range(a + 1, 41)}
    assert all(abs(spans[a, b] - s) < 1e-9 for a, b, s in found)
    assert all(b <= c for (_, b, _), (c, _, _) in zip(found, found[1:], strict=False))
    if max(spans.values()) > 0:
        assert abs(max(s for *_, s in found) - max(spans.values())) < 1e-9
    for a, b, s in found:  # all proper parts are worse
        assert all(spans[c, d] < s + 1e-9 for c in range(a, b) for d in range(c + 1, b + 1))
    covered = {k for a, b, _ in found for k in range(a, b)}
    assert all(k in covered for k, s in enumerate(scores) if s > 0)


def test_held_out_rows(spark):
    frame = spark.createDataFrame([(k,) for k in range(200)] + [(None,)], "doc_id bigint")
    for row in frame.select("doc_id", toxicity.held_out().alias("held")).collect():
        assert row.held == (row.doc_id is None or zlib.crc32(str(row.doc_id).encode()) % 5 == 0)


def corpus(spark, seed=3):
    rng = random.Random(seed)
    insults = [f"grunf{end}" for end in ("er", "ing", "ich", "ous", "ant", "y")]
    rows, labels = [], []
    for k in range(600):
        words = [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(rng.randrange(20, 120))]
        toxic = k % 6 == 0
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(insults[: 5 if k < 500 else 6]) for _ in range(rng.randrange(3, 7))]
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_finds_the_passages(spark):
    documents, labels = corpus(spark)
    model = toxicity.fit(documents, labels)
    extra = spark.createDataFrame([(None, None), (1000, ""), (1001, "word " * 50000), (1002, "GRUNFER grunfing, grunfous! " * 3), (1002, "wab")], "doc_id bigint, text string")
    frame = documents.union(extra).withColumns({"score": F.lit("clash"), "segments": F.lit(1)})
    scored = [(r.doc_id, r.score, r.segments) for r in toxicity.score(frame, model).collect()]
    assert len(scored) == 605 and all(0 <= s <= 1 for _, s, _ in scored)
    for doc_id, score, segments in scored:
        if doc_id is not None and doc_id < 600:
            assert (score >= 0.5) == (doc_id % 6 == 0) == bool(segments), doc_id
    loud = [(s, g) for i, s, g in scored if i == 1002]
    assert sorted(s >= 0.5 for s, _ in loud) == [False, True]
    passage = next(g for s, g in loud if s >= 0.5)[0]
    assert (passage.start, passage.stop) == (0, len("GRUNFER grunfing, grunfous! " * 3) - 2) and passage.expected < 1e-3


def test_without_labels_nothing_is_toxic(spark):
    documents, labels = corpus(spark)
    for known in (labels.limit(0), labels.withColumn("toxic", F.lit(None).cast("int")), labels.withColumn("toxic", F.lit(0))):
        model = toxicity.fit(documents, known)
        assert toxicity.score(documents.limit(20), model).filter("score >= 0.5").count() == 0
    assert toxicity.score(documents.limit(0), toxicity.fit(documents.limit(0), labels)).collect() == []


def test_held_out_accuracy(spark):
    scored = queries.op4_toxicity(spark, f"{TESTDATA}/sf0.01").join(spark.read.parquet(f"{TESTDATA}/sf0.01/labels.parquet"), "doc_id")
    rows = scored.filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.93 * len(rows)
    assert not any(r.predicted and not r.toxic for r in rows)
