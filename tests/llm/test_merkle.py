"""The Merkle manifest against one built in plain Python."""

import random
import string
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle, queries

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, pos bigint, path string, total bigint"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    framed = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))
    return digest("".join(framed))


def lower(text):
    return None if text is None else text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def tree(nodes):
    """(root, each node's path of (left, right)); a lone node is the root."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, at in zip(paths, places, strict=True):
            run = at // 8 * 8
            path.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 8])))
        nodes = [digest("".join(nodes[k : k + 8])) for k in range(0, len(nodes), 8)]
        places = [at // 8 for at in places]
    return nodes[0], paths


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [(g, sorted(groups[g], key=lambda r: r[:3])) for g in order]
    trees = [(g, own, *tree([r[2] for r in own])) for g, own in trees]
    root, above = tree([subroot for _, _, subroot, _ in trees])
    result = []
    for (_, own, subroot, paths), top in zip(trees, above, strict=True):
        for (_, _, own_leaf, row), path in zip(own, paths, strict=True):
            whole = path + top
            changed = row[0] is not None and crc32(str(row[0]).encode()) % 3 == 0
            folded = leaf(row, lower(row[1])) if changed else own_leaf
            for left, right in whole:
                folded = digest(left + folded + right)
            proof = digest("".join(left + right for left, right in whole))
            result.append((row[0], own_leaf, subroot, root, proof, folded, folded == root))
    return sorted(result, key=str)


def awkward(seed=3):
    """Groups of 1, 7, 8, 9, 513 and 1,300 leaves, negative, far, repeated and null ids, rows that repeat."""
    rng = random.Random(seed)
    rows = []
    for lang, count in (("one", 1), ("é", 7), ("e", 8), ("nine", 9), (None, 513), ("many", 1300), *((f"l{k}", 2) for k in range(12))):
        ids = rng.sample(range(-5000, 5000), count) if lang != "many" else [rng.choice((rng.randrange(10**17), 63, 64, -1, 4095, 4096)) for _ in range(count)]
        rows += [(i, f"Text {i} ÄÉ" if i % 7 else None, lang, None if i % 5 == 0 else "S", i % 90) for i in ids]
    rows += [(None, f"N{k % 4}", "many", "s", None) for k in range(300)] + [(None, None, None, None, None)] * 20
    rows += [(2**63 - 1, "", "nine", "", 0), (-(2**63), "x" * 300_000, "nine", "", 300_000), (7, "Same", "one", "s", 4), (7, "Same", "one", "s", 4)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [awkward(), awkward()[:1], [(1, "A", None, "s", 1)] * 9], ids=["awkward", "one", "copies"])
def test_query_equals_plain(spark, tmp_path, rows):
    frame = spark.createDataFrame([(*row, "clash", 1, "clash", 2) for row in rows], SCHEMA)
    frame.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op11_manifest(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=str) == plain(rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op11_manifest(spark, str(tmp_path))
    assert found.columns[:1] == ["doc_id"] and found.collect() == []


def test_positions_need_no_sort_of_distinct_ids(spark):
    ids = random.Random(1).sample(range(-(10**6), 10**6), 3000)
    leaves = spark.createDataFrame([(str(i % 3), i, "d") for i in ids], "grp string, id bigint, digest string")
    placed = merkle.positions(leaves)
    by_group = {g: sorted(i for i in ids if str(i % 3) == g) for g in "012"}
    assert {(r.grp, r.id, r.pos, r.total) for r in placed.collect()} == {
        (g, i, pos, len(own)) for g, own in by_group.items() for pos, i in enumerate(own)
    }
    assert placed.filter(F.col("pos").isNull()).count() == 0
    assert "Window" not in placed._jdf.queryExecution().executedPlan().toString()
