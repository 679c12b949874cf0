"""The pipeline against a plain version of its stages."""

import random
import re

import public_tokenizers
import test_mixing
import test_toxicity
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark):
    rng = random.Random(12)
    rows = [tuple(row) for row in test_toxicity.corpus(spark)[0].collect()]
    clean = [row for row in rows if row[0] % 6]
    rows += [(1000 + k, clean[k % 40][1]) for k in range(120)]  # copies
    for k in range(60):  # near copies
        words = clean[50 + k % 20][1].split()
        words[rng.randrange(len(words))] = f"near{k}"
        rows.append((2000 + k, " ".join(words)))
    rows += [(3000, None), (3001, ""), (3002, " \n"), (None, "no id at all"), (3003, "given twice"), (3003, "given twice")]
    return [(i, t, None if n % 50 == 0 else "en", None if n % 40 == 0 else f"s{n % 5 if n % 3 else 0}", len(t or "")) for n, (i, t) in enumerate(rows)]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def without_copies(rows):
    largest = {}
    for row in rows:
        text = row[1] or ""
        if text not in largest or (row[0] is not None and (largest[text][0] is None or row[0] > largest[text][0])):
            largest[text] = row
    return list(largest.values())


def without_near_copies(rows):
    sets, group = [shingles(row[1]) for row in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for row, g in zip(rows, group, strict=True):
        least[g] = min((x for x in (least.get(g), row[0]) if x is not None), default=None)
    return [row for row, g in zip(rows, group, strict=True) if row[0] == least[g]]


def mixed(rows):
    # the source belongs to a row, which its id names here
    taken = {row[0]: row[4] for row in test_mixing.plain([(r[0], r[1], r[3]) for r in rows])}
    result = []
    for row in rows:
        text, size = row[1] or "", test_mixing.words(row[1])
        for start in range(0, taken[row[0]], size or 1):
            amount = min(size, taken[row[0]] - start)
            ends = [m.end() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
            result.append((*row[:1], text if amount == size else text[: ends[amount - 1]], *row[2:4]))
    return result


def test_equals_plain_version(spark, tmp_path):
    rows = documents(spark)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    _, labels = test_toxicity.corpus(spark)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact dedup", "near dedup", "mixing", "encoding"]

    scored = toxicity.score(frame, toxicity.fit(frame, labels), carry=COLUMNS).filter("score < 0.5").select(COLUMNS)
    expected = [tuple(row) for row in scored.collect()]
    assert {row[0] for row in rows} - {row[0] for row in expected} == {k for k in range(600) if k % 6 == 0}
    expected = without_copies(expected)
    expected = mixed(without_near_copies(expected))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoded = sorted(((i, lang, source, library.encode(text, add_special_tokens=False).ids) for i, text, lang, source in expected), key=str)

    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.filter(~F.col("round_trip") | (F.size("ids") != F.col("n_tokens"))).count() == 0
    found = sorted(((r.doc_id, r.lang, r.source, r.ids) for r in result.collect()), key=str)
    assert len(found) == len(encoded)
    assert [(a, b) for a, b in zip(found, encoded, strict=True) if a != b] == []


def test_stages_keep_the_columns(spark, tmp_path):
    frame = spark.createDataFrame(documents(spark)[:5], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    _, labels = test_toxicity.corpus(spark)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for given in (frame, frame.limit(0)):
        docs = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == COLUMNS
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_one_of_near_copies_under_the_same_or_no_id_stays(spark):
    def near(name):
        words = [f"{name}{k}" for k in range(100)]
        return [" ".join(words[:at] + ["other"] + words[at + 1 :]) for at in (10, 50, 90)]

    same, none, mixed_ids = near("a"), near("b"), near("c")
    rows = [(7, t) for t in same] + [(None, t) for t in none] + [(None, mixed_ids[0]), (9, mixed_ids[1]), (8, mixed_ids[2])]
    rows += [(7, "another text of this id"), (None, "another text without id"), (None, " "), (5, None)]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "").collect()
    found = [tuple(row) for row in kept]
    assert len([r for r in found if r[1] in same]) == len([r for r in found if r[1] in none]) == 1
    assert [r for r in found if r[1] in mixed_ids] == [(8, mixed_ids[2])]
    assert len(found) == 3 + 4


def test_further_columns_with_clashing_names_are_kept(spark, tmp_path):
    rows = [(k, f"words of text number {k // 2} and {'some more of them ' * (k % 3)}", "en", f"s{k % 2}", 30) for k in range(12)]
    rows += [(None, None, None, None, None), (12, "x" * 100_000 + " y", "en", "s0", 100_002)]
    plain = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    extra = {"key": F.lit("k"), "_key": F.col("doc_id") + 1, "_size": F.lit(-1), "_of": F.lit("o"), "taken": F.lit(7), "digest": F.lit("d")}
    wide = plain.withColumns(extra)
    stages = dict(corpus_pipeline.STAGES)
    for name in ("exact dedup", "near dedup", "mixing"):
        found = stages[name](spark, wide, str(tmp_path))
        assert found.columns == wide.columns
        expected = stages[name](spark, plain, str(tmp_path)).withColumns(extra)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str), name
