"""Language identification against a plain version, and on texts that were held out."""

import math
import random
from collections import Counter
from zlib import crc32

import pytest
import regex
from pyspark.sql import functions as F

from tidemark.llm import language_id as li
from tidemark.llm import queries

SCHEMA = "doc_id bigint, text string, lang string, score string, unit string, n string, lang_pred string"
#: Made languages: syllables of their own and shared ones.
SYLLABLES = {"aa": "ka lo mi tu ra", "bb": "ße lö mi tü ra", "cc": "que ción mi tu ño", "zz": "漢 字 ра ми то"}


def documents(count=240, seed=5):
    rng, rows = random.Random(seed), []
    for k in range(count):
        lang = rng.choice(sorted(SYLLABLES))
        words = ("".join(rng.choices(SYLLABLES[lang].split(), k=rng.randrange(1, 4))) for _ in range(rng.randrange(3, 30)))
        rows.append((k, " ".join(words).capitalize() + ". 12!", lang))
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "123 _ !?", "aa"), (903, "x", None), (None, "KALOMI ra", "aa"), (904, "KALOMI ra " * 40_000, None)]
    return rows + [(5, "ra ra", "bb"), (5, "ra ra", "bb"), (905, "Жжж", None), (906, "İx" + "q" * 100, "cc"), (907, "́́", "aa")]


def learns(doc_id):
    return doc_id is not None and crc32(str(doc_id).encode()) % 3 != 1


def words_of(text):
    return regex.findall(r"\p{L}[\p{L}\p{M}]{0,39}", (text or "").lower())


def plain(rows, most):
    """Each row's language and score by the same model, with dictionaries."""
    learned = [(t, lang) for i, t, lang in rows if lang is not None and learns(i)]
    languages = sorted({lang for _, lang in learned})
    tables = {}
    for length in (0, *li.LENGTHS):
        counts = {lang: Counter() for lang in languages}
        for text, lang in learned:
            for word in words_of(text):
                marked = word if length == 1 else f"<{word}>"
                counts[lang].update([word] if length == 0 else [marked[k : k + length] for k in range(len(marked) - length + 1)])
        everywhere = sum(counts.values(), Counter())
        kept = sorted(everywhere, key=lambda u: (-everywhere[u], u.encode()))[:most]
        tables[length] = {
            unit: [math.log((counts[g][unit] + li.PRIOR) / (sum(counts[g].values()) + li.PRIOR * max(1, len(kept)))) for g in languages]
            for unit in kept
        }

    def word_scores(word):
        if word in tables[0]:
            return tables[0][word]
        for length in li.LENGTHS:
            marked = word if length == 1 else f"<{word}>"
            known = [tables[length][g] for k in range(len(marked) - length + 1) if (g := marked[k : k + length]) in tables[length]]
            if known:
                return [sum(column) / len(known) for column in zip(*known, strict=True)]
        return [0.0] * len(languages)

    texts = Counter(lang for _, lang in learned)
    for i, text, _ in rows:
        words = words_of(text)
        if not words:
            yield i, "und", 0.0
            continue
        totals = [math.log(texts[g] / len(learned)) for g in languages]
        for word, times in Counter(words).items():
            totals = [t + times * s for t, s in zip(totals, word_scores(word), strict=True)]
        best = max(totals)
        yield i, languages[totals.index(best)], 1 / sum(math.exp(max(t - best, -700)) for t in totals)


@pytest.mark.parametrize("cells", [li.CELLS, 60])
def test_equals_plain(spark, cells):
    rows = documents()
    frame = spark.createDataFrame([(*row, "clash", "clash", "clash", "clash") for row in rows], SCHEMA).repartition(3)
    found = li.predict(frame, li.fit(frame, cells)).collect()
    expected = sorted(plain(rows, cells // len(SYLLABLES)), key=str)
    found = sorted(map(tuple, found), key=str)
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    assert [r[2] for r in found] == pytest.approx([r[2] for r in expected], rel=1e-6)


def test_held_out_texts(spark, tmp_path):
    rows = documents(600)
    spark.createDataFrame([(*row, "", "", "", "") for row in rows], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op12_language(spark, str(tmp_path)).collect()
    given = {i: (lang, text) for i, text, lang in rows}
    judged = [(r.lang_pred, *given[r.doc_id]) for r in found if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert {r.doc_id for r in found if not r.held_out} == {i for i, *_ in rows if learns(i)}
    assert len(judged) > 150 and sum(p == lang for p, lang, _ in judged) >= 0.95 * len(judged)
    assert all(0 <= r.score <= 1 for r in found) and {r.lang_pred for r in found} <= {*SYLLABLES, "und"}


def test_without_anything_to_learn_from(spark):
    frame = spark.createDataFrame([(1, "abc", None), (2, None, None)], "doc_id bigint, text string, lang string")
    assert {tuple(r) for r in li.predict(frame, li.fit(frame)).collect()} == {(1, "und", 0.0), (2, "und", 0.0)}
    empty = frame.filter(F.lit(False))
    assert li.predict(empty, li.fit(empty)).collect() == []


def test_labels_and_ids_are_no_inputs(spark):
    model = li.fit(spark.createDataFrame(documents(), "doc_id bigint, text string, lang string"))
    one = spark.createDataFrame([(1, "kalomi tu", "aa"), (2, "kalomi tu", "bb"), (None, "kalomi tu", None)], "doc_id bigint, text string, lang string")
    assert len({(r.lang_pred, r.score) for r in li.predict(one, model).collect()}) == 1
