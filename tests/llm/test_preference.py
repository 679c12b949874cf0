"""Formatted pairs against plain Python."""

import random

from pyspark.sql import functions as F

from tidemark.llm import preference

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def awkward():
    rng = random.Random(9)
    rows = []
    for conv in range(120):
        opening = rng.choice(["hello", "hello", "<|im_start|>system", f"own {conv}", None, ""])
        turns = [(None if opening is None else "user", opening)]
        turns += [(rng.choice(["assistant", "user", "assistant", None]), rng.choice(["yes", "no é😀", "", None])) for _ in range(rng.randrange(6))]
        rows += [(conv, k, role, text) for k, (role, text) in enumerate(turns)]
    rows += [(200, 0, "user", "hello"), (200, 0, "user", "hello"), (200, None, "system", "first"), (None, 1, "assistant", "no id"), (None, 0, "user", "q")]
    return rows + [(201, k, ("user", "assistant")[k % 2], "long " * 2000) for k in range(400)]


def shown(turns):
    safe = lambda s: s.replace("<|im_", "<| im_")
    text, spans = "", []
    for role, content in turns:
        text += f"<|im_start|>{safe(role)}\n"
        start = len(text)
        text += safe(content) + "<|im_end|>"
        if role == "assistant":
            spans.append((start, len(text)))
        text += "\n"
    return text, spans


def plain(rows):
    whole = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "unknown", r[3] or "")
    for row in sorted(rows, key=key):
        whole.setdefault(row[0], []).append((row[2] or "unknown", row[3] or ""))
    groups = {}
    for conv in sorted(whole, key=lambda c: (c is not None, c or 0)):
        groups.setdefault(whole[conv][0], []).append(conv)
    result = []
    for convs in groups.values():
        for k in range(0, len(convs), 2):
            chosen = whole[convs[k]]
            if k + 1 < len(convs):
                other, rejected = convs[k + 1], whole[convs[k + 1]]
            else:
                other, rejected = None, list(chosen)
                last = max((i for i, (role, _) in enumerate(chosen) if i and role == "assistant"), default=None)
                if last is not None:
                    rejected[last] = (chosen[last][0], chosen[last - 1][1])
            n = 0
            while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
                n += 1
            c, r = shown(chosen[n:]), shown(rejected[n:])
            result.append((convs[k], other, n, shown(chosen[:n])[0], c[0], r[0], c[1], r[1]))
    return sorted(result, key=str)


def test_equals_plain_computation(spark):
    frame = spark.createDataFrame(awkward(), SCHEMA).withColumns({"opening": F.lit("clash"), "turns": F.lit(1), "prompt": F.lit(2)})
    found = []
    for r in preference.format_pairs(preference.pairs_by_opening(frame)).collect():
        losses = ([tuple(s) for s in spans] for spans in (r.chosen_loss, r.rejected_loss))
        found.append((r.chosen_id, r.rejected_id, r.prompt_turns, r.prompt, r.chosen_text, r.rejected_text, *losses))
    found.sort(key=str)
    assert len(found) == len(plain(awkward()))
    assert [a[:3] for a, b in zip(found, plain(awkward()), strict=True) if a != b] == []


def test_null_and_equal_sides(spark):
    turns = "array<struct<turn:bigint,role:string,text:string>>"
    same = [(0, "user", "q"), (1, "assistant", "a")]
    frame = spark.createDataFrame([(1, same, same), (2, same, None), (3, None, None), (4, same, same[:1])], f"id int, chosen {turns}, rejected {turns}")
    rows = {r.id: (r.prompt_turns, r.chosen_turns, r.rejected_turns, r.chosen_loss, r.rejected_text) for r in preference.format_pairs(frame).collect()}
    assert rows[1] == (2, 0, 0, [], "") and rows[3] == (0, 0, 0, [], "")
    assert rows[2][:3] == (0, 2, 0) and rows[4][:3] == (1, 1, 0)


def test_empty_table(spark):
    assert preference.format_pairs(preference.pairs_by_opening(spark.createDataFrame([], SCHEMA))).collect() == []
