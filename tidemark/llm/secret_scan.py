"""Secret scans by a trigram index: Boolean trigram queries pick the texts that a rule's pattern is tried on."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty, written

#: A class of at most so many characters, and runs of at most so many strings, are spelled out.
SMALL_CLASS = 4
MOST_STRINGS = 64
SPANS = "array<struct<start:bigint,number:int,stop:bigint>>"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of `pattern` count if `group` has `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    Rule("hex", "[0-9a-f]{24,}", least=24),
)
#: Added to the base: tokens with a fixed beginning, and private keys.
MORE = (
    Rule("github", "gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abp]-[A-Za-z0-9-]{10,}"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

Clause = frozenset[frozenset[str]]


def trigram_query(pattern: str) -> list[Clause]:
    """What a text must hold to match: of each clause one set of trigrams, folded to lower case.

    Runs of parts with few possible strings are spelled out; each run all of whose strings have
    three characters or more gives a clause. No clause means that nothing can be demanded.
    """
    parsed = re._parser.parse(pattern)
    clauses: list[Clause] = []
    run: set[str] = {""}

    def close() -> None:
        nonlocal run
        if min(map(len, run)) >= 3:
            options = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
            # what asks for more than another option adds nothing
            clauses.append(frozenset(o for o in options if not any(other < o for other in options)))
        run = {""}

    def extend(strings: set[str]) -> None:
        nonlocal run
        if len(run) * len(strings) > MOST_STRINGS:
            close()
        run = {a + b for a, b in product(run, strings)}

    def walk(parts: Sequence) -> None:
        for part in parts:
            if (strings := _spelled([part])) is not None:
                extend(strings)
                continue
            kind, value = str(part[0]), part[1]
            if kind == "SUBPATTERN":
                walk(value[-1])
            elif kind in ("MAX_REPEAT", "MIN_REPEAT") and value[0] >= 1:
                walk(value[2])
                close()
            else:
                close()

    walk(parsed)
    close()
    return clauses


def _spelled(parts: Sequence) -> set[str] | None:
    """All strings the parts can match, in lower case, if they are few."""
    found = {""}
    for kind, value in parts:
        kind = str(kind)
        if kind == "LITERAL":
            strings = {chr(value).lower()}
        elif kind == "IN" and len(value) <= SMALL_CLASS and all(str(k) == "LITERAL" for k, _ in value):
            strings = {chr(v).lower() for _, v in value}
        elif kind == "SUBPATTERN":
            strings = _spelled(value[-1])
        elif kind == "BRANCH":
            options = [_spelled(option) for option in value[1]]
            strings = None if None in options else set().union(*options)
        elif kind in ("MAX_REPEAT", "MIN_REPEAT") and value[1] <= SMALL_CLASS or kind.endswith("REPEAT") and value[0] == value[1] <= 8:
            one = _spelled(value[2])
            times = range(value[0], value[1] + 1)
            strings = None if one is None else {"".join(x) for n in times for x in product(one, repeat=n)}
        else:
            strings = None
        if strings is None or len(found) * len(strings) > MOST_STRINGS:
            return None
        found = {a + b for a, b in product(found, strings)}
    return found


def trigram_postings(documents: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """The inverted index (trigram, doc_id) of lower-cased texts, for the trigrams that queries ask for."""
    low = documents.select("doc_id", F.lower(text_or_empty("text")).alias("_low"))
    holds = F.array(*(F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in vocabulary))
    return low.select("doc_id", F.explode(F.array_compact(holds)).alias("trigram"))


def candidates(documents: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(id, kinds): the documents in which postings leave a rule possible, with the kinds of these rules."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    vocabulary = sorted({t for clauses in queries.values() for clause in clauses for some in clause for t in some})
    if not vocabulary:
        return documents.select(F.col("doc_id").alias("_id"), F.array().cast("array<string>").alias("_kinds")).limit(0)
    held = trigram_postings(documents, vocabulary).groupBy("doc_id").agg(F.collect_set("trigram").alias("_held"))

    def has_all(trigrams: frozenset[str]) -> Column:
        return F.size(F.array_except(F.array(*(F.lit(t) for t in sorted(trigrams))), F.col("_held"))) == 0

    def fits(clauses: list[Clause]) -> Column:
        result = F.lit(True)
        for clause in clauses:
            any_of = F.lit(False)
            for trigrams in sorted(clause, key=sorted):
                any_of = any_of | has_all(trigrams)
            result = result & any_of
        return result

    kinds = F.array_compact(F.array(*(F.when(fits(q), F.lit(kind)) for kind, q in queries.items() if q)))
    return held.select(F.col("doc_id").alias("_id"), kinds.alias("_kinds")).filter(F.size("_kinds") > 0)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value worked out once, however often it is named."""
    return F.transform(F.array(value), body)[0]


def _before(lengths: Column) -> Column:
    """Of an array of numbers, the sum before each; in pieces of about the root of its size, so that long arrays stay cheap."""
    zero = F.lit(0).cast("bigint")

    def running(values: Column, start: Column) -> Column:
        added = F.aggregate(values, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        return _let(added, lambda sums: F.slice(sums, F.lit(1), F.size(sums) - 1))

    def in_pieces(step: Column) -> Column:
        last = F.ceil(F.size(lengths) / step).cast("int") - 1
        pieces = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(lengths, k * step + 1, step))
        return _let(pieces, lambda cut: F.flatten(F.zip_with(cut, starts(cut), running)))

    def starts(cut: Column) -> Column:
        return running(F.transform(cut, lambda piece: F.aggregate(piece, zero, lambda acc, x: acc + x)), zero)

    return _let(F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(lengths)))).cast("int"), in_pieces)


def _found(text: Column, rule: Rule, number: int) -> Column:
    """An array of (start, number, stop) of the rule's matches in the text, in code points."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    parts = F.struct(
        F.transform(matches, lambda m: F.length(m).cast("bigint")).alias("long"),
        F.transform(checked, lambda c: F.length(c) >= rule.least).alias("counts"),
        F.transform(F.split(text, rule.pattern, -1), lambda gap: F.length(gap).cast("bigint")).alias("gaps"),
    )

    def placed(part: Column) -> Column:
        # before the end of the i-th match stand i matches and i gaps
        steps = F.zip_with(F.slice(part["gaps"], F.lit(1), F.size(part["long"])), part["long"], lambda gap, m: gap + m)
        ends = _let(steps, lambda lengths: F.zip_with(_before(lengths), lengths, lambda before, step: before + step))
        spans = F.zip_with(
            ends, part["long"], lambda end, m: F.struct((end - m).alias("start"), F.lit(number).alias("number"), end.alias("stop"))
        )
        return F.array_compact(F.zip_with(spans, part["counts"], lambda span, ok: F.when(ok, span)))

    return F.when(F.regexp_like(text, pattern), _let(parts, placed)).otherwise(F.array()).cast(SPANS)


def scan(documents: DataFrame, rules: Sequence[Rule] = BASE + MORE) -> DataFrame:
    """(doc_id, text, spans) of each row of (doc_id, text); spans: array of (start, number, stop).

    `number` is the rule's place in `rules`, positions are code points, `stop` is exclusive, and
    spans are sorted by start, then number. A rule with a trigram query is tried on the texts whose
    postings satisfy it; a rule without is tried on all. Candidates are a table with a known size,
    so Spark joins them without moving texts where they are few.

    Null texts are empty and hold nothing. A null doc_id is an id like others, and rows that share
    an id share candidates, each being verified by its own text. An empty table gives an empty
    table. Other columns are not read.
    """
    rows = documents.select("doc_id", text_or_empty("text").alias("text"))
    picked = written(candidates(rows, rules), "secret-candidates")
    joined = rows.join(picked, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    found = []
    for number, rule in enumerate(rules):
        spans = _found(F.col("text"), rule, number)
        if trigram_query(rule.pattern):
            asked = F.coalesce(F.array_contains("_kinds", rule.kind), F.lit(False))
            spans = F.when(asked, spans).otherwise(F.array().cast(SPANS))
        found.append(spans)
    return joined.select("doc_id", "text", F.array_sort(F.flatten(F.array(*found))).alias("spans"))


def named(spans: Column, rules: Sequence[Rule]) -> Column:
    """Spans as kind:start:stop, joined by commas."""
    kinds = F.array(*(F.lit(rule.kind) for rule in rules))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["number"] + 1), s["start"].cast("string"), s["stop"].cast("string"))),
        ",",
    )
