"""Toxic passages: maximal scoring segments of token log-odds, judged by extreme-value statistics."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_or_empty, written

#: The classifier is fitted on so many labelled documents at most, those with the least hashes of their ids.
MOST_LABELLED = 20_000
#: The Dirichlet prior's count of each word in each class.
PRIOR = 0.5
#: Words speak for toxicity if their log-odds are so many standard deviations above 0.
DEVIATIONS = 3.0
#: Of an unknown word that is longer, so many first letters are looked up, the most first.
STEMS = (6, 5, 4)
#: A segment is significant if chance gives fewer than so many as good ones in a clean text of that length.
SIGNIFICANT = 0.05
ROWS_AT_ONCE = 1000

SEGMENTS = "array<struct<start:int,stop:int,score:double,expected:double>>"


@dataclass
class Model:
    """What scoring a text needs; its size follows from the bounded sample it was fitted on.

    `words` and `stems` have the log-odds of what speaks for toxicity, `plain` the words that don't
    though their stem does, and `drift` what any other word takes away. `rate` and `spread` are the
    parameters of the distribution of a clean text's best segment, `offset` and `slope` those of the
    logistic curve from evidence to probability.
    """

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    plain: set[str] = field(default_factory=set)
    drift: float = 0.01
    rate: float = 1.0
    spread: float = 1.0
    offset: float = -20.0
    slope: float = 0.0

    def word(self, word: str) -> float | None:
        found = self.words.get(word)
        if found is None and word not in self.plain:
            for length in STEMS:
                if len(word) > length and (found := self.stems.get(word[:length])) is not None:
                    break
        return found

    def segments(self, words: list[str]) -> list[tuple[int, int, float]]:
        """All maximal scoring segments (first word, word after the last, score), in one pass."""
        hits = [(k, score) for k, word in enumerate(words) if (score := self.word(word)) is not None]
        return maximal_segments(hits, self.drift)

    def expected(self, score: float, length: int) -> float:
        """How many segments of that score or more a clean text of that length has by chance."""
        return self.spread * max(length, 1) * math.exp(-self.rate * score)

    def evidence(self, segments: list[tuple[int, int, float]], length: int) -> float:
        """The surprise of all significant segments together; without any, that of the best."""
        if not segments:
            return -math.log(self.spread * max(length, 1) + 1e-9)
        surprises = [-math.log(self.expected(score, length) + 1e-300) for _, _, score in segments]
        significant = [s for s in surprises if s > -math.log(SIGNIFICANT)]
        return sum(significant) if significant else max(surprises)

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.offset + self.slope * squash(evidence)))))


def squash(evidence: float) -> float:
    """Evidence on a scale on which many segments and few differ less."""
    return math.copysign(math.log1p(abs(evidence)), evidence)


def split_words(text: str) -> list[str]:
    return re.findall(r"[^\W\d_]+", text.lower())


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """Maximal scoring segments of a sequence that has the score `-drift` but for `hits`.

    Candidates hold the sums before and after them. A new one joins the nearest earlier candidate
    that began lower, if that ended lower too, and so on; each is joined once, so time is linear.
    """
    stack: list[tuple[int, int, float, float, int]] = []  # first, after, sum before, sum after, lower one
    total, last = 0.0, -1
    for at, score in hits:
        total -= drift * (at - last - 1)
        last = at
        before, total = total, total + score
        if score <= 0:
            continue
        first, left, right = at, before, total
        while True:
            lower = len(stack) - 1
            while lower >= 0 and stack[lower][2] >= left:
                lower = stack[lower][4]
            if lower < 0 or stack[lower][3] >= right:
                stack.append((first, at + 1, left, right, lower))
                break
            first, left = stack[lower][0], stack[lower][2]
            del stack[lower:]
    return [(first, after, right - left) for first, after, left, right, _ in stack]


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows that nothing is learned from: a fifth by hash, and those without id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled(documents: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """(text, toxic) of a bounded number of labelled documents that may be learned from, copies once."""
    sample = (
        labels.filter(F.col("toxic").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(most)
    )
    # at most `most` rows of two numbers
    joined = documents.join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    return joined.select(text_or_empty("text").alias("text"), F.col("_toxic").alias("toxic")).dropDuplicates()


def fit(documents: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """The model of a bounded sample of labelled rows that are not held out."""
    sample = written(labelled(documents, labels, most), "toxic-sample")
    counts = written(
        sample.mapInPandas(_count, "unit string, stem boolean, toxic bigint, clean bigint")
        .groupBy("unit", "stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "toxic-counts",
    )
    total = counts.filter("NOT stem").agg(F.sum("toxic"), F.sum("clean"), F.count(F.lit(1))).first()
    n_toxic, n_clean, kinds = (x or 0 for x in total)
    documents_toxic, documents_clean = (x or 0 for x in sample.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first())
    if not documents_toxic or not documents_clean:
        share = documents_toxic / (documents_toxic + documents_clean + 1)
        return Model(offset=math.log(share / (1 - share)) if share else -20.0)

    def log_odds(count: str, all_of_class: int) -> Column:
        seen = F.col(count) + PRIOR
        return F.log(seen) - F.log(F.lit(all_of_class + PRIOR * kinds) - seen)

    odds = log_odds("toxic", n_toxic) - log_odds("clean", n_clean)
    deviation = F.sqrt(1 / (F.col("toxic") + PRIOR) + 1 / (F.col("clean") + PRIOR))
    scored = counts.withColumn("score", odds).withColumn("tells", odds > DEVIATIONS * deviation)
    # all that is brought to the driver comes from the bounded sample
    telling = scored.filter("tells").toPandas()
    words, stems = telling[~telling["stem"]], telling[telling["stem"]]
    model = Model(
        words=dict(zip(words["unit"], words["score"], strict=True)),
        stems=dict(zip(stems["unit"], stems["score"], strict=True)),
    )
    # words that clean texts use, though their stem speaks for toxicity
    used = scored.filter("NOT stem AND NOT tells AND clean > 0")
    begins = F.broadcast(scored.filter("stem AND tells").select(F.col("unit").alias("_stem")))
    beside = used.join(begins, F.substring("unit", 1, 4) == F.substring("_stem", 1, 4), "left_semi")
    model.plain = set(beside.select("unit").toPandas()["unit"])
    hits = sample.mapInPandas(_hit_counts(model), "toxic int, score double, words bigint").groupBy("toxic", "score")
    seen = hits.agg(F.sum("words").alias("words")).toPandas()
    model.drift, model.rate = _background(seen)
    best = sample.mapInPandas(_best(model), "toxic int, length int, best double").toPandas()
    clean = best[best["toxic"] == 0]
    # with the rate given, the likeliest scale of the distribution of the best segments of clean texts
    model.spread = len(clean) / max(1e-9, float((clean["length"].clip(lower=1) * np.exp(-model.rate * clean["best"])).sum()))
    judged = sample.mapInPandas(_evidence(model), "toxic int, evidence double").toPandas()
    model.offset, model.slope = _logistic(judged["evidence"].map(squash).to_numpy(float), judged["toxic"].to_numpy(float))
    return model


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words and stems with the numbers of toxic and clean texts that hold them: a word that one text repeats counts once."""
    for batch in batches:
        counts: dict[tuple[str, bool], list[int]] = {}
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            words = set(split_words(text))
            units = {(word, False) for word in words}
            units |= {(word[:length], True) for word in words for length in STEMS if len(word) > length}
            for unit in units:
                counts.setdefault(unit, [0, 0])[1 - toxic] += 1
        yield pd.DataFrame([(*unit, *both) for unit, both in counts.items()], columns=["unit", "stem", "toxic", "clean"])


def _hit_counts(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter = Counter()
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                counts.update((toxic, model.word(word) or 0.0) for word in split_words(text))
            yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["toxic", "score", "words"])

    return run


def _background(seen: pd.DataFrame) -> tuple[float, float]:
    """The drift, and the rate at which chance segments of clean texts get rarer with their score."""

    def told(toxic: int) -> float:
        own = seen[seen["toxic"] == toxic]
        return (float(own.loc[own["score"] > 0, "words"].sum()) + PRIOR) / (float(own["words"].sum()) + 1)

    clean = seen[seen["toxic"] == 0]
    hits = clean[clean["score"] > 0]
    # the log-odds of a word that doesn't speak for toxicity, and more than chance hits outweigh
    gain = float((hits["score"] * hits["words"]).sum()) / max(1.0, float(clean["words"].sum()))
    drift = max(math.log((1 - told(0)) / (1 - min(0.5, told(1)))), 2 * gain, 0.005)
    scores = np.append(hits["score"].to_numpy(float), [-drift, float(seen["score"].max())])
    weights = np.append(hits["words"].to_numpy(float), [float(clean.loc[clean["score"] == 0, "words"].sum()), PRIOR])
    weights /= weights.sum()
    low, high = 1e-6, 10.0
    for _ in range(100):  # the sum is below 1 for small rates and grows without bound
        rate = (low + high) / 2
        low, high = (low, rate) if float(weights @ np.exp(np.minimum(rate * scores, 500))) > 1 else (rate, high)
    return drift, low


def _best(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [split_words(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "toxic": batch["toxic"],
                    "length": [len(w) for w in words],
                    "best": [max((s for *_, s in model.segments(w)), default=0.0) for w in words],
                }
            )

    return run


def _evidence(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [split_words(text) for text in batch["text"]]
            yield pd.DataFrame(
                {"toxic": batch["toxic"], "evidence": [model.evidence(model.segments(w), len(w)) for w in words]}
            )

    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Offset and slope by Newton steps, with a slight pull to 0."""
    features = np.column_stack([np.ones_like(x), x])
    weights, pull = np.zeros(2), np.diag([1e-3, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        gradient = features.T @ (y - p) - pull @ weights
        step = np.linalg.solve((features * (p * (1 - p))[:, None]).T @ features + pull, gradient)
        weights = weights + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(weights[0]), max(0.0, float(weights[1]))


def score(documents: DataFrame, model: Model, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns `carry`, `score` and `segments` of each row of (text).

    `score` is the probability that the text is labelled toxic. `segments` are its significant
    passages: start and stop in code points of the lower-cased text, the sum of log-odds, and the
    number of passages as good that chance gives a clean text of that length.

    Every row is scored by its own whole text, so repeated rows repeat. Null and empty texts have no
    words and score as such; an empty table gives an empty table. Columns not in `carry` are not read.
    """
    names = list(carry)
    # a text that is carried along is read there
    read = documents.select(*names) if "text" in names else documents.select(*names, text_or_empty("text").alias("_text"))
    at = names.index("text") if "text" in names else len(names)
    made = T.StructType.fromDDL(f"score double, segments {SEGMENTS}")
    schema = T.StructType([*documents.select(*names).schema.fields, *made.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                scores, found = [], []
                for text in (text or "" for text in batch.column(at).to_pylist()):
                    words = split_words(text)
                    segments = model.segments(words)
                    scores.append(model.probability(model.evidence(segments, len(words))))
                    kept = [(*s, e) for s in segments if (e := model.expected(s[2], len(words))) < SIGNIFICANT]
                    places = [m.span() for m in re.finditer(r"[^\W\d_]+", text.lower())] if kept else []
                    found.append([{"start": places[a][0], "stop": places[b - 1][1], "score": s, "expected": e} for a, b, s, e in kept])
                spans = pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())])))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(names)], pa.array(scores, pa.float64()), spans], [*names, "score", "segments"]
                )

    return read.mapInArrow(run, schema)
