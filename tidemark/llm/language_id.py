"""Language identification: words by their frequency in each language, unseen ones by ever shorter n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_or_empty, written

UNKNOWN = "und"
#: Lengths of the n-grams of unseen words, in the order in which they are tried.
LENGTHS = (5, 4, 3, 2, 1)
#: Languages that the model knows, those with most documents.
MOST_LANGUAGES = 1000
#: Words times languages, and n-grams of a length times languages, that the model holds: the most frequent
#: ones. So it is some megabytes at any input, and may be sent to all tasks.
CELLS = 400_000
#: Added to each count.
PRIOR = 0.5
#: Letters of a word; a longer run of letters is several words.
LONGEST = 40
#: Different words that a task counts at once.
REMEMBERED = 200_000
ROWS_AT_ONCE = 500

_LETTERS = re.compile(f"[a-z]{{1,{LONGEST}}}")
_ANY_LETTERS = regex.compile(rf"\p{{L}}[\p{{L}}\p{{M}}]{{0,{LONGEST - 1}}}")


def split_words(text: str) -> list[str]:
    """Runs of letters in lower case; none if the text has no letter."""
    return (_LETTERS if text.isascii() else _ANY_LETTERS).findall(text.lower())


def grams(word: str, length: int) -> list[str]:
    """The n-grams of a word between marks of its ends; the word's letters themselves for length 1."""
    marked = word if length == 1 else f"<{word}>"
    return [marked[k : k + length] for k in range(len(marked) - length + 1)]


@dataclass
class Model:
    """The logarithms of the frequencies of words, and of n-grams, in all languages: a row of a table for each."""

    languages: list[str] = field(default_factory=list)
    prior: np.ndarray = field(default_factory=lambda: np.zeros(0))
    words: dict[str, int] = field(default_factory=dict)
    word_table: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    grams: dict[str, int] = field(default_factory=dict)
    gram_table: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def __post_init__(self) -> None:
        #: rows of unseen words below those of known ones, as far as a task remembers them
        self.unseen: dict[str, int] = {}
        self.table = self.word_table

    def __getstate__(self) -> dict:
        return {**vars(self), "unseen": {}, "table": self.word_table}

    def predict(self, texts: Sequence[str]) -> list[tuple[str, float]]:
        """Each text's likeliest language, the least of equals, and its probability; `und` without letters or languages."""
        counted = [Counter(split_words(text)) if self.languages else {} for text in texts]
        self._back_off({word for counts in counted for word in counts if word not in self.words})
        known, unseen, found = self.words.get, self.unseen.__getitem__, []
        step = max(1, 2 * CELLS // max(1, len(self.languages)))
        for counts in counted:
            if not counts:
                found.append((UNKNOWN, 0.0))
                continue
            rows = [unseen(word) if (row := known(word)) is None else row for word in counts]
            times, total = list(counts.values()), self.prior
            for start in range(0, len(rows), step):
                total = total + np.array(times[start : start + step], float) @ self.table[rows[start : start + step]]
            best = int(total.argmax())
            found.append((self.languages[best], float(1 / np.exp(np.maximum(total - total[best], -700)).sum())))
        return found

    def _back_off(self, words: set[str]) -> None:
        """Gives each unseen word a row: the mean of its longest known n-grams, nothing if none is known."""
        count = max(1, len(self.languages))
        if len(self.unseen) + len(words) > 2 * CELLS // count:
            self.unseen, self.table = {}, self.word_table
        new = [word for word in words if word not in self.unseen]
        if not new:
            return
        rows, get = [], self.grams.get
        step = max(1, CELLS // count // 4)
        for start in range(0, len(new), step):
            part = np.zeros((min(step, len(new) - start), count))
            places, sizes, at = [], [], []
            for number, word in enumerate(new[start : start + step]):
                for length in LENGTHS:
                    known = [row for gram in grams(word, length) if (row := get(gram)) is not None]
                    if known:
                        at.append(number)
                        places += known
                        sizes.append(len(known))
                        break
            if at:
                begins = np.cumsum([0, *sizes[:-1]])
                part[at] = np.add.reduceat(self.gram_table[places], begins) / np.array(sizes)[:, None]
            rows.append(part)
        first = len(self.table)
        self.unseen.update((word, first + k) for k, word in enumerate(new))
        self.table = np.concatenate([self.table, *rows])


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows that nothing is learned from: a third by hash, and those without id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def fit(documents: DataFrame, cells: int = CELLS) -> Model:
    """The model of all documents (doc_id, lang, text) that have a language and are not held out.

    Words are counted per language over all of them, and n-grams over the counted words. The model
    has the most frequent ones, the lesser of equally frequent ones, so that its size is bounded.
    Without such documents it knows no language.
    """
    learned = documents.filter(F.col("lang").isNotNull() & ~held_out())
    counted = learned.select(F.col("lang").cast("string").alias("lang"), text_or_empty("text").alias("text"))
    schema = "lang string, unit string, n bigint, texts bigint"
    partial = counted.mapInArrow(_count_words, schema).groupBy("lang", "unit")
    words = written(partial.agg(F.sum("n").alias("n"), F.sum("texts").alias("texts")), "language-words")
    # the rows without a word have the numbers of texts
    texts = words.filter("unit = ''").orderBy(F.desc("texts"), "lang").limit(MOST_LANGUAGES).toPandas()
    if texts.empty:
        return Model()
    languages = sorted(texts["lang"])
    model = Model(languages=languages)
    shares = texts.set_index("lang")["texts"].reindex(languages).to_numpy(float)
    model.prior = np.log(shares / shares.sum())
    known = words.filter("unit <> ''").filter(F.col("lang").isin(languages) if len(languages) == MOST_LANGUAGES else F.lit(True))
    most = max(1, cells // len(languages))
    model.words, model.word_table = _frequencies(known.select("lang", "unit", "n"), languages, most)
    parts = known.select("lang", "unit", "n").mapInPandas(_count_grams, "length int, lang string, unit string, n bigint")
    counts = written(parts.groupBy("length", "lang", "unit").agg(F.sum("n").alias("n")), "language-grams")
    tables = [np.zeros((0, len(languages)))]
    for length in LENGTHS:
        units, matrix = _frequencies(counts.filter(F.col("length") == length).drop("length"), languages, most)
        first = len(model.grams)
        model.grams.update((unit, first + k) for unit, k in units.items())
        tables.append(matrix)
    model.gram_table = np.concatenate(tables)
    return model


def _frequencies(counts: DataFrame, languages: list[str], most: int) -> tuple[dict[str, int], np.ndarray]:
    """The rows of units, and a table of the logarithms of the frequencies of the most frequent units in all languages, of counts (lang, unit, n)."""
    totals = {row["lang"]: row["n"] for row in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    frequent = counts.groupBy("unit").agg(F.sum("n").alias("_all")).orderBy(F.desc("_all"), "unit").limit(most)
    # at most `most` units of at most LONGEST letters, and as many rows for each language
    kept = counts.join(F.broadcast(frequent.select("unit")), "unit").toPandas()
    units, places = np.unique(kept["unit"].to_numpy(object).astype(str), return_inverse=True) if len(kept) else ([], [])
    matrix = np.full((len(units), len(languages)), PRIOR)
    at = {language: k for k, language in enumerate(languages)}
    matrix[places, [at[language] for language in kept["lang"]]] += kept["n"].to_numpy(float)
    sums = np.array([totals.get(language, 0) for language in languages], float) + PRIOR * max(1, len(units))
    return {str(unit): k for k, unit in enumerate(units)}, np.log(matrix / sums)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of words, and of texts in the row of no word."""
    counts: dict[str, Counter] = {}
    texts: Counter = Counter()

    def shown() -> pa.RecordBatch:
        rows = [(lang, "", 0, n) for lang, n in texts.items()]
        rows += [(lang, word, n, 0) for lang, own in counts.items() for word, n in own.items()]
        columns = zip(*rows, strict=True) if rows else ((), (), (), ())
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "unit", "n", "texts"])

    for whole in batches:
        for start in range(0, whole.num_rows, ROWS_AT_ONCE):
            batch = whole.slice(start, ROWS_AT_ONCE)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts[lang] += 1
                counts.setdefault(lang, Counter()).update(split_words(text))
            if sum(map(len, counts.values())) + len(texts) > REMEMBERED:
                yield shown()
                counts.clear()
                texts.clear()
    yield shown()


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partial counts of the n-grams of counted words."""
    for batch in batches:
        counts: dict[str, dict[str, int]] = {}
        for lang, word, n in zip(batch["lang"], batch["unit"], batch["n"].tolist(), strict=True):
            own = counts.setdefault(lang, {})
            get = own.get
            for length in LENGTHS:
                for gram in grams(word, length):
                    own[gram] = get(gram, 0) + n
        rows = [(len(gram), lang, gram, n) for lang, own in counts.items() for gram, n in own.items()]
        yield pd.DataFrame(rows, columns=["length", "lang", "unit", "n"]).astype({"length": "int32", "n": "int64"})


def predict(documents: DataFrame, model: Model, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns `carry`, `lang_pred` and `score` of each row's whole `text`.

    `score` is the probability of the language by its words and by its share of the learned texts.
    Texts that are null or have no letter are `und` with a score of 0. Every row is judged by its own
    text, so repeated rows repeat; equally likely languages go by the lesser name; an empty table
    gives an empty table. Columns not named in `carry` are not read, so extra ones can't clash.
    """
    names = list(carry)
    read = documents.select(*names, text_or_empty("text").alias("_text"))
    schema = T.StructType([*documents.select(*names).schema.fields, *T.StructType.fromDDL("lang_pred string, score double").fields])
    # a worker keeps the model from task to task, and what it found of unseen words
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                languages, scores = zip(*own.predict(batch.column(len(names)).to_pylist()), strict=True)
                columns = [pa.array(languages, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *columns], schema.names)

    return read.mapInArrow(run, schema)
