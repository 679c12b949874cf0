"""Byte-pair encoding and decoding by a contiguous array of ranks."""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_or_empty

# Fixed value: the pattern that splits text into words before the merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Ranges of letters and numbers younger than the tokenizer's character tables, which take them for symbols.
YOUNG = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959"
    " 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8"
    " 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128"
    " 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed"
    " 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)
#: Words of more bytes are merged by a heap: repeated scans of a long array take the square of its length.
SHORT_WORD = 200
#: Words whose ids a task remembers.
REMEMBERED = 500_000
#: Rows that a task holds at once.
ROWS_AT_ONCE = 500


class Vocabulary:
    """The ids, merges and special tokens of a byte-level vocabulary file."""

    def __init__(self, content: str):
        parsed = json.loads(content)
        model = parsed["model"]
        letters = _byte_letters()
        back = {letter: bytes([byte]) for byte, letter in letters.items()}
        ids = model["vocab"]
        self.byte_ids = [ids[letters[byte]] for byte in range(256)]
        #: by the left id, by the right id: the rank of their merge; by rank: the id it gives
        self.ranks: list[dict[int, int]] = [{} for _ in range(max(ids.values()) + 1)]
        self.made: list[int] = []
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[ids[left]][ids[right]] = len(self.made)
            self.made.append(ids[left + right])
        special = {token["content"]: token["id"] for token in parsed["added_tokens"]}
        self.special = special
        self.texts = [b""] * (max([*ids.values(), *special.values()]) + 1)
        for token, number in ids.items():
            if token not in special:
                self.texts[number] = b"".join(back[letter] for letter in token)
        for token, number in special.items():
            self.texts[number] = token.encode()
        self.split = regex.compile(SPLIT)
        self.split_ascii = re.compile(SPLIT.replace(r"\s\p{L}\p{N}", r"\sA-Za-z0-9").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]"))
        # separators that the two kinds of patterns may take for white space or not
        self.odd = re.compile(r"[\x1c-\x1f]")
        young = "".join(
            "-".join(rf"\U{int(end, 16):08x}" for end in part.split("-")) for part in YOUNG.split()
        )
        self.young = regex.compile(f"[{young}]")
        self.beyond = regex.compile(rf"[\u{int(YOUNG.split()[0], 16):04x}-\U0010ffff]")
        self.special_split = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) or r"(?!)")
        #: by word: its ids, four bytes each
        self.known: dict[str, bytes] = {}

    def __getstate__(self) -> dict:
        return {**vars(self), "known": {}}

    def words(self, text: str) -> list[str]:
        if text.isascii():
            return (self.split if self.odd.search(text) else self.split_ascii).findall(text)
        if not self.beyond.search(text) or not self.young.search(text):
            return self.split.findall(text)
        plain = self.young.sub("¡", text)
        return [text[m.start() : m.end()] for m in self.split.finditer(plain)]

    def ids(self, word: str) -> bytes:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            raw = word.encode()
            found = array("i", self._scan(raw) if len(raw) <= SHORT_WORD else self._heap(raw)).tobytes()
            if len(raw) <= SHORT_WORD:
                self.known[word] = found
        return found

    def _scan(self, raw: bytes) -> list[int]:
        """The array of parts and the array of ranks of neighbours; the least rank goes first, the leftmost of equals."""
        merges, made, never = self.ranks, self.made, len(self.made)
        byte_ids = self.byte_ids
        parts = [byte_ids[byte] for byte in raw]
        ranks = [merges[left].get(right, never) for left, right in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) != never:
            at = ranks.index(least)
            parts[at] = part = made[least]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = merges[parts[at - 1]].get(part, never)
            if at < len(ranks):
                ranks[at] = merges[part].get(parts[at + 1], never)
        return parts

    def _heap(self, raw: bytes) -> list[int]:
        """The same merges for a long word: neighbours in linked lists, ranks in a heap."""
        parts: list[int | None] = [self.byte_ids[byte] for byte in raw]
        size, merges = len(parts), self.ranks
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = []

        def push(at: int) -> None:
            pair = parts[at], parts[after[at]]
            if (rank := merges[pair[0]].get(pair[1])) is not None:
                heapq.heappush(heap, (rank, at, pair))

        for at in range(size - 1):
            push(at)
        while heap:
            rank, at, (left, right) = heapq.heappop(heap)
            to = after[at]
            if parts[at] != left or to >= size or parts[to] != right:
                continue
            parts[at], parts[to] = self.made[rank], None
            after[at] = after[to]
            if after[at] < size:
                before[after[at]] = at
                push(at)
            if before[at] >= 0:
                push(before[at])
        return [part for part in parts if part is not None]

    def encode(self, text: str) -> list[int]:
        return array("i", self.encoded(text)).tolist()

    def encoded(self, text: str) -> bytes:
        """The ids of a text, four bytes each."""
        pieces, at = [], 0
        for mark in self.special_split.finditer(text) if self.special else ():
            pieces += self._known(self.words(text[at : mark.start()]))
            pieces.append(array("i", [self.special[mark.group()]]).tobytes())
            at = mark.end()
        pieces += self._known(self.words(text[at:] if at else text))
        return b"".join(pieces)

    def _known(self, words: list[str]) -> list[bytes]:
        found = list(map(self.known.get, words))
        return [self.ids(word) if ids is None else ids for word, ids in zip(words, found, strict=True)] if None in found else found

    def decode(self, ids: Sequence[int]) -> str:
        return decoded(np.array([-1 if i is None else i for i in ids], np.int64), _texts(self.texts))


def _texts(texts: list[bytes]) -> np.ndarray:
    """The texts of ids, and an empty one for ids outside the vocabulary."""
    table = np.empty(len(texts) + 1, object)
    table[:] = [*texts, b""]
    return table


def decoded(ids: np.ndarray, texts: np.ndarray) -> str:
    """Bytes that are not UTF-8 become replacement characters, ids outside the vocabulary nothing."""
    outside = (ids < 0) | (ids >= len(texts) - 1)
    return b"".join(texts[np.where(outside, len(texts) - 1, ids)].tolist()).decode(errors="replace")


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + k) for k, byte in enumerate(hidden)}


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def _vocabulary(path: str) -> Vocabulary:
    """The vocabulary file, read once on the driver; it is some megabytes at any input."""
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


def encode(documents: DataFrame, path: str, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns `carry` and `ids`, an array of token ids, of each row's whole `text`.

    Texts are split into words, special tokens standing for themselves. A short word is an array of
    parts beside an array of the ranks of neighbouring parts: the least rank is searched again and
    again, its boundary deleted and the ranks beside it renewed. Long words give the same ids by a heap.

    A null or empty text has no ids. All rows are encoded by themselves, so repeated rows repeat and
    an empty table gives an empty table. Columns not named in `carry` are not read.
    """
    # a worker keeps it from task to task, and the words that it learned
    shared = documents.sparkSession.sparkContext.broadcast(_vocabulary(path))
    names = list(carry)
    read = documents.select(*names, text_or_empty("text").alias("_text"))
    schema = T.StructType([*documents.select(*names).schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in _small(batches):
            all_ids = [vocabulary.encoded(text) for text in batch.column(len(names)).to_pylist()]
            offsets = np.cumsum([0, *(len(ids) // 4 for ids in all_ids)], dtype=np.int32)
            flat = np.frombuffer(b"".join(all_ids), np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], ids], [*names, "ids"])

    return read.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns `carry` and `text`, the decoded `ids`, of each row; null or no ids give an empty text."""
    # the texts of tokens are all that decoding needs
    shared = encoded.sparkSession.sparkContext.broadcast(_texts(_vocabulary(path).texts))
    names = list(carry)
    # ids that are carried along are read there
    read = encoded.select(*names) if "ids" in names else encoded.select(*names, F.col("ids").alias("_ids"))
    at = names.index("ids") if "ids" in names else len(names)
    schema = T.StructType([*encoded.select(*names).schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in _small(batches):
            column = batch.column(at)
            flat = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            texts = [decoded(ids, known) for ids in np.split(flat, ends[:-1])] if len(ends) else []
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(texts, pa.string())], [*names, "text"])

    return read.mapInArrow(run, schema)


def round_trip(documents: DataFrame, path: str, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns `carry`, `ids` and `decoded` of each row's whole `text`: `encode` and `decode` in one worker.

    The text is decoded from the ids alone. Rows, nulls and empty tables are as in `encode`.
    """
    vocabulary = _vocabulary(path)
    # the table's texts are those of the vocabulary, and stay so in a worker
    shared = documents.sparkSession.sparkContext.broadcast((vocabulary, _texts(vocabulary.texts)))
    names = list(carry)
    read = documents.select(*names, text_or_empty("text").alias("_text"))
    made = [T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())]
    schema = T.StructType([*documents.select(*names).schema.fields, *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = shared.value
        for batch in _small(batches):
            all_ids = [vocabulary.encoded(text) for text in batch.column(len(names)).to_pylist()]
            offsets = np.cumsum([0, *(len(ids) // 4 for ids in all_ids)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(all_ids), np.int32)))
            texts = pa.array([decoded(np.frombuffer(one, np.int32), known) for one in all_ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], ids, texts], [*names, "ids", "decoded"])

    return read.mapInArrow(run, schema)
