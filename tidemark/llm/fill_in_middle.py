"""Fill-in-the-middle texts by rotating blocks in place."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_or_empty

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes that a reversal holds beside the text at a time.
SWAPPED = 1 << 16
#: Bytes of text that a task turns into rows at a time.
BYTES_AT_ONCE = 4 << 20


def transformed(text: bytes, doc_id: int | None, seed: int = 7, rate: int = 100, spm: int = 50) -> tuple[int, str, int | None, int | None, bytearray]:
    """(lines, form, code points of the prefix and of the middle, output) of one text.

    Cuts and form follow the digest of the seed and the id. Sentinels are inserted before the three
    segments in the order of the text, and one rotation brings them in the order of the form.
    """
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    buffer = bytearray(text)
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    lines = len(ends) + (bool(text) and not text.endswith(b"\n"))
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return lines, "plain", None, None, buffer
    first, second = sorted((h1 % (lines + 1), h2 % (lines + 1)))
    cuts = [0 if k == 0 else len(text) if k == lines else int(ends[k - 1]) for k in (first, second)]
    prefix, middle = (_code_points(text, a, b) for a, b in ((0, cuts[0]), tuple(cuts)))
    # in the order of the text: prefix, middle, suffix; from the back, so that earlier cuts stay
    for at, mark in ((cuts[1], SUFFIX), (cuts[0], MIDDLE), (0, PREFIX)):
        buffer[at:at] = mark
    head, body = len(PREFIX) + cuts[0], len(MIDDLE) + cuts[1] - cuts[0]
    rotate(buffer, head, head + body, len(buffer))  # prefix, suffix, middle
    if h4 % 100 < spm:
        rotate(buffer, 0, head, len(buffer) - body)  # suffix, prefix, middle
        return lines, "spm", prefix, middle, buffer
    return lines, "psm", prefix, middle, buffer


def restored(output: bytes, form: str) -> bytearray:
    """The text that gave an output: its rotations inverted, its sentinels taken out."""
    buffer = bytearray(output)
    if form == "plain":
        return buffer
    middle = output.rindex(MIDDLE)
    if form == "spm":
        head = output.index(PREFIX)
        rotate(buffer, 0, head, middle)
        head = middle - head
    else:
        head = output.index(SUFFIX)
    rotate(buffer, head, middle, len(buffer))
    for at, mark in ((head + len(buffer) - middle, SUFFIX), (head, MIDDLE), (0, PREFIX)):
        del buffer[at : at + len(mark)]
    return buffer


def rotate(buffer: bytearray, start: int, middle: int, stop: int) -> None:
    """Exchanges the neighbours [start, middle) and [middle, stop) in place: each reversed, then both together."""
    view = np.frombuffer(buffer, np.uint8)
    for a, b in ((start, middle), (middle, stop), (start, stop)):
        _reverse(view, a, b)


def _reverse(view: np.ndarray, start: int, stop: int) -> None:
    while stop - start > 1:
        size = min(SWAPPED, (stop - start) // 2)
        ahead = view[start : start + size].copy()
        view[start : start + size] = view[stop - size : stop][::-1]
        view[stop - size : stop] = ahead[::-1]
        start, stop = start + size, stop - size


def _code_points(text: bytes, start: int, stop: int) -> int:
    """Bytes that begin a code point in UTF-8."""
    return int(np.count_nonzero(np.frombuffer(text, np.uint8, stop - start, start) & 0xC0 != 0x80)) if stop > start else 0


def transform(
    documents: DataFrame, carry: Sequence[str] = ("doc_id",), seed: int = 7, rate: int = 100, spm: int = 50, doc_id: str = "doc_id"
) -> DataFrame:
    """The columns `carry`, and `n`, `form`, `prefix_chars`, `middle_chars`, `output` of each row's whole `text`.

    A text is cut into `n` lines at two places that follow from `seed` and id. `form` is `psm`
    (prefix, suffix, middle), for `spm` of a hundred rows `spm` (suffix, prefix, middle), or `plain`
    for empty texts, those that hold a sentinel, and all but `rate` of a hundred.

    Null texts are empty, null ids count as an empty one. Rows are handled by themselves, so those that
    repeat give the same, of any length, as only a segment of 64 KiB is held beside a text; an empty
    table gives an empty table. Columns not named in `carry` are not read, so extra ones can't clash.
    """
    names = list(carry)
    read = documents.select(*names, F.col(doc_id).cast("bigint").alias("_id"), text_or_empty("text").alias("_text"))
    made = T.StructType.fromDDL("n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    schema = T.StructType([*documents.select(*names).schema.fields, *made.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, len(names) + 1):
            texts = batch.column(len(names) + 1).cast(pa.binary()).to_pylist()
            found = [transformed(text, i, seed, rate, spm) for text, i in zip(texts, batch.column(len(names)).to_pylist(), strict=True)]
            lines, forms, prefixes, middles, outputs = map(list, zip(*found, strict=True))
            numbers = [pa.array(values, pa.int64()) for values in (lines, prefixes, middles)]
            columns = [numbers[0], pa.array(forms, pa.string()), *numbers[1:], _strings(outputs)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *columns], schema.names)

    return read.mapInArrow(run, schema)


def restore(outputs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns `carry` and `text`, the exact text that gave `output` in the form `form`; null gives an empty text."""
    names = list(carry)
    read = outputs.select(*names, F.col("form").alias("_form"), text_or_empty("output").alias("_output"))
    schema = T.StructType([*outputs.select(*names).schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, len(names) + 1):
            forms = batch.column(len(names)).to_pylist()
            texts = [restored(o, f) for o, f in zip(batch.column(len(names) + 1).cast(pa.binary()).to_pylist(), forms, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], _strings(texts)], schema.names)

    return read.mapInArrow(run, schema)


def _strings(values: list[bytearray]) -> pa.Array:
    """Strings of bytes that are UTF-8 wherever the texts were."""
    offsets = pa.array([0, *accumulate(map(len, values))], pa.int32())
    return pa.StringArray.from_buffers(len(values), offsets.buffers()[1], pa.py_buffer(b"".join(values)))


def _pieces(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Parts of the batches of some megabytes of text each; a longer text is one for itself."""
    for batch in batches:
        sizes = np.diff(np.frombuffer(batch.column(text).buffers()[1], np.int32, batch.num_rows + 1, 4 * batch.column(text).offset))
        start = held = 0
        for at, size in enumerate(sizes.tolist()):
            if at > start and held + size > BYTES_AT_ONCE:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)
