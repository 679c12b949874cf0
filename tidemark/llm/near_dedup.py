"""Near duplicates: MinHash bands for candidates, sequential Bayesian pruning, exact verification."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import components, prefix_sums, written

#: Words of a shingle.
SHINGLE = 3
BANDS, ROWS = 24, 5
HASHES = BANDS * ROWS
#: Signatures are compared so many hashes at a time.
BATCH = 24
#: Documents are linked from so many hundredths of Jaccard similarity.
PERCENT = 85
#: The probability with which a comparison may give up a pair that should be linked.
MISS = 1e-6
#: Documents that one task compares with one another, or two blocks of which it compares.
BLOCK = 512
#: A document with more shingles counts as several of so many, so that a task is bounded by bytes as well.
LONG_SET = 4096
ROWS_AT_ONCE = 256
REMEMBERED = 300_000


def multipliers() -> np.ndarray:
    """The odd factors that stand for the hash functions."""
    return np.random.default_rng(8).integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Sets of shingles as sorted arrays of 64-bit hashes."""

    def __init__(self, words: int = SHINGLE):
        self.words = words
        self.known: dict[bytes, int] = {}

    def _word(self, word: bytes) -> int:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        found = self.known[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return found

    def set_of(self, text: str | None) -> np.ndarray:
        """Words are runs without ASCII white space, A-Z lower-cased; fewer words than a shingle's are one shingle."""
        split = (text or "").encode().lower().split()  # of bytes: ASCII letters and white space only
        if not split:
            return np.empty(0, np.uint64)
        known = self.known
        hashes = np.array([known[w] if w in known else self._word(w) for w in split], np.uint64)
        size = min(self.words, len(hashes))
        mixed = np.full(len(hashes) - size + 1, 0x9E3779B97F4A7C15 + size, np.uint64)
        for k in range(size):
            mixed = _mix(mixed ^ hashes[k : len(hashes) - size + 1 + k])
        return np.unique(mixed)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def signatures(sets: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    """A row of minimal hashes, 32 bits each, for each set; sets are not empty."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    result = np.empty((len(sets), len(factors)), np.uint32)
    for k, factor in enumerate(factors):
        result[:, k] = np.minimum.reduceat(flat * factor, starts) >> np.uint64(32)
    return result


def band_keys(rows: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    bands = rows.reshape(len(rows), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), bands.shape[:2]).copy()
    for k in range(ROWS):
        keys = _mix(keys ^ bands[:, :, k])
    return keys.view(np.int64)


def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[int]:
    """After each batch, the matches below which a pair is given up.

    With an even prior, the similarity of a pair with m of n matches is Beta(m + 1, n - m + 1); it is
    above t as likely as a binomial variable of n + 1 draws at t is at most m.
    """
    t, result = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, 0
        while (below := below + math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)) < miss:
            m += 1
        result.append(m)
    return result


def sketches(documents: DataFrame, words: int = SHINGLE, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """(row, doc_id, shingles, digest, bands, _carried) of each row: the set's size, its SHA-256, and its band keys.

    Without words, the set is empty and digest and bands are null. `_carried` holds a hash of the text
    besides the columns of `carry`. Written, so `row` stays what it is.
    """
    carried = F.struct(F.xxhash64("text").alias("_content"), *(column.alias(name) for name, column in (carry or {}).items()))
    read = documents.select("doc_id", F.col("text").alias("_text"), carried.alias("_carried"))
    made = T.StructType.fromDDL("shingles bigint, digest binary, bands array<bigint>")
    schema = T.StructType([read.schema["doc_id"], read.schema["_carried"], *made.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, factors = Shingler(words), multipliers()
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                sets = [shingler.set_of(text) for text in batch.column(1).to_pylist()]
                full = [s for s in sets if len(s)]
                keys = iter(band_keys(signatures(full, factors)) if full else ())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(2),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    schema.names,
                )

    return written(read.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "near-sketches")


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.sha256(shingles.tobytes()).digest()


def _weight(shingles: str | Column = "shingles") -> Column:
    """How many documents a document counts as."""
    return F.greatest(F.lit(1), F.ceil((F.col(shingles) if isinstance(shingles, str) else shingles) / LONG_SET)).cast("bigint")


def _sets(documents: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(id, family, size, set) of the classes `wanted` (id, family, size, doc_id, content, digest), out of their texts.

    Another text with the same doc_id and hash has another digest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                sets = [shingler.set_of(text) for text in batch.column(4).to_pylist()]
                own = [_digest(s) == d for s, d in zip(sets, batch.column(3).to_pylist(), strict=True)]
                kept = batch.select(["id", "family", "size"]).filter(pa.array(own, pa.bool_()))
                raw = pa.array([s.tobytes() for s, o in zip(sets, own, strict=True) if o], pa.binary())
                yield pa.RecordBatch.from_arrays([*kept.columns, raw], ["id", "family", "size", "set"])

    made = _texts(documents, wanted).mapInArrow(run, "id bigint, family bigint, size bigint, set binary")
    return written(made.dropDuplicates(["id"]), "near-sets")


def _texts(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, family, size, digest, _text): the rows with the doc_id, which may be null or repeat, and the text of a class wanted.

    A row meets one class, but where hashes of texts collide.
    """
    # by sorted partitions at any size, so the plan at a small size is that at a large one
    picked = wanted.select("id", "family", "size", "digest", F.col("doc_id").alias("_doc"), F.col("content").alias("_of")).hint("merge")
    texts = documents.select("doc_id", F.col("text").alias("_text"), F.xxhash64("text").alias("_content"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_content") == F.col("_of"))
    return texts.join(picked, same).select("id", "family", "size", "digest", "_text")


def _with_sets(units: DataFrame, sets: DataFrame) -> DataFrame:
    return units.join(sets.select(F.col("id").alias("_id"), "set").hint("merge"), F.col("id") == F.col("_id")).drop("_id")


def _links(units: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join what is not joined, of each unit of rows (unit, id, group, left, right, set).

    A unit compares its left rows with its right rows, but for those that are of one group already.
    """
    factors, enough = multipliers(), least_matches(percent)

    def run(unit: pd.DataFrame) -> pd.DataFrame:
        found = compare(
            [np.frombuffer(s, np.uint64) for s in unit["set"]],
            unit["group"].to_numpy(), unit["left"].to_numpy(bool), unit["right"].to_numpy(bool), factors, enough, percent,
        )
        ids = unit["id"].to_numpy()
        return pd.DataFrame({"a": ids[[a for a, _ in found]], "b": ids[[b for _, b in found]]}, dtype="int64")

    return written(units.groupBy("unit").applyInPandas(run, "a bigint, b bigint"), "near-links")


def compare(sets, groups, left, right, factors, enough, percent) -> list[tuple[int, int]]:
    """Pairs of places whose sets are similar, as many as join all that is linked within the unit."""
    _, group = np.unique(groups, return_inverse=True)
    rows = np.concatenate([signatures(sets[k : k + 64], factors) for k in range(0, len(sets), 64)])
    universe, flat = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    marked = np.zeros(len(universe), bool)
    places, found = np.arange(len(sets)), []
    for a in np.flatnonzero(left):
        # a pair of rows that are both left and right is compared once
        others = places[right & (group != group[a]) & ~(left & right & (places <= a) & right[a])]
        others = others[np.minimum(sizes[others], sizes[a]) * 100 >= percent * np.maximum(sizes[others], sizes[a])]
        matches = np.zeros(len(others), int)
        for k, least in enumerate(enough):
            part = slice(k * BATCH, (k + 1) * BATCH)
            matches = matches + (rows[others, part] == rows[a, part]).sum(axis=1)
            others, matches = others[matches >= least], matches[matches >= least]
        if not len(others):
            continue
        marked[flat[ends[a] - sizes[a] : ends[a]]] = True
        for b in others:
            if group[b] == group[a]:
                continue
            shared = int(marked[flat[ends[b] - sizes[b] : ends[b]]].sum())
            if 100 * shared >= percent * (int(sizes[a]) + int(sizes[b]) - shared):
                found.append((int(a), int(b)))
                group[group == group[b]] = group[a]
        marked[flat[ends[a] - sizes[a] : ends[a]]] = False
    return found


def near_groups(
    documents: DataFrame,
    words: int = SHINGLE,
    percent: int = PERCENT,
    block: int = BLOCK,
    carry: Mapping[str, Column] | None = None,
    chosen: bool = False,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) and the columns of `carry`, for each row of (doc_id, text).

    Documents with equal sets of shingles are one class. Classes that share a band are candidates; those
    that candidates connect are a family. A family of up to `block` classes is compared in one task,
    where a class of very many shingles counts as several. In a larger one, each band is compared by itself, and bands of more than `block` classes in blocks:
    first all against one class of the band, then those pairs of blocks that are not of one component
    yet. A comparison reads signatures batch by batch, gives up a pair when the posterior probability
    that it should be linked falls below the chosen one, and counts the full sets of the others.

    `component_id` is the least doc_id that links lead to, itself included, and a row is kept if its
    own doc_id is that. Null doc_ids count for nothing; in a component of nothing else it is null.
    Null and empty texts, and those of white space, have no shingles and are linked with nothing. Rows
    that repeat a doc_id are documents of their own, all kept if the id is the least. With `chosen`, a
    column of that name is true for one row of each component, one with the least doc_id, and for each
    row without shingles. An empty table gives an empty table. Other columns are not read.
    """
    rows = sketches(documents, words, carry)
    full = rows.filter("digest IS NOT NULL")
    classes = written(
        full.groupBy("digest").agg(
            F.min("row").alias("id"),
            F.min("doc_id").alias("least"),
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"),
        ),
        "near-classes",
    )
    first = full.join(classes.select(F.col("id").alias("_id")).hint("merge"), F.col("row") == F.col("_id"), "left_semi")
    banded = written(first.select(F.col("row").alias("id"), _weight().alias("weight"), F.explode("bands").alias("band")), "near-bands")
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("size"), F.min("id").alias("low")).filter("n > 1").drop("n")
    members = written(
        banded.join(shared.withColumnRenamed("band", "_band").hint("merge"), F.col("band") == F.col("_band")).drop("_band"),
        "near-members",
    )
    families = written(
        components(members.select(F.col("id").alias("a"), F.col("low").alias("b")), "near-families"), "near-families"
    ).toDF("id", "family")
    wanted = full.join(families.hint("merge"), F.col("row") == F.col("id"))
    sizes = wanted.groupBy(F.col("family").alias("_family")).agg(F.sum(_weight()).alias("size"))
    sized = written(
        wanted.join(sizes.hint("merge"), F.col("family") == F.col("_family")).select(
            "id", "family", "size", "doc_id", F.col("_carried._content").alias("content"), "digest"
        ),
        "near-sized",
    )
    sets = _sets(documents, sized, words)
    # a small family's sets are dealt by family, and only those of large ones meet their bands
    all_pairs = [F.lit(True).alias("left"), F.lit(True).alias("right")]
    small = sets.filter(F.col("size") <= block)
    links = _links(small.select(F.col("family").alias("unit"), "id", F.col("id").alias("group"), *all_pairs, "set"), percent)
    large = sized.filter(F.col("size") > block)
    if not large.isEmpty():
        links = links.union(_links_of_large(large, members, sets.filter(F.col("size") > block), percent, block))
    linked = components(links, "near-components")
    resolved = classes.join(linked.hint("merge"), F.col("id") == F.col("node"), "left").select(
        "digest", "least", "first", F.coalesce("component", "id").alias("component")
    )
    named = written(resolved, "near-resolved")
    names = named.groupBy(F.col("component").alias("_component")).agg(
        F.min("least").alias("component_id"), F.min("first").alias("first")
    )
    of_digest = written(
        named.drop("first").join(names.hint("merge"), F.col("component") == F.col("_component")).select(
            F.col("digest").alias("_digest"), "component_id", F.col("first.row").alias("_first")
        ),
        "near-names",
    )
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        rows.drop("bands")
        .join(of_digest.hint("merge"), F.col("digest") == F.col("_digest"), "left")
        .select(
            "doc_id",
            F.col("shingles").alias("n_shingles"),
            component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
            *([F.coalesce(F.col("row") == F.col("_first"), F.lit(True)).alias("chosen")] if chosen else []),
            *(F.col(f"_carried.{name}") for name in carry or {}),
        )
    )


def _links_of_large(large: DataFrame, members: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links within families that are too large for one task, band by band."""
    in_large = members.join(large.select(F.col("id").alias("_id")).hint("merge"), F.col("id") == F.col("_id"), "left_semi")
    # bands with the same members are compared once
    content = in_large.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")
    )
    once = content.groupBy("n", "x", "y").agg(F.min("band").alias("_band")).select("_band")
    bands = written(in_large.join(once.hint("merge"), F.col("band") == F.col("_band"), "left_semi"), "near-large")
    all_pairs = [F.lit(True).alias("left"), F.lit(True).alias("right")]
    narrow = bands.filter(F.col("size") <= block).select(
        F.concat_ws(":", F.lit("b"), "band").alias("unit"), "id", F.col("id").alias("group"), *all_pairs
    )
    links = _links(_with_sets(narrow, sets), percent)
    wide = bands.filter(F.col("size") > block).select("band", "id", "low", "weight")
    if wide.isEmpty():
        return links

    def blocks(frame: DataFrame, order: list[str]) -> DataFrame:
        placed = prefix_sums(frame, "band", order, "weight", "near-blocks")
        return placed.withColumn("part", F.floor(F.col("before") / block)).drop("before", "row_before", "weight")

    # each block against the band's first class, which stands in all of its units
    parts = written(blocks(wide, ["id"]), "near-parts")
    firsts = parts.select("band", "part", "low").distinct().select("band", "part", F.col("low").alias("id"), F.lit(True).alias("left"))
    rest = parts.filter("id <> low").select("band", "part", "id", F.lit(False).alias("left"))
    star = rest.union(firsts).select(
        F.concat_ws(":", F.lit("s"), "band", "part").alias("unit"), "id", F.col("id").alias("group"), "left", (~F.col("left")).alias("right")
    )
    links = written(links.union(_links(_with_sets(star, sets), percent)), "near-so-far")
    # by component, so that a large one fills blocks of its own, which need no comparison
    known = components(links, "near-so-far")
    grouped = wide.join(known.hint("merge"), F.col("id") == F.col("node"), "left").select(
        "band", "id", "weight", F.coalesce("component", "id").alias("group")
    )
    parts = written(blocks(grouped, ["group", "id"]), "near-parts")
    spans = written(
        parts.groupBy("band", "part").agg(F.min("group").alias("low"), F.max("group").alias("high")), "near-spans"
    )
    other = spans.toDF("_band", "other", "other_low", "other_high")
    # pairs of blocks, of which there is one for each `block` of weight; not pairs of rows
    pairs = spans.join(other, (F.col("band") == F.col("_band")) & (F.col("part") <= F.col("other"))).filter(
        F.least("low", "other_low") < F.greatest("high", "other_high")
    )
    pairs = pairs.select(
        F.concat_ws(":", F.lit("p"), "band", "part", "other").alias("unit"), F.col("band").alias("_band"), "part", "other"
    )
    sides = pairs.select(
        "unit", "_band",
        F.explode(
            F.when(F.col("part") == F.col("other"), F.array(F.struct(F.col("part").alias("at"), F.lit(True).alias("left"), F.lit(True).alias("right"))))
            .otherwise(
                F.array(
                    F.struct(F.col("part").alias("at"), F.lit(True).alias("left"), F.lit(False).alias("right")),
                    F.struct(F.col("other").alias("at"), F.lit(False).alias("left"), F.lit(True).alias("right")),
                )
            )
        ).alias("side"),
    ).select("unit", "_band", "side.*")
    units = sides.join(parts, (F.col("_band") == F.col("band")) & (F.col("at") == F.col("part"))).select(
        "unit", "id", "group", "left", "right"
    )
    return links.union(_links(_with_sets(units, sets), percent))
