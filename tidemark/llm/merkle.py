"""A Merkle manifest of a table: leaves placed by ranks in bitmaps of their ids, levels reduced in slot arrays."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prefix_sums, written

#: Nodes that become one.
FAN = 8
#: Levels that one array of slots reduces, so it has 512 slots at most.
LEVELS = 3
SLOTS = FAN**LEVELS
#: Ids of a bitmap: 64 words of 64 bits, of which only those that hold ids are stored.
BLOCK_BITS, WORD_BITS = 12, 6

PATH = "array<struct<left:string,right:string>>"


def leaf(columns: Sequence[str | Column]) -> Column:
    """The digest of some values: of each `-` if it is null, else its length in bytes, a colon and itself."""

    def framed(column: str | Column) -> Column:
        value = (F.col(column) if isinstance(column, str) else column).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(framed, columns)), 256)


@dataclass
class Manifest:
    """A tree over groups of leaves, of any size, as tables.

    `tiers` are the slot arrays of a group's levels, three levels each, from the leaves up, `subroots`
    the groups' own roots, `top` the same arrays over these, and `root` the digest of all, null
    without leaves.
    """

    tiers: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: str | None


def positions(leaves: DataFrame) -> DataFrame:
    """Adds `pos`, the number of earlier leaves of the same `grp` by ascending `id`, and `total`, that of all.

    Ids are not sorted. Each task sets the bits of its ids in words of 64, which are merged by OR, and
    the words of 4,096 neighbouring ids become a bitmap that stores those words only that are not
    empty, with a directory: which words these are, and how many ids lie before each. The rank of
    an id is then read off two bit counts, after the leaves of earlier blocks, added up by range.

    Leaves whose id is null come first. Where a block holds an id repeatedly, or is that of the null
    ids, its leaves are ordered by id and digest instead, by range, so one id may hold any share of
    all leaves; equal leaves may change places, which no digest shows.
    """
    low = f"id & {(1 << BLOCK_BITS) - 1}"
    word, bit = f"cast(({low}) >> {WORD_BITS} AS int)", f"cast(id & {(1 << WORD_BITS) - 1} AS int)"
    block = F.expr(f"shiftright(id, {BLOCK_BITS})")
    words = leaves.groupBy("grp", block.alias("block"), F.expr(word).alias("w")).agg(
        F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("bits"), F.count(F.lit(1)).alias("n")
    )
    filled = F.sort_array(F.collect_list(F.struct("w", "bits")))  # 64 words at most
    blocks = words.groupBy("grp", "block").agg(
        F.expr("bit_or(shiftleft(1L, w))").alias("present"), filled.alias("filled"), F.sum("n").alias("n"), F.sum(F.bit_count("bits")).alias("ids")
    )
    placed = written(prefix_sums(blocks, "grp", ["block"], "n", "bitmap-order").drop("row_before"), "bitmaps")
    totals = placed.groupBy(F.col("grp").alias("_g")).agg(F.sum("n").alias("total"))
    directory = placed.join(totals, F.col("grp").eqNullSafe(F.col("_g"))).select(
        F.col("grp").alias("_grp"),
        F.col("block").alias("_block"),
        "present",
        F.expr("transform(filled, f -> f.bits)").alias("words"),
        F.expr("transform(filled, (f, i) -> aggregate(slice(filled, 1, i), 0, (n, g) -> n + bit_count(g.bits)))").alias("counts"),
        "before",
        "total",
        F.expr("block IS NULL OR n <> ids").alias("repeats"),
    )
    # by sorted partitions, as those of the null ids may be large and only sorted ones are split
    near = leaves.withColumn("_at", block).join(
        directory.hint("merge"), F.col("grp").eqNullSafe(F.col("_grp")) & F.col("_at").eqNullSafe(F.col("_block"))
    )
    slot = f"bit_count(present & ~shiftleft(-1L, {word}))"
    rank = F.expr(f"before + counts[{slot}] + bit_count(words[{slot}] & ~shiftleft(-1L, {bit}))")
    names = leaves.columns
    plain = near.filter("NOT repeats").select(*names, rank.cast("bigint").alias("pos"), "total")
    if placed.filter("block IS NULL OR n <> ids").isEmpty():
        return plain
    several = near.filter("repeats").select(
        *names, "total", F.struct("grp", "_at").alias("_place"), F.col("before").alias("_earlier"), F.lit(1).alias("_one"),
        F.monotonically_increasing_id().alias("_row"),
    )
    ordered = prefix_sums(several, "_place", ["id", "digest", "_row"], "_one", "leaf-order")
    return plain.union(ordered.select(*names, (F.col("_earlier") + F.col("row_before")).alias("pos"), "total"))


def build(leaves: DataFrame) -> Manifest:
    """The manifest of leaves (grp, id, digest), whose further columns are kept with them.

    Per group the leaves ascend by id, null ids first. While a group has several nodes, every eight
    neighbours become one, the last run being shorter. What remains are the subroots, which give
    the root likewise, ordered by group, null first.
    """
    tiers, subroots = _reduced(positions(leaves))
    keyed = subroots.select(F.lit(0).alias("_all"), "grp", "digest", F.lit(1).alias("_one"))
    ordered = prefix_sums(keyed, "_all", ["grp"], "_one", "subroot-order")
    total = subroots.count()
    top, root = _reduced(
        ordered.select(F.lit(0).alias("grp"), F.col("grp").alias("of"), "digest", F.col("row_before").alias("pos"), F.lit(total).cast("bigint").alias("total"))
    )
    last = root.first()
    return Manifest(tiers, subroots, top, last["digest"] if last else None)


def _reduced(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The slot arrays of each tier, and (grp, digest) of each group's root, of nodes (grp, pos, total, digest).

    An array holds the nodes of 512 neighbouring positions, its key, so it is bounded whatever the
    group's size. Tiers follow until no group has more than one node.
    """
    tiers, roots = [], []
    while True:
        more = [name for name in nodes.columns if name not in ("grp", "pos", "total", "digest")]
        slots = nodes.groupBy("grp", F.expr(f"pos div {SLOTS}").alias("key"), "total").agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest", F.struct(F.lit(0).alias("_none"), *more).alias("carried")))).alias("slots")
        )
        arrays = slots.select(
            "grp", "key", "total", F.expr("transform(slots, s -> s.carried)").alias("carried"), F.expr("transform(slots, s -> s.digest)").alias("level0")
        )
        for level in range(LEVELS):
            arrays = arrays.withColumn(f"level{level + 1}", F.expr(_runs(f"level{level}")))
        # levels of this tier: those until one node is left, three at most
        needed = F.expr("CASE " + " ".join(f"WHEN total <= {FAN**k} THEN {k}" for k in range(LEVELS)) + f" ELSE {LEVELS} END")
        arrays = arrays.withColumn("levels", needed)
        digest = F.expr("CASE levels " + " ".join(f"WHEN {k} THEN level{k}[0]" for k in range(LEVELS + 1)) + " END")
        tier = written(arrays.withColumn("digest", digest).drop(f"level{LEVELS}"), "merkle-tier")
        tiers.append(tier)
        roots.append(tier.filter(f"total <= {SLOTS}").select("grp", "digest"))
        rest = tier.filter(f"total > {SLOTS}")
        if rest.isEmpty():
            break
        nodes = rest.select("grp", F.col("key").alias("pos"), F.expr(f"(total + {SLOTS - 1}) div {SLOTS}").alias("total"), "digest")
    found = roots[0]
    for others in roots[1:]:
        found = found.union(others)
    return tiers, found


def _runs(level: str) -> str:
    """The digests of every eight neighbours of an array."""
    return (
        f"transform(sequence(1, size({level}), {FAN}),"
        f" i -> sha2(array_join(slice({level}, i, {FAN}), ''), 256))"
    )


def _path(levels: str, at: str, above: str) -> str:
    """The siblings, left and right, of the slot `at` in each of the tier's levels, and those above them."""

    def siblings(k: int) -> str:
        shift = int(log2(FAN))
        place = f"shiftright({at}, {shift * k})"
        begin = f"(shiftright({at}, {shift * (k + 1)}) * {FAN})"
        left = f"array_join(slice(level{k}, {begin} + 1, {place} - {begin}), '')"
        right = f"array_join(slice(level{k}, {place} + 2, {begin} + {FAN - 1} - {place}), '')"
        return f"named_struct('left', {left}, 'right', {right})"

    own = " ".join(f"WHEN {n} THEN array({', '.join(siblings(k) for k in range(n))})" for n in range(1, LEVELS + 1))
    return f"concat(CASE {levels} {own} ELSE cast(array() AS {PATH}) END, {above})"


def proofs(manifest: Manifest) -> DataFrame:
    """(grp, digest, subroot, path) and the further columns of each leaf.

    `path` has for each level, from the leaf's up to the root's, the digests of the run's other nodes,
    joined, left and right of its own; `fold` gives the root by it. Paths go down the tiers, one
    for each array of slots.
    """
    top = _downward(manifest.top, None)
    above = top.select(F.col("of").alias("grp"), F.lit(0).cast("bigint").alias("pos"), F.col("digest").alias("subroot"), "path")
    return _downward(manifest.tiers, above)


def _downward(tiers: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """Each node of the lowest tier with its path; `above` has those of the groups' roots."""
    known = None
    for number, tier in reversed(list(enumerate(tiers))):
        # a group's paths come from above in the tier where it ends, else from one tier up
        sources = [(above, True), (known, False)]
        given = [paths.select("grp", "pos", "subroot", "path", F.lit(ends).alias("ends")) for paths, ends in sources if paths is not None]
        if given:
            paths = (given[0].union(given[1]) if len(given) > 1 else given[0]).toDF("_grp", "_pos", "subroot", "path", "_ends")
            place = F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("key") == F.col("_pos"))
            met = tier.join(paths, place & ((F.col("total") <= SLOTS) == F.col("_ends")))
        else:
            met = tier.withColumns({"path": F.expr(f"cast(array() AS {PATH})"), "subroot": F.lit(None).cast("string")})
        slot = f"struct(key * {SLOTS} + i AS pos, level0[i] AS digest, c AS carried, {_path('levels', 'i', 'path')} AS path)"
        nodes = met.select("grp", "subroot", F.expr(f"inline(transform(carried, (c, i) -> {slot}))"))
        if number == 0:
            kept = [f"carried.{name}" for name in tier.schema["carried"].dataType.elementType.names if name != "_none"]
            return nodes.select("grp", *kept, "digest", "subroot", "path")
        known = nodes
    raise ValueError("a manifest has at least one tier")


def joined_siblings(path: str = "path") -> Column:
    """The digests of all siblings, level by level, left to right."""
    return F.expr(f"array_join(transform({path}, p -> concat(p.left, p.right)), '')")


def fold(digest: str | Column, path: str = "path") -> Column:
    """The root that a leaf's digest and its path give."""
    start = F.col(digest) if isinstance(digest, str) else digest
    return F.aggregate(F.col(path), start, lambda own, p: F.sha2(F.concat(p["left"], own, p["right"]), 256))
