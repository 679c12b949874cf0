"""Nearest neighbours by inner product: a vantage-point tree for each shard of the vectors."""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

SHARD_ROWS = 8192
QUERY_ROWS = 4096
#: A length of vectors has so many centres at most, and so many lengths have any, the commonest ones.
CENTRES = 256
LENGTHS = 16
LEAF = 128
#: Lower bounds are compared with this part of the distance of the worst kept: 1 is exact, less is faster.
FACTOR = 1.0
#: Distinct vectors kept beyond what is asked for, until scores are added up in their final order.
SPARE = 4
#: Scores this close, as a part of the squared norms, may be ties that rounding has parted.
ROUNDING = 1e-7


def usable(vectors: DataFrame, name: str = "embedding") -> DataFrame:
    """(row, vec_id, vector): rows with an id and finite components that are not all zero, in double precision.

    `row` is a number that no two rows share, as ids may repeat; written, so it stays what it is.
    """
    vector = F.col(name).cast("array<double>")
    rows = (
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector"))
        .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .filter(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        .filter(F.exists("vector", lambda x: x != 0))
    )
    return written(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector"), "vectors")


@dataclass
class Index:
    """`trees` has (length, cell, shard, tree, nearest, farthest, longest); `centres` those of the cells of a length.

    A cell holds the vectors nearest to its centre. `nearest` and `farthest` are distances of a shard's
    vectors from that centre, one more coordinate giving them all the squared norm `longest`, as in its tree.
    """

    trees: DataFrame
    centres: dict[int, np.ndarray]


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> Index:
    """The rows of `usable`, each in one tree of about `shard_rows` at most.

    Only vectors of the same length have an inner product, so a tree has vectors of one length. Where a
    length fills several shards, its vectors are dealt by the nearest of as many centres, up to
    `CENTRES`: vectors chosen by the hash of their row. A cell of more rows than a shard, such as one
    with many copies of a vector, is dealt to several by hash.
    """
    lengths = vectors.groupBy(F.size("vector").alias("length")).count().filter(F.col("count") > shard_rows)
    commonest = lengths.orderBy(F.desc("count"), "length").limit(LENGTHS).collect()
    centres = {}
    for length, rows in commonest:
        some = vectors.filter(F.size("vector") == length).orderBy(F.xxhash64("row"), "row").limit(min(CENTRES, -(-rows // shard_rows)))
        centres[length] = np.unique(np.array([r.vector for r in some.select("vector").collect()], float), axis=0)

    def to_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = np.zeros(len(batch), np.int32)
            for own, rows, points in _by_length(batch, centres):
                cells[own] = np.argmin((points**2).sum(axis=1) - 2 * (rows @ points.T), axis=1)
            yield batch.assign(length=batch["vector"].map(len), cell=cells)

    # written, as a repeated task might add up products in another order
    celled = written(vectors.mapInPandas(to_cells, "row bigint, vec_id bigint, vector array<double>, length int, cell int"), "vp-cells")
    sizes = celled.groupBy("length", "cell").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("parts"))
    dealt = celled.join(sizes, ["length", "cell"]).withColumn("shard", F.pmod(F.xxhash64("row"), "parts").cast("int"))
    schema = "length int, cell int, shard int, tree binary, nearest double, farthest double, longest double"
    trees = dealt.groupBy("length", "cell", "shard").applyInPandas(lambda rows: _built(rows, centres), schema)
    return Index(written(trees, "vp-trees"), centres)


def _by_length(batch: pd.DataFrame, centres: dict[int, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positions and vectors of each length that has centres, and these."""
    lengths = batch["vector"].map(len).to_numpy()
    for length, points in centres.items():
        own = np.flatnonzero(lengths == length)
        if len(own):
            yield own, np.stack(batch["vector"].iloc[own].to_numpy()).astype(float), points


def _built(rows: pd.DataFrame, centres: dict[int, np.ndarray]) -> pd.DataFrame:
    first, vectors = rows.iloc[0], np.stack(rows["vector"].to_numpy())
    tree = Tree.build(rows["row"].to_numpy(np.int64), rows["vec_id"].to_numpy(np.int64), vectors)
    nearest, farthest = 0.0, np.inf
    if first["length"] in centres:
        beyond = np.maximum(0, tree.longest - (vectors**2).sum(axis=1))
        away = np.sqrt(((vectors - centres[first["length"]][first["cell"]]) ** 2).sum(axis=1) + beyond)
        nearest, farthest = away.min(), away.max()
    place = {name: [first[name]] for name in ("length", "cell", "shard")}
    return pd.DataFrame({**place, "tree": [tree.dump()], "nearest": nearest, "farthest": farthest, "longest": tree.longest})


class Tree:
    """Distinct vectors with their ids, and nodes that split them by their distance from a vantage point.

    Inner products become distances by one more coordinate, which gives all vectors the norm of the
    longest and queries none: then the nearest is the one with the largest product.
    """

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        for name, value in arrays.items():
            setattr(self, name, value)
        self.longest = float((self.vectors**2).sum(axis=1).max())

    @classmethod
    def build(cls, numbers: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> Tree:
        order = np.lexsort((numbers, ids, *rows.T[::-1]))
        numbers, ids, rows = numbers[order], ids[order], np.ascontiguousarray(rows[order])
        new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
        starts = np.flatnonzero(new)
        vectors, firsts = rows[starts], np.append(starts, len(ids))
        norms = (vectors**2).sum(axis=1)
        wide = np.column_stack([vectors, np.sqrt(np.maximum(0, norms.max() - norms))])
        places, nodes = np.arange(len(vectors)), []
        # a node: vantage point, first and last place, inner and outer child, and their distances' ranges
        waiting = [(0, len(vectors))]
        spans, chance = [], np.random.default_rng(9)
        while waiting:
            low, high = waiting.pop()
            number = len(nodes)
            nodes.append([-1, low, high, -1, -1])
            spans.append([0.0] * 4)
            if high - low <= LEAF:
                continue
            some = places[chance.integers(low, high, 8)]
            far = [np.var(np.linalg.norm(wide[places[low:high:8]] - wide[p], axis=1)) for p in some]
            point = some[int(np.argmax(far))]
            distance = np.linalg.norm(wide[places[low:high]] - wide[point], axis=1)
            middle = (high - low) // 2
            split = np.argpartition(distance, middle)
            places[low:high], distance = places[low:high][split], distance[split]
            near, beyond = distance[:middle], distance[middle:]
            nodes[number][0] = point
            spans[number] = [near.min(), near.max(), beyond.min(), beyond.max()]
            waiting += [(low, low + middle), (low + middle, high)]
        cls._link(nodes)
        return cls(
            {
                "numbers": numbers, "ids": ids, "firsts": firsts, "vectors": vectors[places], "owners": places,
                "points": vectors[[max(0, n[0]) for n in nodes]],
                "nodes": np.array(nodes, np.int64), "spans": np.array(spans, float),
            }
        )

    @staticmethod
    def _link(nodes: list[list[int]]) -> None:
        """Children by their ranges of places."""
        by_range = {(n[1], n[2]): k for k, n in enumerate(nodes)}
        for n in nodes:
            if n[0] >= 0:
                middle = n[1] + (n[2] - n[1]) // 2
                n[3], n[4] = by_range[n[1], middle], by_range[middle, n[2]]

    def dump(self) -> bytes:
        file = io.BytesIO()
        np.savez(file, **self.arrays)
        return file.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Tree:
        with np.load(io.BytesIO(raw)) as arrays:
            return cls(dict(arrays))

    def search(
        self, numbers: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int, factor: float
    ) -> Iterator[tuple[int, int, int, float]]:
        """(query's row, row, id, score) of the k best of this shard for each query, its own row left out.

        Scores below a query's floor need not be found.

        Where the worst kept is within rounding of the k-th, others that tie may be missing, and the
        query is compared with all vectors of the shard.
        """
        keep = min(k + 1 + SPARE, len(self.vectors))
        best = np.full((len(queries), keep), -np.inf)
        where = np.zeros((len(queries), keep), np.int64)
        norms = (queries**2).sum(axis=1) + self.longest

        def visit(number: int, some: np.ndarray, bound: np.ndarray) -> None:
            # the distance of the worst kept; infinite until enough are kept
            least = np.maximum(best[some].min(axis=1), floors[some] - ROUNDING * norms[some])
            worst = np.sqrt(np.maximum(0, norms[some] - 2 * least))
            some = some[bound <= factor * worst * (1 + 1e-9) + 1e-9]
            if not len(some):
                return
            point, low, high, inner, outer = self.nodes[number]
            if point < 0:
                scores = np.column_stack([best[some], queries[some] @ self.vectors[low:high].T])
                places = np.column_stack([where[some], np.broadcast_to(np.arange(low, high), (len(some), high - low))])
                top = np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
                best[some], where[some] = np.take_along_axis(scores, top, 1), np.take_along_axis(places, top, 1)
                return
            distance = np.sqrt(np.maximum(0, norms[some] - 2 * (queries[some] @ self.points[number])))
            a, b, c, d = self.spans[number]
            to_inner = np.maximum(0, np.maximum(a - distance, distance - b))
            to_outer = np.maximum(0, np.maximum(c - distance, distance - d))
            first_inner = to_inner <= to_outer
            visit(inner, some[first_inner], to_inner[first_inner])
            visit(outer, some, to_outer)
            visit(inner, some[~first_inner], to_inner[~first_inner])

        visit(0, np.arange(len(queries)), np.zeros(len(queries)))
        for q in range(len(queries)):
            kept = where[q][np.isfinite(best[q])]
            scores = products(queries[q], self.vectors[kept])
            found = []
            for place, score in zip(kept, scores, strict=True):
                owner = self.owners[place]
                same = slice(self.firsts[owner], min(self.firsts[owner + 1], self.firsts[owner] + k + 1))
                pairs = zip(self.ids[same].tolist(), self.numbers[same].tolist(), strict=True)
                found += [(-score, i, n) for i, n in pairs if n != numbers[q]]
            found = sorted(found)[:k]
            if found and keep < len(self.vectors) and best[q].min() >= -found[-1][0] - ROUNDING * norms[q]:
                found = self._all(numbers[q], queries[q], k)
            yield from ((numbers[q], n, i, -score) for score, i, n in found)

    def _all(self, number: int, query: np.ndarray, k: int) -> list[tuple[float, int, int]]:
        """(negative score, id, row) of the k best of all vectors, by score, id and row."""
        by_owner = np.empty(len(self.vectors))
        by_owner[self.owners] = products(query, self.vectors)
        scores = np.repeat(by_owner, np.diff(self.firsts))
        others = np.flatnonzero(self.numbers != number)
        best = others[np.lexsort((self.numbers[others], self.ids[others], -scores[others]))[:k]]
        return [(-float(scores[i]), int(self.ids[i]), int(self.numbers[i])) for i in best]


def products(query: np.ndarray, vectors: np.ndarray) -> list[float]:
    """Inner products added up from the first component to the last, the same for equal vectors."""
    total = np.zeros(len(vectors))
    for d in range(len(query)):
        total = total + query[d] * vectors[:, d]
    return total.tolist()


def search(index: Index, queries: DataFrame, k: int, factor: float = FACTOR) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner products for each of some rows of `usable`.

    A query first meets the cell whose centre has the largest product with it. The k-th score found
    there is its floor, and it goes on to those cells only that may hold a better one by the triangle
    inequality over centre, query and the cell's range of distances. A shard gives its k best for a
    query, and the k best of those stay. Every other row of that length is a candidate, also those
    that repeat the query's id or vector; equal scores go by smaller vec_id. Queries that share an id are
    answered each. With fewer candidates than k, all of them are given; without queries or vectors, none.
    A factor of 1 gives the exact result, a smaller one prunes a branch or cell though it may hold a neighbour.
    """
    centres = index.centres
    asked = "row bigint, vector array<double>, length int, cell int, floor double"

    def home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = np.zeros(len(batch), np.int32)
            for own, rows, points in _by_length(batch, centres):
                cells[own] = np.argmax(rows @ points.T, axis=1)
            yield batch.assign(length=batch["vector"].map(len), cell=cells, floor=-np.inf)

    first = written(queries.select("row", "vector").mapInPandas(home, asked), "vp-queries")
    found = _met(index, first, k, factor)
    if centres:
        found = written(_best(found, k).drop("rank"), "vp-found")
        kth = found.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")).filter(F.col("n") == k)
        floored = first.join(kth, first["row"] == kth["query"], "left").select(
            "row", "vector", "length", "cell", F.coalesce("kth", "floor").alias("floor")
        )
        further = floored.mapInPandas(_further(_ranges(index), centres, factor), asked)
        found = found.unionByName(_met(index, written(further, "vp-queries"), k, factor))
    ids = queries.select(F.col("row").alias("_row"), F.col("vec_id").alias("query_id"))
    return _best(found, k).join(ids, F.col("query") == F.col("_row")).select("query_id", "rank", "vec_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    ranked = found.selectExpr(
        "*", "CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id, row) AS int) AS rank"
    )
    return ranked.filter(F.col("rank") <= k)


def _ranges(index: Index) -> dict[int, np.ndarray]:
    """Of each length with centres, the nearest, farthest and longest of its cells, at most `LENGTHS * CENTRES` rows."""
    ranges = {length: np.tile([np.inf, 0.0, 0.0], (len(points), 1)) for length, points in index.centres.items()}
    # shards of a cell give their vectors different norms; each bound here is at most that of any of them
    of = index.trees.filter(F.col("length").isin(*index.centres)).groupBy("length", "cell")
    for length, cell, *seen in of.agg(F.min("nearest"), F.max("farthest"), F.max("longest")).collect():
        ranges[length][cell] = seen
    return ranges


def _further(ranges: dict[int, np.ndarray], centres: dict[int, np.ndarray], factor: float):
    """Queries once for each other cell that may hold scores above their floor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for own, rows, points in _by_length(batch, centres):
                nearest, farthest, longest = ranges[rows.shape[1]].T
                squares = (rows**2).sum(axis=1)[:, None]
                away = np.sqrt(np.maximum(0, squares + (points**2).sum(axis=1) - 2 * (rows @ points.T)))
                bound = np.maximum(0, np.maximum(nearest - away, away - farthest))
                norms = squares + longest
                floors = batch["floor"].to_numpy()[own][:, None] - ROUNDING * norms
                worst = np.sqrt(np.maximum(0, norms - 2 * floors)) + ROUNDING * np.sqrt(norms)
                goes = ~(bound > factor * worst) & np.isfinite(nearest)
                goes[np.arange(len(own)), batch["cell"].to_numpy()[own]] = False
                # a cell at a time, which bounds what is sent at once
                for cell in np.flatnonzero(goes.any(axis=0)):
                    yield batch.iloc[own[goes[:, cell]]].assign(cell=np.int32(cell))

    return run


def _met(index: Index, asked: DataFrame, k: int, factor: float) -> DataFrame:
    """(query, row, vec_id, score): the k best of each shard of the cells that queries are sent to.

    Queries come in blocks of about `QUERY_ROWS` at most, and a block meets each shard of its cell.
    """
    parts = max(1, -(-asked.select("row").distinct().count() // QUERY_ROWS))
    block = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    blocks = asked.groupBy("length", "cell", block.alias("block")).agg(
        F.collect_list(F.struct("row", "vector", "floor")).alias("queries")
    )
    met = blocks.join(index.trees.select("length", "cell", "shard", "tree"), ["length", "cell"])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0]
        numbers = np.array([q["row"] for q in row["queries"]], np.int64)
        vectors = np.array([np.asarray(q["vector"], float) for q in row["queries"]])
        floors = np.array([q["floor"] for q in row["queries"]], float)
        found = list(Tree.load(row["tree"]).search(numbers, vectors, floors, k, factor))
        return pd.DataFrame(found, columns=["query", "row", "vec_id", "score"])

    return met.groupBy("length", "cell", "shard", "block").applyInPandas(run, "query bigint, row bigint, vec_id bigint, score double")
