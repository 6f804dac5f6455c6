"""Nearest neighbours by largest inner product: a hierarchical k-means tree, searched best bin first.

Vectors get one more component, ``sqrt(M^2 - |x|^2)`` with M the largest norm of all, so that the largest inner product is the
smallest distance. The tree is fitted to a bounded sample; every vector then goes down to its leaf. A query walks the tree
with a priority queue of nodes by distance and visits leaves in that order; how many is calibrated: for a sample of queries the
exact neighbours are found among all vectors, and the visits are widened until the leaves hold ``TARGET_RECALL`` of them.
A query whose leaves hold too few vectors for an answer goes on to further ones, to all of them if need be.

Leaves are cut into blocks of bounded size, queries of a leaf likewise, and each pair of blocks is one matrix product. Equal
vectors stand in for each other: of one vector only the smallest ids can be among the nearest, and equal queries are searched
once.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_batches

#: bounds of the fit
SAMPLE_VECTORS, CALIBRATION_QUERIES = 16_384, 128
BRANCHES, LEAST_LEAVES, MOST_LEAVES, LEAF_VECTORS = 8, 64, 1024, 1000
TARGET_RECALL = 0.95
BLOCK = 1024


@dataclass
class Node:
    centre: np.ndarray
    children: list[Node] = field(default_factory=list)
    leaf: int = -1


@dataclass
class Tree:
    root: Node
    leaves: int
    reach: float  # the largest norm

    def extended(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.reach**2 - (vectors**2).sum(axis=1), 0.0))
        return np.column_stack([vectors, rest])

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child at every level."""
        points, out = self.extended(vectors), np.zeros(len(vectors), np.int32)
        open_nodes = [(self.root, np.arange(len(points)))]
        while open_nodes:
            node, rows = open_nodes.pop()
            if not node.children:
                out[rows] = node.leaf
            elif len(rows):
                nearest = _distances(points[rows], np.stack([c.centre for c in node.children])).argmin(axis=1)
                open_nodes += [(child, rows[nearest == i]) for i, child in enumerate(node.children)]
        return out

    def order(self, query: np.ndarray, visits: int, sizes: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first ``visits`` leaves, best bin first; more if they hold less than ``least`` vectors by the ``sizes`` of leaves."""
        point = np.append(query, 0.0)[None, :]
        heap, found, ticket, held = [(0.0, 0, self.root)], [], 0, 0
        while heap and (len(found) < visits or held < least):
            _, _, node = heapq.heappop(heap)
            if not node.children:
                found.append(node.leaf)
                held += 0 if sizes is None else int(sizes[node.leaf])
                continue
            gaps = _distances(point, np.stack([c.centre for c in node.children]))[0]
            for child, gap in zip(node.children, gaps.tolist()):
                ticket += 1
                heapq.heappush(heap, (gap, ticket, child))
        return found


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared, up to a term of the point alone."""
    return (centres**2).sum(axis=1) - 2.0 * (points @ centres.T)


def _split(points: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    centres = points[random.choice(len(points), BRANCHES, replace=False)]
    for _ in range(10):
        own = _distances(points, centres).argmin(axis=1)
        for i in range(BRANCHES):
            if (own == i).any():
                centres[i] = points[own == i].mean(axis=0)
    return centres, _distances(points, centres).argmin(axis=1)


def grow(sample: np.ndarray, reach: float, leaves: int) -> Tree:
    """A tree with about ``leaves`` leaves."""
    tree = Tree(Node(np.zeros(sample.shape[1] + 1)), 0, reach)
    random, most = np.random.default_rng(0), max(len(sample) // leaves, 1)
    points = tree.extended(sample)
    open_nodes = [(tree.root, np.arange(len(points)))]
    while open_nodes:
        node, rows = open_nodes.pop()
        if len(rows) > max(most * 1.5, BRANCHES):
            centres, own = _split(points[rows], random)
            kept = [i for i in range(BRANCHES) if (own == i).any()]
            if len(kept) > 1:
                node.children = [Node(centres[i]) for i in kept]
                open_nodes += [(child, rows[own == i]) for child, i in zip(node.children, kept)]
                continue
        node.leaf, tree.leaves = tree.leaves, tree.leaves + 1
    return tree


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: vectors without null or non-finite components that are not zero; of unlike lengths, the commonest."""
    fine = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    common = fine.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return fine.where(F.size("v") == (common["n"] if common else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column (each row a vector) as a matrix."""
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _best(scores: np.ndarray, ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray, keep: int):
    """For each query ``(position, ids, scores)`` of its ``keep`` best; scores are summed anew, the same way wherever they come up."""
    for i, row in enumerate(scores):
        if len(row) > keep:
            least = np.partition(row, len(row) - keep)[len(row) - keep]
            chosen = np.flatnonzero(row >= least - 1e-9 * (1.0 + abs(least)))
        else:
            chosen = np.arange(len(row))
        exact = (vectors[chosen] * queries[i]).sum(axis=1)
        first = np.lexsort((ids[chosen], -exact))[:keep]
        yield i, ids[chosen][first], exact[first]


_FOUND = "query long, vec_id long, score double"


def _found(pieces: list[tuple]) -> pa.RecordBatch:
    empty = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    columns = [np.concatenate(x) for x in zip(*(pieces or empty))]
    return pa.record_batch({"query": columns[0], "vec_id": columns[1], "score": columns[2]})


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)


def exact_neighbours(vectors: DataFrame, queries: list[tuple[int, np.ndarray]], keep: int) -> DataFrame:
    """``query, vec_id, score, rank`` of the given (few) queries among all vectors, themselves included."""
    if not queries:
        return vectors.sparkSession.createDataFrame([], _FOUND + ", rank int")
    names, points = np.array([q for q, _ in queries]), np.stack([v for _, v in queries])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, matrix = np.asarray(batch.column("vec_id")), _matrix(batch.column("v"))
        return _found([(np.full(len(i), names[at]), i, s) for at, i, s in _best(points @ matrix.T, ids, matrix, points, keep)])

    return _ranked(map_batches(vectors.select("vec_id", "v"), run, _FOUND, 4096), keep)


def calibrate(tree: Tree, vectors: DataFrame, queries: list[tuple[int, np.ndarray]], k: int, target: float = TARGET_RECALL) -> int:
    """The fewest leaf visits that reach the target on the given queries, against all vectors."""
    truth = exact_neighbours(vectors, queries, k + 1).join(vectors, "vec_id").select("query", "vec_id", "v").collect()
    if not truth:
        return tree.leaves
    leaf = tree.assign(np.array([r.v for r in truth]))
    place = {q: {leaf: i for i, leaf in enumerate(tree.order(v, tree.leaves))} for q, v in queries}
    visits = np.sort([place[r.query][int(at)] + 1 for r, at in zip(truth, leaf)])
    return int(visits[min(int(np.ceil(target * len(visits))), len(visits)) - 1])


def _points(frame: DataFrame, most: int) -> list[tuple[int, np.ndarray]]:
    """The ``most`` rows of smallest hash."""
    rows = frame.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).select("vec_id", "v").collect()
    return [(r.vec_id, np.array(r.v)) for r in rows]


def _leaf_sizes(frame: DataFrame) -> DataFrame:
    """``leaf, n``: the rows of each leaf; no more leaves than the sample has vectors."""
    return frame.groupBy("leaf").agg(F.count("*").alias("n"))


def _leaf_blocks(frame: DataFrame, sizes: DataFrame, name: str, salt: int) -> DataFrame:
    """``leaf, ids, vs``: the rows of each leaf in blocks of about ``BLOCK``."""
    blocks = sizes.select("leaf", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    return (
        frame.join(F.broadcast(blocks), "leaf")
        .groupBy("leaf", F.expr(f"pmod(xxhash64({salt}, vec_id), blocks)").alias("block"))
        .agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
        .select("leaf", F.col("rows.vec_id").alias(f"{name}_ids"), F.flatten("rows.v").alias(f"{name}_v"))
    )


def search(vectors: DataFrame, is_query, k: int = 20, target: float = TARGET_RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row that ``is_query`` picks, itself left out.

    ``vectors`` has ``vec_id`` and ``embedding``. Null, zero and non-finite vectors, and rows without an id, take no part; a
    repeated (id, vector) counts once. Ties go to the smaller id; with at most ``k`` candidates all come back. An empty table
    gives no rows.
    """
    alike = Window.partitionBy("v").orderBy("vec_id")
    distinct = usable(vectors).dropDuplicates(["vec_id", "v"])
    # k + 1 of one vector are enough: its other copies come after them everywhere
    kept = materialize(distinct.withColumn("copy", F.row_number().over(alike)).where(F.col("copy") <= k + 1), "vectors")
    asked = materialize(distinct.where(is_query).select("vec_id", "v", F.xxhash64("v").alias("hash")), "queries")
    asks = asked.groupBy("v").agg(F.min("vec_id").alias("vec_id"))
    size = kept.agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("reach")).first()
    if not size.n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.stack([v for _, v in _points(kept, SAMPLE_VECTORS)])
    tree = grow(sample, size.reach, min(max(LEAST_LEAVES, size.n // LEAF_VECTORS), MOST_LEAVES))
    visits = calibrate(tree, kept.select("vec_id", "v"), _points(asks, CALIBRATION_QUERIES), k, target)

    def to_leaf(batch: pa.RecordBatch) -> pa.RecordBatch:
        leaf = tree.assign(_matrix(batch.column("v"))) if batch.num_rows else np.zeros(0, np.int32)
        return pa.record_batch([*batch.columns, pa.array(leaf, pa.int32())], names=["vec_id", "v", "leaf"])

    def to_leaves(batch: pa.RecordBatch) -> pa.RecordBatch:
        leaves = [tree.order(v, visits, held, k + 1) for v in _matrix(batch.column("v"))] if batch.num_rows else []
        return pa.record_batch([*batch.columns, pa.array(leaves, pa.list_(pa.int32()))], names=["vec_id", "v", "leaves"])

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        pieces = []
        for row in range(batch.num_rows):
            asked_ids, asked_v, ids, v = (np.asarray(batch.column(c)[row].values) for c in ("q_ids", "q_v", "c_ids", "c_v"))
            points, matrix = asked_v.reshape(len(asked_ids), -1), v.reshape(len(ids), -1)
            pieces += [(np.full(len(i), asked_ids[at]), i, s) for at, i, s in _best(points @ matrix.T, ids, matrix, points, k + 1)]
        return _found(pieces)

    placed = map_batches(kept.select("vec_id", "v"), to_leaf, "vec_id long, v array<double>, leaf int", 4096)
    sizes = materialize(_leaf_sizes(placed), "leaf_sizes")
    held = np.zeros(tree.leaves, np.int64)
    for row in sizes.collect():
        held[row.leaf] = row.n
    routed = map_batches(asks.select("vec_id", "v"), to_leaves, "vec_id long, v array<double>, leaves array<int>", 4096)
    routed = routed.select("vec_id", "v", F.explode("leaves").alias("leaf"))
    asking = _leaf_blocks(routed, _leaf_sizes(routed), "q", 1)
    pairs = asking.join(_leaf_blocks(placed, sizes, "c", 2), "leaf").select("q_ids", "q_v", "c_ids", "c_v")
    nearest = _ranked(map_batches(pairs, compare, _FOUND, 8), k + 1).select("query", "vec_id", "score")

    # back from distinct query vectors to all queries
    names = asks.select(F.col("v").alias("ask_v"), F.col("vec_id").alias("query"))
    answered = (
        asked.select(F.col("vec_id").alias("query_id"), "v")
        .join(names, F.col("v") == F.col("ask_v"))
        .select("query_id", "query")
        .join(nearest, "query")
        .where("query_id <> vec_id")
    )
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answered.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
