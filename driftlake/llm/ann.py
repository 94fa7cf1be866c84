"""Approximate nearest neighbours by a forest of random-projection trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlake.llm.scratch import ship

#: Trees; rows (about) that they are grown on; leaves of a tree that are tried, as long as a leaf has FEWEST rows of the
#: sample; queries of the sample that try them, and the share of their neighbours that must be found.
TREES, SAMPLE, LEAVES, FEWEST, TRIALS, RECALL = 3, 1 << 16, (64, 256, 1024, 4096), 16, 128, 0.98
#: Rows whose scoring costs as much as the way to one more leaf, about.
WAY = 50
#: Queries of a leaf answered in one task; more are dealt to several.
TOGETHER = 4096
#: Rows scored at once against these.
CHUNK = 1024


@dataclass
class Tree:
    """Inner nodes' planes and children; a child below 0 is leaf -child - 1."""

    planes: np.ndarray
    cuts: np.ndarray
    children: np.ndarray
    n_leaves: int


def grow(points: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    """Split at the median along the line between two random points until at most `leaf` points are left."""
    planes, cuts, children, leaves = [], [], [], 0
    todo = [(np.arange(len(points)), -1, 0)]
    while todo:
        at, parent, side = todo.pop()
        node = -leaves - 1
        if len(at) > leaf:
            a, b = rng.choice(at, 2, replace=False)
            plane = points[a] - points[b]
            along = points[at] @ plane
            cut = float(np.median(along))
            low = along < cut
            if low.any() and not low.all():
                node = len(planes)
                planes.append(plane / (np.linalg.norm(plane) or 1))
                cuts.append(cut / (np.linalg.norm(plane) or 1))
                children.append([0, 0])
                todo += [(at[low], node, 0), (at[~low], node, 1)]
        leaves += node < 0
        if parent >= 0:
            children[parent][side] = node
    return Tree(np.array(planes).reshape(len(planes), points.shape[1]), np.array(cuts), np.array(children, np.int64).reshape(-1, 2), leaves)


def leaf_of(tree: Tree, points: np.ndarray) -> np.ndarray:
    node = np.zeros(len(points), np.int64) if len(tree.cuts) else np.full(len(points), -1)
    while (inner := np.flatnonzero(node >= 0)).size:
        at = node[inner]
        side = (np.einsum("ij,ij->i", points[inner], tree.planes[at]) >= tree.cuts[at]).astype(np.int64)
        node[inner] = tree.children[at, side]
    return -node - 1


def visit(trees: list[Tree], query: np.ndarray, visits: int) -> list[tuple[int, int]]:
    """Leaves of all trees in the order of one queue: a leaf is as near as the furthest wrong turn on its path."""
    queue = [(0.0, t, 0 if len(tree.cuts) else -1) for t, tree in enumerate(trees)]
    sides = [tree.planes @ query - tree.cuts for tree in trees]
    out = []
    while queue and len(out) < visits:
        far, t, node = heapq.heappop(queue)
        while node >= 0:
            side = float(sides[t][node])
            right = int(side >= 0)
            heapq.heappush(queue, (max(far, abs(side)), t, int(trees[t].children[node, 1 - right])))
            node = int(trees[t].children[node, right])
        out.append((t, -node - 1))
    return out


def trial(trees: list[Tree], points: np.ndarray, queries: np.ndarray, k: int, recall: float) -> int:
    """The least number of leaves after which queries (places among points) have met so much of their k nearest, on the mean.

    Neighbours in a sample are further off than among all rows, so that the share among all is rather higher."""
    total = sum(t.n_leaves for t in trees)
    leaves = [leaf_of(t, points) for t in trees]
    met = []
    for i in queries:
        asked = np.r_[points[i, :-1], 0.0]
        near = points @ asked
        near[i] = -np.inf
        best = np.argsort(-near)[: min(k, len(points) - 1)]
        rank = {leaf: n for n, leaf in enumerate(visit(trees, asked, total))}
        met += [min(rank[t, int(own[j])] for t, own in enumerate(leaves)) for j in best]
    return int(np.sort(met)[max(0, int(np.ceil(recall * len(met))) - 1)]) + 1 if met else total


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """One more component gives all rows one length: the nearest by angle then has the largest inner product."""
    return np.c_[x, np.sqrt(np.maximum(0, longest**2 - (x * x).sum(1)))]


def _indexed(shared, dim: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, longest = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _lifted(_matrix(batch.column("vec"), dim), longest)
            for t, tree in enumerate(trees):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(points), t, np.int32)), pa.array(leaf_of(tree, points).astype(np.int32)), batch.column("id"), batch.column("copy"), batch.column("vec")], ["tree", "leaf", "id", "copy", "vec"])

    return go


def _visits(shared, dim: int, visits: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, _ = shared.value
        for batch in batches:
            for i, q in enumerate(_matrix(batch.column("vec"), dim) if batch.num_rows else ()):
                to = visit(trees, np.r_[q, 0.0], visits)
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in to], pa.int32()), pa.array([x[1] for x in to], pa.int32()), pa.array([batch.column("id")[i].as_py()] * len(to), pa.int64()), pa.array(np.zeros(len(to), np.int32)), pa.array([batch.column("vec")[i].as_py()] * len(to), pa.list_(pa.float64()))], ["tree", "leaf", "id", "copy", "vec"])

    return go


def _best(queries: np.ndarray, vectors: np.ndarray, q_ids: np.ndarray, ids: np.ndarray, copies: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The k nearest of ids to each query, with all that tie with the last; scores summed in one order everywhere."""
    near = queries @ vectors.T
    near[q_ids[:, None] == ids[None, :]] = -np.inf
    for i in range(len(queries)):
        row = near[i]
        least = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
        at = np.flatnonzero((row >= least - 1e-9) & (row > -np.inf))
        if len(at):
            yield np.full(len(at), q_ids[i]), ids[at], copies[at], (vectors[at] * queries[i]).sum(1)


def _answers(dim: int, k: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, q_ids, queries = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = np.stack([batch.column(c).to_numpy() for c in ("tree", "leaf", "part")], 1)
            ids, copies, row = batch.column("id").to_numpy(), batch.column("copy").to_numpy(), batch.column("row").to_numpy(zero_copy_only=False)
            vectors = _matrix(batch.column("vec"), dim)
            bounds = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]).any(1), True])
            out = []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if name != tuple(cells[lo]):
                    name, q_ids, queries = tuple(cells[lo]), [], []
                mid = lo + int((~row[lo:hi]).sum())
                q_ids += ids[lo:mid].tolist()
                queries += list(vectors[lo:mid])
                for at in range(mid, hi, CHUNK) if queries else ():
                    to = min(hi, at + CHUNK)
                    out += _best(np.array(queries), vectors[at:to], np.array(q_ids), ids[at:to], copies[at:to], k)
            q, v, c, s = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0))
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(c), pa.array(s)], ["query_id", "vec_id", "copy", "score"])

    return go


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", trees: int = TREES, sample: int = SAMPLE, leaves: int | None = None, visits: int | None = None, recall: float = RECALL, seed: int = 7) -> DataFrame:
    """Each query row's k rows of largest inner product found, itself left out.

    Trees split a sample (about `sample` rows, dealt by hash) along lines between two of its points; every row is
    indexed under its leaf in each tree. A query takes the nearest leaves of all trees from one priority queue
    and meets their rows by a join; all met are scored exactly, in double precision, and ranked (ties: smaller id). How many
    leaves a tree has, and how many a query visits, comes from trials on the sample: the cheapest of LEAVES with which TRIALS
    queries find `recall` of their neighbours there. Clustered vectors need few visits; those of independent components, the
    hardest case, about half of all leaves. `leaves` and `visits` fix both; a number of visits of all leaves is exact.

    Of equal vectors, which are numbered so that rows of one id stay apart, only the k + 1 of smallest ids can be answers, so the others stay out of the index, and a vector that
    a third of all rows have fills no leaf. Leaves that many queries visit are dealt out in parts.

    Rows take no part if their vector is null, zero, of another length than most, or holds a null, NaN or infinity, or if their
    id is null. Rows that repeat an id are rows of their own, and a query of another id meets them all (queries of one id
    ask together, and don't meet each other); no rows give no rows. Returns query_id,
    rank (from 1), vec_id, score.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), is_query.alias("asks"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(fine)
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    sizes = rows.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n"), F.max(square).alias("most")).orderBy(F.desc("n"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, longest = sizes["dim"], float(np.sqrt(sizes["most"]))
    rows = rows.where(F.size("vec") == dim)
    copies = Window.partitionBy(F.xxhash64("vec"), F.hash("vec")).orderBy("id")
    kept = rows.select("id", "vec").withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    share = min(1.0, sample / sizes["n"])
    seen = rows.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20)) < share * (1 << 20)).select("vec").toArrow()["vec"].combine_chunks()
    points = _lifted(_matrix(seen, dim), longest) if len(seen) else np.zeros((0, dim + 1))
    points = np.unique(points, axis=0)
    forest, visits = _forest(points, sizes["n"], k, trees, leaves, visits, recall, np.random.default_rng(seed))
    shared = spark.sparkContext.broadcast((forest, longest))
    schema = "tree int, leaf int, id long, copy int, vec array<double>"
    asked = rows.where("asks").select("id", "vec").mapInArrow(_visits(shared, dim, visits), schema)
    index = kept.mapInArrow(_indexed(shared, dim), schema)
    parts = asked.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / TOGETHER).cast("int").alias("parts"))
    to = asked.join(parts, ["tree", "leaf"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).withColumn("row", F.lit(False))
    of = index.join(parts, ["tree", "leaf"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("row", F.lit(True))
    met = to.unionByName(of).drop("parts").repartition(F.col("tree"), F.col("leaf"), F.col("part")).sortWithinPartitions("tree", "leaf", "part", "row")
    found = met.mapInArrow(_answers(dim, k), "query_id long, vec_id long, copy int, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _forest(points: np.ndarray, n: int, k: int, trees: int, leaves: int | None, visits: int | None, recall: float, rng: np.random.Generator) -> tuple[list[Tree], int]:
    """The trees, and how many leaves a query visits: as told, or the cheapest of those tried for n rows."""
    grown = lambda count: [grow(points, max(1, -(-len(points) // count)), rng) for _ in range(trees)]
    if leaves and visits:
        return grown(leaves), visits
    queries = rng.choice(len(points), min(TRIALS, len(points)), replace=False) if len(points) else []
    best = None
    for count in (leaves,) if leaves else LEAVES:
        if best and len(points) < FEWEST * count:
            break
        forest = grown(count)
        need = max(trees, visits or trial(forest, points, queries, k, recall))
        price = need * (n / count + WAY)
        if best is None or price < best[0]:
            best = (price, forest, need)
    return best[1], best[2]
