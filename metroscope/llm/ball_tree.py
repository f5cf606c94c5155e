"""Exact search for the highest inner products: ball trees per shard, branch and bound, rounds that share bounds.

Vectors are dealt into shards of ``shard_rows``; each becomes a ball tree, one row of a table. A node is a ball
(centre, radius) around its vectors, so no vector in it scores above

    q . centre + |q| radius

Queries travel in blocks. A block searches a shard level by level: a node whose bound is below a query's k-th score so far is
left out with all below it; each query then takes the leaves in the order of their bounds, raising its k-th score as it goes. Shards are
searched in rounds, 1, 1, 2, 4, ... of them per block: after a round the best of all shards so far are merged, and their k-th scores
bound the next round. So later shards send only rows that may still belong to the result. Scores are whole numbers: they are
exact as floats below 2**53, as 64-bit integers below 2**63, and as Python integers beyond.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import staged

SHARD_ROWS = 1 << 14
BLOCK_QUERIES = 1 << 10
LEAF_ROWS = 128
FOUND = "query long, query_id long, score long, row long, vec_id long"


def _saved(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _loaded(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as found:
        return {k: found[k] for k in found.files}


def _compact(vectors: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes as hold them."""
    most = np.abs(vectors).max(initial=0)
    return vectors.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.float64)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of whole numbers held as floats: exact, clipped to 64 bits at the very end."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    if most < 2.0**63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = [[int(x) for x in row] for row in b]
    return np.array([[max(-(1 << 63), min((1 << 63) - 1, sum(int(x) * y for x, y in zip(row, other)))) for other in whole] for row in a], dtype=np.int64).reshape(len(a), len(b))


def bounds_of_levels(n: int, leaf_rows: int) -> list[np.ndarray]:
    """Where the nodes of each level begin and end among n rows: halves of halves, until a node holds ``leaf_rows`` at most."""
    levels = [np.array([0, n])]
    while max(np.diff(levels[-1])) > leaf_rows:
        edges = levels[-1]
        levels.append(np.sort(np.concatenate((edges, (edges[:-1] + edges[1:]) // 2))))
    return levels


def build_tree(vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(order of the rows, centres per level, radii per level). A node is halved at the median along the line between two far points of it."""
    order, levels = np.arange(len(vectors)), bounds_of_levels(len(vectors), leaf_rows)
    centres, radii = [], []
    for depth, edges in enumerate(levels):
        own_centres, own_radii = np.zeros((len(edges) - 1, vectors.shape[1])), np.zeros(len(edges) - 1)
        for k, (first, last) in enumerate(zip(edges[:-1], edges[1:])):
            if first == last:
                continue
            points = vectors[order[first:last]]
            centre = points.mean(axis=0)
            away = np.linalg.norm(points - centre, axis=1)
            own_centres[k], own_radii[k] = centre, away.max()
            if depth + 1 < len(levels):
                one = points[away.argmax()]
                other = points[np.linalg.norm(points - one, axis=1).argmax()]
                middle = (first + last) // 2 - first
                if 0 < middle < len(points):
                    order[first:last] = order[first:last][np.argpartition(points @ (other - one), middle)]
        centres.append(own_centres)
        radii.append(own_radii)
    return order, centres, radii


class Best:
    """The k best rows of each query so far; ``floor`` is the score that a row must reach to matter."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.score, self.unnamed = np.zeros((queries, 0), np.int64), np.zeros((queries, 0), bool)
        self.vec_id, self.row = np.zeros((queries, 0), np.int64), np.zeros((queries, 0), np.int64)
        self.real = np.zeros((queries, 0), bool)

    def add(self, at: np.ndarray, score: np.ndarray, vec_id: np.ndarray, unnamed: np.ndarray, row: np.ndarray, real: np.ndarray) -> None:
        """Candidates (shared by the queries ``at``) with their scores; ``real`` marks those that count for a query."""
        real = real & (score >= self.floor[at][:, None])
        useful = real.any(axis=1)
        if not useful.any():
            return
        at, score, real = at[useful], score[useful], real[useful]
        wide = lambda x: np.broadcast_to(x, score.shape)
        joined = [np.concatenate((old[at], new), axis=1) for old, new in (
            (self.score, score), (self.unnamed, wide(unnamed)), (self.vec_id, wide(vec_id)), (self.row, wide(row)), (self.real, real))]
        score, unnamed, vec_id, row, real = joined
        best = np.lexsort((row, vec_id, unnamed, ~score, ~real), axis=1)[:, : self.k]
        if best.shape[1] > self.score.shape[1]:
            more = best.shape[1] - self.score.shape[1]
            for name in ("score", "unnamed", "vec_id", "row", "real"):
                own = getattr(self, name)
                setattr(self, name, np.concatenate((own, np.zeros((len(own), more), own.dtype)), axis=1))
        for name, found in zip(("score", "unnamed", "vec_id", "row", "real"), joined):
            taken = np.take_along_axis(found, best, axis=1)
            getattr(self, name)[at, : taken.shape[1]] = taken
        if self.score.shape[1] == self.k:
            full = at[self.real[at, self.k - 1]]
            self.floor[full] = np.maximum(self.floor[full], self.score[full, self.k - 1])


def search(tree: dict[str, np.ndarray], queries: np.ndarray, rows: np.ndarray, floor: np.ndarray, k: int) -> Best:
    """The k best rows of a tree for each query that reach its ``floor``; a query's own row is no candidate."""
    vectors, found = tree["vectors"].astype(np.float64), Best(len(queries), k, floor)
    depth = int(tree["depth"][0])
    length = np.linalg.norm(queries, axis=1)
    bound = np.full((len(queries), 1), np.inf)
    for level in range(depth):
        centres, radii = tree[f"centres{level}"], tree[f"radii{level}"]
        if level:
            bound = np.repeat(bound, 2, axis=1)
        # Nodes that no query may need are not looked at.
        open_nodes = np.flatnonzero((bound >= found.floor[:, None]).any(axis=0))
        own = queries @ centres[open_nodes].T + length[:, None] * radii[open_nodes]
        own += 1e-9 * (length[:, None] * (np.linalg.norm(centres[open_nodes], axis=1) + radii[open_nodes])) + 1e-6
        tighter = np.full_like(bound, -np.inf)
        tighter[:, open_nodes] = np.minimum(bound[:, open_nodes], np.where(np.isnan(own), np.inf, own))
        bound = tighter
    edges = bounds_of_levels(len(vectors), int(tree["leaf_rows"][0]))[-1]
    order = np.argsort(-bound, axis=1, kind="stable")
    done, step = 0, 1
    while done < order.shape[1]:
        # The next leaves of each query, best bound first; twice as many each time.
        turn = order[:, done : done + step]
        useful = np.take_along_axis(bound, turn, axis=1) >= found.floor[:, None]
        if not useful.any():
            break
        at, leaf = np.repeat(np.arange(len(queries)), turn.shape[1])[useful.ravel()], turn[useful]
        by_leaf = np.argsort(leaf, kind="stable")
        at, leaf = at[by_leaf], leaf[by_leaf]
        for own in np.split(np.arange(len(leaf)), np.flatnonzero(np.diff(leaf)) + 1):
            asking, (first, last) = at[own], edges[leaf[own[0]] : leaf[own[0]] + 2]
            score = inner_products(queries[asking], vectors[first:last])
            found.add(asking, score, tree["vec_id"][first:last], tree["unnamed"][first:last], tree["row"][first:last], tree["row"][first:last][None, :] != rows[asking][:, None])
        done, step = done + step, 2 * step
    return found


def _usable(vector: Column) -> Column:
    """Vectors without a null or non-finite component; one that 1,024 times makes infinite counts as such."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(1024.0 * x) < F.lit(float("inf")), F.lit(False))), F.lit(False))


def _blocks(rows: DataFrame, size: int, build, schema: str) -> DataFrame:
    """Runs of at most ``size`` rows (row, vec_id, vector) of one length, each handed to ``build``."""

    def run(batches):
        from pyspark import TaskContext

        held: dict[int, list] = {}
        part, serial = TaskContext.get().partitionId() << 32, 0

        def made(dim: int) -> pa.RecordBatch:
            nonlocal serial
            row, vec_id, values = (np.concatenate(x) for x in zip(*held.pop(dim)))
            serial += 1
            return build(part + serial - 1, dim, row, vec_id, values.reshape(len(row), dim))

        for batch in batches:
            vectors = batch.column(2)
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = np.floor(1024.0 * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            starts = np.cumsum(sizes) - sizes
            ids = np.array(batch.column(1).to_pylist(), dtype=object)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                for first in range(0, len(at), size):
                    some = at[first : first + size]
                    held.setdefault(dim, []).append((batch.column(0).to_numpy()[some], ids[some], flat[(starts[some][:, None] + np.arange(dim)).ravel()]))
                    if sum(len(x[0]) for x in held[dim]) >= size:
                        yield made(dim)
        for dim in list(held):
            yield made(dim)

    return rows.select("row", F.col("vec_id").cast("long"), "vector").mapInArrow(run, schema)


def _shard(leaf_rows: int):
    def build(shard: int, dim: int, row: np.ndarray, vec_id: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        order, centres, radii = build_tree(values, leaf_rows)
        unnamed = np.array([v is None for v in vec_id], dtype=bool)
        ids = np.array([0 if v is None else v for v in vec_id], dtype=np.int64)
        tree = _saved(vectors=_compact(values[order]), row=row[order], vec_id=ids[order], unnamed=unnamed[order], depth=np.array([len(centres)]), leaf_rows=np.array([leaf_rows]),
                      **{f"centres{k}": c for k, c in enumerate(centres)}, **{f"radii{k}": r for k, r in enumerate(radii)})
        return pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([dim]), pa.array([tree], pa.binary())], names=["shard", "dim", "tree"])

    return build


def _query_block(block: int, dim: int, row: np.ndarray, vec_id: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    data = _saved(vectors=_compact(values), row=row, vec_id=vec_id.astype(np.int64))
    return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([dim]), pa.array([data], pa.binary())], names=["block", "dim", "queries"])


def _numbered(blocks: DataFrame, name: str) -> DataFrame:
    """Numbers 0, 1, ... within each vector length; a narrow row per block."""
    return blocks.withColumn("number", F.row_number().over(Window.partitionBy("dim").orderBy(name)) - 1)


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 10, vector_col: str = "embedding", shard_rows: int = SHARD_ROWS,
                       block_queries: int = BLOCK_QUERIES, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``vectors`` (vec_id, the vector) that ``is_query`` marks, its ``k`` best other rows.

    A component x counts as floor(1024 x). The score is the inner product; of equal scores the smaller vec_id comes first (a null one last). Rows
    whose vector is null or holds a null or non-finite component take no part; a row that repeats another is a row of its own, so it is found
    by its copy and asks for itself. Vectors are compared with those of their own length. Scores beyond 64 bits are clipped. Queries with
    fewer than ``k`` other rows have all of them; an empty table gives no rows. Other columns are ignored.
    """
    usable = staged(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("asks")).where(
        _usable(F.col("vector"))).withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = usable.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    spread = lambda rows, n, size: rows.repartition(max(1, -(-n // size)))
    trees = staged(_blocks(spread(usable, sizes["n"], shard_rows), shard_rows, _shard(leaf_rows), "shard long, dim long, tree binary"), "trees")
    asked = staged(_blocks(spread(usable.where("asks"), sizes["q"], block_queries), block_queries, _query_block, "block long, dim long, queries binary"), "queries")
    shards = _numbered(trees.select("shard", "dim"), "shard")
    blocks = _numbered(asked.select("block", "dim"), "block")
    counts = shards.groupBy("dim").agg(F.count("*").alias("shards"))
    most = counts.agg(F.max("shards")).first()[0] or 0
    best, first, last = None, 0, 1
    while first < most:
        # Each block begins with a shard of its own; which shards it meets in this round follows from its number.
        met = blocks.join(counts, "dim").where(F.col("shards") > first).select("block", "dim", "shards", "number", F.explode(
            F.sequence(F.lit(first), F.least(F.lit(last), F.col("shards")).cast("int") - 1)).alias("turn")).select(
            "block", "dim", F.pmod(F.col("number") + F.col("turn"), F.col("shards")).alias("number")).join(shards, ["dim", "number"]).select("block", "shard")
        found = _searched(met, trees, asked, best, k)
        best = staged(_merged(found if best is None else best.drop("rank").unionByName(found), k), "best")
        first, last = last, 2 * last
    if best is None:
        return usable.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return best.select("query_id", "rank", "vec_id", "score")


def _merged(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.select(*[c.split()[0] for c in FOUND.split(", ")]).withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def _searched(met: DataFrame, trees: DataFrame, asked: DataFrame, best: DataFrame | None, k: int) -> DataFrame:
    """Rows of the trees that may be among the best of the queries, over pairs (block, shard)."""
    floors = None
    if best is not None:
        # The k-th score of each query so far, with its block: a few bytes per query.
        kth = best.where(F.col("rank") == k).select(F.col("query").alias("q"), F.col("score").alias("floor"))
        rows = asked.select("block", "queries").mapInArrow(_query_rows, "block long, q long")
        floors = rows.join(kth, "q").groupBy("block").agg(F.collect_list(F.struct("q", "floor")).alias("floors"))
    blocks = asked.select("block", "queries")
    blocks = blocks.join(floors, "block", "left") if floors is not None else blocks.withColumn("floors", F.lit(None).cast("array<struct<q:long,floor:long>>"))
    pairs = met.join(blocks, "block").join(trees.select("shard", "tree"), "shard").select("queries", "floors", "tree")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k_th in range(batch.num_rows):
                asking, floors, data = (batch.column(c)[k_th].as_py() for c in range(3))
                queries, tree = _loaded(asking), _loaded(data)
                floor = np.full(len(queries["row"]), np.iinfo(np.int64).min)
                if floors:
                    known = {f["q"]: f["floor"] for f in floors}
                    floor = np.array([known.get(r, floor[0]) for r in queries["row"].tolist()], dtype=np.int64)
                own = search(tree, queries["vectors"].astype(np.float64), queries["row"], floor, k)
                at, place = np.nonzero(own.real)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries["row"][at]), pa.array(queries["vec_id"][at]), pa.array(own.score[at, place]), pa.array(own.row[at, place]),
                     pa.array(own.vec_id[at, place], mask=own.unnamed[at, place])], names=["query", "query_id", "score", "row", "vec_id"])

    return pairs.mapInArrow(run, FOUND)


def _query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = _loaded(data)["row"]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), block)), pa.array(rows)], names=["block", "q"])
