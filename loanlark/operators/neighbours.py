"""Exact k nearest neighbours over a tree of balls, block by block.

Candidates are placed in the leaves of a ball tree once and stored; every leaf has a centre, a
radius and a size. A query first meets its own leaf, which bounds how far its k-th neighbour
can be, and then only leaves whose ball reaches into that bound. Leaves and the queries sent
to them are split into blocks of bounded size, a task compares one pair of blocks and returns
at most k rows per query, and a last ranking merges them. Nothing is approximated: a candidate
is skipped only if it cannot be among the k nearest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.functions.balls import BallTree, distances, squared
from loanlark.functions.skew import salted_lookup
from loanlark.session import through_storage

ROWS_PER_LEAF = 2_048
SAMPLE_PER_LEAF = 16
#: Bytes of the sample that the tree is built from; larger tables have larger leaves.
TREE_BYTES = 64 << 20
BLOCK_ROWS = 4_096
QUERIES_AT_ONCE = 256
#: Bytes that a step of a task holds of any matrix or of rows to be sent on.
BATCH_BYTES = 8 << 20
NEAREST = pa.schema([("id", pa.int64()), ("neighbour", pa.int64()), ("distance", pa.float64())])


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().to_numpy(zero_copy_only=False)


def _points(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _least(ids: np.ndarray, points: np.ndarray, qs: np.ndarray, far: np.ndarray, slack: np.ndarray, k: int) -> tuple:
    """(query, point, distance) of the k nearest points of each query that lie within ``far``."""
    rough = squared(qs, points)
    # the product form rounds; whatever could still be among the k is measured exactly
    limit = far**2 + slack
    many = np.flatnonzero((rough <= limit[:, None]).sum(axis=1) > k)
    if len(many):
        limit[many] = np.minimum(limit[many], np.partition(rough[many], k - 1, axis=1)[:, k - 1] + slack[many])
    row, at = np.nonzero(rough <= limit[:, None])
    exact = np.empty(len(row))
    step = max(1, BATCH_BYTES // (8 * qs.shape[1]))
    for i in range(0, len(row), step):
        part = slice(i, i + step)
        exact[part] = np.sqrt(((points[at[part]] - qs[row[part]]) ** 2).sum(axis=1))
    order = np.lexsort((ids[at], exact, row))
    row, at, exact = row[order], at[order], exact[order]
    best = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[best], at[best], exact[best]


def _block_nearest(k: int):
    def nearest(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        if queries.num_rows and candidates.num_rows:
            ids, points = _numbers(candidates["id"]).astype(np.int64), _points(candidates["vec"].combine_chunks())
            qids, vectors = _numbers(queries["id"]).astype(np.int64), _points(queries["vec"].combine_chunks())
            far = _numbers(queries["far"])
            heaviest = (points**2).sum(axis=1).max()
            for start in range(0, len(qids), QUERIES_AT_ONCE):
                part = slice(start, start + QUERIES_AT_ONCE)
                slack = 1e-9 * ((vectors[part] ** 2).sum(axis=1) + heaviest)
                row, at, exact = _least(ids, points, vectors[part], far[part], slack, k)
                found.append((qids[part][row], ids[at], exact))
        columns = [np.concatenate(c) for c in zip(*found)] or [np.empty(0)] * 3
        return pa.table(dict(zip(NEAREST.names, columns)), schema=NEAREST)

    return nearest


def nearest_neighbours(
    queries: DataFrame, candidates: DataFrame, key: str, vector: str, k: int
) -> DataFrame:
    """(id, rank, neighbour, distance): the k nearest other rows, ties by id.

    Copies of a vector are looked up once. Of the copies among the candidates only the
    k + 1 smallest ids can be neighbours, since ties go by id, so the rest stays behind.
    """
    asked = _pairs_of(queries, key, vector)
    copies = Window.partitionBy("vec").orderBy("id")
    offered = (
        _pairs_of(candidates, key, vector)
        .withColumn("copy", F.row_number().over(copies))
        .filter(F.col("copy") <= k + 1)
        .drop("copy")
    )
    # counted, sampled and placed: stored, so that copies are told apart once
    offered = through_storage(offered, "offered")
    distinct = asked.groupBy("vec").agg(F.min("id").alias("id"))
    found = (
        # one more than wanted, as one of them may be the row itself
        _nearest_to_vectors(distinct, offered, k + 1)
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("distance", "neighbour"))).alias("near"))
    )
    by_vector = distinct.join(found, "id").select("vec", "near")
    others = F.slice(F.filter("near", lambda x: x["neighbour"] != F.col("id")), 1, k)
    return (
        salted_lookup(asked, by_vector, ["vec"], ["id"])
        .select("id", F.posexplode(others).alias("place", "x"))
        .select("id", (F.col("place") + 1).alias("rank"), "x.neighbour", "x.distance")
    )


def _pairs_of(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec")
    )


def plant(candidates: DataFrame, size: int, seed: int = S.SEED) -> BallTree:
    """A tree for a counted table, from a sample by hash of at most ``TREE_BYTES``."""
    first = candidates.select("vec").first()
    room = TREE_BYTES // (8 * max(1, len(first[0])) * SAMPLE_PER_LEAF)
    leaves = max(1, min(math.ceil(size / ROWS_PER_LEAF), room))
    if leaves == 1:
        return BallTree(np.array([first[0]], np.float64), 1, seed)
    share = min(1.0, SAMPLE_PER_LEAF * leaves / size)
    drawn = F.shiftrightunsigned(F.xxhash64("id", F.lit(seed)), 11) < F.lit(int(share * 2**53))
    sample = candidates.filter(drawn).select("vec").toArrow()["vec"].combine_chunks()
    return BallTree(_points(sample) if len(sample) else np.array([first[0]], np.float64), leaves, seed)


def placed(rows: DataFrame, tree: BallTree) -> DataFrame:
    """(leaf, id, vec, away): the leaf of each row and how far its centre is."""
    ship = rows.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = _points(batch.column("vec"))
                leaves = ship.value.leaves_of(points)
                columns = [pa.array(leaves), batch.column("id"), batch.column("vec"), pa.array(ship.value.away(points, leaves))]
                yield pa.RecordBatch.from_arrays(columns, names=["leaf", "id", "vec", "away"])

    return rows.select("id", "vec").mapInArrow(run, "leaf int, id long, vec array<double>, away double")


def leaf_table(rows: DataFrame, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and radius of each leaf; one row a leaf reaches the driver."""
    sizes, radii = np.zeros(leaves, np.int64), np.zeros(leaves)
    for r in rows.groupBy("leaf").agg(F.count("*").alias("n"), F.max("away").alias("r")).collect():
        sizes[r.leaf], radii[r.leaf] = r.n, r.r
    return sizes, radii


def _sent(batch: pa.RecordBatch, centres: np.ndarray, sizes: np.ndarray, radii: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    points, own = _points(batch.column("vec")), batch.column("leaf").to_numpy()
    far = batch.column("far").to_numpy(zero_copy_only=False).copy()
    between = distances(points, centres)
    for i in np.flatnonzero(np.isinf(far)):
        reach = between[i] + radii
        order = np.argsort(reach)
        enough = np.searchsorted(np.cumsum(sizes[order]), k)
        if enough < len(order):
            far[i] = reach[order[enough]] * (1 + 1e-9) + 1e-9
    needed = (between - radii <= (far * (1 + 1e-9) + 1e-9)[:, None]) & (sizes > 0)
    needed[np.arange(len(own)), own] = False
    row, leaf = np.nonzero(needed)
    step = max(1, BATCH_BYTES // (8 * points.shape[1]))
    for i in range(0, len(row), step):
        take, to = row[i : i + step], leaf[i : i + step]
        columns = [pa.array(to.astype(np.int32)), batch.column("id").take(pa.array(take)), batch.column("vec").take(pa.array(take)), pa.array(far[take])]
        yield pa.RecordBatch.from_arrays(columns, names=["leaf", "id", "vec", "far"])


def sent_on(asked: DataFrame, tree: BallTree, sizes: np.ndarray, radii: np.ndarray, k: int) -> DataFrame:
    """(leaf, id, vec, far): the queries (leaf, id, vec, far) once for each other leaf whose ball
    comes as near as ``far``, the k-th distance known; where that is infinite, the leaves' sizes
    and far ends bound it."""
    ship = asked.sparkSession.sparkContext.broadcast((tree.centres, sizes, radii))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, sizes, radii = ship.value
        rows = max(1, BATCH_BYTES // (8 * len(centres)))
        for batch in batches:
            # a query may go to every leaf: neither its distances nor its copies are held all at once
            for start in range(0, batch.num_rows, rows):
                yield from _sent(batch.slice(start, rows), centres, sizes, radii, k)

    return asked.select("leaf", "id", "vec", "far").mapInArrow(run, "leaf int, id long, vec array<double>, far double")


def _compared(asked: DataFrame, offered: DataFrame, asked_sizes: dict[int, int], sizes: np.ndarray, k: int) -> DataFrame:
    """(id, neighbour, distance): up to k rows for each query and block of its leaf."""
    blocks = lambda n: max(1, math.ceil(n / BLOCK_ROWS))
    table = [(leaf, blocks(n), blocks(int(sizes[leaf]))) for leaf, n in sorted(asked_sizes.items())]
    # one row a leaf
    parts = F.broadcast(asked.sparkSession.createDataFrame(table, "leaf int, qs int, cs int"))
    own = F.xxhash64("id", F.lit(1))
    left = asked.join(parts, "leaf").select(
        "leaf", "id", "vec", "far", F.pmod(own, F.col("qs")).cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), F.col("cs") - 1)).alias("cb"),
    )
    right = offered.join(parts, "leaf").select(
        "leaf", "id", "vec", F.pmod(own, F.col("cs")).cast("int").alias("cb"), F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("qb"),
    )
    keys = ["leaf", "qb", "cb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_block_nearest(k), "id long, neighbour long, distance double")


def _nearest_to_vectors(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(id, neighbour, distance): for each query the k nearest candidates, itself included."""
    size = candidates.count()
    if not size:
        return queries.sparkSession.createDataFrame([], "id long, neighbour long, distance double")
    tree = plant(candidates, size)
    leaves = len(tree.centres)
    offered = through_storage(placed(candidates, tree), "leaves")
    asked = through_storage(placed(queries, tree), "asked")
    sizes, radii = leaf_table(offered, leaves)
    asked_sizes = {i: int(n) for i, n in enumerate(leaf_table(asked, leaves)[0]) if n}
    first = _compared(asked.withColumn("far", F.lit(math.inf)), offered, asked_sizes, sizes, k)
    order = Window.partitionBy("id").orderBy("distance", "neighbour")
    if leaves > 1:
        first = through_storage(first, "first")
        known = first.groupBy("id").agg(F.array_sort(F.collect_list("distance")).alias("d"))
        far = F.coalesce(F.try_element_at("d", F.lit(k)), F.lit(math.inf))
        bounded = asked.join(known, "id", "left").select("leaf", "id", "vec", far.alias("far"))
        sent = through_storage(sent_on(bounded, tree, sizes, radii, k), "sent")
        sent_sizes = {r["leaf"]: r["count"] for r in sent.groupBy("leaf").count().collect()}
        first = first.unionByName(_compared(sent, offered, sent_sizes, sizes, k))
    return first.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")
