"""Approximate nearest neighbours by inner product with learned partitions.

Fitting, on a bounded sample: a graph joins each sampled vector to its nearest;
the graph is cut into parts of equal size by recursive bisection along its
second eigenvector, each cut improved by swaps across it; a small network learns
the parts of a vector's neighbours from the vector. How many parts a query
visits is the least number that finds the target share of the sample's true
neighbours.

Index: the network puts every row into its most probable part. Search: a query
goes to its most probable parts, where exact inner products rerank all rows. A
part is cut into blocks of rows and blocks of queries of bounded size, so one
part, or one vector that fills a third of the table, never meets in one task;
each pair of blocks yields a query's nearest, which are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rootlens.llm.frames import Scratch

#: Rows the partitions are fitted on, parts, and sampled rows a part needs at least.
SAMPLE_ROWS = 12_000
PARTS = 32
ROWS_PER_PART = 48
GRAPH_NEIGHBOURS = 12
HIDDEN = 96
EPOCHS = 14
#: Share of the sample's true neighbours that the visited parts must hold.
TARGET_RECALL = 0.95
#: Rows and queries that meet in one group.
BLOCK_ROWS = 8192
BLOCK_QUERIES = 512
SEED = 11

# Fixed value: neighbours of a query.
NEAREST = 20


def nearest(queries: np.ndarray, rows: np.ndarray, k: int, skip: np.ndarray | None = None) -> np.ndarray:
    """Indexes of the k rows with the largest inner product, in no order; ``skip`` names a row left out."""
    out = np.empty((len(queries), k), np.int64)
    for at in range(0, len(queries), 512):
        score = queries[at : at + 512] @ rows.T
        if skip is not None:
            score[np.arange(len(score)), skip[at : at + 512]] = -np.inf
        out[at : at + 512] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


def _bisect(a: np.ndarray, b: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Halves of a graph of n nodes with edges a-b: False and True, equal in size."""
    degree = np.bincount(a, minlength=n) + 1.0
    scale = 1 / np.sqrt(degree)
    first = np.sqrt(degree)
    first /= np.linalg.norm(first)
    x = rng.standard_normal(n)
    for _ in range(80):
        x -= first * (first @ x)
        x /= np.linalg.norm(x) or 1.0
        # self-loops keep the iteration on the largest eigenvalues
        x = x + scale * (np.bincount(a, (x * scale)[b], n) + x * scale)
    side = np.zeros(n, bool)
    side[np.argsort(x * scale, kind="stable")[n // 2 :]] = True
    for _ in range(8):
        # gain of moving a node to the other half; swap the best of both halves
        across = np.bincount(a, side[a] != side[b], n)
        gain = 2 * across - np.bincount(a, minlength=n)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        k = min(len(left), len(right), max(1, n // 50))
        better = np.flatnonzero(gain[left[:k]] + gain[right[:k]] > 0)
        if not len(better):
            break
        before = side.copy()
        side[left[better]], side[right[better]] = True, False
        if (side[a] != side[b]).sum() >= (before[a] != before[b]).sum():
            side = before
            break
    return side


def cut_graph(edges: tuple[np.ndarray, np.ndarray], n: int, parts: int) -> np.ndarray:
    """The part of each node; ``parts`` is a power of two and parts differ by few nodes."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    part = np.zeros(n, np.int64)
    for _ in range(parts.bit_length() - 1):
        inside = part[edges[0]] == part[edges[1]]
        a, b = edges[0][inside], edges[1][inside]
        new = part * 2
        for p in np.unique(part):
            nodes = np.flatnonzero(part == p)
            place = np.full(n, -1)
            place[nodes] = np.arange(len(nodes))
            own = part[a] == p
            new[nodes] += _bisect(place[a[own]], place[b[own]], len(nodes), rng)
        part = new
    return part


@dataclass
class Router:
    """A network of one hidden layer, and how many parts a query visits."""

    weights: list[np.ndarray]
    probes: int
    dimension: int

    @property
    def parts(self) -> int:
        return self.weights[3].shape[0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        z = np.maximum(_unit(x) @ w1 + b1, 0) @ w2 + b2
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def _unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _learn(x: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    """Adam on the cross entropy to ``target``, the parts of a vector's neighbours."""
    rng = np.random.Generator(np.random.PCG64(SEED + 1))
    shape = ((x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN, target.shape[1]), (target.shape[1],))
    w = [rng.standard_normal(s) * (np.sqrt(2 / s[0]) if len(s) == 2 else 0) for s in shape]
    m, v = [np.zeros(s) for s in shape], [np.zeros(s) for s in shape]
    t = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            rows = order[at : at + 128]
            h = np.maximum(x[rows] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            d = (p - target[rows]) / len(rows)
            back = (d @ w[2].T) * (h > 0)
            t += 1
            for i, g in enumerate((x[rows].T @ back, back.sum(0), h.T @ d, d.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                rate = 0.003 * (1 - epoch / EPOCHS)
                w[i] = w[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return w


def fit(sample: np.ndarray, parts: int = PARTS, k: int = NEAREST) -> Router:
    """Fit on the distinct rows of the sample."""
    sample = np.unique(np.asarray(sample, np.float64), axis=0)
    n, dimension = sample.shape
    while parts > 1 and n < parts * ROWS_PER_PART:
        parts //= 2
    if parts == 1:
        zero = [np.zeros((dimension, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)]
        return Router(zero, 1, dimension)
    own = np.arange(n)
    near = nearest(sample, sample, min(max(GRAPH_NEIGHBOURS, k), n - 1), own)
    a, b = np.repeat(own, GRAPH_NEIGHBOURS), near[:, :GRAPH_NEIGHBOURS].ravel()
    pairs = np.unique(np.concatenate((a * n + b, b * n + a)))
    part = cut_graph((pairs // n, pairs % n), n, parts)
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(own, near.shape[1] + 1), part[np.concatenate((near, own[:, None]), axis=1)].ravel()), 1.0)
    router = Router(_learn(_unit(sample), target / target.sum(1, keepdims=True)), parts, dimension)
    # the index holds a row where the network puts it, so that is what is measured
    chance = router.probabilities(sample)
    held = chance.argmax(1)
    probe = own[:: max(1, n // 1500)]
    place = np.empty_like(chance[probe], dtype=np.int64)
    np.put_along_axis(place, np.argsort(-chance[probe], axis=1), np.arange(parts)[None, :], axis=1)
    rank = np.take_along_axis(place, held[near[probe][:, :k]], axis=1)
    found = np.array([(rank < p).mean() for p in range(1, parts + 1)])
    router.probes = int(np.argmax(found >= TARGET_RECALL)) + 1
    return router


def usable(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id, vector of the rows that take part, repeated rows once."""
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return (
        table.select(table[id_column].cast("long").alias("vec_id"), table[vector_column].alias("vector"))
        .filter(F.col("vec_id").isNotNull() & x.isNotNull())
        .filter(finite & F.exists(x, lambda v: v != 0))
        .dropDuplicates(["vec_id", "vector"])
    )


def train(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, parts: int = PARTS) -> Router | None:
    """Fit on at most ``sample_rows`` of the usable rows, taken by a hash of the id; the
    dimension is the most frequent length. None without rows."""
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return None
    drawn = rows.filter(F.size("vector") == common["d"]).orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id").limit(sample_rows)
    return fit(np.array([r["vector"] for r in drawn.select("vector").collect()], np.float64), parts)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(-1, dimension)


def search(
    rows: DataFrame,
    router: Router,
    scratch: Scratch,
    queries: DataFrame,
    k: int = NEAREST,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each of ``queries``.

    ``rows`` and ``queries`` have vec_id and vector; rows with the query's id are left out."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(router)
    d = router.dimension
    shaped = F.size("vector") == d

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = sent.value.probabilities(_matrix(batch.column("vector"), d)).argmax(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], names=["vec_id", "vector", "part"])

    schema = rows.select("vec_id", "vector").schema
    index = scratch.store(rows.filter(shaped).select("vec_id", "vector").mapInArrow(place, schema.add("part", "integer")), "index")
    held = {r[0]: r[1] for r in index.groupBy("part").count().collect()}  # a row for each part
    count = np.array([held.get(p, 0) for p in range(router.parts)], np.int64)
    blocks = np.maximum(1, -(-count // BLOCK_ROWS))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(-sent.value.probabilities(_matrix(batch.column("vector"), d)), axis=1, kind="stable")
            # more parts where those do not hold enough rows
            short = np.cumsum(count[order], axis=1) - count[order] < k + 1
            visit = short | (np.arange(order.shape[1]) < sent.value.probes)
            visit &= count[order] > 0
            at, column = np.nonzero(visit)
            taken = batch.select(["vec_id", "vector"]).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(order[at, column], pa.int32())], names=["vec_id", "vector", "part"])

    routed = queries.filter(shaped).select("vec_id", "vector").mapInArrow(route, schema.fromJson(index.schema.jsonValue()))
    routed = scratch.store(routed, "routed")
    asked = {r[0]: r[1] for r in routed.groupBy("part").count().collect()}
    query_blocks = np.maximum(1, -(-np.array([asked.get(p, 0) for p in range(router.parts)], np.int64) // BLOCK_QUERIES))

    def of_part(values: np.ndarray):
        return F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("part") + 1)

    def copied(frame: DataFrame, own: np.ndarray, own_name: str, other: np.ndarray, other_name: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), of_part(own)).cast("int")
        return frame.withColumn(own_name, mine).withColumn(other_name, F.explode(F.sequence(F.lit(0), of_part(other) - 1)))

    left = copied(routed, query_blocks, "qblock", blocks, "block")
    right = copied(index, blocks, "block", query_blocks, "qblock")

    def best(q: pa.Table, m: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if q.num_rows and m.num_rows:
            x, y = _matrix(q["vector"], d), _matrix(m["vector"], d)
            qid, mid = q["vec_id"].to_numpy(), m["vec_id"].to_numpy()
            # tells rows apart that share an id but not a vector
            mark = np.array([xxhash.xxh3_64_intdigest(v.tobytes()) >> 1 for v in x], np.int64)
            rough = x @ y.T
            rough[qid[:, None] == mid[None, :]] = -np.inf
            found = []
            for i in range(len(x)):
                row = rough[i]
                if len(row) > k:
                    bar = np.partition(row, len(row) - k)[len(row) - k]
                    # the product of matrices may differ in its last bits from row to row
                    slack = 1e-9 * (abs(bar) + 1) if np.isfinite(bar) else 0.0
                    near = np.flatnonzero(row >= bar - slack) if np.isfinite(bar) else np.flatnonzero(np.isfinite(row))
                else:
                    near = np.flatnonzero(np.isfinite(row))
                exact = (y[near] * x[i]).sum(1)
                order = np.lexsort((mid[near], -exact))[:k]
                found.append((np.full(len(order), qid[i]), np.full(len(order), mark[i]), mid[near][order], exact[order]))
            out = [np.concatenate(c) for c in zip(*found, strict=True)]
        return pa.Table.from_arrays([pa.array(c) for c in out], names=["query_id", "mark", "vec_id", "score"])

    near = left.groupBy("part", "block", "qblock").cogroup(right.groupBy("part", "block", "qblock"))
    near = near.applyInArrow(best, "query_id long, mark long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(
    table: DataFrame,
    every: int,
    k: int = NEAREST,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The k nearest found among all rows for each row whose id is divisible by ``every``.

    Defined cases: rows with a null id, a null or zero vector, or a null, NaN or
    infinite component take no part, neither do vectors of another length than the
    most frequent one; repeated rows count once; rows that share an id are never each other's
    neighbours; ties go to the smaller id; with fewer candidates
    all are returned; an empty table gives no rows; other columns are ignored.
    """
    spark = table.sparkSession
    scratch = Scratch(spark)
    rows = scratch.store(usable(table, id_column, vector_column), "rows")
    router = train(rows)
    if router is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(rows, router, scratch, rows.filter(F.col("vec_id") % every == 0), k)
