"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Vectors belong to cells around centroids that are fitted on a bounded sample.  A vector is kept as the
signs of its rotated offset from its centroid, packed, with two correction scalars: the offset's length and
the inner product of its direction with its code.  From bits and scalars follow estimates of inner products
with error bounds; only vectors whose upper bound reaches the query's k-th best so far are reranked on the
original coordinates.  A query first searches the cell that promises most, then, with the k-th best of that
as its floor, the cells whose own upper bound reaches the floor.  Vectors in tight clusters leave few of
them; vectors without any structure leave most, whatever the method.  Equal vectors are one entry of the
index with their k + 1 smallest ids, which is all of them that can be among k nearest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage

#: Vectors a cell has on average, most cells, and bytes of the sample that centroids are fitted on.
CELL, CELLS, SAMPLE_BYTES = 4096, 1024, 32 << 20
#: Queries and vectors that meet in one task; queries whose estimates are held at a time.
QUERY_BLOCK, VECTOR_BLOCK, SLICE = 4096, 8192, 256
#: Standard deviations that the error bounds of codes allow, and those of cells: a code's error doesn't depend on
#: how near its vector is, but the nearest vectors are the outermost of their cells.
SIGMAS, CELL_SIGMAS = 3.0, 5.0
#: Keys that the rows of one often repeated vector are dealt over before they meet.
SALTS = 64


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A random rotation, the same on every worker."""
    q, r = np.linalg.qr(np.random.default_rng(7919 + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, length, <direction, code>) of vectors; a zero vector's scalars are 0 and 1."""
    turned = x @ rotation(x.shape[1])
    length = np.linalg.norm(turned, axis=1)
    fit = np.abs(turned).sum(axis=1) / (np.sqrt(x.shape[1]) * np.where(length > 0, length, 1))
    return np.packbits(turned > 0, axis=1), length, np.where(length > 0, np.minimum(fit, 1), 1.0)


class Coded:
    """Coded vectors of one cell, against which queries are estimated."""

    def __init__(self, codes: np.ndarray, length: np.ndarray, fit: np.ndarray, dim: int):
        self.signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * np.float32(2) - np.float32(1)
        self.scale = (length / (fit * np.sqrt(dim))).astype(np.float32)
        self.spread = (SIGMAS * length * np.sqrt(np.maximum(1 - fit * fit, 0) / max(dim - 1, 1)) / fit).astype(np.float32)
        self.dim = dim

    def estimate(self, q: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(queries, vectors): estimated inner products with the original vectors, and their error bounds."""
        turned = (q @ rotation(self.dim)).astype(np.float32)
        size = np.linalg.norm(q, axis=1)
        slack = 1e-5 * size * (1 + np.linalg.norm(centre))  # of single precision
        return turned @ self.signs.T * self.scale + (q @ centre).astype(np.float32)[:, None], size.astype(np.float32)[:, None] * self.spread + slack.astype(np.float32)[:, None]


def _usable(c: str):
    ok = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.col(c).isNotNull() & (F.size(c) > 0) & ok & F.exists(c, lambda v: v != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1)


def _equal_vectors(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            flat = b.column("v").flatten()
            x = np.ascontiguousarray(np.asarray(flat).reshape(b.num_rows, -1)) + np.zeros(1, flat.type.to_pandas_dtype())
            ids = np.asarray(b.column("id"))
            raw = x.view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel()
            _, group = np.unique(raw, return_inverse=True)
            order = np.lexsort((ids, group))
            first = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0]))
            ends = np.append(first[1:], len(order))
            yield pa.RecordBatch.from_arrays([b.column("v").take(pa.array(order[first])), pa.array([ids[order[a : min(e, a + k)]].tolist() for a, e in zip(first, ends)], pa.list_(pa.int64()))], names=["v", "ids"])

    return run


def centroids(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Means of ``cells`` groups of the sample's distinct vectors, by Lloyd's steps from a spread-out start."""
    x = np.unique(sample, axis=0)
    cells = min(cells, len(x))
    if cells <= 1:
        return x.mean(axis=0, keepdims=True)
    rng = np.random.default_rng(11)
    mu = x[rng.choice(len(x), cells, replace=False)]
    for _ in range(rounds):
        own = nearest_cell(x, mu)
        order = np.argsort(own, kind="stable")
        some, first = np.unique(own[order], return_index=True)
        mu[some] = np.add.reduceat(x[order], first, axis=0) / np.diff(np.append(first, len(x)))[:, None]
    return mu


def nearest_cell(x: np.ndarray, mu: np.ndarray) -> np.ndarray:
    half = (mu * mu).sum(axis=1) / 2
    return np.concatenate([(x[a : a + 4096] @ mu.T - half).argmax(axis=1) for a in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def _coded(mu: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("v"))
                cell = nearest_cell(x, mu)
                codes, length, fit = encode(x - mu[cell])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(length), pa.array(fit)], names=[*b.schema.names, "cell", "code", "length", "fit"])

    return run


class Cells:
    """Centroids, and how many vectors are around each and how far."""

    def __init__(self, mu: np.ndarray):
        self.mu, self.count, self.radius = mu, np.zeros(len(mu), np.int64), np.zeros(len(mu))

    def promise(self, q: np.ndarray) -> np.ndarray:
        """(queries, cells): upper bounds of inner products with a cell's vectors; -inf for empty cells."""
        size = np.linalg.norm(q, axis=1)[:, None]
        return np.where(self.count > 0, q @ self.mu.T + CELL_SIGMAS * size * self.radius / np.sqrt(self.mu.shape[1]), -np.inf)


class Index:
    """Entries (v, ids, cell, code, length, fit), stored, and their cells."""

    def __init__(self, vectors: DataFrame, k: int, vec_id: str, embedding: str, cell: int, cells: int):
        element = vectors.schema[embedding].dataType.elementType
        self.type = "float" if isinstance(element, T.FloatType) else "double"
        self.own = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast(f"array<{self.type}>").alias("v")).where(F.col("id").isNotNull() & _usable("v"))
        size = self.own.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
        self.dim, n = (size.d, size["count"]) if size else (0, 0)
        if not n:
            return
        own = self.own.where(F.size("v") == self.dim)
        cells = max(1, min(n // cell, cells, SAMPLE_BYTES // (8 * self.dim * 32)))
        # At most 64 vectors a cell are wanted; their number is within a few per cent of that, whatever n is.
        share = min(1.0, 64 * cells / n)
        some = own.where(F.pmod(F.xxhash64("id", F.lit("cells")), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else own
        sample = _matrix(some.select("v").limit(128 * cells).toArrow().column("v").combine_chunks())
        self.cells = Cells(centroids(sample, cells) if len(sample) else np.zeros((1, self.dim)))
        entries = own.mapInArrow(_equal_vectors(k + 1), f"v array<{self.type}>, ids array<bigint>")
        least = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids")
        entries = entries.groupBy("v", F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt")).agg(least).groupBy("v").agg(least)
        self.entries = stage(entries.mapInArrow(_coded(self.cells.mu), f"v array<{self.type}>, ids array<bigint>, cell int, code binary, length double, fit double"), "index")
        for r in self.entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("length") * F.col("length")).alias("s")).collect():
            self.cells.count[r.cell], self.cells.radius[r.cell] = r.n, np.sqrt(r.s / r.n)


def _route(cells: Cells, probes: int | None):
    """(qn, id, floor, v, cell) for each cell that a query searches: its first without a floor, else the others that reach it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                up, floor = cells.promise(_matrix(b.column("v"))), np.asarray(b.column("floor")) if b.num_rows else np.zeros(0)
                home = up.argmax(axis=1)
                i = np.arange(len(up))
                goes = np.zeros(up.shape, bool)
                goes[i, home] = np.isnan(floor)
                later = ~np.isnan(floor)
                reach = (up >= np.where(later, floor, np.inf)[:, None]) & np.isfinite(up)
                if probes is not None:
                    rank = np.argsort(np.argsort(-up, axis=1, kind="stable"), axis=1, kind="stable")
                    reach &= rank < probes
                reach[i, home] = False
                goes |= reach
                q, cell = np.nonzero(goes)
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(q)) for c in ("qn", "id", "floor", "v")), pa.array(cell.astype(np.int32))], names=["qn", "id", "floor", "v", "cell"])

    return run


def _search(k: int, mu: np.ndarray):
    schema = pa.schema([("qn", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(key, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return schema.empty_table()
        q, x = (_matrix(t.column("v").combine_chunks()) for t in (queries, vectors))
        centre = mu[vectors.column("cell")[0].as_py()]
        numbers, names, floors = queries.column("qn").to_numpy(), queries.column("id").to_numpy(), queries.column("floor").to_numpy()
        floors = np.where(np.isnan(floors), -np.inf, floors)
        ids = vectors.column("ids").to_pylist()
        codes = np.frombuffer(b"".join(vectors.column("code").to_pylist()), np.uint8).reshape(len(x), -1)
        coded, out = Coded(codes, vectors.column("length").to_numpy(), vectors.column("fit").to_numpy(), x.shape[1]), ([], [], [], [])
        for lo in range(0, len(q), SLICE):
            near, err = coded.estimate(q[lo : lo + SLICE], centre)
            for i in range(lo, min(lo + SLICE, len(q))):
                best = _best(q[i], names[i], floors[i], near[i - lo], near[i - lo] + err[i - lo], x, ids, k)
                out[0].extend([numbers[i]] * len(best))
                out[1].extend([names[i]] * len(best))
                out[2].extend(c for _, c in best)
                out[3].extend(-s for s, _ in best)
        return pa.table([pa.array(o, f.type) for o, f in zip(out, schema)], schema=schema)

    return run


def _best(q: np.ndarray, name: int, floor: float, near: np.ndarray, upper: np.ndarray, x: np.ndarray, ids: list[list[int]], k: int) -> list[tuple[float, int]]:
    """The k ids of largest inner product with ``q`` as (-score, id); none under the floor is needed."""

    def listed(entries: np.ndarray) -> list[tuple[float, int]]:
        # Summed in the order of the coordinates, so that the score doesn't depend on what is computed beside it.
        found: dict[int, float] = {}
        for j, s in zip(entries.tolist(), np.cumsum(x[entries] * q, axis=1)[:, -1].tolist()):
            for c in ids[j]:
                if c != name and s > found.get(c, -np.inf):
                    found[c] = s
        return sorted((-s, c) for c, s in found.items())[:k]

    if len(near) > 4 * k:
        first = listed(np.argpartition(-near, 2 * k)[: 2 * k])
        if len(first) == k:
            floor = max(floor, -first[-1][0])
    alive = np.flatnonzero(upper >= floor)
    if len(alive) > 2 * k:
        exact = x[alive] @ q
        # An entry holds k ids that count or all it has, so distinct ones among fewer than k + 1 entries may be too few.
        alive = alive[exact >= floor - 1e-9 * (1 + abs(floor))]
    return [b for b in listed(alive) if -b[0] >= floor]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", probes: int | None = None, cell: int = CELL, cells: int = CELLS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every query by inner product, ties to the smaller id.

    Null or zero vectors, those with null or non-finite components, without an id, or of another than
    the commonest dimension take no part; rows of the query's own id are left out; fewer than k
    candidates are all returned; repeated rows count once.  An id of several vectors appears once, by the
    greatest inner product of any of the query's vectors with any of its own.  An empty table gives an
    empty result; extra columns are not read.

    Every cell whose bound reaches a query's floor is searched, unless ``probes`` limits them to the most
    promising ones.
    """
    spark = vectors.sparkSession
    index = Index(vectors, k, vec_id, embedding, cell, cells)
    if not index.dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = queries.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast(f"array<{index.type}>").alias("v")).where(F.col("id").isNotNull() & _usable("v") & (F.size("v") == index.dim)).distinct()
    asked = stage(asked.withColumn("qn", F.monotonically_increasing_id()), "queries")
    none = F.lit(float("nan"))
    first = stage(_wave(index, asked.withColumn("floor", none), k, probes), "nearest")
    if len(index.cells.mu) > 1:
        rank = F.row_number().over(Window.partitionBy("qn").orderBy(F.col("score").desc(), "vec_id"))
        kth = first.groupBy("qn", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", rank).where(f"rank <= {k}").where(f"rank = {k}").select("qn", F.col("score").alias("floor"))
        second = _wave(index, asked.join(kth, "qn", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))), k, probes)
        first = first.unionByName(second)
    best = first.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _wave(index: Index, asked: DataFrame, k: int, probes: int | None) -> DataFrame:
    """Queries meet the entries of the cells they are routed to, blocks of both at a time."""
    routes = asked.mapInArrow(_route(index.cells, probes), f"qn long, id long, floor double, v array<{index.type}>, cell int")
    chunks = np.zeros(len(index.cells.mu), np.int64)
    for r in routes.groupBy("cell").count().collect():
        chunks[r.cell] = -(-r["count"] // QUERY_BLOCK)
    blocks = -(-index.cells.count // VECTOR_BLOCK)
    # By cell, of which there are at most CELLS: how many blocks its queries and its vectors are dealt over.
    of = lambda a: F.element_at(F.array(*[F.lit(int(v)) for v in a]), F.col("cell") + 1)
    every = lambda a: F.explode(F.when(of(a) > 0, F.sequence(F.lit(0), of(a) - 1)).otherwise(F.array().cast("array<int>")))
    dealt = lambda c, a: F.pmod(F.xxhash64(c), F.greatest(of(a), F.lit(1))).cast("int")
    left = routes.withColumn("chunk", dealt("qn", chunks)).withColumn("block", every(blocks))
    right = index.entries.withColumn("block", dealt("v", blocks)).withColumn("chunk", every(chunks))
    meet = ["cell", "chunk", "block"]
    return left.groupBy(*meet).cogroup(right.groupBy(*meet)).applyInArrow(_search(k, index.cells.mu), "qn long, query_id long, vec_id long, score double")


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


SQL_OP2 = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM p)
SELECT query_id, rk::INTEGER AS rank, vec_id, score FROM r WHERE rk <= 20
"""
