"""Exact top-k inner-product search with a pivot-distance index.

Vectors get one extra coordinate, sqrt(M - |x|^2) with M the largest squared norm (0 for a query), so
that a larger inner product is a smaller distance. Every vector is keyed by its nearest pivot and
its distance to it; distances are cut into rings, and a ring's rows are packed into blocks in order
of distance. A query knows its distance to each pivot, so the triangle inequality bounds its
distance to any vector of a ring from below:

1. Each query looks into its nearest rings, in order of that bound, until they hold enough vectors.
   The k-th score so far is a limit.
2. It then looks into every other ring whose bound does not exceed the limit. No other ring can hold
   a result, so the answer is exact.

Queries travel in packs; packs and blocks meet by an equi-join on the ring, and one product scores a
whole pack against a whole block. Each task keeps only the k best per query. Pivots are fitted on at
most ``_SAMPLE`` vectors; all vectors are indexed. Pivots, rings and their bounds have a fixed size.

Distances are taken of vectors made smaller by a power of two where their components are so large that squares would
leave the range of a double; scores are exact whole numbers at any size.

Defined cases: a vector that is null or holds a null or non-finite component takes no part (a component that
overflows once scaled is not finite), nor does a row without ``vec_id``. Rows sharing a ``vec_id`` are one vector, the smallest in array order.
Vectors of unequal length compare as if padded with zeros; an empty vector scores 0. Ties go to the
smaller id. Scores beyond 64 bits are cut to the range of a long, so all of them tie. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skillgauge.llm import words as W
from skillgauge.sources.stores import stage

_PIVOTS = 16
_RINGS = 8
_SAMPLE = 4096
_BLOCK = 1024
_PACK = 256
_EXACT = 2.0**53
_HUGE = 2.0**400


def _quantise(scale: float):
    schema = pa.schema([("vec_id", pa.int64()), ("dim", pa.int64()), ("norm", pa.float64()), ("peak", pa.float64()), ("body", pa.binary())])

    def run(batches):
        for batch in batches:
            vectors = [np.floor(scale * np.array(v, dtype=np.float64)) for v in batch.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), pa.array([len(v) for v in vectors], pa.int64()), pa.array([_norm(v) for v in vectors], pa.float64()),
                pa.array([float(np.abs(v).max(initial=0.0)) for v in vectors], pa.float64()), pa.array([v.tobytes() for v in vectors], pa.binary())], schema=schema)

    return run


def _norm(v: np.ndarray) -> float:
    with np.errstate(over="ignore"):
        return float(v @ v)


def _matrix(blobs, dim: int) -> np.ndarray:
    out = np.zeros((len(blobs), dim))
    for row, blob in zip(out, blobs):
        own = np.frombuffer(blob, dtype=np.float64)
        row[: len(own)] = own
    return out


class Index:
    """Pivots with their ring bounds; rings are equal parts of a pivot's range of distances."""

    def __init__(self, pivots: np.ndarray, dim: int, most: float, shrink: float = 1.0):
        self.pivots, self.dim, self.most, self.shrink = pivots, dim, most, shrink  # pivots and most are of shrunk vectors
        self.low = self.step = self.inner = self.outer = self.held = None

    def distances(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        vectors = vectors * self.shrink
        extra = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0.0, self.most - (vectors**2).sum(axis=1)))
        return np.sqrt(np.maximum(0.0, ((vectors[:, None, :] - self.pivots[None, :, :-1]) ** 2).sum(axis=2) + (extra[:, None] - self.pivots[None, :, -1]) ** 2))

    def rings(self, pivot: np.ndarray, distance: np.ndarray) -> np.ndarray:
        return np.clip(((distance - self.low[pivot]) / self.step[pivot]).astype(np.int64), 0, _RINGS - 1)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Least possible distance of each query to the vectors of each ring, less a margin for rounding."""
        far = self.distances(queries, query=True)[:, :, None]
        near = np.maximum(0.0, np.maximum(self.inner[None] - far, far - self.outer[None]))
        return np.where(self.held[None] > 0, np.maximum(0.0, near - 1e-7 * (1.0 + far + self.outer[None])), np.inf)


def _pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """A few rounds of k-means from far-apart starts."""
    chosen = [0]
    gap = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    centres = sample[chosen].copy()
    for _ in range(6):
        own = np.stack([((sample - c) ** 2).sum(axis=1) for c in centres]).argmin(axis=0)
        for i in range(len(centres)):
            if (own == i).any():
                centres[i] = sample[own == i].mean(axis=0)
    return centres


def _key(shared):
    schema = pa.schema([("vec_id", pa.int64()), ("pivot", pa.int32()), ("distance", pa.float64()), ("body", pa.binary())])

    def run(batches):
        index: Index = shared.value
        for batch in batches:
            blobs = batch.column("body").to_pylist()
            if not blobs:
                continue
            vectors = _matrix(blobs, index.dim)
            far = index.distances(vectors, query=False)
            pivot = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), pa.array(pivot, pa.int32()), pa.array(far[np.arange(len(far)), pivot]),
                pa.array([v.tobytes() for v in vectors], pa.binary())], schema=schema)

    return run


def _pack_blocks(batches):
    """Consecutive rows of one ring as one block; rows arrive by pivot and distance."""
    schema = pa.schema([("ring", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary())])
    ring, ids, rows = None, [], []

    def block():
        return pa.RecordBatch.from_pydict(
            {"ring": [ring], "ids": [np.array(ids, dtype=np.int64).tobytes()], "rows": [b"".join(rows)]}, schema=schema)

    for batch in batches:
        for at, vec_id, body in zip(*(batch.column(c).to_pylist() for c in ("ring", "vec_id", "body"))):
            if ids and (at != ring or len(ids) >= _BLOCK):
                yield block()
                ids, rows = [], []
            ring = at
            ids.append(vec_id)
            rows.append(body)
    if ids:
        yield block()


def _visits(shared, k: int, later: bool):
    """Packs of queries by ring. First looks: nearest rings until they hold enough; later: all others within the limit."""
    schema = pa.schema([("ring", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary())])

    def run(batches):
        index: Index = shared.value
        for batch in batches:
            blobs = batch.column("body").to_pylist()
            limits = batch.column("limit").to_pylist() if later else [None] * len(blobs)
            ids = np.array(batch.column("vec_id").to_pylist(), dtype=np.int64)
            for a in range(0, len(blobs), _PACK):
                queries = _matrix(blobs[a : a + _PACK], index.dim)
                bounds = index.bounds(queries).reshape(len(queries), -1)
                order = np.argsort(bounds, axis=1, kind="stable")
                before = np.cumsum(index.held.ravel()[order], axis=1) - index.held.ravel()[order]
                first = np.zeros(bounds.shape, dtype=bool)
                np.put_along_axis(first, order, before <= 4 * k, axis=1)  # the query itself may be among them
                wanted = first & np.isfinite(bounds)
                if later:
                    # A score at the lower end of a long may be a cut one and limits nothing.
                    reach = np.array([
                        np.inf if x is None or x <= -(2.0**63) else np.sqrt(max(0.0, float(q @ q) + index.most - 2.0 * x * index.shrink * index.shrink))
                        for x, q in zip(limits[a : a + _PACK], queries * index.shrink)])
                    wanted = ~first & np.isfinite(bounds) & (bounds <= reach[:, None] * (1 + 1e-7) + 1e-7)
                for ring in np.flatnonzero(wanted.any(axis=0)):
                    own = wanted[:, ring]
                    yield pa.RecordBatch.from_pydict({
                        "ring": [int(ring)], "ids": [ids[a : a + _PACK][own].tobytes()], "rows": [queries[own].tobytes()]}, schema=schema)

    return run


def _products(queries: np.ndarray, vectors: np.ndarray, dim: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        exact = dim * np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) < _EXACT
    if exact:
        return (queries @ vectors.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in queries], [[int(x) for x in row] for row in vectors]
    top = np.iinfo(np.int64)
    return np.array([[min(max(sum(a * b for a, b in zip(q, v)), top.min), top.max) for v in whole[1]] for q in whole[0]], dtype=np.int64)


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int):
    order = np.lexsort((vec, ~score, query))  # ~score falls as the score grows, and does not overflow
    query, vec, score = query[order], vec[order], score[order]
    first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.empty(0, dtype=int)
    place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    keep = place < k
    return query[keep], vec[keep], score[keep]


def _score(shared, k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        dim = shared.value.dim
        found, held = [], 0
        for batch in batches:
            for q_ids, q_rows, v_ids, v_rows in zip(*(batch.column(c).to_pylist() for c in ("q_ids", "q_rows", "ids", "rows"))):
                q_ids, v_ids = np.frombuffer(q_ids, dtype=np.int64), np.frombuffer(v_ids, dtype=np.int64)
                queries = np.frombuffer(q_rows, dtype=np.float64).reshape(len(q_ids), dim)
                vectors = np.frombuffer(v_rows, dtype=np.float64).reshape(len(v_ids), dim)
                scores = _products(queries, vectors, dim)
                # The k-th best of a row, itself left out, bounds what can be among its best.
                top = min(k + 1, scores.shape[1])
                floor = np.partition(scores, scores.shape[1] - top, axis=1)[:, scores.shape[1] - top]
                row, column = np.nonzero(scores >= floor[:, None])
                other = q_ids[row] != v_ids[column]
                row, column = row[other], column[other]
                found.append(_best(q_ids[row], v_ids[column], scores[row, column], k))
                held += len(found[-1][0])
                if held > 1 << 20:
                    found = [_best(*(np.concatenate(x) for x in zip(*found)), k)]
                    held = len(found[0][0])
        if found:
            query, vec, score = _best(*(np.concatenate(x) for x in zip(*found)), k)
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(vec), pa.array(score)], schema=schema)

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of every query row with the
    other rows of (vec_id, embedding), components taken as floor(scale * x)."""
    spark = vectors.sparkSession
    W.small_batches(spark)
    whole = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x * F.lit(float(scale))) == float("inf")))
    clean = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("asks")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(whole)
    single = clean.groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.bool_or("asks").alias("asks"))
    asking = single.where("asks").select("vec_id")
    rows = stage(single.select("vec_id", "embedding").mapInArrow(_quantise(scale), "vec_id long, dim long, norm double, peak double, body binary"), "vectors")
    dim, most, peak = rows.agg(F.coalesce(F.max("dim"), F.lit(0)), F.coalesce(F.max("norm"), F.lit(0.0)), F.coalesce(F.max("peak"), F.lit(0.0))).first()
    shrink = 1.0
    if peak > _HUGE:  # components of at most 1, so squared norms are at most dim
        shrink, most = 2.0 ** -math.frexp(peak)[1], float(dim)

    sample = W.least_rows(rows, F.xxhash64("vec_id"), _SAMPLE).collect()
    lifted = np.zeros((max(1, len(sample)), dim + 1))
    if sample:
        lifted[:, :-1] = shrink * _matrix([bytes(r["body"]) for r in sample], dim)
        lifted[:, -1] = np.sqrt(np.maximum(0.0, most - (lifted[:, :-1] ** 2).sum(axis=1)))
    index = Index(_pivots(lifted, _PIVOTS), dim, most, shrink)
    keyed = stage(rows.mapInArrow(_key(spark.sparkContext.broadcast(index)), "vec_id long, pivot int, distance double, body binary"), "keyed")

    count = len(index.pivots)
    index.low, high = np.zeros(count), np.zeros(count)
    for pivot, low, top in keyed.groupBy("pivot").agg(F.min("distance"), F.max("distance")).collect():
        index.low[pivot], high[pivot] = low, top
    index.step = np.maximum((high - index.low) / _RINGS, 1e-9)
    ring = F.least(F.lit(_RINGS - 1), F.floor(
        (F.col("distance") - F.element_at(F.array(*map(F.lit, index.low.tolist())), F.col("pivot") + 1))
        / F.element_at(F.array(*map(F.lit, index.step.tolist())), F.col("pivot") + 1)).cast("int"))
    ringed = keyed.withColumn("ring", (F.col("pivot") * _RINGS + F.greatest(F.lit(0), ring)).cast("int"))
    index.inner, index.outer = np.zeros(count * _RINGS), np.zeros(count * _RINGS)
    index.held = np.zeros(count * _RINGS, dtype=np.int64)
    for at, inner, outer, n in ringed.groupBy("ring").agg(F.min("distance"), F.max("distance"), F.count(F.lit(1))).collect():
        index.inner[at], index.outer[at], index.held[at] = inner, outer, n
    index.inner, index.outer, index.held = (x.reshape(count, _RINGS) for x in (index.inner, index.outer, index.held))

    shared = spark.sparkContext.broadcast(index)
    packed = "ring int, ids binary, rows binary"
    blocks = stage(ringed.repartitionByRange("ring", "distance", "vec_id").sortWithinPartitions("ring", "distance", "vec_id")
                   .mapInArrow(_pack_blocks, packed), "blocks")
    queries = stage(rows.join(asking, "vec_id", "left_semi").select("vec_id", "body"), "queries")

    def look(asked: DataFrame, later: bool) -> DataFrame:
        packs = asked.mapInArrow(_visits(shared, k, later), packed).select("ring", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"))
        # A pack holds vectors for each of its rings, far more than the queries' file tells: broadcast, all would pass through the driver.
        return blocks.join(packs.hint("merge"), "ring").select("q_ids", "q_rows", "ids", "rows").mapInArrow(_score(shared, k), "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    early = stage(ranked(look(queries, later=False)).drop("rank"), "early")
    limits = early.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("limit"))
    limited = queries.join(limits.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").select("vec_id", "body", F.col("limit").cast("double").alias("limit"))
    return ranked(early.unionByName(look(limited, later=True))).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op1_vector_search(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)))
