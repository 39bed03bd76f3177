"""Exact top-k by integer inner product, pruned with segment statistics from coarse to fine.

A vector is cut into equal segments. With the mean m, deviation s and length n of each segment,
``|q - x|^2 >= sum n * ((m_q - m_x)^2 + (s_q - s_x)^2)``, and this bound grows tighter as segments are halved.
As ``2 q.x = |q|^2 + |x|^2 - |q - x|^2``, a lower bound of the distance is an upper bound of the inner product: a pair
whose bound stays below the k-th best score known for its query is dropped, and only survivors are scored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import materialize

#: Segments at each resolution, coarse to fine; a dimension that they do not divide leaves a shorter last segment.
LEVELS = (2, 8)
BLOCK_ROWS = 8192
#: Pairs bounded at a time in a task.
CELL_PAIRS = 1 << 21
#: Share of a cell's pairs from which on all of them are multiplied at once.
DENSE = 1 / 64
EXACT = 2**53
PACKED = "ids binary, numbers binary, dim int, n int"
HITS = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id long, numbers array<bigint>: floor(256 * x) of every component.

    Rows with a null id, a null vector, or a null or non-finite component are left out; so are empty vectors.
    """
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad)
    return rows.select(
        F.col(key).cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("numbers"),
    )


def _pack(block_rows: int):
    """Rows of a partition to blocks of one dimension each, at most ``block_rows`` long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def packed(dim: int) -> pa.RecordBatch:
            ids = np.concatenate([x for x, _ in kept[dim]])
            numbers = np.concatenate([x for _, x in kept.pop(dim)])
            return pa.RecordBatch.from_pydict(
                {"ids": [ids.tobytes()], "numbers": [numbers.tobytes()], "dim": pa.array([dim], pa.int32()), "n": pa.array([len(ids)], pa.int32())}
            )

        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            arrays = batch.column("numbers")
            flat, ends = arrays.flatten().to_numpy(zero_copy_only=False), np.cumsum(arrays.value_lengths().to_numpy(zero_copy_only=False))
            sizes = np.diff(ends, prepend=0)
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                matrix = flat[(ends[rows] - dim)[:, None] + np.arange(dim)].astype(np.int64)
                for a in range(0, len(rows), block_rows):
                    part = slice(a, a + block_rows)
                    held = sum(len(x) for x, _ in kept.get(dim, []))
                    if held and held + len(ids[rows[part]]) > block_rows:
                        yield packed(dim)
                    kept.setdefault(dim, []).append((ids[rows[part]], matrix[part]))
        for dim in list(kept):
            yield packed(dim)

    return run


def segment_features(numbers: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(n) * (mean, deviation) of each segment, so that the product of two rows is their largest inner product."""
    edges = np.unique(np.linspace(0, numbers.shape[1], min(segments, numbers.shape[1]) + 1).astype(int))[:-1]
    length = np.diff(edges, append=numbers.shape[1])
    mean = np.add.reduceat(numbers, edges, axis=1) / length
    deviation = np.sqrt(np.maximum(np.add.reduceat(numbers * numbers, edges, axis=1) / length - mean * mean, 0))
    return np.hstack([mean * np.sqrt(length), deviation * np.sqrt(length)])


def _exact(a: np.ndarray, b: np.ndarray, spec: str) -> np.ndarray:
    """Integer products: in doubles where these are exact, else in Python's integers; beyond a long it raises."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[-1]
    if most < EXACT:
        return np.einsum(spec, a.astype(float), b.astype(float), optimize=True).astype(np.int64)
    if most < 2**62:
        return np.einsum(spec, a, b)
    return np.einsum(spec, a.astype(object), b.astype(object)).astype(np.int64)


def _gathered(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, product: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The product of each pair of rows, some pairs at a time."""
    parts = [slice(i, i + CELL_PAIRS // 8) for i in range(0, max(1, len(at_a)), CELL_PAIRS // 8)]
    return np.concatenate([product(a[at_a[part]], b[at_b[part]]) for part in parts])


def _score(k: int, levels: tuple[int, ...]):
    """The k best candidates of each query in a cell (a block of queries and a block of candidates)."""

    def cell(row: dict) -> Iterator[pa.RecordBatch]:
        dim = row["dim"]
        q_ids, x_ids = (np.frombuffer(row[c], np.int64) for c in ("q_ids", "ids"))
        q, x = (np.frombuffer(row[c], np.int64).reshape(-1, dim) for c in ("q_numbers", "numbers"))
        floors = np.frombuffer(row["floors"], np.int64) if row["floors"] is not None else np.full(len(q), np.iinfo(np.int64).min)
        q_floats, x_floats = q.astype(float), x.astype(float)
        features = [(segment_features(q_floats, s), segment_features(x_floats, s)) for s in levels]
        # Products of whole numbers below 2 ** 53 are exact in doubles, whatever the order of the sum.
        in_doubles = np.abs(q_floats).max(initial=0) * np.abs(x_floats).max(initial=0) * dim < EXACT
        q_norms, longest = np.linalg.norm(q_floats, axis=1), np.linalg.norm(x_floats, axis=1).max(initial=0)
        step = max(1, CELL_PAIRS // len(x))
        for a in range(0, len(q), step):
            part = slice(a, a + step)
            own = q_ids[part, None] == x_ids[None, :]
            coarse = features[0][0][part] @ features[0][1].T
            # Rounding: the bound is widened by far more than the products can lose.
            slack = 1e-9 * q_norms[part, None] * longest + 1e-6
            coarse[own] = -np.inf
            floor = floors[part].astype(float)
            if len(x) > k:
                # The candidates that look best give a k-th score to beat.
                first = np.argpartition(-coarse, k - 1, axis=1)[:, :k]
                seed = _exact(q[part], x[first], "qd,qkd->qk")
                seed = np.where(np.take_along_axis(own, first, 1), np.iinfo(np.int64).min, seed)
                floor = np.maximum(floor, seed.min(axis=1).astype(float))
            alive = (coarse + slack >= floor[:, None]) & ~own
            for fine_q, fine_x in features[1:]:
                # Where many pairs are left, one matrix product of all costs less than to gather each of them.
                if np.count_nonzero(alive) > DENSE * alive.size:
                    alive &= fine_q[part] @ fine_x.T + slack >= floor[:, None]
                    continue
                at_q, at_x = np.nonzero(alive)
                bound = _gathered(fine_q[part], fine_x, at_q, at_x, lambda a, b: np.einsum("ij,ij->i", a, b))
                drop = bound + slack[at_q, 0] < floor[at_q]
                alive[at_q[drop], at_x[drop]] = False
            if in_doubles and np.count_nonzero(alive) > DENSE * alive.size:
                scores = np.where(alive, q_floats[part] @ x_floats.T, -np.inf)
                if len(x) > k:
                    floor = np.maximum(floor, np.partition(scores, len(x) - k, axis=1)[:, -k])
                at_q, at_x = np.nonzero(alive & (scores >= floor[:, None]))
                score = scores[at_q, at_x].astype(np.int64)
            else:
                at_q, at_x = np.nonzero(alive)
                score = _gathered(q[part], x, at_q, at_x, lambda a, b: _exact(a, b, "ij,ij->i")).astype(np.int64)
            order = np.lexsort((x_ids[at_x], -score, at_q))
            at_q, at_x, score = at_q[order], at_x[order], score[order]
            starts = np.searchsorted(at_q, at_q, side="left")
            best = np.arange(len(at_q)) - starts < k
            columns = (q_ids[part][at_q[best]], x_ids[at_x[best]], score[best])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from cell(batch.slice(i, 1).to_pylist()[0])

    return run


def exact_top_k(
    vectors: DataFrame,
    is_query: F.Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    levels: tuple[int, ...] = LEVELS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``is_query`` marks, the k highest scores among all other rows.

    Candidates stay in the blocks their scan made; the query blocks, packed into a few rows, are joined to them cell by
    cell, so a cell holds at most ``block_rows`` rows of each side. One corpus block first gives every query
    a score to beat; the other cells emit only what reaches it.

    Ties go to the smaller id. Vectors are compared with those of their own dimension only. Rows with a null id or an
    unusable vector (see :func:`quantised`) take no part. Candidates with the query's id are its own and are skipped; rows
    that repeat another id are candidates of their own, and a repeated query asks once, with its smallest vector. An empty
    table gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, key, vector)
    asked = quantised(vectors.where(is_query), key, vector).groupBy("id").agg(F.min("numbers").alias("numbers"))
    corpus = materialize(rows.mapInArrow(_pack(block_rows), PACKED).withColumn("block", F.monotonically_increasing_id()), "top-k-corpus")
    asked = asked.repartition(-(-max(1, asked.count()) // block_rows), "id")
    queries = asked.mapInArrow(_pack(block_rows), PACKED).withColumn("q_block", F.monotonically_increasing_id())
    queries = materialize(queries.select("q_block", "dim", F.col("ids").alias("q_ids"), F.col("numbers").alias("q_numbers")), "top-k-queries")

    cells = queries.select("q_block", "dim").join(corpus.select("block", "dim"), "dim")
    # The block of each dimension that all its queries meet first.
    first = corpus.groupBy("dim").agg(F.max_by("block", F.struct("n", "block")).alias("block"))

    def scored(pairs: DataFrame, candidates: DataFrame, asked: DataFrame) -> DataFrame:
        full = pairs.join(candidates, ["block", "dim"]).join(asked, ["q_block", "dim"])
        full = full.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block", "q_block")
        return full.select("dim", "q_ids", "q_numbers", "ids", "numbers", "floors").mapInArrow(_score(k, levels), HITS)

    opened = queries.withColumn("floors", F.lit(None).cast("binary"))
    seeds = materialize(scored(cells.join(first, ["block", "dim"], "left_semi"), corpus, opened), "top-k-seeds")
    least = seeds.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    hits = materialize(scored(cells.join(first, ["block", "dim"], "left_anti"), corpus, _with_floors(queries, least)), "top-k-hits")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = seeds.unionByName(hits).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _with_floors(queries: DataFrame, least: DataFrame) -> DataFrame:
    """The score to beat of every packed query, in the order of its block."""
    lowest = -(2**63)
    ids = queries.mapInArrow(_unpack, "q_block long, at int, query_id long")
    floors = ids.join(least, "query_id", "left").groupBy("q_block").agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("floor", F.lit(lowest)).alias("floor")))).alias("f"))
    packed = floors.select("q_block", F.col("f.floor").alias("f")).mapInArrow(_pack_floors, "q_block long, floors binary")
    return queries.join(packed, "q_block")


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, ids in zip(batch.column("q_block").to_pylist(), batch.column("q_ids").to_pylist(), strict=True):
            ids = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), block), pa.int64()), pa.array(np.arange(len(ids)), pa.int32()), pa.array(ids)], names=["q_block", "at", "query_id"]
            )


def _pack_floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        floors = [np.asarray(x, np.int64).tobytes() for x in batch.column("f").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("q_block"), pa.array(floors, pa.binary())], names=["q_block", "floors"])
