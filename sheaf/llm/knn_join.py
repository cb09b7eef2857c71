"""Exact top-k search by a Voronoi kNN join over inner products.

Pivots, more of them for a larger table, split the data into Voronoi cells. A
cell's summary (how many vectors, the largest distance from the pivot) bounds
what a query can score in it: with p the pivot and d the largest distance, at
most <q, p> + |q| d. A query's k-th best score among a bounded sample of the
data is one that its k-th best of all can't fall below, so it needs only the
cells whose bound reaches that. Queries are sent to the cells they need, being
the fewer; a cell's vectors are sent as often as there are groups of queries
that need it, and groups are large. There they are scored in chunks of bounded
size by matrix products, and a query's chunk winners are merged.

Cells are cut in chunks by hash of the vector's id and queries in groups by hash
of the query's id, so neither a cell nor a group that holds much of the data
lands in one task. Pivots and the sample affect cost, never results; where
vectors have no clusters in many dimensions, every query needs every cell.

Components are floor(64 * x), x as double. Defined results: vectors that are
null, or hold a null or a component that isn't finite, take no part, nor do rows
with a null id; shorter vectors count as filled up with zeros; rows that repeat
id and vector count once; every row of the query's id is its own; scores beyond
64 bits are clipped; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheaf.llm.common import materialize, slices, small_batches

K = 20
SCALE = 64
#: Vectors in a chunk and queries in a group, at most; the fewest that a chunk is cut for.
CHUNK = 65536
GROUP = 32768
LEAST_CHUNK = 1024
#: Pivots and rows of the sample, at most.
PIVOTS = 1024
SAMPLE = 8192
#: Scores that a task holds at a time.
HELD = 1 << 22


def quantized(vectors: DataFrame) -> DataFrame:
    """vec_id and the components that take part, as doubles."""
    x = F.transform("embedding", lambda v: F.floor(F.lit(float(SCALE)) * v.cast("double")).cast("double"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    whole = F.transform("embedding", lambda v: v.cast("double") * SCALE)
    exact = F.when(F.exists(whole, lambda v: F.abs(v) >= 2.0**62), whole).otherwise(x)  # so large a double is whole
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))).select("vec_id", exact.alias("x"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of a batch as rows, filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dim))
    out[np.arange(dim)[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def find_pivots(sample: np.ndarray, n: int, rounds: int = 5) -> np.ndarray:
    """Centres of a few rounds of k-means from the first n rows."""
    pivots = sample[:n].copy()
    for _ in range(rounds):
        own = nearest(sample, pivots)[0]
        for j in range(len(pivots)):
            if (own == j).any():
                pivots[j] = sample[own == j].mean(0)
    return np.round(pivots)


def nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row and the distance, rounded outwards."""
    d2 = (x * x).sum(1)[:, None] - 2 * (x @ pivots.T) + (pivots * pivots).sum(1)[None, :]
    cell = d2.argmin(1)
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1)) * (1 + 1e-9)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products, as floats where these are exact."""
    most = np.sqrt((q * q).sum(1).max()) * np.sqrt((x * x).sum(1).max()) * (1 + 1e-6) if len(q) and len(x) else 0
    if most < 2.0**24:
        return q.astype(np.float32) @ x.T.astype(np.float32)
    if most < 2.0**53:
        return q @ x.T
    whole = np.array([[int(v) for v in r] for r in q], object) @ np.array([[int(v) for v in r] for r in x], object).T
    return np.clip(whole, -(2**63), 2**63 - 1).astype(np.int64)


def sure_scores(ids: np.ndarray, q: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th best score among a sample's rows of other ids; -inf where these are fewer."""
    if len(sample) < k:
        return np.full(len(q), -np.inf)
    scores = products(q, sample).astype(np.float64)
    scores[ids[:, None] == sample_ids[None, :]] = -np.inf
    return np.partition(scores, len(sample) - k, axis=1)[:, len(sample) - k]


def reached(q: np.ndarray, sure: np.ndarray, pivots: np.ndarray, farthest: np.ndarray) -> np.ndarray:
    """Whether a cell can hold, for each query and cell, a vector that scores at least the query's sure score."""
    inner, spread = q @ pivots.T, np.sqrt((q * q).sum(1))[:, None] * farthest[None, :]
    return inner + spread + 1e-6 * (1 + np.abs(inner) + spread) >= sure[:, None]


def winners(ids: np.ndarray, q: np.ndarray, sure: np.ndarray, theirs: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of each query's k best of other ids that aren't below its sure score; theirs rise."""
    out = [(np.zeros(0, np.int64),) * 3]
    step = max(1, HELD // max(1, len(x)))
    for at in range(0, len(ids), step):
        own = ids[at : at + step]
        scores = products(q[at : at + step], x)
        fits = (theirs[None, :] != own[:, None]) & (scores >= sure[at : at + step, None] - 1)
        if scores.shape[1] > k:
            lowest = np.iinfo(np.int64).min if scores.dtype == np.int64 else -np.inf
            fits &= scores >= np.partition(np.where(fits, scores, lowest), scores.shape[1] - k, axis=1)[:, scores.shape[1] - k][:, None]
        row, column = np.nonzero(fits)
        score = scores[row, column].astype(np.int64)
        order = np.lexsort((column, -score, row))  # ids rise, so ties go to the smaller
        row, column, score = row[order], column[order], score[order]
        first = np.searchsorted(row, np.arange(len(own)))
        best = np.arange(len(row)) - first[row] < k
        out.append((own[row[best]], theirs[column[best]], score[best]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def top_k(vectors: DataFrame, is_query, k: int = K, chunk: int = CHUNK, group: int = GROUP, least_chunk: int = LEAST_CHUNK) -> DataFrame:
    """The k vectors of highest inner product for each query row: query_id, rank, vec_id, score.

    is_query: a condition on vec_id.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    own = quantized(vectors)
    largest = F.aggregate("x", F.lit(0.0), lambda m, v: F.greatest(m, F.abs(v)))
    n, n_queries, dim, most = own.agg(F.count("*"), F.count_if(is_query), F.coalesce(F.max(F.size("x")), F.lit(0)), F.max(largest)).first()
    dim = max(dim, 1)
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    element = "short" if most < 2**15 else "double"
    own = own.select("vec_id", F.col("x").cast(f"array<{element}>").alias("x"))
    drawn = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    sample_ids, sample = once(drawn.column("vec_id").to_numpy(), matrix(drawn.column("x").combine_chunks(), dim))
    pivots = find_pivots(sample, min(PIVOTS, max(4, round(n**0.5 / 4)), len(sample)))
    sent = spark.sparkContext.broadcast((sample_ids, sample, pivots))  # of bounded size

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = nearest(matrix(batch.column("x"), dim), sent.value[2])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "x", "query")), pa.array(cell, pa.int32()), pa.array(far)], ["vec_id", "x", "query", "cell", "far"])

    placed = own.select("vec_id", "x", is_query.alias("query")).mapInArrow(assign, f"vec_id long, x array<{element}>, query boolean, cell int, far double")
    placed = materialize(placed, "knn-cells")
    held, farthest = np.zeros(len(pivots), np.int64), np.full(len(pivots), -np.inf)
    for cell, rows, far in placed.groupBy("cell").agg(F.count("*"), F.max("far")).collect():  # PIVOTS at most
        held[cell], farthest[cell] = rows, far
    chunks = -(-held // min(chunk, max(least_chunk, n // 64)))
    groups = -(-n_queries // group)
    known = np.flatnonzero(held)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample_ids, sample, pivots = sent.value
        for batch in slices(batches, 64):
            ids, q = batch.column("vec_id").to_numpy(), matrix(batch.column("x"), dim)
            sure = sure_scores(ids, q, sample_ids, sample, k)
            row, cell = np.nonzero(reached(q, sure, pivots[known], farthest[known]))
            cell = known[cell]
            times = chunks[cell]
            part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, cell = np.repeat(row, times), np.repeat(cell, times)
            kept = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(part, pa.int32()), kept.column("grp"), kept.column("vec_id"), kept.column("x"), pa.array(sure[row])], ["cell", "chunk", "grp", "vec_id", "x", "sure"])

    grp = F.pmod(F.xxhash64(F.col("vec_id") + 1), F.lit(groups)).cast("int").alias("grp")
    asked = placed.filter("query").select(grp, "vec_id", "x").mapInArrow(ask, f"cell int, chunk int, grp int, vec_id long, x array<{element}>, sure double")
    # which groups of queries need a cell: of no more entries than cells times groups
    needs = {r["cell"]: r["groups"] for r in asked.groupBy("cell").agg(F.sort_array(F.collect_set("grp")).alias("groups")).collect()}
    wanted = spark.sparkContext.broadcast(needs)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            theirs = [wanted.value.get(c, ()) for c in batch.column("cell").to_pylist()]
            kept = batch.take(pa.array(np.repeat(np.arange(len(theirs)), [len(g) for g in theirs])))
            yield pa.RecordBatch.from_arrays([kept.column("cell"), kept.column("chunk"), pa.array([g for gs in theirs for g in gs], pa.int32()), kept.column("vec_id"), kept.column("x")], ["cell", "chunk", "grp", "vec_id", "x"])

    of_cell = F.element_at(F.array(*(F.lit(max(1, int(c))) for c in chunks)), F.col("cell") + 1)
    chunked = placed.select("cell", F.pmod(F.xxhash64("vec_id"), of_cell).cast("int").alias("chunk"), "vec_id", "x")
    data = chunked.mapInArrow(replicate, f"cell int, chunk int, grp int, vec_id long, x array<{element}>")

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, q, sure = left.column("vec_id").to_numpy(), matrix(left.column("x").combine_chunks(), dim), left.column("sure").to_numpy()
        theirs, x = once(right.column("vec_id").to_numpy(), matrix(right.column("x").combine_chunks(), dim))
        (ids, q), sure = once(ids, q), sure[first_of(ids, q)]
        order = np.argsort(theirs, kind="stable")
        found = winners(ids, q, sure, theirs[order], x[order], k)
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("query_id", "vec_id", "score"), found, strict=True)})

    keys = ("cell", "chunk", "grp")
    won = asked.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(solve, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return won.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def first_of(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The first rows of those that repeat id and vector."""
    if len(np.unique(ids)) == len(ids):
        return np.arange(len(ids))
    seen: dict[tuple, int] = {}
    for i, key in enumerate(zip(ids.tolist(), (r.tobytes() for r in x), strict=True)):
        seen.setdefault(key, i)
    return np.fromiter(seen.values(), int)


def once(ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without rows that repeat id and vector."""
    keep = first_of(ids, x)
    return ids[keep], x[keep]
