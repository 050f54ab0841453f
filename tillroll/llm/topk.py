"""Operator 3: exact top-k by inner product without random access.

Vectors are dealt into blocks.  In a block every dimension is a list sorted by
component, and a query reads each list from the end that scores highest for
it, a run of rows at a time and in sorted order only.  After each run every
vector has a lower bound (entries read, plus the list's last value for the
rest) and an upper bound (entries read, plus the value last read).  A query
stops when the vectors whose upper bound reaches its k-th lower bound are few;
only for those the remaining entries are added up.  The tops of the blocks are
merged by Spark.

Defined results: vectors that are NULL, or hold NULL or non-finite components,
and rows without an id take no part.  Shorter vectors count as padded with
zeros.  Rows that repeat an id count once, by their smallest vector.  Ties go
to the smaller id.  Scores must fit a long, and components 2**52 / dimensions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillroll.llm.common import ship

SCHEMA = "query_id long, vec_id long, score long"
#: Vectors of a block, queries that meet a block together, and queries whose
#: bounds are held at once: 4096 x 128 doubles are 4 MB.
BLOCK_ROWS, QUERY_ROWS, AT_ONCE = 4096, 8192, 128


def _matrix(t: pa.Table, scale: float) -> np.ndarray:
    flat = t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat.astype("f8") * scale).reshape(t.num_rows, -1)


def nra_block(ids, c, qids, q, k):
    """Rows (query, vector, score) of the k best of this block per query."""
    n = len(ids)
    order = np.argsort(c, axis=0, kind="stable")
    lists = np.take_along_axis(c, order, axis=0)          # ascending lists
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[:, None], axis=0)
    low_end, high_end = lists[0], lists[-1]
    few = max(4 * k, 32)
    out = []
    for s in range(0, len(qids), AT_ONCE):
        ask, name = q[s:s + AT_ONCE], qids[s:s + AT_ONCE]
        todo = np.arange(len(ask))
        depth = min(n, max(64, n // 16))
        while len(todo):
            up, down = np.maximum(ask[todo], 0.0), np.minimum(ask[todo], 0.0)
            seen_d, seen_a = rank >= n - depth, rank < depth
            known = up @ (c * seen_d).T + down @ (c * seen_a).T
            last_d, last_a = lists[n - depth], lists[depth - 1]
            upper = known + (up * last_d) @ (~seen_d).T + (down * last_a) @ (~seen_a).T
            lower = known + (up * low_end) @ (~seen_d).T + (down * high_end) @ (~seen_a).T
            own = ids[None, :] == name[todo][:, None]
            upper[own] = lower[own] = -np.inf
            kth = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(todo), -np.inf)
            open_ = upper >= kth[:, None]
            open_[own] = False
            done = (open_.sum(axis=1) <= few) | (depth == n)
            for row in np.flatnonzero(done):
                at = np.flatnonzero(open_[row])
                score = c[at] @ ask[todo[row]]
                best = np.lexsort((ids[at], -score))[:k]
                out.append((np.full(len(best), name[todo[row]]), ids[at][best],
                            score[best].astype("i8")))
            todo = todo[~done]
            depth = min(n, depth * 2)
    if not out:
        return [np.empty(0, "i8")] * 3
    return [np.concatenate(x) for x in zip(*out)]


def _task(k: int, scale: float):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            cols = [np.empty(0, "i8")] * 3
        else:
            cols = nra_block(left["id"].to_numpy(), _matrix(left, scale),
                             right["id"].to_numpy(), _matrix(right, scale), k)
        return pa.table({n: pa.array(x, pa.int64()) for n, x in
                         zip(("query_id", "vec_id", "score"), cols)})
    return run


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the rows that take part, one per id."""
    rows = df.select(F.col(id_col).cast("long").alias("id"),
                     F.col(vec_col).alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def topk(candidates: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
         vec_col: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query."""
    spark = candidates.sparkSession
    ship(spark)
    c, q = usable(candidates, id_col, vec_col), usable(queries, id_col, vec_col)
    n, dims = c.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    m, qdims = q.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    dims = max(dims or 0, qdims or 0, 1)
    blocks, qblocks = -(-max(n, 1) // BLOCK_ROWS), -(-max(m, 1) // QUERY_ROWS)
    pad = F.concat(F.col("v").cast("array<double>"),
                   F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("v")))

    def dealt(df, own, count, other, others):
        return df.select("id", pad.alias("v"), F.pmod(F.xxhash64("id"), F.lit(count)).alias(own),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))).alias(other))

    left = dealt(c, "block", blocks, "part", qblocks)
    right = dealt(q, "part", qblocks, "block", blocks)
    tops = (left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
                .applyInArrow(_task(k, scale), SCHEMA))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (tops.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))
