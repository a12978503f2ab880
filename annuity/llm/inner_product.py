"""Exact top-k search by inner product.

Vectors are whole numbers, floor(64 x) of each component. All vectors are
rotated to the axes on which a sample varies most (an SVD of at most
``SAMPLE`` rows; the rotation changes no inner product), so the first
components carry most of a product. Candidates are sorted by falling length
and cut into splits in that order, which are searched in rounds: the split of the longest
vectors first, then as many splits as before in each round. After a round every query has the k best
so far, and goes only to the splits of the next one that can still reach its k-th best score, as its
length times the longest vector of the split tells before anything is shuffled. So the number of rounds
is the logarithm of the splits, and what tasks return grows with the rounds, not with the splits. A task
searches one block of queries in one split, taking longer vectors first:

* a query stops when its length times the longest vector left is below its k-th best score;
* otherwise the product of the first ``HEAD`` rotated components plus the
  product of the residual lengths (Cauchy-Schwarz) bounds the score, and only
  candidates that may reach the k-th best are scored, in whole numbers.

Every split returns its k best per query that reach the score so far. Where lengths are alike no split can be left out, and the work grows with queries times rows.

Rows: vectors that are null or hold a null or non-finite component take no
part, nor do null ids. Repeated ids and rows are rows of their own: each is a
candidate, and a query if its id says so, and only a query's own row is left out. Vectors of unequal
length are compared over the components both have; empty ones score 0. Ties go to the smaller id. Other
columns are ignored; an empty table gives an empty result. Vectors so long that a product could
leave 64 bits fail the query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from annuity.llm.common import stage

SCALE = 64
TOP = 20
EVERY = 20
SAMPLE = 4096
HEAD = 24
QUERY_BLOCK = 16384
SPLIT_ROWS = 8192
QUERIES_AT_ONCE = 2048
# A split grows with the root of all rows up to what a task holds well.
ROOT_ROWS, MOST_ROWS = 8, 65536
# A vector's length below which no product of two leaves 64 bits.
LONGEST = 3.0e9
# Rounding of the bounds: far above that of sums of products of doubles.
EPS = 1e-9


def whole_numbers(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(row, vec_id, v array<long>, norm) of the rows that take part."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(F.col(vector), lambda c: c.cast("double")).alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
            .where(F.forall("x", finite)))
    large = F.transform("x", lambda c: c * SCALE)
    length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, c: acc + c.cast("double") * c.cast("double")))
    # Rounding down makes a component longer by less than one.
    checked = F.when(length(large) + F.sqrt(F.size("x")) < LONGEST, F.transform(large, lambda c: F.floor(c).cast("long"))).otherwise(
        F.raise_error(F.lit("inner products of these vectors may not fit 64 bits")).cast("array<bigint>"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", checked.alias("v")).withColumn("norm", length(F.col("v")))


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Axes by falling variance of at most SAMPLE rows, the longest first in id-hash order."""
    some = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("v").collect()
    if not some or not width:
        return np.eye(width)
    m = np.zeros((len(some), width))
    for i, r in enumerate(some):
        m[i, :len(r["v"])] = r["v"]
    return np.linalg.svd(m, full_matrices=True)[2].T if len(some) >= width else np.linalg.eigh(m.T @ m)[1][:, ::-1]


def _matrix(values, width: int) -> np.ndarray:
    out = np.zeros((len(values), width), np.int64)
    for i, v in enumerate(values):
        out[i, :len(v)] = v
    return out


class Best:
    """The k best (score, id) of each query; ties to the smaller id."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.q, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(queries, -np.inf) if floor is None else floor

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        q, score, ids = (np.concatenate(x) for x in ((self.q, q), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, q))
        q, score, ids = q[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        keep = rank < self.k
        last = rank == self.k - 1
        self.floor[q[last]] = np.maximum(self.floor[q[last]], score[last])
        self.q, self.score, self.id = q[keep], score[keep], ids[keep]


def search(queries: np.ndarray, query_rows: np.ndarray, rows: np.ndarray, numbers: np.ndarray, axes: np.ndarray,
           k: int, ids: np.ndarray | None = None, floor: np.ndarray | None = None) -> Best:
    """The k best of ``rows`` (longest first) for each query.

    ``query_rows`` and ``numbers`` are row numbers (a query leaves out its own), ``ids``
    order equal scores (row numbers by default), and ``floor`` is a score that each query's results must reach.
    """
    ids = numbers if ids is None else ids
    best = Best(len(queries), k, floor)
    q_rot, r_rot = queries @ axes, rows @ axes
    q_len, r_len = np.linalg.norm(queries, axis=1), np.linalg.norm(rows, axis=1)
    rest = lambda x: np.sqrt(np.maximum((x[:, HEAD:] ** 2).sum(axis=1), 0.0))
    q_rest, r_rest = rest(q_rot), rest(r_rot)
    # Products of doubles are exact while sums stay below 2^53.
    exact = max(np.abs(queries).max(initial=0), np.abs(rows).max(initial=0)) ** 2 * max(1, queries.shape[1]) < 2 ** 53
    q_num, r_num = (queries.astype(float), rows.astype(float)) if exact else (queries, rows)
    begin, size = 0, 64
    while begin < len(rows):
        end = min(begin + size, len(rows))
        slack = EPS * (1 + q_len * r_len[begin])
        open_ = np.flatnonzero(q_len * r_len[begin] + slack >= best.floor)
        if not len(open_):
            break
        for a in range(0, len(open_), QUERIES_AT_ONCE):
            use = open_[a:a + QUERIES_AT_ONCE]
            bound = q_rot[use, :HEAD] @ r_rot[begin:end, :HEAD].T
            bound += q_rest[use, None] * r_rest[None, begin:end]
            near = bound + slack[use, None] >= best.floor[use, None]
            near &= query_rows[use, None] != numbers[None, begin:end]
            qi, ri = np.nonzero(near)
            if 4 * len(qi) > near.size:
                score = (q_num[use] @ r_num[begin:end].T)[qi, ri]
            else:
                score = np.einsum("ij,ij->i", q_num[use[qi]], r_num[begin + ri])
            score = score.astype(np.int64)
            good = score >= best.floor[use[qi]]
            best.add(use[qi[good]], score[good], ids[begin + ri[good]])
        begin, size = end, min(2 * size, 1024)
    return best


def _block_search(axes: np.ndarray, k: int):
    width = len(axes)

    def found(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values(["vec_id", "row"])
        right = right.sort_values(["norm", "vec_id", "row"], ascending=[False, True, True])
        ids, numbers, q_rows = right["vec_id"].to_numpy(), right["row"].to_numpy(), left["row"].to_numpy()
        floor = left["floor"].to_numpy(float)
        best = search(_matrix(left["v"], width), q_rows, _matrix(right["v"], width), numbers, axes, k, ids,
                      np.where(np.isnan(floor), -np.inf, floor))
        return pd.DataFrame({"row": q_rows[best.q], "query_id": left["vec_id"].to_numpy()[best.q], "vec_id": best.id,
                             "score": best.score})

    return found


def top_k(vectors: DataFrame, k: int = TOP, every: int = EVERY, vec_id: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the vectors whose id is divisible by ``every``."""
    rows = stage(whole_numbers(vectors, vec_id, vector), "vectors")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = width or 0
    axes = rotation(rows, width)
    splits = max(1, -(-n // max(SPLIT_ROWS, min(ROOT_ROWS * math.isqrt(n), MOST_ROWS))))
    blocks = max(1, -(-n // (every * QUERY_BLOCK)))
    # In falling order of length; equal lengths spread by the row number, so no length is too much for a split.
    ordered = rows.repartitionByRange(splits, F.desc("norm"), F.xxhash64("row")) if splits > 1 else rows.coalesce(1)
    placed = stage(ordered.withColumn("split", F.spark_partition_id()), "vector-splits")
    longest = placed.groupBy("split").agg(F.max("norm").alias("longest"))
    last = placed.agg(F.max("split")).first()[0] or 0
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    queries = rows.where(F.col("vec_id") % every == 0).withColumn("block", block)
    candidates = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    by, kept = ("block", "split"), "row long, query_id long, vec_id long, score long"

    def searched(asked: DataFrame, part: Column) -> DataFrame:
        # New columns: both sides of the cogroup come from one table.
        asked = asked.select(*[F.col(c).alias(c) for c in ("row", "vec_id", "v", "floor", *by)])
        return asked.groupBy(*by).cogroup(candidates.where(part).groupBy(*by)).applyInPandas(_block_search(axes, k), kept)

    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    found = searched(queries.withColumns({"split": F.lit(0), "floor": F.lit(None).cast("double")}), F.col("split") == 0)
    begin = 1
    while begin <= last:
        # As many splits again as have been searched.
        end = min(2 * begin, last + 1)
        found = stage(ranked(found).drop("rank"), "best-so-far")
        floors = (found.groupBy(F.col("row").alias("_row")).agg(F.count(F.lit(1)).alias("_n"), F.min("score").alias("_least"))
                  .select("_row", F.when(F.col("_n") >= k, F.col("_least").cast("double")).alias("floor")))
        asked = (queries.join(floors, F.col("row") == F.col("_row"), "left")
                 .withColumn("split", F.explode(F.sequence(F.lit(begin), F.lit(end - 1)))).join(longest, "split"))
        reach = F.col("norm") * F.col("longest") * (1 + EPS) + 1
        asked = asked.where(F.col("floor").isNull() | (reach >= F.col("floor")))
        found = found.unionByName(searched(asked, F.col("split").between(begin, end - 1)))
        begin = end
    return ranked(found).select("query_id", "rank", "vec_id", "score")


def op4(vectors: DataFrame) -> DataFrame:
    return top_k(vectors)


def op4_sql() -> str:
    """The same rows by DuckDB, every query against every vector."""
    return f"""
with v as (select row_number() over () as r, vec_id, list_transform(embedding, lambda c: floor({SCALE} * c::double)::bigint) as w
           from embeddings where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
s as (select q.r, q.vec_id as query_id, c.vec_id as vec_id,
             coalesce(list_sum(list_transform(range(1, least(len(q.w), len(c.w)) + 1), lambda i: q.w[i] * c.w[i])), 0)::bigint as score
      from v q join v c on q.r <> c.r where q.vec_id % {EVERY} = 0),
r as (select query_id, (row_number() over (partition by r order by score desc, vec_id))::int as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= {TOP}"""
