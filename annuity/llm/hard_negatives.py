"""Hard-negative mining by a vertical scan of columnar dimensions (BOND).

Vectors are whole numbers, floor(256 x) of each component, and lie in splits of
about ``SPLIT_ROWS`` rows, dealt by a hash, stored column by column. For a block
of anchors a task reads the columns of its split one after another in each
anchor's order of falling magnitude, so the largest terms of a product come
first. With the smallest and largest value of every column that is still unread, a
row's product is known to lie between two bounds, which close in as
columns are read. After every ``STEP`` columns the bitmap of candidates shrinks:

* positives (rows of the anchor's label): a row goes if its upper bound is
  below the k-th highest lower bound, or the k-th best of splits before;
* negatives (rows of other labels): the product is wanted in a window of
  each positive's score. A row goes if its bounds miss every window, or if, in
  each window it can reach, enough rows that surely lie in it are surely higher.

Rows that are left when all columns are read have their exact products, and
windows are resolved on those. The best of all splits are the result.

Before the splits are searched, each anchor gets a floor: the k-th best exact score
among rows of a first split. Anchors are dealt to the splits that can reach
their floor or windows by the splits' column ranges; the others are dropped
before the shuffle. The number of splits searched still grows with the rows.

Rows: vectors that are null or hold a null or non-finite component take no
part, nor do rows with a null label or id. Repeated ids and rows are rows of their
own: each of them is an anchor, positive and negative as its id says. Vectors
of unequal length are compared over the components both have. Ties go to the smaller id. Other columns are
ignored; an empty table gives an empty result. Vectors so long that a product could leave
64 bits fail the query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from annuity.llm.common import stage

SCALE = 256
EVERY = 100
POSITIVES = 5
NEGATIVES = 10
# Shares of the positive's score, in hundredths.
LOWEST, HIGHEST = 30, 90
SPLIT_ROWS = 16384
ANCHOR_BLOCK = 4096
STEP = 8
# A vector's length below which no product of two leaves 64 bits.
LONGEST = 3.0e9


def whole_numbers(vectors: DataFrame, vec_id: str, vector: str, label: Column) -> DataFrame:
    """(row, vec_id, label, v array<long>) of the rows that take part."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), label.alias("label"),
                           F.transform(F.col(vector), lambda c: c.cast("double")).alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull())
            .where(F.forall("x", finite)))
    large = F.transform("x", lambda c: c * SCALE)
    # Rounding down makes a component longer by less than one.
    length = F.sqrt(F.aggregate(large, F.lit(0.0), lambda a, c: a + c * c)) + F.sqrt(F.size("x"))
    checked = F.when(length < LONGEST, F.transform(large, lambda c: F.floor(c).cast("long"))).otherwise(
        F.raise_error(F.lit("inner products of these vectors may not fit 64 bits")).cast("array<bigint>"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", checked.alias("v"))


class Split:
    """The columns of one split with their smallest and largest values; short vectors are filled with zeros."""

    def __init__(self, rows: pd.DataFrame, width: int):
        rows = rows.sort_values(["vec_id", "row"])
        self.row, self.ids = rows["row"].to_numpy(), rows["vec_id"].to_numpy()
        self.label = rows["label"].to_numpy()
        self.columns = matrix(rows["v"], width).T.copy()
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)


def matrix(values, width: int) -> np.ndarray:
    out = np.zeros((len(values), width), np.int64)
    for i, v in enumerate(values):
        out[i, :len(v)] = v
    return out


def spread(anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of what each column can add to a product, the least and the most."""
    a, b = anchor * low, anchor * high
    return np.minimum(a, b), np.maximum(a, b)


def _order(anchor: np.ndarray) -> tuple[np.ndarray, int]:
    order = np.argsort(-np.abs(anchor), kind="stable")
    return order, int(np.count_nonzero(anchor))


def scan(split: Split, anchor: np.ndarray, candidates: np.ndarray, shrink) -> tuple[np.ndarray, np.ndarray]:
    """(candidates left, their exact products), reading columns by falling magnitude of the anchor.

    ``shrink(lower, upper)`` tells which candidates stay.
    """
    order, n = _order(anchor)
    widest = np.maximum(np.abs(split.low.astype(float)), np.abs(split.high.astype(float)))
    bounded = float(np.abs(anchor.astype(float)) @ widest) < 2 ** 62  # else sums of bounds could leave 64 bits
    least, most = spread(anchor[order], split.low[order], split.high[order])
    # What the columns from k on can still add.
    least, most = (np.append(x[::-1].cumsum()[::-1], 0) for x in (least, most))
    product = np.zeros(len(candidates), np.int64)
    for begin in range(0, n, STEP):
        end = min(begin + STEP, n)
        for k in order[begin:end]:
            product += anchor[k] * split.columns[k, candidates]
        if not bounded and end < n:
            continue
        keep = shrink(product + least[end], product + most[end])
        if not keep.all():
            candidates, product = candidates[keep], product[keep]
        if not len(candidates):
            break
    return candidates, product


def kth(values: np.ndarray, k: int) -> int | None:
    """The k-th highest value, None if there are fewer."""
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else None


def best_positives(split: Split, row: int, label: int, anchor: np.ndarray, k: int, floor: int | None) -> list[tuple]:
    """(row, vec_id, score) of the split's k best rows of the label that reach ``floor``."""
    def shrink(lower, upper):
        limit = max((x for x in (kth(lower, k), floor) if x is not None), default=None)
        return np.ones(len(lower), bool) if limit is None else upper >= limit

    same = np.flatnonzero((split.label == label) & (split.row != row))
    found, score = scan(split, anchor, same, shrink)
    best = np.lexsort((split.row[found], split.ids[found], -score))[:k]
    return [(split.row[found[i]], split.ids[found[i]], score[i]) for i in best]


def best_negatives(split: Split, label: int, anchor: np.ndarray, windows: np.ndarray, k: int) -> list[tuple]:
    """(window number, vec_id, score) of the split's k best rows of other labels in each window.

    ``windows``: lowest and highest product of each, both allowed.
    """
    def shrink(lower, upper):
        keep = np.zeros(len(lower), bool)
        for low, high in windows:
            reach = (upper >= low) & (lower <= high)
            sure = kth(lower[(lower >= low) & (upper <= high)], k)
            keep |= reach if sure is None else reach & (upper >= sure)
        return keep

    others = np.flatnonzero(split.label != label)
    found, score = scan(split, anchor, others, shrink)
    out = []
    for w, (low, high) in enumerate(windows):
        inside = np.flatnonzero((score >= low) & (score <= high))
        best = inside[np.lexsort((split.ids[found[inside]], -score[inside]))[:k]]
        out += [(w, split.ids[found[i]], score[i]) for i in best]
    return out


def window_of(score: int, lowest: int, highest: int) -> tuple[int, int]:
    """Whole products p with lowest * score <= 100 p <= highest * score."""
    return -(-lowest * score // 100), highest * score // 100


def _positives_in_split(width: int, k: int):
    def found(key: tuple, anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(rows):
            split, vectors = Split(rows, width), matrix(anchors["v"], width)
            floors = anchors["floor"].to_numpy()
            for i, (row, anchor_id, label) in enumerate(zip(anchors["row"], anchors["vec_id"], anchors["label"])):
                floor = None if pd.isna(floors[i]) else int(floors[i])
                out += [(row, anchor_id, *x) for x in best_positives(split, row, label, vectors[i], k, floor)]
        return pd.DataFrame(out, columns=["row", "anchor_id", "positive_row", "positive_id", "positive_score"]).astype("int64")

    return found


def _negatives_in_split(width: int, k: int, lowest: int, highest: int):
    def found(key: tuple, anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(rows):
            split, vectors = Split(rows, width), matrix(anchors["v"], width)
            for i, (row, label, scores) in enumerate(zip(anchors["row"], anchors["label"], anchors["scores"])):
                scores = [int(s) for s in scores]
                windows = np.array([window_of(s, lowest, highest) for s in scores], np.int64)
                out += [(row, scores[w], vec_id, score) for w, vec_id, score in best_negatives(split, label, vectors[i], windows, k)]
        return pd.DataFrame(out, columns=["row", "positive_score", "negative_id", "negative_score"]).astype("int64")

    return found


def _ranges(placed: DataFrame) -> DataFrame:
    """(split, low, high): smallest and largest value of each column of each split."""
    ends = (placed.select("split", F.posexplode("v").alias("k", "x")).groupBy("split", "k")
            .agg(F.min("x").alias("low"), F.max("x").alias("high")))
    ordered = F.array_sort(F.collect_list(F.struct("k", "low", "high")))
    return (ends.groupBy("split").agg(ordered.alias("ends"))
            .select("split", F.col("ends.low").alias("low"), F.col("ends.high").alias("high")))


def _reach() -> Column:
    """The highest product that an anchor ``v`` can have in a split with column ranges ``low`` and ``high``.

    Unequal lengths: a missing component counts as zero.
    """
    x = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    most = lambda t: F.greatest(x(t["v"]) * x(t["low"]), x(t["v"]) * x(t["high"]), F.lit(0.0))
    # Doubles round: a little is added.
    return F.aggregate(F.arrays_zip("v", "low", "high"), F.lit(0.0), lambda a, t: a + most(t)) * (1 + 1e-9) + 1


def _dealt(anchors: DataFrame, ranges: DataFrame, splits: int, floor: Column) -> DataFrame:
    """A copy of each anchor for every split whose column ranges let a product reach ``floor`` (null: every split)."""
    copies = anchors.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
    # A split of empty vectors has no ranges.
    return (copies.join(ranges, "split", "left")
            .where(floor.isNull() | F.coalesce(_reach() >= floor, F.lit(True)))
            # New columns: both sides of the cogroup come from one table.
            .select(*[F.col(c).alias(c) for c in copies.columns]))


def hard_negatives(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   lowest: int = LOWEST, highest: int = HIGHEST, vec_id: str = "vec_id", vector: str = "embedding",
                   label: Column | str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every ``every``-th id.

    ``lowest`` and ``highest``: a negative's score in hundredths of the positive's.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = stage(whole_numbers(vectors, vec_id, vector, label.cast("long")), "vectors")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = width or 0
    splits = max(1, -(-n // SPLIT_ROWS))
    blocks = max(1, -(-n // (every * ANCHOR_BLOCK)))
    placed = rows.withColumn("split", F.pmod(F.xxhash64("row"), F.lit(splits)).cast("int"))
    ranges = stage(_ranges(placed), "column-ranges")
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")
    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("block", block)
    candidates = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    by = ("block", "split")

    # Positives: the first split gives each anchor a floor, the others are asked only where they can reach it.
    kept = "row long, anchor_id long, positive_row long, positive_id long, positive_score long"
    search = _positives_in_split(width, positives)
    no_floor = F.lit(None).cast("long").alias("floor")
    first = stage(anchors.withColumn("split", F.lit(0)).select("*", no_floor).groupBy(*by)
                  .cogroup(candidates.where(F.col("split") == 0).groupBy(*by)).applyInPandas(search, kept), "first-positives")
    found = first
    if splits > 1:
        floors = (first.groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.min("positive_score").alias("least"))
                  .select(F.col("row").alias("_row"), F.when(F.col("n") >= positives, F.col("least")).alias("floor")))
        asked = anchors.join(floors, F.col("row") == F.col("_row"), "left").drop("_row")
        rest = _dealt(asked, ranges, splits, F.col("floor")).where(F.col("split") > 0)
        found = first.unionByName(rest.groupBy(*by).cogroup(candidates.where(F.col("split") > 0).groupBy(*by))
                                  .applyInPandas(search, kept))
    best = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    pairs = stage(found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
                  .select("row", "anchor_id", "positive_id", "positive_score"), "positives")

    # Negatives: a window of products for each positive's score; equal scores share one.
    wanted = pairs.groupBy(F.col("row").alias("_row")).agg(F.collect_set("positive_score").alias("scores"))
    asked = anchors.join(wanted, F.col("row") == F.col("_row")).drop("_row")
    least = (F.array_min("scores").cast("double") * lowest / 100 * (1 - 1e-9) - 1) if lowest >= 0 else F.lit(None).cast("double")
    mined = (_dealt(asked, ranges, splits, least).groupBy(*by).cogroup(candidates.groupBy(*by))
             .applyInPandas(_negatives_in_split(width, negatives, lowest, highest),
                            "row long, positive_score long, negative_id long, negative_score long"))
    hardest = Window.partitionBy("row", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = mined.withColumn("rank", F.row_number().over(hardest)).where(F.col("rank") <= negatives)
    return pairs.join(ranked, ["row", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def shifted_label(vec_id: str = "vec_id", label: str = "label") -> Column:
    """The label of op12: (label + 1) modulo 10 where the id is divisible by 7."""
    return F.when(F.col(vec_id) % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label))


def op12(vectors: DataFrame) -> DataFrame:
    return hard_negatives(vectors, label=shifted_label())


def op12_sql() -> str:
    """The same rows by DuckDB, every anchor against every vector."""
    return f"""
with v as (select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda c: floor({SCALE} * c::double)::bigint) as w from embeddings
           where vec_id is not null and label is not null and embedding is not null
             and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
s as materialized (select a.r as a, a.vec_id as anchor_id, c.r as c, c.vec_id, a.label = c.label as same,
             coalesce(list_sum(list_transform(range(1, least(len(a.w), len(c.w)) + 1), lambda i: a.w[i] * c.w[i])), 0)::bigint as score
      from v a join v c on a.r <> c.r where a.vec_id % {EVERY} = 0),
p as (select a, anchor_id, c, vec_id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by a order by score desc, vec_id, c) <= {POSITIVES}),
n as (select p.a, p.c, p.anchor_id, p.positive_id, p.positive_score, s.vec_id as negative_id, s.score as negative_score,
             (row_number() over (partition by p.a, p.c order by s.score desc, s.vec_id))::int as rank
      from p join s on s.a = p.a and not s.same
      where {LOWEST} * p.positive_score <= 100 * s.score and 100 * s.score <= {HIGHEST} * p.positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= {NEGATIVES}"""
