"""Ranked lexical search by per-term geometric blocking.

Documents become sparse vectors of whole-number impacts (what a term adds to a
score). They are dealt to segments of about ``SEGMENT_ROWS`` documents by a
hash; in a segment every term has a posting list, and the list is clustered
by the similarity of its documents' whole vectors: blocks of neighbours,
each with the coordinatewise maximum of its vectors as its summary. The summary times the item is a bound
for every document of the block, exact in whole numbers. An item visits its
terms' lists from the strongest on; a block is skipped only if its bound is
below the item's k-th best score, and the remaining lists only if their
strongest impacts together are. All else is scored exactly.

A first segment gives each item a k-th best score to start from. Lists are
clustered when an item first visits them; a common term's list, which few
items must visit, is usually never built.

Items are searched ``ENTRIES_AT_ONCE`` words at a time (the vocabulary that tasks get is
bounded by that and the longest item), each batch against all documents.

Rows: every document takes part, null ids too (last among equal scores);
repeated rows and ids are documents of their own, as repeated items are items
of their own. Null and empty texts have no terms: such items give no rows.
Ids are whole numbers. Other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from annuity.llm.common import UPPER, stage

TOP = 20
SEGMENT_ROWS = 4096
BLOCK_ROWS = 32
SKETCH = 16
ENTRIES_AT_ONCE = 65536
TERMS_AT_ONCE = 2048
BLOCKS_AT_ONCE = 8
# Fixed values of the score: length normalisation in hundredths, saturation in thousandths.
LENGTH_SHARE, SATURATION = 25, 12
# Characters between terms: everything below 128 that is neither digit nor letter.
_TERMS = bytes.maketrans(bytes(range(128)), bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(128)))
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERMS).split()


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_id, terms): the terms of every item with repeats; ``item`` numbers the rows."""
    lower = F.translate(F.col(text), UPPER, UPPER.lower())
    return items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"),
                        F.coalesce(F.regexp_extract_all(lower, F.lit(TERM_PATTERN), F.lit(0)), F.array().cast("array<string>")).alias("terms"))


def vectors(docs: DataFrame, vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, n, terms, counts): all terms of a document counted, those of the vocabulary (a broadcast dict) kept."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            sizes, terms, counts, widths = [], [], [], []
            for one in batch.column(2):
                words = terms_of(one.as_py())
                found = np.fromiter((i for i in map(number, words) if i is not None), np.int32)
                kinds, many = np.unique(found, return_counts=True)
                sizes.append(len(words)), terms.append(kinds), counts.append(many), widths.append(len(kinds))
            ends = pa.array(np.append(0, np.cumsum(widths)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, kind), *x]).astype(kind)))
                     for x, kind in ((terms, np.int32), (counts, np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), *lists],
                                             names=["row", "doc_id", "n", "terms", "counts"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(counted, "row long, doc_id long, n long, terms array<int>, counts array<long>")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Segment:
    """Impacts of some documents over some terms, and the blocked posting lists of those terms."""

    def __init__(self, impacts: np.ndarray):
        self.impacts = impacts
        self.strongest = impacts.max(axis=0, initial=0)
        signs = np.random.default_rng(0).choice([-1.0, 1.0], (impacts.shape[1], SKETCH))
        sketch = impacts @ signs
        self.sketch = sketch / np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents, where each block starts among them, summaries) of one posting list."""
        found = self.lists.get(term)
        if found is None:
            docs = np.flatnonzero(self.impacts[:, term])
            starts = np.zeros(1, np.int64)
            if len(docs) > BLOCK_ROWS:
                centres = self.sketch[docs[::BLOCK_ROWS]]
                nearest = np.argmax(self.sketch[docs] @ centres.T, axis=1)
                order = np.argsort(nearest, kind="stable")
                docs, nearest = docs[order], nearest[order]
                starts = np.flatnonzero(np.r_[True, nearest[1:] != nearest[:-1]])
                # A large cluster is several blocks.
                place = np.arange(len(docs)) - np.repeat(starts, np.diff(np.append(starts, len(docs))))
                starts = np.flatnonzero(place % (4 * BLOCK_ROWS) == 0)
            found = self.lists[term] = docs, starts, np.maximum.reduceat(self.impacts[docs], starts, axis=0)
        return found

    def search(self, terms: np.ndarray, repeats: np.ndarray, k: int, floor: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k best that reach ``floor``; ``order``: places among equal scores."""
        strong = self.strongest[terms] * repeats
        visit = np.argsort(-strong, kind="stable")
        rest = strong[visit][::-1].cumsum()[::-1]
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        seen = np.zeros(len(self.impacts), bool)
        for at, t in enumerate(visit):
            if rest[at] < floor or not strong[t]:
                break
            members, starts, summaries = self.blocks(int(terms[t]))
            bounds = summaries[:, terms] @ repeats
            ends = np.append(starts[1:], len(members))
            ranked = np.argsort(-bounds, kind="stable")
            for a in range(0, len(ranked), BLOCKS_AT_ONCE):
                some = [b for b in ranked[a:a + BLOCKS_AT_ONCE] if bounds[b] >= floor]
                if not some:
                    break
                new = np.concatenate([members[starts[b]:ends[b]] for b in some])
                new = new[~seen[new]]
                seen[new] = True
                score = self.impacts[new[:, None], terms] @ repeats
                good = score >= floor
                docs, scores = np.concatenate([docs, new[good]]), np.concatenate([scores, score[good]])
                if len(docs) > k:
                    best = np.lexsort((order[docs], -scores))[:k]
                    docs, scores = docs[best], scores[best]
                if len(docs) == k:
                    floor = max(floor, int(scores.min()))
        return docs, scores


def _groups(items: list[tuple[int, np.ndarray, np.ndarray]], at_once: int) -> Iterator[list]:
    """Items in groups of at most ``at_once`` distinct terms; an item with more is a group of its own."""
    group, held = [], set()
    for item in items:
        new = set(item[1].tolist())
        if group and len(held | new) > at_once:
            yield group
            group, held = [], set()
        group.append(item)
        held |= new
    if group:
        yield group


def _segment_search(shared, k: int):
    def found(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        items, weights, documents, words, floors = shared.value
        ids, no_id = pdf["doc_id"].to_numpy(), pdf["no_id"].to_numpy()
        order = np.empty(len(pdf), np.int64)
        order[np.lexsort((ids, no_id))] = np.arange(len(pdf))
        # Whole numbers of any size: 25 n N may leave 64 bits.
        m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * int(n) * documents // words for n in pdf["n"]], np.int64)
        doc = np.repeat(np.arange(len(pdf)), pdf["terms"].map(len))
        term, tf = (np.concatenate(pdf[c].to_numpy()).astype(np.int64) for c in ("terms", "counts"))
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + SATURATION * m[doc]))
        out = []
        for group in _groups(items, TERMS_AT_ONCE):
            used = np.unique(np.concatenate([terms for _, terms, _ in group]))
            column = np.full(len(weights), -1)
            column[used] = np.arange(len(used))
            dense = np.zeros((len(pdf), len(used)), np.int64)
            here = column[term] >= 0
            dense[doc[here], column[term[here]]] = impact[here]
            segment = Segment(dense)
            for item, terms, repeats in group:
                docs, scores = segment.search(column[terms], repeats, k, floors.get(item, 1), order)
                out.append(pd.DataFrame({"item": item, "doc_id": ids[docs], "no_id": no_id[docs], "score": scores}))
        return pd.concat(out)

    return found


def _batch(docs: DataFrame, items: list, k: int, doc_id: str, text: str) -> DataFrame:
    """(item, doc_id, no_id, score) of the items' best documents of each segment."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for r in items for t in r["terms"]}))}
    shared = spark.sparkContext.broadcast({t.encode(): i for t, i in vocabulary.items()})
    rows = stage(vectors(docs, shared, doc_id, text), "term-vectors")
    documents, words, holding = rows.agg(F.count_if(F.col("n") > 0), F.sum("n"), F.count_if(F.size("terms") > 0)).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for r in rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        weights[r["t"]] = weight(documents, r["df"])
    asked = [(r["item"], *np.unique([vocabulary[t] for t in r["terms"]], return_counts=True)) for r in items]
    segments = max(1, -(-holding // SEGMENT_ROWS))
    dealt = (rows.where(F.size("terms") > 0).select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "n", "terms", "counts",
        F.pmod(F.xxhash64("row"), F.lit(segments)).cast("int").alias("segment")))

    def searched(part: DataFrame, floors: dict[int, int]) -> DataFrame:
        given = spark.sparkContext.broadcast((asked, weights, documents, words, floors))
        return part.groupBy("segment").applyInPandas(_segment_search(given, k), "item long, doc_id long, no_id boolean, score long")

    if segments == 1:
        return searched(dealt, {})
    first = stage(searched(dealt.where("segment = 0"), {}), "first-segment")
    floors = {r["item"]: r["least"] for r in first.groupBy("item").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= k).collect()}
    return first.unionByName(searched(dealt.where("segment > 0"), floors))


def search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a score above 0."""
    asked = stage(item_terms(items, item_id, item_text).where(F.size("terms") > 0), "items")
    entries = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    batches = max(1, -(-entries // ENTRIES_AT_ONCE))
    batch = F.pmod(F.xxhash64("item"), F.lit(batches))
    parts = [_batch(docs, asked.where(batch == b).orderBy("item").collect(), k, doc_id, text) for b in range(batches)]
    found = reduce(DataFrame.unionByName, parts)
    best = Window.partitionBy("item").orderBy(F.desc("score"), "no_id", "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select(
        "item_id", "rank", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score")


def op13(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)


def op13_sql() -> str:
    """The same rows by DuckDB, every item against every document that holds one of its terms."""
    terms = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{TERM_PATTERN}')"
    return f"""
with d as (select row_number() over () as r, doc_id, {terms} as t from documents),
size as (select count(*) filter (where len(t) > 0) as n_docs, sum(len(t))::bigint as n_terms from d),
i as (select row_number() over () as i, item_id, {terms} as t from benchmark),
q as (select i, item_id, term, count(*) as repeats from (select i, item_id, unnest(t) as term from i) group by all),
p as (select r, doc_id, n, term, count(*) as tf from (select r, doc_id, len(t) as n, unnest(t) as term from d)
      where term in (select term from q) group by all),
w as (select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w from p, size group by term),
s as (select i, item_id, r, doc_id,
             sum(repeats * w * ((1000000000 * tf) // (1000 * tf + {SATURATION} * ({100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * n_docs) // n_terms))))::bigint as score
      from q join p using (term) join w using (term), size group by all),
k as (select item_id, (row_number() over (partition by i order by score desc, doc_id nulls last, r))::int as rank, doc_id, score
      from s where score > 0)
select item_id, rank, doc_id, score from k where rank <= {TOP}"""
