"""Token counts at every prefix, hard negatives and ranked search against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from annuity.llm import hard_negatives, ranked_search, token_counts

PIECES = ["'", "'ll", "'ve", "'re", "l", "v", "r", "e", " ", "  ", "\n", "\t", "a", "the", "The", "ing", "1", "23",
          "<|endoftext|>", "<|endo", "_", "--", "...", "<|", "|>", " ", "é", "中文", "\U0001F600", "ß", "\x1c", "​",
          "ʼ", "²", "٣", "Ⅷ", "ǅ", "ͅ", "\x85", " ", "　", "привет", "ñ"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(token_counts.tokenizer_path())


@pytest.fixture(scope="module")
def prefixes():
    return token_counts.Prefixes(token_counts.tokenizer_path())


def encoded(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_every_prefix_has_its_count(tokenizer, prefixes):
    rng = random.Random(5)
    for k in range(3000):
        text = "".join(rng.choice(PIECES[:26] if k % 2 else PIECES) for _ in range(rng.randint(0, 14)))
        got = np.concatenate([np.zeros(0, int), *prefixes.parts(text)]).tolist()
        assert got == [encoded(tokenizer, text[:i + 1]) for i in range(len(text))], repr(text)


def test_long_texts_are_counted_in_parts(tokenizer, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(token_counts, "PART", 40)
    monkeypatch.setattr(token_counts, "CACHED_PIECES", 5)
    small = token_counts.Prefixes(token_counts.tokenizer_path())
    for _ in range(20):
        text = "".join(rng.choice([*PIECES, " word", " other"]) for _ in range(200))
        got = np.concatenate(list(small.parts(text))).tolist()
        assert got == [encoded(tokenizer, text[:i + 1]) for i in range(len(text))]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="plain byte-level"):
        token_counts.Prefixes(token_counts.tokenizer_path("word_bpe_49k.json"))


def test_counts_of_whole_tables(spark, sf_small, edge_docs, tokenizer):
    for docs in (spark.read.parquet(f"{sf_small}/documents.parquet"), edge_docs):
        want = Counter((r["doc_id"], len((r["text"] or "").encode()), encoded(tokenizer, r["text"])) for r in docs.collect())
        rows = token_counts.op11(docs).collect()
        assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)


def test_prefix_questions_need_no_encoding(spark, edge_docs, tokenizer):
    rows = [(k, r["doc_id"], r["text"]) for k, r in enumerate(edge_docs.collect()) if len(r["text"] or "") < 2000]
    docs = spark.createDataFrame(rows, "place long, doc_id long, text string")
    table = token_counts.prefix_table(docs, row=F.col("place"), block=64).cache()
    texts = {k: t or "" for k, _, t in rows}
    assert {r["row"] for r in table.collect()} == set(texts)
    for r in table.collect():
        assert r["counts"] == [encoded(tokenizer, texts[r["row"]][:r["start"] + k + 1]) for k in range(len(r["counts"]))]
    for chars in (1, 64, 65, 100, 5000):
        assert {r["row"]: r["tokens"] for r in token_counts.tokens_at(table, chars).collect()} == {
            k: encoded(tokenizer, t[:chars]) for k, t in texts.items()}
    for budget in (0, 1, 17, 60, 10_000):
        want = {k: max(i for i in range(len(t) + 1) if encoded(tokenizer, t[:i]) <= budget) for k, t in texts.items()}
        assert {r["row"]: r["chars"] for r in token_counts.longest_within(table, budget).collect()} == want


def test_texts_cut_to_a_budget(spark, edge_docs, tokenizer):
    cut = token_counts.truncated(edge_docs, 50)
    assert cut.columns == edge_docs.columns and cut.count() == edge_docs.count()
    assert all(encoded(tokenizer, r["text"]) <= 50 for r in cut.collect())
    assert Counter(r["text"] is None for r in cut.collect()) == Counter(r["text"] is None for r in edge_docs.collect())


def plain_negatives(rows, every=100):
    """(anchor, positive, rank, negative, positive score, negative score) from all products."""
    out = Counter()
    v = [np.floor(256 * np.array(x, np.float32).astype(float)).astype(np.int64).tolist() for _, x, _ in rows]
    for a, (anchor, _, label) in enumerate(rows):
        if anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v[a], v[b])), i, b, other) for b, (i, _, other) in enumerate(rows) if b != a]
        for p, positive, _, _ in sorted(x for x in scored if x[3] == label)[:5]:
            near = sorted((s, i) for s, i, _, other in scored if other != label and 30 * -p <= 100 * -s <= 90 * -p)
            out.update((anchor, positive, k + 1, i, -p, -s) for k, (s, i) in enumerate(near[:10]))
    return out


@pytest.mark.parametrize("scale", [0.2, 3e5])
def test_negatives_equal_all_products(spark, monkeypatch, scale):
    monkeypatch.setattr(hard_negatives, "SPLIT_ROWS", 150)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 3)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 24)) + 0.7
    labels = np.where(rng.random(900) < 0.4, 0, rng.integers(0, 6, 900))  # one hot label
    v = ((centres[rng.integers(0, 6, 900)] + rng.normal(size=(900, 24))) * scale).astype(np.float32)
    v[300:340] = v[200]  # copies: ties
    rows = [(int(i), x.tolist(), int(k)) for i, x, k in zip([*range(880), *([100] * 20)], v, labels)]  # a repeated id
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    got = hard_negatives.hard_negatives(table).collect()
    assert Counter(tuple(r) for r in got) == plain_negatives(rows)


def test_bounds_shrink_the_candidates():
    rng = np.random.default_rng(2)
    import pandas as pd

    v = (rng.normal(size=(2000, 64)) * 0.9 ** np.arange(64) * 1000).astype(np.int64)
    v[:10] *= 3
    split = hard_negatives.Split(pd.DataFrame({"row": range(2000), "vec_id": range(2000), "label": 0, "v": list(v)}), 64)
    left = []
    keep = lambda lower, upper: (left.append(len(lower)), upper >= hard_negatives.kth(lower, 5))[1]
    found, _ = hard_negatives.scan(split, v[0], np.arange(2000), keep)
    assert left[0] == 2000 and left[-1] < 200 and set(np.argsort(-(v @ v[0]))[:5]) <= set(found.tolist())


def test_products_beyond_64_bits_fail(spark):
    rows = [(100, [2.0e7] * 3, 1), (1, [2.0e7] * 3, 1), (2, [1.0e30] * 3, 0)]
    near = spark.createDataFrame(rows[:2] + [(2, [1.0e7] * 3, 0)], "vec_id long, embedding array<double>, label int")
    # 256 x 2e7 in three components: 7.9e19 does not fit.
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives.hard_negatives(near).collect()
    fits = spark.createDataFrame([(100, [6.7e6] * 3, 1), (1, [6.7e6] * 3, 1), (2, [4.0e6] * 3, 0)], "vec_id long, embedding array<double>, label int")
    (row,) = hard_negatives.hard_negatives(fits).collect()
    assert (row["positive_score"], row["negative_score"]) == (3 * 1715200000 ** 2, 3 * 1715200000 * 1024000000)


def plain_ranking(docs, items, k=20):
    cut = lambda t: [re.sub("[A-Z]+", lambda m: m[0].lower(), x) for x in
                     re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    terms = [(i, Counter(cut(t)), len(cut(t))) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for _, _, n in terms), sum(n for _, _, n in terms)
    df = Counter(t for _, c, _ in terms for t in c)
    out = Counter()
    for item, text in items:
        scored = []
        for place, (i, c, n) in enumerate(terms):
            m = 75 + 25 * n * n_docs // n_terms if n_terms else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                        for t in cut(text) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, place))
        out.update((item, r + 1, None if no else i, -s) for r, (s, no, i, _) in enumerate(sorted(scored)[:k]))
    return out


@pytest.mark.parametrize("segment_rows", [40, 4096])
def test_ranking_equals_all_scores(spark, sf_small, edge_docs, edge_dirs, monkeypatch, segment_rows):
    monkeypatch.setattr(ranked_search, "SEGMENT_ROWS", segment_rows)
    monkeypatch.setattr(ranked_search, "BLOCK_ROWS", 3)
    monkeypatch.setattr(ranked_search, "ENTRIES_AT_ONCE", 600)
    monkeypatch.setattr(ranked_search, "TERMS_AT_ONCE", 100)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").unionByName(edge_docs.select("doc_id", "text"))
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").unionByName(
        spark.read.parquet(f"{edge_dirs[0]}/benchmark.parquet").select("item_id", "text"))
    got = Counter(tuple(r) for r in ranked_search.search(docs, items).collect())
    assert got == plain_ranking([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])


def test_blocks_are_skipped_by_exact_bounds():
    rng = np.random.default_rng(3)
    topics = rng.integers(0, 40, 3000)
    impacts = np.where(rng.random((3000, 200)) < np.where(np.arange(200) // 5 == topics[:, None], 0.9, 0.03), rng.integers(1, 1000, (3000, 200)), 0)
    segment = ranked_search.Segment(impacts)
    for term in range(0, 200, 17):
        docs, starts, summaries = segment.blocks(term)
        assert sorted(docs) == np.flatnonzero(impacts[:, term]).tolist()
        for a, b, top in zip(starts, [*starts[1:], len(docs)], summaries):
            assert (impacts[docs[a:b]].max(axis=0) == top).all()
    terms, repeats = np.arange(10, 15), np.ones(5, np.int64)
    scores = impacts[:, terms] @ repeats
    order = np.argsort(np.lexsort((np.arange(3000),)))
    docs, found = segment.search(terms, repeats, 20, 1, order)
    best = np.lexsort((np.arange(3000), -scores))[:20]
    assert docs.tolist() == best.tolist() and found.tolist() == scores[best].tolist()
    _, starts, summaries = segment.blocks(10)
    assert (summaries[:, terms] @ repeats < found[-1]).mean() > 0.2
