"""Sharding, top-k, license scan, mixing, rule ledger and pipeline beyond their SQL."""

import textwrap
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from annuity.llm import inner_product, license_scan, mixing, rule_ledger, sharding


def test_shards_match_the_mixture(spark, sf_small, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 16)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("doc_id") % 7)))
    rows = sharding.shards(docs, 8).toPandas()
    sizes = rows.groupby("shard").size()
    assert len(rows) == docs.count() and sizes.max() - sizes.min() <= 1
    for shard, part in rows.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    counts = rows.groupby(["source", "shard"]).size().unstack(fill_value=0)
    assert (counts.max(axis=1) - counts.min(axis=1)).max() <= 2


def test_a_third_of_equal_rows_is_split(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 100)
    monkeypatch.setattr(sharding, "COPIES_AT_ONCE", 50)
    rows = [(7, "same text", "hot")] * 2000 + [(None, None, None)] * 500 + [(k, f"text {k % 900}", f"s{k % 5}") for k in range(3500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    biggest = []
    find = sharding.ranked

    def watched(df, group, bucket, *args):
        biggest.append(df.groupBy(*group, bucket).count().agg(F.max("count")).first()[0])
        return find(df, group, bucket, *args)

    monkeypatch.setattr(sharding, "ranked", watched)
    out = sharding.shards(docs, 8, keep_text=True).toPandas()
    assert max(biggest) < 250 and len(out) == 6000
    assert Counter(zip(out["doc_id"].fillna(-1).astype(int), out["text"].fillna("null"))) == Counter(
        (-1 if i is None else i, "null" if t is None else t) for i, t, _ in rows)
    assert set(out.groupby("shard").size()) == {750}
    for _, part in out.groupby("shard"):
        assert sorted(part["slot"]) == list(range(750))
        assert 249 <= (part["source"] == "hot").sum() <= 251


def test_written_shards(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    path = sharding.write_shards(docs, str(tmp_path / "shards"), 4, 2)
    back = spark.read.parquet(path)
    assert {(r["doc_id"], r["text"]) for r in back.collect()} == {(r["doc_id"], r["text"]) for r in docs.collect()}
    files = back.groupBy("shard", F.input_file_name().alias("f")).agg(F.min("slot").alias("a"), F.max("slot").alias("b")).collect()
    for shard in range(4):
        ranges = [(r["a"], r["b"]) for r in sorted((r for r in files if r["shard"] == shard), key=lambda r: r["f"])]
        assert ranges[0][0] == 0 and all(x[1] + 1 == y[0] for x, y in zip(ranges, ranges[1:]))


def test_shards_depend_on_the_seed(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    a, b = ({r["doc_id"]: r["shard"] for r in sharding.shards(docs, 8, seed).collect()} for seed in (1, 2))
    assert a != b


@pytest.mark.parametrize("scale", [0.3, 5e5])
def test_top_k_equals_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(inner_product, "SPLIT_ROWS", 70)
    monkeypatch.setattr(inner_product, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(1)
    v = (rng.normal(size=(400, 40)) * rng.exponential(size=(400, 1)) * scale * (0.8 ** np.arange(40))).astype(np.float32)
    v[200:220] = v[0]
    vectors = spark.createDataFrame(list(enumerate(v.tolist())), "vec_id long, embedding array<float>")
    whole = np.floor(64 * v.astype(float)).astype(np.int64)
    score = whole @ whole.T
    want = set()
    for q in range(0, 400, 20):
        order = [i for i in np.lexsort((np.arange(400), -score[q])) if i != q][:20]
        want |= {(q, k + 1, int(i), int(score[q, i])) for k, i in enumerate(order)}
    assert {tuple(r) for r in inner_product.top_k(vectors).collect()} == want


def test_repeated_ids_are_rows_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(inner_product, "SPLIT_ROWS", 20)
    monkeypatch.setattr(inner_product, "ROOT_ROWS", 1)
    rng = np.random.default_rng(9)
    v = rng.normal(size=(150, 6)).astype(np.float32)
    v[100:] = v[:50]  # copies, a third of them under one id
    ids = [20 if k % 3 == 0 else k for k in range(150)]
    vectors = spark.createDataFrame(list(zip(ids, v.tolist())), "vec_id long, embedding array<float>")
    whole = np.floor(64 * v.astype(float)).astype(np.int64)
    score = whole @ whole.T
    want = Counter()
    for q in [k for k in range(150) if ids[k] % 20 == 0]:
        order = [i for i in np.lexsort((ids, -score[q])) if i != q][:20]
        want.update((ids[q], k + 1, ids[i], int(score[q, i])) for k, i in enumerate(order))
    assert Counter(tuple(r) for r in inner_product.top_k(vectors).collect()) == want


def test_products_stay_true_up_to_the_bound(spark):
    near = spark.createDataFrame([(0, [2.6e7] * 3), (1, [2.6e7] * 3), (2, [-2.6e7] * 3)], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in inner_product.top_k(near).collect()]
    assert got == [(0, 1, 1, 3 * 1664000000 ** 2), (0, 2, 2, -3 * 1664000000 ** 2)]
    for x in (3.0e7, 1.0e30):
        with pytest.raises(Exception, match="64 bits"):
            inner_product.top_k(spark.createDataFrame([(0, [x] * 3), (1, [1.0])], "vec_id long, embedding array<double>")).collect()


def test_short_splits_are_not_asked(spark, monkeypatch):
    """Splits whose longest vector cannot reach a query's floor get no copy of it."""
    monkeypatch.setattr(inner_product, "SPLIT_ROWS", 100)
    monkeypatch.setattr(inner_product, "ROOT_ROWS", 1)
    rng = np.random.default_rng(5)
    v = (rng.normal(size=(1000, 8)) * np.where(np.arange(1000) % 20 == 7, 50.0, 0.01)[:, None]).astype(np.float32)
    v[:, 0] = np.abs(v[:, 0]) + np.where(np.arange(1000) % 20 == 7, 100, 0)
    v[::20, 0] += 1
    vectors = spark.createDataFrame(list(enumerate(v.tolist())), "vec_id long, embedding array<float>")
    rows = inner_product.top_k(vectors)
    whole = np.floor(64 * v.astype(float)).astype(np.int64)
    best = {q: sorted((int(whole[q] @ whole[i]) for i in range(1000) if i != q), reverse=True)[:20] for q in range(0, 1000, 20)}
    got = {}
    for r in rows.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["score"])
    assert got == best


def test_pruning_leaves_out_short_vectors(monkeypatch):
    rng = np.random.default_rng(4)
    rows = np.vstack([rng.normal(size=(50, 8)) * 1000, rng.normal(size=(5000, 8))]).astype(np.int64)
    rows = rows[np.argsort(-np.linalg.norm(rows, axis=1))]
    seen = []
    add = inner_product.Best.add
    monkeypatch.setattr(inner_product.Best, "add", lambda self, q, s, i: (seen.append(len(q)), add(self, q, s, i)))
    inner_product.search(rows[:3], np.array([-1, -2, -3]), rows, np.arange(len(rows)), np.eye(8), 5)
    assert sum(seen) < 500


def scan(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in license_scan.op6(docs).collect()}


def test_license_labels(spark):
    filler = " ".join(f"w{i}" for i in range(200))
    rows = scan(spark, f"{filler} Licensed under CC BY-NC 4.0. {filler}", "Released under the MIT\nLicense, or so",
                "permitted provided that the following conditions are met", "MIT license apache LICENSE",
                "Redistribution and use in source and binary forms, with or without modification, are permitted "
                "provided that the following conditions are met:", filler, None, "Licensed under CC BY 4.0.\nAll rights")
    assert rows[7]["labels"] == "cc-by"
    assert rows[0]["labels"] == "cc-by-nc" and rows[0]["n_base"] == 0 and rows[0]["score"] == 1.0
    assert (rows[1]["base_labels"], rows[1]["first_word"], rows[1]["n_base"]) == ("mit", 3, 1)
    assert rows[2]["labels"] == "" and rows[2]["score"] == 0.0
    assert (rows[3]["labels"], rows[3]["n_base"], rows[3]["first_word"], rows[3]["last_word"]) == ("apache,mit", 2, 0, 2)
    assert rows[4]["labels"] == "bsd" and rows[4]["base_labels"] == ""
    assert rows[5]["labels"] == rows[6]["labels"] == "" and rows[6]["first_word"] is None


def test_a_narrower_notice_beside_a_wider_one(spark):
    by, nc = "Licensed under CC BY 4.0", "licensed under CC BY-NC 4.0"
    rows = scan(spark, f"{by}; figures {nc}.", f"{nc}. {nc}.", f"{nc}; {by}; {nc}", by, nc, "All rights reserved.",
                "All rights reserved. No part of this may be reproduced.", "Licence: all, rights", f"{nc}\n{by}")
    assert [rows[i]["labels"] for i in range(9)] == [
        "cc-by,cc-by-nc", "cc-by-nc", "cc-by,cc-by-nc", "cc-by", "cc-by-nc", "all-rights-reserved", "all-rights-reserved", "",
        "cc-by,cc-by-nc"]


def test_long_templates_are_never_cut(spark):
    notice = " ".join(f"term{i}" for i in range(150))
    templates = [*license_scan.TEMPLATES, ("long", "own", notice)]
    docs = spark.createDataFrame([(k, " ".join(f"w{i}" for i in range(k)) + " " + notice + " x" * 300) for k in (0, 40, 100, 148, 149, 150, 333)],
                                 "doc_id long, text string")
    assert all(r["all_labels"] == ["own"] and r["score"] == 1.0 for r in license_scan.scan(docs, templates=templates).collect())


@pytest.mark.parametrize("lead", ["", " * ", "# "])
def test_wrapped_notices(spark, lead):
    """Notices wrapped at 72 columns, as license headers are, at every offset to the windows."""
    names = [n for n, _, text in license_scan.TEMPLATES if len(text.split()) > 12]
    notices = {n: (label, text) for n, label, text in license_scan.TEMPLATES if n in names}
    wrapped = [(notices[n][0], "\n".join(lead + line for line in textwrap.wrap(
        " ".join(f"w{i}" for i in range(before)) + " " + notices[n][1] + " " + " ".join(f"v{i}" for i in range(90)), 72)))
               for n in names for before in (0, 20, 31, 33, 50, 70)]
    rows = scan(spark, *[text for _, text in wrapped])
    for i, (label, text) in enumerate(wrapped):
        assert label in rows[i]["labels"].split(",") and rows[i]["score"] == 1.0, text
    assert {"bsd", "mit", "apache", "gpl", "mpl"} == {label for label, _ in wrapped}


def test_rake_meets_the_targets():
    rng = np.random.default_rng(0)
    cells = np.array([(a, b) for a in range(3) for b in range(4)])
    tokens = rng.integers(1, 1000, 12).astype(float)
    targets = [np.array([0.2, 0.3, 0.5]), np.array([0.1, 0.2, 0.3, 0.4])]
    share, off = mixing.rake(cells, tokens, targets)
    assert off < 1e-8
    for k, t in enumerate(targets):
        assert np.allclose(np.bincount(cells[:, k], weights=share), t)
    # Raking keeps the odds ratios of the input.
    odds = lambda x: x[0] * x[5] / (x[1] * x[4])
    assert odds(share) == pytest.approx(odds(tokens))
    p = mixing.probabilities(share, tokens, 0.3)
    assert (p * tokens).sum() == pytest.approx(0.3 * tokens.sum()) and p.max() <= 1


def test_rake_keeps_within_what_is_there():
    cells, tokens = np.array([[0, 0], [0, 1], [1, 0], [1, 1]]), np.array([1.0, 9, 40, 50])
    share, _ = mixing.rake(cells, tokens, [np.array([0.5, 0.5]), np.array([0.5, 0.5])], 0.5)
    assert (share * 0.5 * tokens.sum() <= tokens * (1 + 1e-9)).all()


def plain_mixture(cells: dict[tuple, int]) -> dict[tuple, float]:
    """Probability by cell: square-root targets, proportional fitting within what is there, and a scale by halving."""
    total = sum(cells.values())
    goals, parts = [], []
    for k in range(3):
        there = Counter()
        for cell, n in cells.items():
            there[cell[k]] += n
        roots = sum(n ** 0.5 for n in there.values())
        goal = {c: n ** 0.5 / roots for c, n in there.items()}
        passed = 0.0
        for c in sorted(goal, key=lambda c: there[c] / goal[c]):
            passed += goal[c]
            if passed > 0.2:
                parts.append(there[c] / total / goal[c])
                break
        goals.append(goal)
    keep = min(1.0, *parts)
    share = {cell: n / total for cell, n in cells.items()}
    for _ in range(500):
        for k, goal in enumerate(goals):
            now = Counter()
            for cell, x in share.items():
                now[cell[k]] += x
            share = {cell: min(x * goal[cell[k]] / now[cell[k]], cells[cell] / total / keep) for cell, x in share.items()}
        off = max(abs(sum(x for cell, x in share.items() if cell[k] == c) - g) for k, goal in enumerate(goals) for c, g in goal.items())
        if off < 1e-9:
            break
    low, high = 0.0, 1e6
    for _ in range(200):
        scale = (low + high) / 2
        kept = sum(min(n, scale * share[cell] * total) for cell, n in cells.items())
        low, high = (scale, high) if kept < keep * total else (low, scale)
    return {cell: min(1.0, low * share[cell] * total / n) for cell, n in cells.items()}


def test_op7_equals_plain_fitting(spark):
    rows = mixing.op7(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    cells = Counter()
    at = lambda r: tuple(r[c] or "none" for c in ("source", "lang", "topic"))
    for r in rows:
        cells[at(r)] += r["tokens"]
    want = plain_mixture(cells)
    assert len(rows) == 1000 and all(r["probability"] == pytest.approx(want[at(r)], rel=1e-5) for r in rows)
    picked = sum(r["tokens"] for r in rows if r["selected"]) / sum(cells.values())
    assert picked == pytest.approx(sum(want[c] * n for c, n in cells.items()) / sum(cells.values()), rel=0.1)


def test_a_mixture_at_its_targets_is_kept_whole(spark):
    rows = [(k, f"some words {k}", ["a", "b"][k % 2], "en") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    assert all(r["selected"] and r["probability"] == pytest.approx(1.0) for r in mixing.op7(docs).collect())


def test_nearly_empty_categories_do_not_decide(spark):
    there, goal = np.array([0.5, 0.4997, 0.0003]), np.array([0.5, 0.495, 0.005])
    assert mixing.affordable(there, goal) == 1.0
    assert mixing.affordable(np.array([0.9, 0.1]), np.array([0.5, 0.5])) == pytest.approx(0.2)


def test_mixture_follows_given_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows, names = mixing.mixed(*mixing.measured(docs), {"lang": {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}, "topic": {"article": 0.7, "other": 0.3}}, 0.3)
    pdf = rows.select("lang", names["tokens"], names["weight"], names["probability"], names["selected"]).toPandas()
    raked = pdf[names["weight"]].mul(pdf[names["tokens"]]).groupby(pdf["lang"]).sum() / pdf[names["tokens"]].sum()
    assert raked["en"] == pytest.approx(0.4, abs=0.01) and raked["fr"] == pytest.approx(0.2, abs=0.01)
    assert (pdf[names["tokens"]] * pdf[names["probability"]]).sum() == pytest.approx(0.3 * pdf[names["tokens"]].sum(), rel=1e-6)
    assert pdf[pdf[names["selected"]]][names["tokens"]].sum() == pytest.approx(0.3 * pdf[names["tokens"]].sum(), rel=0.15)


def test_every_source_has_its_own_target(spark):
    """300 rare sources beside a large one: each gets the square root of its share, none is folded."""
    sizes = [("big", 90_000)] + [(f"s{i:03}", 100 + i % 3 * 50) for i in range(300)]
    rows = spark.createDataFrame([(i, s, "en", "note", n, 0) for i, (s, n) in enumerate(sizes)],
                                 "doc_id long, source string, lang string, topic string, tokens long, draw long")
    names = {"tokens": "tokens", "topic": "topic", "draw": "draw"}
    got = {r["source"]: r["weight"] * r["tokens"] for r in mixing.mixed(rows, names, keep=0.01)[0].collect()}
    total, roots = sum(n for _, n in sizes), sum(n ** 0.5 for _, n in sizes)
    assert all(got[s] / total == pytest.approx(n ** 0.5 / roots, rel=1e-6) for s, n in sizes)


@pytest.mark.parametrize("targets,keep", [(None, 0.5), ({"lang": {"en": 0.5, "fr": 0.2, "xx": 0.1, "other": 0.2}}, 0.3), (None, 1.0), (None, None)])
def test_cells_raked_in_spark_equal_those_on_the_driver(spark, monkeypatch, targets, keep):
    monkeypatch.setattr(mixing, "ROUNDS", 4)
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame(
        [(i, [None, *"abcdef"][int(rng.integers(7) * rng.random())], ["en", "fr", "de", "es", None][rng.integers(5)],
          ["note", "table"][rng.integers(2)], int(rng.integers(1, 1000)), int(rng.integers(16 ** 13))) for i in range(200)],
        "doc_id long, source string, lang string, topic string, tokens long, draw long")
    names = {"tokens": "tokens", "topic": "topic", "draw": "draw"}
    found = []
    for most in (mixing.MAX_CELLS, 0):
        monkeypatch.setattr(mixing, "MAX_CELLS", most)
        out = mixing.mixed(rows, names, targets, keep)[0].orderBy("doc_id").collect()
        assert len(out) == 200
        found.append(np.array([(r["weight"], r["probability"]) for r in out]))
    # The part that targets allow is found in small steps where cells stay in Spark.
    assert np.allclose(*found, rtol=1e-9 if keep else 5e-3)
    if keep is None:
        return
    tokens = np.array([r["tokens"] for r in out])
    assert (tokens * found[1][:, 1]).sum() == pytest.approx(keep * tokens.sum())


def test_ledger_policies_and_ablations(spark):
    words = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, words), (2, "a b"), (3, "a b c " * 30), (4, words.upper()), (5, "*** " * 60), (6, None)],
                                 "doc_id long, text string")
    rows = rule_ledger.ledger(docs)
    fails = {r["doc_id"]: {n for n, b in rule_ledger.BIT.items() if r["failures"] >> b & 1} for r in rows.collect()}
    assert fails[1] == set() and "few_words" in fails[2] and "repeated_windows" in fails[3] and fails[4] == {"shouting"}
    assert "symbols" in fails[5] and "few_words" in fails[6]
    for policy, rules in rule_ledger.POLICIES.items():
        kept = {r["doc_id"]: r["kept"] for r in rule_ledger.apply_policy(rows, policy).collect()}
        assert kept == {i: not f & set(rules) for i, f in fails.items()}
        table = {r["rule"]: r for r in rule_ledger.ablations(rows, policy).collect()}
        for rule in rules:
            assert table[rule]["failed"] == sum(rule in f for f in fails.values())
            assert table[rule]["only_by_it"] == sum(f & set(rules) == {rule} for f in fails.values())


@pytest.mark.parametrize("text,want", [("a b c a b c", 6), ("a b c d a b c", 6), ("a a a a", 4), ("a b", 0), ("a b c", 0),
                                       ("x a b c y a b c z", 6), ("a b a b a b", 6)])
def test_repeated_words(spark, text, want):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert rule_ledger.op10(docs).first()["n_repeat_words"] == want


def test_pipeline_keeps_columns_and_clean_documents(spark, edge_dirs):
    from annuity.llm.common import stage

    for folder in edge_dirs:
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        before = docs.columns
        for name, function in corpus_pipeline.STAGES:
            out = stage(function(spark, docs, folder), "test")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == before and out.count() <= docs.count()
            docs = out


def test_pipeline_equals_its_plain_version(spark):
    """Every stage's decisions, taken again row by row from the operators' plain parts."""
    from annuity.llm import packing, quality_classifier, simhash, toxicity
    from annuity.llm.common import stage

    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())

    good = stage(steps["quality classifier"](spark, docs, folder), "test")
    w = quality_classifier.train(docs, labels).astype(float)
    plain = []
    for r in docs.collect():
        i, x = quality_classifier.features(r["text"])
        if 1 / (1 + np.exp(-(w[i] @ x))) >= quality_classifier.THRESHOLD:
            plain.append(r["doc_id"])
    assert ids(good) == sorted(plain)

    mild = stage(steps["toxicity"](spark, good, folder), "test")
    model = toxicity.train(good, labels)
    *a, b = toxicity.calibrate(good, labels, model)
    rows = good.collect()
    found = toxicity.features(model, [r["text"] for r in rows])
    assert ids(mild) == sorted(r["doc_id"] for r, x in zip(rows, found) if 1 / (1 + np.exp(-(x @ np.array(a) + b))) < 0.5)

    single = stage(steps["simhash near-dedup"](spark, mild, folder), "test")
    rows = mild.collect()
    fps = np.array([simhash.fingerprint(r["text"], 3) for r in rows], np.uint64)
    kept = []
    near = [set(np.flatnonzero(np.bitwise_count(f ^ fps) <= 3).tolist()) for f in fps]
    seen = set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = set(), [i]
        while todo:
            j = todo.pop()
            if j not in group:
                group.add(j)
                todo += near[j] - group
        seen |= group
        kept.append(min(rows[j]["doc_id"] for j in group))
    assert ids(single) == sorted(kept)

    sample = stage(steps["mixing sources"](spark, single, folder), "test")
    # Tokens, topics and draws are the operator's; what is kept follows from plain fitting.
    rows, names = mixing.measured(single)
    rows = rows.collect()
    at = lambda r: (r["source"] or "none", r["lang"] or "none", r[names["topic"]])
    cells = Counter()
    for r in rows:
        cells[at(r)] += r[names["tokens"]]
    chance = plain_mixture(cells)
    near = [r["doc_id"] for r in rows if abs(r[names["draw"]] / 16 ** 13 - chance[at(r)]) < 1e-6]
    assert not near and ids(sample) == sorted(r["doc_id"] for r in rows if r[names["draw"]] / 16 ** 13 < chance[at(r)])

    out = steps["best-fit packing"](spark, sample, folder).toPandas()
    tokens = packing.Tokens(packing.tokenizer_path())
    assert out["length"].sum() == sum(len(tokens.whole(r["text"])) // 4 + 1 for r in sample.collect())
