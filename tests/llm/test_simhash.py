import numpy as np
import pandas as pd
import pytest
import xxhash

from annuity.llm import simhash


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, max_bits=3):
    """Label of every distinct fingerprint, by comparing all pairs."""
    u = np.unique(np.array(fps, np.uint64))
    label = list(range(len(u)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[i] ^ u) <= max_bits).tolist():
            a, b = sorted((root(i), root(j)))
            label[b] = a
    return {int(f): root(i) for i, f in enumerate(u)}


def test_gray_rank_is_the_place_in_the_sequence():
    places = np.arange(64, dtype=np.uint64)
    assert (simhash.gray_rank(places ^ (places >> np.uint64(1))) == places).all()


@pytest.mark.parametrize("text", ["", "one", "Two Words", "a b c", "a b c d a b c d", "\x0bX\x0c y\r\nz  q", "Ä Ö ü ä " * 9])
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3) == plain_fingerprint(text)


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 64)
    assert simhash.fingerprint(text, 3) == plain_fingerprint(text)


@pytest.fixture(scope="module")
def crowded():
    """Clusters at few bits, chains, and a third of all under one 16-bit pattern."""
    rng = np.random.default_rng(5)
    x = np.repeat(rng.integers(0, 2 ** 64, 12, dtype=np.uint64), 40)
    for _ in range(4):
        x = np.where(rng.random(len(x)) < 0.6, x ^ (np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)), x)
    chain = np.cumsum([0, *[1 << (3 * i) for i in range(20)]]).astype(np.uint64)
    hot = np.uint64(0x1234 << 48) | (rng.integers(0, 2 ** 14, 300).astype(np.uint64) << np.uint64(7))
    return np.unique(np.concatenate([x, chain, hot, [np.uint64(0), ~np.uint64(0)]]))


@pytest.mark.parametrize("node_rows", [20, 16384])
def test_components_equal_all_pairs(spark, crowded, node_rows):
    distinct = spark.createDataFrame(pd.DataFrame({"fp": crowded.view(np.int64)})).repartition(5)
    edges = simhash.links(distinct, 3, node_rows)
    found = edges.toPandas()
    assert (np.bitwise_count(found["a"].to_numpy().view(np.uint64) ^ found["b"].to_numpy().view(np.uint64)) <= 64).all()
    roots = {int(np.int64(r["fp"]).view(np.uint64)): r["root"] for r in simhash.components(edges).collect()}
    want = plain_components(crowded)
    groups = {}
    for f, label in want.items():
        groups.setdefault(label, set()).add(roots.get(f, int(np.uint64(f).view(np.int64))))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_long_chain_is_one_component(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long").repartition(7)
    assert {(r["fp"], r["root"]) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(n + 1)}


def test_rows_and_kept_rows(spark, edge_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    texts = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    label = plain_components([plain_fingerprint(t) for _, t in texts])
    low = {}
    for i, t in texts:
        if i is not None:
            c = label[plain_fingerprint(t)]
            low[c] = min(low.get(c, i), i)
    want = sorted(str((i, f"{plain_fingerprint(t):016x}", low.get(label[plain_fingerprint(t)]))) for i, t in texts)
    assert sorted(str(tuple(r)) for r in rows) == want
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(low.values()))


def test_null_ids_alone_keep_one(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "q r s t")], "doc_id long, text string")
    assert sorted(r["text"] for r in simhash.keep_one(docs).collect()) == ["a b c d", "q r s t"]
