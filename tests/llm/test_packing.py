import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from annuity.llm import packing


@pytest.fixture(scope="module")
def tokens():
    found = packing.Tokens(packing.tokenizer_path())
    assert found.by_word
    return found


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60) | st.text(alphabet="abcXYZ'sétİıſΣß.,!?-|&<>019 \n\t\x1c\x85 ", max_size=60))
def test_tokens_equal_the_tokenizer(tokens, text):
    assert tokens(text) == tokens.whole(text)


@pytest.mark.parametrize("text", ["<|endoftext|> a", "x<|startoftext|>y", "it's we'll 'tis don't", "ΣΑΣ", "é É"])
def test_special_texts(tokens, text):
    assert tokens(text) == tokens.whole(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_pack_is_whole_and_fits(lengths):
    lengths = np.array(lengths, np.int64)
    bins = packing.pack(lengths, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(0 < lengths[b].sum() <= 50 for b in bins)
    assert len(bins) <= len(packing.best_fit(lengths, 50))


def test_local_search_empties_a_bin():
    # Best fit in falling order needs three bins of 10; the search finds two.
    lengths = np.array([4, 4, 3, 3, 3, 3])
    assert len(packing.pack(lengths, 10)) == 2


def test_exchange_two_for_one():
    lengths = np.array([6, 2, 2, 3, 3, 4])
    bins = packing.improve([[0, 1], [2, 3, 4], [5]], lengths, 10)
    assert len(bins) == 2


@pytest.mark.parametrize("lengths", [[5] * 4096, [3] * 2048, [700] * 300 + [5] * 300, [7] * 500 + [11] * 500 + [1021] * 40])
def test_few_different_lengths_take_few_looks(monkeypatch, lengths):
    """What a step looks at are different lengths by bin, not pieces."""
    looked, unique = [], np.unique

    def counted(x, *args, **kwargs):
        out = unique(x, *args, **kwargs)
        looked.append(len(out[0] if isinstance(out, tuple) else out))
        return out

    rng = np.random.default_rng(1)
    lengths = rng.permutation(np.array(lengths))
    before = packing.best_fit(lengths, 2048)
    monkeypatch.setattr(packing.np, "unique", counted)
    bins = packing.improve(before, lengths, 2048)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths))) and len(bins) <= len(before)
    assert all(lengths[b].sum() <= 2048 for b in bins)
    assert sum(looked) < 200_000


def test_other_vocabularies_are_asked_whole():
    other = packing.Tokens(packing.tokenizer_path("byte_bpe_50k.json"))
    assert not other.by_word
    for text in ("The Quick  brown\nfox", "it's", ""):
        assert other(text) == other.whole(text)


def layout(df: pd.DataFrame, capacity: int):
    df = df.sort_values(["sequence_id", "offset"])
    assert (df.groupby("sequence_id")["length"].cumsum() - df["length"] == df["offset"]).all()
    assert df.groupby("sequence_id")["length"].sum().max() <= capacity
    return df["sequence_id"].nunique()


def test_edge_documents(spark, edge_docs, tokens):
    df = packing.op1(edge_docs).toPandas()
    want = []
    for r in edge_docs.collect():
        ids = tokens.whole(r["text"] or "") + bytes(4)
        want += [(-1 if r["doc_id"] is None else r["doc_id"], k, at // 4, len(ids[at:at + 8192]) // 4, zlib.crc32(ids[at:at + 8192]))
                 for k, at in enumerate(range(0, len(ids), 8192))]
    got = df.fillna({"doc_id": -1})[["doc_id", "piece", "start", "length", "ids_crc32"]].astype("int64")
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(want)
    n = layout(df, 2048)
    assert n <= -(-int(df["length"].sum()) // 2048) + 1


def test_sequences_hold_every_token(spark, edge_docs, tokens):
    placed = packing.packed(packing.pieces(edge_docs, keep_ids=True))
    got = {}
    for r in packing.sequences(placed).collect():
        assert len(r["ids"]) <= 2048
        for s in r["spans"]:
            part = np.array(r["ids"][s["offset"]:s["offset"] + s["length"]], "<u4").tobytes()
            got.setdefault(str(s["doc_id"]), []).append((s["start"], part))
    for r in edge_docs.dropDuplicates(["doc_id"]).where("doc_id is not null").collect():
        whole = tokens.whole(r["text"] or "") + bytes(4)
        copies = sum(1 for x in got[str(r["doc_id"])] if x[0] == 0)
        assert b"".join(p for _, p in sorted(got[str(r["doc_id"])])[::copies]) == whole


def test_several_groups_and_rounds(spark):
    rng = np.random.default_rng(3)
    rows = [(i, 0, 0, int(n), i) for i, n in enumerate(rng.integers(1, 1000, 900))]
    df = packing.packed(spark.createDataFrame(rows, packing.PIECES), group_rows=100).toPandas()
    assert sorted(df["doc_id"]) == list(range(900))
    assert layout(df, 2048) <= 1.03 * df["length"].sum() / 2048 + 2
