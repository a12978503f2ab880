"""Packing token sequences by swap-based local search.

Every text becomes token ids and an end id; only what is longer than a
sequence is cut, into full pieces and a rest. Pieces are packed in groups of
about ``GROUP_ROWS`` (by a hash, so a hot source spreads evenly): best fit in
falling order first, then local search among underfull bins. A step moves a
piece to another bin, exchanges one for one, or two for one; it is taken
if the sum of squared fills grows, so the emptier bin drains into the fuller
ones and the search ends; it stops early where the tokens need all the bins
left. Bins that stay underfull are opened and packed again with those of
other groups, ``ROUNDS`` times.

Tokens: the tokenizer splits at white space before it merges, so texts of
plain letters and punctuation are looked up word by word in a table that the
vocabulary's own merge model fills; other texts are given to the tokenizer whole.

Rows: one per piece. Null and empty texts are one piece holding the end id. Repeated
rows and ids are packed one by one. Other columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annuity.llm.common import stage

CAPACITY = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"
GROUP_ROWS = 4096
ROUNDS = 3
# A bin with at most this much room counts as full between rounds.
SLACK = 8
CACHED_WORDS = 600_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACE = "sequence_id long, offset long, room long"
# Characters that lower-case one by one, compose with nothing and are white space for everyone alike.
_PLAIN = re.compile("[\t-\r -~¡-±´-¸º»¿-įı-ſ–—‘-”…]*")
# How the vocabulary's tokenizer cuts a lower-cased word (a fixed value), for such characters.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
# The same, as the vocabulary's file states it (a fixed value).
_CUT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}


class _Words(dict):
    """Token ids by word; the vocabulary's model fills in what is missing."""

    def __init__(self, model, spelled):
        super().__init__()
        self.model, self.spelled = model, spelled

    def __missing__(self, word: str) -> bytes:
        core = word.rstrip(",.;:!?")
        if len(core) < len(word) and core and core[-1].isalnum():
            # A cut falls between a letter or digit and what follows.
            found = self[core] + self[word[len(core):]]
        else:
            parts = [word] if word.isalpha() else _PARTS.findall(word)
            ids = [t.id for part in parts
                   for t in self.model.tokenize(part if part.isascii() else self.spelled(part)[0][0])]
            found = struct.pack(f"<{len(ids)}I", *ids)
        self[word] = found
        return found


class Tokens:
    """Token ids of texts as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # The word table holds for tokenizers that compose, join white space, lower-case and cut as below, and no others.
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        self.by_word = (spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
                        and [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
                        and [c.get("type") for c in cuts] == ["Split", "ByteLevel"] and cuts[0].get("pattern") == _CUT
                        and not cuts[1].get("add_prefix_space") and not cuts[1].get("use_regex"))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = _Words(self.tokenizer.model, ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str | None) -> bytes:
        text = text or ""
        if not self.by_word or not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return self.whole(text)
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        return b"".join(map(self.words.__getitem__, text.lower().split()))


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, text: str = "text",
           doc_id: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """Every document's pieces with their place, length and CRC, and with ``keep_ids`` their token ids.

    ``path``: the vocabulary, on every machine.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens, end = Tokens(path or tokenizer_path()), np.array([END_ID], "<u4").tobytes()
        for pdf in batches:
            out = []
            for one, t in zip(pdf["doc_id"], pdf["text"]):
                ids = tokens(t) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    out.append((one, k, at // 4, len(part) // 4, zlib.crc32(part), *([np.frombuffer(part, "<i4")] * keep_ids)))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids])
            yield frame.astype({"doc_id": pdf["doc_id"].dtype})

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(cut, PIECES + ", ids array<int>" * keep_ids)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that holds it."""
    room_of: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    rooms = 0  # bit r: some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = room_of[room].pop()
            if not room_of[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        left = room - n
        if left:
            room_of[left].append(b)
            rooms |= 1 << left
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Drain the emptier bins into the fuller ones by moves and swaps that raise the sum of squared fills.

    Bins are visited from the emptiest on, until a whole round finds no step
    or no bin can be saved any more. Steps are looked for among the different
    lengths of each bin, so many equal pieces cost no more than one.
    """
    # All fills are multiples of what divides every length.
    unit = int(np.gcd.reduce(lengths))
    least = -(-int(lengths.sum()) // (capacity // unit * unit))
    fill = np.array([lengths[b].sum() for b in bins], np.int64)
    where = np.empty(len(lengths), np.int64)
    for b, items in enumerate(bins):
        where[items] = b
    values, kind = np.unique(lengths, return_inverse=True)
    better = True
    while better and (fill > 0).sum() > least:
        better = False
        for b in np.argsort(fill, kind="stable").tolist():
            while 0 < fill[b] < capacity and (step := _step(b, where, kind, values, fill, capacity)):
                out, to, back = step
                out, back = _items(where, kind, b, out), _items(where, kind, to, back)
                where[out], where[back] = to, b
                gain = int(lengths[out].sum() - lengths[back].sum())
                fill[to] += gain
                fill[b] -= gain
                better = True
            if better and (fill > 0).sum() <= least:
                break
    order = np.argsort(where, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(where[order]) != 0])
    return [part.tolist() for part in np.split(order, cuts[1:])]


def _items(where: np.ndarray, kind: np.ndarray, b: int, kinds: list[int]) -> list[int]:
    """Different items of a bin, one of each of the ``kinds`` of length."""
    out: list[int] = []
    for k in kinds:
        out.append(next(i for i in np.flatnonzero((where == b) & (kind == k))[:len(kinds)].tolist() if i not in out))
    return out


def _step(b: int, where: np.ndarray, kind: np.ndarray, values: np.ndarray, fill: np.ndarray, capacity: int):
    """(kinds of length out of b, bin they go to, kinds back) of the largest gain, or None."""
    at, back = np.divmod(np.unique(where * len(values) + kind), len(values))
    target, back = at[at != b], back[at != b]
    if not len(target):
        return None
    own, many = np.unique(kind[where == b], return_counts=True)
    room = capacity - fill
    best = (0, None)

    def consider(total, taken):
        """Give ``taken`` for one piece of another bin."""
        nonlocal best
        gain = total - values[back]
        ok = (gain > best[0]) & (gain <= room[target]) & (fill[target] + gain > fill[b])
        if ok.any():
            k = int(np.argmax(np.where(ok, gain, 0)))
            best = (int(gain[k]), (taken, int(target[k]), [int(back[k])]))

    bins = np.unique(target)
    for k in own[::-1].tolist():  # a move, or one for one
        n = int(values[k])
        free = bins[(room[bins] >= n) & (fill[bins] + n > fill[b])]
        if len(free) and n > best[0]:
            best = (n, ([k], int(free[np.argmin(room[free])]), []))
        consider(n, [k])
    if best[1] is None:  # two for one
        seen = set()
        for x, i in enumerate(own.tolist()):
            for j in own[x + (many[x] < 2):].tolist():
                total = int(values[i] + values[j])
                if total not in seen:
                    seen.add(total)
                    consider(total, [i, j])
    return best[1]


def pack(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    return improve(best_fit(lengths, capacity), lengths, capacity) if len(lengths) else []


def _group(capacity: int, turn: int):
    def packed(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        # One order whatever way the rows came.
        pdf = pdf.sort_values(["length", "ids_crc32", "doc_id", "piece"], ascending=False, kind="stable").reset_index(drop=True)
        lengths = pdf["length"].to_numpy(np.int64)
        sequence, offset, room = (np.zeros(len(pdf), np.int64) for _ in range(3))
        for k, items in enumerate(pack(lengths, capacity)):
            ends = np.cumsum(lengths[items])
            sequence[items] = (turn << 56) | (int(key[0]) << 20) | k
            offset[items] = ends - lengths[items]
            room[items] = capacity - ends[-1]
        return pdf.drop(columns="grp").assign(sequence_id=sequence, offset=offset, room=room)

    return packed


def packed(parts: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with sequence_id, offset and the sequence's room."""
    done, rest = [], stage(parts, "pieces")
    placed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema) + f", {PLACE}"
    for turn in range(rounds):
        n = rest.count()
        groups = max(1, -(-n // group_rows))
        # The row's place in the written table keeps repeated rows apart.
        grp = F.pmod(F.xxhash64(F.lit(turn), "doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups))
        out = stage(rest.withColumn("grp", grp).groupBy("grp").applyInPandas(_group(capacity, turn), placed), "packed")
        last = turn == rounds - 1 or groups == 1
        done.append(out if last else out.where(F.col("room") <= SLACK))
        if last:
            break
        rest = out.where(F.col("room") > SLACK).drop("sequence_id", "offset", "room")
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, spans): each sequence's tokens and the document pieces they come from, in order.

    ``placed``: packed pieces that kept their ids. A sequence is bounded by the capacity, so are its pieces.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "start", "ids")))
    rows = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    return rows.select("sequence_id", F.flatten("parts.ids").alias("ids"),
                       F.transform("parts", lambda x: x.dropFields("ids")).alias("spans"))


def op1(docs: DataFrame) -> DataFrame:
    return packed(pieces(docs)).drop("room")
