"""Exact token counts at every prefix of a text, by dynamic programming.

The tokenizer cuts a text into pieces (words with their leading space, runs of
white space and so on) and merges byte pairs inside each. Inside a piece, the
last token of a prefix's encoding is the one token that ends there and may
follow the last token of the prefix before it: two tokens may be neighbours
if encoding their joined text gives the same two tokens, and a sequence is an
encoding if all its neighbours may be. So from left to right

    count[i] = count[i - len(last)] + 1

and one pass gives the count of every prefix, not only of the whole piece.
Counts of pieces are kept by piece, and a text's counts are those of its
pieces on top of what stands before. A prefix may be cut otherwise than the
text it comes from in three places, which are computed as the prefix has them:
the last character of a run of white space, a contraction cut in the middle
and a special string cut in the middle.

The table has the counts in blocks of ``BLOCK`` characters, so questions are
answered from it without encoding again: tokens of any prefix
(``tokens_at``), the longest prefix within a budget (``longest_within``), texts
cut to a budget (``truncated``).

Rows: at least one block per input row; ``row`` tells repeated rows apart.
Null and empty texts have one block without counts. Null ids are kept. Other
columns are ignored. An empty table gives an empty result. Texts are
read whole; a text is counted about ``PART`` characters at a time.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annuity.llm.common import fresh, stage

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
BLOCK = 16384
PART = 1 << 20
CACHED_PIECES = 500_000
CACHED_PAIRS = 500_000
CACHED_LENGTH = 64
TABLE = ("row long, doc_id {id}, start long, counts array<int>, n_chars long, n_tokens long, last boolean")

# Characters that byte-level vocabularies spell as themselves, and the white space of their patterns.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WHITE = re.compile(f"[{_SPACES}]+")
_RUN = re.compile(f"[{_SPACES}]{{2}}")
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
# Characters whose class every library agrees on; other texts are cut by the tokenizer itself.
_PLAIN = re.compile("[\t\n\r -~\xc0-\xd6\xd8-\xf6\xf8-\u0131\u0132-\u017e\u2018-\u201d\u2013\u2014\u2026]*")
_PIECES = re.compile("|".join(_CONTRACTIONS) + r"| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
# A single space between two words: the text is always cut before it.
_SEAM = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def _spelling() -> dict[int, str]:
    """The character that spells each byte: its own where printed, else the next one from 256 on."""
    out, more = {b: chr(b) for b in _PRINTED}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(more)
            more += 1
    return out


class _Pieces(dict):
    """Counts by piece; what is missing is computed, and kept if it is short.

    When it is full, what was used since the last time stays.
    """

    def __init__(self, compute):
        super().__init__()
        self.compute, self.older = compute, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = self.compute(piece)
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found


class Prefixes:
    """Counts of tokens at every prefix under one byte-level vocabulary."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback")
                or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or spec["normalizer"]
                or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex")
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])):
            raise ValueError(f"{path}: prefix counts need a plain byte-level BPE vocabulary")
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = model["vocab"]
        self.longest = max(map(len, self.vocabulary))
        self.spelling = _spelling()
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pieces = _Pieces(self._piece)
        self.pairs: dict[tuple[str, str], bool] = {}

    def _neighbours(self, left: str, right: str) -> bool:
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > CACHED_PAIRS:
                self.pairs.clear()
            parts = [t.value for t in self.tokenizer.model.tokenize(left + right)]
            found = self.pairs[key] = parts == ([left, right] if left else [right])
        return found

    def _piece(self, piece: str) -> bytes:
        """The count at every character of one piece, as 32-bit numbers."""
        spelled = piece.replace(" ", self.spelling[32]) if piece.isascii() and piece.isprintable() else (
            piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.spelling))
        vocabulary, pairs = self.vocabulary, self.pairs
        count, last = [0], [""]
        for end, new in enumerate(spelled, 1):
            # Only one token fits, so the likeliest may be tried first: the last one grown by a character, then that character.
            left = last[-1]
            begin, token = end - 1 - len(left), left + new
            if token not in vocabulary or not (pairs.get((last[begin], token)) or self._neighbours(last[begin], token)):
                begin, token = end - 1, new
                if not (pairs.get((left, token)) or self._neighbours(left, token)):
                    for begin in range(max(0, end - self.longest), end - 1):
                        token = spelled[begin:end]
                        if token in vocabulary and self._neighbours(last[begin], token):
                            break
                    else:
                        raise ValueError(f"no encoding ends at byte {end} of {piece[:50]!r}")
            count.append(count[begin] + 1)
            last.append(token)
        if len(spelled) == len(piece) and piece not in _CONTRACTIONS:
            return array("i", count[1:]).tobytes()
        counts = np.array(count[1:], np.int32)
        if len(spelled) != len(piece):  # where a character ends
            raw = np.frombuffer(piece.encode("utf-8", "surrogatepass"), np.uint8)
            counts = counts[np.append(raw[1:] & 0xC0 != 0x80, True)]
        if piece in _CONTRACTIONS and len(piece) == 3:  # a part of it is no contraction
            counts[1] = self._whole("'") + self._whole(piece[1])
        return counts.tobytes()

    def _whole(self, piece: str) -> int:
        return int(np.frombuffer(self.pieces[piece], np.int32)[-1])

    def cut(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return _PIECES.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def ordinary(self, text: str) -> np.ndarray:
        """The count at every character of a text in which special strings mean nothing."""
        parts = self.cut(text)
        if not parts:
            return np.zeros(0, np.int64)
        counts = np.frombuffer(b"".join(map(self.pieces.__getitem__, parts)), np.int32).astype(np.int64)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = lengths.cumsum()
        totals = counts[ends - 1]
        before = totals.cumsum() - totals
        counts += np.repeat(before, lengths)
        if _RUN.search(text):
            for k, part in enumerate(parts[:-1]):
                if part[-1].isspace() and _WHITE.fullmatch(part) and _WHITE.match(parts[k + 1]):
                    # A prefix that ends with this run has it in one piece.
                    counts[ends[k]] = before[k] + self._whole(part + parts[k + 1][0])
        return counts

    def parts(self, text: str) -> Iterator[np.ndarray]:
        """The counts at every character, part by part."""
        before, begin = 0, 0
        found = list(self.special.finditer(text)) if self.special else []
        for match in [*found, None]:
            stop = match.start() if match else len(text)
            # All but the last character of a special string are ordinary text to a prefix.
            reach = match.end() - 1 if match else stop
            while begin < reach:
                seam = _SEAM.search(text, begin + PART, stop) if reach - begin > PART else None
                end = seam.start() if seam else reach
                counts = self.ordinary(text[begin:end])
                yield counts + before
                if seam:
                    before, begin = before + int(counts[-1]), end
                else:
                    before += int(counts[stop - begin - 1]) if stop > begin else 0
                    begin = reach
            if match:
                before, begin = before + 1, match.end()
                yield np.array([before])


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def prefixes_of(path: str) -> Prefixes:
    """Kept by a Python worker from task to task: most pieces of a task's texts are known from the last one's."""
    return Prefixes(path)


def _blocks(prefixes: Prefixes, text: str, block: int) -> Iterator[np.ndarray]:
    left = np.zeros(0, np.int64)
    for counts in prefixes.parts(text):
        left = np.concatenate([left, counts])
        full = len(left) // block * block
        yield from np.split(left[:full], range(block, full, block)) if full else ()
        left = left[full:]
    yield left


def prefix_table(docs: DataFrame, path: str | None = None, text: str = "text", doc_id: str = "doc_id",
                 row: Column | None = None, block: int = BLOCK) -> DataFrame:
    """(row, doc_id, start, counts, n_chars, n_tokens, last): blocks of counts of each text's prefixes.

    ``counts[k]`` is the count of the first start + k + 1 characters. ``n_chars``
    and ``n_tokens`` stand at the block's end, so in the ``last`` block they
    are the text's. ``path``: the vocabulary, on every machine.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = prefixes_of(path or tokenizer_path())
        for batch in batches:
            place, start, arrays, tokens, last = [], [], [], [], []
            held = 0

            def table():
                values = pa.array(np.concatenate(arrays).astype(np.int32)) if arrays else pa.array([], pa.int32())
                sizes = np.array([len(a) for a in arrays], np.int64)
                at = pa.array(place, pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, sizes.cumsum()).astype(np.int32)), values)
                begin = np.array(start, np.int64)
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(begin), lists, pa.array(begin + sizes),
                     pa.array(tokens, pa.int64()), pa.array(last, pa.bool_())],
                    names=["row", "doc_id", "start", "counts", "n_chars", "n_tokens", "last"])

            for i, one in enumerate(batch.column(2)):
                begin, total = 0, 0
                for counts in _blocks(prefixes, one.as_py() or "", block):
                    if begin and not len(counts):  # the text ended with a block
                        last[-1] = True
                        break
                    total = int(counts[-1]) if len(counts) else total
                    place.append(i), start.append(begin), arrays.append(counts), tokens.append(total)
                    last.append(len(counts) < block)
                    begin, held = begin + len(counts), held + len(counts)
                if held > PART:
                    yield table()
                    place, start, arrays, tokens, last, held = [], [], [], [], [], 0
            if place:
                yield table()

    number = F.monotonically_increasing_id() if row is None else row
    rows = docs.select(number.alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(counted, TABLE.format(id=kind))


def tokens_at(table: DataFrame, chars: int) -> DataFrame:
    """(row, doc_id, tokens): tokens of the first ``chars`` characters; the whole text's where it is shorter."""
    inside = (F.col("start") < chars) & (F.col("n_chars") >= chars)
    shorter = F.col("last") & (F.col("n_chars") < chars)
    return table.where(inside | shorter).select("row", "doc_id", F.when(
        inside, F.expr(f"get(counts, cast({int(chars)} - start - 1 as int))").cast("long")).otherwise(F.col("n_tokens")).alias("tokens"))


def longest_within(table: DataFrame, budget: int) -> DataFrame:
    """(row, doc_id, chars): the longest prefix of at most ``budget`` tokens.

    A longer prefix may have fewer tokens, so every count is looked at.
    """
    ends = F.array_max(F.transform("counts", lambda c, i: F.when(c <= budget, F.col("start") + i + 1)))
    return table.groupBy("row", "doc_id").agg(F.coalesce(F.max(ends), F.lit(0)).cast("long").alias("chars"))


def truncated(docs: DataFrame, budget: int, path: str | None = None, text: str = "text",
              doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with every text cut to its longest prefix of at most ``budget`` tokens; null stays null."""
    row, chars = fresh(docs, "row_number", "kept_chars")
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    kept = longest_within(prefix_table(rows, path, text, doc_id, F.col(row)), budget)
    kept = kept.select(F.col("row").alias(row), F.col("chars").cast("int").alias(chars))
    cut = F.substring(F.col(text), F.lit(1), F.col(chars))
    return rows.join(kept, row).withColumn(text, cut).select(*docs.columns)


def counted(docs: DataFrame, limit: int = LIMIT, path: str | None = None, text: str = "text",
            doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document, from the last block of its prefix counts."""
    size = F.octet_length(F.coalesce(F.col(text).cast("string"), F.lit("")))
    # The size travels in the place of the row number: no join, and texts are read once.
    table = prefix_table(docs, path, text, doc_id, size.cast("long"))
    return table.where("last").select("doc_id", F.col("row").alias("n_bytes"), "n_tokens",
                                      (F.col("n_tokens") > limit).alias("over_limit"))


def op11(docs: DataFrame) -> DataFrame:
    return counted(docs)
