"""Interpolated Kneser-Ney character models over several classes.

Text becomes a sequence of character codes: a lower-cased letter of any script
is its own code (letters beyond the basic plane share 6,400 codes), and every run
of anything else is one gap (0). ``ORDER`` codes of 16 bits are an n-gram, packed in one 64-bit
key. Each order has a sorted array of the keys seen, with the log-probabilities of
all classes beside it, and one of the contexts seen, with their back-off weights.

Counting covers all texts given: each task counts its part and emits every
(class, n-gram) once, and Spark adds them up in a written table, which grows with the corpus.
Up to ``MAX_GRAMS`` n-grams and ``MAX_CELLS`` probabilities the driver smooths the table and broadcasts the result.
A larger table is smoothed by Spark, with the same formula over all n-grams (``Tables``): the most frequent ones are broadcast
with their probabilities, and those of every other n-gram are looked up for each batch of texts by joins (``applied``).
So these sizes bound what the driver holds, not what a model knows. More than ``MAX_CLASSES`` classes fail the query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annuity.llm.common import fresh, stage

BITS, ORDER = 16, 4
CODES = 1 << BITS
# Letters beyond the basic plane share the codes of its private area.
SHARED_FROM, SHARED = 0xE000, 0x1900
CONTEXT = ORDER - 1
SHIFT = np.uint64(BITS)
CHARS_AT_ONCE = 1 << 18
COUNTS_AT_ONCE = 1 << 22
MAX_CLASSES = 1024
MAX_GRAMS, MAX_CELLS = 1 << 22, 1 << 25
COUNT_BINS = 1000
# Texts whose n-grams are looked up together, in characters.
CHARS_A_BATCH = 1 << 22


class Alphabet:
    """Character code by code point; the table is made once per Python worker."""

    table: np.ndarray | None = None

    @classmethod
    def codes(cls) -> np.ndarray:
        if cls.table is None:
            table = np.zeros(0x110000, np.uint16)
            letter = np.array([chr(c).isalpha() for c in range(0x110000)])
            points = np.flatnonzero(letter)
            table[points] = np.where(points < CODES, points, SHARED_FROM + points % SHARED)
            cls.table = table
        return cls.table


def encode(text: str | None) -> np.ndarray:
    """Codes with CONTEXT gaps in front; runs of other characters are one gap."""
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate([np.zeros(CONTEXT, np.uint16), Alphabet.codes()[raw], np.zeros(1, np.uint16)])
    keep = np.r_[True, (codes[1:] | codes[:-1]) != 0]
    keep[:CONTEXT] = True
    return codes[keep]


@dataclass
class Chunk:
    """N-grams of several texts: those of segment i are grams[start[i]:end[i]], of text doc[i].

    Of those, the first own[i] are in no later segment of the text.
    """

    grams: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    own: np.ndarray


def chunks(texts, overlap: int = 0) -> Iterator[Chunk]:
    """Whole texts as n-grams, about CHARS_AT_ONCE at a time.

    A longer text is cut into segments that share ``overlap`` n-grams.
    """
    parts, docs, own, size = [], [], [], 0
    for at, text in enumerate(texts):
        codes = encode(text)
        if len(codes) <= CONTEXT + 1 and not codes.any():
            continue
        stop = max(1, len(codes) - CONTEXT - overlap)
        for begin in range(0, stop, CHARS_AT_ONCE):
            part = codes[begin:begin + CHARS_AT_ONCE + CONTEXT + overlap]
            parts.append(part)
            docs.append(at)
            own.append(CHARS_AT_ONCE if begin + CHARS_AT_ONCE < stop else len(part) - CONTEXT)
            size += len(part)
            if size >= CHARS_AT_ONCE:
                yield _chunk(parts, docs, own)
                parts, docs, own, size = [], [], [], 0
    if parts:
        yield _chunk(parts, docs, own)


def _chunk(parts, docs, own) -> Chunk:
    codes = np.concatenate(parts).astype(np.uint64)
    n = len(codes) - CONTEXT
    grams = np.zeros(n, np.uint64)
    for k in range(ORDER):
        grams = (grams << np.uint64(BITS)) | codes[k:k + n]
    lengths = np.array([len(p) for p in parts])
    start = np.cumsum(lengths) - lengths
    return Chunk(grams, start, start + lengths - CONTEXT, np.array(docs), np.array(own))


def _own(chunk: Chunk) -> np.ndarray:
    """Which n-grams lie inside one segment."""
    mark = np.zeros(len(chunk.grams) + 1, np.int8)
    mark[chunk.start] += 1
    np.subtract.at(mark, chunk.end, 1)
    return np.cumsum(mark[:-1], dtype=np.int8) > 0


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(class, gram, n) of a task's texts. What is held is merged as it grows: at most one entry per n-gram."""
    held: dict[str, list] = {}
    size = 0

    def merged(parts):
        grams = np.concatenate([p[0] for p in parts])
        order = np.argsort(grams, kind="stable")
        grams, n = grams[order], np.concatenate([p[1] for p in parts])[order]
        first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
        return [(grams[first], np.add.reduceat(n, first))]

    for pdf in batches:
        for label, rows in pdf.groupby("label"):
            for chunk in chunks(rows["text"]):
                grams, n = np.unique(chunk.grams[_own(chunk)], return_counts=True)
                held.setdefault(label, []).append((grams, n))
                size += len(grams)
                if size > COUNTS_AT_ONCE:
                    held = {c: merged(p) for c, p in held.items()}
                    size = 0
    for label, parts in held.items():
        grams, n = merged(parts)[0]
        yield pd.DataFrame({"label": label, "gram": grams.view(np.int64), "n": n.astype(np.int64)})


def counted(rows: DataFrame) -> DataFrame:
    """(label, gram, n) over all ``rows`` (label, text)."""
    parts = rows.select("label", "text").mapInPandas(_count, "label string, gram long, n long")
    return parts.groupBy("label", "gram").agg(F.sum("n").alias("n"))


def discount(n: np.ndarray) -> float:
    """The usual estimate from how many n-grams occur once and twice."""
    return discount_of(int((n == 1).sum()), int((n == 2).sum()))


def discount_of(once: int, twice: int) -> float:
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


class Smoothed:
    """Interpolation of one order's counts with a lower order, for one class."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.grams, self.n, self.d = grams, n, discount(n)
        context = grams >> SHIFT
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(grams) else np.zeros(0, np.int64)
        self.context = context[first]
        self.total = np.add.reduceat(n, first) if len(first) else np.zeros(0, np.int64)
        self.kinds = np.diff(np.r_[first, len(grams)])

    def left_over(self, context: np.ndarray) -> np.ndarray:
        """Weight of the lower order after a context; 1 where it was never seen."""
        at, hit = find(self.context, context)
        return np.where(hit, self.d * _take(self.kinds, at) / np.maximum(_take(self.total, at), 1), 1.0)

    def probability(self, grams: np.ndarray, lower: np.ndarray) -> np.ndarray:
        at, hit = find(self.grams, grams)
        c, seen = find(self.context, grams >> SHIFT)
        kept = np.where(hit, _take(self.n, at) - self.d, 0.0) / np.maximum(_take(self.total, c), 1)
        return np.where(seen, kept, 0.0) + self.left_over(grams >> SHIFT) * lower


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in a sorted hash array, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _take(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return values[at] if len(values) else np.zeros(len(at))


def _tail(order: int) -> np.uint64:
    """Mask of the last ``order`` codes."""
    return np.uint64((1 << BITS * order) - 1)


class Model:
    """Per class log-probabilities: of stored n-grams, else back-off weight plus the next lower order."""

    # Where the n-grams that are not in the arrays have their probabilities; None where all are in the arrays.
    tables: Tables | None = None

    def __init__(self, labels: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]], shared: bool):
        """``shared``: the lower orders come from the n-grams of all classes together."""
        self.labels = labels
        counts = {c: (g[o := np.argsort(g)], n[o]) for c, (g, n) in ((c, (g.astype(np.uint64), n)) for c, (g, n) in counts.items())}
        every = np.unique(np.concatenate([counts[c][0] for c in labels])) if labels else np.zeros(0, np.uint64)
        # Index 0 is unused: keys[k] and so on are of order k.
        self.keys: list[np.ndarray] = [np.zeros(0, np.uint64)] * (ORDER + 1)
        self.keys[ORDER] = every
        for k in range(ORDER - 1, 0, -1):
            self.keys[k] = np.unique(self.keys[k + 1] & _tail(k))
        self.contexts = [np.unique(keys >> SHIFT) for keys in self.keys]
        self.stored = [np.zeros((len(keys), len(labels)), np.float32) for keys in self.keys]
        self.left = [np.zeros((len(contexts), len(labels)), np.float32) for contexts in self.contexts]
        pooled = self._smooth(every, None) if shared else None
        for at, c in enumerate(labels):
            probabilities, left = self._smooth(*counts[c], pooled)
            for k in range(1, ORDER + 1):
                self.stored[k][:, at], self.left[k][:, at] = np.log(probabilities[k]), np.log(left[k])

    def _smooth(self, grams: np.ndarray, n: np.ndarray | None, below: tuple[list, list] | None = None) -> tuple[list, list]:
        """Probabilities of all keys and back-off weights of all contexts by order, of one class.

        Lower orders count the kinds of n-grams that end in theirs, or are those of ``below``.
        """
        probabilities, left = ([None] * (ORDER + 1) for _ in range(2))
        kinds, orders = grams, [None] * (ORDER + 1)
        orders[ORDER] = Smoothed(grams, n) if n is not None else None
        for k in range(ORDER - 1, 0, -1):
            kinds, many = np.unique(kinds & _tail(k), return_counts=True)
            orders[k] = Smoothed(kinds, many)
        for k in range(1, ORDER + 1):
            if below is not None and k < ORDER:
                probabilities[k], left[k] = below[0][k], below[1][k]
            elif orders[k] is not None:
                lower = 1.0 / CODES if k == 1 else probabilities[k - 1][find(self.keys[k - 1], self.keys[k] & _tail(k - 1))[0]]
                probabilities[k] = orders[k].probability(self.keys[k], lower)
                left[k] = orders[k].left_over(self.contexts[k])
        return probabilities, left

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        """One row per n-gram, one column per class."""
        if self.tables is not None:
            raise ValueError("a model with tables is used by ``applied``")
        grams = np.asarray(grams, np.uint64)
        out = np.zeros((len(grams), len(self.labels)), np.float32)
        rest = np.arange(len(grams))
        for k in range(ORDER, 0, -1):
            own = grams[rest] & _tail(k)
            at, hit = find(self.keys[k], own)
            out[rest[hit]] += self.stored[k][at[hit]]
            rest, own = rest[~hit], own[~hit]
            if not len(rest):
                return out
            at, seen = find(self.contexts[k], own >> SHIFT)
            out[rest[seen]] += self.left[k][at[seen]]
        out[rest] -= np.float32(np.log(CODES))
        return out


def ship(df: DataFrame, model: Model):
    """A broadcast of the model's arrays: at most ``MAX_CELLS`` probabilities of an order."""
    return df.sparkSession.sparkContext.broadcast({k: v for k, v in vars(model).items() if k != "tables"})


def shipped(arrays) -> Model:
    out = Model.__new__(Model)
    out.__dict__ = dict(arrays.value)
    return out


class Found:
    """A model with the probabilities of other n-grams beside its arrays, as looked up for some texts."""

    def __init__(self, model: Model, grams: np.ndarray, stored: np.ndarray):
        order = np.argsort(grams)
        self.labels, self.model, self.grams, self.stored = model.labels, model, grams[order], stored[order]

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        grams = np.asarray(grams, np.uint64)
        out = np.zeros((len(grams), len(self.labels)), np.float32)
        for keys, stored in ((self.model.keys[ORDER], self.model.stored[ORDER]), (self.grams, self.stored)):
            at, hit = find(keys, grams)
            out[hit] = stored[at[hit]]
        return out


def _masked(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit(int(_tail(order)))) if order < ORDER else gram


def _context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, BITS)


class Tables:
    """The smoothed counts as written tables, one set per order: any n-gram's probabilities by joins.

    ``kept[k]``: (key, values) what each class keeps of an n-gram's own count; ``left[k]``: (key, values) each
    class's weight of the lower order after a context. ``values`` are by class number; a class that has not
    seen the key is not in them. With ``shared`` lower orders there is one class, 0, below the highest order.
    """

    def __init__(self, counts: DataFrame, classes: int, shared: bool):
        """``counts``: (c, gram, n), each (c, gram) once."""
        self.classes, self.shared = classes, shared
        self.kept: list[DataFrame | None] = [None] * (ORDER + 1)
        self.left: list[DataFrame | None] = [None] * (ORDER + 1)
        kinds = counts
        for k in range(ORDER, 0, -1):
            if k < ORDER:
                if shared and k == ORDER - 1:
                    kinds = kinds.select(F.lit(0).alias("c"), "gram").distinct()
                kinds = stage(kinds.groupBy("c", _masked(F.col("gram"), k).alias("gram")).agg(F.count(F.lit(1)).alias("n")), f"kinds-{k}", narrow=True)
            self.kept[k], self.left[k] = self._smooth(kinds, k)

    @staticmethod
    def _smooth(kinds: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
        # One row per class.
        seen = kinds.groupBy("c").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect()
        d = F.create_map(*[x for r in seen for x in (F.lit(r["c"]), F.lit(discount_of(r["once"], r["twice"])))])[F.col("c")]
        contexts = kinds.groupBy("c", _context(F.col("gram")).alias("h")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        own = kinds.select("c", "gram", "n", _context(F.col("gram")).alias("h")).join(contexts, ["c", "h"])
        by_class = lambda key, value: (
            F.col(key).alias("key"), F.struct(F.col("c"), value.alias("value")).alias("v"))
        tables = (own.select(*by_class("gram", (F.col("n") - d) / F.col("total"))),
                  contexts.select(*by_class("h", d * F.col("kinds") / F.col("total"))))
        kept, left = (stage(t.groupBy("key").agg(F.map_from_entries(F.collect_list("v")).alias("values")), f"{name}-{k}", narrow=True)
                      for t, name in zip(tables, ("kept", "left")))
        return kept, left

    def probabilities(self, grams: DataFrame) -> DataFrame:
        """(gram, p) of the distinct n-grams in ``grams`` (gram): p has a probability for each class."""
        wanted = {ORDER: stage(grams.select("gram").distinct(), f"wanted-{ORDER}", narrow=True)}
        for k in range(ORDER - 1, 0, -1):
            wanted[k] = stage(wanted[k + 1].select(_masked(F.col("gram"), k).alias("gram")).distinct(), f"wanted-{k}", narrow=True)
        below: DataFrame | None = None
        for k in range(1, ORDER + 1):
            gram = F.col("gram")
            rows = (wanted[k].select("gram", _context(gram).alias("_h"), _masked(gram, k - 1).alias("_tail"))
                    .join(self.kept[k].select(F.col("key").alias("gram"), F.col("values").alias("_kept")), "gram", "left")
                    .join(self.left[k].select(F.col("key").alias("_h"), F.col("values").alias("_left")), "_h", "left"))
            if below is None:
                lower = lambda c: F.lit(1.0 / CODES)
            else:
                rows = rows.join(below.select(F.col("gram").alias("_tail"), F.col("p").alias("_lower")), "_tail")
                one = self.shared and k == ORDER
                lower = lambda c, one=one: F.get("_lower", F.lit(0) if one else c)
            width = 1 if self.shared and k < ORDER else self.classes
            p = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda c: (
                F.coalesce(F.try_element_at("_kept", c), F.lit(0.0))
                + F.coalesce(F.try_element_at("_left", c), F.lit(1.0)) * lower(c)))
            below = stage(rows.select("gram", p.alias("p")), f"probabilities-{k}", narrow=True)
        return below


def applied(docs: DataFrame, model: Model, function: Callable, kind: str, name: str) -> DataFrame:
    """``docs`` with column ``name`` of type ``kind``: ``function(model, texts)``, a list of values, over their ``text``."""
    arrays = ship(docs, model)
    if model.tables is None:

        @F.pandas_udf(kind)
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = shipped(arrays)
            for texts in batches:
                yield function(own, texts.tolist())

        return docs.withColumn(name, of(F.col("text")))
    row, batch, result = fresh(docs, "_row", "_batch", "_result")
    # Row numbers hold once they are written.
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-texts")
    chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    texts = rows.select(F.pmod(F.xxhash64(row), F.lit(chars // CHARS_A_BATCH + 1)).alias("batch"), F.col(row).alias("row"), "text")

    def grams_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = shipped(arrays).keys[ORDER]
        for pdf in batches:
            for of_batch, own in pdf.groupby("batch"):
                for chunk in chunks(own["text"]):
                    grams = np.unique(chunk.grams[_own(chunk)])
                    rest = grams[~find(keys, grams)[1]]
                    yield pd.DataFrame({"batch": np.int64(of_batch), "gram": rest.view(np.int64)})

    needed = stage(texts.select("batch", "text").mapInPandas(grams_of, "batch long, gram long").distinct(), "needed-grams")
    found = needed.join(model.tables.probabilities(needed), "gram").select("batch", "gram", F.transform("p", lambda x: F.ln(x).cast("float")).alias("p"))
    classes = len(model.labels)

    def apply(own: pd.DataFrame, looked_up: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame({"row": pd.Series([], dtype=np.int64), "value": pd.Series([], dtype=object)})
        stored = np.stack(looked_up["p"].to_list()) if len(looked_up) else np.zeros((0, classes), np.float32)
        with_rest = Found(shipped(arrays), looked_up["gram"].to_numpy(np.int64).view(np.uint64), stored.astype(np.float32))
        values = function(with_rest, own["text"].tolist())
        values = values.to_dict("records") if isinstance(values, pd.DataFrame) else list(values)
        return pd.DataFrame({"row": own["row"].to_numpy(), "value": pd.Series(values, dtype=object)})

    done = (texts.groupBy("batch").cogroup(found.groupBy("batch"))
            .applyInPandas(apply, f"row long, value {kind if '<' in kind else f'struct<{kind}>'}"))
    done = stage(done, "looked-up")
    return (rows.join(done.select(F.col("row").alias(batch), F.col("value").alias(result)), F.col(row) == F.col(batch))
            .select(*docs.columns, F.col(result).alias(name)))


def least_counts(bins: list[tuple[str, int, int]], classes: int) -> dict[str, int]:
    """By class, the count from which its n-grams are held in arrays, from (class, count, n-grams with it)."""
    room = min(MAX_GRAMS, MAX_CELLS // max(classes, 1)) // max(classes, 1)
    least: dict[str, int] = {}
    held: dict[str, int] = {}
    for label, n, grams in sorted(bins, key=lambda x: (x[0], -x[1])):
        held[label] = held.get(label, 0) + grams
        if held[label] <= room:
            least[label] = n
    return least


def model(counts: DataFrame, shared: bool = False) -> Model:
    """Smooth all counts. Where they do not fit the arrays, those hold the most frequent n-grams of each class, and ``tables`` the rest.

    N-grams that occur ``COUNT_BINS`` times or more share one bin.
    """
    counts = stage(counts, "character-counts", narrow=True)
    names = [r["label"] for r in counts.select("label").distinct().limit(MAX_CLASSES + 1).collect()]
    if len(names) > MAX_CLASSES:
        raise ValueError(f"character models of more than {MAX_CLASSES} classes")
    names.sort()
    if not names:
        return Model([], {}, shared)
    bins = counts.groupBy("label", F.least(F.col("n"), F.lit(COUNT_BINS)).alias("n")).agg(F.count(F.lit(1)).alias("grams")).collect()
    bins = [(r["label"], r["n"], r["grams"]) for r in bins]
    least = least_counts(bins, len(names))
    number = F.create_map(*[c for k, name in enumerate(names) for c in (F.lit(name), F.lit(k))])
    numbered = counts.select("label", number[F.col("label")].alias("c"), "gram", "n")
    if all(n >= least.get(label, n + 1) for label, n, _ in bins):
        pdf = numbered.select("c", "gram", "n").toPandas()
        by = {names[c]: (r["gram"].to_numpy().view(np.uint64), r["n"].to_numpy()) for c, r in pdf.groupby("c")}
        return Model(names, by, shared)
    tables = Tables(numbered.select("c", "gram", "n"), len(names), shared)
    limit = F.create_map(*[c for name in names for c in (F.lit(name), F.lit(least.get(name)).cast("long"))])
    often = tables.probabilities(numbered.where(F.col("n") >= limit[F.col("label")]))
    pdf = often.select("gram", *[F.ln(F.get("p", F.lit(k))).cast("float").alias(f"p{k}") for k in range(len(names))]).toPandas()
    grams = pdf["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(grams)
    out = Model([], {}, shared)
    out.labels, out.tables = names, tables
    out.keys[ORDER], out.stored[ORDER] = grams[order], pdf.drop(columns="gram").to_numpy(np.float32)[order]
    return out
