"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints: 64 bits over word shingles. Two fingerprints link when they
differ in at most ``max_bits`` bits; a component is everything that links
reach.

The index. Among ``max_bits + 1`` fields of a fingerprint, two linked
fingerprints agree on at least one, so each distinct fingerprint is entered
once per field, rotated to put that field in front, and the entries are sorted
by Gray rank (the place of the bits in the reflected Gray sequence). Entries
with one field value then form one run, a top node whose shared masked bit
pattern is that field. A node with more than ``node_rows`` entries is divided by
the next bits of the Gray rank, again and again, so no task holds a large
node; a pair of divided nodes is joined only if their shared patterns differ in at
most ``max_bits`` bits. Inside a node, runs of ``FANOUT`` neighbours form lower nodes with
the mask of the bits they share; a pair of nodes whose shared patterns already
differ in more bits is dropped with all that is below it.

A task never returns all links of a dense group, only links that connect what
it has found (a spanning forest, fewer links than fingerprints). Components
are found on distinct fingerprints by repeated hooking to the smallest label, with
every round written to the shared folder.

Rows: one per input row; null and empty texts have no words and fingerprint
zero, linked like any other. Repeated rows give repeated results. Null ids take
part in links but not in the smallest id (null only if all ids are null). Other columns are ignored. An empty
table gives an empty result. Texts are read whole, a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annuity.llm.common import fresh, stage

BITS = 64
SEED = 42
FANOUT = 8
NODE_ROWS = 16384
DEEPER_BITS = 8
PAIRS_AT_ONCE = 1 << 18
SHINGLES_AT_ONCE = 1 << 16


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words; bytes.split() splits at ASCII white space alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def fingerprint(text: str | None, shingle: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; no words: 0."""
    words = words_of(text)
    if not words:
        return 0
    line, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    starts = [0, *(ends[:len(words) - k] + 1).tolist()]
    stops = ends[k - 1:].tolist()
    counts, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        part = slice(at, at + SHINGLES_AT_ONCE)
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[part], stops[part])], np.uint64)
        counts += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with a column of signed 64-bit fingerprints."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(name, of(F.col(text)))


def gray_rank(bits: np.ndarray) -> np.ndarray:
    """The place of each 64-bit pattern in the reflected Gray sequence."""
    out = bits.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def rotate(bits: np.ndarray, by: int) -> np.ndarray:
    return bits if not by else (bits << np.uint64(by)) | (bits >> np.uint64(BITS - by))


def fields(max_bits: int) -> list[tuple[int, int]]:
    """(start, width) of the max_bits + 1 fields that cover a fingerprint."""
    edges = [BITS * i // (max_bits + 1) for i in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _entries(max_bits: int):
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            f = pdf["fp"].to_numpy(np.int64).view(np.uint64)
            for k, (start, _) in enumerate(fields(max_bits)):
                rank = gray_rank(rotate(f, start))
                yield pd.DataFrame({"field": np.full(len(f), k, np.int32), "gray": rank.view(np.int64)})

    return make


def _prefix(gray: Column, bits: Column | int) -> Column:
    """The first ``bits`` bits of a Gray rank."""
    width = F.lit(bits) if isinstance(bits, int) else bits
    return F.call_function("shiftrightunsigned", gray, F.lit(BITS) - width)


def index_nodes(entries: DataFrame, widths: list[int], node_rows: int) -> DataFrame:
    """(field, depth, prefix) of every node: as deep as needed for ``node_rows`` entries.

    Each level counts only the entries of the nodes that are still too large.
    A node at full depth is one fingerprint, so the levels end.
    """
    width = F.element_at(F.array(*map(F.lit, widths)), F.col("field") + 1)
    rows = entries.withColumn("depth", width)
    done = None
    while True:
        counted = stage(rows.groupBy("field", "depth", _prefix(F.col("gray"), F.col("depth")).alias("prefix"))
                        .agg(F.count(F.lit(1)).alias("n")), "gray-nodes", narrow=True)
        fits = (F.col("n") <= node_rows) | (F.col("depth") >= BITS)
        done = counted.where(fits) if done is None else done.unionByName(counted.where(fits))
        large = counted.where(~fits)
        if large.isEmpty():
            return done
        large = large.select(F.col("field").alias("_f"), F.col("depth").alias("_d"), F.col("prefix").alias("_p"))
        rows = rows.join(large, (F.col("field") == F.col("_f")) & (F.col("depth") == F.col("_d"))
                         & (_prefix(F.col("gray"), F.col("depth")) == F.col("_p")), "left_semi")
        rows = rows.withColumn("depth", F.least(F.col("depth") + DEEPER_BITS, F.lit(BITS)))


def node_pairs(nodes: DataFrame, widths: list[int], max_bits: int) -> DataFrame:
    """Pairs of divided nodes under one top node whose shared patterns differ in at most max_bits bits.

    The bits a node's prefix fixes are its mask; accumulated differences over
    the bits that both fix prune the pair. Undivided nodes pair only with
    themselves.
    """
    width = F.element_at(F.array(*map(F.lit, widths)), F.col("field") + 1)
    top = F.call_function("shiftrightunsigned", F.col("prefix"), F.col("depth") - width)
    # The pattern of a rank prefix is its Gray code, which has the same length.
    code = F.col("prefix").bitwiseXOR(F.call_function("shiftrightunsigned", F.col("prefix"), F.lit(1)))
    cut = nodes.where(F.col("depth") > width).select("field", "depth", "prefix", top.alias("top"), code.alias("code"))
    a, b = cut.alias("a"), cut.alias("b")
    both = F.least("a.depth", "b.depth")
    head = lambda s: F.call_function("shiftrightunsigned", F.col(f"{s}.code"), F.col(f"{s}.depth") - both)
    differ = F.bit_count(head("a").bitwiseXOR(head("b")))
    later = (F.col("a.depth") < F.col("b.depth")) | (
        (F.col("a.depth") == F.col("b.depth")) & (F.col("a.prefix") < F.col("b.prefix")))
    return (a.join(b, (F.col("a.field") == F.col("b.field")) & (F.col("a.top") == F.col("b.top")) & later
                   & (differ <= max_bits))
            .select(F.col("a.field").alias("field"), F.col("a.depth").alias("da"), F.col("a.prefix").alias("pa"),
                    F.col("b.depth").alias("db"), F.col("b.prefix").alias("pb")))


class _Forest:
    """Smallest-label components of rows 0..n-1, fed with links in chunks."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while len(i):
            a, b = label[i], label[j]
            new = a != b
            if not new.any():
                return
            i, j, a, b = i[new], j[new], a[new], b[new]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def _levels(node: np.ndarray, bits: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """From the leaves up: (node, mask, pattern, first child, end child) of runs of FANOUT neighbours."""
    full = np.full(len(bits), ~np.uint64(0))
    levels = [(node, full, bits, np.arange(len(bits)), np.arange(len(bits)) + 1)]
    while True:
        node, mask, pattern = levels[-1][:3]
        new = np.r_[True, node[1:] != node[:-1]]
        first = np.flatnonzero(new)
        place = np.arange(len(node)) - np.repeat(first, np.diff(np.r_[first, len(node)]))
        start = np.flatnonzero(place % FANOUT == 0)
        if len(start) == len(node):
            return levels
        ones = np.bitwise_and.reduceat(pattern & mask, start)
        zeros = np.bitwise_and.reduceat(~pattern & mask, start)
        levels.append((node[start], ones | zeros, ones, start, np.r_[start[1:], len(node)]))


def _expand(a: np.ndarray, b: np.ndarray, level) -> tuple[np.ndarray, np.ndarray]:
    """All child pairs of the node pairs (a, b)."""
    first, end = level[3], level[4]
    na, nb = end[a] - first[a], end[b] - first[b]
    n = na * nb
    pair = np.repeat(np.arange(len(a)), n)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
    return first[a][pair] + k // nb[pair], first[b][pair] + k % nb[pair]


def linked(node: np.ndarray, bits: np.ndarray, max_bits: int, side: np.ndarray | None = None) -> np.ndarray:
    """Component labels (row numbers) among rows of equal ``node`` that lie next to each other in Gray order.

    With ``side`` only links between side 0 and side 1 are looked for.
    """
    forest = _Forest(len(bits))
    if not len(bits):
        return forest.label
    key = node if side is None else node * 2 + side
    levels = _levels(key, bits)
    top = levels[-1][0]
    if side is None:
        a = b = np.arange(len(top))
    else:  # the one run of side 0 with the one run of side 1 of the same node
        a, b = np.flatnonzero(top % 2 == 0), np.flatnonzero(top % 2 == 1)
        a, hit = a[np.isin(top[a], top[b] - 1)], np.isin(top[b] - 1, top[a])
        b = b[hit]
    stack = [(len(levels) - 1, a, b)]
    while stack:
        at, a, b = stack.pop()
        if len(a) > 1 and len(a) * FANOUT * FANOUT > PAIRS_AT_ONCE:
            half = len(a) // 2
            stack += [(at, a[:half], b[:half]), (at, a[half:], b[half:])]
            continue
        if at == 0:
            forest.add(a, b)
            continue
        x, y = _expand(a, b, levels[at])
        mask, pattern = levels[at - 1][1:3]
        near = np.bitwise_count((pattern[x] ^ pattern[y]) & mask[x] & mask[y]) <= max_bits
        if side is None:
            near &= (x <= y) if at > 1 else (x < y)
        stack.append((at - 1, x[near], y[near]))
    return forest.label


def _links_in_node(max_bits: int, pairwise: bool):
    """Links of each node (or pair of nodes) of a partition sorted by node; one node in memory at a time."""
    starts = [s for s, _ in fields(max_bits)]

    def found(pdf: pd.DataFrame) -> pd.DataFrame:
        gray = pdf["gray"].to_numpy(np.int64).view(np.uint64)
        bits = gray ^ (gray >> np.uint64(1))
        node = (np.cumsum(np.r_[0, (pdf["key"].to_numpy()[1:] != pdf["key"].to_numpy()[:-1])]))
        side = pdf["side"].to_numpy(np.int64) if pairwise else None
        label = linked(node, bits, max_bits, side)
        back = np.array([(BITS - s) % BITS for s in starts], np.uint64)[pdf["field"].to_numpy()]
        f = np.where(back > 0, (bits << back) | (bits >> ((np.uint64(BITS) - back) % np.uint64(BITS))), bits).view(np.int64)
        other = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"a": f[label[other]], "b": f[other]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            key = rest["key"].to_numpy()
            if not len(key):
                continue
            earlier = np.flatnonzero(key != key[-1])
            cut = earlier[-1] + 1 if len(earlier) else 0
            if cut:
                yield found(rest.iloc[:cut])
                rest = rest.iloc[cut:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield found(rest)

    return run


def links(distinct: DataFrame, max_bits: int = 3, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (a, b) that connect every two of the distinct fingerprints ``fp`` that differ in at most max_bits bits.

    The links are a spanning forest per node, so there are at most as many as
    index entries, however dense a group is; every returned link is reached by true links.
    """
    widths = [w for _, w in fields(max_bits)]
    entries = distinct.select("fp").mapInPandas(_entries(max_bits), "field int, gray long")
    entries = stage(entries, "gray-entries", narrow=True)
    nodes = index_nodes(entries, widths, node_rows)
    width = F.element_at(F.array(*map(F.lit, widths)), F.col("field") + 1)
    pairs = stage(node_pairs(nodes, widths, max_bits), "gray-node-pairs", narrow=True)
    divided = stage(nodes.where(F.col("depth") > width).select(
        F.col("field").alias("_f"), F.col("depth").alias("_d"), F.col("prefix").alias("_p"),
        F.call_function("shiftrightunsigned", F.col("prefix"), F.col("depth") - width).alias("_t")), "gray-divided", narrow=True)
    top = _prefix(F.col("gray"), width)
    rows = entries.withColumn("top", top)
    plain = F.struct(F.lit(0).alias("d"), F.col("top").alias("p"))
    if divided.isEmpty():
        keyed, across = rows.withColumn("node", plain), None
    else:
        hot = divided.groupBy("_f", "_t").agg(F.collect_set("_d").alias("depths"))
        rows = rows.join(hot, (F.col("field") == F.col("_f")) & (F.col("top") == F.col("_t")), "left").drop("_f", "_t")
        # Try the depths that occur under this top node; exactly one of them is a node.
        tried = F.transform("depths", lambda d: F.struct(d.alias("d"), _prefix(F.col("gray"), d).alias("p")))
        cool = rows.where(F.col("depths").isNull()).select("field", "gray", plain.alias("node"))
        warm = (rows.where(F.col("depths").isNotNull()).select("field", "gray", F.explode(tried).alias("node"))
                .join(divided, (F.col("field") == F.col("_f")) & (F.col("node.d") == F.col("_d"))
                      & (F.col("node.p") == F.col("_p")), "left_semi"))
        warm = stage(warm, "gray-divided-entries", narrow=True)
        keyed = cool.unionByName(warm)
        side = lambda d, p, n: (warm.join(pairs.withColumnRenamed("field", "_f"), (F.col("field") == F.col("_f"))
                                          & (F.col("node.d") == F.col(d)) & (F.col("node.p") == F.col(p)))
                                .select("field", "gray", F.lit(n).alias("side"), _key("_f", "da", "pa", "db", "pb")))
        across = side("da", "pa", 0).unionByName(side("db", "pb", 1))
    keyed = keyed.select("field", "gray", F.lit(0).alias("side"), _key("field", "node.d", "node.p"))
    out = _search(keyed, max_bits, False)
    return out if across is None else out.unionByName(_search(across, max_bits, True))


def _key(*columns: str) -> Column:
    return F.concat_ws(":", *columns).alias("key")


def _search(rows: DataFrame, max_bits: int, pairwise: bool) -> DataFrame:
    # Unsigned order of Gray ranks: flip the sign bit.
    order = F.col("gray").bitwiseXOR(F.lit(-(1 << 63)))
    return (rows.repartition("key").sortWithinPartitions("key", "side", order)
            .mapInPandas(_links_in_node(max_bits, pairwise), "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) for every end of a link: root is the smallest fingerprint reached.

    Alternating stars: each round links every node to the smallest of its
    neighbours (large star, then small star) until nothing changes. A round
    halves long chains, so there are few; each is written to the shared folder.
    """
    def hook(pairs, moves):
        """Each x, and its neighbours y where ``moves``, to the smallest of x and its neighbours."""
        low = pairs.groupBy("x").agg(F.min("y").alias("low")).select(
            F.col("x").alias("_x"), F.least("x", "low").alias("low"))
        moved = pairs.where(moves).join(low, F.col("x") == F.col("_x"))
        return (moved.select(F.col("y").alias("a"), F.col("low").alias("b"))
                .unionByName(low.select(F.col("_x").alias("a"), F.col("low").alias("b")))
                .where(F.col("a") != F.col("b")).distinct())

    edges = stage(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links", narrow=True)
    state = None
    while True:
        down = edges.select(F.col("a").alias("x"), F.col("b").alias("y"))
        up = edges.select(F.col("b").alias("x"), F.col("a").alias("y"))
        # Large star: what is above x moves to the smallest that x touches.
        edges = hook(down.unionByName(up), F.col("y") > F.col("x"))
        # Small star: what is below x moves to the smallest below x.
        down = edges.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y"))
        edges = stage(hook(down, F.lit(True)), "links", narrow=True)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("fp"), "root").distinct())


def _components_of_rows(docs: DataFrame, shingle: int, max_bits: int, text: str, doc_id: str,
                        node_rows: int) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row; root is the component's smallest fingerprint."""
    (name,) = fresh(docs, "fingerprint")
    rows = stage(fingerprints(docs, shingle, text, name).select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
        F.col(name).alias("fp")), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints", narrow=True)
    roots = components(links(distinct, max_bits, node_rows))
    rooted = distinct.join(roots.withColumnRenamed("fp", "_fp"), F.col("fp") == F.col("_fp"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = stage(rooted, "rooted-fingerprints", narrow=True)
    lowest = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("component_id"))
    ids = rooted.join(lowest, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), "root", "component_id")
    return rows.join(ids, F.col("fp") == F.col("_fp")).drop("_fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, text: str = "text",
                    doc_id: str = "doc_id", node_rows: int = NODE_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id is the smallest id reached."""
    return _components_of_rows(docs, shingle, max_bits, text, doc_id, node_rows).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3, text: str = "text",
             doc_id: str = "doc_id", node_rows: int = NODE_ROWS) -> DataFrame:
    """One row of each component, with all columns of ``docs``: the smallest id (null last), then text hash."""
    rows = _components_of_rows(docs, shingle, max_bits, text, doc_id, node_rows)
    key = F.struct(F.col("doc_id").isNull().alias("n"), F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("text_hash").alias("h"))
    kept = (rows.groupBy("root", key.alias("k")).agg(F.count(F.lit(1)).alias("copies"))
            .groupBy("root").agg(F.min(F.struct("k.*", "copies")).alias("k")))
    n, i, h, *wanted = fresh(docs, "id_is_null", "id_or_zero", "text_hash", "kept_null", "kept_id", "kept_hash")
    names = [n, i, h]
    kept = stage(kept.select(*[F.col(f"k.{c}").alias(name) for c, name in zip("nih", wanted)],
                             F.col("k.copies").alias("copies")), "kept-rows", narrow=True)
    keyed = (docs.withColumn(n, F.col(doc_id).isNull()).withColumn(i, F.coalesce(F.col(doc_id), F.lit(0)))
             .withColumn(h, F.xxhash64(F.coalesce(F.col(text), F.lit("")))))
    same = [F.col(a) == F.col(b) for a, b in zip(names, wanted)]
    # Texts are dealt by key once and not sorted.
    single = lambda k: keyed.join(k.drop("copies").hint("shuffle_hash"), same, "left_semi")
    repeated = kept.where(F.col("copies") > 1)
    out = single(kept) if repeated.isEmpty() else single(kept.where(F.col("copies") == 1)).unionByName(
        single(repeated).dropDuplicates(names))
    return out.select(*docs.columns)


def op3(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, 3, 3)
