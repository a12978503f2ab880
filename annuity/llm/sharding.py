"""Shards that each match the source mixture: proportional stratified interleaving.

The rows of each source are shuffled by a seeded hash and ranked; a row's
fractional rank is (rank - 1/2) / rows of its source. Sorted by fractional
rank, every stretch holds the sources in their overall proportions, so the
sorted rows are cut into shards of equal row counts (at most one apart).

Ranks are counted in buckets, never in one window over a source or over the
table: the shuffle hash, and then the fractional rank, is spread evenly, so
equal slices of it hold about as many rows whatever a source's share.
Bucket counts (one row per bucket) give each bucket's first rank. A bucket has
the square root of all rows, at least ``BUCKET_ROWS``, so neither the buckets
nor the table of their counts outgrows a task. Equal rows share a hash, so they
are counted first (with partial sums) and ranked as one row that takes as many ranks; what is repeated
often is dealt out again in parts of ``COPIES_AT_ONCE``.

Rows: one per input row. A null source is a source of its own; a null or empty
text has size 1 and CRC 0. Repeated rows are placed one by one; the order
among fully equal rows is open but makes no difference. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annuity.llm.common import stage

BUCKET_ROWS = 4096
COPIES_AT_ONCE = 4096
SEED = 42
# The shuffle hash: 13 hexadecimal digits of an MD5, below 2^52 and so exact as a double.
HASH_DIGITS = 13


def shuffle_key(seed: int) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                       F.col("text_crc32").cast("string"))
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("long")


def ranked(rows: DataFrame, group: list[str], bucket: str, order: list, name: str, copies: Column | None = None) -> DataFrame:
    """``name``: each row's rank from 0 within its group, by bucket and then ``order``; a row takes ``copies`` ranks (one by default).

    One window per bucket; the ranks at which buckets begin come from the
    bucket counts, one row per (group, bucket).
    """
    copies = F.lit(1) if copies is None else copies
    sizes = rows.groupBy(*group, bucket).agg(F.sum(copies).alias("_n"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(*[F.col(c).alias(f"_{c}") for c in [*group, bucket]],
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    ahead = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_at", F.coalesce(F.sum(copies).over(ahead), F.lit(0)))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*group, bucket]]
    out = local.join(first, same)
    return out.select(*rows.columns, (F.col("_first") + F.col("_at")).alias(name))


def _each(rows: DataFrame) -> DataFrame:
    """A row for every copy, its rank the first one's and its number; a hot row's copies come from many tasks."""
    several = F.col("copies") > COPIES_AT_ONCE
    part = F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {COPIES_AT_ONCE}").cast("int")))
    hot = rows.where(several).withColumn("_part", part).repartition("key", "_part")
    all_parts = rows.where(~several).withColumn("_part", F.lit(0)).unionByName(hot)
    first = F.col("_part").cast("long") * COPIES_AT_ONCE
    copy = F.explode(F.sequence(first, F.least(first + COPIES_AT_ONCE, F.col("copies")) - 1))
    return all_parts.withColumn("_copy", copy).withColumn("rank", F.col("rank") + F.col("_copy")).drop("_part", "_copy", "copies")


def shards(docs: DataFrame, n_shards: int = 8, seed: int = SEED, source: str = "source",
           text: str = "text", doc_id: str = "doc_id", keep_text: bool = False) -> DataFrame:
    """doc_id, source, size, text_crc32, fraction, shard (from 0) and slot (place in the shard); the text if kept."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                       (F.octet_length(content) + 1).cast("long").alias("size"),
                       F.crc32(content.cast("binary")).alias("text_crc32"),
                       *([F.col(text).alias("text"), F.xxhash64(text).alias("_hash")] if keep_text else []))
    same = ["doc_id", "source", "size", "text_crc32", *(["_hash"] if keep_text else [])]
    # Equal rows, copies and all, are one row from here on; texts by their hash, of which the first one is kept.
    rows = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("copies"), *([F.first("text").alias("text")] if keep_text else [])).drop("_hash")
    rows = stage(rows.withColumn("key", shuffle_key(seed)), "shard-rows")
    total = rows.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    bucket_rows = max(BUCKET_ROWS, math.isqrt(total))

    per_source = rows.groupBy(F.col("source").alias("_source")).agg(F.sum("copies").alias("of"))
    spread = F.col("key") / F.lit(float(16 ** HASH_DIGITS))
    rows = (rows.join(per_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("slice", F.floor(spread * F.ceil(F.col("of") / bucket_rows))))
    ties = ["key", "doc_id", "text_crc32", "size"]
    rows = _each(ranked(rows, ["source"], "slice", ties, "rank", F.col("copies")))
    # (rank + 1/2) / n, over whole numbers
    rows = rows.withColumn("fraction", (2 * F.col("rank") + 1) / (2 * F.col("of")))
    rows = rows.withColumn("part", F.floor(F.col("fraction") * (total // bucket_rows + 1)))
    rows = ranked(rows.drop("slice"), [], "part", ["fraction", "source", *ties], "place")
    shard = F.expr(f"place * {n_shards} div {max(total, 1)}")
    begin = F.expr(f"(shard * {total} + {n_shards - 1}) div {n_shards}")
    return (rows.withColumn("shard", shard.cast("int"))
            .select("doc_id", "source", "size", "text_crc32", "fraction", "shard",
                    (F.col("place") - begin).cast("long").alias("slot"), *(["text"] if keep_text else [])))


def write_shards(docs: DataFrame, path: str, n_shards: int = 8, files_per_shard: int = 1, seed: int = SEED) -> str:
    """The documents as Parquet, a folder per shard, in order of the slots within and across its files."""
    rows = shards(docs, n_shards, seed, keep_text=True)
    (rows.repartitionByRange(n_shards * files_per_shard, "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").partitionBy("shard").parquet(path))
    return path


def op2(docs: DataFrame) -> DataFrame:
    return shards(docs, 8).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                  F.lit(None).cast("int").alias("grown_shard"))


def op2_sql() -> str:
    """The same rows by DuckDB, with plain windows; the CRC is folded over the text's bytes."""
    table = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ 0xEDB88320 if n & 1 else n >> 1
        table.append(n)
    return f"""
with raw as (select doc_id, source, coalesce(text, '') as t from documents),
crc as (select doc_id, source, t, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::bigint) as bytes from raw),
d as (select doc_id, source, (octet_length(encode(t)) + 1)::bigint as size,
             xor(list_reduce(bytes, lambda acc, b: xor(acc >> 8, ({table})[(xor(acc, b) & 255) + 1]), 4294967295::bigint), 4294967295) as text_crc32
      from crc),
k as (select *, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::varchar, '') || ':' || text_crc32::varchar), 1, {HASH_DIGITS}))::bigint as key from d),
r as (select *, row_number() over (partition by source order by key, doc_id, text_crc32, size) - 1 as rank,
             count(*) over (partition by source) as n, count(*) over () as total from k),
f as (select *, (2 * rank + 1)::double / (2 * n) as fraction from r),
p as (select *, row_number() over (order by fraction, source nulls first, key, doc_id, text_crc32, size) - 1 as place from f),
s as (select *, place * 8 // total as shard from p)
select doc_id, size, text_crc32, 'rows' as law, shard::int as shard,
       (place - (shard * total + 7) // 8)::bigint as slot, null::int as grown_shard from s"""
