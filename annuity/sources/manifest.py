"""Outputs read back: line numbers, a manifest of parts, and what is wrong with an output.

Spark writes an ordered output as part files, whose order by part number is
the order of the lines. A row's place is its part, the block of that part (a large
file is read in blocks) and its place in the block; only small sums per block
are put in one sequence.

A manifest has one row per part: name, rows, first and last value of the order,
checksum. It is taken from the files as written and compared with the rows and the checksum
that the writing job observed, so a part that is lost, changed or out of order is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

PLACE = ["_part", "_file", "_block"]


def _placed(read: DataFrame) -> DataFrame:
    """Rows of a file source with part number, file, block and a rising number within the block."""
    name = F.col("_metadata.file_name")
    return read.select("*", F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long").alias("_part"), name.alias("_file"),
                       F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))


def numbered(read: DataFrame, line: str = "line") -> DataFrame:
    """``read`` (a file source) with its line numbers from 1, in the order of its parts.

    Numbers within a block are a window over that block; the lines before it are a
    running sum over one row per block.
    """
    rows = _placed(read).withColumn("_in_block", F.row_number().over(Window.partitionBy(*PLACE).orderBy("_id")))
    sizes = _placed(read).groupBy(*PLACE).agg(F.count(F.lit(1)).alias("_rows"))
    before = sizes.select(*PLACE, (F.sum("_rows").over(Window.orderBy(*PLACE)) - F.col("_rows")).alias("_before"))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_b")) for c in PLACE]
    before = before.withColumnsRenamed({c: f"{c}_b" for c in PLACE})
    on = same[0] & same[1] & same[2]
    return rows.join(before, on).select((F.col("_before") + F.col("_in_block")).alias(line), *read.columns)


def checksum(columns: list[str]) -> Column:
    """Sum of row hashes: the same in any order of rows. Nulls count by their place."""
    row = F.xxhash64(*columns, F.array(*[F.col(c).isNull() for c in columns]))
    return F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")


def observed(columns: list[str]) -> list[Column]:
    """What the writing job notes about the rows it writes."""
    return [F.count(F.lit(1)).alias("rows"), checksum(columns).alias("checksum")]


def manifest(read: DataFrame, order: list[str]) -> DataFrame:
    """(part, name, rows, first, last, checksum, unordered) of every part of ``read`` (a file source).

    ``unordered`` counts places where a row is lower than the one before it, within and between
    parts, by all columns, those of ``order`` first; it is 0 without an order.
    """
    columns = read.columns
    key = F.struct(*[F.col(c) for c in [*order, *[c for c in columns if c not in order]]])
    rows = _placed(read).withColumn("_key", key)
    last = F.lag("_key").over(Window.partitionBy(*PLACE).orderBy("_id"))
    blocks = rows.withColumn("_low", F.coalesce(last > F.col("_key"), F.lit(False))).groupBy(*PLACE).agg(
        F.count(F.lit(1)).alias("rows"), F.min_by("_key", "_id").alias("first"), F.max_by("_key", "_id").alias("last"),
        checksum(columns).alias("checksum"), F.count_if("_low").alias("unordered"))
    turn = Window.orderBy(*PLACE)
    # One row per block from here on.
    between = F.when(F.lag("last").over(turn) > F.col("first"), 1).otherwise(0)
    blocks = blocks.withColumn("unordered", (F.col("unordered") + between) * (1 if order else 0))
    text = lambda c: F.to_json(c)
    return blocks.groupBy(F.col("_part").alias("part"), F.col("_file").alias("name")).agg(
        F.sum("rows").alias("rows"), text(F.min_by("first", "_block")).alias("first"), text(F.max_by("last", "_block")).alias("last"),
        F.sum("checksum").cast("decimal(38,0)").alias("checksum"), F.sum("unordered").alias("unordered"))


def faults(parts: DataFrame, rows: int, total: object) -> list[str]:
    """What is wrong with an output, by its manifest and what its writing job observed; empty if nothing is."""
    found = parts.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("checksum"), F.lit(0)).cast("decimal(38,0)"),
                      F.coalesce(F.sum("unordered"), F.lit(0))).first()
    out = []
    if found[0] != rows:
        out.append(f"{rows} rows written, {found[0]} found")
    if found[1] != total:
        out.append("rows differ from those written")
    if found[2]:
        out.append(f"out of order in {found[2]} places")
    return out


def write_manifest(parts: DataFrame, path: str) -> DataFrame:
    """Store a manifest (one row per part) and return it as stored."""
    parts.write.mode("overwrite").parquet(path)
    return parts.sparkSession.read.schema(parts.schema).parquet(path)


def differences(spark: SparkSession, path: str, read: DataFrame, order: list[str]) -> DataFrame:
    """(part, name, fault) where an output no longer is what its stored manifest says.

    For the receiving side, or before an old output is used again.
    """
    then = spark.read.parquet(path).alias("a")
    now = manifest(read, order).alias("b")
    both = then.join(now, F.col("a.name") == F.col("b.name"), "full_outer")
    fault = (F.when(F.col("b.name").isNull(), "lost").when(F.col("a.name").isNull(), "not in the manifest")
             .when(F.col("a.rows") != F.col("b.rows"), "other number of rows")
             .when(F.col("a.checksum") != F.col("b.checksum"), "other rows")
             .when((F.col("a.first") != F.col("b.first")) | (F.col("a.last") != F.col("b.last")), "other order"))
    return both.select(F.coalesce("a.part", "b.part").alias("part"), F.coalesce("a.name", "b.name").alias("name"),
                       fault.alias("fault")).where(F.col("fault").isNotNull())
