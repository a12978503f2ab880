"""Output sinks: ordered CSV reports, fixed-width exchange file, staged tables (the history table: ``history``)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annuity.config import RunConfig

# Output folder and file names under the run's output root.
REPORT_DIR = "ipo"
EXCHANGE_DIR = "epo"
MONTHLY_REPORT = "ipomonthlyreport.csv"
MONTHLY_TOTALS = "ipomonthlytotals.csv"
QUARTERLY_REPORT = "ipoqrtrlyreport.csv"
QUARTERLY_TOTALS = "ipoqrtrlytotals.csv"
EXCHANGE_ENCODING = "ISO-8859-1"


def report_path(cfg: RunConfig, name: str) -> str:
    return f"{cfg.out_root.rstrip('/')}/{REPORT_DIR}/{cfg.run_stamp}/{name}"


def exchange_path(cfg: RunConfig) -> str:
    return f"{cfg.out_root.rstrip('/')}/{EXCHANGE_DIR}/{cfg.run_stamp}/epoqrtrly{cfg.run_stamp}.txt"


def history_path(cfg: RunConfig) -> str:
    return f"{cfg.out_root.rstrip('/')}/history/renewal_history"


def shared_folder(spark: SparkSession) -> str:
    """Where stages are written: the folder in ``spark.checkpoint.dir``, as a setting or on the context; under
    the warehouse only where neither is set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages").rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: what follows starts from files."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Fewer rows are not worth a second write; every join of them is cheap either way.
BUCKET_ROWS = 2_000_000
# A bucket may hold this many times the rows of an even one, and a key so many rows, before a table counts as skewed.
UNEVEN, HOT_ROWS = 4, 100_000


def stage_buckets(df: DataFrame, name: str, key: str, buckets: int) -> tuple[DataFrame, bool]:
    """``stage``, in buckets sorted by ``key`` unless the table is small or one key holds too many rows; whether it is.

    Joins, aggregates and windows on the key need no exchange afterwards. The table's
    catalog entry is dropped at once: the plan holds the files and their buckets.
    """
    spark = df.sparkSession
    plain = stage(df, name)
    rows = plain.count()
    if rows < BUCKET_ROWS:
        return plain, False
    hottest = plain.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    if hottest > max(HOT_ROWS, UNEVEN * rows / buckets):
        return plain, False
    table = f"{name}_{uuid.uuid4().hex}"
    (plain.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", f"{shared_folder(spark)}/{table}").saveAsTable(table))
    stored = spark.table(table)
    spark.sql(f"drop table {table}")
    return stored, True


def _sorted_output(df: DataFrame, order_by: list[str], files: int | None,
                   observe: tuple | None = None, small: bool = False) -> DataFrame:
    """Rows in global order, one contiguous range per file; part files follow the order by name.

    Rows are ordered by ``order_by`` and then by all other columns, so rows that tie on
    ``order_by`` neither sit in one task nor come out in varying order. ``files`` sets the
    number of ranges; ``files=1``, and ``small`` for a table whose size is
    bounded by construction, sort in one task. ``observe`` = (Observation,
    *metrics) is attached above the sort: the job that samples the range
    bounds runs the plan below it, and metrics observed there would be
    counted twice.
    """
    order = [*order_by, *[c for c in df.columns if c not in order_by]]
    if files == 1 or small:
        # Small tables are ordered by the given columns alone; without any they keep their order.
        out = df.repartition(1)
        keys = order_by if small else order
        out = out.sortWithinPartitions(*keys) if keys else out
    elif files:
        out = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    else:
        out = df.orderBy(*order)
    return out.observe(*observe) if observe else out


def write_csv(df: DataFrame, path: str, order_by: list[str], columns: list[str] | None = None,
              files: int | None = None, observe: tuple | None = None, small: bool = False) -> str:
    """A CSV report with a header line, rows in ``order_by`` order, then ``columns`` kept.

    With several files each part carries the header, so the folder reads back
    as one CSV dataset (``header=True``).
    """
    out = _sorted_output(df, order_by, files, observe, small)
    if columns:
        out = out.select(*columns)
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_exchange_file(lines: DataFrame, path: str, files: int | None = None,
                        observe: tuple | None = None) -> str:
    """The exchange file: one fixed-width record per line, sorted, Latin-1.

    The header record sorts first and the trailer last, so the part files
    concatenated by name are the file. The text writer ignores an encoding
    option, so the CSV writer is used with quoting and whitespace trimming
    turned off; records hold no delimiter.
    """
    (_sorted_output(lines, ["record"], files, observe).select("record")
     .write.mode("overwrite")
     .option("header", False)
     .option("encoding", EXCHANGE_ENCODING)
     .option("quote", "")
     .option("escape", "")
     .option("sep", "\t")
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path


def read_exchange_file(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a written exchange file: (record)."""
    return spark.read.option("encoding", EXCHANGE_ENCODING).text(path).withColumnRenamed("value", "record")


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """A CSV report with the columns and types it was written from."""
    return spark.read.option("header", True).schema(schema).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    df.write.mode("overwrite").format(fmt).save(path)
    return path
