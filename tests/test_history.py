"""The history as snapshots: complete versions only, and only changed partitions written."""

import glob

import pytest
from pyspark.sql import functions as F

from annuity.config import RunConfig
from annuity.schemas import PROCESSED_YEAR
from annuity.sources import history
from tests.helpers import D, money

SCHEMA = ("application_num string, renewal_year int, renewal_fee decimal(12,2), date_processed date, source string, "
          "type_identifier string")
ROWS = [("EP1", 5, money("10.00"), D(2000, 3, 1), "Legacy", "Renewals"), ("EP2", 6, None, D(2000, 4, 1), "Legacy", "Renewals"),
        ("EP2", 6, None, D(2000, 4, 1), "Legacy", "Renewals"), ("EP3", 7, money("5.00"), D(1999, 4, 1), "Dynamics", "Renewals"),
        ("EP4", None, None, D(1999, 4, 1), "Legacy", "Licence of Right"), ("EP5", None, None, None, "Legacy", "Restoration")]


def config(scratch, table):
    return RunConfig(run_date=D(2001, 1, 3), out_root=scratch, history_table=table)


def rows(df):
    return sorted(map(str, (r.asDict() for r in df.drop(PROCESSED_YEAR).collect())))


def partitions(cfg):
    """(run, partition) folders that hold data."""
    found = glob.glob(f"{cfg.out_root}/history/renewal_history/data/run=*/type_identifier=*/processed_year=*/*.parquet")
    return {tuple(f.split("/")[-4:-1]) for f in found}


def test_a_second_run_writes_only_what_changed(spark, scratch):
    cfg = config(scratch, "snap_changed")
    first = history.write_snapshot(spark, spark.createDataFrame(ROWS, SCHEMA), cfg)
    assert (first.version, len(first.changed), first.dropped) == (1, 4, [])
    before = partitions(cfg)

    # The same rows in another order and other partitions: nothing to write.
    again = history.write_snapshot(spark, spark.createDataFrame(ROWS[::-1], SCHEMA).repartition(3), cfg)
    assert (again.version, again.changed) == (2, []) and partitions(cfg) == before

    more = [*ROWS, ("EP9", 5, money("1.00"), D(2000, 12, 31), "Legacy", "Renewals")]
    third = history.write_snapshot(spark, spark.createDataFrame(more, SCHEMA), cfg)
    assert (third.version, third.changed) == (3, [("Renewals", 2000)])
    new = partitions(cfg) - before
    assert {p[1:] for p in new} == {("type_identifier=Renewals", "processed_year=2000")}

    full = config(f"{scratch}/full", "snap_full")
    history.write_snapshot(spark, spark.createDataFrame(more, SCHEMA), full)
    assert rows(spark.table("snap_changed")) == rows(spark.table("snap_full")) == rows(spark.createDataFrame(more, SCHEMA))
    # Older versions stay readable.
    schema = spark.table("snap_changed").schema
    assert rows(history.read_history(spark, cfg, schema, 1)) == rows(spark.createDataFrame(ROWS, SCHEMA))
    assert rows(history.read_history(spark, cfg, schema)) == rows(spark.table("snap_changed"))
    with pytest.raises(ValueError, match="no history version"):
        history.read_history(spark, cfg, schema, 9)


def test_partitions_go_with_their_rows(spark, scratch):
    cfg = config(scratch, "snap_gone")
    history.write_snapshot(spark, spark.createDataFrame(ROWS, SCHEMA), cfg)
    snapshot = history.write_snapshot(spark, spark.createDataFrame(ROWS[:3], SCHEMA), cfg)
    assert snapshot.changed == [] and len(snapshot.dropped) == 3
    assert rows(spark.table("snap_gone")) == rows(spark.createDataFrame(ROWS[:3], SCHEMA))
    empty = history.write_snapshot(spark, spark.createDataFrame([], SCHEMA), cfg)
    assert empty.version == 3 and spark.table("snap_gone").count() == 0


def test_a_broken_run_leaves_the_last_version(spark, scratch, monkeypatch):
    cfg = config(scratch, "snap_broken")
    history.write_snapshot(spark, spark.createDataFrame(ROWS, SCHEMA), cfg)
    want = rows(spark.table("snap_broken"))

    broken = spark.createDataFrame(ROWS, SCHEMA).repartition(4).withColumn("renewal_year", F.when(
        F.col("application_num") == "EP4", F.raise_error(F.lit("lost source")).cast("int")).otherwise(F.col("renewal_year") + 1))
    with pytest.raises(Exception, match="lost source"):
        history.write_snapshot(spark, broken, cfg)
    assert rows(spark.table("snap_broken")) == want

    # Broken after the data of the new version was written, before the version was.
    def stopped(*args, **kwargs):
        raise RuntimeError("driver lost")

    changed = spark.createDataFrame(ROWS, SCHEMA).withColumn("renewal_year", F.lit(1))
    with monkeypatch.context() as m:
        m.setattr(history, "Row", stopped)
        with pytest.raises(RuntimeError, match="driver lost"):
            history.write_snapshot(spark, changed, cfg)
    assert len({p[0] for p in partitions(cfg)}) == 2  # its data lies there
    assert rows(spark.table("snap_broken")) == want
    assert rows(history.read_history(spark, cfg, spark.table("snap_broken").schema)) == want

    done = history.write_snapshot(spark, changed, cfg)
    assert done.version == 2 and rows(spark.table("snap_broken")) == rows(changed)
