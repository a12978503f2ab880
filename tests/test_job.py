"""The composed run: outputs, exchange file contract, trailer control totals."""

import datetime as dt
import glob
import os
from decimal import Decimal

from pyspark.sql import functions as F

from annuity.config import RunConfig
from annuity.plans import job
from annuity.plans.pipeline import Pipeline
from annuity.sources.testdata import fixture_tables


def _part_files(path):
    return sorted(glob.glob(f"{path}/part-*"))


def _text(path, encoding="utf-8"):
    """The output as one file: part files concatenated in name order."""
    return "".join(open(f, encoding=encoding).read() for f in _part_files(path))


def test_ordered_parts_concatenate_to_sorted_file(spark, scratch):
    """Without a file count, each range of the global sort is its own part, in order."""
    from annuity.sources import sinks
    lines = spark.range(0, 5000, 1, 7).select(
        F.format_string("%03d%077d", (F.col("id") * 7919) % 1000, F.col("id")).alias("record"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = sinks.write_exchange_file(lines, f"{scratch}/parts")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(_part_files(path)) > 1
    got = _text(path, "iso-8859-1").split("\n")[:-1]
    assert got == sorted(r.record for r in lines.collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for files in (1, 2, 3, 7):
            path = sinks.write_exchange_file(lines, f"{scratch}/files{files}", files=files)
            assert len(_part_files(path)) == files
            assert _text(path, "iso-8859-1").split("\n")[:-1] == got
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ties_are_spread_and_ordered(spark, scratch):
    from annuity.sources import sinks
    rows = spark.range(0, 4000, 1, 5).select(F.lit("x").alias("type"), (F.col("id") * 7919 % 4000).alias("n"))
    path = sinks.write_csv(rows, f"{scratch}/ties", ["type"], files=4)
    parts = [open(f).read().splitlines()[1:] for f in _part_files(path)]
    assert len(parts) == 4 and all(len(p) > 400 for p in parts)
    assert [int(x.split(",")[1]) for p in parts for x in p] == list(range(4000))


def test_a_lost_trailer_fails_the_run(spark, sf_small, scratch, monkeypatch):
    from annuity.operators import exchange
    monkeypatch.setattr(exchange, "TRAILER_REFERENCE", "POA 35/28 TOO LONG")
    cfg = RunConfig(run_date=dt.date(2001, 1, 3), quarterly=True, out_root=scratch)
    assert job.run(spark, fixture_tables(spark, sf_small), cfg).status == "failed"


def test_quarterly_run(spark, sf_small, scratch):
    cfg = RunConfig(run_date=dt.date(2001, 1, 3), quarterly=True, out_root=scratch)
    result = job.run(spark, fixture_tables(spark, sf_small), cfg)
    delivered = {"status_report", "quarterly_totals", "exchange_file"}
    assert set(result.outputs) == {"history", "rejects", *delivered, *(f"{x}_manifest" for x in delivered)}
    assert not result.faults
    for name in delivered:
        stored = spark.read.parquet(result.outputs[f"{name}_manifest"])
        assert stored.count() == len([f for f in _part_files(result.outputs[name]) if os.path.getsize(f)])
    assert len(_part_files(result.outputs["quarterly_totals"])) == 1

    text = _text(result.outputs["exchange_file"], "iso-8859-1")
    lines = text.split("\n")[:-1]
    assert lines[0].startswith("100") and lines[-1].startswith("900")
    assert {len(x) for x in lines} == {80}
    assert lines == sorted(lines)
    assert "_" not in text
    assert result.metrics["exchange_lines"] == len(lines)

    # Trailer totals equal the accepted renewal rows.
    p = Pipeline(fixture_tables(spark, sf_small), cfg)
    accepted = p.renewal_rows.where(F.col("_reason").isNull())
    sums = accepted.agg(F.sum("renewal_fee"), F.sum("total_epo_amount")).collect()[0]
    trailer = lines[-1]
    assert Decimal(trailer[18:31] + "." + trailer[31:33]) == sums[0]
    assert Decimal(trailer[33:46] + "." + trailer[46:48]) == sums[1]
    # So do the lines themselves.
    for total, place in zip(sums, (36, 46)):
        assert total == sum(Decimal(x[place:place + 8] + "." + x[place + 8:place + 10]) for x in lines if x.startswith("200"))
    assert result.metrics["lines_200"] == sum(x.startswith("200") for x in lines)

    # What the period holds is in the file or among the rejects.
    split = p.renewals_split.agg(F.sum("renewal_fee"), F.sum("total_epo_amount")).collect()[0]
    for total, accepted_sum, name in zip(split, sums, ("prescribed", "remitted")):
        assert total == accepted_sum + (result.metrics[f"rejected_{name}"] or 0)
    assert result.status == "rejects"
    rejected = spark.read.parquet(result.outputs["rejects"])
    for t in (200, 400, 500, 600):
        assert result.metrics[f"null_rows_{t}"] == rejected.where(
            (F.col("type") == t) & F.col("reason").startswith("missing ")).agg(F.coalesce(F.sum("payments"), F.lit(0))).first()[0]

    history = spark.read.table(cfg.history_table)
    assert history.count() == result.metrics["renewals"] + result.metrics["restorations"] + \
        result.metrics["lor_cancellations"]
    assert spark.read.parquet(result.outputs["rejects"]).count() == result.metrics["rejects"]
    header = open(_part_files(result.outputs["quarterly_totals"])[0]).read().splitlines()
    assert header[0] == "Month,Amount" and header[-1].startswith("EPO Total")


def test_monthly_run(spark, sf_small, scratch):
    cfg = RunConfig(run_date=dt.date(2001, 1, 3), quarterly=False, out_root=scratch, output_files=1)
    result = job.run(spark, fixture_tables(spark, sf_small), cfg)
    assert {x for x in result.outputs if not x.endswith("_manifest")} == {"history", "monthly_report", "monthly_totals"}
    assert result.status == "ok" and not result.faults
    for key in ["monthly_report", "monthly_totals"]:
        assert len(_part_files(result.outputs[key])) == 1, key
    rows = open(_part_files(result.outputs["monthly_report"])[0]).read().splitlines()
    assert rows[0].startswith("European Patent (UK) Publication Number,Due Date For Payment Of Renewal")
    assert len(rows) - 1 == result.metrics["renewals_in_period"]
    totals = open(_part_files(result.outputs["monthly_totals"])[0]).read().splitlines()
    assert [t.split(",")[0] for t in totals] == [
        "Description", "Grand Total Prescribed UK Fees", "Grand Total to be Remitted to EPO", "Grand Total Retained"]
    assert not os.path.exists(f"{scratch}/epo")
