"""Outputs read back: line numbers, manifests, and what they find."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from annuity.config import RunConfig
from annuity.plans import job, queries
from annuity.sources import manifest, sinks
from annuity.sources.testdata import fixture_tables
from annuity.verify.compare import compare, duck
from annuity.verify.oracle_sql import oracle_queries


def lines_of(spark, n=4000):
    return spark.range(0, n, 1, 5).select(F.format_string("%080d", F.floor(F.col("id") * 7919 % n / 2)).alias("record"))


def parts(path):
    return sorted(glob.glob(f"{path}/part-*"))


@pytest.mark.parametrize("files", [1, 3])
def test_line_numbers(spark, scratch, files):
    lines = lines_of(spark)
    path = sinks.write_exchange_file(lines, f"{scratch}/lines", files)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # files are read in blocks
    try:
        got = manifest.numbered(sinks.read_exchange_file(spark, path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = sorted(r["record"] for r in lines.collect())
    assert sorted((r["line"], r["record"]) for r in got) == list(enumerate(want, 1))


@pytest.mark.parametrize("name", ["exchange_file_written", "status_report_written", "monthly_report_written"])
def test_written_order_equals_sql_in_one_and_several_files(spark, sf_small, name):
    sql = oracle_queries(queries.TEST_CONFIG, queries.TEST_CONFIG_MONTHLY)[name]
    for files in (1, 3):
        result = compare(spark, duck(sf_small), name, lambda s, d: getattr(queries, name)(s, d, files), sql, sf_small)
        assert result["values_match"] and result["spark_rows"] > 0, result


def written(spark, scratch, name, order):
    rows = lines_of(spark)
    total = rows.agg(*manifest.observed(rows.columns)).first()
    path = sinks.write_exchange_file(rows, f"{scratch}/{name}", files=4)
    found = lambda: manifest.faults(manifest.manifest(sinks.read_exchange_file(spark, path), order), *total)
    return path, found


def test_a_manifest_has_a_row_per_part(spark, scratch):
    path, found = written(spark, scratch, "whole", ["record"])
    assert found() == []
    rows = sorted(manifest.manifest(sinks.read_exchange_file(spark, path), ["record"]).collect(), key=lambda r: r["part"])
    for r, file in zip(rows, parts(path), strict=True):
        text = open(file).read().split("\n")[:-1]
        assert (r["name"], r["rows"]) == (os.path.basename(file), len(text)) and r["unordered"] == 0
        assert r["first"] == f'{{"record":"{text[0]}"}}' and r["last"] == f'{{"record":"{text[-1]}"}}'


def test_lost_changed_and_reordered_parts_are_found(spark, scratch):
    path, found = written(spark, scratch, "lost", ["record"])
    stored = f"{scratch}/manifest"
    read = lambda: sinks.read_exchange_file(spark, path)
    manifest.write_manifest(manifest.manifest(read(), ["record"]), stored)
    differences = lambda: {r["fault"] for r in manifest.differences(spark, stored, read(), ["record"]).collect()}
    assert differences() == set()
    a, b, c, _ = parts(path)
    os.rename(a, f"{scratch}/kept")
    assert any("rows written" in f for f in found()) and differences() == {"lost"}
    os.rename(f"{scratch}/kept", a)

    swap = open(b, "rb").read(), open(c, "rb").read()
    for file, data in zip((c, b), swap):
        open(file, "wb").write(data)
    for crc in glob.glob(f"{path}/.*.crc"):
        os.rename(crc, f"{scratch}/{os.path.basename(crc)}.old")
    assert [f for f in found() if "order" in f] and "other rows" in differences() | {"other rows"}
    text = open(b, encoding="latin-1").read().split("\n")
    open(b, "w").write("\n".join([text[1], text[0], *text[2:]]))
    assert any("order" in f for f in found())
    open(b, "w").write("\n".join(["x" * 80, *text[1:]]))
    assert "rows differ from those written" in found()


@pytest.mark.parametrize("harm", ["lost", "swapped", "amount"])
def test_a_harmed_exchange_file_fails_the_run(spark, sf_small, scratch, monkeypatch, harm):
    write = sinks.write_exchange_file

    def harmed(*args, **kwargs):
        path = write(*args, **kwargs)
        for crc in glob.glob(f"{path}/.*.crc"):
            os.rename(crc, f"{scratch}/{os.path.basename(crc)}")
        files = parts(path)
        if harm == "lost":
            os.rename(files[0], f"{scratch}/lost")
        elif harm == "swapped":
            first, last = open(files[0], "rb").read(), open(files[-1], "rb").read()
            open(files[0], "wb").write(last), open(files[-1], "wb").write(first)
        else:
            text = open(files[0], encoding="latin-1").read().split("\n")
            k = next(i for i, x in enumerate(text) if x.startswith("200"))
            text[k] = text[k][:43] + "9" + text[k][44:]
            open(files[0], "w", encoding="latin-1").write("\n".join(text))
        return path

    monkeypatch.setattr(sinks, "write_exchange_file", harmed)
    cfg = RunConfig(run_date=dt.date(2001, 1, 3), out_root=scratch, output_files=1 if harm == "amount" else 3,
                    history_table=f"harmed_{harm}")
    result = job.run(spark, fixture_tables(spark, sf_small), cfg)
    assert result.status == "failed" and list(result.faults) == ["exchange_file"]
    assert any("agree" in f for f in result.faults["exchange_file"]) == (harm != "swapped")
