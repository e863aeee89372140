from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskmart.operators import firsts
from riskmart.sources import landing, quoted
from riskmart.spec import NA_TOKENS


def write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def test_texts_names_and_lineage(spark, tmp_path):
    path = write(tmp_path, "in.csv", 'Txn_ID,Cust_AGE,Note\nT1,007,"a ""b"", c"\nT2,,x\nT3,NA,None\nT4\n')
    rows = landing.land_csv(spark, path, "2024-02-01T00:00:00").orderBy("_load_seq").collect()
    assert [(r.txn_id, r.cust_age, r.note) for r in rows] == [
        ("T1", "007", 'a "b", c'), ("T2", "", "x"), ("T3", "", ""), ("T4", "", "")]
    assert {(r._loaded_at, r._source_file) for r in rows} == {("2024-02-01T00:00:00", "in.csv")}


def test_every_missing_token_is_blanked(spark):
    tokens = [*NA_TOKENS, "", None, "na", " NA"]
    source = spark.createDataFrame([(t,) for t in tokens], "Device_IP_Country string")
    found = [r.device_ip_country for r in landing.land(source, "now", "f").collect()]
    assert len(NA_TOKENS) == 18 and found == [""] * 20 + ["na", " NA"]


def test_load_order_is_file_order_over_many_splits(spark, tmp_path):
    path = write(tmp_path, "in.csv", "Txn_ID,N\n" + "".join(f"T{i % 7},{i}\n" for i in range(5000)))
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        landed = landing.land_csv(spark, path, "now")
        assert landed.rdd.getNumPartitions() > 5
        stored = str(tmp_path / "stored")
        landed.write.parquet(stored)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    rows = spark.read.parquet(stored)
    assert [int(r.n) for r in rows.orderBy("_load_seq").collect()] == list(range(5000))
    for plan in (firsts.first_rows, firsts.by_window):
        assert sorted(int(r.n) for r in plan(rows, ["txn_id"], [F.col("_load_seq")]).collect()) == list(range(7))


def test_files_with_another_header_are_refused(spark, tmp_path):
    write(tmp_path, "a.csv", "Txn_ID,N\nT1,1\n")
    write(tmp_path, "b.csv", "N,Txn_ID\n1,T1\n")
    with pytest.raises(Exception, match="(?i)header"):
        landing.land_csv(spark, str(tmp_path), "now").collect()


def test_line_break_inside_quotes(spark, tmp_path):
    path = write(tmp_path, "in.csv", 'Txn_ID,Note\nT1,"two\nlines"\n')
    assert [r.note for r in landing.land_csv(spark, path, "now", multi_line=True).collect()] == ["two\nlines"]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_equal_the_reader_of_whole_files(spark, tmp_path, seed, end):
    r = random.Random(seed)
    bits = ["a", "b c", ",", '""', end, end + end, "\u00e9", "x" * 30, ", ", " "]

    def value():
        if r.random() < 0.4:
            return r.choice(["plain", "", "7", 'in"side', "two words", " lead"])
        return '"' + "".join(r.choice(bits) for _ in range(r.randrange(12))) + '"'
    text = end.join(["Txn_ID,Note,Other", *(f"T{i},{value()},{value()}" for i in range(600))]) + end
    (tmp_path / "in").mkdir()
    for name in ("a.csv", "b.csv"):
        (tmp_path / "in" / name).write_bytes(text.encode())
    (tmp_path / "in" / "long.csv").write_bytes(f'Txn_ID,Note,Other{end}L,"{("line," + end) * 3000}",z{end}M,n,o'.encode())
    path = str(tmp_path / "in")
    whole = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(path).na.fill("")
    settings = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "0"}
    saved = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert len(quoted.begun_inside(spark, path)) >= 5
        found = landing.land_csv(spark, path, "now", multi_line=True).select("txn_id", "note", "other", "_source_file", "_load_seq").collect()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    blank = lambda x: "" if x in NA_TOKENS else x
    assert Counter((r.txn_id, r.note, r.other) for r in found) == Counter(tuple(map(blank, r)) for r in whole.collect())
    for name in ("a.csv", "b.csv"):
        ordered = [r.txn_id for r in sorted((r for r in found if r._source_file == name), key=lambda r: r._load_seq)]
        assert ordered == [f"T{i}" for i in range(600)]


def test_quoted_files_are_read_by_several_tasks(spark, tmp_path):
    path = write(tmp_path, "in.csv", "Txn_ID,Note\n" + 'T,"two\nlines"\n' * 3000)
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        parts = quoted.records(spark, path)
        assert parts.select(F.spark_partition_id()).distinct().count() > 5 and parts.count() == 3001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)


def test_quoted_files_with_another_header_or_more_fields_are_refused(spark, tmp_path):
    write(tmp_path, "a.csv", "Txn_ID,N\nT1,1\n")
    write(tmp_path, "b.csv", "N,Txn_ID\n1,T1\n")
    with pytest.raises(Exception, match="header differs"):
        landing.land_csv(spark, str(tmp_path), "now", multi_line=True).collect()
    path = write(tmp_path, "c.csv", 'Txn_ID,N\nT1,"a\nb",3\n')
    with pytest.raises(Exception, match="more fields"):
        landing.land_csv(spark, path, "now", multi_line=True).collect()


def test_counts_and_unique_keys(spark):
    assert landing.check_count(3, 3, "t") == 3
    with pytest.raises(landing.CountMismatch, match="2 rows stored, 3 rows read"):
        landing.check_count(3, 2, "t")
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, n int")
    landing.require_unique(landing.repeated_keys(rows, ["k", "n"]), "t")
    with pytest.raises(ValueError, match="1 repeated keys, first 2 rows for"):
        landing.require_unique(landing.repeated_keys(rows, ["k"]), "t")
    check = landing.row_count_check(rows, rows.where("n = 1")).first()
    assert (check.source_rows, check.stored_rows, check.status) == (3, 2, "FAIL")


@pytest.mark.parametrize("multi_line", [False, True])
@pytest.mark.parametrize("line", ["T2,2,EXTRA", "T2,,EXTRA", "T2,2,", 'T2,"a",b,c'])
def test_surplus_fields_are_refused_with_their_line(spark, tmp_path, line, multi_line):
    path = write(tmp_path, "in.csv", f"Txn_ID,N\nT1,1\n{line}\n")
    with pytest.raises(Exception, match="more fields than the header has: " + line.split('"')[0]):
        landing.land_csv(spark, path, "now", multi_line).collect()


def test_short_and_empty_fields_are_kept(spark, tmp_path):
    path = write(tmp_path, "in.csv", 'A,B,C\n1\n1,2\n,,\n"",x,""\n')
    rows = landing.land_csv(spark, path, "now").orderBy("_load_seq").collect()
    assert [(r.a, r.b, r.c) for r in rows] == [("1", "", ""), ("1", "2", ""), ("", "", ""), ("", "x", "")]
