"""Registered queries against their SQL, and every operator on awkward tables."""

from __future__ import annotations

import oracle_check
import pytest
from pyspark.sql import functions as F

from riskmart.llm import cpsj, debruijn, langid, packing, quality, quoting, records, spaced, store, templates, toxicity
from riskmart.llm.queries import QUERIES, SQL

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return oracle_check.connect(TINY)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, tables, name):
    rows, problem = oracle_check.compare(spark, tables, QUERIES[name], SQL[name], TINY)
    assert not problem and rows > 0


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14))


def _judged(docs):
    return quality.judge(docs).select("row.doc_id", "kept")


def _written(docs, folder):
    path = packing.bpe.default_path()
    return records.read(docs.sparkSession, folder, records.write(docs, folder, path))


LONG = " ".join(f"w{i % 7919}" for i in range(60_000))
AWKWARD = [(1, None, "en", "h"), (2, "", "en", "h"), (3, " \n\t ", None, None), (4, LONG, "en", "h"), (4, LONG, "en", "h"),
           (5, "one", "de", None), (None, "no identity here at all", None, None), (None, None, None, None),
           (6, "été \U0001F600 naïve " * 12, "fr", ""), (7, "> quoted\nown", "en", "h"),
           (8, " ".join(f"word{i}" for i in range(60)), "en", "h")]
OPERATORS = {
    "op1": lambda d, b, l, f: _judged(d), "op2": lambda d, b, l, f: langid.identify(d),
    "op4": lambda d, b, l, f: toxicity.score(d, l), "op5": lambda d, b, l, f: debruijn.remove(d).select("row.doc_id", "kept"),
    "op6": lambda d, b, l, f: _written(d, f), "op7": lambda d, b, l, f: packing.pack(d),
    "op8": lambda d, b, l, f: cpsj.groups(d), "op9": lambda d, b, l, f: templates.scan(d),
    "op10": lambda d, b, l, f: spaced.overlaps(d, b)}


@pytest.mark.parametrize("name", list(OPERATORS))
@pytest.mark.parametrize("rows", ["awkward", "none"])
def test_awkward_rows(spark, tmp_path, name, rows):
    store.workers(spark)
    docs = spark.createDataFrame(AWKWARD if rows == "awkward" else [], "doc_id long, text string, lang string, source string")
    # Columns that bear names of the operators' own.
    for clash in ("row", "key", "n_words", "id", "node", "marks", "kept", "rank", "length", "toxic", "hash", "h1", "count"):
        docs = docs.withColumn(clash, F.lit("x"))
    bench = spark.createDataFrame([(1, None), (None, "one two three"), (2, "")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (5, None), (4, 0)], "doc_id long, toxic long")
    found = OPERATORS[name](docs, bench, labels, f"file://{tmp_path}/records").collect()
    expected = 0 if rows == "none" or name == "op10" else len(AWKWARD)
    assert len({tuple(r)[:2] for r in found}) > 5 if expected and name == "op7" else len(found) == expected


def test_stages_keep_columns_of_any_name(spark):
    store.workers(spark)
    docs = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string").withColumn(
        "n_chars", F.length("text").cast("long")).withColumn("marks", F.lit(1)).withColumn("a b", F.lit(2))
    bench = spark.createDataFrame([(1, "no identity here at all")], "item_id long, text string")
    for kept in (quality.kept_rows(docs), cpsj.kept_rows(docs), debruijn.kept_rows(docs), spaced.clean(docs, bench)):
        assert kept.columns == docs.columns
        assert 0 < kept.count() <= docs.count()


def test_empty_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string, key string, level int")
    assert quoting.conversations(none).count() == 0
