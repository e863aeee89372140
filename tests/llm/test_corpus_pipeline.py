"""The pipeline's stages, each on its own input, against the SQL or a brute-force form of its operator."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from riskmart.llm import bpe, cpsj, debruijn, packing, quality, store
from test_text_operators import _overlaps

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """(input rows, output rows) of each stage, by name."""
    docs, found = store.table(spark, TINY, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, TINY).write.parquet(path)
        docs = spark.read.parquet(path)
        found[name] = before, docs
    return found


def _sql(docs, sql: str, tmp_path):
    docs.write.parquet(str(tmp_path / "in"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/in/*.parquet'")
    return {r[0]: r for r in connection.execute(f"SELECT doc_id, * FROM ({sql})").fetchall()}


def _by_id(docs):
    return {r["doc_id"]: r for r in docs.collect()}


def test_order_and_columns(steps, spark):
    assert list(steps) == ["quality_rules", "near_dedup", "substring_dedup", "decontaminate", "pack"]
    columns = spark.read.parquet(f"{TINY}/documents.parquet").columns
    assert all(out.columns == columns for name, (_, out) in steps.items() if name != "pack")


def test_quality_rules(steps, tmp_path):
    before, after = steps["quality_rules"]
    judged = _sql(before, quality.SQL, tmp_path)
    assert _by_id(after) == {i: r for i, r in _by_id(before).items() if judged[i][-1]}
    assert 0 < after.count() < before.count()


def test_near_dedup(steps, tmp_path):
    before, after = steps["near_dedup"]
    judged = _sql(before, cpsj.SQL, tmp_path)
    assert _by_id(after) == {i: r for i, r in _by_id(before).items() if judged[i][-1]}
    assert after.count() < before.count()


def test_substring_dedup(steps):
    before, after = (_by_id(x) for x in steps["substring_dedup"])
    first: dict[tuple, int] = {}
    for i in sorted(before):
        ws, gone = before[i]["text"].split(), set()
        for p in range(len(ws) - debruijn.K + 1):
            if first.setdefault(tuple(ws[p:p + debruijn.K]), i) < i:
                gone.update(range(p, p + debruijn.K))
        left = " ".join(w for p, w in enumerate(ws) if p not in gone)
        if not gone:
            assert after[i] == before[i]
        elif left:
            assert after[i]["text"] == left and after[i]["n_chars"] == len(left)
        else:
            assert i not in after


def test_decontaminate(steps, spark):
    before, after = (_by_id(x) for x in steps["decontaminate"])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    touched = {d for d in before for t in [before[d]["text"]] if len(t) < 3000 and _overlaps([(d, t)], items[:40])}
    assert not touched & after.keys()
    assert all(after[i] == before[i] for i in after) and len(before) - len(after) < 0.2 * len(before)


def test_pack(steps):
    before, packed = _by_id(steps["pack"][0]), steps["pack"][1].collect()
    library = bpe.encoder(bpe.default_path()).library
    tokens = {i: len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for i, r in before.items()}
    held: dict[int, int] = {}
    for r in packed:
        held[r["doc_id"]] = held.get(r["doc_id"], 0) + r["length"]
    assert held == tokens
    used = len({r["sequence_id"] for r in packed})
    assert used <= -(-sum(tokens.values()) // packing.SIZE) + 1
    assert max(r["offset"] + r["length"] for r in packed) <= packing.SIZE


def test_run_equals_the_stages(steps, spark):
    packed = corpus_pipeline.run(spark, TINY)
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert np.array_equal(sorted(map(tuple, packed.select(keys).collect())), sorted(map(tuple, steps["pack"][1].select(keys).collect())))
