from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskmart.llm import bpe, packing, records, words

TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=60), st.text(" \n\tabAé'.<|>\x01", max_size=60)), max_size=8)
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    found = words.find(pa.array(texts, pa.string()))
    expected = [SPACED.findall(t or "") for t in texts]
    assert found.counts.tolist() == [len(x) for x in expected]
    assert [found.word(i).decode() for i in range(len(found.starts))] == [w for x in expected for w in x]
    hashes = {}
    for w, h in zip((w for x in expected for w in x), found.hashes.tolist()):
        assert hashes.setdefault(w, h) == h
    assert len(set(hashes.values())) == len(hashes)


@settings(max_examples=50, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_grams_stay_inside_a_text(texts, k):
    found = words.find(pa.array(texts, pa.string()))
    at, hashes = found.grams(k)
    expected = [(t, tuple(x[i:i + k])) for t, x in enumerate(SPACED.findall(y or "") for y in texts)
                for i in range(len(x) - k + 1)]
    assert found.text_of[at].tolist() == [t for t, _ in expected]
    same = {}
    for (_, gram), h in zip(expected, hashes.tolist()):
        assert same.setdefault(gram, h) == h
    assert len(set(same.values())) == len(same)


def test_chunks_are_whole_and_bounded():
    texts = ["a" * 10, None, "b" * (3 * words.CHUNK), "", "c" * 400_000, "d" * 400_000, "e" * 400_000]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(words.chunks([batch, batch.slice(0, 0)]))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    assert all(sum(len(t or "") for t in p.column("text").to_pylist()) <= words.CHUNK or p.num_rows <= 1 or
               max(len(t or "") for t in p.column("text").to_pylist()) > words.CHUNK for p in parts)


@pytest.fixture(scope="module")
def encoder():
    return bpe.encoder(bpe.default_path())


@settings(max_examples=150, deadline=None)
@given(texts=TEXTS)
def test_ids_equal_the_librarys(texts):
    encoder = bpe.encoder(bpe.default_path())
    ids, bounds = encoder.encode(pa.array(texts, pa.string()), 7)
    for t, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == [*encoder.library.encode(t or "", add_special_tokens=False).ids, 7]


def test_special_tokens_and_a_full_cache(encoder, monkeypatch):
    texts = ["a<|endoftext|>b <|startoftext|>", "don't we'LL 12,5 x́   y z", "\x01 \x01\x01 a", "KK ΣΣ"]
    for limit in (bpe.ENTRIES, 3):
        monkeypatch.setattr(bpe, "ENTRIES", limit)
        encoder._clear()
        for _ in range(2):
            ids, bounds = encoder.encode(pa.array(texts))
            for t, a, b in zip(texts, bounds, bounds[1:]):
                assert ids[a:b].tolist() == encoder.library.encode(t, add_special_tokens=False).ids


def _crc(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_crc32c():
    parts = [b"123456789", b"\0" * 4, *(bytes(np.random.default_rng(n).integers(0, 256, n, np.uint8)) for n in (255, 256, 257, 1500))]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    sums = records.crc32c(np.frombuffer(b"".join(parts), np.uint8), bounds).tolist()
    assert sums == [_crc(x) for x in parts] and sums[0] == 0xE3069283


def test_records_round_trip_index_and_damage(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i} " * (i % 5)) for i in range(300, 0, -1)] + [(None, "x")],
                                 "doc_id long, text string")
    folder = f"file://{tmp_path}/r"
    shards = records.write(docs, folder, bpe.default_path())
    rows = sorted(records.read(spark, folder, shards).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, *range(1, 301)]
    library, start = bpe.encoder(bpe.default_path()).library, 0
    texts = {None: "x"} | {i: f"text number {i} " * (i % 5) for i in range(1, 301)}
    for r in rows:
        ids = [*library.encode(texts[r["doc_id"]], add_special_tokens=False).ids, records.END]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    last = max(r["shard"] for r in shards.collect())
    got = records.fetch(folder, last, [300, 299])
    assert got[300].tolist() == [records.END] and len(got[299]) > 4
    file = tmp_path / "r" / f"{last}.records"
    data = bytearray(file.read_bytes())
    data[-6] ^= 1
    with pytest.raises(ValueError):
        records.parse(bytes(data))
    with pytest.raises(ValueError):
        records.parse(bytes(data[:3]) + b"\1" + bytes(data[4:]), check=True)


@pytest.mark.parametrize("counts", [{4096: 5}, {1: 10_000}, {3000: 40, 1096: 40, 7: 3}, {2049: 9, 2047: 4, 2048: 1},
                                    {n: 1 + n % 7 for n in range(1, 4097, 3)}, {}])
def test_plan_holds_every_piece_once(counts):
    plan = packing.plan(counts)
    held: dict[int, int] = {}
    for config, times in plan:
        assert sum(x * k for x, k in config.items()) <= packing.SIZE and times > 0
        for x, k in config.items():
            held[x] = held.get(x, 0) + k * times
    assert held == counts
    bound = -(-sum(x * n for x, n in counts.items()) // packing.SIZE)
    big = sum(n for x, n in counts.items() if x > packing.SIZE // 2)
    assert sum(t for _, t in plan) <= max(bound, big) * 1.02 + 1


def test_knapsack_is_optimal_on_small_cases():
    random = np.random.default_rng(3)
    for _ in range(30):
        lengths = np.unique(random.integers(1, 20, 4))
        values = random.random(len(lengths))
        best = [0.0] * 31
        for room in range(1, 31):
            best[room] = max([best[room - 1], *(best[room - x] + v for x, v in zip(lengths.tolist(), values) if x <= room)])
        found = packing.knapsack(lengths, values, 30)
        worth = dict(zip(lengths.tolist(), values))
        assert sum(x * k for x, k in found.items()) <= 30
        assert abs(sum(worth[x] * k for x, k in found.items()) - best[30]) < 1e-9


def test_packed_pieces_are_the_librarys_ids_and_gapless(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), size=512).collect()
    library = bpe.encoder(bpe.default_path()).library
    cut = {(r["doc_id"], r["piece"]): r for r in packed}
    for r in rows:
        ids = [*library.encode(r["text"], add_special_tokens=False).ids, packing.END]
        for piece, start in enumerate(range(0, len(ids), 512)):
            part = np.array(ids[start:start + 512], "<u4")
            got = cut.pop((r["doc_id"], piece))
            assert (got["start"], got["length"], got["ids_crc32"]) == (start, len(part), zlib.crc32(part.tobytes()))
    assert not cut
    sequences: dict[int, list] = {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 512
    least = max(-(-sum(r["length"] for r in packed) // 512), sum(r["length"] > 256 for r in packed))
    assert len(sequences) <= least * 1.01 + 1


def test_vocabulary_file_is_a_parameter(tmp_path):
    data = json.load(open(bpe.default_path()))
    own = tmp_path / "own.json"
    own.write_text(json.dumps(data))
    ids, _ = bpe.encoder(str(own)).encode(pa.array(["hello there"]))
    assert ids.tolist() == bpe.encoder(bpe.default_path()).encode(pa.array(["hello there"]))[0].tolist()


def test_one_text_with_more_distinct_runs_than_the_table_holds(monkeypatch):
    monkeypatch.setattr(bpe, "ENTRIES", 8)
    monkeypatch.setattr(bpe, "_BITS", 4)
    encoder = bpe.Encoder(bpe.default_path())
    for n in (300, 3, 40):
        text = " ".join(f"word{i * 7}" for i in range(n))
        assert encoder.encode(pa.array([text]))[0].tolist() == encoder.library.encode(text, add_special_tokens=False).ids
