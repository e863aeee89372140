"""Words that collide under polynomial hashes, and large groups of near copies."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from riskmart.llm import cpsj, debruijn, packing, records, spaced, store, words


@pytest.fixture(autouse=True)
def ready(spark):
    store.workers(spark)


def _pair(bits: int = 12) -> tuple[str, str]:
    """The Thue-Morse word of 2**bits letters and its complement."""
    text = "a"
    for _ in range(bits):
        text += text.translate(str.maketrans("ab", "ba"))
    return text, text.translate(str.maketrans("ab", "ba"))


def test_words_of_the_same_parts_have_different_hashes():
    r = random.Random(1)
    parts = [r.choice("abcdefgh") * 8 for _ in range(3)]
    texts = {*_pair(10), *_pair(12), *_pair(15), "ab", "ba", "abababab" * 9, "babababa" * 9}
    texts |= {"".join(r.choice(parts) for _ in range(6)) for _ in range(500)} | {"a" * n for n in range(1, 200)}
    found = [words.find(pa.array([t]), seed=s).hashes[0] for t in texts for s in (0, 1)]
    assert len(set(found)) == 2 * len(texts)
    joined = words.find(pa.array([" ".join(sorted(texts))])).hashes
    assert [words.find(pa.array([t])).hashes[0] for t in sorted(texts)] == joined.tolist()


def _docs(spark):
    one, two = _pair()
    common = [f"w{i}" for i in range(20)]
    rows = [(1, " ".join([one, *common])), (2, " ".join([two, *common])), (3, " ".join([*common[:10], one, *common[10:]])),
            (4, " ".join([*common[:10], two, *common[10:]])), (5, f"{one} {two}"), (6, two)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_substring_dedup_tells_them_apart(spark):
    rows, docs = _docs(spark)
    found = {r["row"]["doc_id"]: (r["n_removed"], r["kept"]) for r in debruijn.remove(docs, as_hash=True).collect()}
    seen = set()
    for doc, text in rows:
        split, gone = text.split(), set()
        for i in range(len(split) - 12):
            window = tuple(split[i:i + 13])
            if window in seen:
                gone.update(range(i, i + 13))
        seen.update(tuple(split[i:i + 13]) for i in range(len(split) - 12))
        kept = " ".join(w for i, w in enumerate(split) if i not in gone)
        assert found[doc] == (len(gone), hashlib.sha256(kept.encode()).hexdigest())


def test_token_ids_are_those_of_the_library(spark):
    from tokenizers import Tokenizer
    path = packing.bpe.default_path()
    library = Tokenizer.from_file(path)
    texts = [t for _, t in _docs(spark)[0]]
    ids, bounds = packing.bpe.encoder(path).encode(pa.array(texts))
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids


def test_near_dedup_tells_them_apart(spark):
    rows, docs = _docs(spark)
    found = {r["id"]: r["component_id"] for r in cpsj.groups(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6} or _brute(rows) == found


def _brute(rows):
    sets = {}
    for doc, text in rows:
        split = text.split()
        sets[doc] = {tuple(split[i:i + 5]) for i in range(max(len(split) - 4, 1))}
    label = {doc: doc for doc in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if label[b] < label[a] and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                    label[a], changed = label[b], True
    return label


def _near_copies(n: int, seed: int = 2) -> list[tuple]:
    r = random.Random(seed)
    page = [f"w{r.randrange(5000)}" for _ in range(300)]

    def copy(k):
        mine = list(page)
        for _ in range(k):
            mine[r.randrange(300)] = f"z{r.randrange(10**9)}"
        return " ".join(mine)
    rows = [(i, copy(1)) for i in range(n)] + [(10**6 + i, copy(2 + i % 12)) for i in range(60)]
    return rows + [(2 * 10**6 + i, " ".join(f"q{r.randrange(50)}" for _ in range(60))) for i in range(30)]


def test_nodes_of_near_copies_end_as_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(cpsj, "LEAF", 40)
    rows = _near_copies(150)
    found = {r["id"]: r["component_id"] for r in cpsj.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == _brute(rows)


def test_rows_of_a_level_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(cpsj, "LEAF", 100)
    sizes, stage = [], store.stage

    def counted(df, name):
        stored = stage(df, name)
        if name == "nodes":
            sizes.append(stored.count())
        return stored
    monkeypatch.setattr(store, "stage", counted)
    rows = _near_copies(600)
    found = {r["id"]: r["component_id"] for r in cpsj.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(v == 0 for v in found.values()) >= 600
    assert max(sizes) <= cpsj.TREES * len(rows) and len(sizes) <= 3 * cpsj.DEPTH
    assert all(b <= 2 * a for a, b in zip(sizes, sizes[1:]))


@pytest.mark.parametrize("texts", [["a b c d e f g"] * 3, ["a b c d e f g", "a b c d e f h", "x y z u v w"]])
def test_links_of_many_shared_elements(texts, monkeypatch):
    monkeypatch.setattr(cpsj, "_DENSE", 3)
    monkeypatch.setattr(cpsj, "_SLICE", 2)
    a, b = cpsj.links_of(np.zeros(len(texts), np.int64), pa.array(texts))
    expected = _brute(list(enumerate(texts)))
    linked = dict(enumerate(range(len(texts)))) | dict(zip(a.tolist(), b.tolist()))
    assert linked == expected
