"""Suffix dedup, hard negatives and conversation repair against brute force on small fixtures."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.llm import negatives, repair, store, suffixes

CLASHES = ("row", "key", "id", "uid", "doc", "tie", "num", "start", "marks", "kept", "conv", "part", "block", "rank", "n")


@pytest.fixture(autouse=True)
def ready(spark):
    store.workers(spark)


def _clashing(df):
    for name in CLASHES:
        df = df.withColumn(name, F.lit("x"))
    return df


# Suffix-array dedup

@pytest.mark.parametrize("alphabet", [1, 2, 3, 200])
def test_suffix_array_is_sorted_to_the_depth(alphabet):
    r = random.Random(alphabet)
    for size in (1, 2, 7, 60, 700):
        parts = [[r.randrange(1, alphabet + 1) for _ in range(r.randrange(1, size + 1))] + [0] for _ in range(4)]
        text = np.array(sum(parts, []), np.uint8)
        order, raw = suffixes.suffix_array(text), text.tobytes()
        assert sorted(order.tolist()) == list(range(len(text)))
        keys = [raw[i:i + suffixes.WIDTH] for i in order]
        assert keys == sorted(keys)
        common = suffixes.common_prefixes(text, order)
        for a, b, n in zip(keys, keys[1:], common[1:].tolist()):
            # Past the end of the text both have zeros.
            a, b = a.ljust(suffixes.WIDTH, b"\0"), b.ljust(suffixes.WIDTH, b"\0")
            assert a[:n] == b[:n] and (n == suffixes.WIDTH or a[n] != b[n])


def _removed(rows: list[tuple]) -> dict:
    """{(doc_id, text): (n_removed, n_spans, what is left)} by looking at every window; ids differ unless texts are equal."""
    width, seen, found = suffixes.WIDTH, set(), {}
    last = 2**63
    for doc, text in sorted({(d, t or "") for d, t in rows}, key=lambda x: last if x[0] is None else x[0]):
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - width + 1):
            if raw[i:i + width] in seen:
                gone[i:i + width] = b"\1" * width
            seen.add(raw[i:i + width])
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        found[doc, text] = (sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g))
    return found


def _texts(seed: int) -> list[tuple]:
    r = random.Random(seed)
    noise = lambda n: " ".join(r.choice(["été", "wörd", "plain", "x", "\U0001F600", str(r.randrange(999))]) for _ in range(n))
    shared = [noise(60) for _ in range(3)]
    rows = [(i, noise(r.randrange(3)) + r.choice(shared) + noise(r.randrange(40))) for i in range(25)]
    rows += [(30, "ab" * 700), (31, "=" * 900), (32, "x" * 99), (33, "x" * 100), (34, "x" * 101), (35, None), (36, ""),
             (37, rows[0][1]), (37, rows[0][1]), (38, noise(20_000)), (None, shared[0]), (None, None)]
    rows += [(40 + i, f"{shared[1]} {i} {shared[1][:150]}") for i in range(30)]
    return rows


@pytest.mark.parametrize("group", [suffixes.GROUP, 600])
def test_repeated_bytes_go_as_by_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(suffixes, "GROUP", group)  # small groups are cut again, to the last level
    rows = _texts(1)
    expected = _removed(rows)
    docs = _clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    found = suffixes.remove(docs).collect()
    assert Counter((f["row"]["doc_id"], f["row"]["text"]) for f in found) == Counter(rows)
    for f in found:
        assert (f["n_removed"], f["n_spans"], bytes(f["kept"])) == expected[f["row"]["doc_id"], f["row"]["text"] or ""]


def test_third_of_all_rows_without_id_and_under_one_id(spark):
    text = " ".join(map(str, range(100)))
    rows = [(None, text + str(i)) for i in range(100)] + [(7, text + str(i)) for i in range(100)] + [(i, None) for i in range(50)]
    found = suffixes.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # Equal texts: the numbered one stays before the one without id; within an id one text comes first.
    assert len(found) == 250 and sum(f["n_removed"] < 50 for f in found if f["row"]["text"]) == 1
    assert suffixes.remove(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# Hard negatives

def _mined(rows: list[tuple]) -> Counter:
    """(anchor, positive, rank, negative, positive score, negative score) by looking at every pair."""
    usable = {(i, lab, tuple(np.floor(256 * np.array(v, float)).astype(int).tolist())) for i, lab, v in rows
              if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    order = lambda a: lambda b: (-score(a, b), negatives.LAST if b[0] is None else b[0])
    found = Counter()
    for a in (u for u in usable if u[0] is not None and u[0] % 100 == 0):
        others = sorted((u for u in usable if u is not a), key=order(a))
        for p in [u for u in others if u[1] == a[1]][:5]:
            ps = score(a, p)
            inside = [u for u in others if u[1] != a[1] and 30 * ps <= 100 * score(a, u) <= 90 * ps]
            found.update((a[0], p[0], k, u[0], ps, score(a, u)) for k, u in enumerate(inside[:10], 1))
    return found


@pytest.mark.parametrize("block", [negatives.BLOCK, 16])
@pytest.mark.parametrize("kind", ["float", "coarse", "huge"])
def test_negatives_equal_brute_force(spark, monkeypatch, block, kind):
    monkeypatch.setattr(negatives, "BLOCK", block)
    r = np.random.default_rng(3)
    scale = {"float": 1, "coarse": 4, "huge": 3e5}[kind]
    v = r.normal(size=(400, 21)) * scale
    if kind == "coarse":  # many ties
        v = np.round(v / 4) / 2
    rows = [(5 * i, int(r.integers(4)), x.tolist()) for i, x in enumerate(v)]
    rows += [(3, None, [1.0]), (4, 1, None), (6, 1, [1.0, None]), (7, 2, [float("nan")]), (8, 2, [float("inf")] * 21),
             (9, 0, []), (11, 1, [1.5, 2.5]), (12, 3, rows[0][2]), (300, rows[60][1], rows[60][2]), (None, 2, rows[1][2])]
    table = _clashing(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"))
    found = negatives.mine(table).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    expected = _mined(rows)
    assert Counter(tuple(x) for x in found.collect()) == expected and len(expected) > 20


def test_bounds_drop_candidates_before_the_last_column():
    r = np.random.default_rng(4)
    columns = r.integers(-300, 300, size=(64, 2000)) // np.arange(1, 65)[:, None]
    block = negatives.Block(np.arange(2000), np.zeros(2000, np.int64), np.zeros(2000, np.int64), columns)
    sizes = []
    anchor, rows = columns[:, 0], np.arange(2000)

    def keep(left, at_least, at_most):
        sizes.append(len(left))
        return at_most >= np.partition(at_least, -5)[-5]
    left, score = block.scan(anchor, rows, keep)
    assert sizes[0] == 2000 and sizes[-1] < 200
    exact = anchor @ columns
    assert (exact[left] == score).all() and set(np.argsort(-exact, kind="stable")[:5]) <= set(left.tolist())


def test_no_vectors_and_scores_beyond_64_bits(spark):
    schema = "vec_id long, label int, embedding array<double>"
    assert negatives.mine(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        negatives.mine(spark.createDataFrame([(0, 1, [1e15]), (1, 1, [1e15])], schema)).collect()


# Conversation repair

def _hurt(rows: list[tuple]) -> list[tuple]:
    blank = lambda x: " " if x is None else x
    found = []
    for conv, turn, role, text in rows:
        hit = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if hit:
            text = "" if hit == 1 else text.translate(str.maketrans("", "", ".!?")) if hit == 2 else text
            found += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return found


def _repaired(rows: list[tuple]) -> tuple:
    """What the operator returns for the rows of one conversation, by extending all cheapest edits row by row."""
    rows = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        marks = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    follow = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    full = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(4):
            for state, (cost, audit, lines) in list(best.items()):
                for to in follow[state]:
                    if to in full:
                        new = (cost + 3, audit + "I", lines + (f"{full[to]}:",))
                        if to not in best or new < best[to]:
                            best[to] = new
        return best
    # Cheapest edits per state are kept with all that could still be ASCII-least: prefixes of equal cost compare alone.
    best = inserted({"": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        new = {}

        def offer(state, value):
            if state not in new or value < new[state]:
                new[state] = value
        for state, (cost, audit, lines) in best.items():
            offer(state, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 * (fault == "truncated")
            for to in follow[state]:
                if role[:1] == to:
                    offer(to, (cost + extra, audit + "K", lines + (f"{role}:{text}",)))
                if to in full:
                    offer(to, (cost + 3 + extra, audit + "R", lines + (f"{full[to]}:{text}",)))
        best = inserted(new)
    cost, audit, lines = min(best[s] for s in ("", "a") if s in best)
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    count = Counter(faults)
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _conversations(seed: int) -> list[tuple]:
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "u", "sys"]
    texts = ["Yes.", "No", "Why?!", " ", "", None, "half a", "été!", "Done.\n", "Done. "]
    rows = []
    for conv in range(60):
        for turn in range(r.randrange(1, 25)):
            natural = ["user", "assistant"][turn % 2]
            rows.append((conv, turn, natural if r.random() < 0.6 else r.choice(roles), f"{turn}." if r.random() < 0.5 else r.choice(texts)))
    rows += [(100, None, "user", f"{i}?") for i in range(9)] + [(None, i, "user", "Same.") for i in range(8)]
    rows += [(101, 5, "user", "Again.")] * 6 + [(102, -3, "assistant", "x"), (102, 10, "user", "y.")]
    rows += [(103, i, ["user", "assistant"][i % 2], f"{i}.") for i in range(300)]
    return rows


@pytest.mark.parametrize("size", [repair.ROWS, 1, 3])
def test_repair_equals_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(repair, "ROWS", size)
    rows = _conversations(5)
    table = _clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = {x[0]: tuple(x)[1:] for x in repair.repair(table, repair.damaged(table)).collect()}
    groups = defaultdict(list, {conv: [] for conv, *_ in rows})
    for conv, *row in _hurt(rows):
        groups[conv].append(tuple(row))
    assert found == {conv: _repaired(own) for conv, own in groups.items()}


def test_chunks_converge_in_few_passes(spark, monkeypatch):
    monkeypatch.setattr(repair, "ROWS", 10)
    rows = [(1, i, ["user", "assistant"][(i // 7) % 2], f"{i}.") for i in range(500)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chunks = repair.packed(repair.faulted(repair.plain(table)))
    params, passes = repair.stitched(chunks)
    assert params.count() == chunks.count() >= 50 and 1 <= passes <= 5


def test_fix_up_equals_a_new_run():
    for codes in itertools.product(range(9), repeat=3):
        long, out = bytes(codes * 20), repair.backward(bytes(codes * 20), repair.GUESS)[0]
        assert repair.fixed(long, repair.GUESS, out, repair.END) == repair.backward(long, repair.END)[0]


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair(none, repair.damaged(none)).count() == 0
