"""Operators against brute force on small fixtures, and the classifiers on the fold that they do not learn from."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskmart.llm import components, cpsj, debruijn, langid, quality, quoting, spaced, store, templates, toxicity, words

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(autouse=True)
def ready(spark):
    store.workers(spark)


def _noise(seed: int, n: int, stock: int = 5000) -> list[str]:
    r = random.Random(seed)
    return [f"w{r.randrange(stock)}" for _ in range(n)]


# Quality rules

def test_host_verdict_needs_evidence_and_spares_clean_documents(spark):
    clean = "these are quite ordinary words that say something new about a subject every single time"
    loud = clean.replace("words", "#### $$$$ words")
    rows = [(i, loud, "bad") for i in range(40)] + [(40, clean, "bad"), (41, loud, "once")]
    rows += [(100 + i, f"{clean} {i}", f"good{i % 7}") for i in range(140)] + [(300, loud, "good1"), (301, "short", "good1")]
    kept = {r["row"]["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(kept[i] for i in range(40)) and kept[40] and kept[41] and kept[300] and not kept[301]
    assert all(kept[100 + i] for i in range(140))


@pytest.mark.parametrize(("mean", "var"), [(None, None), (0.0, 0.0), (1.0, 0.0), (0.3, 0.01), (0.5, 0.25), (0.2, 1e-12)])
def test_prior_is_bounded(mean, var):
    alpha, beta = quality.prior(mean, var)
    assert alpha >= 0 and beta >= 0 and quality.STRENGTH[0] <= alpha + beta + 1e-9 <= quality.STRENGTH[1] + 1


def test_quality_stays_native(spark):
    plan = quality.measure(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Language identification

def test_language_of_unseen_documents(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in store.table(spark, folder, "documents").collect()}
    rows = [r for r in langid.query(spark, folder).collect() if r["held_out"]]
    assert len(rows) > 200
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in rows]) >= 0.98


def test_undetermined_and_unlabelled(spark):
    docs = spark.createDataFrame([(1, None, "en"), (2, "12 ! 34", "en"), (3, "the words of it", "en"), (5, "die Worte", "de")],
                                 "doc_id long, text string, lang string")
    found = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert found[1]["lang_pred"] == found[2]["lang_pred"] == "und" and found[1]["score"] == 0
    assert found[3]["lang_pred"] == "en" and 0 < found[3]["score"] <= 1
    none = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


def test_profiles_are_sets_of_ngrams():
    texts = ["abcab", "", "été", "abcab" * 50, None]
    rows = langid.profiles(pa.array(texts))
    for text, row in zip(texts, rows):
        grams = {(text or "")[i:i + n] for n in langid.N for i in range(len(text or "") - n + 1)}
        assert len(grams) - 3 <= row.sum() <= len(grams)


# Toxicity

def test_gradients_equal_differences():
    net = toxicity.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    found = words.find(pa.array(["one two three", "four two one five " * 9], pa.large_string()), words.ALNUM, words.LOWER)
    vocabulary = toxicity.Vocabulary(found)
    at, _ = toxicity.windows(found.bounds)
    index = np.where(at >= 0, vocabulary.index[at], -1)
    x, trace, slope = net.inputs(vocabulary).astype(np.float64), {}, np.linspace(-1, 1, len(index))
    net.forward(net.gates(x), index, trace)
    grad, d_x = net.backward(x, index, slope, trace)
    for array, slopes in [*((net.p[k], g) for k, g in grad.items()), (x, d_x)]:
        place = tuple(n // 2 for n in array.shape)
        old, values = array[place], []
        for step in (0.01, -0.01):
            array[place] = old + step
            values.append(float((net.forward(net.gates(x), index) * slope).sum()))
        array[place] = old
        assert abs((values[0] - values[1]) / 0.02 - slopes[place]) < 1e-5


def test_all_windows_cover_every_word():
    for n in (0, 1, 23, 24, 25, 36, 37, 100):
        at, _ = toxicity.windows(np.array([0, n]))
        assert set(at[at >= 0].tolist()) == set(range(n))


@pytest.mark.parametrize("step", [1, 7, toxicity.STEP, toxicity.SIZE])
def test_windows_of_any_step_cover_every_word_of_each_text(step):
    bounds = np.cumsum([0, 1, 23, 24, 0, 25, 48, 49, 100, 2400])
    at, text = toxicity.windows(bounds, step)
    for i, (begin, end) in enumerate(zip(bounds, bounds[1:])):
        mine = at[text == i]
        assert set(mine[mine >= 0].tolist()) == set(range(begin, end))


def test_toxic_documents_of_the_unseen_fold(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in store.table(spark, folder, "labels").collect()}
    rows = [r for r in toxicity.query(spark, folder).collect() if r["held_out"] and r["doc_id"] in truth]
    score, toxic = np.array([r["score"] for r in rows]), np.array([truth[r["doc_id"]] for r in rows], bool)
    order = score.argsort().argsort()
    area = (order[toxic].mean() - (toxic.sum() - 1) / 2) / (~toxic).sum()
    assert area >= 0.9
    assert (score[toxic] >= toxicity.THRESHOLD).mean() >= 0.8 and (score[~toxic] >= toxicity.THRESHOLD).mean() <= 0.1


# Substring dedup

def test_hot_passages_and_paths(spark):
    passage, other = _noise(1, 60), _noise(2, 30)
    rows = [(i, " ".join(_noise(100 + i, 20) + passage + (other if i % 3 else []) + _noise(900 + i, 15))) for i in range(60)]
    got = {r["row"]["doc_id"]: r for r in debruijn.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first: dict[tuple, int] = {}
    for i, text in rows:
        ws = text.split()
        gone = set()
        for p in range(len(ws) - 12):
            if first.setdefault(tuple(ws[p:p + 13]), i) < i:
                gone.update(range(p, p + 13))
        assert got[i]["kept"] == " ".join(w for p, w in enumerate(ws) if p not in gone) and got[i]["n_removed"] == len(gone)
    spans = got[59]["spans"]
    assert sum(s["n_words"] for s in spans) >= 60 and all(s["src_doc"] < 59 for s in spans)


def test_colliding_passages_are_found_and_done_again(spark, monkeypatch):
    honest, seeds = debruijn.Windows.__init__, []

    def collide(self, texts, seed):
        honest(self, texts, seed)
        seeds.append(seed)

    answers = iter([3, 0])
    monkeypatch.setattr(debruijn, "unverified", lambda claimed, texts: next(answers))
    rows = [(1, " ".join(_noise(5, 40))), (2, " ".join(_noise(5, 40) + ["end"]))]
    got = debruijn.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert next(answers, None) is None and {r["n_removed"] for r in got} == {0, 40}


def test_a_wrong_source_does_not_verify(spark):
    texts = spark.createDataFrame([(1, "a b c d"), (2, "x b c y")], "doc long, text string")
    right, wrong = debruijn._digest(b"b c"), debruijn._digest(b"b d")
    claims = spark.createDataFrame([(1, 1, 2, right), (2, 1, 2, right), (2, 1, 2, wrong), (1, 3, 2, right)],
                                   "src_doc long, src_start long, n_words long, digest binary")
    assert debruijn.unverified(claims, texts) == 2


# Near duplicates

def _near_copies(n: int, most: int) -> list[tuple[int, str]]:
    base, r = _noise(7, 120), random.Random(11)
    rows = []
    for i in range(n):
        ws = list(base)
        for _ in range(r.randrange(most)):
            ws[r.randrange(len(ws))] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(ws)))
    return rows + [(n + i, " ".join(_noise(50 + i, 80))) for i in range(20)]


def _components(rows: list[tuple[int, str]]) -> dict[int, int]:
    sets = {}
    for i, text in rows:
        ws = text.split()
        sets[i] = {tuple(ws[p:p + 5]) for p in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())
    label = {i: i for i in sets}
    links = [(i, j) for i in sets for j in sets if j < i and sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    for _ in sets:
        before = dict(label)
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    return label


@pytest.mark.parametrize("leaf", [2048, 24])
def test_near_copies_small_and_large_nodes(spark, monkeypatch, leaf):
    """With the small leaf, nodes branch and at the greatest depth are compared block by block."""
    monkeypatch.setattr(cpsj, "LEAF", leaf)
    monkeypatch.setattr(cpsj, "DEPTH", 12 if leaf > 100 else 2)
    rows = _near_copies(90, 9)
    got = {r["id"]: r["component_id"] for r in cpsj.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _components(rows)


def test_rows_without_or_with_one_doc_id_are_documents_of_their_own(spark):
    a, b, c, d, e = (_noise(i, 120) for i in range(20, 25))
    near = [[*ws[:60], "other", *ws[61:]] for ws in (a, b, c, d, e)]
    # Of texts without doc_id, two are linked with two documents, two with each other, one with none.
    rows = [(5, a), (900, b), (None, near[0]), (None, near[1]), (None, c), (None, near[2]), (None, _noise(30, 120)),
            (7, d), (8, near[3]), (7, e), (9, near[4]), (None, _noise(31, 120)), (None, _noise(31, 120))]
    docs = spark.createDataFrame([(i, " ".join(ws)) for i, ws in rows], "doc_id long, text string")
    left = sorted((r["doc_id"] or 0, r["text"]) for r in cpsj.kept_rows(docs).collect())
    whole = {(i or 0, " ".join(ws)) for i, ws in rows}
    one_of_two = [x for x in left if x in {(0, " ".join(c)), (0, " ".join(near[2]))}]
    assert len(one_of_two) == 1
    gone = {(0, " ".join(near[0])), (0, " ".join(near[1])), (8, " ".join(near[3])), (9, " ".join(near[4])),
            (0, " ".join(c)), (0, " ".join(near[2]))} - set(one_of_two)
    assert left == sorted([*(whole - gone), (0, " ".join(_noise(31, 120)))])
    got = cpsj.groups(docs).collect()
    assert len(got) == len(rows) and sorted(r["component_id"] for r in got if r["kept"] and r["id"] < 1000) == [5, 7, 7, 900]
    assert sorted(r["component_id"] for r in got if r["id"] == cpsj.LAST) == [5, 900, *[cpsj.LAST] * 5]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (201, 200)]
    got = {r["node"]: r["label"] for r in components.labels(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


# Benchmark decontamination

def _overlaps(docs, items):
    found = {}
    for d, text in docs:
        a = ALNUM.findall(text.lower())
        for i, item in items:
            b = ALNUM.findall(item.lower())
            best = None
            for shift in range(-len(b) + 1, len(a)):
                lo, hi = max(0, -shift), min(len(b), len(a) - shift)
                same = np.array([a[q + shift] == b[q] for q in range(lo, hi)], bool)
                if len(same):
                    x, y = spaced.best_stretch(same)
                    if y > x and spaced.counts(x, y, same, len(b)):
                        got = (lo + shift + x, lo + x, y - x, int(same[x:y].sum()))
                        if best is None or (got[2], -got[0], -got[1]) > (best[2], -best[0], -best[1]):
                            best = got
            if best and len(b) >= spaced.MIN_ITEM:
                found[d, i] = best
    return found


def test_overlaps_with_replaced_words(spark):
    r, items, docs = random.Random(3), [], []
    for i in range(12):
        items.append((i, " ".join(_noise(i, [40, 25, 13, 9, 5, 3][i % 6]))))
    for d in range(60):
        ws = items[d % 12][1].split()
        for _ in range(d // 12):
            ws[r.randrange(len(ws))] = "other"
        docs.append((d, " ".join(_noise(500 + d, 30) + ([w.upper() + "," for w in ws] if d % 5 else ws[:14]) + _noise(700 + d, 9))))
    got = {(x["doc_id"], x["item_id"]): (x["doc_start"], x["item_start"], x["n_words"], x["n_same"]) for x in spaced.overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    expected = _overlaps(docs, items)
    assert got.items() <= expected.items()  # nothing that brute force does not find
    missed = {k: v for k, v in expected.items() if k not in got}
    # A seed needs seven equal words under one mask; up to one replaced word in eight always leaves one.
    assert all(v[3] < v[2] * 7 / 8 for v in missed.values()) and len(missed) <= 0.05 * len(expected)
    clean = {x["doc_id"] for x in spaced.clean(spark.createDataFrame(docs, "doc_id long, text string"),
                                               spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert clean == {d for d, _ in docs} - {d for d, _ in got}


def test_short_items_are_found_whichever_words_are_replaced(spark):
    for n in range(spaced.MIN_ITEM, spaced.MIN_WORDS):
        most = n * 20 // 100
        for gone in itertools.combinations(range(1, n - 1), most):
            assert any(all(mask[i] == "0" for i in gone) for mask in spaced.short_masks(n))
    items = [(n, " ".join(_noise(60 + n, n))) for n in range(5, 13)]
    docs = []
    for n, item in items:
        ws = item.split()
        ws[3 if n > 5 else 2] = "other"
        docs.append((n, " ".join(_noise(80 + n, 6) + ws + _noise(95 + n, 4))))
    got = spaced.overlaps(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): r["n_same"] for r in got} == {(n, n): n - 1 for n, _ in items if n - 1 >= 0.8 * n}


def _longest(same: list[bool]) -> tuple[int, int]:
    """Every stretch from an equal to an equal word, judged by itself."""
    passing = [(b - a, -a) for a in range(len(same)) for b in range(a + 1, len(same) + 1)
               if same[a] and same[b - 1] and 100 * sum(same[a:b]) >= 80 * (b - a)]
    n, a = max(passing, default=(0, 0))
    return -a, n - a


def test_longest_stretch_equals_all_stretches_judged_one_by_one():
    r = random.Random(9)
    for _ in range(400):
        share = r.choice([0.1, 0.5, 0.7, 0.8, 0.9])
        same = [r.random() < share for _ in range(r.randrange(1, 45))]
        assert spaced.best_stretch(np.array(same)) == _longest(same), same


@pytest.mark.parametrize("parts", [(20, -9, 20, -9, 20), (40, -19, 40, -19, 40), (30, *(2, -1) * 33, 2)])
def test_more_copied_words_never_hide_an_overlap(spark, parts):
    """Positive parts of the item are copied, negative ones replaced."""
    item = _noise(41, sum(map(abs, parts)))
    same = [n > 0 for n in parts for _ in range(abs(n))]
    doc = _noise(42, 7) + [w if s else f"other{i}" for i, (w, s) in enumerate(zip(item, same))] + _noise(43, 5)
    docs = spark.createDataFrame([(1, " ".join(doc)), (2, " ".join(_noise(44, 200)))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    a, b = _longest(same)
    assert b - a >= 20
    assert [tuple(r) for r in spaced.overlaps(docs, items).collect()] == [(1, 1, 7 + a, a, b - a, sum(same[a:b]))]
    assert {r["doc_id"] for r in spaced.clean(docs, items).collect()} == {2}


def test_large_benchmarks_take_several_passes(spark, monkeypatch):
    items = spark.createDataFrame([(i, " ".join(_noise(i, 30))) for i in range(40)], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(_noise(i, 30))) for i in range(0, 40, 3)], "doc_id long, text string")
    monkeypatch.setattr(spaced, "BLOCK_WORDS", 300)
    assert len(list(spaced.blocks(items))) > 2
    assert {(r["doc_id"], r["item_id"]) for r in spaced.overlaps(docs, items).collect()} == {(i, i) for i in range(0, 40, 3)}
    assert spaced.clean(docs, items).count() == 0


# License templates

@pytest.mark.parametrize("template", ["a <<beginOptional>> b", "a <<endOptional>>", "a <<what>>", "<<beginOptional>>a<<endOptional>>",
                                      '<<var;name="x";match="{0,2}">> a'])
def test_faulty_templates(template):
    with pytest.raises(ValueError):
        templates.Automaton(template)


def test_automata_equal_regular_expressions():
    r = random.Random(5)
    shapes = ["a b c", "a <<beginOptional>>b <<beginOptional>>c<<endOptional>> d<<endOptional>> a",
              'a <<var;name="x";match="{1,3}">> b', 'a b <<beginOptional>><<var;name="x";match="{0,2}">> c<<endOptional>>',
              'a <<beginOptional>>b<<endOptional>> <<beginOptional>>b c<<endOptional>> <<var;name="y";match="{0,1}">> d']
    for shape in shapes:
        automaton, pattern = templates.Automaton(shape), re.compile(templates._pattern(templates.parse(shape)))
        for _ in range(800):
            ws = [r.choice("abcd") for _ in range(r.randrange(1, 9))]
            whole = [n for n in range(1, len(ws) + 1) if pattern.fullmatch("".join(f"{w} " for w in ws[:n]))]
            assert automaton.match(iter(ws)) == max(whole, default=0), (shape, ws)


def test_mandatory_wording_is_exact(spark):
    rows = [(1, "Released under the MIT License."), (2, "Released under an MIT License"), (3, "released, under: THE very old version of the MIT license"),
            (4, "Copyright (c) 1999 Some Body. All rights reserved"), (5, "mit  LICENSE apache-license General Public\nLicense")]
    got = {r["doc_id"]: r for r in templates.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["labels"] == "mit" and got[1]["score"] == 1 and got[2]["score"] == 0.5 and got[3]["score"] == 1
    assert got[4]["labels"] == "copyright,reserved" and got[4]["n_base"] == 0 and got[4]["first_word"] is None
    assert (got[5]["base_labels"], got[5]["n_base"], got[5]["first_word"], got[5]["last_word"]) == ("apache,gpl,mit", 3, 0, 4)


# Quotation linking

def test_nested_quotes_make_threads(spark):
    rows = [(1, 0, "a", "First  thing.\nSecond thing."), (1, 1, "b", "> first thing.\n>\n> unknown words\nI agree"),
            (1, 2, "c", ">> Second thing.\n> I  AGREE\nme too"), (1, 3, "a", "no quotes"), (1, 4, "d", "> me too\n> no quotes\nlast"),
            (2, 0, "a", "> I agree\nother conversation"), (None, 1, "x", "> I agree"), (3, None, "x", None)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): r for r in quoting.conversations(messages).collect()}
    assert got[1, 1]["text"] == "I agree" and (got[1, 1]["n_quotes"], got[1, 1]["n_linked"], got[1, 1]["parent_turn"]) == (2, 1, 0)
    assert (got[1, 2]["parent_turn"], got[1, 2]["root_turn"], got[1, 2]["depth"], got[1, 2]["n_linked"]) == (1, 0, 2, 2)
    assert got[1, 3]["parent_turn"] is None and got[1, 3]["root_turn"] == 3
    assert (got[1, 4]["parent_turn"], got[1, 4]["root_turn"], got[1, 4]["depth"]) == (2, 0, 3)
    assert got[2, 0]["n_linked"] == 0 and got[None, 1]["n_quotes"] == 1 and got[3, None]["text"] == ""


def test_long_chains_follow_pointers(spark):
    chain = spark.createDataFrame([(1, i + 1, i) for i in range(300)], "conv_id long, turn long, parent_turn long")
    got = {r["turn"]: (r["root_turn"], r["depth"]) for r in quoting.threads(chain).collect()}
    assert got == {i + 1: (0, i + 1) for i in range(300)}
