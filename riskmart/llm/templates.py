"""License scan: templates with optional and replaceable regions, compiled to automata over words.

Words are lower-cased runs of ASCII letters and digits and of all other characters beyond ASCII. A template is text in
which <<beginOptional>>...<<endOptional>> may be missing (regions may nest) and <<var;name="...";match="{a,b}">> stands
for any a to b words; all else is mandatory wording and must match word for word, at any place of a text. Sets of
automaton states are cached as they are met, so a template is followed one table look-up per word.

Besides, places of fixed phrases are counted. `labels` has the labels of phrases and of accepted templates, `score` is 1
if a template is accepted, 0.5 if only phrases are found, else 0.

Defined cases: null text is empty, without words, places and labels; repeated rows are judged each; an empty table gives
an empty result; extra columns take no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm import store, words

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

TEMPLATES = {
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License")<<endOptional>>',
    "cc-by-nc-4.0": "Licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>Creative Commons<<endOptional>> "
                    "CC BY-NC 4.0",
    "gpl-3.0": "licensed under the GNU General Public License, <<beginOptional>>either<<endOptional>> version 3 "
               "<<beginOptional>>of the License, or (at your option) any later version<<endOptional>>",
    "mit": 'Released under the <<beginOptional>><<var;name="kind";match="{1,2}">> version of the<<endOptional>> '
           "MIT License",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  'associated documentation files (the "Software"), to deal in the Software without restriction',
    "copyright": 'Copyright <<beginOptional>>(c)<<endOptional>> <<var;name="holder";match="{0,12}">> '
                 "All rights reserved",
    "reserved": "All rights reserved",
}

FOUND = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
         "score double")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARK = re.compile(r"<<(.*?)>>", re.S)


def split(text: str) -> list[str]:
    """Words of a short text, such as a template or phrase."""
    return _WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text))


def parse(template: str) -> list:
    """Nested list of words (str), optional regions (list) and replaceable ones ((least, most))."""
    stack: list[list] = [[]]
    for i, part in enumerate(_MARK.split(template)):
        if i % 2 == 0:
            stack[-1].extend(split(part))
        elif part == "beginOptional":
            stack.append([])
        elif part == "endOptional":
            if len(stack) < 2:
                raise ValueError(f"endOptional without beginOptional: {template}")
            region = stack.pop()
            stack[-1].append(region)
        elif found := re.fullmatch(r'var;.*match="\{(\d+),(\d+)\}"', part):
            stack[-1].append((int(found[1]), int(found[2])))
        else:
            raise ValueError(f"unknown markup <<{part}>>")
    if len(stack) != 1:
        raise ValueError(f"beginOptional without endOptional: {template}")
    return stack[0]


class Automaton:
    """States 0 to n; `step` maps a state to (word or None for any, next state), `skip` to states reached by no word."""

    def __init__(self, template: str):
        self.step: dict[int, list[tuple[str | None, int]]] = {}
        self.skip: dict[int, list[int]] = {}
        self.n = 0
        tree = parse(template)
        self.mandatory = [x for x in tree if isinstance(x, str)]
        if not self.mandatory:
            raise ValueError("a template needs mandatory wording")
        self.end = self._add(tree, 0)
        self.start = self._closed({0})
        self.first = {w for s in self.start for w, _ in self.step.get(s, ())}
        if None in self.first or self.end in self.start:
            raise ValueError("a template must begin with wording")
        self.vocabulary = {w for edges in self.step.values() for w, _ in edges if w is not None}
        self.cache: dict[tuple[frozenset, str | None], frozenset] = {}

    def _add(self, items: list, state: int) -> int:
        for item in items:
            if isinstance(item, list):
                end = self._add(item, state)
                self.skip.setdefault(state, []).append(end)
                state = end
            else:
                least, most = item if isinstance(item, tuple) else (1, 1)
                word = None if isinstance(item, tuple) else item
                begins = []
                for i in range(most):
                    if i >= least:
                        begins.append(state)
                    self.n += 1
                    self.step.setdefault(state, []).append((word, self.n))
                    state = self.n
                for begin in begins:
                    self.skip.setdefault(begin, []).append(state)
        # Regions end in a state of their own, so that what follows one is not taken for its inside.
        self.n += 1
        self.skip.setdefault(state, []).append(self.n)
        return self.n

    def _closed(self, states: set[int]) -> frozenset:
        todo, found = list(states), set(states)
        while todo:
            for s in self.skip.get(todo.pop(), ()):
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)

    def match(self, sequence: Iterator[str | None]) -> int:
        """Number of words of the longest match that begins with the first word, 0 if none; None is an unknown word."""
        states, longest = self.start, 0
        for i, word in enumerate(sequence, 1):
            key = (states, word)
            if key not in self.cache:
                self.cache[key] = self._closed({t for s in states for w, t in self.step.get(s, ()) if w is None or w == word})
            states = self.cache[key]
            if not states:
                break
            if self.end in states:
                longest = i
        return longest


class Scanner:
    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.automata = {label: Automaton(t) for label, t in templates.items()}
        self.phrases = [(split(p), label) for p, label in phrases.items()]
        vocabulary = sorted(set().union(*(a.vocabulary for a in self.automata.values()), *(p for p, _ in self.phrases)))
        hashes = words.find(pa.array(vocabulary, pa.string()), words.ALNUM, words.LOWER).hashes
        order = np.argsort(hashes)
        self.hashes, self.known = hashes[order], [vocabulary[i] for i in order]
        self.number = {w: i for i, w in enumerate(self.known)}
        self.sieve = np.zeros(1 << 16, bool)
        self.sieve[hashes >> np.uint64(48)] = True

    def numbers(self, found: words.Words) -> np.ndarray:
        """Number of each word in the vocabulary, -1 for other words."""
        result = np.full(len(found.hashes), -1, np.int32)
        at = np.flatnonzero(self.sieve[found.hashes >> np.uint64(48)])
        place = np.minimum(np.searchsorted(self.hashes, found.hashes[at]), len(self.hashes) - 1)
        hit = self.hashes[place] == found.hashes[at]
        result[at[hit]] = place[hit]
        return result

    def scan(self, found: words.Words) -> tuple[dict[int, list[tuple[int, str]]], dict[int, set[str]]]:
        """(places of phrases by text: word from 0, label), (labels of accepted templates by text)."""
        number, text = self.numbers(found), found.text_of
        places: dict[int, list[tuple[int, str]]] = {}
        for phrase, label in self.phrases:
            at = np.flatnonzero(number == self.number[phrase[0]])
            at = at[at + len(phrase) <= found.bounds[1:][text[at]]] if len(at) else at
            for j, word in enumerate(phrase[1:], 1):
                at = at[number[at + j] == self.number[word]]
            for i in at.tolist():
                t = int(text[i])
                places.setdefault(t, []).append((i - int(found.bounds[t]), label))
        accepted: dict[int, set[str]] = {}
        for label, automaton in self.automata.items():
            rare = max(automaton.mandatory, key=len)
            candidates = np.unique(text[number == self.number[rare]])
            first = np.isin(number, [self.number[w] for w in automaton.first])
            for t in candidates.tolist():
                begin, end = int(found.bounds[t]), int(found.bounds[t + 1])
                for i in (np.flatnonzero(first[begin:end]) + begin).tolist():
                    if automaton.match(self.known[n] if n >= 0 else None for n in number[i:end]):
                        accepted.setdefault(t, set()).add(label)
                        break
        return places, accepted


def scan(docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """One row per document; texts are read where they lie."""
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    Scanner(templates, phrases)  # a faulty template is refused before the job starts

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        for batch in words.chunks(batches):
            found = words.find(batch.column("text"), words.ALNUM, words.LOWER)
            places, accepted = scanner.scan(found)
            n = batch.num_rows
            values = {"n_base": [0] * n, "first_word": [None] * n, "last_word": [None] * n, "base_labels": [""] * n,
                      "labels": [""] * n, "score": [0.0] * n}
            for t in places.keys() | accepted.keys():
                at, base = [i for i, _ in places.get(t, ())], {x for _, x in places.get(t, ())}
                values["n_base"][t] = len(at)
                values["first_word"][t], values["last_word"][t] = (min(at), max(at)) if at else (None, None)
                values["base_labels"][t] = ",".join(sorted(base))
                values["labels"][t] = ",".join(sorted(base | accepted.get(t, set())))
                values["score"][t] = 1.0 if t in accepted else 0.5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.counts.astype(np.int64)),
                 *(pa.array(values[c], pa.int64()) for c in ("n_base", "first_word", "last_word")),
                 *(pa.array(values[c], pa.string()) for c in ("base_labels", "labels")),
                 pa.array(values["score"], pa.float64())],
                names=["doc_id", "n_words", *values])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, FOUND)


def query(spark, sf_dir: str) -> DataFrame:
    return scan(store.table(spark, sf_dir, "documents"))


def _pattern(items: list) -> str:
    """The template as a regular expression over words that each end in one space."""
    out = ""
    for item in items:
        if isinstance(item, str):
            out += f"{item} "
        elif isinstance(item, list):
            out += f"(?:{_pattern(item)})?"
        else:
            out += f"(?:[^ ]+ ){{{item[0]},{item[1]}}}"
    return out


def sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    places = " UNION ALL ".join(
        f"SELECT doc_id, i - 1 AS i, '{label}' AS label FROM spot WHERE "
        + " AND ".join(f"w[i + {j}] = '{word}'" if j else f"w[i] = '{word}'" for j, word in enumerate(split(phrase)))
        for phrase, label in PHRASES.items())
    accepted = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label FROM m WHERE regexp_matches(joined, ' {_pattern(parse(t))}')"
        for label, t in TEMPLATES.items())
    return rf"""
WITH w AS (SELECT doc_id, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
m AS (SELECT doc_id, w, ' ' || coalesce(list_aggregate(w, 'string_agg', ' '), '') || ' ' AS joined FROM w),
spot AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w),
place AS ({places}),
b AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM place GROUP BY doc_id),
accepted AS ({accepted}),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT doc_id, label FROM place UNION ALL SELECT * FROM accepted) GROUP BY doc_id),
a AS (SELECT DISTINCT doc_id, 1 AS yes FROM accepted)
SELECT m.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base,
       CAST(b.lo AS BIGINT) AS first_word, CAST(b.hi AS BIGINT) AS last_word, coalesce(b.labels, '') AS base_labels,
       coalesce(l.labels, '') AS labels,
       CAST(CASE WHEN a.yes = 1 THEN 1.0 WHEN b.n > 0 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS score
FROM m LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN a USING (doc_id)
"""
