"""Benchmark decontamination by spaced seeds.

Words are lower-cased runs of ASCII letters and digits and of all other characters beyond ASCII. A mask of ones and
zeros is laid over every window of a benchmark item and of a document; the words under its ones are hashed, those under
zeros ignored, so that a replaced word spoils only the masks that look at it. Where hashes of both sides meet, the two
texts are compared word by word along that alignment: the overlap is the longest stretch that begins and ends with an
equal word and has at least `MIN_SAME` percent equal words. It counts from `MIN_WORDS` words, or, for a shorter item, if
it is the whole item. Items of fewer than `MIN_ITEM` words say too little and match nothing.
Items of fewer than `MIN_WORDS` words have masks of their own size that find each such overlap. Longer ones are covered
by six masks of `MIN_WORDS` words, of which one ignores any two replaced words; only an overlap whose every window of
that size has three or more replaced words may have no seed.

A hit whose predecessor, one word earlier on both sides, is a hit too adds no alignment and is not listed, so a text and
an item that repeat a few words cost their alignments, not the product of their places.

The seeds of the benchmark go to the tasks in blocks of at most `BLOCK_WORDS` words; a larger benchmark takes more
passes over the documents. Documents are not shuffled.

Defined cases: null or empty texts have no words and match nothing; equal benchmark rows count once; each document row
is judged by itself; empty tables give an empty result; extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm import store, words

MIN_WORDS, MIN_SAME, MIN_ITEM = 13, 80, 5
# Besides four masks for long stretches: of each four neighbouring words two are ignored, in all six ways.
MASKS = ("1111011", "1101101011", "11100110100111", "1111111",
         *("".join("01"[i % 4 not in zeros] for i in range(MIN_WORDS)) for zeros in combinations(range(4), 2)))
BLOCK_WORDS = 200_000
FOUND = "doc_id long, item_id long, doc_start long, item_start long, n_words long, n_same long"
_FILTER_BITS = 20
_HITS = 1 << 20  # hits listed at once
_ITEM_START, _TEXT_START = np.uint64(1), np.uint64(2)  # stand for the seed before the first one


def short_masks(n: int) -> list[str]:
    """Masks over a whole item of `n` words: wherever as many words are replaced as may be, one mask ignores them all."""
    replaced = n * (100 - MIN_SAME) // 100
    groups = 3 if replaced == 1 else 4
    return ["".join("0" if 0 < i < n - 1 and i % groups in zeros else "1" for i in range(n))
            for zeros in combinations(range(groups), replaced)]


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the words under the mask's ones for each window, by its start."""
    room = max(len(hashes) - len(mask) + 1, 0)
    total = np.full(room, len(mask), np.uint64)
    for j, bit in enumerate(mask):
        if bit == "1":
            total += hashes[j:j + room] * words.power(j + 1)
    return words.mix(total)


def preceded(keys: np.ndarray, before: np.ndarray) -> np.ndarray:
    """One hash for a seed and the seed before it."""
    return words.mix(keys + before * words.power(1))


def best_stretch(same: np.ndarray) -> tuple[int, int]:
    """[begin, end) of the longest stretch from an equal to an equal word with `MIN_SAME` percent equal; the first such."""
    starts = np.flatnonzero(same)
    if not len(starts):
        return 0, 0
    # A stretch passes if the sum does not fall from its begin to its end; each end takes its earliest such begin.
    sums = np.concatenate([[0], np.cumsum(np.where(same, 100 - MIN_SAME, -MIN_SAME))])
    low = np.minimum.accumulate(sums[starts])
    ends = starts + 1
    begins = starts[np.searchsorted(-low, -sums[ends])]
    best = int((ends - begins).argmax())
    return int(begins[best]), int(ends[best])


def counts(begin: int, end: int, same: np.ndarray, item_words: int) -> bool:
    n = end - begin
    return n >= min(MIN_WORDS, item_words) and 100 * int(same[begin:end].sum()) >= MIN_SAME * n


class Block:
    """Seeds of some items, and the overlaps of a chunk of documents with them."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids = [i for i, _ in items]
        found = words.find(pa.array([t for _, t in items], pa.large_string()), words.ALNUM, words.LOWER)
        self.hashes, self.bounds = found.hashes, found.bounds
        sizes = found.counts
        usable = np.repeat(sizes >= MIN_ITEM, sizes)
        # (mask, size of the items that it is laid over as a whole, or 0 for every window of all items)
        short = sorted(set(sizes[(sizes >= MIN_ITEM) & (sizes < MIN_WORDS)].tolist()))
        self.masks = [(m, 0) for m in MASKS] + [(m, n) for n in short for m in short_masks(n)]
        self.tables = []
        for mask, size in self.masks:
            at = np.arange(max(len(self.hashes) - len(mask) + 1, 0))
            owner = found.text_of
            keep = usable[at] & (at + len(mask) <= self.bounds[1:][owner[at]])
            if size:
                keep &= sizes[owner[at]] == size
            at = at[keep]
            every = seeds(self.hashes, mask)
            keys, before = every[at], np.where(at > self.bounds[owner[at]], every[at - 1], _ITEM_START)
            order = np.lexsort((before, keys))
            sieve = np.zeros(1 << _FILTER_BITS, bool)
            sieve[keys >> np.uint64(64 - _FILTER_BITS)] = True
            pairs, first, many = np.unique(preceded(keys, before)[order], return_index=True, return_counts=True)
            self.tables.append((keys[order], at[order], sieve, pairs, first, many))
        self.owner = found.text_of

    def _alignments(self, found: words.Words, text_of: np.ndarray, mask: str, keys: np.ndarray, places: np.ndarray,
                    sieve: np.ndarray, pairs: np.ndarray, first: np.ndarray, many: np.ndarray) -> Iterator[np.ndarray]:
        """Rows of (text, item, shift) where a seed of the text meets one of the item and the seeds before them do not."""
        yield np.zeros((0, 3), np.int64)
        mine = seeds(found.hashes, mask)
        at = np.flatnonzero(sieve[mine >> np.uint64(64 - _FILTER_BITS)])
        at = at[at + len(mask) <= found.bounds[1:][text_of[at]]] if len(at) else at
        low, high = (np.searchsorted(keys, mine[at], side) for side in ("left", "right"))
        at, low, high = at[high > low], low[high > low], high[high > low]
        if not len(at):
            return
        pair = preceded(mine[at], np.where(at > found.bounds[text_of[at]], mine[at - 1], _TEXT_START))
        i = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
        skip = np.where(pairs[i] == pair, many[i], 0)  # places with the same seed before them, in order from `head` on
        head = np.where(skip > 0, first[i], high) - low
        n = high - low - skip
        ends = np.cumsum(n)
        cuts = np.unique(np.searchsorted(ends, np.arange(_HITS, int(ends[-1]) + _HITS, _HITS))).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(at)]):
            hit = np.repeat(np.arange(a, b), n[a:b])
            step = np.arange(len(hit)) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b])
            place = places[low[hit] + step + np.where(step >= head[hit], skip[hit], 0)]
            yield np.unique(np.stack([text_of[at[hit]], self.owner[place], at[hit] - place], 1), axis=0)

    def overlaps(self, found: words.Words) -> dict[tuple[int, int], tuple[int, int, int, int]]:
        """(text, item) -> (start in the text, start in the item, words, equal words) of the longest overlap."""
        alignments = []
        text_of = found.text_of
        for (mask, _), table in zip(self.masks, self.tables):
            alignments += self._alignments(found, text_of, mask, *table)
        result: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for text, item, shift in np.unique(np.concatenate(alignments), axis=0).tolist():
            begin = max(int(self.bounds[item]), int(found.bounds[text]) - shift)
            end = min(int(self.bounds[item + 1]), int(found.bounds[text + 1]) - shift)
            same = self.hashes[begin:end] == found.hashes[begin + shift:end + shift]
            a, b = best_stretch(same)
            if counts(a, b, same, int(self.bounds[item + 1] - self.bounds[item])):
                got = (begin + shift + a - int(found.bounds[text]), begin + a - int(self.bounds[item]), b - a,
                       int(same[a:b].sum()))
                old = result.get((text, item))
                if old is None or (got[2], -got[0], -got[1]) > (old[2], -old[0], -old[1]):
                    result[text, item] = got
        return result


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in parts of about BLOCK_WORDS words, each collected by itself."""
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = ceil(total / (5 * BLOCK_WORDS))
    for i in range(n):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == i).collect()]


def _block(shared) -> Block:
    """The worker's tables of a broadcast block, made once."""
    if _made.get("of") != shared.value[0]:
        _made.update({"of": shared.value[0], "block": Block(shared.value[1])})
    return _made["block"]


_made: dict = {}


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that overlap: the longest overlap, starts counted in words from 0."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    result = None
    for items in blocks(benchmark):
        shared = spark.sparkContext.broadcast((store.folder(spark, "block"), items))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = _block(shared)
            for batch in words.chunks(batches):
                found = block.overlaps(words.find(batch.column("text"), words.ALNUM, words.LOWER))
                if found:
                    text, item = np.array(list(found)).T
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(text)),
                         pa.array([block.ids[i] for i in item.tolist()], pa.int64()),
                         *(pa.array(list(x), pa.int64()) for x in zip(*found.values()))],
                        names=["doc_id", "item_id", "doc_start", "item_start", "n_words", "n_same"])

        part = texts.mapInArrow(search, FOUND)
        result = part if result is None else result.unionByName(part)
    return spark.createDataFrame([], FOUND) if result is None else result


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that overlap with no item."""
    spark = docs.sparkSession
    for items in blocks(benchmark):
        shared = spark.sparkContext.broadcast((store.folder(spark, "block"), items))

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = _block(shared)
            for batch in words.chunks(batches):
                found = block.overlaps(words.find(batch.column("text"), words.ALNUM, words.LOWER))
                left = np.ones(batch.num_rows, bool)
                left[[text for text, _ in found]] = False
                yield batch.filter(pa.array(left))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def query(spark, sf_dir: str) -> DataFrame:
    return overlaps(store.table(spark, sf_dir, "documents"), store.table(spark, sf_dir, "benchmark"))
