"""Removal of byte strings that repeat, by suffix arrays that two-stage sorting builds.

A window is `WIDTH` consecutive bytes of one document's UTF-8 text. Every byte under a window that also starts earlier
(smaller document, or same document and earlier start) is removed. Documents are ordered by doc_id, then by a hash.

Equal windows must meet in one suffix array, none of which may be larger than a task:
1. Texts that occur more than once are one; in all but the first every window starts earlier, so only leaders go on.
2. Each window is known by its minimizer, the least hash of `GRAM` bytes in it. Neighbours that share it form a piece.
   Only pieces whose minimizer occurs twice, in different texts or at two places of one, can repeat.
3. Equal pieces are one; in all but the first every window starts earlier. First pieces are grouped by minimizer; only
   groups of several, or of one whose minimizer stands at two places, are fetched from the texts.
4. Groups are laid into blocks. A block's suffix array comes from two-stage sorting: only suffixes smaller than their
   successors are sorted directly, word by word to the depth of a window; bucket scans induce all others. Neighbours
   with a common prefix of a window start with equal windows; all but the earliest are marked.
5. A group larger than `GROUP` bytes is cut into pieces again by minimizers under another seed, so that windows are dealt
   anew, at last window by window, when equal pieces are equal windows and nothing is left to compare.
6. Marked windows of a document become spans, and its text is cut once.

Defined cases: null text is empty; a text shorter than a window loses nothing; null doc_id comes after all others; rows
of one doc_id, or without one, count as one document if their texts are equal, else as several in order of a hash; an
empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm import store, words

WIDTH, GRAM = 100, 24
PIECE = 400  # windows of a piece at most (below 512, see `_coordinates`)
GROUP = 1 << 20  # bytes of the pieces of a group that one suffix array takes
BLOCK = 1 << 20  # bytes after which a block of whole groups is sorted
LEVELS = 4  # cuts of large groups by minimizers, after that by single windows
LAST = 2**63 - 1  # stands for a null doc_id
_WORD = 8


def _words(data: np.ndarray) -> np.ndarray:
    """Number of the 8 bytes from each place on, ordered as the bytes are; the data end in zeros."""
    padded = np.concatenate([data, np.zeros(_WORD - 1, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, _WORD).copy().view(">u8").ravel().astype(np.uint64)


def _minimizers(data: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the gram from each place on, least of them in the window from each place on)."""
    if len(data) < WIDTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    word = _words(data)[:len(data) - _WORD + 1]
    n = len(data) - GRAM + 1
    total = np.zeros(n, np.uint64)
    for j in range(GRAM // _WORD):
        total += words.mix(word[_WORD * j:_WORD * j + n] + words.power(3 * seed + j + 1))
    grams = words.mix(total)
    least, width, wanted = grams, 1, WIDTH - GRAM + 1
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return grams, least


class Pieces:
    """Pieces of the byte strings of a chunk: string, first window and number of windows of each, and its minimizer."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, seed: int, single: bool = False):
        self.data, self.bounds = data, bounds
        grams, least = _minimizers(data, seed)
        sizes = np.diff(bounds)
        windows = np.maximum(sizes - WIDTH + 1, 0)
        ends = np.cumsum(windows)
        string = np.repeat(np.arange(len(sizes)), windows)
        at = np.arange(len(string)) - np.repeat(ends - windows, windows)  # start in its string
        place = at + bounds[string]
        mini = least[place]
        new = np.ones(len(place), bool)
        if not single:
            new[1:] = (mini[1:] != mini[:-1]) | (string[1:] != string[:-1])
            # Long runs are cut by their own length, wherever they are.
            run = np.flatnonzero(new)
            inside = np.arange(len(new)) - np.repeat(run, np.diff(np.concatenate([run, [len(new)]])))
            new |= inside % PIECE == 0
        first = np.flatnonzero(new)
        self.string, self.start, self.mini = string[first], at[first], mini[first]
        self.windows = np.diff(np.concatenate([first, [len(new)]]))
        self.place = place[first]
        # Windows of a piece can only be equal to one another if its minimizer stands at two places.
        hits = np.bincount((np.cumsum(new) - 1)[grams[place] == mini], minlength=len(first))
        last = self.place + self.windows - 1
        for j in range(1, WIDTH - GRAM + 1):  # behind the start of the last window
            hits += grams[last + j] == self.mini
        self.again = hits > 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.place[i]:self.place[i] + self.windows[i] + WIDTH - 1].tobytes()


def suffix_array(text: np.ndarray, depth: int = WIDTH) -> np.ndarray:
    """Places of all suffixes, ordered by their first `depth` symbols (bytes, ordered ones of equal beginnings as they
    come). `text` ends with the symbol 0, which may stand elsewhere too."""
    n = len(text)
    # A suffix is smaller than its successor if its first symbol is smaller than the next different one.
    change = np.flatnonzero(text[1:] != text[:-1])
    runs = np.diff(np.concatenate([[-1], change, [n - 1]]))
    rises = np.concatenate([text[change] < text[change + 1], [False]])
    small = np.repeat(rises, runs)
    direct = _sorted(text, np.flatnonzero(small), depth)
    first = text[direct]
    counts = np.bincount(text, minlength=256)
    begins = np.cumsum(counts) - counts
    order = np.full(n, -1, np.int64)
    heads = begins.copy()  # next free place of each bucket's induced suffixes
    direct_at = np.searchsorted(first, np.arange(257))
    previous = np.concatenate([[0], text[:-1]])
    # The last suffix is smallest of all but has no successor to be induced from.
    order[0], heads[0] = n - 1, 1

    def induce(found: np.ndarray, symbol: int) -> np.ndarray:
        """Place the predecessors of suffixes in order; those in the same bucket are given back to be scanned next."""
        found = found[found > 0]
        before = previous[found]
        larger = before >= symbol
        found, before = found[larger] - 1, before[larger]
        found, before = found[~small[found]], before[~small[found]]
        grouped = np.argsort(before, kind="stable")
        found, before = found[grouped], before[grouped]
        if not len(found):
            return found
        number = np.bincount(before, minlength=256)
        offset = np.arange(len(found)) - np.repeat(np.cumsum(number) - number, number)
        order[heads[before] + offset] = found
        heads[:] += number
        return found[before == symbol]

    for symbol in range(256):
        if not counts[symbol]:
            continue
        fresh = order[begins[symbol]:heads[symbol]]
        while len(fresh):
            fresh = induce(fresh, symbol)
        mine = direct[direct_at[symbol]:direct_at[symbol + 1]]
        order[begins[symbol] + counts[symbol] - len(mine):begins[symbol] + counts[symbol]] = mine
        induce(mine, symbol)
    return order


def _sorted(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes at the places, ordered by their first `depth` symbols at least."""
    word = np.concatenate([_words(text), np.zeros(depth + _WORD, np.uint64)])
    order = at
    group = np.zeros(len(at), np.int64)  # number of the suffixes known to be smaller
    open_ = np.arange(len(at))  # places in `order` whose group has more than one member
    for offset in range(0, depth, _WORD):
        if not len(open_):
            break
        key, mine = word[order[open_] + offset], group[open_]
        by = np.argsort(key, kind="stable")
        by = by[np.argsort(mine[by], kind="stable")]
        key, mine = key[by], mine[by]
        order[open_] = order[open_][by]
        new = np.ones(len(by), bool)
        new[1:] = (mine[1:] != mine[:-1]) | (key[1:] != key[:-1])
        first = np.flatnonzero(new)
        sizes = np.diff(np.concatenate([first, [len(new)]]))
        group[open_] = np.repeat(open_[first], sizes)
        open_ = open_[np.repeat(sizes > 1, sizes)]
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int = WIDTH) -> np.ndarray:
    """Length of the common beginning of each suffix in order and the one before it, at most `depth`; 0 for the first."""
    word = np.concatenate([_words(text), np.zeros(depth + _WORD, np.uint64)])
    common = np.zeros(len(order), np.int64)
    at = np.arange(1, len(order))
    for offset in range(0, depth, _WORD):
        differ = word[order[at] + offset] ^ word[order[at - 1] + offset]
        # Leading equal bytes of the two words: those above the highest bit that differs.
        equal = np.zeros(len(at), np.int64)
        for j in range(1, _WORD + 1):
            equal += (differ >> np.uint64(64 - 8 * j)) == 0
        common[at] += equal
        at = at[equal == _WORD]
    return np.minimum(common, depth)


def repeats(pieces: list[bytes], doc: np.ndarray, tie: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece, window in it) of every window that also starts earlier in one of the pieces."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    used = np.bincount(data, minlength=256) > 0
    if used.all():
        raise ValueError("a text is not UTF-8: it has all 256 byte values")
    symbols = np.cumsum(used).astype(np.uint8)  # 1 and up; 0 ends a piece
    sizes = np.array([len(p) for p in pieces])
    begins = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(pieces), np.uint8)
    piece = np.repeat(np.arange(len(pieces)), sizes)
    text[np.arange(len(data)) + piece] = symbols[data]
    owner = np.repeat(np.arange(len(pieces)), sizes + 1)
    order = suffix_array(text)
    order = order[order - begins[owner[order]] <= sizes[owner[order]] - WIDTH]  # those that hold a whole window
    same = common_prefixes(text, order) >= WIDTH
    group = np.cumsum(~same)
    own = owner[order]
    at = order - begins[own]
    ranked = np.lexsort((start[own] + at, tie[own], doc[own], group))
    first = np.ones(len(order), bool)
    first[1:] = group[ranked][1:] != group[ranked][:-1]
    # A window that stands twice in the table at one place of a document is the same window.
    later = ranked[~first]
    return own[later], at[later]


def runs(piece: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first byte, number of bytes) of the strings covered by windows."""
    order = np.lexsort((at, piece))
    piece, at = piece[order], at[order]
    new = np.ones(len(at), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (at[1:] > at[:-1] + WIDTH)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[:len(first)] - 1
    return piece[first], at[first], at[last] - at[first] + WIDTH


SPAN = "doc long, tie long, start long, n_bytes long"
PIECE_OF = f"num long, {SPAN}, mini long, again boolean"

def _spans(doc, tie, start, size) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (doc, tie, start, size)],
                                      names=["doc", "tie", "start", "n_bytes"])


def _long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pieces of the texts: minimizer, text, and start, windows and `again` in one number."""
    for batch in words.chunks(batches):
        found = Pieces(*words.bytes_of(batch.column("text")), 0)
        packed = found.start << 10 | found.windows << 1 | found.again
        yield pa.RecordBatch.from_arrays(
            [pa.array(_long(found.mini)), pa.array(np.asarray(batch.column("num"), np.int64)[found.string]), pa.array(packed)],
            names=["mini", "num", "packed"])


def _listed(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    """(row of each element of `wanted`, its fields)."""
    wanted = batch.column("wanted")
    flat = wanted.flatten()
    row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(wanted.offsets)))
    return row, [np.asarray(flat.field(i), np.int64) for i in range(flat.type.num_fields)]


def _slices(batch: pa.RecordBatch, with_bytes: bool) -> pa.RecordBatch:
    """The wanted pieces of the texts, with their digest or their bytes."""
    data, bounds = words.bytes_of(batch.column("text"))
    row, (mini, packed) = _listed(batch)
    start, n, again = packed >> 10, (packed >> 1 & 511) + WIDTH - 1, (packed & 1).astype(bool)
    begin = bounds[row] + start
    whole = memoryview(data.tobytes())
    raw = [whole[a:b] for a, b in zip(begin.tolist(), (begin + n).tolist())]
    raw = [bytes(x) for x in raw] if with_bytes else [hashlib.blake2b(x, digest_size=16).digest() for x in raw]
    num, doc, tie = (np.asarray(batch.column(c), np.int64)[row] for c in ("num", "doc", "tie"))
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, (num, doc, tie, start, n, mini, again)), pa.array(raw, pa.binary())],
        names=["num", "doc", "tie", "start", "n_bytes", "mini", "again", "bytes" if with_bytes else "digest"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in words.chunks(batches):
        yield _slices(batch, False)


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in words.chunks(batches):
        yield _slices(batch, True)


def _cut_again(level: int):
    """Pieces of large groups cut anew by the minimizers of another seed."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.chunks(batches, "bytes"):
            found = Pieces(*_binary(batch.column("bytes")), level, single=level > LEVELS)
            of = found.string
            num, doc, tie, start, mini = (np.asarray(batch.column(c), np.int64)[of] for c in ("num", "doc", "tie", "start", "mini"))
            mini = words.mix(found.mini ^ words.mix(mini.view(np.uint64)))
            raw = [found.bytes_of(i) for i in range(len(of))]
            digest = [hashlib.blake2b(x, digest_size=16).digest() for x in raw]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, (num, doc, tie, start + found.start, found.windows + WIDTH - 1, _long(mini), found.again)),
                 pa.array(digest, pa.binary()), pa.array(raw, pa.binary())],
                names=["num", "doc", "tie", "start", "n_bytes", "mini", "again", "digest", "bytes"])
    return rows


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces come sorted by minimizer; blocks of whole groups are sorted together."""
    def answer(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        mini = np.asarray(table.column("mini"), np.int64)
        alone = np.ones(len(mini), bool)
        alone[1:] &= mini[1:] != mini[:-1]
        alone[:-1] &= mini[1:] != mini[:-1]
        table = table.filter(pa.array(~alone | np.asarray(table.column("again"))))
        if not table.num_rows:
            return _spans(*[[]] * 4)
        doc, tie, start = (np.asarray(table.column(c), np.int64) for c in ("doc", "tie", "start"))
        piece, at = repeats(table.column("bytes").to_pylist(), doc, tie, start)
        piece, at, size = runs(piece, at)
        return _spans(doc[piece], tie[piece], start[piece] + at, size)

    waiting, size = [], 0
    for batch in words.chunks(batches, "bytes"):
        mini = np.asarray(batch.column("mini"))
        if waiting and size >= BLOCK:
            last = waiting[-1].column("mini")[-1].as_py()
            cut = int(np.flatnonzero(np.concatenate([mini != last, [True]]))[0])
            if cut < len(mini):
                yield answer([*waiting, batch.slice(0, cut)])
                batch, waiting, size = batch.slice(cut), [], 0
        waiting.append(batch)
        size += batch.nbytes
    if waiting:
        yield answer(waiting)


def _led(pieces: DataFrame) -> DataFrame:
    """Stored pieces with `leads`, true for the first of equal ones; only these keep their bytes."""
    place = F.struct("doc", "tie", "start")
    firsts = pieces.groupBy("digest").agg(F.min(place).alias("first"))
    # What grows with the documents is never broadcast, so that plans are the same at every size.
    leads = place == F.col("first")
    own = [F.when(leads, F.col(c)).alias(c) for c in pieces.columns if c == "bytes"]
    return store.stage(pieces.join(firsts.hint("merge"), "digest").select(
        "num", "doc", "tie", "start", "n_bytes", "mini", "again", leads.alias("leads"), *own), "pieces")


def _wanted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("num").agg(F.collect_list(F.struct("mini", "packed")).alias("wanted"))


def spans(leaders: DataFrame) -> DataFrame:
    """(doc, tie, start, n_bytes): byte strings to be removed; `leaders` has num, doc, tie and text, different texts."""
    all_ = store.stage(leaders.select("num", "text").mapInArrow(_coordinates, "mini long, num long, packed long"), "coordinates")
    # A minimizer repeats if two texts have it, or two pieces, or a piece at two places.
    common = store.stage(all_.groupBy("mini").agg(
        F.min("num").alias("low"), F.max("num").alias("high"), F.count("*").alias("pieces"),
        F.max(F.col("packed").bitwiseAND(1)).alias("again")).where("low < high OR pieces > 1 OR again = 1").select("mini"), "common")
    wanted = store.stage(_wanted(all_.join(common.hint("merge"), "mini")), "wanted")
    store.discard(all_)
    store.discard(common)
    texts = leaders.select("num", "doc", "tie", "text")
    pieces = store.stage(texts.join(wanted.hint("merge"), "num").mapInArrow(_digests, f"{PIECE_OF}, digest binary"), "candidates")
    store.discard(wanted)
    known = _led(pieces)
    store.discard(pieces)
    columns = ["doc", "tie", "start", "n_bytes"]
    found = [known.where("NOT leads").select(*columns)]
    first = known.where("leads")
    groups = first.groupBy("mini").agg(F.count("*").alias("members"), F.max("again").alias("repeats")).where(
        "members > 1 OR repeats").select("mini")
    packed = F.shiftleft("start", 10).bitwiseOR(F.shiftleft(F.col("n_bytes") - (WIDTH - 1), 1)).bitwiseOR(F.col("again").cast("long"))
    wanted = store.stage(_wanted(first.join(groups.hint("merge"), "mini").select("num", "mini", packed.alias("packed"))), "wanted")
    met = store.stage(texts.join(wanted.hint("merge"), "num").mapInArrow(_fetched, f"{PIECE_OF}, bytes binary"), "groups")
    store.discard(wanted)
    level = 0
    while True:
        large = store.stage(met.groupBy("mini").agg(F.sum("n_bytes").alias("weight")).where(
            F.col("weight") > GROUP).select("mini"), "large")
        small = met.join(large, "mini", "left_anti").select("doc", "tie", "start", "mini", "again", "bytes")
        found.append(store.stage(small.repartition("mini").sortWithinPartitions("mini").mapInArrow(_compare, SPAN), "spans"))
        if large.isEmpty():
            break
        level += 1
        pieces = store.stage(met.join(large, "mini", "left_semi").mapInArrow(
            _cut_again(level), f"{PIECE_OF}, digest binary, bytes binary"), "candidates")
        known = _led(pieces)
        store.discard(pieces)
        found.append(known.where("NOT leads").select(*columns))
        if level > LEVELS:  # pieces of one window: equal ones have been found, and no others can repeat
            break
        met = known.where("leads")
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def _cut(as_hash: bool, columns: list[str]):
    """Removes the bytes of the spans in `marks`; a size of -1 is the whole text."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.chunks(batches):
            data, bounds = words.bytes_of(batch.column("text"))
            marks = batch.column("marks")
            n = np.asarray(marks.value_lengths().fill_null(0), np.int64)
            row = np.repeat(np.arange(batch.num_rows), n)
            flat = marks.flatten()
            start, size = (np.asarray(flat.field(i), np.int64) for i in range(2))
            sizes = np.diff(bounds)
            size = np.where(size < 0, np.where(sizes[row] >= WIDTH, sizes[row], 0), size)
            cover = np.zeros(len(data) + 1, np.int64)
            np.add.at(cover, bounds[row] + start, 1)
            np.subtract.at(cover, bounds[row] + start + size, 1)
            gone = np.cumsum(cover)[:-1] > 0
            edge = np.ones(len(gone), bool)
            edge[1:] = ~gone[:-1]
            edge[bounds[:-1][sizes > 0]] = True
            total, begun = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, gone & edge))
            removed, spans_ = total[bounds[1:]] - total[bounds[:-1]], begun[bounds[1:]] - begun[bounds[:-1]]
            kept = data[~gone].tobytes()
            limits = (bounds - total[bounds]).tolist()
            parts = [kept[a:b] for a, b in zip(limits, limits[1:])]
            values = pa.array([hashlib.sha256(x).hexdigest() for x in parts], pa.string()) if as_hash else \
                pa.array(parts, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.select(columns).columns, *(pa.array(x.astype(np.int64)) for x in (sizes, removed, spans_)), values],
                names=[*columns, "n_bytes", "n_removed", "n_spans", "kept"])
    return rows


def remove(docs: DataFrame, as_hash: bool = False) -> DataFrame:
    """Per row of `docs`: the struct `row` of its columns, n_bytes, n_removed, n_spans, kept (the bytes that are left, or
    their SHA-256). Removed bytes may split a character, so what is left is binary."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc")
    known = [doc, F.xxhash64("text").alias("tie"), F.sha2("text", 256).alias("digest")]
    texts = docs.select(*known, "text").where(F.octet_length("text") >= WIDTH)
    # Copies are merged before the shuffle, so a text with very many is no more than one row per task.
    leaders = store.stage(texts.groupBy("digest").agg(
        F.min("doc").alias("doc"), F.first("tie").alias("tie"), F.first("text").alias("text"), F.count("*").alias("copies")).withColumn("num", F.monotonically_increasing_id()), "leaders")
    several = leaders.where("copies > 1").select("digest", F.col("doc").alias("leader"))
    marks = spans(leaders.select("num", "doc", "tie", "text")).unionByName(
        texts.select("doc", "tie", "digest").join(several, "digest").where("doc > leader").select(
            "doc", "tie", F.lit(0).cast("long").alias("start"), F.lit(-1).cast("long").alias("n_bytes")))
    marks = store.stage(marks.groupBy("doc", "tie").agg(F.collect_set(F.struct("start", "n_bytes")).alias("marks")), "marks")
    store.discard(leaders)
    # Columns pass through under names of their own, so that they clash with nothing; the text only once.
    named = {c: "text" if c == "text" else f"_own{i}" for i, c in enumerate(docs.columns) if c != "text" or not as_hash}
    rows = docs.select(*known[:2], "text", *(F.col(f"`{c}`").alias(n) for c, n in named.items() if c != "text"))
    flat = rows.join(marks.hint("merge"), ["doc", "tie"], "left").drop("doc", "tie")
    through = [c for c in flat.columns if c in named.values()]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema if f.name in through),
                        f"n_bytes long, n_removed long, n_spans long, kept {'string' if as_hash else 'binary'}"])
    cut = flat.mapInArrow(_cut(as_hash, through), schema)
    return cut.select(F.struct(*(F.col(n).alias(c) for c, n in named.items())).alias("row"), "n_bytes", "n_removed",
                      "n_spans", "kept")


def query(spark, sf_dir: str) -> DataFrame:
    cut = remove(store.table(spark, sf_dir, "documents").select("doc_id", "text"), as_hash=True)
    return cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").alias("kept_sha256"))


SQL = f"""
WITH b AS (SELECT doc_id, encode(coalesce(text, '')) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
win AS (
  SELECT doc_id, i, x[i + 1:i + {WIDTH}] AS g
  FROM (SELECT doc_id, x, unnest(range(0, n - {WIDTH - 1})) AS i FROM b WHERE n >= {WIDTH})),
later AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
islands AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {WIDTH} THEN 0 ELSE 1 END AS begins
  FROM later),
spans AS (
  SELECT doc_id, min(i) AS a, max(i) + {WIDTH} AS z
  FROM (SELECT doc_id, i, sum(begins) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM islands) GROUP BY doc_id, s),
kept AS (
  SELECT doc_id, max(k) AS k, max(number) AS number, sum(size) AS size FROM (
    SELECT doc_id, count(*) AS number, sum(z - a) AS size, NULL AS k FROM spans GROUP BY doc_id
    UNION ALL
    SELECT doc_id, NULL, NULL, string_agg(CASE WHEN z > a THEN hex(x[a + 1:z]) ELSE '' END, '' ORDER BY a) FROM (
      SELECT s.doc_id, lag(z, 1, 0) OVER (PARTITION BY s.doc_id ORDER BY a) AS a, a AS z FROM spans s
      UNION ALL SELECT spans.doc_id, max(z), max(b.n) FROM spans JOIN b USING (doc_id) GROUP BY spans.doc_id) g
    JOIN b USING (doc_id) GROUP BY doc_id) GROUP BY doc_id)
SELECT b.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(size, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(number, 0) AS BIGINT) AS n_spans,
       sha256(CASE WHEN k IS NULL THEN x ELSE unhex(k) END) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id)
"""
