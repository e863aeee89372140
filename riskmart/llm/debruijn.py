"""Removal of passages that repeat across documents, on a De Bruijn graph of their words.

Words are runs of characters that are no ASCII white space, as they are. A window of `K` words is an edge from the node
of its first K - 1 words to the node of its last K - 1 words; a node is a 64-bit hash, an edge the pair. An edge is
repeated if it occurs in two documents; its source is its place in the document with the smallest doc_id. In every other
document each word under a repeated edge is removed.

Steps, none of which gathers more than one document's own words in a place:
0. Copies: texts are known by two hashes. Of equal texts the document with the smallest doc_id leads; in the others
   every window repeats, so they need no graph.
1. Sieve: of each window only its minimizer, the smallest hash of `MINI` words in it, is counted. Equal windows have
   equal minimizers, and neighbours share theirs, so a quarter of the windows' number is shuffled, pre-aggregated. Only
   windows of leaders whose minimizer occurs in two different texts go on.
2. Edges: windows that are left are aggregated to edges with their source, again partially before the shuffle.
3. Compaction: nodes with more than one edge in or out are found by aggregation and joined to the edges; edges that
   follow one another in a source without such a node between form one path.
4. Spans: windows join edges; those that follow one another in a document and along a path become one span (start,
   n_words, source document, start there). A document's spans meet its text once, where covered words leave.
5. Verification: every span's words are compared with those at its source coordinates, by a digest of the words. If any
   differ, two passages share hashes, and all is done again under another seed, of which the word hashes depend.

Defined cases: null text has no words; documents of fewer than K words lose none; null doc_id comes after all others, and
such documents do not repeat one another; rows with the same doc_id do not repeat one another either; an empty table
gives an empty result; extra columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm import store, words

K = 13
MINI = 7
SEEDS = 3  # further ones that are tried
LAST = 2**63 - 1  # stands for a null doc_id

SPAN = "struct<start: long, n_words: long, src_doc: long, src_start: long, digest: binary>"
KEPT = f"n_words long, n_removed long, kept string, spans array<{SPAN}>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("n_words", pa.int64()), ("src_doc", pa.int64()),
                             ("src_start", pa.int64()), ("digest", pa.binary())]))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _longs(column: pa.Array) -> np.ndarray:
    return np.asarray(column, np.int64)


class Windows:
    """Windows of the texts of a chunk: start (word index), text, nodes and minimizer."""

    def __init__(self, texts: pa.Array, seed: int):
        self.words = found = words.find(texts, seed=seed)
        hashes = found.hashes
        text = found.text_of
        at = np.arange(len(hashes))
        self.at = at = at[at + K <= found.bounds[1:][text]] if len(at) else at
        self.text = text[at]
        node, small = words.gram_hashes(hashes, K - 1), words.gram_hashes(hashes, MINI)
        least, width = small, 1
        while width < K - MINI + 1:  # least of 1, 2, 4, ... and at last K - MINI + 1 neighbours
            step = min(width, K - MINI + 1 - width)
            least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
            width += step
        self.begin, self.end, self.mini = node[at], node[at + 1] if len(at) else node[:0], least[at]

    def minimizers(self) -> tuple[np.ndarray, np.ndarray]:
        """(minimizer, text), once for neighbours that share it."""
        new = np.ones(len(self.at), bool)
        new[1:] = (self.mini[1:] != self.mini[:-1]) | (self.text[1:] != self.text[:-1])
        return self.mini[new], self.text[new]


def _sieve(seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.chunks(batches):
            mini, text = Windows(batch.column("text"), seed).minimizers()
            if len(mini):
                own = _longs(batch.column("h1"))[text]
                order = np.lexsort((own, mini))
                mini, own = mini[order], own[order]
                first = np.flatnonzero(np.concatenate([[True], mini[1:] != mini[:-1]]))
                last = np.concatenate([first[1:], [len(mini)]]) - 1
                yield pa.RecordBatch.from_arrays([_long(mini[first]), _long(own[first]), _long(own[last])],
                                                 names=["mini", "low", "high"])
    return rows


def _own(seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.chunks(batches):
            mini, text = Windows(batch.column("text"), seed).minimizers()
            yield pa.RecordBatch.from_arrays([_long(mini), _long(_longs(batch.column("h1"))[text])],
                                             names=["mini", "h1"])
    return rows


def _flat(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """(row of each element, elements) of a list column."""
    import pyarrow.compute as pc
    n = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    return np.repeat(np.arange(len(column)), n), pc.list_flatten(column)


def _candidates(seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.chunks(batches):
            windows = Windows(batch.column("text"), seed)
            row, mini = _flat(batch.column("minis"))
            mark = words.mix(_longs(mini).view(np.uint64) ^ words.mix(row.astype(np.uint64)))
            own = words.mix(windows.mini ^ words.mix(windows.text.astype(np.uint64)))
            hit = np.isin(own, mark)  # a chance hit only lets one window more through
            place = windows.at - windows.words.bounds[windows.text]
            row = windows.text[hit]
            yield pa.RecordBatch.from_arrays(
                [_long(_longs(batch.column("doc"))[row]), pa.array(np.asarray(batch.column("version"), np.int32)[row]),
                 pa.array(place[hit].astype(np.int32)), _long(windows.begin[hit]), _long(windows.end[hit])],
                names=["doc", "version", "pos", "head", "tail"])
    return rows


def edges(texts: DataFrame, classes: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(windows of leaders that may repeat, repeated edges with their source); `texts` has doc, text, h1 and h2."""
    sieved = texts.select("text", "h1").mapInArrow(_sieve(seed), "mini long, low long, high long")
    common = store.stage(sieved.groupBy("mini").agg(F.min("low").alias("low"), F.max("high").alias("high"))
                         .where("low < high").select("mini"), "common")
    own = texts.select("text", "h1").mapInArrow(_own(seed), "mini long, h1 long").join(common, "mini")
    own = store.stage(own.groupBy("h1").agg(F.collect_set("mini").alias("minis")), "minis")
    leaders = classes.join(own, "h1").select(F.col("leader").alias("doc"), "version", "h1", "h2", "minis")
    # What grows with the documents is never broadcast, so that plans are the same at every size.
    windows = store.stage(texts.join(leaders.hint("merge"), ["doc", "h1", "h2"]).select("doc", "version", "text", "minis").mapInArrow(
        _candidates(seed), "doc long, version int, pos int, head long, tail long"), "windows")
    found = windows.groupBy("head", "tail").agg(
        F.min("doc").alias("src_doc"), F.max("doc").alias("high"), F.min_by("pos", "doc").alias("src_pos"))
    found = store.stage(found.where("src_doc < high").drop("high"), "edges")
    store.discard(common)
    store.discard(own)
    return windows, found


def paths(found: DataFrame) -> DataFrame:
    """Edges with `path`, the source position where their nonbranching path begins."""
    sides = [found.select(F.col(c).alias("node"), F.lit(int(c == "head")).alias("out"), F.lit(int(c == "tail")).alias("in"))
             for c in ("head", "tail")]
    forks = (sides[0].unionByName(sides[1]).groupBy("node").agg(F.sum("out").alias("out"), F.sum("in").alias("in"))
             .where("out > 1 OR in > 1").select("node", F.lit(True).alias("fork")))
    source = Window.partitionBy("src_doc").orderBy("src_pos")
    follows = (F.lag("src_pos").over(source) == F.col("src_pos") - 1) & F.col("fork").isNull()
    joined = found.join(forks, found["head"] == forks["node"], "left").drop("node")
    begins = joined.withColumn("begins", ~F.coalesce(follows, F.lit(False)))
    run = source.rowsBetween(Window.unboundedPreceding, 0)
    return begins.withColumn("path", F.max(F.when(F.col("begins"), F.col("src_pos"))).over(run)).drop("fork", "begins")


def spans(windows: DataFrame, found: DataFrame) -> DataFrame:
    """(doc, version, start, n_words, src_doc, src_start): runs of repeated windows along one path; start in words from 0.

    Windows meet edges by one hash of both nodes, to shuffle less; that a span's words are its source's is verified.
    """
    edge = F.xxhash64("head", "tail").alias("edge")
    known = paths(found).select(edge, "src_doc", "src_pos", "path")
    marked = windows.select(edge, "doc", "version", "pos").join(known, "edge").where("doc > src_doc").drop("edge")
    text = Window.partitionBy("doc", "version").orderBy("pos")
    step = F.col("pos") - F.lag("pos").over(text)
    follows = ((step <= 1) & (F.col("src_pos") - F.lag("src_pos").over(text) == step)
               & (F.lag("src_doc").over(text) == F.col("src_doc")) & (F.lag("path").over(text) == F.col("path")))
    begins = marked.withColumn("begins", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
    run = F.sum("begins").over(text.rowsBetween(Window.unboundedPreceding, 0))
    return begins.withColumn("run", run).groupBy("doc", "version", "run").agg(
        F.min("pos").cast("long").alias("start"), (F.max("pos") - F.min("pos") + K).cast("long").alias("n_words"),
        F.min("src_doc").alias("src_doc"), F.min("src_pos").cast("long").alias("src_start")).drop("run")


def joined_words(found: words.Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, bounds by text, begin of each kept word): the kept words of each text with one space between them."""
    starts, ends = found.starts[keep], found.ends[keep]
    text = found.text_of[keep]
    lead = np.zeros(len(starts), np.int64)
    lead[1:] = text[1:] == text[:-1]  # a space before all but a text's first word
    sizes = ends - starts
    stops = np.cumsum(sizes + lead)
    begins = stops - sizes
    out = np.full(int(stops[-1]) if len(stops) else 0, 0x20, np.uint8)
    steps = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(begins, sizes) + steps] = found.data[np.repeat(starts, sizes) + steps]
    bounds = np.concatenate([[0], stops])[np.searchsorted(text, np.arange(len(found.bounds)))]
    return out, bounds, begins


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _cut(as_hash: bool, columns: list[str]):
    """Removes the words of the spans in `marks`, -1 words being all; `kept` is what is left, or its SHA-256."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.chunks(batches):
            found = words.find(batch.column("text"), hashed=False)
            row, marks = _flat(batch.column("marks"))
            start, n, src_doc, src_start = (_longs(marks.field(i)) for i in range(4))
            n = np.where(n < 0, found.counts[row], n)
            usable = (n >= K) & (start + n <= found.counts[row])
            row, start, n, src_doc, src_start = (x[usable] for x in (row, start, n, src_doc, src_start))
            first = found.bounds[row] + start
            cover = np.zeros(len(found.starts) + 1, np.int64)
            np.add.at(cover, first, 1)
            np.subtract.at(cover, first + n, 1)
            gone = np.cumsum(cover[:-1]) > 0
            whole, _, begins = joined_words(found, np.ones(len(gone), bool))
            whole, finish = memoryview(whole.tobytes()), begins + (found.ends - found.starts)
            listed: list[list] = [[] for _ in range(batch.num_rows)]
            for t, a, w, m, d, z in zip(*(x.tolist() for x in (row, first, start, n, src_doc, src_start))):
                listed[t].append({"start": w, "n_words": m, "src_doc": d, "src_start": z,
                                  "digest": _digest(whole[begins[a]:finish[a + m - 1]])})
            kept, bounds, _ = joined_words(found, ~gone)
            limits, kept = bounds.tolist(), kept.tobytes()
            texts = [kept[a:b] for a, b in zip(limits, limits[1:])]
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[found.bounds])
            values = [hashlib.sha256(x).hexdigest() for x in texts] if as_hash else [x.decode() for x in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(columns).columns, _long(found.counts), _long(removed), pa.array(values, pa.string()),
                 pa.array(listed, _SPANS)], names=[*columns, "n_words", "n_removed", "kept", "spans"])
    return rows


def _source_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in words.chunks(batches):
        found = words.find(batch.column("text"))
        whole, _, begins = joined_words(found, np.ones(len(found.starts), bool))
        whole, finish = memoryview(whole.tobytes()), begins + (found.ends - found.starts)
        row, spans = _flat(batch.column("wanted"))
        start, n = (_longs(spans.field(i)) for i in range(2))
        first = found.bounds[row] + start
        last = first + n - 1
        inside = last < found.bounds[row + 1]
        doc = _longs(batch.column("doc"))[row]
        yield pa.RecordBatch.from_arrays(
            [_long(doc[inside]), _long(start[inside]), _long(n[inside]),
             pa.array([_digest(whole[begins[a]:finish[b]]) for a, b in
                       zip(first[inside].tolist(), last[inside].tolist())], pa.binary())],
            names=["src_doc", "src_start", "n_words", "digest"])


def unverified(claimed: DataFrame, texts: DataFrame) -> int:
    """How many spans have words other than those at their source coordinates."""
    keys = ["src_doc", "src_start", "n_words", "digest"]
    claims = store.stage(claimed.select(*keys).distinct(), "claims")
    wanted = claims.groupBy(F.col("src_doc").alias("doc")).agg(F.collect_set(F.struct("src_start", "n_words")).alias("wanted"))
    true = texts.join(wanted.hint("merge"), "doc").select("doc", "text", "wanted").mapInArrow(
        _source_digests, "src_doc long, src_start long, n_words long, digest binary")
    return claims.join(true, keys, "left_anti").count()


def remove(docs: DataFrame, as_hash: bool = False, seed: int = 0) -> DataFrame:
    """Per row of `docs`: the struct `row` of its columns, n_words, n_removed, kept and spans (see the module)."""
    # Chained hashes of several values depend on the first alone, so the seed comes before the text.
    known = [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), "text",
             F.xxhash64(F.lit(1), "text").alias("h1"), F.xxhash64(F.lit(2), "text").alias("h2")]
    texts = docs.select(*known)
    classes = texts.groupBy("h1", "h2").agg(F.min("doc").alias("leader"))
    # Texts that share a leading doc_id, which tables should not have, are told apart by a small number.
    version = F.row_number().over(Window.partitionBy("leader").orderBy("h1", "h2"))
    classes = store.stage(classes.withColumn("version", version), "classes")
    windows, found = edges(texts, classes, seed)
    runs = store.stage(spans(windows, found), "spans")
    store.discard(windows)
    store.discard(found)
    mark = ["start", "n_words", "src_doc", "src_start"]
    copies = texts.select("doc", "h1", "h2").join(classes, ["h1", "h2"]).where("doc > leader").select(
        "doc", "h1", F.lit(0).cast("long").alias("start"), F.lit(-1).cast("long").alias("n_words"),
        F.col("leader").alias("src_doc"), F.lit(0).cast("long").alias("src_start"))
    led = classes.select(F.col("leader").alias("doc"), "version", "h1")
    marks = runs.join(led, ["doc", "version"]).select("doc", "h1", *mark).unionByName(copies).groupBy("doc", "h1").agg(
        F.collect_set(F.struct(*mark)).alias("marks"))
    marks = store.stage(marks, "marks")
    store.discard(runs)
    checked = store.stage(_cut_rows(docs.select("doc_id", "text"), known, marks, True), "cut")
    if unverified(checked.select(F.explode("spans").alias("s")).select("s.*"), texts.select("doc", "text")):
        if seed >= SEEDS:
            raise RuntimeError(f"passages share their hashes under {SEEDS + 1} seeds")
        return remove(docs, as_hash, seed + 1)
    return checked if as_hash else _cut_rows(docs, known, marks, False)


def _cut_rows(docs: DataFrame, known: list, marks: DataFrame, as_hash: bool) -> DataFrame:
    """Rows with their own columns in the struct `row`. Texts are shuffled once, marks are few; never broadcast."""
    # Columns pass through under names of their own, so that they clash with nothing; the text only once.
    named = {c: "text" if c == "text" else f"_own{i}" for i, c in enumerate(docs.columns) if c != "text" or not as_hash}
    rows = docs.select(*known[:3], *(F.col(f"`{c}`").alias(n) for c, n in named.items() if c != "text"))
    flat = rows.join(marks.hint("merge"), ["doc", "h1"], "left").drop("doc", "h1")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema if f.name in named.values()), KEPT])
    cut = flat.mapInArrow(_cut(as_hash, [x for x in flat.columns if x in named.values()]), schema)
    return cut.select(F.struct(*(F.col(n).alias(c) for c, n in named.items())).alias("row"), "n_words", "n_removed",
                      "kept", "spans")


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows with their own columns; a text that lost words is what is left of it, and goes if nothing is."""
    cut = remove(docs)
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text")).alias("text")
    length = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("row.n_chars")).alias("n_chars") \
        if "n_chars" in docs.columns else None
    changed = {"text": text, "n_chars": length}
    return cut.where("n_removed = 0 OR n_removed < n_words").select(
        *(changed.get(c) if changed.get(c) is not None else o for c, o in zip(docs.columns, own)))


def query(spark, sf_dir: str) -> DataFrame:
    cut = remove(store.table(spark, sf_dir, "documents"), as_hash=True)
    return cut.select("row.doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


SQL = rf"""
WITH m AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, list_slice(w, i, i + {K - 1}) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {K - 2})) AS i FROM m WHERE len(w) >= {K})),
src AS (SELECT g, min(doc_id) AS d FROM win GROUP BY g),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps
  FROM (SELECT doc_id, unnest(range(i, i + {K})) AS p FROM win JOIN src USING (g) WHERE doc_id > d) GROUP BY doc_id),
kept AS (
  SELECT m.doc_id, w, coalesce(len(ps), 0) AS n,
         CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END AS k
  FROM m LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed,
       sha256(coalesce(list_aggregate(k, 'string_agg', ' '), '')) AS kept_sha256
FROM kept
"""
