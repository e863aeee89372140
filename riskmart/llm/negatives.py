"""Hard negatives by a vertical scan that branches and bounds over the dimensions (BOND).

Components become whole numbers, floor(256 * x); a score is the inner product with the anchor. An anchor's positives are
its first `POSITIVES` other rows of the same label, by higher score, then smaller vec_id. For each positive, the first
`NEGATIVES` rows of other labels whose score lies in the window from `LOW` to `HIGH` percent of the positive's follow.

1. Rows are dealt by hash into blocks of about `BLOCK`, each a matrix by column in one task; every block gets all
   anchors, the stated query set, as a stream. No task holds more than a block and a batch of anchors.
2. In a block an anchor reads the columns in descending magnitude of its own components, `STEP` at a time. What is left
   can add at most, and at least, the sum over the remaining columns of its component times the column's largest or
   smallest value. The candidate bitmap loses a row when these bounds show that
   * for positives: as many rows as are wanted are surely better;
   * for negatives: its score lies in no window, or in each as many rows as are wanted lie surely inside and above it.
   Rows that remain when all columns are read have exact scores, and the exact windows decide.
3. The best of all blocks are ranked per anchor, then per anchor and positive: a few rows per block each.

Defined cases: rows with a null label, a null vector or a component that is null or not finite take no part. Equal rows
(vec_id, label, vector) are one row; other rows of the same vec_id are rows of their own, ordered by a hash. Rows without
vec_id are no anchors and come after all others among equal scores. A shorter vector has zeros at its end, so an empty
one scores 0. Extra columns take no part; an empty table gives an empty result. Components so large that a score could
exceed 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm import store

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
SCALE = 256
EVERY = 100  # anchors are the rows whose vec_id is divisible by it
BLOCK, STEP = 8192, 8
LAST = 2**63 - 1  # stands for a null vec_id


def vectors(rows: DataFrame, label=None) -> DataFrame:
    """id (LAST for null), uid (hash of label and vector), label, v: rows that take part, equal ones once."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label") if label is None else label
    taken = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & usable).select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST)).alias("id"), label.cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long")).alias("v"))
    return taken.withColumn("uid", F.xxhash64("label", "v")).groupBy("id", "uid", "label", "v").agg(
        F.count("*").alias("copies")).drop("copies")


def relabelled(every: int = 7, labels: int = 10):
    """The registered query's labels: where vec_id is divisible by `every`, the next label."""
    return F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))


class Block:
    """Rows of one block by column."""

    def __init__(self, ids: np.ndarray, uids: np.ndarray, labels: np.ndarray, columns: np.ndarray):
        self.ids, self.uids, self.labels = ids, uids, labels
        self.width = columns.shape[0]
        self.columns = columns
        self.most, self.least = (f(axis=1) if columns.size else np.zeros(self.width, np.int64) for f in (columns.max, columns.min))
        self.reach = float(np.abs(columns.astype(float)).max()) if columns.size else 0.0
        self.exact = columns.astype(float)

    def scan(self, anchor: np.ndarray, rows: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """(rows left, their scores). `keep(at_least, at_most)` says which candidates stay, given bounds of their scores."""
        size = max(len(anchor), self.width)
        bound = float(np.abs(anchor.astype(float)).max(initial=0)) * self.reach * max(size, 1)
        if bound >= 2.0**63:
            raise OverflowError("scores do not fit 64 bits")
        # Whole numbers below 2**53 are exact as floats, which multiply faster.
        columns, kind = (self.exact, float) if bound < 2.0**53 else (self.columns, np.int64)
        anchor = anchor[:self.width].astype(kind)
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.least[:len(anchor)].astype(kind), anchor * self.most[:len(anchor)].astype(kind)])[:, order]
        rest = np.zeros((2, len(order) + 1), kind)
        rest[0, :-1], rest[1, :-1] = (np.cumsum(x[::-1])[::-1] for x in (ends.min(axis=0), ends.max(axis=0)))
        score = np.zeros(len(rows), kind)
        for begin in range(0, len(order), STEP):
            dims = order[begin:begin + STEP]
            # All rows are a contiguous matrix; few rows are gathered.
            part = columns[dims] if len(rows) == columns.shape[1] else columns[np.ix_(dims, rows)]
            score = score + anchor[dims] @ part
            at = min(begin + STEP, len(order))
            stay = keep(rows, score + rest[0, at], score + rest[1, at])
            if not stay.all():
                rows, score = rows[stay], score[stay]
            if not len(rows):
                break
        return rows, score.astype(np.int64)

    def _ranked(self, rows: np.ndarray, score: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.uids[rows], self.ids[rows], -score))[:n]
        return rows[order], score[order]

    def positives(self, anchor: np.ndarray, label: int, own: tuple[int, int], n: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the block's first `n` rows of the label, the anchor's own row left out."""
        rows = np.flatnonzero((self.labels == label) & ~((self.ids == own[0]) & (self.uids == own[1])))

        def keep(_, at_least, at_most):
            if len(at_least) <= n:
                return np.ones(len(at_least), bool)
            return at_most >= np.partition(at_least, -n)[-n]
        return self._ranked(*self.scan(anchor, rows, keep), n)

    def negatives(self, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window (least and greatest score): (rows, scores) of the block's first `n` rows of other labels in it."""
        rows = np.flatnonzero(self.labels != label)

        def keep(_, at_least, at_most):
            wanted = np.zeros(len(at_least), bool)
            for low, high in windows:
                may = (at_most >= low) & (at_least <= high)
                sure = at_least[(at_least >= low) & (at_most <= high)]
                if len(sure) > n:
                    may &= at_most >= np.partition(sure, -n)[-n]
                wanted |= may
            return wanted
        rows, score = self.scan(anchor, rows, keep)
        return [self._ranked(rows[inside], score[inside], n)
                for inside in ((score >= low) & (score <= high) for low, high in windows)]


def window(positive: int) -> tuple[int, int]:
    """Least and greatest whole score that lies in a positive's window."""
    return -(-LOW * positive // 100), HIGH * positive // 100


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """(rows, width): vectors, with zeros at the end of shorter ones."""
    sizes = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), width), np.int64)
    flat = np.asarray(column.flatten())
    if len(column) and (sizes == width).all():
        return flat.reshape(len(column), width)
    ends = np.cumsum(sizes)
    for i, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist())):
        out[i, :size] = flat[end - size:end]
    return out


def _scan(answer):
    """Batches sorted by block, its rows before the anchors: `answer(block, anchors)` gives the records of a batch."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, block, now = [], None, None
        for batch in batches:
            number, anchor = np.asarray(batch.column("block")), np.asarray(batch.column("anchor"))
            cuts = np.flatnonzero((number[1:] != number[:-1]) | (anchor[1:] != anchor[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(number)]):
                part = batch.slice(a, b - a)
                if number[a] != now:
                    waiting, block, now = [], None, number[a]
                if not anchor[a]:
                    waiting.append(part)
                    continue
                if block is None:
                    block = _block(waiting)
                    waiting = []
                yield answer(block, part)
    return rows


def _block(parts: list[pa.RecordBatch]) -> Block:
    if not parts:
        none = np.zeros(0, np.int64)
        return Block(none, none, none, np.zeros((0, 0), np.int64))
    table = pa.Table.from_batches(parts).combine_chunks()
    v = table.column("v").combine_chunks()
    width = int(np.diff(np.asarray(v.offsets)).max())
    return Block(*(np.asarray(table.column(c)) for c in ("id", "uid", "label")), np.ascontiguousarray(_matrix(v, width).T))


def _anchors(part: pa.RecordBatch):
    v = part.column("v")
    bounds, flat = np.asarray(v.offsets), np.asarray(v.values)
    for i, key in enumerate(zip(*(part.column(c).to_pylist() for c in ("id", "uid", "label")))):
        yield i, key, flat[bounds[i]:bounds[i + 1]]


FOUND = "anchor_id long, anchor_uid long, positive_id long, positive_uid long, positive_score long"
HARD = f"{FOUND}, negative_id long, negative_uid long, negative_score long"


def _records(columns: list[list[np.ndarray]], schema: str) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    arrays = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=names)


def _positives(n: int):
    def answer(block: Block, part: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(5)]
        for _, (vec, uid, label), anchor in _anchors(part):
            rows, score = block.positives(anchor, label, (vec, uid), n)
            for column, values in zip(columns, (np.full(len(rows), vec), np.full(len(rows), uid), block.ids[rows],
                                                block.uids[rows], score)):
                column.append(values)
        return _records(columns, FOUND)
    return _scan(answer)


def _negatives(n: int):
    def answer(block: Block, part: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(8)]
        wanted = part.column("positives").to_pylist()
        for i, (vec, uid, label), anchor in _anchors(part):
            windows = [window(p["positive_score"]) for p in wanted[i]]
            for p, (rows, score) in zip(wanted[i], block.negatives(anchor, label, windows, n)):
                same = (vec, uid, p["positive_id"], p["positive_uid"], p["positive_score"])
                for column, values in zip(columns, [*(np.full(len(rows), x) for x in same), block.ids[rows],
                                                    block.uids[rows], score]):
                    column.append(values)
        return _records(columns, HARD)
    return _scan(answer)


def _met(rows: DataFrame, anchors: DataFrame, blocks: int, extra: list[str]) -> DataFrame:
    """Rows of each block before the anchors, which every block gets."""
    none = {f.name: F.lit(None).cast(f.dataType) for f in anchors.schema}
    data = rows.select(F.pmod(F.xxhash64("id", "uid"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("anchor"),
                       "id", "uid", "label", "v", *(none[c].alias(c) for c in extra))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("anchor"),
                           "id", "uid", "label", "v", *extra)
    return data.unionByName(asked).repartition("block").sortWithinPartitions("block", "anchor")


def _first(found: DataFrame, keys: list[str], score: str, name: str, n: int) -> DataFrame:
    """The first `n` rows per key by score, id and hash, with `rank` from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), f"{name}_id", f"{name}_uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(rows: DataFrame, label=None, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ids are null where vec_id is."""
    taken = store.stage(vectors(rows, label), "vectors")
    blocks = max(1, -(-taken.count() // BLOCK))
    anchors = taken.where((F.col("id") != LAST) & (F.col("id") % EVERY == 0))
    found = _met(taken, anchors, blocks, []).mapInArrow(_positives(positives), FOUND)
    best = _first(found, ["anchor_id", "anchor_uid"], "positive_score", "positive", positives)
    # A negative positive's window is empty, since its limits change places.
    asked = best.where("positive_score >= 0").groupBy("anchor_id", "anchor_uid").agg(F.collect_list(F.struct(
        "positive_id", "positive_uid", "positive_score")).alias("positives"))
    asked = store.stage(anchors.join(asked, (F.col("id") == F.col("anchor_id")) & (F.col("uid") == F.col("anchor_uid"))).drop(
        "anchor_id", "anchor_uid"), "positives")
    hard = _met(taken, asked, blocks, ["positives"]).mapInArrow(_negatives(negatives), HARD)
    pair = ["anchor_id", "anchor_uid", "positive_id", "positive_uid", "positive_score"]
    shown = (F.when(F.col(c) != LAST, F.col(c)).alias(c) for c in ("positive_id", "negative_id"))
    return _first(hard, pair, "negative_score", "negative", negatives).select(
        "anchor_id", *shown, F.col("rank").cast("int").alias("rank"), "positive_score", "negative_score")


def query(spark, sf_dir: str) -> DataFrame:
    return mine(store.table(spark, sf_dir, "embeddings"), relabelled())


SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= {POSITIVES})
SELECT p.a AS anchor_id, p.b AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INTEGER) AS rank,
       s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score
QUALIFY rank <= {NEGATIVES}
"""
