"""Near-duplicate documents by chosen-path set similarity join.

A document's set: hashes of the distinct windows of `K` words of its lower-cased (A-Z) text, words being runs of
characters that are no ASCII white space; a shorter document's whole sequence is its only element. Two documents are
linked if 100 * intersection >= 75 * union of their sets.

A document is known by its doc_id and the hash of its text (`key`), so that rows without doc_id, or with one repeated
doc_id, stay apart unless their texts are equal. Keys are ordered by doc_id first.

1. Each document gets `COORDINATES` minwise tokens of its set. Documents with equal sets are one class, led by the
   smallest key; only leaders go on, so exact copies cost one aggregation.
2. `TREES` independent trees: the root branches leaders by two minwise tokens of its own. In nodes with more than `LEAF`
   documents, or texts too large for a task, a pivot first settles what one comparison can (see `pivoted`); near copies,
   which would follow one another down every branch, end here. What is left branches by `BRANCH` tokens chosen by the
   node's hash, each child agreeing on one, if no child keeps more than half of its node; else, and at `DEPTH`, the node is
   split into blocks and every pair of blocks is compared. So rows at most double from a level to the next.
3. Small nodes are compared exhaustively, once for equal sets of members: sizes of all intersections of full sets. A
   node yields a spanning forest of its links, never its pairs.
4. Links are closed to components; the document with the smallest key of each is kept.

Two linked documents agree on a token with a probability of at least 0.75, so a tree misses them with at most 0.4375
and all of them with 0.4375 ** TREES = 1.8e-6; each further branching of a large node loses 0.25 ** BRANCH of a tree.

Defined cases: documents without words are linked with nothing and kept; null doc_id comes after all others; rows of one
doc_id, or without one, count as one document if their texts are equal, else as several; an empty table gives an empty result; extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm import components, store, words

K = 5
PERCENT = 75
TREES, COORDINATES, BRANCH, DEPTH = 16, 48, 4, 12
LEAF, LEAF_SHINGLES, FEW = 2048, 3_000_000, 8
LAST = 2**63 - 1  # stands for a null doc_id
KEY = "struct<doc: bigint, hash: bigint>"
_DENSE = 16  # elements in at least so many sets of a node are counted by a matrix product
_SLICE = 4096  # of so many elements at once

_ODD = words.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(words.BASE)) | np.uint64(1)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, element) of the sets of all texts, sorted, without repetitions."""
    found = words.find(texts, words.SPACES, words.LOWER)
    at, keys = found.grams(K)
    rows = [found.text_of[at]]
    keys = [keys]
    counts = found.counts
    for n in range(1, K):
        short = np.flatnonzero(counts == n)
        rows.append(short)
        keys.append(words.gram_hashes(found.hashes, n)[found.bounds[short]])
    row, key = np.concatenate(rows), np.concatenate(keys)
    out = []
    for r, mine in zip(*_split(row, key)):
        mine = np.unique(mine)
        out.append((np.full(len(mine), r), mine))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def _split(row: np.ndarray, key: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    if not len(row):
        return [], []
    order = np.argsort(row, kind="stable")
    row, key = row[order], key[order]
    edges = np.flatnonzero(np.diff(row)) + 1
    return row[np.concatenate([[0], edges])].tolist(), np.split(key, edges)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in words.chunks(batches):
        row, key = shingles(batch.column("text"))
        n = np.bincount(row, minlength=batch.num_rows)
        full = np.flatnonzero(n)
        begins = (np.cumsum(n) - n)[full]
        tokens = np.zeros((batch.num_rows, COORDINATES), np.int32)
        total = np.zeros((2, batch.num_rows), np.uint64)
        if len(full):
            for j, odd in enumerate(_ODD):
                least = words.mix(np.minimum.reduceat(key * odd, begins))
                tokens[full, j] = least.astype(np.uint32).view(np.int32)
            for j in range(2):
                total[j, full] = np.add.reduceat(words.mix(key ^ words.power(j + 3)), begins)
        flat = pa.array(tokens.reshape(-1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n.astype(np.int64)), *(pa.array(x.view(np.int64)) for x in total),
             pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * COORDINATES), flat)],
            names=["id", "n", "h1", "h2", "tokens"])


def _against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by pivot, salt and `member`: a pivot's text, then those of members. How near each is to its pivot."""
    now, mine = None, np.zeros(0, np.uint64)
    for batch in words.chunks(batches):
        row, key = shingles(batch.column("text"))
        n = np.bincount(row, minlength=batch.num_rows)
        bounds = np.concatenate([[0], np.cumsum(n)])
        places = list(zip(*(batch.column(c).to_pylist() for c in ("pivot", "salt", "member"))))
        common, of = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for i, (pivot, salt, member) in enumerate(places):
            own = key[bounds[i]:bounds[i + 1]]
            if not member:
                now, mine = (pivot, salt), own
            common[i], of[i] = len(np.intersect1d(own, mine, assume_unique=True)), len(mine)
        keep = pa.array([member for _, _, member in places])
        union = n + of - common
        found = pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("pivot"), pa.array(100 * common >= PERCENT * union),
             pa.array(1 - common / np.maximum(union, 1))], names=["id", "pivot", "linked", "distance"])
        yield found.filter(keep)


def pivoted(rows: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that are left, links (a, b)): members of large nodes that one comparison settles leave, without a loss.

    Every member is compared with its node's pivot on full sets. One minus similarity is a metric: a member nearer to
    the pivot than the nearest unlinked member less the limit can be linked with none of the unlinked ones, and with
    the others the pivot links it. Nodes of near copies, which branching does not shrink, dissolve this way. The pivot is
    the member with the least hash, mostly the same in all trees, so a pair is compared once. Its members are dealt over tasks.
    """
    pivots = rows.groupBy("node").agg(F.min_by("id", F.xxhash64("id")).alias("pivot"))
    asked = rows.join(pivots, "node")
    pairs = store.stage(asked.where("id <> pivot").select("id", "pivot").distinct(), "pivots")
    salts = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / LEAF).cast("int").alias("salts"))
    members = pairs.join(salts, "pivot").select(
        "id", "pivot", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), F.lit(True).alias("member"))
    heads = salts.select(F.col("pivot").alias("id"), "pivot", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                         F.lit(False).alias("member"))
    # Only texts that are asked for are shuffled, if Spark sees that the stored list of their ids is small enough to broadcast.
    wanted = store.stage(pairs.select("id").unionByName(pairs.select(F.col("pivot").alias("id"))).distinct(), "wanted")
    picked = texts.join(wanted, "id", "left_semi").groupBy("id").agg(F.first("text").alias("text"))
    met = members.unionByName(heads).hint("merge").join(picked, "id").select("id", "pivot", "salt", "member", "text")
    near = store.stage(met.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "member").mapInArrow(
        _against, f"id {KEY}, pivot {KEY}, linked boolean, distance double"), "near")
    for table in (pairs, wanted):
        store.discard(table)
    judged_ = asked.join(near, ["id", "pivot"], "left").select(
        "node", "id", "n", F.coalesce("linked", F.lit(True)).alias("linked"), F.coalesce("distance", F.lit(0.0)).alias("distance"))
    nearest = judged_.groupBy("node").agg(F.min(F.when(~F.col("linked"), F.col("distance"))).alias("nearest"))
    settled = F.col("linked") & (F.col("nearest").isNull() | (F.col("distance") < F.col("nearest") - (100 - PERCENT) / 100 - 1e-9))
    left = store.stage(judged_.join(nearest, "node").where(~settled).select("node", "id", "n"), "left")
    return left, near.where("linked").select(F.col("id").alias("a"), F.col("pivot").alias("b"))


def _sized(rows: DataFrame) -> DataFrame:
    """Stored rows of nodes with at least two members; `small` nodes are for one task, `weight` is in shingles."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("members"), F.sum("n").alias("weight")).where("members > 1")
    small = F.expr(f"(members <= {LEAF} AND weight <= {LEAF_SHINGLES}) OR members <= {FEW}")
    return store.stage(rows.join(sizes.withColumn("small", small), "node"), "nodes")


def _block_pairs(rows: DataFrame) -> DataFrame:
    """(node, id) of all pairs of blocks of each node: the exact way for nodes that nothing makes smaller."""
    blocks = F.ceil(F.greatest(F.col("members") * 2 / LEAF, F.col("weight") * 2 / LEAF_SHINGLES)).cast("int")
    dealt = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                       lambda other: F.xxhash64("node", F.least("block", other), F.greatest("block", other)))
    return dealt.select(F.explode(pair).alias("node"), "id")


def leaves(leaders: DataFrame, texts: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """((node, id): members of all nodes that are small enough to be compared, at least two each; links found before)."""
    keys = [F.xxhash64(F.lit(t), F.col("tokens")[2 * t], F.col("tokens")[2 * t + 1]) for t in range(TREES)]
    rows = _sized(leaders.select("id", "n", F.explode(F.array(*keys)).alias("node")))
    levels, found, links = [rows], [rows.where("small").select("node", "id")], []
    for depth in range(DEPTH):
        large = rows.where("NOT small")
        if large.isEmpty():
            break
        left, settled = pivoted(large.select("node", "id", "n"), texts)
        links.append(settled)
        rows = _sized(left)
        levels += [left, rows]
        found.append(rows.where("small").select("node", "id"))
        large = rows.where("NOT small")
        choice = [F.pmod(F.xxhash64("node", F.lit(c)), F.lit(COORDINATES)).cast("int") for c in range(BRANCH)]
        child = [F.xxhash64("node", i, F.get("tokens", i)) for i in choice]
        children = large.join(leaders.select("id", "tokens"), "id").select(
            "id", "n", "members", F.col("node").alias("parent"), F.explode(F.array_distinct(F.array(*child))).alias("node"))
        # A node whose child keeps more than half of it would only multiply; so would any at the last level.
        most = children.groupBy("parent", "node").agg(F.count("*").alias("kept"), F.max("members").alias("members")).groupBy(
            "parent").agg((F.max(2 * F.col("kept") - F.col("members")) > 0).alias("stays")).select("parent", "stays")
        if depth == DEPTH - 1:
            most = most.withColumn("stays", F.lit(True))
        most = store.stage(most, "branches")
        levels.append(most)
        stays = most.where("stays").select(F.col("parent").alias("node"))
        found.append(_block_pairs(large.join(stays, "node", "left_semi")))
        rows = _sized(children.join(most.where("NOT stays").select("parent"), "parent", "left_semi").select("id", "n", "node"))
        levels.append(rows)
        found.append(rows.where("small").select("node", "id"))
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    members = result.groupBy("node").agg(F.sort_array(F.collect_set("id")).alias("ids")).where(F.size("ids") > 1)
    distinct = members.groupBy("ids").agg(F.min("node").alias("node")).select("node", F.explode("ids").alias("id"))
    distinct = store.stage(distinct, "leaves")
    for table in levels:
        store.discard(table)
    return distinct, links


def links_of(node: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, smaller row) of a spanning forest of the links inside each node; rows of a node are side by side."""
    row, key = shingles(texts)
    n = np.bincount(row, minlength=len(node))
    key = words.mix(key + words.mix(node.view(np.uint64))[row])
    order = np.argsort(key, kind="stable")
    row, key = row[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    often = np.bincount(group)[group] if len(group) else group
    light, heavy = (often > 1) & (often < _DENSE), often >= _DENSE
    codes = []
    r, g = row[light], group[light]
    for step in range(1, _DENSE - 1):
        same = np.flatnonzero(g[step:] == g[:-step]) if len(g) > step else np.zeros(0, np.int64)
        a, b = r[same], r[same + step]
        codes.append(np.minimum(a, b) * len(node) + np.maximum(a, b))
    code, common = np.unique(np.concatenate(codes), return_counts=True)
    left, right = code // len(node), code % len(node)
    linked = [_similar(left, right, common, n)]
    by_row = np.argsort(row[heavy], kind="stable")
    r, g = row[heavy][by_row], group[heavy][by_row]
    extra_by = np.argsort(left, kind="stable")
    left, right, common = left[extra_by], right[extra_by], common[extra_by]
    edges = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1], [True]]))
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()) if len(r) else []:
        low, high = np.searchsorted(r, [begin, end])
        if low == high:
            continue
        columns, column = np.unique(g[low:high], return_inverse=True)
        both = np.zeros((end - begin, end - begin))
        by_column = np.argsort(column, kind="stable")
        column, of = column[by_column], r[low:high][by_column] - begin
        for first in range(0, len(columns), _SLICE):
            x, y = np.searchsorted(column, [first, first + _SLICE])
            matrix = np.zeros((end - begin, min(_SLICE, len(columns) - first)), np.float32)
            matrix[of[x:y], column[x:y] - first] = 1
            both += matrix @ matrix.T
        both = np.rint(both).astype(np.int64)
        x, y = np.searchsorted(left, [begin, end])
        both[left[x:y] - begin, right[x:y] - begin] += common[x:y]
        a, b = np.triu_indices(end - begin, 1)
        a, b = a[(hit := both[a, b] > 0)], b[hit]
        linked.append(_similar(a + begin, b + begin, both[a, b], n))
    a, b = (np.concatenate(x) for x in zip(*linked))
    least = np.arange(len(node))
    while True:
        low = np.minimum(least[a], least[b])
        before = least.copy()
        np.minimum.at(least, a, low)
        np.minimum.at(least, b, low)
        least = least[least]
        if (least == before).all():
            break
    moved = np.flatnonzero(least != np.arange(len(node)))
    return moved, least[moved]


def _similar(a: np.ndarray, b: np.ndarray, common: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hit = 100 * common >= PERCENT * (n[a] + n[b] - common)
    return a[hit], b[hit]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by node; a node may go over several batches."""
    def answer(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        a, b = links_of(np.asarray(table.column("node")), table.column("text").combine_chunks())
        ids = table.column("id").combine_chunks()
        return pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b))], names=["a", "b"])

    waiting, size = [], 0
    for batch in words.chunks(batches):
        node = np.asarray(batch.column("node"))
        if waiting and size >= words.CHUNK:
            first = waiting[-1].column("node")[-1].as_py()
            cut = int(np.flatnonzero(np.concatenate([node != first, [True]]))[0])
            if cut < len(node):
                yield answer([*waiting, batch.slice(0, cut)])
                batch, waiting, size = batch.slice(cut), [], 0
        waiting.append(batch)
        size += batch.nbytes
    if waiting:
        yield answer(waiting)


def key():
    """What tells documents apart: (doc_id, or LAST for null; hash of the text)."""
    return F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("hash"))


def judged(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: id (its key), n, component (the smallest key of its group)."""
    texts = docs.select(key().alias("id"), "text")
    sketch = store.stage(texts.mapInArrow(
        _sketch, f"id {KEY}, n long, h1 long, h2 long, tokens array<int>"), "sketch")
    classes = store.stage(sketch.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("id").alias("leader")), "classes")
    leaders = store.stage(sketch.join(classes, ["n", "h1", "h2"]).where("id = leader").select(
        "id", "n", "tokens").dropDuplicates(["id"]), "leaders")
    whole = texts.groupBy("id").agg(F.first("text").alias("text"))
    nodes, settled = leaves(leaders, texts)
    # The members grow with the documents, so the plan is the same at every size: no broadcast of what is still small.
    # Rows of one key have one text, and one of them is enough; their copies are merged before the shuffle.
    compared = nodes.hint("merge").join(whole, "id").select("node", "id", "text")
    links = store.stage(compared.repartition("node").sortWithinPartitions("node").mapInArrow(
        _compare, f"a {KEY}, b {KEY}"), "pairs")
    # A row whose class is led by another document is linked with it; classes need no pairs of their own.
    led = sketch.join(classes, ["n", "h1", "h2"]).where("id <> leader").select(
        F.col("id").alias("a"), F.col("leader").alias("b"))
    known = links.unionByName(led)
    for more in settled:
        known = known.unionByName(more)
    labels = components.labels(known)
    for table in (leaders, nodes, links):
        store.discard(table)
    joined = sketch.join(labels, sketch["id"] == labels["node"], "left")
    return joined.select("id", "n", F.coalesce("label", "id").alias("component"))


def groups(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: id (doc_id, or LAST for null), n_shingles, component_id, kept."""
    return judged(docs).select(F.col("id.doc").alias("id"), F.col("n").alias("n_shingles"),
                               F.col("component.doc").alias("component_id"), (F.col("component") == F.col("id")).alias("kept"))


def _shown(name: str):
    return F.when(F.col(name) != LAST, F.col(name))


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, of one document per group."""
    gone = judged(docs).where("component <> id").select(F.col("id").alias("_gone")).distinct()
    return docs.join(gone, key() == F.col("_gone"), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return groups(store.table(spark, sf_dir, "documents")).select(
        _shown("id").alias("doc_id"), "n_shingles", _shown("component_id").alias("component_id"), "kept")


SQL = rf"""
WITH RECURSIVE m AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, list_slice(w, i, i + {K - 1}) AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {K - 2})) AS i FROM m WHERE len(w) >= {K})
    UNION ALL SELECT doc_id, w FROM m WHERE len(w) BETWEEN 1 AND {K - 1})),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
link AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= {PERCENT} * (p.c + q.c - i)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM m
  UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT m.doc_id, CAST(coalesce(c, 0) AS BIGINT) AS n_shingles, r.component_id, m.doc_id = r.component_id AS kept
FROM m LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
"""
