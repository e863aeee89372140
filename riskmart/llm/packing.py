"""Best-fit packing: token pieces into as few sequences of fixed size as possible, planned on their length histogram.

A configuration is a multiset of lengths that fits one sequence. The configuration linear program (use as few
configurations as possible so that every length is covered) is solved by multiplicative weights: a length's weight
falls as it gets covered, and a knapsack by dynamic programming finds the configuration of greatest weight. It ends
when every length is covered. The fractional uses are rounded, once down and once with what was cut off carried on to the
next; what they leave is packed best-fit, largest first, on the histogram as well, and the shorter plan is taken. The
histogram has at most one entry per token of a sequence, so the driver's work does not depend on the number of pieces.

Pieces then take their places in Spark: the r-th piece of a length goes to the r-th place that the plan has for it.

Defined cases: null or empty text is one piece with only the end id; repeated rows are packed each; rows with equal
doc_id and piece are interchangeable; an empty table gives an empty result; extra columns take no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm import bpe, store, words

SIZE = 4096
END = 1
DECAY = 6.0
LONGER = 1.2  # long pieces, which leave the worst gaps later, weigh more than in proportion
GROUP_ROWS, GROUPS = 1000, 4096  # pieces of one length are ranked in groups

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECES}, sequence_id long, offset long"


def pieces(docs: DataFrame, path: str, size: int = SIZE, end: int = END) -> DataFrame:
    """One row per piece: only documents of more than `size` tokens, the end id included, are cut."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe.encoder(path).encode
        for batch in words.chunks(batches):
            ids, bounds = encode(batch.column("text"), end)
            data = memoryview(ids.astype("<u4").tobytes())
            n = np.diff(bounds)
            parts = -(-n // size)
            doc = np.repeat(np.arange(len(n)), parts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * size
            length = np.minimum(size, n[doc] - start)
            begin = bounds[doc] + start
            crc = [zlib.crc32(data[4 * a:4 * (a + b)]) for a, b in zip(begin.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def knapsack(lengths: np.ndarray, values: np.ndarray, size: int) -> dict[int, int]:
    """The multiset of lengths of greatest value that fits `size`, as length -> count."""
    least = int(lengths[0])
    value = np.full(size + 1, -np.inf)
    value[lengths] = values
    # Back to front, so that the gains of a room are the sum of two slices: back[size - r] is the best of room r.
    back, choice = np.zeros(size + 1), np.full(size + 1, -1)
    for room in range(least, size + 1):
        gains = back[size - room + least:] + value[least:room + 1]
        i = int(gains.argmax())
        before = back[size - room + 1]
        if gains[i] > before:
            back[size - room], choice[room] = gains[i], i + least
        else:
            back[size - room], choice[room] = before, 0
    found: dict[int, int] = {}
    room = size
    while room >= lengths[0]:
        length = int(choice[room])
        if length > 0:
            found[length] = found.get(length, 0) + 1
        room -= max(length, 1)
    return found


def fractional(counts: dict[int, int], size: int) -> list[tuple[dict[int, int], float]]:
    """Uses of configurations by multiplicative weights.

    A length weighs its size ** LONGER times exp(-DECAY * covered share), nothing once it is covered, so that full
    sequences of long and little covered lengths win. Each round uses its configuration until one of its lengths is covered,
    so there are at most as many rounds as lengths, and those at most `size`.
    """
    lengths = np.array(sorted(counts))
    demand = np.array([counts[x] for x in lengths.tolist()], float)
    covered = np.zeros(len(lengths))
    at = {x: i for i, x in enumerate(lengths.tolist())}
    uses = []
    while len(open_ := np.flatnonzero(covered < demand)):
        weights = lengths[open_] ** LONGER * np.exp(-DECAY * covered[open_] / demand[open_])
        config = knapsack(lengths[open_], weights, size)
        use = min((demand[at[x]] - covered[at[x]]) / k for x, k in config.items())
        uses.append((config, use))
        for x, k in config.items():
            covered[at[x]] += use * k
            if demand[at[x]] - covered[at[x]] < 1e-9 * demand[at[x]]:
                covered[at[x]] = demand[at[x]]
    return uses


def best_fit(counts: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Largest first, each sequence filled with the largest lengths that still fit, equal sequences in one step."""
    left = dict(counts)
    lengths = sorted(left)
    below = {x: i for i, x in enumerate(lengths)}
    plan = []
    while lengths:
        config: dict[int, int] = {}
        room, i = size, len(lengths) - 1
        while i >= 0:
            x = lengths[i]
            k = min(room // x, left[x])
            if k:
                config[x] = k
                room -= k * x
            i = min(i - 1, int(np.searchsorted(lengths, room, "right")) - 1) if room else -1
        times = min(left[x] // k for x, k in config.items())
        plan.append((config, times))
        for x, k in config.items():
            left[x] -= times * k
        if any(left[x] == 0 for x in config):
            lengths = [x for x in lengths if left[x]]
    return plan


def rounded(uses: list[tuple[dict[int, int], float]], counts: dict[int, int], carry: bool) -> tuple[list, dict[int, int]]:
    """(configurations with whole uses, what they leave of `counts`)."""
    left, result, rest = dict(counts), [], 0.0
    for config, use in uses:
        wanted = use + rest + 1e-9
        times = min(int(wanted), *(left[x] // k for x, k in config.items()))
        rest = wanted - int(wanted) if carry else 0.0
        if times:
            result.append((config, times))
            for x, k in config.items():
                left[x] -= times * k
    return result, {x: n for x, n in left.items() if n}


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[dict[int, int], int]]:
    """Configurations and how many sequences use each; together they hold every piece exactly once."""
    uses = fractional(counts, size)
    plans = []
    for carry in (True, False):
        chosen, left = rounded(uses, counts, carry)
        plans.append(chosen + best_fit(left, size))
    return min(plans, key=lambda p: sum(times for _, times in p))


def runs(chosen: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length: rows of (first rank, first sequence, pieces per sequence, offset of the first) in order of rank."""
    table: dict[int, list] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for config, times in chosen:
        offset = 0
        for x, k in config.items():
            table.setdefault(x, []).append((ranks.get(x, 0), sequence, k, offset))
            ranks[x] = ranks.get(x, 0) + k * times
            offset += k * x
        sequence += times
    return {x: np.array(rows, np.int64) for x, rows in table.items()}


def ranked(cut: DataFrame, total: int) -> DataFrame:
    """`rank` of each piece among those of its length, from 0.

    A length may hold any share of all pieces, so its pieces are numbered in groups by hash; the groups' sizes, a small
    table, give where each group begins.
    """
    groups = min(GROUPS, ceil(total / GROUP_ROWS)) or 1
    cut = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    sizes = cut.groupBy("length", "group").agg(F.count("*").alias("n"))
    first = sizes.select("length", "group", (F.sum("n").over(Window.partitionBy("length").orderBy("group")) - F.col("n"))
                         .alias("first"))
    own = F.row_number().over(Window.partitionBy("length", "group").orderBy("doc_id", "piece")) - 1
    return cut.withColumn("own", own).join(first, ["length", "group"]).withColumn("rank", F.col("own") + F.col("first"))


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE, end: int = END) -> DataFrame:
    """Pieces of `docs` (doc_id, text) with their sequence and place. Texts are encoded once and never shuffled."""
    cut = store.stage(pieces(docs, path or bpe.default_path(), size, end), "pieces")
    counts = {int(r["length"]): int(r["count"]) for r in cut.groupBy("length").count().collect()}  # at most `size` rows
    places = runs(plan(counts, size))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(x)) for x in ("length", "rank"))
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            order = np.argsort(length, kind="stable")
            for mine in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                x = int(length[mine[0]])
                row = places[x][np.searchsorted(places[x][:, 0], rank[mine], "right") - 1]
                steps = rank[mine] - row[:, 0]
                sequence[mine] = row[:, 1] + steps // row[:, 2]
                offset[mine] = row[:, 3] + steps % row[:, 2] * x
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "piece", "start", "length", "ids_crc32"]).columns, pa.array(sequence),
                 pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long").alias("rank")]
    return ranked(cut, sum(counts.values())).select(*columns).mapInArrow(place, PLACED)


def query(spark, sf_dir: str) -> DataFrame:
    return pack(store.table(spark, sf_dir, "documents"))
