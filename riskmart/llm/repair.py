"""Repair of the turn structure of conversations by a Viterbi search that runs in parallel chunks.

A repaired conversation's role initials are `(s?(ua)+)?`. Edits: Keep (0), Rerole to user or assistant (3), Delete (4;
blank and duplicate rows must go) and Insert an empty user or assistant turn (3); a truncated row that stays adds 3. The
audit has the initials of the cheapest edits; of equally cheap ones the ASCII-least.

States say what the output ends in: nothing, s, u, a. Each allows one next role for rerole and insert, so an audit
determines the result. Cost vectors hold, per state, what the rest of a conversation costs.

1. Equal rows of a turn are one row with a count. Rows are range partitioned by conversation and turn, and packed into
   chunks of bounded size, one table row each; a conversation of any length is dealt over many tasks.
2. Chunks run backward from a speculative vector (zeros), only the last one from the true end. Costs of this kind forget
   their start: vectors that differ only by a constant (their rank is one) choose the same edits.
3. Fix-up passes: a chunk whose right neighbour's result is not what it started from, up to a constant, runs again from
   that result, until its vectors meet the old ones; passes end when no chunk changes. Most vectors meet within some
   rows; where none do, passes are as many as a conversation has chunks.
4. Each chunk is traced forward from every state along the stitched costs; the true states are followed from chunk to
   chunk, and the chunks that hold them give audit and repaired rows.

Defined cases: null role or text is one space; null turns come first; rows of a turn are ordered by role and text; null
conv_id is a conversation of its own; no rows after damage give zeros, an empty audit and no repaired rows; an empty
table gives an empty result; extra columns take no part. The hash of a repaired conversation is sequential by nature:
its chunks stream through one task, a chunk at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm import store

ROWS, BYTES = 4096, 1 << 20  # bounds of a chunk; a longer row is a chunk of its own
RECORDS = 2000  # chunks of a batch at most
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
KEEP = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = {"su", "ua", "au"}
FINE, CUT, GONE = range(3)  # a row as it is, truncated, or one that must be deleted
INITIALS = "sua-"  # - for any other
_FAR = 1 << 40

Vector = tuple[int, int, int, int]
GUESS: Vector = (0, 0, 0, 0)


def _with_inserts(c: list[int]) -> Vector:
    user, assistant = min(c[USER], INSERT + c[ASSISTANT]), min(c[ASSISTANT], INSERT + c[USER])
    return min(c[NOTHING], INSERT + user), min(c[SYSTEM], INSERT + user), user, assistant


END = _with_inserts([0, _FAR, _FAR, 0])


@lru_cache(maxsize=1 << 16)
def before(code: int, after: Vector) -> Vector:
    """Costs before a row of class `code`, up to a constant (the least is 0), from those after it."""
    initial, kind = INITIALS[code // 3], code % 3
    costs = []
    for state in range(4):
        best = DELETE + after[state]
        if kind != GONE:
            extra = TRUNCATED if kind == CUT else 0
            best = min(best, REROLE + extra + after[NEXT[state]])
            if (state, initial) in KEEP:
                best = min(best, extra + after[KEEP[state, initial]])
        costs.append(best)
    least = min(costs)
    return _with_inserts([c - least for c in costs])


def backward(codes: bytes, after: Vector) -> list[Vector]:
    """Costs before each row, and after the last."""
    vectors = [after]
    for code in reversed(codes):
        after = before(code, after)
        vectors.append(after)
    return vectors[::-1]


def fixed(codes: bytes, old: Vector, out: Vector, new: Vector) -> Vector:
    """Costs before the first row for the end costs `new`, given the result `out` for `old`; stops where both meet."""
    for code in reversed(codes):
        if old == new:
            return out
        old, new = before(code, old), before(code, new)
    return new


@lru_cache(maxsize=1 << 16)
def _choice(code: int, state: int, after: Vector) -> tuple[str, int, int]:
    """(edits up to and with the row, state after it, their cost): the ASCII-least of the cheapest."""
    initial, kind = INITIALS[code // 3], code % 3
    extra = TRUNCATED if kind == CUT else 0
    found = []
    for inserts in range(3):  # more than two come back to the same state
        head, paid = "I" * inserts, INSERT * inserts
        found.append((paid + DELETE + after[state], head + "D", state, paid + DELETE))
        if kind != GONE:
            kept = KEEP.get((state, initial))
            if kept is not None:
                found.append((paid + extra + after[kept], head + "K", kept, paid + extra))
            found.append((paid + REROLE + extra + after[NEXT[state]], head + "R", NEXT[state], paid + REROLE + extra))
        state = NEXT[state]
    return min(found)[1:]


def traced(codes: bytes, counts: list[int], vectors: list[Vector], state: int, last: bool) -> tuple[int, int, list[str]]:
    """(state at the end, cost, edits per row and at the end) along the costs."""
    cost, edits = 0, []
    for i, code in enumerate(codes):
        edit, state, paid = _choice(code, state, vectors[i + 1])
        copies = counts[i] - 1
        cost += paid + DELETE * copies
        edits.append(edit + "D" * copies)
    closing = ""
    while last and END[state]:
        closing, state, cost = closing + "I", NEXT[state], cost + INSERT
    return state, cost, [*edits, closing]


def repaired(edits: list[str], roles: list[str], texts: list[str], state: int) -> list[str]:
    """`role:text` of what the edits leave, from the state at the begin."""
    lines = []
    for edit, role, text in zip(edits, [*roles, ""], [*texts, ""]):
        for letter in edit:
            if letter == "K":
                state = KEEP[state, role[:1]]
                lines.append(f"{role}:{text}")
            elif letter in "RI":
                state = NEXT[state]
                lines.append(f"{NAMES[state]}:{text if letter == 'R' else ''}")
            # Copies of a row follow it and are deleted.
    return lines


def damaged(rows: DataFrame) -> DataFrame:
    """The registered query's damage: conv, turn, role, text, n (how often the row is there)."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text, hit = F.coalesce("text", F.lit(" ")), F.col("hit")
    hurt = rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("hit"))
    return hurt.where("hit <> 0").select(
        "conv", "turn", F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(hit == 3, 2).otherwise(1).cast("long").alias("n"))


def plain(rows: DataFrame) -> DataFrame:
    """Conversations as they are, in the form of `damaged`."""
    return rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), *(
        F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), F.lit(1).cast("long").alias("n"))


def faulted(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text, n, blank, duplicate, truncated; equal rows of a turn are one, with the sum of `n`.

    Of equal rows the first may be fine, the others are duplicates (unless blank): `duplicate` is about the first."""
    merged = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    alike = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    merged = store.stage(merged.withColumn("alike", alike), "rows")
    turn = F.coalesce("turn", F.lit(-2**63))
    seen = merged.groupBy("conv", "alike").agg(F.min(turn).alias("first"), F.count("*").alias("turns")).where(
        "turns > 1").select(F.col("conv").alias("of"), F.col("alike").alias("same"), "first")
    joined = merged.join(seen, F.col("conv").eqNullSafe(F.col("of")) & (F.col("alike") == F.col("same")), "left")
    return joined.select(
        "conv", "turn", "role", "text", "n", (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        F.coalesce(turn > F.col("first"), F.lit(False)).alias("duplicate"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"))


def _schema(conv: str) -> str:
    return (f"conv {conv}, part int, block long, codes binary, counts array<long>, roles array<string>, "
            f"texts array<string>, head string, tail string, low long, high long, turns long, blank long, "
            f"duplicate long, truncated long, illegal long")


class _Chunk:
    def __init__(self, conv):
        self.conv, self.codes, self.counts, self.roles, self.texts = conv, bytearray(), [], [], []
        self.head = self.tail = self.low = self.high = None
        self.bytes = self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def full(self, rows: int) -> bool:
        return len(self.codes) >= rows or self.bytes >= BYTES

    def add(self, turn, role, text, n, blank, duplicate, truncated) -> None:
        initial = role[:1]
        kind = GONE if blank or duplicate else CUT if truncated else FINE
        self.codes.append(3 * (INITIALS.index(initial) if initial and initial in "sua" else 3) + kind)
        self.counts.append(n)
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text)
        self.blank += n if blank else 0
        self.duplicate += 0 if blank else n - 1 + bool(duplicate)
        self.truncated += kind == CUT
        # Copies stand side by side and their initials are equal, which is never legal.
        self.illegal += n - 1 + (self.tail is not None and self.tail + initial not in LEGAL)
        self.head = initial if self.head is None else self.head
        self.tail = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn


def _pack(conv_type: pa.DataType, limit: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0

        def batch_of(chunks: list[_Chunk], first: int) -> pa.RecordBatch:
            longs = ["low", "high", "turns", "blank", "duplicate", "truncated", "illegal"]
            columns = {
                "conv": pa.array([c.conv for c in chunks], conv_type), "part": pa.array([part] * len(chunks), pa.int32()),
                "block": pa.array(range(first, first + len(chunks)), pa.int64()),
                "codes": pa.array([bytes(c.codes) for c in chunks], pa.binary()),
                "counts": pa.array([c.counts for c in chunks], pa.list_(pa.int64())),
                "roles": pa.array([c.roles for c in chunks], pa.list_(pa.string())),
                "texts": pa.array([c.texts for c in chunks], pa.list_(pa.string())),
                "head": pa.array([c.head for c in chunks], pa.string()), "tail": pa.array([c.tail for c in chunks], pa.string())}
            columns |= {name: pa.array([getattr(c, name) for c in chunks], pa.int64()) for name in longs}
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        done, size, chunk = [], 0, None
        for batch in batches:
            for conv, *row in zip(*(column.to_pylist() for column in batch.columns)):
                if chunk is not None and (conv != chunk.conv or chunk.full(limit)):
                    done.append(chunk)
                    size += chunk.bytes
                    chunk = None
                    if len(done) >= RECORDS or size >= BYTES:
                        yield batch_of(done, block)
                        block, done, size = block + len(done), [], 0
                if chunk is None:
                    chunk = _Chunk(conv)
                chunk.add(*row)
        if chunk is not None:
            done.append(chunk)
        if done:
            yield batch_of(done, block)
    return rows


def packed(rows: DataFrame) -> DataFrame:
    """Chunks of at most `ROWS` rows in order, stored; `block` runs within `part`, both grow in order."""
    order = ["conv", "turn", "role", "text"]
    field = rows.schema["conv"]
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[field.dataType.simpleString()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *order, "n", "blank", "duplicate", "truncated")
    return store.stage(ordered.mapInArrow(_pack(arrow, ROWS), _schema(field.dataType.simpleString())), "chunks")


def _costs(column: pa.Array) -> list[Vector]:
    return [None if v is None else tuple(v) for v in column.to_pylist()]


def _guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        part, block, codes, last = batch.columns
        ends = [END if x else GUESS for x in last.to_pylist()]
        outs = [backward(c, e)[0] for c, e in zip(codes.to_pylist(), ends)]
        yield pa.RecordBatch.from_arrays([part, block, *(pa.array(v, pa.list_(pa.int64())) for v in (ends, outs))],
                                         names=["part", "block", "end", "out"])


def _fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        part, block, codes, end, out, new = batch.columns
        new, old = _costs(new), _costs(end)
        new = [o if n is None else n for n, o in zip(new, old)]
        outs = [fixed(*x) for x in zip(codes.to_pylist(), old, _costs(out), new)]
        yield pa.RecordBatch.from_arrays([part, block, *(pa.array(v, pa.list_(pa.int64())) for v in (new, outs))],
                                         names=["part", "block", "end", "out"])


VECTORS = "part int, block long, end array<long>, out array<long>"


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        part, block, number, place, codes, end = batch.columns
        exits = []
        for c, e in zip(codes.to_pylist(), _costs(end)):
            vectors = backward(c, e)
            exits.append([traced(c, [1] * len(c), vectors, state, False)[0] for state in range(4)])
        yield pa.RecordBatch.from_arrays([part, block, number, place, pa.array(exits, pa.list_(pa.int32()))],
                                         names=["part", "block", "number", "place", "exits"])


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks come sorted by conversation and place; the state goes from one to the next."""
    state = NOTHING
    for batch in batches:
        part, block, _, place, exits = batch.columns
        begins = []
        for at, ends in zip(place.to_pylist(), exits.to_pylist()):
            state = NOTHING if at == 0 else state
            begins.append(state)
            state = ends[state]
        yield pa.RecordBatch.from_arrays([part, block, pa.array(begins, pa.int32())], names=["part", "block", "begin"])


def stitched(chunks: DataFrame) -> tuple[DataFrame, int]:
    """((part, block, last, end, begin) of the chunks of conversations with several, number of fix-up passes)."""
    order = Window.partitionBy("conv").orderBy("part", "block")
    placed = chunks.select("conv", "part", "block").select(
        "*", (F.row_number().over(order) - 1).cast("long").alias("place"),
        F.lead("part").over(order).alias("next_part"), F.lead("block").over(order).alias("next_block"),
        F.first("part").over(order).alias("lead_part"), F.first("block").over(order).alias("lead_block"))
    several = placed.where("place > 0 OR next_part IS NOT NULL").select(
        "part", "block", "place", "next_part", "next_block", F.xxhash64("lead_part", "lead_block").alias("number"))
    # Two conversations may share the hash `number`; their chunks are still told apart by their own place and order.
    several = store.stage(chunks.select("part", "block", "codes").join(several, ["part", "block"]), "several")
    vectors = store.stage(several.select("part", "block", "codes", F.col("next_part").isNull().alias("last")).mapInArrow(
        _guess, VECTORS), "vectors")
    passes = 0
    while True:
        given = vectors.select(F.col("part").alias("next_part"), F.col("block").alias("next_block"), F.col("out").alias("new"))
        compared = several.join(vectors, ["part", "block"]).join(given, ["next_part", "next_block"], "left")
        if compared.where("new <> end").isEmpty():
            break
        passes += 1
        changed = store.stage(compared.select("part", "block", "codes", "end", "out", "new").mapInArrow(_fix, VECTORS), "vectors")
        store.discard(vectors)
        vectors = changed
    exits = several.join(vectors, ["part", "block"]).select("part", "block", "number", "place", "codes", "end").mapInArrow(
        _exits, "part int, block long, number long, place long, exits array<int>")
    begins = exits.repartition("number").sortWithinPartitions("number", "part", "block").mapInArrow(
        _follow, "part int, block long, begin int")
    result = store.stage(begins.join(vectors, ["part", "block"]).join(
        several.select("part", "block", F.col("next_part").isNull().alias("last")), ["part", "block"]), "stitched")
    for table in (several, vectors):
        store.discard(table)
    return result.select("part", "block", "last", "end", "begin"), passes


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        conv, part, block, codes, counts, roles, texts, last, end, begin = batch.columns
        found = []
        rows = zip(*(x.to_pylist() for x in (codes, counts, roles, texts, last, begin)), _costs(end))
        for c, n, r, t, final, state, costs in rows:
            state, final, costs = (NOTHING, True, END) if costs is None else (state, final, costs)
            _, cost, edits = traced(c, n, backward(c, costs), state, final)
            found.append(("".join(edits), cost, "\n".join(repaired(edits, r, t, state))))
        audit, cost, text = ([f[i] for f in found] for i in range(3))
        yield pa.RecordBatch.from_arrays(
            [conv, part, block, pa.array(audit, pa.string()), pa.array(cost, pa.int64()), pa.array(text, pa.string())],
            names=["conv", "part", "block", "audit", "cost", "repaired"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks come sorted by conversation and order: one row per conversation, its hash and audit put together."""
    now, first = None, True

    def answer() -> pa.RecordBatch:
        conv, digest, audit, cost, extra, shared = now[:6]
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], conv_type), pa.array(["".join(audit)]), pa.array([cost], pa.int64()),
             pa.array([digest.hexdigest()]), pa.array([extra], pa.int64()), pa.array([shared], pa.int64())],
            names=["conv", "audit", "cost", "repaired_sha256", "borders", "shared"])

    for batch in batches:
        conv_type = batch.schema.field("conv").type
        for conv, audit, cost, text, head, tail, low, high in zip(*(x.to_pylist() for x in batch.columns)):
            if first or conv != now[0]:
                if not first:
                    yield answer()
                now, first = [conv, hashlib.sha256(), [], 0, 0, 0, False, None, None], False
            elif now[7] is not None and now[7] + head not in LEGAL:
                now[4] += 1
            now[5] += low is not None and low == now[8]
            if text:
                now[1].update(("\n" if now[6] else "").encode() + text.encode())
                now[6] = True
            now[2].append(audit)
            now[3] += cost
            now[7], now[8] = tail, high if high is not None else now[8]
    if not first:
        yield answer()


def repair(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Per conv_id of `conversations`: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    `rows` are the rows to be repaired (as from `damaged`); those of `conversations` unless given. `edits` has the
    repaired rows themselves.
    """
    rows = plain(conversations) if rows is None else rows
    chunks, done = edits(rows)
    kind = chunks.schema["conv"].dataType.simpleString()
    single = done.where("last IS NULL").select(
        "conv", "audit", "cost", F.sha2("repaired", 256).alias("repaired_sha256"), F.lit(0).cast("long").alias("borders"),
        F.lit(0).cast("long").alias("shared"))
    several = done.where("last IS NOT NULL").repartition("conv").sortWithinPartitions("conv", "part", "block").select(
        "conv", "audit", "cost", "repaired", "head", "tail", "low", "high").mapInArrow(
        _whole, f"conv {kind}, audit string, cost long, repaired_sha256 string, borders long, shared long")
    counts = ["turns", "blank", "duplicate", "truncated", "illegal"]
    parts = conversations.select(F.col("conv_id").alias("conv")).distinct()
    for more in (chunks.select("conv", "low", "high", *counts), single, several):
        parts = parts.unionByName(more, allowMissingColumns=True)
    zero = F.lit(0).cast("long")
    sums = parts.groupBy("conv").agg(
        *(F.coalesce(F.sum(c), zero).alias(c) for c in [*counts, "borders", "shared"]), F.min("low").alias("low"),
        F.max("high").alias("high"), F.coalesce(F.max("cost"), zero).alias("cost"),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - (F.col("turns") - F.col("shared")), zero)
    return sums.select(F.col("conv").alias("conv_id"), gaps.alias("gaps"), "blank", "duplicate", "truncated",
                       (F.col("illegal") + F.col("borders")).alias("illegal"), "cost", "audit", "repaired_sha256")


def edits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chunks of rows, per chunk its audit, cost and repaired rows; `last` is null where it is its conversation's only one)."""
    chunks = packed(faulted(rows))
    params, _ = stitched(chunks)
    kind = chunks.schema["conv"].dataType.simpleString()
    joined = chunks.join(params, ["part", "block"], "left")
    applied = joined.select("conv", "part", "block", "codes", "counts", "roles", "texts", "last", "end", "begin").mapInArrow(
        _apply, f"conv {kind}, part int, block long, audit string, cost long, repaired string")
    applied = store.stage(applied, "edits")
    return chunks, applied.join(params.select("part", "block", "last"), ["part", "block"], "left").join(
        chunks.select("part", "block", "head", "tail", "low", "high"), ["part", "block"])


def query(spark, sf_dir: str) -> DataFrame:
    table = store.table(spark, sf_dir, "conversations")
    return repair(table, damaged(table))


def _state_sql(state: int) -> str:
    """SQL for the best {c, a, t} before a row from `state`, without inserts; `s0` to `s3` are those after the row."""
    names = {USER: "user", ASSISTANT: "assistant"}
    options = [f"{{'c': {DELETE} + s{state}.c, 'a': 'D' || s{state}.a, 't': s{state}.t}}"]
    rerole = f"s{NEXT[state]}"
    options.append(f"{{'c': {REROLE} + extra + {rerole}.c, 'a': 'R' || {rerole}.a, "
                   f"'t': chr(10) || '{names[NEXT[state]]}:' || text || {rerole}.t}}")
    for (begin, initial), end in KEEP.items():
        if begin == state:
            options.append(f"{{'c': extra + s{end}.c + CASE WHEN i1 = '{initial}' THEN 0 ELSE {_FAR} END, "
                           f"'a': 'K' || s{end}.a, 't': chr(10) || role || ':' || text || s{end}.t}}")
    return f"list_min([{', '.join(options)}])"


def _insert_sql(base: str, other: str, name: str) -> str:
    return (f"list_min([{base}, {{'c': {INSERT} + {other}.c, 'a': 'I' || {other}.a, "
            f"'t': chr(10) || '{name}:' || {other}.t}}])")


SQL = rf"""
WITH RECURSIVE bits AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY n) AS t FROM (SELECT unnest(range(256)) AS n)),
k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(
           list_concat([4294967295], list_transform(string_split(
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) % 20 AS hit
  FROM conversations, bits),
d AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN hit = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM k WHERE hit <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS i1,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i0
  FROM d),
f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN nth > 1 THEN 2
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault FROM o),
x AS (SELECT *, CASE fault WHEN 0 THEN 0 WHEN 3 THEN {TRUNCATED} ELSE {_FAR} END AS extra FROM f),
v AS (
  SELECT DISTINCT conv_id, n AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS s0,
         {{'c': CAST(6 AS BIGINT), 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s1,
         {{'c': CAST(3 AS BIGINT), 'a': 'I', 't': chr(10) || 'assistant:'}} AS s2,
         {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS s3 FROM x
  UNION ALL
  SELECT conv_id, i, {_insert_sql("b0", "r2", "user")} AS s0, {_insert_sql("b1", "r2", "user")} AS s1, r2 AS s2,
         {_insert_sql("b3", "b2", "user")} AS s3
  FROM (
    SELECT *, {_insert_sql("b2", "b3", "assistant")} AS r2
    FROM (
      SELECT v.conv_id, v.i - 1 AS i, {", ".join(f"{_state_sql(s)} AS b{s}" for s in range(4))}
      FROM v JOIN x ON x.conv_id IS NOT DISTINCT FROM v.conv_id AND x.i = v.i)))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v.s0.c, 0) AS cost,
       coalesce(v.s0.a, '') AS audit, sha256(substr(coalesce(v.s0.t, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (i0 IS NOT NULL AND i0 || i1 NOT IN ('su', 'ua', 'au')) AS illegal
  FROM x GROUP BY conv_id) g ON g.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN v ON v.conv_id IS NOT DISTINCT FROM c.conv_id AND v.i = 0
"""
