"""Token ids in length-delimited binary records, and a separate offset index for shuffled reads.

A shard `part-NNNNN.records` holds one record per document, framed as: length of the data (8 bytes, little-endian),
masked CRC-32C of those 8 bytes, the data, masked CRC-32C of the data (mask: rotate right by 15 bits, add 0xa282ead8).
Data: one byte that is 1 if there is a doc_id, the doc_id (8 bytes), one byte with the width of an id (2 if the
vocabulary has at most 65,536 ids, else 4), then the ids, little-endian. `part-NNNNN.index` holds 24 bytes per record:
doc_id (0 for null), offset of its frame, number of ids. Shards ascend by doc_id, so do the records in each.

A task writes its shard under a name of its own and renames it when it is whole, so a task that is run again leaves the
same files. Files are written through Arrow's file systems, to any store that those know; the folder must be shared.

Defined cases: null text is empty and has only the end id; null doc_id comes first; rows with equal doc_id are all
kept, ordered by their text; an empty table gives no shards and an empty result; extra columns take no part.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import bpe, store, words

END = 2
BLOCK = 256  # bytes whose checksums are computed side by side
BUFFER = 1 << 22
_HEAD = struct.Struct("<BqB")
_POLYNOMIAL = 0x82F63B78  # CRC-32C, reflected


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_TABLE = _byte_table()


def _block_shift() -> list[np.ndarray]:
    """What BLOCK zero bytes make of a register, as one table for each of its bytes."""
    tables = []
    for k in range(4):
        register = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(BLOCK):
            register = _TABLE[register & 0xFF] ^ (register >> np.uint32(8))
        tables.append(register)
    return tables


_SHIFT = _block_shift()


def crc32c(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """CRC-32C of each of the byte strings data[bounds[i]:bounds[i + 1]], all of at least 4 bytes.

    Zero bytes in front do not change a register of zero, and a register of ones equals four first bytes inverted. So
    every string is filled up in front to whole blocks; blocks are summed side by side, then joined string by string.
    """
    sizes = np.diff(bounds)
    blocks = -(-sizes // BLOCK)
    stops = np.cumsum(blocks)
    padded = np.zeros(int(blocks.sum()) * BLOCK, np.uint8)
    at = stops * BLOCK - sizes
    padded[np.arange(len(data)) + np.repeat(at - bounds[:-1], sizes)] = data
    for j in range(4):
        padded[at + j] ^= 0xFF
    columns = np.ascontiguousarray(padded.reshape(-1, BLOCK).T)
    register = np.zeros(columns.shape[1], np.uint32)
    for column in columns:
        register = _TABLE[(register ^ column) & 0xFF] ^ (register >> np.uint32(8))
    total = np.zeros(len(sizes), np.uint32)
    order = np.argsort(-blocks, kind="stable")
    first = (stops - blocks)[order]
    for j in range(int(blocks.max(initial=0))):
        alive = order[:int(np.searchsorted(-blocks[order], -j, "left"))]
        old = total[alive]
        moved = _SHIFT[0][old & 0xFF] ^ _SHIFT[1][(old >> 8) & 0xFF] ^ _SHIFT[2][(old >> 16) & 0xFF] ^ _SHIFT[3][old >> 24]
        total[alive] = moved ^ register[first[:len(alive)] + j]
    return total ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def frames(doc_ids: list, ids: np.ndarray, bounds: np.ndarray, width: int) -> tuple[bytes, np.ndarray]:
    """(framed records, offset of each frame in them)."""
    raw = memoryview(ids.astype(f"<u{width}").tobytes())
    limits = (bounds * width).tolist()
    data = [_HEAD.pack(x is not None, x or 0, width) + raw[a:b] for x, a, b in zip(doc_ids, limits, limits[1:])]
    sizes = np.array([len(x) for x in data], np.uint64)
    edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    sums = masked(crc32c(np.frombuffer(b"".join(data), np.uint8), edges))
    heads = masked(crc32c(sizes.astype("<u8").view(np.uint8), np.arange(len(data) + 1) * 8))
    out = b"".join(part for n, h, x, s in zip(sizes.tolist(), heads.tolist(), data, sums.tolist())
                   for part in (struct.pack("<QI", n, h), x, struct.pack("<I", s)))
    return out, edges[:-1] + 16 * np.arange(len(data))


def _open(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder)


SHARD = "shard string, n_docs long, n_tokens long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write(docs: DataFrame, folder: str, path: str, end: int = END) -> DataFrame:
    """Write `docs` (doc_id, text) in ascending order of doc_id; one row per shard that has documents."""
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder = bpe.encoder(path)
        width = 2 if encoder.library.get_vocab_size() <= 1 << 16 else 4
        system, base = _open(folder)
        name = f"part-{TaskContext.get().partitionId():05d}"
        own = f"{base}/_writing-{name}-{uuid.uuid4().hex}"
        n_docs = n_tokens = place = 0
        records = index = None
        for batch in words.chunks(batches):
            if records is None:
                system.create_dir(base, recursive=True)
                records, index = (system.open_output_stream(f"{own}.{x}") for x in ("records", "index"))
            ids, bounds = encoder.encode(batch.column("text"), end)
            doc_ids = batch.column("doc_id").to_pylist()
            framed, offsets = frames(doc_ids, ids, bounds, width)
            records.write(framed)
            index.write(np.stack([np.array([x or 0 for x in doc_ids], "<i8"), offsets + place, np.diff(bounds)], 1)
                        .astype("<i8").tobytes())
            place += len(framed)
            n_docs += len(doc_ids)
            n_tokens += len(ids)
        if records is not None:
            for stream, kind in ((index, "index"), (records, "records")):
                stream.close()
                system.move(f"{own}.{kind}", f"{base}/{name}.{kind}")
            yield pa.RecordBatch.from_pylist([{"shard": name, "n_docs": n_docs, "n_tokens": n_tokens}])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return store.stage(ordered.mapInArrow(shards, SHARD), "shards")


def parse(block: bytes, check: bool = True) -> tuple[list[tuple[int | None, np.ndarray]], int]:
    """(doc_id and ids of each whole frame, bytes used); a wrong checksum raises."""
    view, at, found, data = memoryview(block), 0, [], []
    while at + 12 <= len(block):
        n, head = struct.unpack_from("<QI", block, at)
        if at + 16 + n > len(block):
            if check:
                _frame_size(block[at:at + 12])  # a frame that goes on, not a wrong length
            break
        data.append((n, head, view[at + 12:at + 12 + n], struct.unpack_from("<I", block, at + 12 + n)[0]))
        at += 16 + n
    if check and data:
        sizes = np.array([x[0] for x in data], "<u8")
        heads = masked(crc32c(sizes.view(np.uint8), np.arange(len(data) + 1) * 8))
        edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        sums = masked(crc32c(np.frombuffer(b"".join(x[2] for x in data), np.uint8), edges))
        if heads.tolist() != [x[1] for x in data] or sums.tolist() != [x[3] for x in data]:
            raise ValueError("a record's checksum is wrong")
    for _, _, x, _ in data:
        known, doc_id, width = _HEAD.unpack_from(x)
        found.append((doc_id if known else None, np.frombuffer(x, f"<u{width}", offset=_HEAD.size)))
    return found, at


def _frame_size(head: bytes) -> int:
    n, crc = struct.unpack("<QI", head)
    if masked(crc32c(np.frombuffer(head[:8], np.uint8), np.array([0, 8])))[0] != crc:
        raise ValueError("a record's length has a wrong checksum")
    return 16 + n


def stream(system, file: str) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """Records of a shard, a few MB at a time; a longer record is read whole."""
    with system.open_input_stream(file) as source:
        rest = b""
        while True:
            need = max(BUFFER, _frame_size(rest[:12]) if len(rest) >= 12 else 0)
            more = source.read(need - len(rest)) if len(rest) < need else b""
            rest += more
            found, used = parse(rest)
            rest = rest[used:]
            if found:
                yield found
            elif not more:
                if rest:
                    raise ValueError(f"{file} ends inside a record")
                return


def fetch(folder: str, shard: str, doc_ids: list[int]) -> dict[int, np.ndarray]:
    """Ids of some documents of a shard in any order, through its index."""
    system, base = _open(folder)
    with system.open_input_file(f"{base}/{shard}.index") as file:
        index = np.frombuffer(file.read(), "<i8").reshape(-1, 3)
    found = {}
    with system.open_input_file(f"{base}/{shard}.records") as file:
        for doc_id in doc_ids:
            file.seek(int(index[np.searchsorted(index[:, 0], doc_id), 1]))
            head = file.read(12)
            [(known, ids)], _ = parse(head + file.read(_frame_size(head) - 12))
            if known != doc_id:
                raise KeyError(doc_id)
            found[doc_id] = ids
    return found


def read(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """Per record: doc_id, start (ids of all records before it), n_tokens, ids_crc32; shards are read side by side."""
    start, rows = 0, []
    for row in sorted(shards.collect(), key=lambda r: r["shard"]):  # one row per shard
        rows.append((row["shard"], start, row["n_docs"]))
        start += row["n_tokens"]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                place, n_docs = row["start"], 0
                for found in stream(system, f"{base}/{row['shard']}.records"):
                    ids = [x.astype("<u4") for _, x in found]
                    sizes = np.array([len(x) for x in ids], np.int64)
                    starts = place + np.cumsum(sizes) - sizes
                    place, n_docs = place + int(sizes.sum()), n_docs + len(found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x for x, _ in found], pa.int64()), pa.array(starts), pa.array(sizes),
                         pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])
                if n_docs != row["n_docs"]:
                    raise ValueError(f"{row['shard']} has {n_docs} records, {row['n_docs']} were written")

    plan = spark.createDataFrame(rows, "shard string, start long, n_docs long")
    return plan.repartition(max(len(rows), 1)).mapInArrow(records, ROWS)


def query(spark, sf_dir: str) -> DataFrame:
    docs = store.table(spark, sf_dir, "documents")
    folder = store.folder(spark, "records")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return read(spark, folder, write(docs, folder, bpe.default_path()))
