"""Language identification with string kernels.

A text's profile is the set of its character n-grams of 1 to 4 code points (blended spectrum, presence only), hashed to
`BUCKETS`. The kernel of two texts is the size of the intersection of their profiles over the root of the product of
their sizes. `LANDMARKS` training texts span a Nyström approximation of it, in which one ridge regression per language
against the rest is solved. Since both are linear in the profile, a model is one matrix (n-grams by languages), and
scoring is a product of a batch of profiles with it.

The model is fitted on the driver on at most `PER_LANG` labelled rows per language and `SAMPLE` in all, chosen by hash;
their profiles are computed on the executors. All texts are then scored whole.

Defined cases: `und` with score 0 for null, empty or letterless texts and if there are no labelled rows; rows with null
lang or doc_id train nothing, null doc_id is not held out; repeated rows get equal results; extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm import store, words

N = (1, 2, 3, 4)
BUCKETS = 1 << 16
LANDMARKS, PER_LANG, SAMPLE = 128, 150, 3000
RIDGE = 0.1
SHARPNESS = 4.0
BLOCK = 128  # texts whose profiles are held at once
FOUND = "doc_id long, held_out boolean, lang_pred string, score double"


def held_out(column: str = "doc_id") -> Column:
    """True for the fold that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 4 == 2, F.lit(False))


def profiles(texts: pa.Array) -> np.ndarray:
    """Rows of booleans: which buckets have an n-gram of the text."""
    data, offsets = words.bytes_of(texts)
    first = (data & 0xC0) != 0x80  # first bytes of code points
    bounds = np.concatenate([[0], np.cumsum(first)])[offsets]
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    end = bounds[1:][text]
    found = np.zeros((len(offsets) - 1) * BUCKETS, bool)
    total = np.zeros(len(points), np.uint32)
    place = np.arange(len(points))
    for n in range(1, max(N) + 1):
        if len(points) < n:
            break
        room = len(points) - n + 1
        total = total[:room] * np.uint32(0x9E3779B1) + points[n - 1:] + np.uint32(n)
        if n in N:
            whole = place[:room] + n <= end[:room]
            bucket = (total ^ (total >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            bucket = (bucket >> np.uint32(16)).astype(np.int64)
            found[(text[:room] * BUCKETS + bucket)[whole]] = True
    return found.reshape(-1, BUCKETS)


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    sizes = np.sqrt(np.maximum(a.sum(1), 1))[:, None] * np.sqrt(np.maximum(b.sum(1), 1))[None, :]
    return a.astype(np.float32) @ b.astype(np.float32).T / sizes


class Model:
    """languages, the columns of the profile that it looks at, their weights, and the bias."""

    def __init__(self, rows: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE):
        self.languages = sorted(set(langs))
        # Landmarks go round the languages, so that none is left out.
        turn = {x: iter([i for i, y in enumerate(langs) if y == x]) for x in self.languages}
        chosen: list[int] = []
        while turn and len(chosen) < landmarks:
            for x in list(turn):
                i = next(turn[x], None)
                if i is None:
                    del turn[x]
                elif len(chosen) < landmarks:
                    chosen.append(i)
        marks = rows[chosen]
        values, vectors = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
        good = values > 1e-6 * values.max()
        nystroem = vectors[:, good] / np.sqrt(values[good])
        mapped = kernel(rows, marks) @ nystroem
        targets = np.array([[1.0 if y == x else -1.0 for x in self.languages] for y in langs])
        middle, self.bias = mapped.mean(0), targets.mean(0)
        mapped = mapped - middle
        beta = np.linalg.solve(mapped.T @ mapped + ridge * np.eye(mapped.shape[1]), mapped.T @ (targets - self.bias))
        self.bias = self.bias - middle @ beta
        self.columns = np.flatnonzero(marks.any(0))
        scaled = marks[:, self.columns] / np.sqrt(np.maximum(marks.sum(1), 1))[:, None]
        self.weights = (scaled.T @ (nystroem @ beta)).astype(np.float32)

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        margins = rows[:, self.columns].astype(np.float32) @ self.weights / np.sqrt(np.maximum(rows.sum(1), 1))[:, None]
        margins = SHARPNESS * (margins + self.bias)
        shares = np.exp(margins - margins.max(1, keepdims=True))
        best = shares.argmax(1)
        return [self.languages[i] for i in best.tolist()], shares.max(1) / shares.sum(1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in words.chunks(batches):
        for begin in range(0, batch.num_rows, BLOCK):
            yield batch.slice(begin, BLOCK)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _pieces(batches):
        rows = np.packbits(profiles(batch.column("text")), axis=1)
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([x.tobytes() for x in rows], pa.binary())],
                                         names=["lang", "profile"])


def fit(docs: DataFrame) -> Model | None:
    """A model of the bounded sample, None without labelled rows."""
    labelled = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return None
    each = max(1, min(PER_LANG, SAMPLE // len(counts)))
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    # A share of each language that has about three times the rows wanted keeps the exact choice small.
    limit = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, int(min(1.0, 3 * each / n) * (1 << 30)) + 1)))
    thin = labelled.select("doc_id", "lang", order.alias("order")).where(F.col("order") < limit[F.col("lang")])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))
    ids = [r["doc_id"] for r in thin.withColumn("rank", rank).where(F.col("rank") <= each).select("doc_id").collect()]
    sample = labelled.where(F.col("doc_id").isin(ids)).select("lang", "text").mapInArrow(
        _packed, "lang string, profile binary").collect()
    rows = np.unpackbits(np.frombuffer(b"".join(r["profile"] for r in sample), np.uint8).reshape(len(sample), -1), axis=1)
    order = sorted(range(len(sample)), key=lambda i: (sample[i]["lang"], sample[i]["profile"]))
    return Model(rows[order].astype(bool), [sample[i]["lang"] for i in order])


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", "lang")
    shared = docs.sparkSession.sparkContext.broadcast(fit(rows))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in _pieces(batches):
            letters = np.asarray(batch.column("letters").to_pylist(), bool)
            langs, scores = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            if model is not None:
                langs, scores = model.predict(profiles(batch.column("text")))
            langs = [x if y else "und" for x, y in zip(langs, letters.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs), pa.array(np.where(letters, scores, 0.0))],
                names=["doc_id", "held_out", "lang_pred", "score"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    return rows.select("doc_id", held_out().alias("held_out"), "text", letters).mapInArrow(predict, FOUND)


def query(spark, sf_dir: str) -> DataFrame:
    return identify(store.table(spark, sf_dir, "documents"))
