"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word enters as two embeddings: that of the word itself (hashed) and, from its bytes, the mean over its trigrams with
word ends plus the sum over its beginnings of 3 to 7 bytes (hashed), so that unknown forms are read by their letters. Two gated recurrent layers run over a
window of `SIZE` words, one in each direction; attention pools their states to one logit. All windows of a text, one
every `STEP` words, are scored, and a logistic curve turns the largest logit into the text's score.

Words are lower-cased runs of ASCII letters and digits and of all other characters beyond ASCII. Gate inputs are
computed once for each distinct word of a chunk of texts; a step of the network is then a gather and a small product
for all windows of the chunk.

Labels belong to texts, not to windows. Training starts with an even share for each window of a toxic text and then
gives each the share that the network itself sees, relative to the strongest window of its text. It takes at most
`PER_CLASS` labelled texts of either class, chosen by hash among those of at most `TRAIN_CHARS` characters.

Defined cases: texts without words score 0; without labelled rows of both classes every text scores 0; labels that
repeat count once, as toxic if any is; null doc_id is not held out; an empty table gives an empty result; extra columns
take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm import store, words
from riskmart.llm.langid import held_out

SIZE, STEP = 24, 12
HIDDEN, WIDTH = 8, 12  # states of a direction; numbers of an embedding
WORDS, TRIGRAMS, STEMS = 1 << 15, 1 << 13, 1 << 16
BEGINNINGS = range(3, 8)
PER_CLASS, TRAIN_CHARS = 600, 20_000
EPOCHS, BATCH, RATE = 4, 256, 0.01
SHARED = 4  # a word of fewer training texts has no embedding of its own, else it would be learned by heart
DECAY, DROPOUT = 0.02, 0.3  # of the embeddings, each step
CURVE = 4  # every fourth text of the sample sets the curve instead of training the network
THRESHOLD = 0.3
FOUND = "doc_id long, held_out boolean, score double, predicted int"


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Vocabulary:
    """Distinct words of a chunk: bucket of each, and the trigram buckets of all one after another."""

    def __init__(self, found: words.Words):
        keys, first, self.index = np.unique(found.hashes, return_index=True, return_inverse=True)
        self.bucket = (keys >> np.uint64(49)).astype(np.int64)
        starts, ends = found.starts[first], found.ends[first]
        sizes = ends - starts
        # A word of n bytes has n trigrams: its bytes with a mark on both sides.
        self.trigrams_of = np.repeat(np.arange(len(keys)), sizes)
        at = np.repeat(starts, sizes) + np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        data = found.data.astype(np.uint32)
        left = np.where(at > np.repeat(starts, sizes), data[np.maximum(at - 1, 0)], 256)
        right = np.where(at + 1 < np.repeat(ends, sizes), data[np.minimum(at + 1, max(len(data) - 1, 0))], 257)
        code = ((left * np.uint32(0x9E3779B1) + data[at]) * np.uint32(0x85EBCA6B) + right) * np.uint32(0xC2B2AE35)
        self.trigrams = (code >> np.uint32(19)).astype(np.int64)
        self.begins = np.cumsum(sizes) - sizes
        self.sizes = sizes
        # Beginnings of each word, the bucket STEMS where it is shorter.
        code = np.full(len(keys), 256, np.uint32)
        self.stems = np.full((len(keys), len(BEGINNINGS)), STEMS)
        for j in range(max(BEGINNINGS)):
            code = np.where(j < sizes, (code * np.uint32(0x9E3779B1) + data[np.minimum(starts + j, max(len(data) - 1, 0))])
                            * np.uint32(0x85EBCA6B), code)
            if j + 1 in BEGINNINGS:
                long = sizes > j
                bucket = (code ^ (code >> np.uint32(15))) * np.uint32(0xC2B2AE35)
                self.stems[long, j + 1 - BEGINNINGS[0]] = (bucket >> np.uint32(16))[long]


def windows(bounds: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """(word indices of each window, -1 where a text ends; text of each window)."""
    n = np.diff(bounds)
    many = np.where(n > 0, np.maximum(1, -(-(n - SIZE) // step) + 1), 0)
    text = np.repeat(np.arange(len(n)), many)
    begin = (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)) * step
    at = begin[:, None] + np.arange(SIZE)
    return np.where(at < n[text][:, None], at + bounds[text][:, None], -1), text


class Network:
    """Parameters by name; `forward` and `backward` work on rows of word indices."""

    def __init__(self, seed: int = 0):
        random = np.random.default_rng(seed)

        def some(*shape: int, scale: float) -> np.ndarray:
            return (random.standard_normal(shape) * scale).astype(np.float32)

        # 1 for buckets of words, and of beginnings, that enough training texts share
        self.known, self.stem_known = np.ones(WORDS, np.float32), np.ones(STEMS + 1, np.float32)
        self.stem_known[STEMS] = 0
        self.p = {"word": some(WORDS, WIDTH, scale=0.1), "trigram": some(TRIGRAMS, WIDTH, scale=0.1),
                  "stem": some(STEMS + 1, WIDTH, scale=0.1),
                  "score": some(2 * HIDDEN, scale=0.3), "score_bias": np.zeros(1, np.float32),
                  "attend": some(2 * HIDDEN, HIDDEN, scale=0.3), "query": some(HIDDEN, scale=0.3)}
        for d in "fb":
            self.p |= {f"in_{d}": some(2 * WIDTH, 3 * HIDDEN, scale=0.2), f"bias_{d}": np.zeros(3 * HIDDEN, np.float32),
                       f"gates_{d}": some(HIDDEN, 2 * HIDDEN, scale=0.3), f"new_{d}": some(HIDDEN, HIDDEN, scale=0.3)}
        self.curve = (1.0, 0.0)

    def inputs(self, vocabulary: Vocabulary) -> np.ndarray:
        """Both embeddings of each distinct word."""
        sums = np.add.reduceat(self.p["trigram"][vocabulary.trigrams], vocabulary.begins)
        own = self.p["word"][vocabulary.bucket] * self.known[vocabulary.bucket][:, None]
        letters = sums / vocabulary.sizes[:, None].astype(np.float32)
        for column in vocabulary.stems.T:
            letters += self.p["stem"][column] * self.stem_known[column][:, None]
        return np.concatenate([own, letters], 1)

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """Gate inputs of each word, in either direction; the last row is that of no word."""
        return {d: np.concatenate([x @ self.p[f"in_{d}"] + self.p[f"bias_{d}"], np.zeros((1, 3 * HIDDEN), np.float32)])
                for d in "fb"}

    def forward(self, gates: dict[str, np.ndarray], index: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """Logit of each window; index -1 is no word."""
        n, length = index.shape
        real = (index >= 0).astype(np.float32)
        states = np.zeros((length, n, 2 * HIDDEN), np.float32)
        for d, order in (("f", range(length)), ("b", range(length - 1, -1, -1))):
            part = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, 2 * HIDDEN)
            h = np.zeros((n, HIDDEN), np.float32)
            for t in order:
                g = gates[d][index[:, t]]
                zr = sigmoid(g[:, :2 * HIDDEN] + h @ self.p[f"gates_{d}"])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                new = np.tanh(g[:, 2 * HIDDEN:] + (r * h) @ self.p[f"new_{d}"])
                if trace is not None:
                    trace[d, t] = (h, z, r, new)
                h = h + real[:, t:t + 1] * z * (new - h)
                states[t, :, part] = h
        inner = np.tanh(states @ self.p["attend"])
        weight = np.where(real.T > 0, inner @ self.p["query"], -1e9)
        share = np.exp(weight - weight.max(0))
        share /= share.sum(0)
        pooled = (share[:, :, None] * states).sum(0)
        if trace is not None:
            trace.update(states=states, inner=inner, share=share, pooled=pooled, real=real)
        return pooled @ self.p["score"] + self.p["score_bias"][0]

    def backward(self, x: np.ndarray, vocabulary_index: np.ndarray, slope: np.ndarray, trace: dict) -> tuple[dict, np.ndarray]:
        """(gradients of the parameters but embeddings, gradient of the words' inputs); slope is that of the logits."""
        index, p, grad = vocabulary_index, self.p, {}
        states, inner, share, pooled, real = (trace[k] for k in ("states", "inner", "share", "pooled", "real"))
        grad["score"], grad["score_bias"] = pooled.T @ slope, slope.sum(keepdims=True)
        d_pooled = slope[:, None] * p["score"]
        d_states = share[:, :, None] * d_pooled
        d_share = (states * d_pooled).sum(2)
        d_weight = share * (d_share - (share * d_share).sum(0))
        d_inner = d_weight[:, :, None] * p["query"] * (1 - inner ** 2)
        grad["query"] = (d_weight[:, :, None] * inner).sum((0, 1))
        grad["attend"] = np.einsum("tni,tnj->ij", states, d_inner)
        d_states = d_states + d_inner @ p["attend"].T
        d_x = np.zeros_like(x)
        for d, order in (("f", range(index.shape[1] - 1, -1, -1)), ("b", range(index.shape[1]))):
            part = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, 2 * HIDDEN)
            gates, new_in = p[f"gates_{d}"], p[f"new_{d}"]
            d_gates, d_new_in = np.zeros_like(gates), np.zeros_like(new_in)
            d_in = np.zeros((len(x) + 1, 3 * HIDDEN), np.float32)
            carried = np.zeros((len(index), HIDDEN), np.float32)
            for t in order:
                h, z, r, new = trace[d, t]
                up = carried + d_states[t, :, part]
                step = up * real[:, t:t + 1]
                pre_new = step * z * (1 - new ** 2)
                pre_z = step * (new - h) * z * (1 - z)
                through = pre_new @ new_in.T
                pre_r = through * h * r * (1 - r)
                both = np.concatenate([pre_z, pre_r], 1)
                d_gates += h.T @ both
                d_new_in += (r * h).T @ pre_new
                np.add.at(d_in, index[:, t], np.concatenate([both, pre_new], 1))
                carried = up - step * z + through * r + both @ gates.T
            d_in = d_in[:-1]
            grad |= {f"gates_{d}": d_gates, f"new_{d}": d_new_in, f"in_{d}": x.T @ d_in, f"bias_{d}": d_in.sum(0)}
            d_x += d_in @ p[f"in_{d}"].T
        return grad, d_x

    def logits(self, texts: pa.Array) -> np.ndarray:
        """Largest logit of each text's windows, -inf without words."""
        found = words.find(texts, words.ALNUM, words.LOWER)
        result = np.full(len(found.bounds) - 1, -np.inf)
        if len(found.starts):
            vocabulary = Vocabulary(found)
            gates = self.gates(self.inputs(vocabulary))
            at, text = windows(found.bounds)
            index = np.where(at >= 0, vocabulary.index[at], -1)
            logit = np.concatenate([self.forward(gates, index[i:i + 4096]) for i in range(0, len(index), 4096)])
            np.maximum.at(result, text, logit)
        return result

    def scores(self, texts: pa.Array) -> np.ndarray:
        a, b = self.curve
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-(a * self.logits(texts).astype(np.float64) + b)))


def train(texts: list[str], toxic: list[bool], share: float, seed: int = 0, epochs: int = EPOCHS) -> Network:
    """Fit on labelled texts; `share` is that of toxic texts among all labelled ones."""
    net, random = Network(seed), np.random.default_rng(seed)
    apart = [i for x in (False, True) for i in [j for j, y in enumerate(toxic) if bool(y) == x][CURVE - 1::CURVE]]
    if {bool(toxic[i]) for i in apart} != {False, True}:
        apart = []  # too few texts to set any apart
    later = [texts[i] for i in apart] or texts, np.array([toxic[i] for i in apart] or toxic, bool)
    texts, toxic = (list(x) for x in zip(*((t, y) for i, (t, y) in enumerate(zip(texts, toxic)) if i not in set(apart))))
    found = words.find(pa.array(texts, pa.large_string()), words.ALNUM, words.LOWER)
    vocabulary = Vocabulary(found)
    at, text = windows(found.bounds, SIZE)
    index = np.where(at >= 0, vocabulary.index[at], -1)
    label = np.array(toxic, bool)
    pairs = np.unique(vocabulary.bucket[vocabulary.index] * len(texts) + found.text_of)
    net.known = (np.bincount(pairs // len(texts), minlength=WORDS) >= SHARED).astype(np.float32)
    pairs = np.unique(vocabulary.stems[vocabulary.index] * len(texts) + found.text_of[:, None])
    net.stem_known = (np.bincount(pairs // len(texts), minlength=STEMS + 1) >= SHARED).astype(np.float32)
    net.stem_known[STEMS] = 0
    target = np.where(label[text], 0.5, 0.0).astype(np.float32)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    positive, negative = np.flatnonzero(label[text]), np.flatnonzero(~label[text])
    for epoch in range(epochs):
        rows = np.concatenate([positive, random.permutation(negative)[:max(len(positive), BATCH)]])
        rows = random.permutation(rows)
        for begin in range(0, len(rows), BATCH):
            mine = rows[begin:begin + BATCH]
            known, local = np.unique(index[mine], return_inverse=True)
            local = local.reshape(len(mine), -1) - (known[0] < 0)
            part = _some(vocabulary, known[known >= 0])
            x, trace = net.inputs(part), {}
            kept = (random.random(x.shape, np.float32) >= DROPOUT) / np.float32(1 - DROPOUT)
            logit = net.forward(net.gates(x * kept), local, trace)
            grad, d_x = net.backward(x * kept, local, (sigmoid(logit) - target[mine]) / len(mine), trace)
            d_x = d_x * kept
            grad["word"], grad["trigram"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["trigram"])
            np.add.at(grad["word"], part.bucket, d_x[:, :WIDTH] * net.known[part.bucket][:, None])
            np.add.at(grad["trigram"], part.trigrams, (d_x[:, WIDTH:] / part.sizes[:, None])[part.trigrams_of])
            grad["stem"] = np.zeros_like(net.p["stem"])
            for column in part.stems.T:
                np.add.at(grad["stem"], column, d_x[:, WIDTH:] * net.stem_known[column][:, None])
            step += 1
            for k, g in grad.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                if k in ("word", "trigram", "stem"):
                    net.p[k] *= 1 - RATE * DECAY * (5 if k == "trigram" else 1)
                net.p[k] -= (RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        gates = net.gates(net.inputs(vocabulary))
        seen = sigmoid(np.concatenate([net.forward(gates, index[i:i + 4096]) for i in range(0, len(index), 4096)]))
        best = np.zeros(len(texts), np.float32)
        np.maximum.at(best, text, seen)
        target = np.where(label[text], (seen / best[text]) ** 2, 0.0).astype(np.float32)
    net.curve = _curve(net.logits(pa.array(later[0], pa.large_string())), later[1], share)
    return net


def _some(vocabulary: Vocabulary, known: np.ndarray) -> Vocabulary:
    """The vocabulary of some of its words."""
    part = object.__new__(Vocabulary)
    part.bucket, part.sizes = vocabulary.bucket[known], vocabulary.sizes[known]
    part.begins = np.cumsum(part.sizes) - part.sizes
    part.trigrams_of = np.repeat(np.arange(len(known)), part.sizes)
    at = np.arange(int(part.sizes.sum())) - part.begins[part.trigrams_of]
    part.stems = vocabulary.stems[known]
    part.trigrams = vocabulary.trigrams[at + vocabulary.begins[known][part.trigrams_of]]
    return part


def _curve(logit: np.ndarray, label: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and shift of the logistic curve for the largest logits, each class weighing its share of all labels."""
    usable = np.isfinite(logit)
    x, y = logit[usable], label[usable].astype(float)
    weight = np.where(y > 0, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    rows = np.stack([x, np.ones_like(x)], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        slope = rows.T @ (weight * (p - y)) + 0.1 * (beta - [1.0, 0.0])
        bend = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 0.1 * np.eye(2)
        beta = beta - np.linalg.solve(bend, slope)
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    """A network of the bounded sample, None unless there are texts of both classes."""
    rows = labels.where(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}  # two rows
    short = docs.where(F.length("text") <= TRAIN_CHARS).select(F.col("doc_id"), "text")
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    ids: dict[int, int] = {}
    for value in (0, 1):  # somewhat more than needed, since long texts leave
        chosen = rows.where(F.col("toxic") == value).orderBy(order, "doc_id").limit(PER_CLASS * 3 // 2)
        ids |= {r["doc_id"]: value for r in chosen.collect()}
    if set(ids.values()) != {0, 1}:
        return None
    sample = sorted({(r["doc_id"], r["text"]) for r in short.where(F.col("doc_id").isin(list(ids))).collect()})
    texts = [(t, bool(ids[i])) for value in (0, 1) for i, t in [x for x in sample if ids[x[0]] == value][:PER_CLASS]]
    if {y for t, y in texts if t.strip()} != {False, True}:
        return None
    return train([t for t, _ in texts], [y for _, y in texts], counts[1] / (counts[0] + counts[1]))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(fit(rows, labels))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in words.chunks(batches):
            scores = net.scores(batch.column("text")) if net is not None else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores),
                 pa.array((scores >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return rows.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(predict, FOUND)


def query(spark, sf_dir: str) -> DataFrame:
    return score(store.table(spark, sf_dir, "documents"), store.table(spark, sf_dir, "labels"))
