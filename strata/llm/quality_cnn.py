"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover all of it. Learned
filters slide over the embedded bytes of a chunk; each filter's strongest
response is the chunk's pooled vector, so a chunk that says the same word over
and over has few filters that respond. A small layer scores that vector, and
the chunk scores are combined into one probability by their maximum and mean
over the document.

The network is trained on the driver on a sample bounded in rows and in bytes
of a row (``TRAIN_ROWS``, ``TRAIN_BYTES``), both parameters; every text is
scored whole, inside the tasks, with the same few thousand weights.

Defined results: a null text is scored as the empty text, which is one chunk
of padding. Repeated rows are scored each on its own. A null doc_id stays null,
teaches nothing, and is neither held out nor not (null). Without labelled rows, or with one class only, the
network is untrained and every score is the share of label 1 (0.5 without
any). Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import slices

CHUNK, HOP = 512, 448  # bytes of a chunk, and from chunk to chunk
WIDTH, STEP = 12, 2  # bytes under a filter, and from place to place
EMBED, FILTERS, HIDDEN = 4, 32, 16
TRAIN_ROWS, TRAIN_BYTES = 6000, 1 << 16  # 393 MB of text on the driver at the very most
EPOCHS, STEPS = 16, 600  # passes over the sample, more of them if they make fewer steps
PLACES = CHUNK // STEP


def chunked(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunks x (CHUNK + WIDTH) symbols, each chunk's row, each chunk's bytes).

    A symbol is a byte's value, or 256 for padding.
    """
    sizes = np.diff(at)
    n_chunks = np.maximum(1, -(-np.maximum(sizes - (CHUNK - HOP), 1) // HOP))
    rows = np.repeat(np.arange(len(sizes)), n_chunks)
    order = np.arange(len(rows)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
    start = order * HOP
    held = np.minimum(CHUNK, sizes[rows] - start)
    span = np.arange(CHUNK + WIDTH)
    inside = span < held[:, None]
    index = np.where(inside, (at[rows] + start)[:, None] + span, 0)
    symbols = np.where(inside, data[index].astype(np.int16), np.int16(256)) if len(data) else np.full(inside.shape, 256, np.int16)
    return symbols, rows, held


@dataclass
class Network:
    seed: int = 7
    prior: float | None = None  # set: every text scores this
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.weights:
            return
        rng = np.random.default_rng(self.seed)
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        self.weights = {
            "embed": draw(0.5, 257, EMBED),
            "filters": draw((2 / (WIDTH * EMBED)) ** 0.5, WIDTH * EMBED, FILTERS),
            "bias": np.zeros(FILTERS, np.float32),
            "hidden": draw((2 / FILTERS) ** 0.5, FILTERS, HIDDEN),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": draw((1 / HIDDEN) ** 0.5, 2 * HIDDEN),
            "out_bias": np.zeros(1, np.float32),
        }

    def pooled(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each chunk's strongest filter responses (after ReLU) and their places."""
        w = self.weights
        flat = w["embed"][symbols].reshape(len(symbols), -1)
        views = np.lib.stride_tricks.sliding_window_view(flat, WIDTH * EMBED, axis=1)[:, :: STEP * EMBED][:, :PLACES]
        best = np.empty((len(symbols), FILTERS), np.float32)
        place = np.empty((len(symbols), FILTERS), np.int16)
        for i in range(0, len(symbols), 256):
            response = np.ascontiguousarray(views[i : i + 256]).reshape(-1, WIDTH * EMBED) @ w["filters"]
            response = response.reshape(-1, PLACES, FILTERS)
            best[i : i + 256] = response.max(1)
            place[i : i + 256] = response.argmax(1) if self._train else 0
        return np.maximum(best + w["bias"], 0), place

    _train = False

    def forward(self, symbols: np.ndarray, rows: np.ndarray, n: int) -> dict[str, np.ndarray]:
        w = self.weights
        pooled, place = self.pooled(symbols)
        hidden = np.maximum(pooled @ w["hidden"] + w["hidden_bias"], 0)
        first = np.searchsorted(rows, np.arange(n))
        most = np.maximum.reduceat(hidden, first)
        count = np.bincount(rows, minlength=n).astype(np.float32)[:, None]
        mean = np.add.reduceat(hidden, first) / count
        both = np.concatenate([most, mean], 1)
        logit = both @ w["out"] + w["out_bias"]
        return {"pooled": pooled, "place": place, "hidden": hidden, "most": most, "count": count, "both": both, "p": 1 / (1 + np.exp(-np.clip(logit, -30, 30)))}

    def gradients(self, symbols: np.ndarray, rows: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        w, n = self.weights, len(target)
        f = self.forward(symbols, rows, n)
        d_logit = ((f["p"] - target) / n).astype(np.float32)
        d_both = d_logit[:, None] * w["out"]
        d_most, d_mean = d_both[:, :HIDDEN], d_both[:, HIDDEN:] / f["count"]
        top = f["hidden"] == f["most"][rows]
        share = np.add.reduceat(top.astype(np.float32), np.searchsorted(rows, np.arange(n)))
        d_hidden = (d_mean[rows] + top * (d_most / share)[rows]) * (f["hidden"] > 0)
        d_pooled = (d_hidden @ w["hidden"].T) * (f["pooled"] > 0)
        out = {
            "out": f["both"].T @ d_logit,
            "out_bias": d_logit.sum(keepdims=True),
            "hidden": f["pooled"].T @ d_hidden,
            "hidden_bias": d_hidden.sum(0),
            "bias": d_pooled.sum(0),
        }
        # only a filter's strongest place in a chunk takes part
        at = (f["place"].astype(np.int64) * STEP)[:, :, None] + np.arange(WIDTH)
        seen = np.take_along_axis(symbols[:, None, :], at, 2)  # chunk, filter, width
        bytes_in = w["embed"][seen].reshape(len(symbols), FILTERS, WIDTH * EMBED)
        out["filters"] = np.einsum("cf,cfw->wf", d_pooled, bytes_in)
        d_in = d_pooled[:, :, None] * w["filters"].T[None]
        d_in = d_in.reshape(-1, EMBED)
        spots = seen.reshape(-1)
        out["embed"] = np.stack([np.bincount(spots, d_in[:, e], 257) for e in range(EMBED)], 1).astype(np.float32)
        return out

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, batch: int = 32, rate: float = 4e-3) -> Network:
        if len(labels) == 0 or labels.min() == labels.max():
            self.prior = float(labels.mean()) if len(labels) else 0.5
            return self
        self._train = True
        rng = np.random.default_rng(self.seed)
        sizes = np.array([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum(sizes)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        a_pass = -(-len(texts) // batch)
        epochs = max(epochs, -(-STEPS // a_pass))  # few labels need as many steps as many do
        step, steps = 0, epochs * a_pass
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for i in range(0, len(order), batch):
                chosen = order[i : i + batch]
                part = np.concatenate([data[ends[j] - sizes[j] : ends[j]] for j in chosen])
                at = np.concatenate([[0], np.cumsum(sizes[chosen])])
                symbols, rows, _ = chunked(part, at)
                step += 1
                pace = rate * (1 - step / (steps + 1))
                for k, g in self.gradients(symbols, rows, labels[chosen].astype(np.float32)).items():
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.001 * (g * g - square[k])
                    self.weights[k] -= pace * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
        self._train = False
        return self

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        n = len(at) - 1
        if self.prior is not None:
            return np.full(n, self.prior)
        symbols, rows, _ = chunked(data, at)
        return self.forward(symbols, rows, n)["p"].astype(np.float64)


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES, folds: int = 5) -> tuple[list[bytes], np.ndarray]:
    """At most ``rows`` labelled texts of at most ``most_bytes`` bytes.

    Rows with crc32(doc_id as text) mod ``folds`` = 0 are held out. The rows
    taken are those of the least hash of their id, and of rows that share an id
    the one with the least text, which no order or partition of the input changes.
    """
    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    usable = usable.filter(F.crc32(F.col("doc_id").cast("string")) % folds != 0)
    chosen = usable.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.octet_length("text") <= most_bytes)
    once = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("text").alias("text"))
    found = sorted(once.collect(), key=lambda r: r["doc_id"])  # bounded by rows
    return [r["text"].encode("utf-8", "replace") for r in found], np.array([r["quality"] for r in found], np.float32)


def score_quality(docs: DataFrame, network: Network, more: tuple[Column, ...] = ()) -> DataFrame:
    """doc_id, ``more`` columns and score (the probability of label 1) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((network.weights, network.prior))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, prior = shared.value
        net = Network(weights=weights, prior=prior)
        for batch, data, at in slices(batches, most=1 << 20):
            kept = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            names = [batch.schema.names[i] for i in kept]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(net.score(data, at))], names=[*names, "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *more, "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.mapInArrow(judge, f"{schema}, score double")


def train_and_score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted: learn from the labelled rows, score every text."""
    network = Network().fit(*training_sample(docs, labels))
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out")
    scored = score_quality(docs, network, more=(held_out,))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, network: Network, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all columns, that score at least ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast((network.weights, network.prior))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, prior = shared.value
        net = Network(weights=weights, prior=prior)
        for batch, data, at in slices(batches, most=1 << 20):
            yield batch.filter(pa.array(net.score(data, at) >= threshold))

    return docs.mapInArrow(judge, docs.schema)
