"""Quality classifier: random-indexing word vectors and a two-layer network.

Every word form has a fixed sparse ternary index vector drawn from its hash
bucket. A form's vector is its own index vector plus the mean of the index
vectors of the words up to WINDOW places before and after it, over all its
occurrences in the learning rows: words of like surroundings get like vectors.
A document pools the vectors of all its tokens (their mean), and beside them the
mean of index vectors of word shapes (letters by case, digits, punctuation as
itself, runs collapsed) and a few rates. A two-layer network scores the pooled
vector, and a temperature fitted on a calibration part of the learning rows
makes the scores probabilities.

Learning uses at most ``max_rows`` labelled documents (their whole texts), taken
by hash of the id; every document is scored over its whole text.

Defined results: null and empty texts are scored as texts without tokens; rows
with a null id are scored and neither held out nor learned from; documents with
conflicting label rows are not learned from; repeated rows are scored each; with
no labelled rows every score is 0.5, and ``keep`` keeps all; an empty table gives
no rows. Extra columns are not read; ``keep`` returns them as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import held_out, labelled_sample, materialize, slices, small_batches, texts_of

MAX_ROWS = 6000
WORDS = 1 << 14
SHAPES = 1 << 10
DIM = 48
NONZERO = 6
HIDDEN = 24
#: Words to either side that make a word's surroundings; tasks that add them up.
WINDOW = 2
FIT_TASKS = 16
#: Parts of the form buckets in which the tasks' sums are added up.
FIT_PARTS = 64
#: Words that a task remembers at most; a full cache is emptied.
CACHE_WORDS = 300_000

_CLASS = str.maketrans({**{chr(c): "a" for c in range(97, 123)}, **{chr(c): "A" for c in range(65, 91)}, **{chr(c): "9" for c in range(48, 58)}})
_RUN = re.compile(r"(.)\1+", re.S)


def index_vectors(n: int, seed: int) -> np.ndarray:
    """A sparse ternary vector for each of n buckets."""
    rng = np.random.default_rng(seed)
    out = np.zeros((n, DIM), np.float32)
    at = np.argsort(rng.random((n, DIM)), axis=1)[:, :NONZERO]
    np.put_along_axis(out, at, rng.choice(np.float32([-1, 1]), at.shape), axis=1)
    return out


def shape_of(word: str) -> str:
    s = word.translate(_CLASS)
    if not s.isascii():
        s = "".join("A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in s)
    return _RUN.sub(r"\1", s)


class Tokens(dict):
    """word -> form bucket * SHAPES + shape bucket."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        form = xxhash.xxh32_intdigest(word.lower().encode("utf-8", "surrogatepass")) % WORDS
        shape = xxhash.xxh32_intdigest(shape_of(word).encode("utf-8", "surrogatepass"), seed=1) % SHAPES
        out = form * SHAPES + shape
        if len(word) <= 64:
            self[word] = out
        return out

    def of(self, text: str) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def pooled(codes: np.ndarray, forms: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """The pooled vector of a document's tokens."""
    n = len(codes)
    out = np.zeros(2 * DIM + 4, np.float32)
    if n:
        form, shape = codes // SHAPES, codes % SHAPES
        counted = np.bincount(shape, minlength=SHAPES).astype(np.float32) / n
        distinct, often = np.unique(form, return_counts=True)
        out[:DIM] = (often.astype(np.float32) @ forms[distinct]) / n
        out[DIM : 2 * DIM] = counted @ shapes
        out[2 * DIM :] = np.log1p(n) / 8, len(distinct) / n, float((form[1:] == form[:-1]).sum()) / n, counted.max()
    return out


def surroundings(form: np.ndarray, index: np.ndarray, total: np.ndarray, count: np.ndarray) -> None:
    """Add the index vectors around each word of a text to its form's total."""
    around, near, n = index[form], np.zeros((len(form), DIM), np.float32), np.zeros(len(form), np.float32)
    for k in range(1, WINDOW + 1):
        near[k:] += around[:-k]
        near[:-k] += around[k:]
        n[k:] += 1
        n[:-k] += 1
    order = np.argsort(form, kind="stable")
    begins = np.flatnonzero(np.r_[True, np.diff(form[order]) > 0])
    total[form[order[begins]]] += np.add.reduceat(near[order], begins)
    count[form[order[begins]]] += np.add.reduceat(n[order], begins)


def word_vectors(sample: DataFrame) -> np.ndarray:
    """Form vectors from the surroundings in the sample's texts.

    Each task adds up for all form buckets; the sample is bounded, and so are
    the tasks that read it. What the tasks found is added up in parts, and only
    the sums reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, tokens = index_vectors(WORDS, 2), Tokens()
        total, count = np.zeros((WORDS, DIM), np.float32), np.zeros(WORDS, np.float32)
        for batch in slices(batches):
            for text in texts_of(batch):
                if len(codes := tokens.of(text)):
                    surroundings(codes // SHAPES, index, total, count)
        parts = [np.concatenate([t.ravel(), c]) for t, c in zip(np.array_split(total, FIT_PARTS), np.array_split(count, FIT_PARTS), strict=True)]
        there = [k for k, x in enumerate(parts) if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array([parts[k].tobytes() for k in there], pa.binary())], ["part", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column("part").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                own = np.frombuffer(x, np.float32)
                sums[k] = sums[k] + own if k in sums else own  # sums of whole numbers, so their order doesn't matter
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "sums"])

    schema = "part int, sums binary"
    got = sample.select("text").repartition(FIT_TASKS).mapInArrow(run, schema).repartition("part").mapInArrow(add, schema).collect()  # FIT_PARTS rows at most
    total, count = np.zeros((WORDS, DIM), np.float32), np.zeros(WORDS, np.float32)
    at = np.array_split(np.arange(WORDS), FIT_PARTS)
    for k, sums in got:
        own, n = np.frombuffer(sums, np.float32), len(at[k])
        total[at[k]], count[at[k]] = own[: n * DIM].reshape(n, DIM), own[n * DIM :]
    return index_vectors(WORDS, 2) + total / np.maximum(count, 1)[:, None]


@dataclass
class Network:
    """Two layers over standardized inputs; temperature divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30).astype(np.float64)))


def train(x: np.ndarray, y: np.ndarray, epochs: int = 60, rate: float = 3e-3, decay: float = 1e-3) -> Network:
    """Adam over small batches; every fifth row is kept for the temperature."""
    rng = np.random.default_rng(11)
    fit_rows = np.arange(len(y)) % 5 != 0 if len(y) >= 50 else np.ones(len(y), bool)
    kept = ~fit_rows if len(y) >= 50 else fit_rows
    net = Network(x[fit_rows].mean(0), x[fit_rows].std(0) + 0.02, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32), rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32), 0.0)
    z, t = ((x - net.mean) / net.scale)[fit_rows].astype(np.float32), y[fit_rows].astype(np.float32)
    params = [net.w1, net.b1, net.w2, np.zeros(1, np.float32)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(t))
        for at in range(0, len(t), 128):
            rows = order[at : at + 128]
            h = np.tanh(z[rows] @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30)))
            g = (p - t[rows]) / len(rows)
            back = np.outer(g, params[2]) * (1 - h * h)
            grads = [z[rows].T @ back + decay * params[0], back.sum(0), h.T @ g + decay * params[2], np.array([g.sum()], np.float32)]
            step += 1
            for q, m, v, d in zip(params, first, second, grads, strict=True):
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.b2 = float(params[3][0])
    logits, truth = net.logits(x[kept]), y[kept]
    choices = np.geomspace(0.5, 8, 60)
    nll = [np.logaddexp(0, -np.where(truth == 1, 1, -1) * logits / c).mean() for c in choices]
    net.temperature = float(choices[int(np.argmin(nll))])
    return net


def pooled_rows(df: DataFrame, keep: tuple[str, ...], schema: str, vectors: object, finish) -> DataFrame:
    """df's kept columns with finish(pooled vectors of a slice); vectors: a broadcast of the form vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, shapes = Tokens(), index_vectors(SHAPES, 5)
        for batch in slices(batches):
            forms = vectors.value[0]
            x = np.stack([pooled(tokens.of(t), forms, shapes) for t in texts_of(batch)]) if batch.num_rows else np.zeros((0, 2 * DIM + 4), np.float32)
            made = finish(x, vectors.value)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made.values()], [*keep, *made])

    return df.select(*keep, "text").mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, modulus: int, remainder: int, max_rows: int) -> tuple[np.ndarray, Network | None]:
    """Form vectors and the network; None without labelled rows of both kinds."""
    spark = docs.sparkSession
    sample = materialize(labelled_sample(docs, labels, "quality", modulus, remainder, max_rows), "quality-sample")
    forms = word_vectors(sample)
    sent = spark.sparkContext.broadcast((forms,))
    rows = pooled_rows(sample, ("doc_id", "label"), "doc_id long, label int, x binary", sent, lambda x, _: {"x": pa.array([r.tobytes() for r in x], pa.binary())})
    got = sorted(rows.collect())  # max_rows at most
    sent.unpersist()
    y = np.array([r["label"] for r in got])
    if len(set(y)) < 2:
        return forms, None
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in got])
    mixed = np.random.default_rng(1).permutation(len(y))
    return forms, train(x[mixed], y[mixed])


def score(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, max_rows: int = MAX_ROWS, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sent = spark.sparkContext.broadcast(fit(docs, labels, modulus, remainder, max_rows))  # of fixed size

    def finish(x: np.ndarray, model: tuple) -> dict[str, pa.Array]:
        p = model[1].scores(x) if model[1] is not None else np.full(len(x), 0.5)
        return {"score": pa.array(p), "predicted": pa.array((p >= threshold).astype(np.int32))}

    marked = docs.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "text")
    return pooled_rows(marked, ("doc_id", "held_out"), "doc_id long, held_out boolean, score double, predicted int", sent, finish)


def keep(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, max_rows: int = MAX_ROWS, threshold: float = 0.7) -> DataFrame:
    """The rows whose texts score at least the threshold, with all their columns; without labelled rows, all."""
    spark = docs.sparkSession
    small_batches(spark)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sent = spark.sparkContext.broadcast(fit(own, labels, modulus, remainder, max_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, shapes = Tokens(), index_vectors(SHAPES, 5)
        forms, net = sent.value
        for batch in slices(batches):
            if net is not None and batch.num_rows:
                scores = net.scores(np.stack([pooled(tokens.of(t), forms, shapes) for t in texts_of(batch)]))
                batch = batch.filter(pa.array(scores >= threshold))
            yield batch

    return docs.mapInArrow(run, docs.schema)
