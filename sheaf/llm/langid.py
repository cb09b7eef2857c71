"""Language identification by error-correcting output codes.

Each language has a binary codeword; for each bit a linear classifier over
hashed byte n-grams predicts it. The decoder sums, over the bits, a loss of the
predicted margin against the codeword's bit, weighted by how reliable that bit
was on the learning rows, and takes the codeword of least loss. The score is the
softmax of the losses at a temperature fitted on the learning rows; a document
whose two best codewords are close is flagged ambiguous.

Learning uses about ``rows_per_lang`` documents of each language, taken by hash
of the id, one row of each id; every document is scored over its whole text.

Defined results: null texts, and texts without a letter, are ``und`` with score
0; a document with a null id is scored, but neither held out nor learned from;
ties between codewords go to the language first in the alphabet; repeated rows
are scored each; an empty table, or one without a language to learn, makes
every document ``und``. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import held_out, learnable, slices, small_batches, texts_of

UNKNOWN = "und"
#: Buckets of each n-gram length.
BUCKETS = 1024
ORDERS = (1, 2, 3)
ROWS_PER_LANG = 600
RIDGE = 1e-2


def features(texts: list[str]) -> np.ndarray:
    """Square roots of the shares of hashed byte n-grams, of length 1 over all orders."""
    out = np.zeros((len(texts), BUCKETS * len(ORDERS)), np.float32)
    for i, text in enumerate(texts):
        a = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
        h = np.zeros(len(a), np.uint32)
        for k, n in enumerate(ORDERS):
            h = (h[: len(a) - n + 1] * np.uint32(257) + a[n - 1 :]) if n > 1 else a
            slot = (h * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
            out[i, k * BUCKETS : (k + 1) * BUCKETS] = np.bincount(slot, minlength=BUCKETS)
    np.sqrt(out, out=out)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def codewords(n: int) -> np.ndarray:
    """n distinct codewords of -1 and 1: exhaustive for few, else the best of seeded random ones."""
    if n == 1:
        return np.ones((1, 1))
    if n <= 5:
        bits = 2 ** (n - 1) - 1
        return np.array([[1 if (c >> (n - 2 - r) if r < n - 1 else 0) & 1 else -1 for c in range(1, bits + 1)] for r in range(n)])
    bits = math.ceil(10 * math.log2(n))
    best, apart, rng = None, -1, np.random.default_rng(7)
    for _ in range(200):
        code = rng.choice((-1, 1), (n, bits))
        code = code[:, np.abs(code.sum(0)) < n]
        near = (code.shape[1] - code @ code.T) / 2 + np.eye(n) * bits
        if near.min() > apart:
            best, apart = code, near.min()
    return best


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    scale: float = 1.0

    def losses(self, x: np.ndarray) -> np.ndarray:
        margins = x @ self.weights + self.bias
        return np.stack([(self.trust * np.exp(-np.clip(margins * word, -3, 3))).sum(1) for word in self.code], 1)

    def probabilities(self, losses: np.ndarray) -> np.ndarray:
        z = np.exp(-self.scale * (losses - losses.min(1, keepdims=True)))
        return z / z.sum(1, keepdims=True)


def learn(x: np.ndarray, langs: list[str]) -> Model:
    """Ridge classifiers of the bits, languages weighted alike; bits weighted by their accuracy."""
    names = sorted(set(langs))
    y = np.array([names.index(v) for v in langs])
    code = codewords(len(names))
    share = 1 / np.bincount(y)[y]
    share = (share / share.sum()).astype(np.float32)
    bias_x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    target = code[y]
    weighted = bias_x * share[:, None]
    gram = weighted.T @ bias_x + RIDGE / x.shape[1] * np.eye(x.shape[1] + 1)
    w = np.linalg.solve(gram, weighted.T @ target)
    margins = bias_x @ w
    right = ((margins * target > 0) * share[:, None]).sum(0)
    model = Model(names, code, w[:-1].astype(np.float32), w[-1], np.maximum(2 * right - 1, 0.01) / np.maximum(2 * right - 1, 0.01).sum())
    losses = model.losses(x)
    scales = np.geomspace(0.5, 50, 30)
    nll = []
    for model.scale in scales:
        nll.append(-(share * np.log(model.probabilities(losses)[np.arange(len(y)), y] + 1e-12)).sum())
    # margins on learning rows are wider than on others, so the mildest scale near the best is taken
    model.scale = float(scales[np.flatnonzero(np.array(nll) <= min(nll) + 0.01)[0]])
    return model


def fit(docs: DataFrame, modulus: int, remainder: int, rows_per_lang: int = ROWS_PER_LANG) -> Model | None:
    """A model of the languages in the learnable rows, None without any."""
    known = docs.filter(F.col("lang").isNotNull() & learnable("doc_id", modulus, remainder))
    counts = known.groupBy("lang").agg(F.count_distinct("doc_id").alias("n"))
    # a share of the hash range for each language, so that about rows_per_lang of its ids fall in
    point = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    drawn = known.select("doc_id", "text", "lang").join(counts, "lang").filter(point < rows_per_lang / F.col("n"))
    rows = drawn.groupBy("doc_id", "lang").agg(F.max("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = features(texts_of(batch)).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "x"])

    got = rows.select("lang", "text").mapInArrow(run, "lang string, x binary").toArrow().sort_by([("lang", "ascending"), ("x", "ascending")])  # about rows_per_lang for each
    if not got.num_rows:
        return None
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float16).reshape(got.num_rows, -1).astype(np.float32)
    return learn(x, got.column("lang").to_pylist())


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean, second string"


def predict(docs: DataFrame, modulus: int = 4, remainder: int = 2, rows_per_lang: int = ROWS_PER_LANG, close: float = 0.2) -> DataFrame:
    """The language of every document of (doc_id, text, lang); only the learning reads lang."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(docs, modulus, remainder, rows_per_lang)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # buckets times bits numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in slices(batches):
            n = batch.num_rows
            best, second, score, close_call = [UNKNOWN] * n, [None] * n, np.zeros(n), np.zeros(n, bool)
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
            if m is not None:
                losses = m.losses(features(texts_of(batch)))
                p, order = m.probabilities(losses), np.argsort(losses, axis=1, kind="stable")
                for i in np.flatnonzero(lettered):
                    best[i], score[i] = m.langs[order[i, 0]], p[i, order[i, 0]]
                    if len(m.langs) > 1:
                        second[i] = m.langs[order[i, 1]]
                        close_call[i] = p[i, order[i, 0]] - p[i, order[i, 1]] < close
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(best, pa.string()), pa.array(score), pa.array(close_call), pa.array(second, pa.string())], ["doc_id", "held_out", "lang_pred", "score", "ambiguous", "second"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    return docs.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), lettered, "text").mapInArrow(run, PREDICTED)
