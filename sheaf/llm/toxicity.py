"""Toxicity by nearest labelled examples: exact TF-IDF cosine on a block-max index.

Terms are lower-cased words and the beginnings of longer words. The examples
are a bounded set of labelled documents; their terms are weighted by
(1 + log tf) * idf * sqrt(chi), where chi is a term's association with the label
among the learning rows, and terms without any are left out: a cosine over all
terms is ruled by what a text is about, and misses a few words in a long one
(figures in the README). The index keeps, for
each term, its postings by example and the largest weight in every block of
examples. A query sums those maxima over its terms, visits the blocks by
falling bound, and stops when no bound left reaches its k-th best cosine, so
the k nearest examples are exact, ties to the smaller example id.

The neighbours vote with their cosines; a logistic curve fitted on the examples'
own leave-one-out votes calibrates the score. Evidence is the neighbours' ids
and, for a text found toxic, the terms that add more to the cosines of its toxic
neighbours than to those of the others.

Every document is scored over its whole text. Defined results: null and empty
texts, and texts without a known term, have no neighbours and get the
calibrated score of an empty vote; rows with a null id are scored, neither held
out nor learned from; documents with conflicting label rows are no examples;
repeated rows are scored each; without examples of both kinds every score is the
share of toxic ones, or 0; an empty table gives no rows. Extra columns are not
read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import held_out, labelled_sample, materialize, slices, small_batches, texts_of

MAX_EXAMPLES = 8000
MAX_TERMS = 4096
BLOCK = 64
NEIGHBOURS = 15
#: Beginnings of words that are terms of their own, by length.
STEMS = (4, 5, 6, 7, 8, 9)
MIN_EXAMPLES = 3
#: A term's association over this has a chance of 1 in 100.
LEAST_CHI = 6.6
CACHE_WORDS = 300_000

_WORD = re.compile(r"\w+")


def terms_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}~" for n in STEMS if n < len(word))]


class Known(dict):
    """word -> numbers of its known terms."""

    def __init__(self, numbers: dict[str, int]):
        super().__init__()
        self.numbers = numbers

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = out = tuple(self.numbers[t] for t in terms_of(word) if t in self.numbers)
        return out

    def counts(self, text: str) -> dict[int, int]:
        out: dict[int, int] = {}
        words = Counter(_WORD.findall(text.lower()))
        for terms, n in zip(map(self.__getitem__, words), words.values(), strict=True):
            for t in terms:
                out[t] = out.get(t, 0) + n
        return out


@dataclass
class Index:
    """Postings sorted by term, then example, with each term's largest weight in every block."""

    ids: np.ndarray
    labels: np.ndarray
    terms: list[str]
    weight: np.ndarray  # of a term
    pointers: np.ndarray  # terms x (blocks + 1): where a block's postings of a term begin
    examples: np.ndarray
    values: np.ndarray
    block_max: np.ndarray  # terms x blocks
    curve: tuple[float, ...] = (0.0, 0.0, 0.0)
    numbers: dict[str, int] = field(default_factory=dict)

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        terms = np.fromiter(sorted(counts), np.int64, len(counts))
        tf = np.array([counts[t] for t in terms], np.float64)
        w = (1 + np.log(tf)) * self.weight[terms] if len(terms) else tf
        norm = np.sqrt((w * w).sum())
        return terms, w / norm if norm else w

    def nearest(self, terms: np.ndarray, w: np.ndarray, k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the k nearest examples with a cosine over 0, but one of them."""
        bound = w @ self.block_max[terms] * (1 + 1e-9)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        rows, cosines = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 4
        while at < len(order):
            if len(cosines) >= k and bound[order[at]] < cosines[k - 1]:
                break
            blocks = order[at : at + step]
            if len(cosines) >= k:
                blocks = blocks[bound[blocks] >= cosines[k - 1]]
            at, step = at + step, step * 4
            begins = self.pointers[terms[:, None], blocks[None, :]].ravel()
            sizes = self.pointers[terms[:, None], blocks[None, :] + 1].ravel() - begins
            if not (total := int(sizes.sum())):
                continue
            posting = np.arange(total) + np.repeat(begins - np.cumsum(sizes) + sizes, sizes)
            place = self.examples[posting] + np.repeat(np.tile((np.arange(len(blocks)) - blocks) * BLOCK, len(terms)), sizes)
            score = np.bincount(place, self.values[posting] * np.repeat(np.repeat(w, len(blocks)), sizes))
            hit = np.flatnonzero(score)  # weights are over 0
            found = blocks[hit // BLOCK] * BLOCK + hit % BLOCK
            keep = found != but
            rows, cosines = np.r_[rows, found[keep]], np.r_[cosines, score[hit[keep]]]
            if len(cosines) > k:  # those that can't be among the first k needn't be sorted
                near = cosines >= np.partition(cosines, len(cosines) - k)[len(cosines) - k] - 1e-11
                rows, cosines = rows[near], cosines[near]
            best = np.lexsort((rows, -np.round(cosines, 12)))[:k]
            rows, cosines = rows[best], cosines[best]
        return rows, cosines

    def evidence(self, terms: np.ndarray, w: np.ndarray, rows: np.ndarray, most: int = 5) -> list[str]:
        """The terms that speak for the toxic neighbours, the strongest first."""
        order = np.argsort(rows)
        near, side = rows[order], np.where(self.labels[rows[order]] == 1, 1.0, -1.0)
        speaks = np.zeros(len(terms))
        for i, t in enumerate(terms):
            lo, hi = self.pointers[t, 0], self.pointers[t, -1]
            at = lo + np.searchsorted(self.examples[lo:hi], near)
            there = (at < hi) & (self.examples[np.minimum(at, len(self.examples) - 1)] == near)
            speaks[i] = w[i] * (self.values[at[there]] * side[there]).sum()
        best = np.argsort(-speaks, kind="stable")[:most]
        return [self.terms[terms[i]] for i in best if speaks[i] > 0]

    def votes(self, rows: np.ndarray, cosines: np.ndarray) -> tuple[float, float]:
        """The share of the cosines that votes toxic, and the largest toxic cosine."""
        toxic = self.labels[rows] * cosines
        return (float(toxic.sum() / cosines.sum()), float(toxic.max())) if len(rows) else (0.0, 0.0)

    def score(self, share: float, top: float) -> float:
        a, b, c = self.curve
        return float(1 / (1 + np.exp(-np.clip(a * share + b * top + c, -30, 30))))


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton's method, with a small ridge."""
    z, beta = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        curve = z.T @ (z * (p * (1 - p))[:, None]) + 1e-2 * np.eye(len(beta))
        move = np.linalg.solve(curve, z.T @ (y - p) - 1e-2 * beta)
        beta += move
        if np.abs(move).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def chosen_terms(rows: list[tuple[int, int, list[tuple[str, int]]]]) -> list[tuple[str, int, float]]:
    """(term, examples that have it, chi square) of the terms most associated with the label."""
    has, toxic = Counter(), Counter()
    for _, label, terms in rows:
        has.update(t for t, _ in terms)
        if label:
            toxic.update(t for t, _ in terms)
    n, positive = len(rows), sum(r[1] for r in rows)
    chi = {t: association(a, toxic[t], n, positive) for t, a in has.items() if MIN_EXAMPLES <= a < n}
    return [(t, has[t], chi[t]) for t in sorted((t for t, c in chi.items() if c > LEAST_CHI), key=lambda t: (-chi[t], t))[:MAX_TERMS]]


def association(has, toxic, n: int, positive: int):
    """Chi square of a term and the label over n examples; numbers or columns."""
    expected = has * (positive / n)
    return (toxic - expected) * (toxic - expected) * n / (expected * (n - positive) * (1 - has / n) + 1e-12)


def build(rows: list[tuple[int, int, list[tuple[str, int]]]], chosen: list[tuple[str, int, float]] | None = None) -> Index | None:
    """The index over (id, label, [(term, tf)]) rows; None without rows of both kinds."""
    rows = sorted(rows, key=lambda r: r[0])
    y = np.array([r[1] for r in rows], np.float64)
    if len(set(y)) < 2:
        return None
    n = len(y)
    chosen = chosen_terms(rows) if chosen is None else chosen
    terms = [t for t, _, _ in chosen]
    numbers = {t: i for i, t in enumerate(terms)}
    weight = np.array([np.log((n + 1) / (a + 0.5)) * np.sqrt(c) for _, a, c in chosen])
    entries = []
    for e, (_, _, own) in enumerate(rows):
        known = [(numbers[t], tf) for t, tf in own if t in numbers]
        w = np.array([(1 + np.log(tf)) * weight[t] for t, tf in known])
        if len(w) and (norm := np.sqrt((w * w).sum())):
            entries += [(t, e, v / norm) for (t, _), v in zip(known, w, strict=True)]
    entries.sort()
    term, example, value = (np.array(c) for c in zip(*entries, strict=True)) if entries else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    blocks = -(-n // BLOCK)
    key = term * blocks + example // BLOCK
    flat = np.searchsorted(key, np.arange(len(terms) * blocks + 1))
    pointers = np.stack([flat[i * blocks : (i + 1) * blocks + 1] for i in range(len(terms))]) if terms else np.zeros((0, blocks + 1), int)
    block_max = np.zeros(len(terms) * blocks)
    np.maximum.at(block_max, key, value)
    index = Index(np.array([r[0] for r in rows]), y, terms, weight, pointers, example, value, block_max.reshape(len(terms), blocks), numbers=numbers)
    seen = [{numbers[t]: tf for t, tf in own if t in numbers} for _, _, own in rows]
    votes = np.array([index.votes(*index.nearest(*index.vector(c), NEIGHBOURS, e)) for e, c in enumerate(seen)])
    index.curve = calibrate(votes, y)
    return index


def fit(docs: DataFrame, labels: DataFrame, modulus: int, remainder: int, max_examples: int) -> tuple[Index | None, float]:
    """The index and the share of toxic examples."""
    sample = materialize(labelled_sample(docs, labels, "toxic", modulus, remainder, max_examples), "toxic-sample")
    known = [(r["doc_id"], r["label"]) for r in sample.select("doc_id", "label").collect()]
    n, positive = len(known), sum(y for _, y in known)
    if not 0 < positive < n:
        return None, positive / n if n else 0.0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has, toxic = Counter(), Counter()
        for batch in slices(batches):
            for text, label in zip(texts_of(batch), batch.column("label").to_pylist(), strict=True):
                own = {t for word in set(_WORD.findall(text.lower())) for t in terms_of(word)}
                has.update(own)
                if label:
                    toxic.update(own)
        yield pa.RecordBatch.from_arrays([pa.array(list(has), pa.string()), pa.array(list(has.values()), pa.int64()), pa.array([toxic[t] for t in has], pa.int64())], ["term", "has", "toxic"])

    counts = sample.select("text", "label").mapInArrow(count, "term string, has long, toxic long").groupBy("term").agg(F.sum("has").alias("has"), F.sum("toxic").alias("toxic"))
    chi = association(F.col("has").cast("double"), F.col("toxic").cast("double"), n, positive).alias("chi")
    best = counts.filter((F.col("has") >= MIN_EXAMPLES) & (F.col("has") < n)).select("term", "has", chi).filter(F.col("chi") > LEAST_CHI).orderBy(F.desc("chi"), "term").limit(MAX_TERMS)
    chosen = [tuple(r) for r in best.collect()]
    numbers = {t: i for i, (t, _, _) in enumerate(chosen)}

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Known(numbers)
        for batch in slices(batches):
            found = [words.counts(t) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array([list(c) for c in found], pa.list_(pa.int32())), pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))], ["doc_id", "label", "terms", "counts"])

    got = sample.mapInArrow(pick, "doc_id long, label int, terms array<int>, counts array<int>").collect()  # chosen terms of the sample alone
    rows = [(r["doc_id"], r["label"], [(chosen[t][0], c) for t, c in zip(r["terms"], r["counts"], strict=True)]) for r in got]
    return build(rows, chosen), positive / n


SCORED = "doc_id long, held_out boolean, score double, predicted int, neighbours array<long>, cosines array<double>, evidence array<string>"


def score(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, max_examples: int = MAX_EXAMPLES, k: int = NEIGHBOURS, threshold: float = 0.5) -> DataFrame:
    """Score, prediction and evidence of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sent = spark.sparkContext.broadcast(fit(docs, labels, modulus, remainder, max_examples))  # bounded by examples and terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, share = sent.value
        known = Known(index.numbers if index else {})
        for batch in slices(batches):
            scores, near, cos, why = [], [], [], []
            for text in texts_of(batch):
                if index is None:
                    p, rows, cosines, terms = share, np.zeros(0, int), np.zeros(0), np.zeros(0, int)
                else:
                    terms, w = index.vector(known.counts(text))
                    rows, cosines = index.nearest(terms, w, k)
                    p = index.score(*index.votes(rows, cosines))
                scores.append(p)
                near.append(index.ids[rows].tolist() if index else [])
                cos.append(cosines.tolist())
                why.append(index.evidence(terms, w, rows) if index and p >= threshold else [])
            p = np.array(scores, np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array(near, pa.list_(pa.int64())), pa.array(cos, pa.list_(pa.float64())), pa.array(why, pa.list_(pa.string()))], ["doc_id", "held_out", "score", "predicted", "neighbours", "cosines", "evidence"])

    return docs.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "text").mapInArrow(run, SCORED)
