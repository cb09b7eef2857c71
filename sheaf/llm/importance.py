"""Importance resampling towards a target: hashed features of words, counted and scored by tries.

Words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII. A
feature is a run of 1 to ``max_words`` words joined by spaces; its bucket is the
CRC-32 of its bytes modulo ``buckets``. Every task keeps a trie of its words:
a node is a run, holds how often it came and the CRC state of its bytes, so that
a longer run's CRC goes on from its beginning's. Only totals by bucket leave a
task, then gains by bucket come back, and the second pass walks tries whose
nodes hold gains.

Memory: a trie is emptied (its counts go to the bucket totals) beyond ``NODES``
nodes, long texts are cut into parts of ``PART`` bytes that overlap by the words
a run needs, and totals and gains are one number for each bucket.

Defined cases: a null text has no words; a null id draws its noise from the
empty id and comes first among ties; repeated rows are rows of their own, and
each is counted, scored and drawn; an empty target has gains from the corpus
alone; empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import materialize, numbered, slices, small_batches

NODES = 400_000
PART = 1 << 20
SEED = 2024

#: A-Z to a-z, and all other ASCII but digits and letters to a space.
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, in order."""
    return (text or "").encode().translate(_CLEAN).split()


class _Roots(dict):
    """Words to the trie's first nodes, made when first asked for."""

    def __init__(self, trie: WordTrie):
        super().__init__()
        self.trie = trie

    def __missing__(self, word: bytes) -> int:
        self[word] = node = self.trie.add(zlib.crc32(word))
        self.trie.words[node] = b" " + word
        return node


class WordTrie:
    """Runs of words; each node's CRC state, found by (node, next word)."""

    def __init__(self):
        self.roots, self.children, self.words, self.states = _Roots(self), {}, {}, []

    def add(self, state: int) -> int:
        self.states.append(state)
        return len(self.states) - 1

    def walk(self, words: list[bytes], max_words: int) -> Iterator[tuple[int, np.ndarray]]:
        """(k, nodes): the node of words[i : i + k + 1] for every i, for k from 0."""
        first = level = np.fromiter(map(self.roots.__getitem__, words), np.int64, len(words))
        yield 0, level
        for k in range(1, max_words):
            if len(words) <= k:
                return
            steps, at = np.unique(level[: len(words) - k] << 32 | first[k:], return_inverse=True)
            found = np.empty(len(steps), np.int64)
            for i, step in enumerate(steps.tolist()):
                node = self.children.get(step)
                if node is None:
                    node = self.children[step] = self.add(zlib.crc32(self.words[step & 0xFFFFFFFF], self.states[step >> 32]))
                found[i] = node
            level = found[at]
            yield k, level

    def buckets_of(self, buckets: int) -> np.ndarray:
        return np.array(self.states, np.int64) % buckets


def _parts(texts: list[str | None], max_words: int) -> Iterator[tuple[int, list[bytes], int]]:
    """(row, words, how many of them were there before): texts in parts, each with the last words of the part before."""
    for row, text in enumerate(texts):
        data, at, kept = (text or "").encode().translate(_CLEAN), 0, []
        while at < len(data):
            end = len(data) if len(data) - at <= PART else data.find(b" ", at + PART)
            end = len(data) if end < 0 else end
            new = data[at:end].split()
            yield row, kept + new, len(kept)
            if max_words > 1:
                kept = (kept + new)[1 - max_words :]
            at = end


def _blocks(texts: list[str | None], max_words: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """Words of about PART bytes of texts at a time, with each word's part, row, and whether it is new in its part."""
    words, part, row, new, size, n = [], [], [], [], 0, 0
    for r, own, before in _parts(texts, max_words):
        words += own
        part.append(np.full(len(own), n))
        row.append(np.full(len(own), r))
        new.append(np.arange(len(own)) >= before)
        n, size = n + 1, size + sum(map(len, own))
        if size >= PART:
            yield words, np.concatenate(part), np.concatenate(row), np.concatenate(new)
            words, part, row, new, size = [], [], [], [], 0
    if words:
        yield words, np.concatenate(part), np.concatenate(row), np.concatenate(new)


def _runs(trie: WordTrie, block: tuple, max_words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(nodes, rows) of the block's runs, each run once."""
    words, part, row, new = block
    for k, nodes in trie.walk(words, max_words):
        fits = (part[: len(nodes)] == part[k:]) & new[k:]
        yield nodes[fits], row[: len(nodes)][fits]


def bucket_counts(texts: DataFrame, buckets: int, max_words: int) -> np.ndarray:
    """How many features of the texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, trie, counts = np.zeros(buckets, np.int64), WordTrie(), np.zeros(0, np.int64)

        def merged() -> np.ndarray:
            own = np.zeros(buckets, np.int64)
            np.add.at(own, trie.buckets_of(buckets), counts)
            return own

        for batch in slices(batches):
            for block in _blocks(batch.column(0).to_pylist(), max_words):
                for nodes, _ in _runs(trie, block, max_words):
                    seen = np.bincount(nodes, minlength=len(trie.states))
                    seen[: len(counts)] += counts
                    counts = seen
                if len(trie.states) > NODES:
                    totals += merged()
                    trie, counts = WordTrie(), np.zeros(0, np.int64)
        if len(counts):
            totals += merged()
        hit = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(totals[hit])], names=["bucket", "n"])

    small_batches(texts.sparkSession)
    out = np.zeros(buckets, np.int64)
    for bucket, n in texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the target's to the corpus's share of each bucket), both with one more in every bucket."""
    n = len(corpus)
    ratio = (target + 1.0) * float(corpus.sum() + n) / ((corpus + 1.0) * float(target.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, max_words: int) -> DataFrame:
    """doc_id, n_features, n_words and weight, the sum of its features' gains, of every document."""
    buckets = len(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known = WordTrie(), np.zeros(0, np.int64)
        for batch in slices(batches):
            weight, features, n_words = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for block in _blocks(batch.column(1).to_pylist(), max_words):
                for k, (nodes, rows) in enumerate(_runs(trie, block, max_words)):
                    if len(known) < len(trie.states):
                        known = np.concatenate([known, gain[np.array(trie.states[len(known) :], np.int64) % buckets]])
                    count = np.bincount(rows, minlength=batch.num_rows)
                    features += count
                    n_words += count * (k == 0)
                    starts = np.flatnonzero(np.diff(rows, prepend=-1))  # rows come in order
                    if len(starts):
                        weight[rows[starts]] += np.add.reduceat(known[nodes], starts)
                if len(trie.states) > NODES:
                    trie, known = WordTrie(), np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(features), pa.array(n_words), pa.array(weight)], names=["doc_id", "n_features", "n_words", "weight"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, n_features long, n_words long, weight long")


def resample(docs: DataFrame, target: DataFrame, buckets: int = 10_000, max_words: int = 1, least_words: int = 20, percent: int = 10) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; those with a rank are drawn.

    Noise that depends on the id alone (Gumbel, by SHA-256) makes the highest
    scores a draw without replacement in proportion to exp(weight / 1000).
    """
    corpus, goal = bucket_counts(docs, buckets, max_words), bucket_counts(target, buckets, max_words)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = materialize(weigh(docs, gains(corpus, goal), max_words).withColumn("score", F.col("weight") + noise), "resample-scores")
    able = scored.filter(F.col("n_words") >= least_words)
    take = able.count() * percent // 100
    drawn = numbered(able, [F.col("score").desc(), F.col("doc_id").asc()], "rank", "resample-ranks").withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
    return drawn.unionByName(scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))).drop("n_words")
