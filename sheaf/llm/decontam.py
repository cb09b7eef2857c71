"""Benchmark decontamination by spaced-seed hashing.

Fixed masks pick some positions of a window of tokens and ignore the rest, so a
window whose tokens were replaced at ignored positions keeps its hash. The
hashes of the benchmark's windows meet those of every document; around each hit
the document and the item are laid side by side without gaps, and the stretch
where they agree best is measured token by token. A document is contaminated by
an item if a stretch of at least ``min_tokens`` tokens (four fifths of the item,
if that is less) agrees in at least ``similarity`` of its positions.

At four fifths the masks miss no such stretch. Those of weight 6 hit every
placement of 2 substitutions in 13 tokens, 3 in 15, 4 in 20 and 5 in 25, and a
longer stretch holds one of these with no more substitutions than that. Those of
weight 4 hit 5 tokens with one substitution anywhere, which every stretch of 5 or
more has; they are for the items alone of which a stretch under 13 tokens is
enough. An item under 5 tokens, which running text holds by chance, must be a
whole line.

Tokens are lower-cased words without punctuation. The benchmark meets the
documents in blocks of ``block_chars`` characters at most (an item is never
split): each is small enough to go to every task, and a larger benchmark takes
more passes over the documents, one block after the other, without any limit on
its items.

Defined results: null and empty texts match nothing, and ``clean`` keeps them;
items without a token match nothing; repeated documents are reported each, and
kept or dropped alike; repeated items are reported under each id, items without
an id not at all; an empty benchmark or table gives no rows. Extra columns are
not read; ``clean`` returns them as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import discard, materialize, slices, small_batches, texts_of

#: Fixed masks of weight 6, and of weight 4 for short items; 1 is a position that counts.
MASKS = ("110001111", "11011000011", "10011010101", "10100101011", "1110010000011")
SHORT_MASKS = ("1111", "10111", "11011", "11101")
SIMILARITY = 0.8
MIN_TOKENS = 13
#: Items of fewer tokens must be a whole line.
MIN_ITEM = 5
#: Hits, and cells of laid-out stretches, that a task holds at a time.
HELD = 1 << 20
BLOCK_CHARS = 16_000_000
FILTER_BITS = 22

_WORD = re.compile(r"\w+")
_MIX = np.random.default_rng(5).integers(1, 1 << 62, 32, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def seed_hashes(ids: np.ndarray, mask: str) -> np.ndarray:
    """The mask's hash at every window of a document's token numbers."""
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, _MIX[len(mask)], np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            h = (h ^ ids[k : k + n]) * _MIX[k]
            h ^= h >> np.uint64(29)
    return h


def stretch_of(n: int, similarity: float = SIMILARITY, min_tokens: int = MIN_TOKENS) -> int:
    """The tokens that a stretch must have at least for an item of n tokens."""
    return min(min_tokens, max(1, round(similarity * n)))


class Seeds:
    """A block of the benchmark: token numbers, and where each seed hash occurs."""

    def __init__(self, items: list[tuple[int, str]]):
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        self.lines: dict[tuple[str, ...], list[int]] = {}
        for item, text in items:
            own = tokens(text)
            if len(own) >= MIN_ITEM:
                self.items.append((item, np.array([self.vocabulary.setdefault(t, len(self.vocabulary) + 1) for t in own], np.uint64)))
            elif own:
                self.lines.setdefault(tuple(own), []).append(item)
        self.tables = []
        for masks, use in ((MASKS, lambda n: stretch_of(n) >= MIN_TOKENS), (SHORT_MASKS, lambda n: stretch_of(n) < MIN_TOKENS)):
            own = [(k, ids) for k, (_, ids) in enumerate(self.items) if use(len(ids))]
            for mask in masks if own else ():
                each = [(k, seed_hashes(ids, mask)) for k, ids in own]
                h = np.concatenate([x for _, x in each])
                item = np.concatenate([np.full(len(x), k) for k, x in each])
                at = np.concatenate([np.arange(len(x)) for _, x in each])
                order = np.argsort(h, kind="stable")
                bits = np.zeros(1 << FILTER_BITS, bool)
                bits[h >> np.uint64(64 - FILTER_BITS)] = True
                self.tables.append((mask, h[order], item[order], at[order], bits))

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.uint64, len(words))

    def diagonals(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, document position less item position) of all hits, each once, in order."""
        keys = [np.zeros(0, np.int64)]
        for mask, table, item, at, bits in self.tables:
            h = seed_hashes(ids, mask)
            p = np.flatnonzero(bits[h >> np.uint64(64 - FILTER_BITS)])
            lo = np.searchsorted(table, h[p], "left")
            times = np.searchsorted(table, h[p], "right") - lo
            upto = np.cumsum(times)
            begin = 0
            while begin < len(p):
                end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + HELD, "right")))
                n = times[begin:end]
                i = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[begin:end], n)
                # shifts are no less than minus the longest item
                keys.append((item[i] << 40) + np.repeat(p[begin:end], n) - at[i] + (1 << 39))
                if sum(map(len, keys)) > 2 * HELD:
                    keys = [np.unique(np.concatenate(keys))]
                begin = end
        found = np.unique(np.concatenate(keys))
        return found >> 40, (found & ((1 << 40) - 1)) - (1 << 39)


def best_stretch(same: np.ndarray, similarity: float) -> tuple[int, int]:
    """The longest stretch [start, end) that begins and ends with agreement and agrees in at least that share."""
    score = np.r_[0, np.cumsum(same - similarity)] + 1e-9 * np.arange(len(same) + 1)
    low = np.minimum.accumulate(np.where(same, score[:-1], np.inf))
    best = (0, 0)
    for end in np.flatnonzero(same)[::-1] + 1:
        if end - best[1] + best[0] <= 0 and best != (0, 0):
            break
        start = int(np.argmax(low <= score[end]))
        # low falls; the first agreement whose prefix is not above this one begins the longest stretch
        if end - start > best[1] - best[0]:
            best = (start, int(end))
    return best


def best_overlap(ids: np.ndarray, own: np.ndarray, shifts: np.ndarray, similarity: float, min_tokens: int) -> tuple[int, int, int] | None:
    """(start, tokens, equal tokens) of the stretch with most equal tokens over an item's shifts; the smallest shift of equals.

    A stretch has no more equal tokens than its shift in all, so shifts are
    measured by falling number of these, until none can be better.
    """
    least = stretch_of(len(own), similarity, min_tokens)
    padded = np.concatenate([np.zeros(len(own), np.uint64), ids, np.zeros(len(own), np.uint64)])
    step = max(1, HELD // len(own))
    equal = np.concatenate([(padded[shifts[at : at + step, None] + np.arange(len(own), 2 * len(own))] == own).sum(1) for at in range(0, len(shifts), step)])
    best: tuple[int, int, int] | None = None
    for i in np.argsort(-equal, kind="stable"):
        if equal[i] < similarity * least or (best and equal[i] <= best[2]):
            break
        shift = int(shifts[i])
        lo, hi = max(0, shift), min(len(ids), shift + len(own))
        same = ids[lo:hi] == own[lo - shift : hi - shift]
        start, end = best_stretch(same, similarity)
        n, right = end - start, int(same[start:end].sum())
        if n >= least and right >= similarity * n and (best is None or right > best[2]):
            best = (lo + start, n, right)
    return best


def overlaps(text: str, seeds: Seeds, similarity: float = SIMILARITY, min_tokens: int = MIN_TOKENS) -> list[tuple[int, int, int, int, float]]:
    """(item_id, first token, tokens, equal tokens, share) of the best stretch of each item in a text."""
    ids = seeds.numbers(tokens(text))
    out = []
    item, shift = seeds.diagonals(ids)
    bounds = [0, *(np.flatnonzero(np.diff(item)) + 1), len(item)] if len(item) else []
    for lo, hi in pairwise(bounds):
        number, own = seeds.items[item[lo]]
        if best := best_overlap(ids, own, shift[lo:hi], similarity, min_tokens):
            out.append((number, *best, best[2] / best[1]))
    if seeds.lines:
        at, met = 0, set()
        for line in text.splitlines():
            own = tuple(tokens(line))
            out += [(number, at, len(own), len(own), 1.0) for number in seeds.lines.get(own, ()) if (number, own) not in met]
            met |= {(number, own) for number in seeds.lines.get(own, ())}
            at += len(own)
    return out


FOUND = "doc_id long, item_id long, start_token int, n_tokens int, n_same int, similarity double"


def contamination(docs: DataFrame, sent: object, similarity: float, min_tokens: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(doc, *found) for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True) for found in overlaps(text, sent.value, similarity, min_tokens)]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [x.split()[0] for x in FOUND.split(", ")])

    return docs.mapInArrow(run, FOUND)


def without(docs: DataFrame, sent: object, similarity: float, min_tokens: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([not overlaps(t, sent.value, similarity, min_tokens) for t in texts_of(batch)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def blocks(benchmark: DataFrame, block_chars: int) -> Iterator[tuple[Seeds, bool]]:
    """The benchmark in blocks that are each small enough for every task, and whether there is but one."""
    own = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).filter(F.col("item_id").isNotNull())
    chars = own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = -(-chars // block_chars)
    for k in range(n):
        part = own if n == 1 else own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        if rows := sorted((r["item_id"], r["text"]) for r in part.collect()):
            yield Seeds(rows), n == 1


def report(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, min_tokens: int = MIN_TOKENS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for each contaminated document and the item found in it; clean documents have none.

    Where there are several blocks, what one found is written and the block
    released before the next.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own, parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), []
    for seeds, alone in blocks(benchmark, block_chars):
        sent = spark.sparkContext.broadcast(seeds)
        found = contamination(own, sent, similarity, min_tokens)
        if not alone:
            found = materialize(found, "decontam-found")
            sent.destroy()
        parts.append(found)
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], FOUND)


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, min_tokens: int = MIN_TOKENS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents without contamination, with all their columns."""
    spark, before = docs.sparkSession, None
    small_batches(spark)
    for seeds, alone in blocks(benchmark, block_chars):
        sent = spark.sparkContext.broadcast(seeds)
        docs = without(docs, sent, similarity, min_tokens)
        if not alone:
            docs = materialize(docs, "decontam-docs")
            sent.destroy()
            if before is not None:
                discard(before)
            before = docs
    return docs
