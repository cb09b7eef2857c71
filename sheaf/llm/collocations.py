"""Collocations: phrases whose words come together more often than their parts suggest, by counting n-grams of word ids.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?]`` and line ends, and
pieces into words at spaces and tabs. Words that come ``least`` times in their
language get an id; all others break pieces, because no phrase with such a word
can be frequent. Ids are written once, then n-grams of 2 to 4 ids are packed
into keys of 128 bits (two longs), counted run by run in tasks, dealt by ranges,
sorted and counted as runs. An n-gram is only counted where its two
(n-1)-grams may be frequent, which a bitmap of fixed size tells: it lets some
others through, never drops one.

Memory: ``DICTIONARY`` words are broadcast at most; where more are frequent, ids
come by a join instead (same result). Tasks hold ``KEYS`` keys, ``WORDS``
counted words or a part of ``PART`` bytes of text; the bitmap has a fixed number of bits.

Defined cases: null texts are empty, a null language is ``und``, repeated rows
count as often as they come, empty tables give no phrases, ids and other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.bitmaps import bitmap, is_set
from sheaf.llm.common import discard, materialize, numbered, slices, small_batches

MAX_WORDS = 4
DICTIONARY = 1 << 20
KEYS = 1 << 21
WORDS = 1 << 19
PART = 1 << 20
SALTS = 64

_ENDS = b".,;:!?\n\x0b\x0c\r"
#: A-Z to a-z, tabs to spaces, ends of pieces to line feeds.
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in _ENDS else b for b in range(256))
#: Stands for the end of a piece among words; no text holds this byte.
_END = b"\xff"


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes, bool]]:
    """(lang, cleaned bytes, whether they go on the part before): texts of a language side by side, long ones in parts cut between words."""
    by_lang = defaultdict(list)
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        if text:
            by_lang["und" if lang is None else lang].append(text.encode())
    for lang, texts in by_lang.items():
        data, at = b"\n".join(texts).translate(_CLEAN), 0
        while at < len(data):
            end = min((found for sep in (b" ", b"\n") if (found := data.find(sep, at + PART)) >= 0), default=len(data))
            yield lang, data[at:end], at > 0
            at = end


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all texts."""

    def rows(counts: dict[str, Counter]) -> pa.RecordBatch:
        flat = [(lang, word, n) for lang, own in counts.items() for word, n in own.items()]
        lang, word, n = zip(*flat, strict=True) if flat else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], names=["lang", "word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = defaultdict(Counter)
        for batch in slices(batches):
            for lang, data, _ in _parts(batch):
                counts[lang].update(data.split())
                if sum(map(len, counts.values())) > WORDS:
                    yield rows(counts)
                    counts = defaultdict(Counter)
        yield rows(counts)

    small_batches(docs.sparkSession)
    return docs.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class _Ids:
    """Ids of a language's words and ends as a row of an ids table: what it repeats of the row before comes first."""

    def __init__(self):
        self.kept = np.zeros(0, np.int32)

    def row(self, ids: np.ndarray, goes_on: bool) -> tuple[bytes, int]:
        kept = self.kept if goes_on else self.kept[:0]
        both = np.concatenate([kept, ids])
        self.kept = both[1 - MAX_WORDS :]
        return both.tobytes(), len(kept)


def encoded(docs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(ids, before): int32 ids of all words in order, 0 where a phrase can't go on; the first ``before`` repeat the row before."""
    sc = docs.sparkSession.sparkContext
    by_lang = defaultdict(dict)
    for lang, word, n in dictionary.select("lang", "word", "id").toLocalIterator():
        by_lang[lang][word.encode()] = n
    known = sc.broadcast(dict(by_lang))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Ids()
        for batch in slices(batches):
            out = []
            for lang, data, goes_on in _parts(batch):
                words = data.replace(b"\n", b" \xff ").split()
                ids = np.fromiter(map(known.value.get(lang, {}).get, words, repeat(0)), np.int32, len(words))
                out.append(own.row(ids, goes_on))
            if out:
                ids, before = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(before, pa.int32())], names=["ids", "before"])

    return docs.select("lang", "text").mapInArrow(encode, "ids binary, before int")


def encoded_by_join(docs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """What ``encoded`` gives, for a dictionary of any size: every word meets its id in a join."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, kept = TaskContext.get().partitionId() << 40, []
        for batch in slices(batches):
            for lang, data, goes_on in _parts(batch):
                new = data.replace(b"\n", b" \xff ").split()
                kept = kept if goes_on else []
                words = kept + new
                part += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(words), pa.int64()), pa.array(range(len(words)), pa.int32()), pa.array([len(kept)] * len(words), pa.int32()), pa.array([lang] * len(words), pa.string()), pa.array([None if w == _END else w for w in words], pa.binary()).cast(pa.string())],
                    names=["part", "pos", "before", "lang", "word"],
                )
                kept = words[1 - MAX_WORDS :]

    def gather(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        ids = table.column("id").to_numpy().astype(np.int32).tobytes()
        return pa.table({"ids": pa.array([ids], pa.binary()), "before": table.column("before").slice(0, 1).cast(pa.int32())})

    words = docs.select("lang", "text").mapInArrow(spread, "part long, pos int, before int, lang string, word string")
    found = words.join(dictionary.select("lang", "word", "id"), ["lang", "word"], "left").select("part", "pos", "before", F.coalesce("id", F.lit(0)).cast("int").alias("id"))
    return found.groupBy("part").applyInArrow(gather, "ids binary, before int")


def _keys(ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the n ids from every place."""
    m = max(len(ids) - n + 1, 0)
    at = [ids[k : k + m].astype(np.int64) if k < n else np.zeros(m, np.int64) for k in range(4)]
    return at[0] << 32 | at[1], at[2] << 32 | at[3]


def _runs(hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys with counts: each key once, its counts added."""
    new = np.ones(len(hi), bool)
    new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
    starts = np.flatnonzero(new)
    return hi[starts], lo[starts], np.add.reduceat(n, starts) if len(starts) else n[:0]


def _batch(hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo), pa.array(n)], names=["hi", "lo", "n"])


def gram_counts(ids: DataFrame, n: int, least: int, shorter: np.ndarray | None) -> DataFrame:
    """(hi, lo, n) of the n-grams that come ``least`` times or more, as a table."""
    spark = ids.sparkSession
    may = None if shorter is None else spark.sparkContext.broadcast(shorter)

    def sorted_batch(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        hi, lo = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(hi) if n == 2 else np.lexsort((lo, hi))
        return _batch(*_runs(hi[order], lo[order], np.ones(len(hi), np.int64)))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(row, np.int32)
                there = own > 0
                m = max(len(own) - n + 1, 0)
                fits = np.logical_and.reduce([there[k : k + m] for k in range(n)])
                fits[: max(before - n + 1, 0)] = False
                hi, lo = _keys(own, n)
                if may is not None:
                    maybe = is_set(may.value, *_keys(own, n - 1))
                    fits &= maybe[:m] & maybe[1 : m + 1]
                at = np.flatnonzero(fits)
                held.append((hi[at], lo[at]))
                size += len(at)
                if size >= KEYS:
                    yield sorted_batch(held)
                    held, size = [], 0
        if size:
            yield sorted_batch(held)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the run that may go on in the next batch
        for batch in batches:
            own = tuple(batch.column(k).to_numpy() for k in range(3))
            if not len(own[0]):
                continue
            hi, lo, count = _runs(*(own if last is None else (np.concatenate(x) for x in zip(last, own, strict=True))))
            done = count[:-1] >= least
            yield _batch(hi[:-1][done], lo[:-1][done], count[:-1][done])
            last = hi[-1:], lo[-1:], count[-1:]
        if last is not None and last[2][0] >= least:
            yield _batch(*last)

    partial = materialize(ids.mapInArrow(packed, "hi long, lo long, n long"), f"grams-{n}")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = ["hi"] if n == 2 else ["hi", "lo"]
    out = materialize(partial.repartitionByRange(parts, *key).sortWithinPartitions(*key).mapInArrow(counted, "hi long, lo long, n long"), f"frequent-{n}")
    discard(partial)
    return out


def _word(k: int) -> Column:
    """The id of word k (from 0) of a key; 0 beyond its end."""
    half = F.col("hi" if k < 2 else "lo")
    return F.shiftright(half, 32) if k % 2 == 0 else half.bitwiseAND(F.lit(0xFFFFFFFF))


def _part(first: int, words: int, name: str) -> list[Column]:
    """The key of some words of a key, as two columns."""
    ids = [_word(first + k) if k < words else F.lit(0).cast("long") for k in range(4)]
    return [F.shiftleft(ids[0], 32).bitwiseOR(ids[1]).alias(f"{name}_hi"), F.shiftleft(ids[2], 32).bitwiseOR(ids[3]).alias(f"{name}_lo")]


def _exact(col: str) -> Column:
    return F.col(col).cast("decimal(20,0)")


def scored(grams: dict[int, DataFrame], dictionary: DataFrame) -> DataFrame:
    """Candidates with a and the lowest-scoring cut: k, l, r, score."""
    single = dictionary.select(F.shiftleft(F.col("id").cast("long"), 32).alias("hi"), F.lit(0).cast("long").alias("lo"), "n")
    counts = single
    for n in sorted(grams)[:-1]:
        counts = counts.unionByName(grams[n])
    cuts = None
    for n, own in grams.items():
        each = [F.struct(F.lit(k).alias("k"), *_part(0, k, "first"), *_part(k, n - k, "rest")) for k in range(1, n)]
        rows = own.select("hi", "lo", F.col("n").alias("a"), F.explode(F.array(*each)).alias("cut")).select("hi", "lo", "a", "cut.*")
        cuts = rows if cuts is None else cuts.unionByName(rows)
    for name, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select(F.col("hi").alias(f"{name}_hi"), F.col("lo").alias(f"{name}_lo"), F.col("n").alias(count)), [f"{name}_hi", f"{name}_lo"])
    score = F.expr("cast((2000000 * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + r) as bigint)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return cuts.groupBy("hi", "lo", "a").agg(best).select("hi", "lo", "a", "best.*")


def covered(grams: dict[int, DataFrame]) -> DataFrame:
    """(hi, lo, most): phrases inside longer candidates with the largest count of one of these."""
    out = None
    for n in sorted(grams)[1:]:
        inner = [F.struct(*_part(at, words, "in")) for words in range(2, n) for at in range(n - words + 1)]
        rows = grams[n].select("n", F.explode(F.array(*inner)).alias("x")).select(F.col("x.in_hi").alias("hi"), F.col("x.in_lo").alias("lo"), "n")
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("hi", "lo").agg(F.max("n").alias("most"))


def mine(docs: DataFrame, least: int = 30, cover: int = 80, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to 4 words."""
    spark = docs.sparkSession
    words = materialize(word_counts(docs), "words")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("total"))
    dictionary = numbered(words.filter(F.col("n") >= least), [F.col("n").desc(), F.col("lang").asc(), F.col("word").asc()], "id", "dictionary")
    few = dictionary.count() <= DICTIONARY
    ids = materialize((encoded if few else encoded_by_join)(docs, dictionary), "word-ids")
    grams, bits = {}, None
    for n in range(2, MAX_WORDS + 1):
        grams[n] = gram_counts(ids, n, least, bits)
        bits = bitmap(grams[n])
    discard(ids)
    kept = scored(grams, dictionary).join(covered(grams), ["hi", "lo"], "left")
    kept = kept.filter(F.col("most").isNull() | (100 * _exact("most") < cover * _exact("a"))).drop("most")
    kept = kept.join(dictionary.select(F.col("id").alias("id1"), "lang"), _word(0) == F.col("id1")).drop("id1")
    best = [F.col("score").desc(), F.col("a").desc()]
    salt = F.pmod(F.xxhash64("hi", "lo"), F.lit(SALTS))
    for by in (["lang", salt], ["lang"]):  # ties at the end stay until phrases are known
        kept = kept.withColumn("place", F.rank().over(Window.partitionBy(*by).orderBy(*best))).filter(F.col("place") <= top).drop("place")
    kept = materialize(kept, "collocations")
    each = F.posexplode(F.filter(F.array(*(_word(k) for k in range(4))), lambda x: x > 0)).alias("pos", "id")
    names = kept.select("hi", "lo", each).join(dictionary.select("id", "word"), "id").groupBy("hi", "lo").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("words"))
    named = kept.join(names, ["hi", "lo"]).withColumn("phrase", F.array_join(F.col("words.word"), " "))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*best, F.col("phrase").asc())).cast("long")
    out = named.withColumn("rank", place).filter(F.col("rank") <= top).join(sizes, "lang")
    return out.select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
