"""Language-model scores: context-tree weighting beside a unigram base.

Texts are lower-cased in A-Z and read as words; a text's stream is its words
with single spaces between them and one end after them. The tree model (ctw.py)
gives the log10 probability of the stream's bytes and the code length per byte,
the base the log10 probability of words and end under smoothed counts. Both
learn from all learnable rows, whole texts: counts of words and of byte strings
are gathered by tasks first and summed by Spark after.

The byte strings' counts make the model. Its depth is the same at every size,
and its nodes are never in one place: strings are dealt into buckets by the last
two bytes of their context, so a bucket holds whole subtrees. The roots of these
subtrees are summed to the nodes of depth 0 and 1, which are 65,535 at most and
go to every task. Texts are dealt into chunks; a chunk's different strings meet
the model's buckets, and what they cost meets the chunk's texts. Buckets and
chunks grow in number with the input, not in size.

Words are looked up in two ways. Those counted most often, ``max_frequent`` at
most, go to every task; a text's other words are joined with the counts.

Defined results: null and empty texts are one end; rows with a null id are
scored, neither held out nor learned from; repeated rows are learned from and
scored as often as they occur; with nothing to learn from every base score is
that of an empty count; an empty table gives no rows. Extra columns are not
read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import held_out, learnable, materialize, slices, small_batches
from sheaf.llm.ctw import Model, Slots, grams_of, parent_key, top_of

DEPTH = 4
#: Bytes of context that say which bucket a string is in; strings in a bucket, bytes of text in a chunk.
SHARED_BYTES = 2
BUCKET_GRAMS = 30_000
CHUNK_BYTES = 8_000_000
MAX_FREQUENT = 50_000
#: Different words or strings that a task adds up before it passes them on.
HELD = 1_000_000
END = b"\n"
SMOOTHING = 0.1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def stream_of(words: list[bytes], depth: int) -> np.ndarray:
    """The bytes of a text after as many ends as the model looks back."""
    return np.frombuffer(END * depth + b" ".join(words) + END, np.uint8)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; the end is not among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                counts.update(words_of(text))
                if len(counts) >= HELD:
                    yield flush()
        yield flush()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def gram_counts(docs: DataFrame, size: int) -> DataFrame:
    """(gram, n) of all strings of this many bytes in the texts' streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting: list[np.ndarray] = []
        seen = 0

        def gather() -> None:
            if waiting:
                held.append(np.unique(np.concatenate(waiting), return_counts=True))
                waiting.clear()
            if len(held) > 1:
                grams, place = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
                held[:] = [(grams, np.bincount(place, np.concatenate([n for _, n in held])).astype(np.int64))]

        def flush() -> pa.RecordBatch:
            grams, n = held.pop() if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            return pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], ["gram", "n"])

        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                waiting.append(grams_of(stream_of(words_of(text), size - 1), size))
                seen += len(waiting[-1])
                if seen >= 2 * HELD:
                    gather()
                    seen = 0
                    if len(held[0][0]) >= HELD:
                        yield flush()
        gather()
        yield flush()

    return docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def bucket_of(grams, shared: int, buckets: int):
    """The bucket of strings by the last bytes of their contexts; of an array or a column of longs."""
    ending = (grams >> 8) & ((1 << (8 * shared)) - 1) if isinstance(grams, np.ndarray) else F.shiftright(grams, 8).bitwiseAND(F.lit((1 << (8 * shared)) - 1))
    spread = (ending * 40503) & 65535 if isinstance(grams, np.ndarray) else (ending * 40503).bitwiseAND(F.lit(65535))
    return spread % buckets


def model_of(counted: pa.Table, depth: int, **kw) -> Model:
    return Model(counted.column("gram").to_numpy().view(np.uint64), counted.column("n").to_numpy().astype(np.float64), depth, **kw)


def fit_top(counted: DataFrame, depth: int, shared: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The tree's nodes of depths under ``shared``, from (bucket, gram, n)."""
    if not shared:
        return []

    def roots(table: pa.Table) -> pa.Table:
        key, n0, n1, weighted = model_of(table, depth, least=shared).roots
        return pa.table({"key": parent_key(key, shared).view(np.int64), "n0": n0, "n1": n1, "weighted": weighted})

    found = counted.groupBy("bucket").applyInArrow(roots, "key long, n0 double, n1 double, weighted double")
    got = found.groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("weighted")).toArrow().sort_by("key")  # 255 * 256 rows at most
    return top_of(got.column("key").to_numpy().view(np.uint64), *(got.column(c).to_numpy() for c in ("n0", "n1", "weighted")), shared - 1)


def chunk_costs(texts: DataFrame, train: DataFrame, depth: int) -> DataFrame:
    """(chunk, grams, logs): log10 of the chance of the last byte of every string in each chunk's texts."""
    shared = min(SHARED_BYTES, depth)
    grams = materialize(gram_counts(train, depth + 1), "lm-grams")
    buckets = min(65536, -(-grams.count() // BUCKET_GRAMS) or 1)
    counted = grams.select(bucket_of(F.col("gram"), shared, buckets).cast("int").alias("bucket"), "gram", "n")
    top = texts.sparkSession.sparkContext.broadcast(fit_top(counted, depth, shared))

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            rows: list[tuple] = []
            for chunk, parts in held.items():
                own = np.unique(np.concatenate(parts)).view(np.int64)
                at = bucket_of(own, shared, buckets)
                order = np.argsort(at, kind="stable")
                begins = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
                rows += [(int(at[part[0]]), chunk, own[part]) for part in np.split(order, begins[1:])]
            held.clear()
            bucket, chunk, grams_ = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(chunk, pa.int64()), pa.array(grams_, pa.list_(pa.int64()))], ["bucket", "chunk", "grams"])

        for batch in slices(batches, 64):
            for chunk, text in zip(batch.column("chunk").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held.setdefault(chunk, []).append(np.unique(grams_of(stream_of(words_of(text), depth), depth + 1)))
                size += len(held[chunk][-1])
            if size >= 4 * HELD:
                held = {c: [np.unique(np.concatenate(parts))] for c, parts in held.items()}
                size = sum(len(parts[0]) for parts in held.values())
                if size >= 2 * HELD:
                    yield flush()
                    size = 0
        yield flush()

    def priced(left: pa.Table, right: pa.Table) -> pa.Table:
        lists = right.column("grams").combine_chunks()
        own = lists.flatten().to_numpy().view(np.uint64)
        logs = model_of(left, depth, top=top.value).costs(own).astype(np.float32) if len(own) else np.zeros(0, np.float32)
        at = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())].astype(np.int32)
        return pa.table({"chunk": right.column("chunk"), "grams": pa.ListArray.from_arrays(pa.array(at), pa.array(own.view(np.int64))), "logs": pa.ListArray.from_arrays(pa.array(at), pa.array(logs))})

    asked = texts.mapInArrow(needed, "bucket int, chunk long, grams array<long>")
    return counted.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(priced, "chunk long, grams array<long>, logs array<float>")


def frequent_words(counts: DataFrame, most: int) -> tuple[dict[bytes, int], int]:
    """The words that occur at least so often that there are no more than ``most``; how often that is."""
    step = F.floor(8 * F.log2(F.col("n").cast("double"))).cast("int")
    bins = sorted(((r["step"], r["words"], r["low"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("low")).collect()), reverse=True)
    total, least = 0, 2**62
    for _, words, low in bins:
        if total + words > most:
            break
        total, least = total + words, low
    got = counts.filter(F.col("n") >= least).toArrow()
    return dict(zip(got.column("word").to_pylist(), got.column("n").to_pylist(), strict=True)), least


def score(docs: DataFrame, modulus: int = 10, remainder: int = 0, depth: int = DEPTH, max_frequent: int = MAX_FREQUENT) -> DataFrame:
    """Counts, base score, score and bits per byte of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    train = docs.filter(learnable("doc_id", modulus, remainder))
    ends = train.count()
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # rows that are equal meet in one chunk
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(-(-size // CHUNK_BYTES) or 1)).alias("chunk")
    texts = docs.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), chunk, "text").repartition("chunk")
    priced = chunk_costs(texts, train, depth)
    counts = materialize(word_counts(train), "lm-words")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, v = n + ends, v + (ends > 0)
    whole = n + SMOOTHING * (v + 1)
    frequent, least = frequent_words(counts, max_frequent)
    log_of = {w: math.log10((c + SMOOTHING) / whole) for w, c in frequent.items()}
    end_log = math.log10((ends + SMOOTHING) / whole)
    sent = spark.sparkContext.broadcast(log_of)  # bounded by max_frequent

    def run(texts: pa.Table, prices: pa.Table) -> pa.Table:
        known, out = sent.value, []
        own, at = np.unique(prices.column("grams").combine_chunks().flatten().to_numpy().view(np.uint64), return_index=True)
        tree = Slots(own, prices.column("logs").combine_chunks().flatten().to_numpy()[at])
        key = (texts.column("chunk")[0].as_py() << 40) if texts.num_rows else 0
        for batch in slices(texts.to_batches(), 128):
            rows: tuple[list, ...] = ([], [], [], [], [], [], [])
            streams, sizes = [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                logs = np.fromiter(map(known.get, words, repeat(np.nan)), np.float64, len(words))
                rare = np.isnan(logs)
                grams = grams_of(stream_of(words, depth), depth + 1)
                streams.append(grams)
                sizes.append(len(grams))
                for column, value in zip(rows, (key, len(words) + 1, int((~rare).sum()) + (ends > 0), float(logs[~rare].sum()) + end_log, 0.0, len(grams), [words[i] for i in np.flatnonzero(rare)]), strict=True):
                    column.append(value)
                key += 1
            if sizes:
                begins = np.r_[0, np.cumsum(sizes)[:-1]]
                costs, there = tree.get(np.concatenate(streams))
                assert there.all(), "a string without a cost"
                rows[4][:] = np.add.reduceat(costs.astype(np.float64), begins).tolist()
            out.append(pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *(pa.array(r, t) for r, t in zip(rows, kinds, strict=True))], names))
        return pa.Table.from_batches(out, pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), *zip(names[2:], kinds, strict=True)]))

    names = ["doc_id", "held_out", "key", "n_tokens", "n_known", "base_score", "score", "n_bytes", "rare"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.binary()))
    schema = "doc_id long, held_out boolean, key long, n_tokens long, n_known long, base_score double, score double, n_bytes long, rare array<binary>"
    scored = materialize(texts.groupBy("chunk").cogroup(priced.groupBy("chunk")).applyInArrow(run, schema), "lm-scored")
    # a word without a count is worth as much anywhere, and is only counted
    found = scored.select("key", F.explode("rare").alias("word")).join(counts.filter(F.col("n") < least), "word")
    gain = F.log10((F.col("n") + SMOOTHING) / F.lit(float(SMOOTHING)))
    found = found.groupBy("key").agg(F.count("*").alias("found"), F.sum(gain).alias("gain"))
    unknown_log = math.log10(SMOOTHING / whole)
    return scored.join(found, "key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.size("rare") * F.lit(unknown_log) + F.coalesce("gain", F.lit(0.0))).alias("base_score"),
        "score",
        (-F.col("score") / F.col("n_bytes") / math.log10(2)).alias("bits_per_byte"),
    )
