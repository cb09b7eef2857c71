"""Repeated passages: bytes covered by a string of ``WINDOW`` bytes that also starts earlier go.

Earlier is a smaller doc_id, or an earlier start in the same document. Strings
are bytes of the input, never across documents, and overlaps count.

1. Every window's least hash of ``GRAM`` bytes is its anchor, a function of its
   bytes alone, so equal windows have equal anchors. Consecutive windows with
   one anchor make a stretch, 168 bytes at most. Anchors that come once have no
   repeat; they are counted in Spark, and a bitmap keeps out most of them.
2. Equal stretches form a class: all its members but the first go whole.
3. Different stretches with one anchor meet in a bucket. Its stretches are split
   into shards, each shard's Burrows-Wheeler transform is made, and the
   transforms are merged by refining their interleave (``bwt.py``). Repeated
   intervals of WINDOW bytes keep their earliest suffix.
4. An anchor with more than ``HOT`` classes (5 MB; the edges of a passage that
   very many documents share) would fill a task: its stretches are cut into their
   windows, and equal windows meet by their 128-bit hash, counted in two steps.

Results are exact up to collisions of 128-bit hashes. Memory: parts of ``PART``
bytes, buckets of about ``BUCKET`` bytes, a bitmap of fixed size; the removed
stretches of one document come together.

Defined cases: a null text is empty; empty and short texts keep all bytes; a
null id comes before all others; rows that repeat id and text are one document,
rows that share an id with other texts are documents in the order of a hash of
the text; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm import bwt
from sheaf.llm.bitmaps import bitmap, is_set
from sheaf.llm.common import discard, materialize, slices, small_batches

WINDOW = 100
GRAM = 48
GRAMS = WINDOW - GRAM + 1
#: Window starts handled at a time; with the longest rest, places fit PLACE_BITS.
PART = 1 << 19
PLACE_BITS = np.uint64(20)
SHARD = 1 << 17
BUCKET = 1 << 20
HOT = 1 << 15

_BASE = 0x100000001B3


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from every place: polynomials of powers of two bytes, put together."""
    h, out, done, size = data.astype(np.uint64) + np.uint64(1), None, 0, 1
    while size <= GRAM:
        if GRAM & size:  # the next ``size`` bytes after the ``done`` ones
            n = max(len(data) - GRAM + 1, 0)
            own = h[done : done + n]
            out = own if out is None else out * np.uint64(pow(_BASE, size, 1 << 64)) + own
            done += size
        if 2 * size <= GRAM:
            h = h[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + h[size:]
        size *= 2
    out = out ^ out >> np.uint64(32)
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    return out


def stretches(data: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, anchor hash) of the windows inside the spans (start, end) of data."""
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return none, none, none
    h = _grams(data)
    low = np.uint64((1 << int(PLACE_BITS)) - 1)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    step = 1
    while 2 * step <= GRAMS:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if rest := GRAMS - step:
        least = np.minimum(least[:-rest], least[rest:])
    inside = np.zeros(len(least), bool)
    for at, end in spans:
        if end - at >= WINDOW:
            inside[at : end - WINDOW + 1] = True
    first = np.flatnonzero(inside)
    if not len(first):
        return none, none, none
    own = least[first]
    new = np.ones(len(first), bool)
    new[1:] = (own[1:] != own[:-1]) | (first[1:] != first[:-1] + 1)
    heads = np.flatnonzero(new)
    return first[heads], np.diff(heads, append=len(first)), h[(own[heads] & low).astype(np.int64)].view(np.int64)


def _parts(texts: list[str | None]) -> Iterator[tuple[bytes, list[tuple[int, int]], list[tuple[int, int]]]]:
    """(data, spans, [(row, what to add to a place to get the text's)]): texts side by side, long ones in overlapping parts."""
    held, size, spans, owners = [], 0, [], []
    for row, text in enumerate(texts):
        data = (text or "").encode()
        for at in range(0, max(len(data) - WINDOW + 1, 0), PART):
            part = data[at : at + PART + WINDOW - 1]
            if size and size + len(part) > PART + WINDOW:
                yield b"".join(held), spans, owners
                held, size, spans, owners = [], 0, [], []
            held.append(part)
            spans.append((size, size + len(part)))
            owners.append((row, at - size))
            size += len(part)
    if size:
        yield b"".join(held), spans, owners


def anchors(docs: DataFrame) -> DataFrame:
    """Anchor hashes (hi) that come more than once, lo is 0, as a table."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for data, spans, _ in _parts(batch.column(0).to_pylist()):
                hashes, n = np.unique(stretches(np.frombuffer(data, np.uint8), spans)[2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n.astype(np.int64))], names=["hi", "n"])

    counts = docs.select("text").mapInArrow(found, "hi long, n long").groupBy("hi").agg(F.sum("n").alias("n"))
    return materialize(counts.filter("n > 1").select("hi", F.lit(0).cast("long").alias("lo")), "repeat-anchors")


def candidates(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """The stretches whose anchor may repeat: anchor, class (a 128-bit hash), place, number of windows, bytes."""
    may = docs.sparkSession.sparkContext.broadcast(bits)
    names = ["anchor", "class", "d", "v", "start", "windows", "bytes"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            d, v = (batch.column(k).to_numpy() for k in (0, 1))
            for data, spans, owners in _parts(batch.column(2).to_pylist()):
                start, windows, anchor = stretches(np.frombuffer(data, np.uint8), spans)
                kept = np.flatnonzero(is_set(may.value, anchor, np.zeros_like(anchor)))
                start, windows, anchor = start[kept], windows[kept], anchor[kept]
                own = np.searchsorted([s for s, _ in spans], start, side="right") - 1
                row, add = np.array(owners, np.int64).reshape(-1, 2)[own].T
                parts = [data[s : s + w + WINDOW - 1] for s, w in zip(start.tolist(), windows.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array([xxhash.xxh3_128_digest(p) for p in parts], pa.binary()), pa.array(d[row]), pa.array(v[row]), pa.array(start + add), pa.array(windows.astype(np.int32)), pa.array(parts, pa.binary())],
                    names=names,
                )

    return docs.select("d", "v", "text").mapInArrow(found, "anchor long, class binary, d long, v long, start long, windows int, bytes binary")


def _place() -> Column:
    return F.struct("d", "v", "start")


def later(members: DataFrame, classes: DataFrame, keys: list[str]) -> DataFrame:
    """(d, v, start, windows) of the members that are not the first of their class."""
    repeated = classes.filter("n > 1").select(*keys, "first")
    return members.join(repeated, keys).filter(_place() != F.col("first")).select("d", "v", "start", "windows")


def _interleaved(table: pa.Table) -> pa.Table:
    """The windows of different stretches of one bucket that also start earlier, as runs (d, v, start, windows)."""
    table = table.sort_by("anchor")
    strings = table.column("bytes").to_pylist()
    d, v, start = (table.column(k).to_numpy() for k in ("d", "v", "start"))
    blank = pa.table({k: pa.array([], pa.int64()) for k in ("d", "v", "start", "windows")})
    if len(strings) < 2:
        return blank
    shards, firsts, held, total = [], [], [], 0
    for i, own in enumerate([*strings, None]):
        if own is None or total >= SHARD:
            shards.append(bwt.Shard(held, WINDOW))
            firsts.append(i - len(held))
            held, total = [], 0
        if own is not None:
            held.append(own)
            total += len(own)
    rows, group, _ = bwt.merge(shards, WINDOW)
    # the string and the offset of each suffix that shares WINDOW bytes
    lengths = np.array([len(s) + 1 for s in strings])
    begins = np.cumsum(lengths) - lengths
    places = np.concatenate([s.places + begins[i] for s, i in zip(shards, firsts, strict=True)])
    position = places[rows]
    string = np.searchsorted(begins, position, side="right") - 1
    offset = position - begins[string]
    order = np.lexsort((start[string] + offset, v[string], d[string], group))
    group, string, offset = group[order], string[order], offset[order]
    gone = np.zeros(len(group), bool)
    gone[1:] = group[1:] == group[:-1]
    string, offset = string[gone], offset[gone]
    if not len(string):
        return blank
    order = np.lexsort((offset, string))
    string, offset = string[order], offset[order]
    new = np.ones(len(string), bool)
    new[1:] = (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)
    heads = np.flatnonzero(new)
    windows = np.diff(heads, append=len(string))
    string, offset = string[heads], offset[heads]
    return pa.table({"d": d[string], "v": v[string], "start": start[string] + offset, "windows": windows.astype(np.int64)})


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches as their windows: class, place."""
    for batch in slices(batches, 1024):
        n = batch.column(4).to_numpy()
        parts = batch.column(3).to_pylist()
        digests = [xxhash.xxh3_128_digest(memoryview(p)[k : k + WINDOW]) for p, w in zip(parts, n.tolist(), strict=True) for k in range(w)]
        row = np.repeat(np.arange(len(n)), n)
        d, v, start = (batch.column(k).to_numpy()[row] for k in range(3))
        offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(d), pa.array(v), pa.array(start + offset), pa.array(np.ones(len(row), np.int32))], names=["class", "d", "v", "start", "windows"])


def repeated(docs: DataFrame) -> DataFrame:
    """(d, v, start, windows): runs of windows that also start earlier, as a table."""
    once = anchors(docs)
    members = materialize(candidates(docs, bitmap(once)), "repeat-stretches", "zstd")
    discard(once)
    keys = ["anchor", "class"]
    classes = materialize(members.groupBy(*keys).agg(F.min(_place()).alias("first"), F.count("*").alias("n")), "repeat-classes")
    shared = classes.groupBy("anchor").agg(F.count("*").alias("classes")).filter("classes > 1")
    meeting = materialize(classes.join(shared, "anchor").select("anchor", "first.*", "classes"), "repeat-meeting")
    several = materialize(first_of_classes(members, meeting), "repeat-first", "zstd")
    buckets = meeting.count() * (WINDOW + GRAMS) // BUCKET + 1
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket")
    runs = several.filter(F.col("classes") <= HOT).select(bucket, "anchor", "d", "v", "start", "bytes").groupBy("bucket").applyInArrow(_interleaved, "d long, v long, start long, windows long")
    single = several.filter(F.col("classes") > HOT).select("d", "v", "start", "bytes", "windows").mapInArrow(_single_windows, "class binary, d long, v long, start long, windows int")
    alike = later(single, single.groupBy("class").agg(F.min(_place()).alias("first"), F.count("*").alias("n")), ["class"])
    whole = later(members, classes, keys).unionByName(alike).withColumn("windows", F.col("windows").cast("long"))
    out = materialize(whole.unionByName(runs), "repeats")
    discard(members, classes, meeting, several)
    return out


def first_of_classes(members: DataFrame, meeting: DataFrame) -> DataFrame:
    """The members in the table ``meeting`` (first of a class, of an anchor with several) with their bytes; a bitmap keeps the others' bytes in place."""
    at = F.xxhash64("d", "v", "start").alias("hi")
    bits = members.sparkSession.sparkContext.broadcast(bitmap(meeting.select(at, F.col("anchor").alias("lo"))))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(is_set(bits.value, batch.column(0).to_numpy(), batch.column(1).to_numpy())))

    own = members.select(at, "anchor", "d", "v", "start", "windows", "bytes").mapInArrow(kept, "hi long, anchor long, d long, v long, start long, windows int, bytes binary")
    key = ["anchor", "d", "v", "start"]  # rows that repeat id and text are one document
    return own.drop("hi").join(meeting, key).dropDuplicates(key)


def _digest(parts: list[bytes]) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(p)
    return h.hexdigest()


def spans_of(row: np.ndarray, start: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end): maximal byte spans that each row's runs of windows cover, in order."""
    far = int((start + windows).max(initial=0)) + 2 * WINDOW  # rows side by side, too far apart to touch
    at = row * far + start
    order = np.argsort(at, kind="stable")
    at, end = at[order], (at + windows + WINDOW - 1)[order]
    reach = np.maximum.accumulate(end) if len(end) else end
    new = np.ones(len(at), bool)
    new[1:] = at[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    last = np.append(heads[1:], len(at))[: len(heads)] - 1
    own = row[order][heads]
    return own, at[heads] - own * far, reach[last] - own * far


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text with a place in the order of documents: d, v."""
    id_ = F.col("doc_id").cast("long")
    return docs.select(id_.alias("doc_id"), F.coalesce(id_, F.lit(-(1 << 63))).alias("d"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("v"), "text")


def with_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text and the byte spans that repeats cover (null: none) of every document.

    Texts without repeats stay in place (text null) and give n_bytes and kept_sha256 at once.
    """
    own = _keyed(docs)
    small_batches(docs.sparkSession)
    runs = repeated(own)
    touched = docs.sparkSession.sparkContext.broadcast(bitmap(runs.select(F.col("d").alias("hi"), F.col("v").alias("lo")).distinct()))

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hit = is_set(touched.value, batch.column(1).to_numpy(), batch.column(2).to_numpy())
            data = [(t or "").encode() for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(x) for x in data], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in data]), pa.array([x if y else None for x, y in zip(data, hit.tolist(), strict=True)], pa.binary())],
                names=["doc_id", "d", "v", "n_bytes", "kept_sha256", "data"],
            )

    sizes = own.mapInArrow(sized, "doc_id long, d long, v long, n_bytes long, kept_sha256 string, data binary")
    gathered = runs.groupBy("d", "v").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    return sizes.join(gathered, ["d", "v"], "left").select("doc_id", "n_bytes", "kept_sha256", "data", "runs")


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            runs, data, shas = batch.column(4), batch.column(3), batch.column(2).to_pylist()
            flat = runs.flatten()
            counts = runs.value_lengths().fill_null(0).to_numpy()
            row, start, end = spans_of(np.repeat(np.arange(batch.num_rows), counts), flat.field("start").to_numpy(), flat.field("windows").to_numpy())
            edges = np.flatnonzero(np.diff(row, prepend=-1, append=-1))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                own = data[int(row[a])].as_py()
                cuts = [0, *np.stack([start[a:b], end[a:b]], 1).ravel().tolist(), len(own)]
                shas[row[a]] = _digest([own[x:y] for x, y in zip(cuts[::2], cuts[1::2], strict=True)])
            n_spans = np.bincount(row, minlength=batch.num_rows)
            removed = np.bincount(row, end - start, batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed), pa.array(n_spans.astype(np.int64)), pa.array(shas, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return with_spans(docs).mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
