"""N-gram Jaccard join by universe partition and the pigeonhole principle.

Sets of shingles meet in bands of set size. Two sets of a band that reach the
similarity differ in at most H elements, H following from the band's largest
size. Elements are hashed into segments: a segments that must agree exactly,
and b segments that may differ by one element. If no exact segment agreed and
every other one differed by two, the sets would differ in a + 2b > H elements;
so a linked pair shares the signature of a segment, or of a segment with one
element deleted. One unit more than that is spent where exact segments occur,
so that an empty exact segment, which tells nothing, need not be indexed on its
own: only subsets of two empty segments are.

A band may have more exact segments than it indexes. If T of them are there,
T - (H - 2b) still agree, so any order that all sets share makes the first
H - 2b + 2 of two similar sets meet; H may be each set's own bound there. Segments are ordered by their rarest
element, rarest first: what many texts hold alike (licenses, lines of a host) is
passed over as long as a set has anything of its own. How frequent an element is
comes from counters of fixed number that are filled in the first pass; they
affect cost, never results.

How many segments of each kind a band gets is decided by cost: rows to index
against pairs that agree by chance, which grow with the square of the number of
sets in the band and fall with the elements in a segment. Bands whose sets may
differ in one element only use deletions of the whole set; in bands where only
equal sets are similar there is nothing to index.

Sets that are equal are one class from the start. In a signature's bucket the
classes are sorted so that near copies follow each other, and every one is tried
against the one before; what that links becomes one component. Then the class
that shares most buckets is tried, in each bucket, against those of other
components. Only classes of one bucket that are in different components even
then meet each other, so a bucket of near copies costs its size, not its square.
All pairs pass parity sketches first, which are made once a class and whose
distance never exceeds that of the sets; what is left is verified on the full
sets.

Shingles are hashed to 64 bits and classes to 128. Defined results: null and
empty texts, and texts without words, have 0 shingles and are linked with
nothing; rows with a null id are counted but have a null component unless a row
with an id has the same shingles; repeated rows are in one component; an empty
table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.llm.common import discard, materialize, slices, small_batches
from sheaf.llm.components import connected_components

#: Similarity as a fraction, words in a shingle.
SIMILARITY = (90, 100)
WORDS = 3
#: A band's sizes are within this factor. Wide bands are cheap: a set looks for partners in few of them, and
#: what it indexes follows from its own size.
BAND = 2.0
#: Cost model: chance that two sets of a band share an element of WORDS words, or one of their rarest;
#: elements in a segment where more are there than are indexed; cost of a chance pair in index rows.
SHARED = 0.2
RARE = 1e-3
UNIT = 2
PAIR_COST = 4.0
#: log2 of the counters of elements; counters that a task passes on and that all tasks get, the fullest ones, at most.
COUNTER_BITS = 22
PASSED, KNOWN = 1 << 16, 1 << 17
#: Bits of the filter that keeps texts out of the verification.
FILTER_BITS = 24
CACHE_WORDS = 400_000
#: Classes that a task remembers, so as not to index them again.
SEEN = 1_000_000

_U = np.uint64
_ODD = np.random.default_rng(9).integers(1, 1 << 62, 16, dtype=np.uint64) * _U(2) + _U(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        out = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = out
        return out


def shingles(text: str | None, words: WordHashes, n: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's n-word shingles; of all its words, if fewer."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    size = min(n, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        h = mixed(h ^ w[k : k + len(h)]) * _ODD[k]
    h = np.sort(mixed(h))
    first = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=first[1:])
    return h[first]


def short_of(own: np.ndarray, name: bytes) -> int:
    """A short class: 24 bits of the set's smallest element, which near copies mostly share, then 39 of the class."""
    return (int(own[0]) >> 40 << 39) | int.from_bytes(name[:5], "big") >> 1


def class_of(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def bands_of(size: int, similarity: tuple[int, int] = SIMILARITY) -> list[int]:
    """The bands in which a set looks for partners: its own, and those of larger partners."""
    own = int(np.log(size) / np.log(BAND) + 1e-9)
    most = size * similarity[1] // similarity[0]
    return list(range(own, int(np.log(most) / np.log(BAND) + 1e-9) + 1))


def difference(band: int, similarity: tuple[int, int] = SIMILARITY, size: int | None = None) -> int:
    """The most elements in which similar sets, the larger of them in this band, can differ; of a set of one size, if given."""
    largest = int(np.floor(BAND ** (band + 1) * (1 + 1e-9)))
    both = 2 * largest if size is None else size + min(largest, size * similarity[1] // similarity[0])
    # |R - S| + |S - R| <= (1 - s) / (1 + s) * (|R| + |S|)
    return (similarity[1] - similarity[0]) * both // (similarity[1] + similarity[0])


def allocation(h: int, size: float, sets: int, shared: float = SHARED, rare: float = RARE) -> tuple[int, int, int]:
    """(exact segments to index, exact segments there are, deletion segments) for a band that may differ in h elements, by cost."""
    if h == 0:
        return 0, 0, 0
    choices = []
    for b in sorted({0, *(int(x) for x in np.linspace(1, (h + 2) // 2, 9))}):
        a = max(0, h + 2 - 2 * b)
        if not a and 2 * (b - 1) >= h + 1:
            continue
        for total in {a, max(a, round(size / UNIT) - 2 * b) if a else 0}:
            unit = size / (total + 2 * b)
            rows = a + b * (1 + 2 * unit)
            chance = a * (rare if total > a else shared) ** unit + b * shared ** max(1.0, 2 * unit - 1)
            choices.append((rows + PAIR_COST * sets * chance, b, a, total))
    cost, b, a, total = min(choices)
    return a, total, b


def signatures(own: np.ndarray, band: int, a: int, b: int, total: int | None = None, levels: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the first a exact segments of a set, of deletions in the others, and of pairs of empty ones.

    total: exact segments there are, a if not given; levels: how frequent each
    element is, which orders them.
    """
    total = a if total is None else total
    if not total + b:
        return np.zeros(0, np.uint64)
    salt = _U(band * 0x9E3779B97F4A7C15 & (2**64 - 1))
    unit = (mixed(own ^ salt) >> _U(33)) % _U(total + 2 * b)
    segment = np.where(unit < total, unit, total + (unit - _U(total)) // _U(2)).astype(np.int64) if total else (unit // _U(2)).astype(np.int64)
    value = mixed(own * _ODD[10])
    added, count = np.zeros(total + b, np.uint64), np.bincount(segment, minlength=total + b).astype(np.uint64)
    order = np.argsort(segment, kind="stable")
    first = np.ones(len(own), bool)
    np.not_equal(segment[order[1:]], segment[order[:-1]], out=first[1:])
    begins = np.flatnonzero(first)
    there = segment[order[begins]]
    added[there] = np.add.reduceat(value[order], begins)

    def signed(s: np.ndarray, t: np.ndarray, n: np.ndarray) -> np.ndarray:
        return mixed(t ^ mixed(s.astype(np.uint64) * _ODD[11] ^ n * _ODD[12] ^ salt))

    full = signed(np.arange(total + b), added, count)
    kept = np.arange(total)
    if total > a:
        level = np.full(total + b, 255, np.uint8)
        level[there] = np.minimum.reduceat(levels[order], begins) if levels is not None else 0
        kept = np.lexsort((full[:total], level[:total]))[:a]
    out = [full[kept[count[kept] > 0]], full[total:]]
    loose = segment >= total
    if b and loose.any():
        s = segment[loose]
        out.append(signed(s, added[s] - value[loose], count[s] - _U(1)))
    empty = np.sort(kept[count[kept] == 0])
    if len(empty) > 1:
        i, j = np.triu_indices(len(empty), 1)
        out.append(mixed((empty[i] * (total + 1) + empty[j] + 1).astype(np.uint64) * _ODD[13] ^ salt))
    return np.concatenate(out)


def counter_of(own: np.ndarray) -> np.ndarray:
    return (own >> _U(64 - COUNTER_BITS)).astype(np.int64)


def sized(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, class, short class and sketch of every row; the last three are null without shingles.

    Beside them, a row of each task has the counters (slots, counts) that are
    fuller there than others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counters, total = WordHashes(), np.zeros(1 << COUNTER_BITS, np.uint32), 0
        for batch in slices(batches):
            sets = [shingles(t, words, n) for t in batch.column("text").to_pylist()]
            for own in sets:
                counters[counter_of(own)] += 1
                total += len(own)
            none = pa.nulls(len(sets), pa.list_(pa.int32()))
            classes = [class_of(s) if len(s) else None for s in sets]
            shorts = [short_of(s, c) if c else None for s, c in zip(sets, classes, strict=True)]
            columns = [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(classes, pa.binary()), pa.array(shorts, pa.int64()), pa.array([parity(s) if len(s) else None for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, none, none], names)
        full = np.flatnonzero(counters > 4 + 4 * total / len(counters))
        if len(full) > PASSED:
            full = full[np.argpartition(counters[full], len(full) - PASSED)[len(full) - PASSED :]]
        lists = [pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in (full, np.minimum(counters[full], 2**31 - 1))]
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int64())), *lists], names)

    names = ["doc_id", "n_shingles", "class", "short", "sketch", "slots", "counts"]
    return docs.mapInArrow(run, "doc_id long, n_shingles long, class binary, short long, sketch array<long>, slots array<int>, counts array<int>")


def levels_of(rows: DataFrame) -> np.ndarray:
    """How full each counter is, as a logarithm; 0 for those that no task passed on."""
    each = rows.filter("slots IS NOT NULL").select(F.explode(F.arrays_zip("slots", "counts")).alias("c")).groupBy(F.col("c.slots").alias("slot")).agg(F.sum("c.counts").alias("n"))
    top = each.orderBy(F.desc("n"), "slot").limit(KNOWN).toArrow()
    out = np.zeros(1 << COUNTER_BITS, np.uint8)
    out[top.column("slot").to_numpy()] = 1 + np.log2(top.column("n").to_numpy().astype(float)).astype(np.uint8)
    return out


def indexed(docs: DataFrame, plan: dict[int, tuple[int, int, int]], levels: np.ndarray, similarity: tuple[int, int] = SIMILARITY, n: int = WORDS) -> DataFrame:
    """(signature, short class) rows, once a task for each class."""
    sent = docs.sparkSession.sparkContext.broadcast(levels)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, known = WordHashes(), set(), sent.value
        for batch in slices(batches):
            found, owner, times = [], [], []
            for text in batch.column("text").to_pylist():
                own = shingles(text, words, n)
                if not len(own):
                    continue
                name = class_of(own)
                if name in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                short = short_of(own, name)
                level = known[counter_of(own)]
                for band in bands_of(len(own), similarity):
                    most = difference(band, similarity, len(own))
                    if not most:
                        continue
                    _, total, b = plan.get(band, (0, 0, 0))
                    got = signatures(own, band, max(0, most + 2 - 2 * b) if total else 0, b, total, level)
                    found.append(got)
                    owner.append(short)
                    times.append(len(got))
            sig = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(np.repeat(np.array(owner, np.int64), times))], ["sig", "short"])

    return docs.mapInArrow(run, "sig long, short long")


def neighbours_in_buckets(rows: DataFrame) -> DataFrame:
    """(sig, before, short): the classes of each bucket that has several beside the one before; null for the first.

    Rows come sorted, so a bucket of any size passes in batches. Short classes
    begin with the set's smallest element, so near copies mostly follow each
    other, and in the same order in all the buckets they share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # signature, class and whether it had one before it
        for batch in batches:
            sig, short = batch.column("sig").to_numpy(), batch.column("short").to_numpy()
            if last is not None:
                sig, short = np.concatenate([[last[0]], sig]), np.concatenate([[last[1]], short])
            new = np.ones(len(sig), bool)
            new[1:] = (sig[1:] != sig[:-1]) | (short[1:] != short[:-1])
            sig, short = sig[new], short[new]
            if not len(sig):
                continue
            joined = np.zeros(len(sig), bool)
            joined[1:] = sig[1:] == sig[:-1]
            joined[0] = last is not None and last[2]
            at = np.flatnonzero(joined[1:]) + 1
            second = at[~joined[at - 1]]
            before = pa.concat_arrays([pa.array(short[at - 1]), pa.nulls(len(second), pa.int64())])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([sig[at], sig[second]])), before, pa.array(np.concatenate([short[at], short[second - 1]]))], ["sig", "before", "short"])
            last = sig[-1], short[-1], joined[-1]

    return rows.repartition("sig").sortWithinPartitions("sig", "short").mapInArrow(run, "sig long, before long, short long")


def parity(own: np.ndarray) -> np.ndarray:
    """The parity sketch of a set: about as many bits as it has elements, a power of two.

    A bit is the parity of the elements that fall on it, so two sets differ in
    at least as many elements as their sketches differ in bits; a sketch's
    halves differ where that of half the bits has a one.
    """
    k = max(7, int(len(own) - 1).bit_length())
    bits = (np.bincount((mixed(own * _ODD[14]) & _U((1 << k) - 1)).astype(np.int64), minlength=1 << k) & 1).astype(np.uint8)
    return np.packbits(bits).view(">i8").astype(np.int64)


def place_of(column: str | Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))


def bitmap_of(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size in which the places of all ids are set."""
    places = ids.select(place_of(ids.columns[0]).alias("p")).groupBy((F.col("p") / 64).cast("long").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 AS int)))").alias("bits"))
    got, out = places.toArrow(), np.zeros((1 << FILTER_BITS) // 64, np.int64)
    out[got.column("w").to_numpy()] = got.column("bits").to_numpy()
    return out


def marked(docs: DataFrame, bitmap: np.ndarray, column: str) -> DataFrame:
    """docs with a column that tells whether the id's place is set in the bitmap; a null id's isn't."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)
    names = [*docs.columns, column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(len(names) - 1).fill_null(0).to_numpy()
            hit = ((sent.value[p // 64] >> (p % 64)) & 1 == 1) & batch.column(len(names) - 1).is_valid().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(hit, pa.bool_())], names)

    doc_id = F.col("doc_id").cast("long")
    return docs.withColumn(column, F.when(doc_id.isNotNull(), place_of(doc_id))).mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.BooleanType())]))


def sets_of(docs: DataFrame, wanted: DataFrame, n: int = WORDS) -> DataFrame:
    """(class, elements) of the classes whose representative rows are wanted (rep).

    A bitmap of fixed size keeps most other texts from being cut; what passes by
    chance finds no partner in the join that follows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bitmap_of(wanted.select("rep")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in slices(batches):
            p = batch.column("p").fill_null(0).to_numpy()
            batch = batch.filter(pa.array((sent.value[p // 64] >> (p % 64)) & 1 == 1))
            found = [own for t in batch.column("text").to_pylist() if len(own := shingles(t, words, n))]
            yield pa.RecordBatch.from_arrays([pa.array([class_of(s) for s in found], pa.binary()), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], ["class", "elements"])

    at = docs.select(place_of("doc_id").alias("p"), "text")
    return at.mapInArrow(run, "class binary, elements array<long>").dropDuplicates(["class"])


def may_reach(x: str, y: str, similarity: tuple[int, int]) -> Column:
    """Whether sizes (x, y with _n) and sketches (with _sketch) leave two classes the similarity."""
    n_x, n_y = F.col(f"{x}_n"), F.col(f"{y}_n")

    def as_wide_as(own: str, other: str) -> Column:
        """A sketch, folded where the other has half as many bits."""
        one, width = F.col(f"{own}_sketch"), F.size(f"{other}_sketch")
        return F.when(F.size(one) > width, F.zip_with(F.slice(one, F.lit(1), width), F.slice(one, width + 1, width), lambda p, q: p.bitwiseXOR(q))).otherwise(one)

    apart = F.aggregate(F.zip_with(as_wide_as(x, y), as_wide_as(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, bits: total + bits)
    near = similarity[0] * F.greatest(n_x, n_y) <= similarity[1] * F.least(n_x, n_y)
    # sets that are near in size, but whose widths are more than a factor of two apart, are not compared by sketch
    wide = F.greatest(F.size(f"{x}_sketch"), F.size(f"{y}_sketch")) > 2 * F.least(F.size(f"{x}_sketch"), F.size(f"{y}_sketch"))
    return near & (wide | ((similarity[0] + similarity[1]) * (n_x + n_y - apart) >= 2 * similarity[0] * (n_x + n_y)))


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, similarity: tuple[int, int], n: int = WORDS) -> DataFrame:
    """The (a, b) class pairs whose sets reach the similarity."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(classes.select("class", "rep"), "class")
    sets = sets_of(docs, wanted, n)
    left = sets.select(F.col("class").alias("a"), F.col("elements").alias("of_a"))
    right = sets.select(F.col("class").alias("b"), F.col("elements").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    enough = similarity[1] * both >= similarity[0] * (F.size("of_a") + F.size("of_b") - both)
    return pairs.join(left, "a").join(right, "b").filter(enough).select("a", "b")


def join(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; words: how many are in a shingle."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = materialize(sized(docs, words), "jaccard-rows")
    rows = made.filter("slots IS NULL").select("doc_id", "n_shingles", "class")
    classes = made.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.max("short").alias("short"), F.first("sketch").alias("sketch"))
    classes = materialize(classes, "jaccard-classes")
    own = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(BAND))) + 1e-9).cast("int")
    counts = {r["band"]: (r["sets"], r["size"]) for r in classes.groupBy(own.alias("band")).agg(F.count("*").alias("sets"), F.avg("n").alias("size")).collect()}
    # a set is indexed in its own band and those of the largest partners it may have
    reach = 2 + int(np.log(similarity[1] / similarity[0]) / np.log(BAND))
    plan = {}
    for band in sorted({b + k for b in counts for k in range(reach)}):
        sets, size = counts.get(band, (0, BAND**band))
        plan[band] = allocation(difference(band, similarity), size, sets + sum(counts.get(band - k, (0, 0))[0] for k in range(1, reach)), SHARED ** (words / WORDS), RARE ** (words / WORDS))

    buckets = materialize(neighbours_in_buckets(indexed(docs, plan, levels_of(made), similarity, words)), "jaccard-buckets")
    named = classes.filter("rep IS NOT NULL")

    def pairs_of(links: DataFrame) -> DataFrame:
        """Classes for pairs (s, t) of short ones whose sizes and sketches allow the similarity."""
        one, two = (named.select(F.col("short").alias(s), F.col("class").alias(c), F.col("n").alias(f"{c}_n"), F.col("sketch").alias(f"{c}_sketch")) for s, c in (("s", "a"), ("t", "b")))
        return links.join(one, "s").join(two, "t").filter(may_reach("a", "b", similarity)).select("a", "b")

    tried = [materialize(pairs_of(buckets.filter("before IS NOT NULL").select(F.col("before").alias("s"), F.col("short").alias("t")).distinct()), "jaccard-pairs")]
    found = connected_components(verified(tried[0], docs, classes, similarity, words))

    def open_buckets(rows: DataFrame) -> DataFrame:
        """The rows (sig, short) of buckets whose classes are not in one component so far, with the component."""
        label = named.join(found, named["class"] == found["node"], "left").select("short", F.coalesce("component", "class").alias("component"))
        marked = rows.select("sig", "short").join(label, "short")
        mixed_ = marked.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("sig")
        return materialize(marked.join(mixed_, "sig"), "jaccard-open")

    def more(links: DataFrame, *tables: DataFrame) -> DataFrame:
        """found after trying other pairs (s, t) of classes, which join those tried; tables are deleted."""
        fresh = pairs_of(links.select(F.least("s", "t").alias("s"), F.greatest("s", "t").alias("t")).distinct())
        for before in tried:
            fresh = fresh.join(before, ["a", "b"], "left_anti")
        fresh = materialize(fresh, "jaccard-pairs")
        discard(*tables)
        tried.append(fresh)
        if fresh.isEmpty():
            return found
        # what is found already stands for all links so far: each class beside the least of its component
        known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        out = connected_components(known.unionByName(verified(fresh, docs, classes, similarity, words)))
        discard(found)
        return out

    # the class of a bucket that shares most with others is the nearest to the middle of a group: it is tried against all of other components
    open_ = open_buckets(buckets)
    degree = open_.groupBy("short").agg(F.count("*").alias("degree"))
    hub = open_.join(degree, "short").groupBy("sig").agg(F.max_by(F.struct("short", "component"), F.struct("degree", "short")).alias("hub"))
    found = more(open_.join(hub, "sig").filter("component <> hub.component").select(F.col("hub.short").alias("s"), F.col("short").alias("t")), buckets)

    # and all pairs that are in different components even so
    rest = open_buckets(open_)
    discard(open_)
    held = rest.join(named.select("short", "n", "sketch"), "short")
    x, y = (held.select("sig", *(F.col(c).alias(f"{side}_{c}") for c in ("short", "component", "n", "sketch"))) for side in ("x", "y"))
    met = x.join(y, "sig").filter((F.col("x_component") < F.col("y_component")) & may_reach("x", "y", similarity))
    found = more(met.select(F.col("x_short").alias("s"), F.col("y_short").alias("t")), rest)
    discard(*tried)

    grouped = classes.join(found, classes["class"] == found["node"], "left").select("class", F.coalesce("component", "class").alias("component"), "rep")
    least = grouped.groupBy("component").agg(F.min("rep").alias("component_id"))
    named_ = grouped.join(least, "component").select("class", "component_id")
    out = rows.join(named_, "class", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    out.sheaf_tables = (made, classes, found)
    return out


def one_of_each(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, words: int = WORDS) -> DataFrame:
    """One row of each component, that of the smallest id, with all its columns.

    Rows without an id stay, as do null and empty texts; of rows that repeat id
    and text one stays. An id with several texts keeps them all, since no row of
    it stands for the others. An empty table gives no rows.
    """
    doc_id = F.col("doc_id").cast("long")
    joined = join(docs, similarity, words)
    ids = joined.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_other"))
    ids = materialize(ids.agg(F.count("*").alias("n"), F.min("component_id").alias("low"), F.max("component_id").alias("high")), "jaccard-ids")
    discard(*joined.sheaf_tables)
    gone, twice = ids.filter("low = high AND low <> _other").select("_other"), ids.filter("n > 1").select("_other")
    # only rows of such ids, and a few that share their places, are moved to be compared with them
    mark = "_met"
    while mark in docs.columns:
        mark += "_"
    held = marked(docs, bitmap_of(gone.unionByName(twice)), mark)
    kept = held.filter(mark).drop(mark).join(gone, doc_id == F.col("_other"), "left_anti")
    once = kept.join(twice, doc_id == F.col("_other"), "left_anti")
    again = kept.join(twice, doc_id == F.col("_other"), "left_semi").dropDuplicates(["doc_id", "text"])
    return held.filter(~F.col(mark)).drop(mark).unionByName(once).unionByName(again)
