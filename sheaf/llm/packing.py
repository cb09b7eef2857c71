"""Best-fit packing of tokenized documents into fixed-length sequences.

Method, best-two-fit over a histogram of lengths: a bin is filled greedily with
the longest document that still fits; then its smallest document gives way to
two unpacked ones if these leave less of the gap unused. A bin built so is
repeated while its lengths last, so the plan is a list of at most one bin
pattern per exhausted length: its size depends on the capacity and never on the
number of documents. Documents then find their place by their rank among those
of equal length.

Defined results: a null or empty text is its end id alone; documents over the
capacity are cut into full pieces and a rest; rows that repeat are packed as
often as they occur; an empty table gives no rows. Columns of the input other
than the id and the text are neither read nor returned.
"""

from __future__ import annotations

import json
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheaf.llm.common import materialize, slices, small_batches, texts_of

CAPACITY = 4096
END_ID = 1
#: Distinct words whose ids a task keeps at most; a full cache is emptied.
CACHE_WORDS = 500_000

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


#: How the tokenizers that the short way is made for cut text, and
#: the letters that stand for bytes in their vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}


def byte_letters() -> list[str]:
    others = iter(range(256, 512))
    return [chr(b) if b in PRINTABLE else chr(next(others)) for b in range(256)]


def packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out.tobytes()


#: Of a worker that runs task after task.
_WORDS: dict[str, WordIds] = {}


def words_of(path: str) -> WordIds:
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


class WordIds(dict):
    """Ids of white-space separated chunks as little-endian bytes.

    A tokenizer of the kind known here drops white space and never joins across
    it, so a text's ids are the ids of its chunks in turn. A chunk of Latin-1
    letters is cut and merged piece by piece, and pieces are remembered too, as
    most new chunks are known pieces with other punctuation or case; any other
    chunk goes through the whole tokenizer. Under a tokenizer of another kind
    whole texts do.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        whole = Tokenizer.from_file(path)
        self.encode, self.merge = whole.encode, whole.model.tokenize
        spec = json.loads(whole.to_str())
        kinds = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.short = kinds == ["NFC", "Replace", "Lowercase"] and [c.get("type") for c in cuts] == ["Split", "ByteLevel"] and cuts[0]["pattern"] == {"Regex": SPLIT} and spec["model"]["type"] == "BPE"
        self.special = [x["content"] for x in spec["added_tokens"]]
        self.first = "".join({x[0] for x in self.special})
        self.spaced = not self.special or not any(c.isspace() for x in self.special for c in x)
        self.cut = regex.compile(SPLIT).findall
        self.letters = byte_letters()
        self.pieces: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        if (out := self.pieces.get(piece)) is None:
            if len(self.pieces) >= CACHE_WORDS:
                self.pieces.clear()
            written = piece if piece.isascii() and piece.isprintable() else "".join(self.letters[b] for b in piece.encode())
            out = packed([t.id for t in self.merge(written)])
            if len(piece) <= 64:
                self.pieces[piece] = out
        return out

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) > 64 or not (word.isascii() or max(word) <= "\xff") or self.marked(word):
            out = packed(self.encode(word, add_special_tokens=False).ids if word else [])
        elif word.isalpha():
            out = self.piece(word.lower())
        elif word[-1:] in ",.;:!?" and word[:-1].isalpha():
            out = self.piece(word[:-1].lower()) + self.piece(word[-1])
        else:
            out = b"".join(map(self.piece, self.cut(word.lower())))
        if len(word) <= 64:
            self[word] = out
        return out

    def marked(self, word: str) -> bool:
        """Whether a special token may be in the word."""
        return self.first in word and any(x in word for x in self.special) if len(self.first) == 1 else any(x in word for x in self.special)

    def of(self, text: str) -> bytes:
        if not self.short or not self.spaced:
            return packed(self.encode(text, add_special_tokens=False).ids)
        words = text.replace("\n", " ").split(" ")
        return b"".join(map(self.__getitem__, words))


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row for each piece of each document: doc_id, piece, start, length, ids_crc32."""
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end, width = words_of(tokenizer), np.asarray([end_id], "<u4").tobytes(), 4 * capacity
        for batch in slices(batches):
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                ids = words.of(text) + end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    for out, value in zip(rows, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        out.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def plan_bins(counts: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins for counts[n] pieces of each length n: ([(length, how many)], repetitions) each.

    counts has one more entry than the capacity.
    """
    capacity, left = len(counts) - 1, counts.astype(np.int64).copy()
    lengths, plan = np.arange(capacity + 1), []
    while left.any():
        free, gap, use = left.copy(), capacity, {}
        while gap and len(fit := np.flatnonzero(free[: gap + 1])):
            n = int(fit[-1])
            take = int(min(free[n], gap // n))
            use[n] = take
            free[n] -= take
            gap -= take * n
        small = min(use)
        if gap and (len(use) > 1 or use[small] > 1) and (pair := tightest_pair(free, lengths, gap + small)) and sum(pair) > small:
            use[small] -= 1
            for n in pair:
                use[n] = use.get(n, 0) + 1
            use = {n: k for n, k in use.items() if k}
        times = min(int(left[n]) // k for n, k in use.items())
        for n, k in use.items():
            left[n] -= times * k
        plan.append((sorted(use.items(), reverse=True), times))
    return plan


def tightest_pair(free: np.ndarray, lengths: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two lengths still free whose sum is the largest within room."""
    first = np.flatnonzero(free[: room + 1])
    if not len(first):
        return None
    below = np.maximum.accumulate(np.where(free > 0, lengths, 0))
    second = below[room - first]
    alone = (second == first) & (free[first] < 2)
    second[alone] = below[np.minimum(first[alone] - 1, room - first[alone])]
    total = np.where(second > 0, first + second, 0)
    i = int(total.argmax())
    return (int(first[i]), int(second[i])) if total[i] else None


def place_table(plan: list[tuple[list[tuple[int, int]], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length the ranks at which a pattern's slots begin: (first rank, first sequence, slots, first offset)."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    rank: dict[int, int] = {}
    sequence = 0
    for bins, times in plan:
        offset = 0
        for n, k in bins:
            found.setdefault(n, []).append((rank.get(n, 0), sequence, k, offset))
            rank[n] = rank.get(n, 0) + k * times
            offset += n * k
        sequence += times
    return {n: tuple(np.asarray(c, np.int64) for c in zip(*rows, strict=True)) for n, rows in found.items()}


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces with their sequence_id and offset.

    The driver sees the histogram of lengths alone: as many rows as the
    capacity at most. Pieces of one length get their ranks in groups, so that a
    length shared by many documents is numbered by many tasks.
    """
    spark = docs.sparkSession
    groups = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = materialize(token_pieces(docs, tokenizer, capacity, end_id), "pieces")
    pieces = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", F.input_file_name()), F.lit(groups)))
    sizes = pieces.groupBy("length", "grp").agg(F.count("*").alias("n"))
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in sizes.groupBy("length").agg(F.sum("n")).collect():
        histogram[length] = n
    places = place_table(plan_bins(histogram))

    before = W.partitionBy("length").orderBy("grp").rowsBetween(W.unboundedPreceding, -1)
    first = sizes.select("length", "grp", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"))
    nth = F.row_number().over(W.partitionBy("length", "grp").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    ranked = pieces.withColumn("nth", nth).join(first, ["length", "grp"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first_rank") + F.col("nth")).alias("rank"))

    sent = spark.sparkContext.broadcast(places)  # bounded by the capacity: at most that many patterns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                begins, sequences, slots, offsets = sent.value[int(n)]
                i = np.searchsorted(begins, rank[at], side="right") - 1
                within = rank[at] - begins[i]
                sequence[at] = sequences[i] + within // slots[i]
                offset[at] = offsets[i] + within % slots[i] * n
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start")), batch.column("length").cast(pa.int64()), batch.column("ids_crc32"), pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
