"""Burrows-Wheeler transforms of string collections, and their merge by refining an interleave.

A collection's symbols are its bytes plus 1 (UTF-8 has none above 0xF4), 0 ends
every string; no two ends are alike. A shard is sorted on its own. Two or more
shards are merged without sorting their suffixes again: the interleave is the
merged order of the shards' rows as far as it is known. It begins with what the
first symbols of the shards' sorted rows say, in blocks; dealing it out by the symbols
before the suffixes, in order, and going on to the suffixes with these symbols
makes it right for one more symbol each time. A suffix alone in its block is
decided: what it shares with its neighbours is known, and no longer suffix that
ends in it can be shared, so that it leaves the interleave. Blocks that are left
after ``depth`` steps are the repeated intervals.
"""

from __future__ import annotations

import numpy as np


def symbols(strings: list[bytes]) -> np.ndarray:
    """The collection as symbols, each string followed by its end."""
    joined = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
    return joined + np.uint8(1)  # 0xff wraps to 0


#: Symbols that fit a number; a sort begins with so many.
HEAD = 8


def heads(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first HEAD symbols from every place as a number, those after an end 0, and how many come before the end."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(HEAD, np.uint8)])
    head, length, going = np.zeros(n, np.uint64), np.zeros(n, np.int8), np.ones(n, bool)
    for k in range(HEAD):
        own = padded[k : k + n]
        going &= own > 0
        head = head << np.uint64(8) | np.where(going, own, 0).astype(np.uint64)
        length += going
    return head, length


def suffix_order(head: np.ndarray, length: np.ndarray, depth: int) -> np.ndarray:
    """Places of the suffixes in order, each compared for ``depth`` symbols at least or to the end of its string."""
    n = len(head)
    order = np.argsort(head, kind="stable")
    new = np.ones(n, bool)
    new[1:] = (head[order][1:] != head[order][:-1]) | (length[order][1:] < HEAD)
    step = HEAD
    while True:
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        if step >= depth or new.all():
            return order
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)
        ordered = key[order]
        new[1:] = ordered[1:] != ordered[:-1]
        step *= 2


class Shard:
    """A sorted collection: its suffixes' places, the symbol before each, and the row of the suffix that begins there."""

    def __init__(self, strings: list[bytes], depth: int):
        text = symbols(strings)
        head, length = heads(text)
        self.places = suffix_order(head, length, depth)
        self.head, self.length = head[self.places], length[self.places]
        self.before = text[self.places - 1]  # before the first symbol comes the last string's end
        row = np.empty(len(text), np.int32)
        row[self.places] = np.arange(len(text), dtype=np.int32)
        self.back = row[self.places - 1]


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, block, shared): rows of the repeated intervals in order, their interval, and for every row how many symbols it shares with another at most.

    Rows count through the shards; no row counts as sharing more than ``depth``.
    """
    sizes = np.array([len(s.places) for s in shards])
    firsts = np.cumsum(sizes) - sizes
    before = np.concatenate([s.before for s in shards])
    back = np.concatenate([s.back + np.int32(at) for s, at in zip(shards, firsts.tolist(), strict=True)])
    # what the shards' sorted heads say: an interleave that is right for HEAD symbols
    head, length = np.concatenate([s.head for s in shards]), np.concatenate([s.length for s in shards])
    rows = np.argsort(head, kind="stable").astype(np.int32)
    head, length = head[rows], length[rows]
    differ = head[1:] ^ head[:-1]
    common = sum((differ >> np.uint64(64 - 8 * k) == 0).astype(np.int8) for k in range(1, HEAD)) + (differ == 0)
    common = np.minimum(common, np.minimum(length[1:], length[:-1]))
    most = np.zeros(len(rows) + 1, np.int16)
    most[1:-1] = common
    shared = np.empty(len(rows), np.int16)
    shared[rows] = np.minimum(np.maximum(most[:-1], most[1:]), depth)
    begun = min(HEAD, depth)
    new = np.ones(len(rows) + 1, bool)
    new[1:-1] = common < begun
    alone = new[:-1] & new[1:]
    rows, block = rows[~alone], np.cumsum(new[:-1], dtype=np.int32)[~alone]
    for _ in range(begun, depth):
        if not len(rows):
            break
        symbol = before[rows]
        order = np.argsort(symbol, kind="stable")
        order = order[np.count_nonzero(symbol == 0) :]  # ends are alone
        symbol, block, rows = symbol[order], block[order], back[rows[order]]
        new = np.ones(len(rows) + 1, bool)
        new[1:-1] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        alone = new[:-1] & new[1:]
        block = np.cumsum(new[:-1], dtype=np.int32)[~alone]
        rows = rows[~alone]
        shared[rows] += 1  # the rows that share one symbol more
    return rows, block, shared
