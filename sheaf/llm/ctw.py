"""Context-tree weighting over bytes, learned from counts of byte strings.

A model of depth D is made from how often each string of D + 1 bytes occurs:
its first D bytes are a context, the last one the symbol. A symbol is eight
binary decisions, each under the bits before it and under the context's last d
bytes for every d from 0 to D. Each such node has a Krichevsky-Trofimov
estimate from its counts; a node's weighted probability mixes half its own
estimate with half the product of its children's, where a child knows one more
byte of context. What a node then predicts is its own estimate, at the posterior
weight of stopping there, mixed with what its child on the path predicts; where
that child was never seen, its own estimate alone.
"""

from __future__ import annotations

import math

import numpy as np

_U = np.uint64


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln(gamma) for x >= 1/2: Stirling's series after a shift by 8."""
    y, shift = np.asarray(x, np.float64) + 8, 0.0
    for k in range(8):
        shift = shift + np.log(x + k)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def kt_block(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the KT probability of a sequence with these counts."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - math.log(math.pi) - log_gamma(n0 + n1 + 1.0)


def node_key(context: np.ndarray, symbol: np.ndarray, bits: int) -> np.ndarray:
    """A node's number: its context's bytes, then its known bits below a leading 1."""
    return (context << _U(8)) | (_U(1) << _U(bits)) | (symbol >> _U(8 - bits))


class Slots:
    """A table from 64-bit keys to floats with vectorized look-up: linear probing in twice the room."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * max(1, len(keys)) - 1).bit_length())
        n = 1 << self.bits
        self.keys = np.full(n, 2**64 - 1, np.uint64)
        self.values = np.zeros(n, np.float32)
        self.probes = 0
        left, at = np.arange(len(keys)), self.start(keys)
        while len(left):
            self.probes += 1
            free = self.keys[at] == _U(2**64 - 1)
            place, first = np.unique(at[free], return_index=True)
            won = left[free][first]
            self.keys[place], self.values[place] = keys[won], values[won]
            stay = np.ones(len(left), bool)
            stay[np.flatnonzero(free)[first]] = False
            left, at = left[stay], (at[stay] + 1) & (n - 1)

    def start(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and whether each key is there."""
        at = self.start(keys)
        hit = self.keys[at] == keys
        out = self.values[at]
        left = np.flatnonzero(~hit)
        probe = at[left]
        for _ in range(self.probes):
            if not len(left):
                break
            probe = (probe + 1) & (len(self.keys) - 1)
            there = self.keys[probe]
            good = there == keys[left]
            out[left[good]], hit[left[good]] = self.values[probe[good]], True
            on = ~good & (there != _U(2**64 - 1))
            left, probe = left[on], probe[on]
        return out, hit


class Model:
    """Predictions of a context tree of some depth from counted strings of depth + 1 bytes.

    ``top`` are the nodes of the smaller depths, where they are known already:
    the strings may then be a part of all, if they hold every string whose
    context ends in the same len(top) bytes. ``roots`` are the smallest depth
    made here: node numbers, counts of 0 and 1, and ln of the weighted
    probability.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int, top: tuple[tuple[np.ndarray, np.ndarray, np.ndarray], ...] = (), least: int | None = None):
        self.depth = depth
        least = len(top) if least is None else least
        #: Of each depth: node numbers, weight of stopping, chance of a 1.
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        below: tuple[np.ndarray, np.ndarray] | None = None
        for d in range(depth, least - 1, -1):
            code, place = np.unique(grams & _U((1 << (8 * (d + 1))) - 1), return_inverse=True)
            total = np.bincount(place, counts)
            parts = []
            for bits in range(8):
                bit = ((code >> _U(7 - bits)) & _U(1)).astype(bool)
                key, at = np.unique(node_key(code >> _U(8), code & _U(255), bits), return_inverse=True)
                parts.append((key, np.bincount(at, total * ~bit), np.bincount(at, total * bit)))
            key, n0, n1 = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(key)
            key, n0, n1 = key[order], n0[order], n1[order]
            del parts, code, place, total
            children = None
            if below is not None:
                # a child's number less its oldest context byte is its parent's
                children = np.bincount(np.searchsorted(key, parent_key(below[0], d + 1)), below[1], len(key))
            node, weighted = made(key, n0, n1, children)
            self.nodes.insert(0, node)
            below = key, weighted
            self.roots = key, n0, n1, weighted
        self.nodes[:0] = top

    def node(self, d: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(weight of stopping, chance of a 1, whether it is there) of nodes of a depth."""
        keys, stop, one = self.nodes[d]
        if not len(keys):
            return np.zeros(len(key)), np.zeros(len(key)), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return stop[at].astype(np.float64), one[at].astype(np.float64), keys[at] == key

    def predicted(self, grams: np.ndarray) -> np.ndarray:
        """log10 of the chance of each string's last byte under the bytes before it."""
        out = np.zeros(len(grams))
        symbol = grams & _U(255)
        for bits in range(8):
            chance, left = np.zeros(len(grams)), np.ones(len(grams))
            last = np.full(len(grams), 0.5)
            open_ = np.ones(len(grams), bool)
            for d in range(self.depth + 1):
                context = (grams >> _U(8)) & _U((1 << (8 * d)) - 1)
                key = node_key(context, symbol, bits)
                stop, one, there = self.node(d, key)
                # where no deeper node was seen, all that is left goes to the last one seen
                ends = open_ & ~there
                chance[ends] += left[ends] * last[ends]
                open_ &= there
                on = open_
                if d == self.depth:
                    chance[on] += left[on] * one[on]
                else:
                    # the weight of stopping is given out once the child is known to be there
                    chance[on] += left[on] * stop[on] * one[on]
                    last[on] = one[on]
                    left[on] *= 1 - stop[on]
            bit = ((symbol >> _U(7 - bits)) & _U(1)).astype(bool)
            out += np.log10(np.clip(np.where(bit, chance, 1 - chance), 1e-12, 1))
        return out

    def costs(self, grams: np.ndarray) -> np.ndarray:
        """predicted(), once for each different string."""
        new, back = np.unique(grams, return_inverse=True)
        return np.concatenate([np.zeros(0), *(self.predicted(part) for part in np.array_split(new, len(new) // 100_000 + 1))])[back]


def made(key: np.ndarray, n0: np.ndarray, n1: np.ndarray, children: np.ndarray | None) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """Nodes as Model keeps them, and ln of their weighted probability; children: that of all their children."""
    own_p = kt_block(n0, n1)
    if children is None:
        weighted, stop = own_p, np.ones(len(key))
    else:
        weighted = np.logaddexp(own_p, children) + math.log(0.5)
        stop = np.exp(own_p + math.log(0.5) - weighted)
    return (key, stop.astype(np.float32), ((n1 + 0.5) / (n0 + n1 + 1)).astype(np.float32)), weighted


def top_of(key: np.ndarray, n0: np.ndarray, n1: np.ndarray, children: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The nodes of depths 0 to ``depth``, from the sums of the roots below them."""
    out = []
    for d in range(depth, -1, -1):
        node, weighted = made(key, n0, n1, children)
        out.insert(0, node)
        key, at = np.unique(parent_key(key, d), return_inverse=True)
        n0, n1, children = (np.bincount(at, x, len(key)) for x in (n0, n1, weighted))
    return out


def parent_key(key: np.ndarray, depth: int) -> np.ndarray:
    """The parent's number of nodes at this depth: without the oldest byte of context."""
    return key & _U((1 << (8 * depth)) - 1)


def grams_of(stream: np.ndarray, size: int) -> np.ndarray:
    """Every string of this many bytes, as a number, the first byte highest."""
    n = len(stream) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(size):
        out = (out << _U(8)) | stream[k : k + n]
    return out
