"""A sorted vocabulary as a minimal acyclic transducer from terms to ordinals.

Terms are added in byte order.  When the next term leaves a path, the states below the
branching point can get no more arcs; each is replaced by an equal state if there is
one (same finality, same arcs), so the automaton is minimal at every moment and needs
memory for its states only.  An arc's output is the number of terms that sort before all
terms behind it; the outputs along a term's path sum to its place in the sorted list.

Arcs lie in flat arrays ordered by (state, byte), with a hash table of their keys, so that
a whole slice of text steps through the automaton together: all of its terms take their
k-th byte at once.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

#: Bytes that make up terms: A-Z, a-z and every byte of a code point over 127.
IN_TERM = np.zeros(256, bool)
IN_TERM[65:91] = IN_TERM[97:123] = IN_TERM[128:] = True
#: Every byte with A-Z lower-cased, and a blank for every byte outside of terms.
FOLD = np.where(IN_TERM, np.arange(256), 32).astype(np.uint8)
FOLD[65:91] += 32


#: Bytes whose terms step through an automaton together.
PIECE = 1 << 21


@dataclass
class Transducer:
    keys: np.ndarray  # state << 8 | byte, ascending
    targets: np.ndarray
    outputs: np.ndarray
    final: np.ndarray
    root: int
    size: int

    def __post_init__(self):
        """A table of arcs by key, open addressing, a quarter full at most."""
        bits = (4 * len(self.keys)).bit_length()
        self.shift = np.uint64(64 - bits)
        self.slots = np.full((1 << bits) + 1, -1, np.int64)
        self.arcs = np.zeros((1 << bits) + 1, np.int32)
        left, slot = np.arange(len(self.keys)), self._slot(self.keys)
        while len(left):
            slot = np.where(slot == 1 << bits, 0, slot)
            free = self.slots[slot] == -1
            mine = np.zeros(len(left), bool)
            mine[np.unique(slot, return_index=True)[1]] = True
            mine &= free
            self.slots[slot[mine]] = self.keys[left[mine]]
            self.arcs[slot[mine]] = left[mine]
            left, slot = left[~mine], slot[~mine] + 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The arcs of the keys, -1 where there is none."""
        slot = self._slot(keys)
        there = self.slots[slot]
        found = np.where(there == keys, self.arcs[slot], -1)
        left = np.flatnonzero((there != keys) & (there != -1))
        slot = slot[left]
        while len(left):
            slot = slot + 1
            slot[slot == len(self.slots) - 1] = 0
            there = self.slots[slot]
            hit = there == keys[left]
            found[left[hit]] = self.arcs[slot[hit]]
            on = ~hit & (there != -1)
            left, slot = left[on], slot[on]
        return found

    def dump(self) -> bytes:
        return pickle.dumps((self.keys, self.targets, self.outputs, self.final, self.root, self.size), protocol=5)

    @staticmethod
    def load(data: bytes) -> Transducer:
        return Transducer(*pickle.loads(data))

    def ordinals(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The ordinals of the terms ``data[start:start + length]``, -1 for unknown ones."""
        found = np.full(len(starts), -1, np.int64)
        live, at, left = np.arange(len(starts)), starts.copy(), lengths.copy()
        state = np.full(len(starts), self.root, np.int64)
        total = np.zeros(len(starts), np.int64)
        while len(live):
            arc = self._find(state << 8 | data[at])
            goes = np.flatnonzero(arc >= 0)
            arc, live, at, left = arc[goes], live[goes], at[goes] + 1, left[goes] - 1
            state, total = self.targets[arc].astype(np.int64), total[goes] + self.outputs[arc]
            ends = left == 0
            if ends.any():
                found[live[ends]] = np.where(self.final[state[ends]], total[ends], -1)
                on = np.flatnonzero(~ends)
                live, at, left, state, total = live[on], at[on], left[on], state[on], total[on]
        return found

    def term(self, ordinal: int) -> bytes:
        """The term at a place, by following the last arc whose output does not exceed it."""
        state, out = self.root, bytearray()
        while True:
            if ordinal == 0 and self.final[state]:
                return bytes(out)
            a, b = np.searchsorted(self.keys, [state << 8, (state + 1) << 8])
            arc = a + int(np.searchsorted(self.outputs[a:b], ordinal, "right")) - 1
            ordinal -= int(self.outputs[arc])
            out.append(int(self.keys[arc]) & 255)
            state = int(self.targets[arc])


def build(terms: Iterable[bytes]) -> Transducer:
    """Of different, not empty terms in byte order."""
    keys: list[int] = []
    targets: list[int] = []
    outputs: list[int] = []
    final: list[bool] = []
    counts: list[int] = []
    register: dict[tuple, int] = {}

    def settle(ends: bool, arcs: list[tuple[int, int]]) -> int:
        signature = (ends, *arcs)
        state = register.get(signature)
        if state is None:
            state = register[signature] = len(final)
            behind = int(ends)
            for byte, target in arcs:
                keys.append(state << 8 | byte)
                targets.append(target)
                outputs.append(behind)
                behind += counts[target]
            final.append(ends)
            counts.append(behind)
        return state

    # the path of the last term: per depth whether a term ends there, and settled arcs
    last = b""
    ends, arcs = [False], [[]]
    for term in terms:
        if term <= last:
            raise ValueError("terms must be different and in byte order")
        common = next((i for i, (x, y) in enumerate(zip(last, term)) if x != y), min(len(last), len(term)))
        for depth in range(len(last), common, -1):
            arcs[depth - 1].append((last[depth - 1], settle(ends.pop(), arcs.pop())))
        ends += [False] * (len(term) - common)
        arcs += [[] for _ in range(len(term) - common)]
        ends[-1] = True
        last = term
    for depth in range(len(last), 0, -1):
        arcs[depth - 1].append((last[depth - 1], settle(ends.pop(), arcs.pop())))
    root = settle(ends[0], arcs[0])
    return Transducer(np.array(keys, np.int64), np.array(targets, np.int32), np.array(outputs, np.int64),
                      np.array(final, bool), root, counts[root])


def pieces(data: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, np.ndarray]]:
    """``(start, bytes)``: the data in pieces that no term crosses."""
    start = 0
    while start < len(data):
        end = start + limit
        while end < len(data) and IN_TERM[data[end]]:
            ahead = np.flatnonzero(~IN_TERM[data[end:end + limit]])
            end += int(ahead[0]) if len(ahead) else limit
        yield start, data[start:end]
        start = end


def term_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the terms in UTF-8 bytes."""
    inside = IN_TERM[data]
    edges = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts = np.flatnonzero(edges == 1)
    return starts, np.flatnonzero(edges == -1) - starts


def _heads(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first eight bytes of each term as a number (zeros behind a shorter one)."""
    head = np.zeros(len(starts), np.uint64)
    for k in range(8):
        byte = np.where(lengths > k, data[np.minimum(starts + k, len(data) - 1)], 0).astype(np.uint64)
        head = head << np.uint64(8) | byte
    return head


class Shelf:
    """The transducers of consecutive ranges of one vocabulary, with global ordinals."""

    def __init__(self, shards: list[tuple[bytes, bytes, int, Transducer]]):
        """``shards``: first term, last term, ordinal of the first, transducer; any order."""
        self.shards = sorted(shards, key=lambda s: s[0])
        ends = [np.frombuffer(b"".join(s[k][:8].ljust(8, b"\0") for s in self.shards), ">u8").astype(np.uint64)
                for k in (0, 1)]
        self.firsts, self.lasts = ends

    def ordinals(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if len(self.shards) == 1:
            found = self.shards[0][3].ordinals(data, starts, lengths)
            return np.where(found >= 0, found + self.shards[0][2], -1)
        found = np.full(len(starts), -1, np.int64)
        head = _heads(data, starts, lengths)
        # ranges whose ends share their first bytes may both hold a term: each is tried
        low, high = np.searchsorted(self.lasts, head, "left"), np.searchsorted(self.firsts, head, "right")
        left = np.flatnonzero(low < high)
        while len(left):
            order = left[np.argsort(low[left], kind="stable")]
            for some in np.split(order, np.flatnonzero(np.diff(low[order])) + 1):
                _, _, offset, fst = self.shards[low[some[0]]]
                got = fst.ordinals(data, starts[some], lengths[some])
                found[some] = np.where(got >= 0, got + offset, -1)
            low[left] += 1
            left = left[(found[left] < 0) & (low[left] < high[left])]
        return found

    def term(self, ordinal: int) -> bytes | None:
        """The term at a place, None if it is in none of these ranges."""
        for _, _, offset, fst in reversed(self.shards):
            if ordinal >= offset:
                return fst.term(ordinal - offset) if ordinal - offset < fst.size else None
        return None
