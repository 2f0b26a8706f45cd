"""A minimal acyclic transducer: words share prefixes and suffixes, and the outputs along a path add up to a word's number.

Compiled once from sorted words, kept as flat arrays, and read through a memory map.
"""

import mmap
import os

import numpy as np

PARTS = ["arc_key", "arc_to", "arc_out", "final", "id_start", "ids"]


def compile_words(words: dict[bytes, bytes]) -> bytes:
    """The automaton of words with packed ids, as bytes; the shared-suffix states are found while sorted words are added.

    Arc (state, byte) has the next state and an output: the number of words that come before, from this state. The sum
    of outputs, and of final states passed, is the word's place in sorted order, which points to its ids.
    """
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    count: list[int] = []
    path: list[list] = [[False, []]]  # of the last word: [is final, arcs (byte, state)]
    ordered, last = sorted(words), b""

    def close(depth: int, word: bytes) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(states)
                states.append(key)
                count.append(final + sum(count[to] for _, to in arcs))
            path[-1][1].append((word[len(path) - 1], register[key]))

    for word in ordered:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        close(same, last)
        path.extend([False, []] for _ in word[same:])
        path[-1][0], last = True, word
    close(0, last)
    root = len(states)
    states.append((path[0][0], tuple(path[0][1])))

    arcs = []
    for state, (final, out) in enumerate(states):
        passed = int(final)
        for byte, to in out:
            arcs.append((state * 256 + byte, to, passed))
            passed += count[to]
    table = np.array(sorted(arcs), np.int64).reshape(-1, 3)
    ids = [words[w] for w in ordered]
    start = np.zeros(len(ids) + 1, np.int64)
    start[1:] = np.cumsum([len(i) // 4 for i in ids]) if ids else 0
    parts = [table[:, 0], table[:, 1], table[:, 2], np.array([f for f, _ in states], np.int64), start,
             np.frombuffer(b"".join(ids), "<u4").astype(np.int64)]
    head = np.array([root, *map(len, parts)], np.int64)
    return b"".join(np.ascontiguousarray(p).tobytes() for p in [head, *parts])


class Lexicon:
    """Looks words up in a compiled automaton, many words at a time."""

    def __init__(self, image: bytes):
        # An unnamed file in memory: it needs no folder and is gone with the process.
        with open(os.memfd_create("lexicon"), "wb+") as file:
            file.write(image)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        flat = np.frombuffer(self.map, np.int64)
        self.root, sizes = int(flat[0]), flat[1:1 + len(PARTS)]
        at = 1 + len(PARTS)
        for name, size in zip(PARTS, sizes):
            setattr(self, name, flat[at:at + size])
            at += size

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """Packed ids of each word, None where the automaton does not accept it."""
        if not words or not len(self.arc_key):
            return [None] * len(words)
        size = np.array([len(w) for w in words])
        text = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        start = np.cumsum(size) - size
        state, number = np.full(len(words), self.root), np.zeros(len(words), np.int64)
        alive = np.flatnonzero(size > 0)
        at = 0
        while len(alive):
            key = state[alive] * 256 + text[start[alive] + at]
            arc = np.minimum(np.searchsorted(self.arc_key, key), len(self.arc_key) - 1)
            there = self.arc_key[arc] == key
            state[alive] = np.where(there, self.arc_to[arc], -1)
            number[alive] += np.where(there, self.arc_out[arc], 0)
            at += 1
            alive = alive[there & (size[alive] > at)]
        found = (state >= 0) & (self.final[state] == 1) & (size > 0)
        return [self.ids[self.id_start[n]:self.id_start[n + 1]].astype("<u4").tobytes() if f else None
                for f, n in zip(found.tolist(), number.tolist())]
