"""Ranked merges of a byte-pair vocabulary, exact, for many words at a time."""

import heapq

import numpy as np

NONE = np.int64(1 << 40)
LONG = 256  # bytes; longer words are merged one by one, in n log n steps


def packed(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.asarray(ids, "<u4").tobytes()


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class Merger:
    """Merges of a model as its JSON file states them; the last letter of a word takes `end_of_word_suffix`."""

    def __init__(self, model: dict):
        self.ids: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        self.letters = byte_letters()
        self.inner = np.array([self.ids[self.letters[b]] for b in range(256)], np.int64)
        self.last = np.array([self.ids[self.letters[b] + end] for b in range(256)], np.int64)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        rows = np.array([(self.ids[a], self.ids[b], r, self.ids[a + b]) for r, (a, b) in enumerate(pairs)], np.int64)
        rows = rows[np.argsort(rows[:, 0] << 20 | rows[:, 1], kind="stable")]
        self.key, self.rank, self.joined = rows[:, 0] << 20 | rows[:, 1], rows[:, 2], rows[:, 3]
        self.by_pair = None

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pair = left << 20 | right
        at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
        hit = self.key[at] == pair
        return np.where(hit, self.rank[at], NONE), self.joined[at]

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word: the pair of lowest rank is joined, leftmost first, until no pair is left."""
        out: list[bytes] = [b""] * len(words)
        short = [k for k, w in enumerate(words) if 0 < len(w) <= LONG]
        for k, w in enumerate(words):
            if len(w) > LONG:
                out[k] = packed(self.merge(w))
        if not short:
            return out
        size = np.array([len(words[k]) for k in short])
        text = np.frombuffer(b"".join(words[k] for k in short), np.uint8)
        ids, owner = self.inner[text], np.repeat(np.arange(len(short)), size)
        ends = np.cumsum(size) - 1
        ids[ends] = self.last[text[ends]]
        rank, joined = np.full(len(ids), NONE), np.zeros(len(ids), np.int64)
        rank[:-1], joined[:-1] = self._ranks(ids[:-1], ids[1:])
        rank[ends] = NONE
        while len(ids):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            sizes = np.diff(starts, append=len(ids))
            least = np.minimum.reduceat(rank, starts)
            open_ = least < NONE
            if 2 * np.count_nonzero(open_) < len(open_) or not open_.any():  # set aside the words that are done
                done = np.flatnonzero(~open_)
                raw = ids.astype("<u4").tobytes()
                for a, n, k in zip(starts[done].tolist(), sizes[done].tolist(), owner[starts[done]].tolist()):
                    out[short[k]] = raw[4 * a:4 * (a + n)]
                stay = np.repeat(open_, sizes)
                ids, owner, rank, joined = ids[stay], owner[stay], rank[stay], joined[stay]
                continue
            hits = np.flatnonzero((rank == np.repeat(least, sizes)) & (rank < NONE))
            first = hits[np.diff(owner[hits], prepend=-1) != 0]
            ids[first] = joined[first]
            rank[first] = rank[first + 1]
            keep = np.ones(len(ids), bool)
            keep[first + 1] = False
            ids, owner, rank, joined = ids[keep], owner[keep], rank[keep], joined[keep]
            at = first - np.arange(len(first))
            near = np.concatenate([at, at - 1])
            near = near[(near >= 0) & (near < len(ids) - 1)]
            near = near[owner[near] == owner[near + 1]]
            rank[near], joined[near] = self._ranks(ids[near], ids[near + 1])
            last = at[(at == len(ids) - 1) | (owner[np.minimum(at + 1, len(ids) - 1)] != owner[at])]
            rank[last] = NONE
        return out

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word, by a heap of pairs."""
        if self.by_pair is None:
            pairs = zip(self.key.tolist(), self.rank.tolist(), self.joined.tolist())
            self.by_pair = {key: (r, j) for key, r, j in pairs}
        ids = [*self.inner[list(word[:-1])].tolist(), int(self.last[word[-1]])]
        right, left = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and right[i] >= 0 and (found := self.by_pair.get(ids[i] << 20 | ids[right[i]])):
                heapq.heappush(heap, (found[0], i, ids[i], ids[right[i]]))

        for i in range(len(ids)):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j], right[i] = self.by_pair[a << 20 | b][1], -1, right[j]
            right[j] = -1
            if right[i] >= 0:
                left[right[i]] = i
            offer(left[i])
            offer(i)
        return [i for i in ids if i >= 0]
