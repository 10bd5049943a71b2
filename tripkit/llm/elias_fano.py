"""Elias-Fano sequences and a memory-mapped trie of contexts and followers, over numpy arrays."""

from __future__ import annotations

from functools import cached_property

import numpy as np


def _pack_low(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bits of each value, one after the other, as bytes with room to read past the end."""
    if width == 0 or not len(values):
        return np.zeros(16, np.uint8)
    # 64 values fill ``width`` words: value j of every 64 goes to the same bits
    v = np.zeros(-(-len(values) // 64) * 64, np.uint64)
    v[:len(values)] = values & np.uint64((1 << width) - 1)
    v = np.ascontiguousarray(v.reshape(-1, 64).T)
    out = np.zeros((width, v.shape[1]), np.uint64)
    for j in range(64):
        word, bit = divmod(j * width, 64)
        out[word] |= v[j] << np.uint64(bit)
        if bit + width > 64:
            out[word + 1] |= v[j] >> np.uint64(64 - bit)
    return np.concatenate([np.ascontiguousarray(out.T).reshape(-1).view(np.uint8), np.zeros(16, np.uint8)])


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary. Selects go by directories
    of the ones and of the zeros, read off the high bits at the first query."""

    ARRAYS = ("low", "high", "shape")

    def __init__(self, low, high, shape):
        self.low, self.high, self.shape = low, high, shape
        self.n, self.width = int(shape[0]), int(shape[1])
        # every byte offset as the start of an 8-byte little-endian word
        self.words = np.lib.stride_tricks.as_strided(low[:8].view("<u8"), (max(1, len(low) - 8),), (1,), writeable=False)

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        v = values.astype(np.uint64)
        n, top = len(v), int(v[-1]) + 1 if len(v) else 1
        width = min(56, max(0, (top // max(1, n)).bit_length() - 1))
        at = (v >> np.uint64(width)).astype(np.int64) + np.arange(n)
        size = (int(at[-1]) if n else 0) + 66
        bits = np.zeros(-(-size // 64) * 64, np.uint8)
        bits[at] = 1
        return cls(_pack_low(v, width), np.packbits(bits, bitorder="little").view("<u8"), np.array([n, width], np.int64))

    def _places(self, bit: int) -> np.ndarray:
        """Place of each such bit among the high bits, less the number of such bits before it."""
        at = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little") == bit)
        at -= np.arange(len(at))
        return at

    @cached_property
    def _highs(self) -> np.ndarray:
        """High part of each value."""
        return self._places(1)

    @cached_property
    def _buckets(self) -> np.ndarray:
        """Position of the first value whose high part is 0, 1, ... or more."""
        return np.concatenate([[0], self._places(0)])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if self.width == 0:
            return np.zeros(len(i), np.uint64)
        bit = i * self.width
        return self.words[bit >> 3] >> (bit & 7).astype(np.uint64) & np.uint64((1 << self.width) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at positions ``i``."""
        return self._highs[i].astype(np.uint64) << np.uint64(self.width) | self._low(i)

    def _candidate(self, x: np.ndarray, start: np.ndarray, end: np.ndarray):
        """(position in x's bucket of the only value that can be x's successor, whether there is one,
        x's low bits): the bucket by select, halved until one value is left."""
        high = np.minimum(x >> np.uint64(self.width), np.uint64(len(self._buckets) - 2)).astype(np.int64)
        at = np.clip(self._buckets[high], start, end)
        last = np.clip(self._buckets[high + 1], start, end)
        want = x & np.uint64((1 << self.width) - 1)
        todo = np.flatnonzero(last - at > 1)  # a frequent context's followers may crowd in few buckets
        low, high, x = at[todo], last[todo], want[todo]
        while len(todo):
            mid = (low + high - 1) >> 1
            less = self._low(mid) < x
            low, high = np.where(less, mid + 1, low), np.where(less, high, mid + 1)
            at[todo] = low
            more = np.flatnonzero(high - low > 1)
            todo, low, high, x = todo[more], low[more], high[more], x[more]
        return at, at < last, want

    def successor(self, x: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Position in [start, end) of the first value >= x, or ``end``."""
        at, there, want = self._candidate(x.astype(np.uint64), start, end)
        at[there] += self._low(at[there]) < want[there]
        return at

    def find(self, x: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Position of x in [start, end), or -1: the successor, if it has x's bucket and low bits."""
        at, there, want = self._candidate(x.astype(np.uint64), start, end)
        there[there] = self._low(at[there]) == want[there]
        return np.where(there, at, -1)


#: Codes of probabilities: -log10 in steps of 1/4096.
STEPS = 4096
NONE = 0xFFFF
_POWERS = np.append(10.0 ** (-np.arange(NONE, dtype=np.float64) / STEPS), 0.0)


def quantise(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.round(-np.log10(p) * STEPS), NONE - 1).astype(np.uint16)


def expand(code: np.ndarray) -> np.ndarray:
    """Probabilities of codes; ``NONE`` is 0."""
    return _POWERS[code]


class Trie:
    """Levels: words (sorted fingerprints), contexts, pointers from contexts to followers, followers
    (word numbers made monotone by the last value of the context before), and the quantised
    probabilities: of each follower, and of the mass each context leaves to the lower order."""

    LEVELS = ("words", "contexts", "pointers", "followers")

    def __init__(self, levels: dict[str, EliasFano], p: np.ndarray, rest: np.ndarray):
        self.levels, self.p, self.rest = levels, p, rest
        self.__dict__.update(levels)

    @classmethod
    def build(cls, context: np.ndarray, follower: np.ndarray, count: np.ndarray, discount: float) -> Trie:
        """From distinct (context, follower) pairs in order, with counts over 0: absolute discounting."""
        contexts, c = np.unique(context, return_inverse=True)
        followers, f = np.unique(follower, return_inverse=True)
        return cls.numbered(contexts, followers, c, f, count, discount)

    @classmethod
    def numbered(cls, contexts: np.ndarray, followers: np.ndarray, c: np.ndarray, f: np.ndarray, count: np.ndarray, discount: float) -> Trie:
        """The same from pairs (contexts[c], followers[f]) of sorted distinct values, some of them unused."""
        new = np.flatnonzero(np.concatenate([np.ones(min(1, len(c)), bool), c[1:] != c[:-1]]))
        size = np.diff(np.append(new, len(c)))
        total = np.add.reduceat(count, new) if len(new) else np.empty(0, np.int64)
        used = np.zeros(len(followers), bool)
        used[f] = True
        number = (np.cumsum(used) - 1)[f]
        last = number[np.append(new[1:], len(c))[:len(new)] - 1] if len(new) else number
        base = np.cumsum(last) - last  # the last value of the context before
        levels = {"words": followers[used], "contexts": contexts[c[new]], "pointers": np.append(new, len(c)), "followers": number + np.repeat(base, size)}
        return cls({k: EliasFano.build(v) for k, v in levels.items()},
                   quantise((count - discount) / np.repeat(total, size)), quantise(discount * size / total))

    def query(self, contexts: np.ndarray, followers: np.ndarray, c: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the pairs (contexts[c], followers[f]) and of each context's rest. Contexts and
        words are found once each, pairs by successor search within their context's range."""
        n, m = self.contexts.n, self.words.n
        p, rest = np.full(len(c), NONE, np.uint16), np.full(len(contexts), NONE, np.uint16)
        if not n:
            return p, rest
        at = self.contexts.find(contexts, np.zeros(len(contexts), np.int64), np.full(len(contexts), n))
        word = self.words.find(followers, np.zeros(len(followers), np.int64), np.full(len(followers), m))
        rest[at >= 0] = self.rest[at[at >= 0]]
        known = np.flatnonzero((at[c] >= 0) & (word[f] >= 0))
        safe = np.maximum(at, 0)
        start, end = self.pointers.access(safe).astype(np.int64), self.pointers.access(safe + 1).astype(np.int64)
        base = np.where(start > 0, self.followers.access(np.maximum(start - 1, 0)), np.uint64(0))
        mine = c[known]
        where = self.followers.find(word[f[known]].astype(np.uint64) + base[mine], start[mine], end[mine])
        hit = where >= 0
        p[known[hit]] = self.p[where[hit]]
        return p, rest

    def _arrays(self):
        return [getattr(self.levels[k], a) for k in self.LEVELS for a in EliasFano.ARRAYS] + [self.p, self.rest]

    def mapped(self) -> Trie:
        """The same trie over a memory-mapped temporary file, which is already unlinked."""
        import tempfile
        arrays = self._arrays()
        with tempfile.TemporaryFile() as f:
            at = []
            for a in arrays:
                f.write(b"\0" * (-f.tell() % 8))
                at.append(f.tell())
                f.write(np.ascontiguousarray(a).tobytes())
            f.write(b"\0" * 8)
            f.flush()
            whole = np.memmap(f, np.uint8, mode="r")
        views = [whole[s:s + a.nbytes].view(a.dtype) for s, a in zip(at, arrays)]
        k = len(EliasFano.ARRAYS)
        levels = {name: EliasFano(*views[i * k:(i + 1) * k]) for i, name in enumerate(self.LEVELS)}
        return Trie(levels, views[-2], views[-1])

    @property
    def n_bytes(self) -> int:
        return sum(a.nbytes for a in self._arrays())
