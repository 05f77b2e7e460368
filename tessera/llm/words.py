"""Words of many texts at once, as arrays.

Texts are laid end to end in one buffer; words are what lies between the bytes
``[\\x20\\x09-\\x0D]``.  Every step is a whole-array operation, so its cost is that
of a few passes over the bytes.
"""

from __future__ import annotations

import itertools

import numpy as np
import xxhash

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_P1, _P2, _P3 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_LONG = 96
#: A-Z to lower case.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def slices(texts: list[bytes], most: int = 1_000_000):
    """Ranges of texts of about ``most`` bytes each; a longer text is a range of its own."""
    start = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, k
            start = size = 0
            start = k
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


class Words:
    """Words of ``texts``: word k is bytes starts[k]:ends[k] of data; text i has words first[i]:first[i + 1]."""

    def __init__(self, texts: list[bytes], breaks: np.ndarray = _WHITE, lower: bool = False):
        data = b"\n".join(texts) + b"\n" + bytes(8)
        self.data = data.translate(LOWER) if lower else data
        size = len(self.data) - 8
        self.bytes = np.frombuffer(self.data, dtype=np.uint8)[:size]
        white = breaks[self.bytes]
        flips = np.flatnonzero(white[1:] != white[:-1]) + 1
        if not white[0]:
            flips = np.concatenate(([0], flips))
        self.starts, self.ends = flips[0::2], flips[1::2]
        at = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
        self.first = np.concatenate(([0], np.searchsorted(self.starts, at)))

    def word(self, k: int) -> bytes:
        return self.data[self.starts[k] : self.ends[k]]


def hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of bytes; ``data`` has eight spare bytes at its end."""
    lanes = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    left = ends - starts
    h = left.astype(np.uint64) * _P3
    todo, at, rest = np.arange(len(starts)), starts, left
    short = left <= _LONG
    if not short.all():
        for k in np.flatnonzero(~short):
            h[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]])
        todo, at, rest = todo[short], starts[short], left[short]
    while len(todo):
        lane = lanes[at]
        part = rest < 8
        lane[part] &= (np.uint64(1) << (rest[part].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        mixed = (h[todo] ^ lane) * _P1
        mixed ^= mixed >> np.uint64(29)
        h[todo] = mixed * _P2
        more = rest > 8
        todo, at, rest = todo[more], at[more] + 8, rest[more] - 8
    h ^= h >> np.uint64(32)
    h[h == 0] = 1
    return h


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of the pair of hashes at each place."""
    x = (a * _P1) ^ (b + _P2)
    x = (x ^ (x >> np.uint64(31))) * _P2
    return x ^ (x >> np.uint64(29))


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices starts[0], starts[0] + 1, ... of all ranges, one range after the other."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return np.arange(total) + np.repeat(starts - before, sizes)


class HashTable:
    """64-bit hashes (never 0) -> numbers from 0 in order of insertion; open addressing, whole arrays at a time."""

    def __init__(self, bits: int = 16):
        self.size = 0
        self._clear(bits)

    def _clear(self, bits: int) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.values = np.zeros(1 << bits, dtype=np.uint64), np.zeros(1 << bits, dtype=np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where it is unknown."""
        out = np.full(len(h), -1, dtype=np.int64)
        slot = (h & self.mask).astype(np.int64)
        key = self.keys[slot]
        hit = key == h
        out[hit] = self.values[slot[hit]]
        todo = np.flatnonzero(~hit & (key != 0))
        while len(todo):
            slot_t = (slot[todo] + 1) & int(self.mask)
            slot[todo] = slot_t
            key = self.keys[slot_t]
            hit = key == h[todo]
            out[todo[hit]] = self.values[slot_t[hit]]
            todo = todo[~hit & (key != 0)]
        return out

    def _put(self, h: np.ndarray, v: np.ndarray) -> None:
        slot = (h & self.mask).astype(np.int64)
        todo = np.arange(len(h))
        while len(todo):
            s = slot[todo]
            free = self.keys[s] == 0
            self.keys[s[free]] = h[todo[free]]  # of several for one place the last stays
            own = self.keys[s] == h[todo]
            self.values[s[own]] = v[todo[own]]
            todo = todo[~own]
            slot[todo] = (slot[todo] + 1) & int(self.mask)

    def add(self, h: np.ndarray) -> None:
        """Insert distinct, unknown hashes."""
        if 2 * (self.size + len(h)) > len(self.keys):
            bits = int(2 * (self.size + len(h))).bit_length() + 1
            old = self.keys != 0
            keys, values = self.keys[old], self.values[old]
            self._clear(bits)
            self._put(keys, values)
        self._put(h, np.arange(self.size, self.size + len(h), dtype=np.int32))
        self.size += len(h)


class WordEncoder:
    """Token ids of texts for a tokenizer that drops white space, from a table of encoded words.

    Words are encoded by the library, each once while the table has room.  Before
    lookup A-Z become lower case and one punctuation mark after a letter or digit
    is cut off, which the tokenizer would do as well.  That is left out for words
    with bytes outside Latin-1 or with a piece of a special token.
    """

    MARKS = np.zeros(256, dtype=bool)
    MARKS[list(b".,;:!?")] = True
    ALNUM = np.zeros(256, dtype=bool)
    ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True

    def __init__(self, path: str, most: int = 500_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.most = Tokenizer.from_file(path), most
        self.table = HashTable()
        self.start, self.count = np.zeros(1 << 10, dtype=np.int64), np.zeros(1 << 10, dtype=np.int32)
        self.pool, self.used = np.zeros(1 << 12, dtype=np.uint32), 0

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, counts = [], []
        for a in range(0, len(texts), 20_000):
            found = [e.ids for e in self.library.encode_batch_fast(texts[a : a + 20_000], add_special_tokens=False)]
            counts.append(np.fromiter(map(len, found), dtype=np.int32, count=len(found)))
            flat.append(np.fromiter(itertools.chain.from_iterable(found), dtype=np.uint32))
        return np.concatenate(flat), np.concatenate(counts)

    @staticmethod
    def _grown(a: np.ndarray, size: int) -> np.ndarray:
        return a if size <= len(a) else np.concatenate((a, np.zeros(max(size, len(a)), dtype=a.dtype)))

    def _learn(self, h: np.ndarray, texts: list[str]) -> None:
        flat, counts = self._ids(texts)
        n = self.table.size
        self.table.add(h)
        self.start, self.count = self._grown(self.start, n + len(h)), self._grown(self.count, n + len(h))
        self.pool = self._grown(self.pool, self.used + len(flat))
        self.start[n : n + len(h)] = self.used + np.cumsum(counts) - counts
        self.count[n : n + len(h)] = counts
        self.pool[self.used : self.used + len(flat)] = flat
        self.used += len(flat)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin (with the end)."""
        words = Words(texts)
        raw, starts, ends = words.bytes, words.starts, words.ends
        data = bytearray(words.data.translate(LOWER))
        odd = np.zeros(len(starts), dtype=bool)
        special = np.flatnonzero((raw[:-1] == 0x3C) & (raw[1:] == 0x7C))
        for at in (np.flatnonzero(raw >= 0xC4), special):
            odd[np.searchsorted(starts, at, side="right") - 1] = True
        for k in np.flatnonzero(odd):
            data[starts[k] : ends[k]] = words.data[starts[k] : ends[k]]
        data = bytes(data)

        last, before = raw[ends - 1], raw[np.maximum(ends - 2, 0)]
        latin = (before >= 0x80) & (raw[np.maximum(ends - 3, 0)] == 0xC3) & (before != 0x97) & (before != 0xB7) & (ends - starts > 2)
        cut = self.MARKS[last] & (ends - starts > 1) & (self.ALNUM[before] | latin) & ~odd
        # Each cut mark is a unit of its own after its word.
        where = np.arange(len(starts)) + np.cumsum(cut) - cut
        total = len(starts) + int(cut.sum())
        us, ue = np.empty(total, dtype=np.int64), np.empty(total, dtype=np.int64)
        us[where], ue[where] = starts, ends - cut
        us[where[cut] + 1], ue[where[cut] + 1] = ends[cut] - 1, ends[cut]
        first = np.append(where, total)[words.first]

        h = hashes(data, us, ue)
        number = self.table.find(h)
        pool, pool_start, pool_count = self.pool, self.start, self.count
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new, at = np.unique(h[missing], return_index=True)
            order = np.argsort(missing[at])  # in order of appearance
            new, at = new[order], missing[at[order]]
            texts_of = [data[us[k] : ue[k]].decode("utf-8", "replace") for k in at]
            room = max(0, self.most - self.table.size)
            if room:
                self._learn(new[:room], texts_of[:room])
                number[missing] = self.table.find(h[missing])
                pool, pool_start, pool_count = self.pool, self.start, self.count
            if len(new) > room:
                extra = HashTable()
                extra.add(new[room:])
                flat, counts = self._ids(texts_of[room:])
                size, used = self.table.size, self.used
                pool = np.concatenate((pool[:used], flat))
                pool_start = np.concatenate((pool_start[:size], used + np.cumsum(counts) - counts))
                pool_count = np.concatenate((pool_count[:size], counts))
                missing = np.flatnonzero(number < 0)
                number[missing] = size + extra.find(h[missing])
        sizes = pool_count[number].astype(np.int64)
        ids = pool[spread(pool_start[number], sizes)]
        return ids, np.concatenate(([0], np.cumsum(sizes)))[first]
