"""Names of a dictionary in texts, found by hashes of their characters.

The dictionary is a few arrays (about a hundred bytes a name, strings included), made once on the driver: a trie of objects in each worker
takes about eight times as much. A place is tried by the hash of its first characters, then by a hash for each length of the names that begin
so; every hit is compared with the name itself, so that a chance collision finds nothing.
"""

from __future__ import annotations

from functools import cache

import numpy as np

#: What stands between texts: no text holds it.
_BETWEEN = "\ud800"
_BASE = 0x9E3779B97F4A7C15
#: Characters by which a place is tried first, and those of texts that are hashed at once.
_STEM, _CHUNK = 6, 1 << 17


def lowered(text: str) -> str:
    """Lower case, character by character, so that places stay the same."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _narrow(codes: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes as hold the largest."""
    most = int(codes.max(initial=0))
    return codes.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)


@cache
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


@cache
def _word_characters() -> np.ndarray:
    out = np.array([chr(i).isalnum() for i in range(0x110000)])
    out[ord("_")] = True
    return out


class Names:
    """Distinct names, none of them empty; a name is told by its place among them."""

    def __init__(self, names: list[str]):
        low = [lowered(n) for n in names]
        sizes = np.array([len(n) for n in names], np.int64)
        self.longest = int(sizes.max(initial=0))
        self.room = -(-(_CHUNK + self.longest) // _CHUNK) * _CHUNK
        #: By length: names in the order of their hashes, these, the characters in lower case and as written, and, where names share a hash, how many follow.
        self.kinds: list[tuple] = []
        stems: dict[int, list[tuple[int, np.ndarray]]] = {}
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            lows = _codes("".join([low[i] for i in own])).reshape(-1, size)
            hashes = self._hash(lows)
            order = np.argsort(hashes, kind="stable")
            hashes, own = hashes[order], own[order]
            written = _codes("".join([names[i] for i in own])).reshape(-1, size)
            ends = np.searchsorted(hashes, hashes, "right") if (hashes[1:] == hashes[:-1]).any() else None
            stem = min(size, _STEM)
            stems.setdefault(stem, []).append((len(self.kinds), np.unique(self._hash(lows[:, :stem]))))
            self.kinds.append((size, own, hashes, _narrow(lows[order]), _narrow(written), ends))
        #: By stem: a table of bits, for each hash of a stem the lengths of names that begin so (the last bit: all further lengths), and these lengths.
        self.stems: list[tuple] = []
        for stem, of in stems.items():
            bits = min(24, max(10, sum(len(h) for _, h in of).bit_length() + 2))
            table = np.zeros(1 << bits, np.uint32)
            for k, (_, h) in enumerate(of):
                table[h >> np.uint64(64 - bits)] |= np.uint32(1 << min(k, 31))
            self.stems.append((stem, np.uint64(64 - bits), table, [kind for kind, _ in of]))

    @staticmethod
    def _hash(rows: np.ndarray) -> np.ndarray:
        out, power = np.zeros(len(rows), np.uint64), 1
        for k in range(rows.shape[1]):
            out += rows[:, k].astype(np.uint64) * np.uint64(power)
            power = power * _BASE % (1 << 64)
        return out

    def find(self, texts: list[str | None], whole: bool = False) -> tuple[np.ndarray, ...]:
        """(row, name, start, same, whole) of every place where a name stands in whatever case: ``same``, whether it is written as the name is;
        ``whole``, if asked for, whether word boundaries are on both sides."""
        rows = [i for i, t in enumerate(texts) if t]
        found = []
        if rows and self.kinds:
            written = _BETWEEN + _BETWEEN.join([texts[i] for i in rows]) + _BETWEEN
            low = _BETWEEN + _BETWEEN.join([lowered(texts[i]) for i in rows]) + _BETWEEN
            starts = np.cumsum([1] + [len(texts[i]) + 1 for i in rows[:-1]])
            for at in range(1, len(low), _CHUNK):
                for name, place, *is_so in self._in_chunk(low[at : at + _CHUNK + self.longest - 1], written[at - 1 : at + _CHUNK + self.longest], whole):
                    row = np.searchsorted(starts, place + at, "right") - 1
                    found.append((np.array(rows)[row], name, place + at - starts[row], *is_so))
        if not found:
            return (*[np.zeros(0, np.int64)] * 3, *[np.zeros(0, bool)] * 2)
        return tuple(map(np.concatenate, zip(*found, strict=True)))

    def _in_chunk(self, low: str, around: str, whole: bool):
        """The hits that begin in the first ``_CHUNK`` characters. ``around`` has a character more on both sides."""
        low, around = _codes(low), _codes(around)
        written, n = around[1:], len(low)
        word = _word_characters()[around] if whole else None
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(low * _powers(_BASE, self.room)[:n], out=sums[1:])
        back = _powers(pow(_BASE, -1, 1 << 64), self.room)
        for stem, shift, table, kinds in self.stems:
            m = min(_CHUNK, n - stem + 1)
            if m <= 0:
                continue
            lengths = table[((sums[stem : stem + m] - sums[:m]) * back[:m]) >> shift]
            begin = np.flatnonzero(lengths)
            lengths = lengths[begin]
            for k, kind in enumerate(kinds):
                size, own, hashes, lows, as_written, ends = self.kinds[kind]
                place = begin[(lengths & np.uint32(1 << min(k, 31))) != 0]
                place = place[place + size <= n]
                h = (sums[place + size] - sums[place]) * back[place]
                slot = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                equal = hashes[slot] == h
                place, slot = place[equal], slot[equal]
                if ends is not None:  # every name of this hash
                    many = ends[slot] - slot
                    place, slot = np.repeat(place, many), np.repeat(slot, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                step = max(1, (1 << 20) // size)
                for lo in range(0, len(place), step):
                    p, s = place[lo : lo + step], slot[lo : lo + step]
                    right = (np.lib.stride_tricks.sliding_window_view(low, size)[p] == lows[s]).all(axis=1)
                    p, s = p[right], s[right]
                    same = (np.lib.stride_tricks.sliding_window_view(written, size)[p] == as_written[s]).all(axis=1)
                    bounds = (word[p] != word[p + 1]) & (word[p + size] != word[p + size + 1]) if whole else np.zeros(len(p), bool)
                    yield own[s], p, same, bounds
