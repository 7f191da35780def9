"""Fast exact encoding with the ``tokenizers`` library by memoising what lies between spaces.

A word-level BPE whose pre-tokeniser never joins text across white space gives the same ids for a
text as for its space-separated units in turn, so each distinct unit is encoded once per Python
worker and texts become concatenations. A unit made of Latin-1 letters and a tail of ASCII symbols is two
pre-tokens: the lower-cased letters go to the library's BPE model directly and the tail is encoded once, so units that
differ in case or tail share their ids. All other units go through the library's whole ``encode``. Special tokens
written in a text get the ids that the library gives them by default.

The cache is bounded: two generations, the older one is dropped when the younger is full. Callers must only use
vocabularies of that kind (letters, single digits and runs of symbols are pre-tokens; lower case) with ids below 65,536
(``word_bpe_49k.json`` is one).
"""

from __future__ import annotations

import os
import re

from .common import kept

#: Letters of one pre-token, then symbols of another. No apostrophe (contractions) and no "<" (special tokens).
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet for Latin-1: printable bytes stand for themselves, the others follow from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class UnitEncoder:
    """Encodes texts to little-endian unsigned 16-bit ids."""

    def __init__(self, vocab_path: str, generation: int = 350_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocab_path)
        self.bpe = self.library.model.tokenize
        self.letters = _byte_letters()
        self.packed = [i.to_bytes(2, "little") for i in range(self.library.get_vocab_size(with_added_tokens=True))]
        self.generation = generation
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}

    def _pack(self, ids: list[int]) -> bytes:
        packed = self.packed
        return b"".join([packed[i] for i in ids])

    def _learn(self, units: list[str]) -> None:
        """Encodes unknown units."""
        young, old, tails, packed, bpe, match, others = self.young, self.old, self.tails, self.packed, self.bpe, _PLAIN.fullmatch, []
        for u in units:
            m = match(u)
            if m is None:
                others.append(u)
                continue
            stem, tail = m.groups()
            low = stem.lower()
            ids = young.get(low) or old.get(low)
            if ids is None:
                word = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
                ids = b"".join([packed[t.id] for t in bpe(word)])
                young[low] = ids
            if tail:
                end = tails.get(tail)
                if end is None:
                    end = self._pack(self.library.encode(tail, add_special_tokens=False).ids)
                    if len(tail) < 16 and len(tails) < 10_000:
                        tails[tail] = end
                ids += end
            young[u] = ids
        for u, enc in zip(others, self.library.encode_batch_fast(others, add_special_tokens=False), strict=True):
            young[u] = self._pack(enc.ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text (a null is an empty text)."""
        split = [(t or "").replace("\n", " ").split(" ") for t in texts]
        if len(self.young) > self.generation:
            self.old, self.young = self.young, {"": b""}
        new = set().union(*split).difference(self.young) if split else set()
        if new:
            found = self.old.keys() & new
            for u in found:
                self.young[u] = self.old[u]
            self._learn(list(new - found))
        get = self.young.__getitem__
        return [b"".join(map(get, units)) for units in split]


def encoder(vocab_path: str) -> UnitEncoder:
    """The worker's encoder, kept between tasks."""
    return kept(("units", vocab_path), lambda: UnitEncoder(vocab_path))
