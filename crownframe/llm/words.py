"""Whole texts to token ids with the tokenizers library, each different word encoded once per worker.

Both vocabularies split a text into words that are merged independently, so a text's ids are the ids of its
words in a row. Texts whose characters all lie in ranges where Python's character classes are those of the
vocabularies' patterns are split here; any other text goes to the library whole. Either way the ids are
those the library gives for the text; strings of special tokens count as ordinary text.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

#: Characters outside these ranges may be classed, composed or lower-cased differently.
UNSAFE = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-įı-˿]")


def _letters() -> str:
    """The letters of the safe ranges as ranges of a character set, which is faster than to exclude classes."""
    safe = [c for c in range(0x300) if not UNSAFE.match(chr(c)) and re.match(r"[^\W\d_]", chr(c))]
    starts = [c for c in safe if c - 1 not in safe]
    ends = [c for c in safe if c + 1 not in safe]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends))


LETTER = f"[{_letters()}]"
#: The vocabularies' split patterns in terms of Python's classes.
SPLIT = {
    "byte_bpe_50k.json": rf" ?{LETTER}+|'s|'t|'re|'ve|'m|'ll|'d| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+",
    "word_bpe_49k.json": rf"{LETTER}+|'s|'t|'re|'ve|'m|'ll|'d|\d|(?:[^\s\w]|_)+",
}
LOWER = {"word_bpe_49k.json"}
#: Words remembered by a worker, and characters split at a time.
REMEMBERED, STEP = 1_000_000, 1 << 20
#: Texts given to the library at a time: what it returns for each takes many times the room of its ids.
GIVEN = 4096


class WordEncoder:
    """Ids of texts as little-endian bytes of `dtype`."""

    def __init__(self, name: str, dtype: str = "<u2", remembered: int | None = None):
        self.remembered = remembered or REMEMBERED
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks use the cores
        self.library = Tokenizer.from_file(public_tokenizers.path(name))
        self.library.encode_special_tokens = True
        if self.library.get_vocab_size() > np.iinfo(dtype).max:
            raise ValueError(f"{name} has ids that don't fit in {dtype}")
        self.split, self.lower, self.dtype = re.compile(SPLIT[name]).findall, name in LOWER, np.dtype(dtype)
        self.known: dict[str, bytes] = {}      # words of late
        self.before: dict[str, bytes] = {}     # and of the time before, of which those seen again move up

    def _by_library(self, texts: list[str]) -> Iterator[bytes]:
        for k in range(0, len(texts), GIVEN):
            found = self.library.encode_batch_fast(texts[k:k + GIVEN], add_special_tokens=False)
            ids = [x.ids for x in found]
            blob = np.fromiter(chain.from_iterable(ids), self.dtype).tobytes()
            at = 0
            for x in ids:
                end = at + len(x) * self.dtype.itemsize
                yield blob[at:end]
                at = end

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= STEP:
                yield from self._some(group)
                group, size = [], 0
        yield from self._some(group)

    def _some(self, texts: list[str]) -> Iterator[bytes]:
        split = [None if UNSAFE.search(t) else self.split(t.lower() if self.lower else t) for t in texts]
        fresh = set(chain.from_iterable(x for x in split if x)).difference(self.known)
        again = fresh.intersection(self.before)
        self.known.update(zip(again, map(self.before.__getitem__, again)))
        fresh = list(fresh - again)
        self.known.update(zip(fresh, self._by_library(fresh)))
        get = self.known.__getitem__
        for t, words in zip(texts, split):
            yield b"".join(map(get, words)) if words is not None else next(self._by_library([t]))
        if len(self.known) > self.remembered // 2:
            self.before, self.known = self.known, {}


@functools.lru_cache(maxsize=4)
def encoder(name: str, dtype: str = "<u2", remembered: int | None = None) -> WordEncoder:
    """The worker's own encoder, kept between tasks."""
    return WordEncoder(name, dtype, remembered)
