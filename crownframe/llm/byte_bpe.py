"""Byte-level BPE with vectorised pre-tokenisation.

A block of texts is one array of code points. Each gets a class (letter, number, white space, apostrophe
that begins a contraction, other; the class of white space says if its run goes on), and a finite automaton
over the classes tells where a word begins. Steps of an automaton are functions from states to states and
their composition is associative, so the block is cut into rows of characters: the function of every row
is composed at once, column by column, a prefix scan over the rows gives the state each row is entered
with, and a second pass marks the words. The slices go through a cache of merged words. The ids' byte lengths
give offsets, by which any run of ids is decoded from the flat bytes of the vocabulary.

Defined results: null text is empty and has no ids; texts are never read as special tokens; bytes that
decode to no text are kept as bytes. Other columns are never looked at.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import sys
from collections.abc import Iterator
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownframe.llm.shared import ship, whole_text

#: Classes of characters.
LETTER, NUMBER, OTHER, SPACE, TWO, THREE, INNER, LAST_BLANK, LAST_SPACE, END = range(10)
#: States: what the open word is; HAVE_n waits for n more letters of a contraction.
NONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, AFTER_BLANK, CLOSED, HAVE_1, HAVE_2 = range(9)
#: White space of the pattern, and the letters of contractions after the apostrophe.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
         0x3000]
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")
#: Characters in a row of the scan; characters taken at a time; words remembered by a worker.
ROW, STEP, REMEMBERED = 256, 1 << 20, 300_000


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """next[state, class] and begins[state, class]: whether a word begins with the character."""
    into = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SPACE: IN_SPACES, TWO: HAVE_1,
            THREE: HAVE_2, INNER: IN_SPACES, LAST_BLANK: AFTER_BLANK, LAST_SPACE: CLOSED, END: NONE}
    follow = np.zeros((9, 10), np.uint8)
    begins = np.ones((9, 10), bool)
    for c, s in into.items():
        follow[:, c] = s

    def stays(state: int, kind: int, to: int) -> None:
        follow[state, kind], begins[state, kind] = to, False

    for kind, state in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        stays(state, kind, state)
        stays(AFTER_BLANK, kind, state)          # a blank belongs to the word after it
    for kind in (TWO, THREE):                    # no contraction inside other characters or after a blank
        stays(IN_OTHERS, kind, IN_OTHERS)
        stays(AFTER_BLANK, kind, IN_OTHERS)
    stays(IN_SPACES, INNER, IN_SPACES)
    stays(HAVE_2, LETTER, HAVE_1)
    stays(HAVE_1, LETTER, CLOSED)
    return follow, begins


FOLLOW, BEGINS = _automaton()


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point, in the Unicode version that the tiktoken library goes by: asked once,
    for letters and for numbers, which of all code points it keeps."""
    found = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        asked = tiktoken.Encoding("classes", pat_str=pattern, special_tokens={},
                                  mergeable_ranks={bytes([i]): i for i in range(256)})
        kept = bytes(asked.encode_ordinary(every)).decode()
        found[np.frombuffer(kept.encode("utf-32-le"), "<u4")] = kind
    found[WHITE] = SPACE
    return found


def word_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where words begin. `points` are code points of texts; `ends` are the places of one filler each after
    every text, which also count as beginnings."""
    cls = _classes()[points]
    cls[ends] = END
    after = np.append(cls[1:], np.uint8(END))
    space = cls == SPACE
    last = space & (after != SPACE) & (after != END)
    cls[space] = INNER
    cls[last] = np.where(points[last] == 0x20, LAST_BLANK, LAST_SPACE)
    for i in np.flatnonzero(points == 0x27):
        tail = "".join(map(chr, points[i + 1:i + 3]))
        if cls[i] == END:
            continue
        if tail[:1] and tail[0] in ONE_LETTER and after[i] == LETTER:
            cls[i] = TWO
        elif tail in TWO_LETTERS and after[i] == LETTER and cls[i + 2] == LETTER:
            cls[i] = THREE
    rows = -(-len(cls) // ROW)
    columns = np.full(rows * ROW, END, np.uint8)
    columns[:len(cls)] = cls
    columns = np.ascontiguousarray(columns.reshape(rows, ROW).T)
    flat_next, flat_begins = FOLLOW.T.ravel(), BEGINS.T.ravel()       # at class * 9 + state
    shifted = columns.astype(np.intp) * 9
    step = np.tile(np.arange(9, dtype=np.uint8), (rows, 1))
    for column in shifted:                                           # each row's function, all rows at once
        step = flat_next[column[:, None] + step]
    gap = 1
    while gap < rows:                                                # prefix scan by composition
        step[gap:] = np.take_along_axis(step[gap:], step[:-gap].astype(np.intp), 1)
        gap *= 2
    state = np.concatenate(([np.uint8(NONE)], step[:-1, NONE]))
    marks = np.empty((ROW, rows), bool)
    for j, column in enumerate(shifted):
        at = column + state
        marks[j], state = flat_begins[at], flat_next[at]
    return np.flatnonzero(marks.T.ravel()[:len(cls)])


class BytePairs:
    """Encoder and decoder of a rank file."""

    def __init__(self, name: str):
        with open(public_tokenizers.path(name), "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        tokens = sorted((i, t) for t, i in self.ranks.items())
        self.length = np.zeros(tokens[-1][0] + 1, np.int64)
        self.length[[i for i, _ in tokens]] = [len(t) for _, t in tokens]
        self.flat = np.frombuffer(b"".join(t for _, t in tokens), np.uint8)
        self.at = np.cumsum(self.length) - self.length
        self.known: dict[bytes, tuple[bytes, bytes]] = {}

    def merge(self, word: bytes) -> list[int]:
        """Join the neighbours of least rank, leftmost first, until none can be joined."""
        if word in self.ranks:
            return [self.ranks[word]]
        rank, n = self.ranks.get, len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            r, i, end = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or after[j] != end:     # one of the two has been joined meanwhile
                continue
            alive[j], after[i] = False, end
            if end < n:
                before[end] = i
                if (r := rank(word[i:after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if i and (r := rank(word[before[i]:end])) is not None:
                heapq.heappush(heap, (r, before[i], end))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i:after[i]]])
            i = after[i]
        return out

    def _learn(self, words: set[bytes]) -> None:
        for w in words:
            ids = self.merge(w)
            self.known[w] = np.array(ids, "<u4").tobytes(), ",".join(map(str, ids)).encode()

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bytes]]:
        """Ids of each text, and the ids as decimal numbers joined by commas."""
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= STEP:
                yield from self._some(group)
                group, size = [], 0
        if group:
            yield from self._some(group)

    def _some(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bytes]]:
        joined = "\n".join([*texts, ""])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        data = joined.encode("utf-8", "surrogatepass")
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = word_starts(points, ends)
        size = 1 + (points >= 0x80).astype(np.uint8) + (points >= 0x800) + (points >= 0x10000)
        at = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))[np.append(starts, len(points))].tolist()
        words = list(map(data.__getitem__, map(slice, at, at[1:])))
        bounds = np.searchsorted(starts, ends).tolist()       # each text's filler is a word of its own
        self._learn(set(words).difference(self.known))
        found = list(map(self.known.__getitem__, words))
        first = 0
        for stop in bounds:
            own = found[first:stop]
            yield (np.frombuffer(b"".join([x[0] for x in own]), "<u4"), b",".join([x[1] for x in own]))
            first = stop + 1
        if len(self.known) > REMEMBERED:
            self.known = dict(islice(self.known.items(), REMEMBERED // 2))

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The byte of the text at which each id begins, and the number of bytes."""
        return np.concatenate(([0], np.cumsum(self.length[ids])))

    def decode(self, ids: np.ndarray, offsets: np.ndarray | None = None) -> bytes:
        """The bytes of the ids."""
        offsets = self.offsets(ids) if offsets is None else offsets
        shift = np.repeat(self.at[ids] - offsets[:-1] + offsets[0], np.diff(offsets))
        return self.flat[shift + np.arange(len(shift))].tobytes()


@functools.lru_cache(maxsize=2)
def pairs(name: str) -> BytePairs:
    """The worker's own encoder, kept between tasks."""
    return BytePairs(name)


def encode(docs: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken", id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per document: doc_id, ids, offsets (byte of the text at which each id begins)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole_text(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pairs(vocabulary)
        for b in batches:
            ids = [x for x, _ in codec.encode(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                 pa.array([codec.offsets(x)[:-1] for x in ids], pa.list_(pa.int64()))],
                names=["doc_id", "ids", "offsets"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, offsets array<long>")


def decode(encoded: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """Per row of doc_id and ids: doc_id, data (bytes). Null ids are none; an id that isn't in the
    vocabulary is an error."""
    ship(encoded.sparkSession)
    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pairs(vocabulary)
        for b in batches:
            data = [codec.decode(np.array(x, np.int64)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return rows.mapInArrow(run, f"doc_id {kind}, data binary")


def round_trip(docs: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken", id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode and decode, with digests of both: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole_text(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pairs(vocabulary)
        for b in batches:
            n, written, read = [], [], []
            for ids, decimal in codec.encode(b.column(1).to_pylist()):
                n.append(len(ids))
                written.append(hashlib.sha256(decimal).hexdigest())
                read.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(written, pa.string()), pa.array(read, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
