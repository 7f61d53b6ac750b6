"""Fill-in-the-middle: documents cut at two token boundaries and written in another order.

A text's token boundaries are kept in a set of byte offsets built like a Roaring bitmap: offsets are dealt to
containers by their upper bits, each container is an array, a bitmap or a list of runs, whichever is smallest, and
a running sum of the containers' sizes stands beside them. The k-th boundary is found by a search in that sum and a
select within one container, so both cuts of a document take two look-ups. `with_boundaries` returns the sets, with
which `cut_again` draws new cuts without splitting the texts again.

Tokens are a run of other characters with the ASCII spaces before it, or the spaces at the end of the text. The
numbers that choose cuts and form come from a hash of seed and doc_id, so they don't depend on order or partitions.

Defined results: null text counts as empty, and empty text is plain; a null doc_id hashes as the empty text;
repeated rows give repeated results; text that holds a marker is plain, so `restore` is exact; other columns of the
input play no part, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from crownframe.llm.shared import ship, whole_text

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ARRAY, BITMAP, RUNS = 0, 1, 2
#: Offsets a container spans; bytes of output handed on at a time.
SPAN, STEP_BYTES = 1 << 16, 8 << 20


class BoundarySet:
    """An ordered set of non-negative numbers that finds its k-th member."""

    def __init__(self, high: np.ndarray, counts: np.ndarray, containers: list[tuple[int, np.ndarray]]):
        self.high, self.containers = high, containers
        self.before = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))

    @classmethod
    def of(cls, members: np.ndarray) -> BoundarySet:
        """From different numbers in ascending order."""
        high, first = np.unique(members // SPAN, return_index=True)
        ends = np.append(first[1:], len(members))
        parts = [_container((members[a:b] % SPAN).astype(np.uint16)) for a, b in zip(first, ends)]
        return cls(high, ends - first, parts)

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The member that k others precede."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        i = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.high[i]) * SPAN + _select(*self.containers[i], k - int(self.before[i]))

    def to_bytes(self) -> bytes:
        head = [len(self.high)]
        for high, n, (kind, data) in zip(self.high, np.diff(self.before), self.containers):
            head += [int(high), int(n), kind, data.nbytes]
        return np.array(head, "<u4").tobytes() + b"".join(data.tobytes() for _, data in self.containers)

    @classmethod
    def from_bytes(cls, data: bytes) -> BoundarySet:
        n = int(np.frombuffer(data, "<u4", 1)[0])
        head = np.frombuffer(data, "<u4", 4 * n, 4).reshape(n, 4).astype(np.int64)
        at, parts = 4 + 16 * n, []
        for kind, size in head[:, 2:].tolist():
            parts.append((kind, np.frombuffer(data, "<u8" if kind == BITMAP else "<u2", size // (8 if kind == BITMAP else 2), at)))
            at += size
        return cls(head[:, 0], head[:, 1], parts)


def _container(low: np.ndarray) -> tuple[int, np.ndarray]:
    """The smallest container of ascending 16-bit numbers; a run is its first number and its length less one."""
    starts = np.flatnonzero(np.concatenate(([True], np.diff(low) != 1)))
    sizes = {ARRAY: 2 * len(low), BITMAP: SPAN // 8, RUNS: 4 * len(starts)}
    kind = min(sizes, key=sizes.get)
    if kind == ARRAY:
        return kind, low
    if kind == RUNS:
        more = np.diff(np.append(starts, len(low))) - 1
        return kind, np.stack([low[starts], more.astype(np.uint16)], 1).ravel()
    bits = np.zeros(SPAN, np.uint8)
    bits[low] = 1
    return kind, np.packbits(bits, bitorder="little").view(np.uint64)


def _select(kind: int, data: np.ndarray, k: int) -> int:
    if kind == ARRAY:
        return int(data[k])
    sizes = np.bitwise_count(data) if kind == BITMAP else data[1::2].astype(np.int64) + 1
    ends = np.cumsum(sizes, dtype=np.int64)
    i = int(np.searchsorted(ends, k, "right"))
    k -= int(ends[i]) - int(sizes[i])
    if kind == RUNS:
        return int(data[2 * i]) + k
    word = np.unpackbits(data[i:i + 1].view(np.uint8), bitorder="little")
    return 64 * i + int(np.flatnonzero(word)[k])


def token_ends(text: bytes) -> np.ndarray:
    """The offset behind each token of a text in UTF-8, ascending."""
    b = np.frombuffer(text, np.uint8)
    if not len(b):
        return np.empty(0, np.int64)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    last = ~space
    last[:-1] &= space[1:]
    last[-1] = True                                    # spaces at the end are a token
    return np.flatnonzero(last) + 1


def characters(part: bytes) -> int:
    """The code points of UTF-8."""
    b = np.frombuffer(part, np.uint8)
    return len(b) - int(np.count_nonzero((b & 0xC0) == 0x80))


def ordered(text: bytes, form: str, first: int, second: int) -> bytes:
    """The text with markers, cut at the two offsets."""
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if form == "psm":
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    if form == "spm":
        return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return text


def _drawn(id_col: str, seed: int, rate: int, spm_rate: int) -> list[Column]:
    """Two numbers for the cuts and the form for texts that may be cut, from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    form = F.when(h[2] % 100 >= rate, "plain").when(h[3] % 100 < spm_rate, "spm").otherwise("psm")
    return [h[0].alias("__h1"), h[1].alias("__h2"), form.alias("__form")]


def _result(id_field: StructField) -> StructType:
    return StructType([
        id_field, StructField("n", LongType()), StructField("form", StringType()),
        StructField("first_cut", LongType()), StructField("second_cut", LongType()),
        StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
        StructField("output", StringType()), StructField("boundaries", BinaryType())])


def _cut(rows: DataFrame, id_field: StructField, with_boundaries: bool) -> DataFrame:
    """From (id, h1, h2, form, text, known boundaries) the result; text and output are worked on as bytes."""
    schema = _result(id_field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, start, held = [], 0, 0
            texts, known = b.column(4), b.column(5)
            h1, h2, forms = (b.column(i).to_pylist() for i in (1, 2, 3))
            for i in range(b.num_rows):
                text = texts[i].as_py()
                ends = BoundarySet.from_bytes(known[i].as_py()) if known[i].is_valid else BoundarySet.of(token_ends(text))
                n, form = len(ends), forms[i]
                if not n or form == "plain" or PREFIX in text or SUFFIX in text or MIDDLE in text:
                    row = (n, "plain", None, None, None, None, text)
                else:
                    a, z = sorted((h1[i] % (n + 1), h2[i] % (n + 1)))
                    first, second = (ends.select(k - 1) if k else 0 for k in (a, z))
                    row = (n, form, first, second, characters(text[:first]), characters(text[first:second]),
                           ordered(text, form, first, second))
                out.append((*row, ends.to_bytes() if with_boundaries else None))
                held += len(text) + len(out[-1][-1] or b"")
                if held >= STEP_BYTES or i == b.num_rows - 1:
                    yield batch(b.column(0).slice(start, len(out)), out)
                    out, start, held = [], i + 1, 0

    def batch(ids: pa.Array, out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)]
        columns[6] = columns[6].cast(pa.string())
        return pa.RecordBatch.from_arrays([ids, *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50,
              spm_rate: int = 80, with_boundaries: bool = False) -> DataFrame:
    """Per document: doc_id, n (tokens), form (plain, psm or spm), both cuts in bytes, prefix_chars, middle_chars,
    output and, if asked for, boundaries. `rate` of 100 documents are cut, `spm_rate` of 100 of those suffix first."""
    ship(docs.sparkSession)
    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole_text(f"`{text_col}`").alias("__text"))
    rows = ids.select("doc_id", *_drawn("doc_id", seed, rate, spm_rate), F.col("__text").cast("binary").alias("__bytes"),
                      F.lit(None).cast("binary").alias("__known"))
    out = _cut(rows, ids.schema["doc_id"], with_boundaries)
    return out if with_boundaries else out.drop("boundaries")


def cut_again(done: DataFrame, seed: int, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """The result of another seed from a `transform` with boundaries; texts come back from their outputs."""
    ship(done.sparkSession)
    texts = restore(done)
    rows = texts.select("doc_id", *_drawn("doc_id", seed, rate, spm_rate),
                        F.col("restored").cast("binary").alias("__bytes"), F.col("boundaries").alias("__known"))
    return _cut(rows, done.schema["doc_id"], True)


def restore(done: DataFrame) -> DataFrame:
    """`done` with the text rebuilt from `output` and `form`, as `restored`."""
    marks = "|".join(re.escape(m.decode()) for m in (PREFIX, SUFFIX, MIDDLE))
    part = F.split("output", marks, -1)       # of a cut text: nothing, then three parts in the order of its form
    return done.withColumn("restored", F.when(F.col("form") == "psm", F.concat(part[1], part[3], part[2]))
                           .when(F.col("form") == "spm", F.concat(part[2], part[3], part[1]))
                           .otherwise(F.col("output")))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of output and restored text."""
    both = restore(transform(docs))
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))
