"""Packing of documents into sequences by patterns fitted with non-negative least squares.

Only the histogram of lengths is needed to plan (a row per length, so never more than `capacity` rows,
however many documents there are). Lengths are binned, and all patterns of up to three bins that fill a
sequence are enumerated. Repeat counts of the patterns are fitted to the histogram by non-negative least
squares and rounded down, never beyond what there is; then each pattern is filled with lengths of its bins,
its last place with the longest that fits. What is left over is packed best-fit, longest first, into the room that patterns leave and into new
sequences. Tasks then number the pieces of each length and look up their place in the plan.

Defined results: a null text is empty and has the end id only; a document longer than a sequence is cut into
pieces of full length, the last of which may be shorter; no other is cut. Repeated rows are documents of
their own. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from crownframe.llm.shared import ship, whole_text
from crownframe.llm.words import encoder
from crownframe.operators.numbering import row_index
from crownframe.session import cut

#: Bins of a sequence's length for the fit, and documents in a fitted pattern.
BINS, MOST = 64, 3

Pattern = tuple[tuple[int, int], ...]      # (length, how many), longest first


def bin_patterns(bins: int = BINS, most: int = MOST) -> np.ndarray:
    """Rows of 1 to `most` bin numbers (0: unused), in falling order, that add up to `bins`."""
    found = []

    def extend(head: list[int], room: int) -> None:
        if not room:
            found.append(head + [0] * (most - len(head)))
        elif len(head) < most:
            for b in range(min(room, head[-1] if head else room), 0, -1):
                if b * (most - len(head)) >= room:
                    extend([*head, b], room - b)

    extend([], bins)
    return np.array(found)


def non_negative_fit(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |a x - y|, by the active-set method; gains below a ten-thousandth of the largest
    count are left."""
    gram, aim = a.T @ a, a.T @ y
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    near = 1e-4 * np.abs(y).max(initial=0.0)
    for _ in range(3 * a.shape[1]):
        gain = aim - gram @ x
        gain[free] = -np.inf
        j = int(gain.argmax())
        if gain[j] <= near:
            break
        free[j] = True
        while True:
            on = np.flatnonzero(free)
            z = np.zeros_like(x)
            z[on] = np.linalg.solve(gram[np.ix_(on, on)] + 1e-9 * np.eye(len(on)), aim[on])
            low = free & (z <= 0)
            if not low.any():
                break
            ratio = x[low] / np.maximum(x[low] - z[low], 1e-300)
            x = x + min(1.0, ratio.min()) * (z - x)
            free &= x > 1e-12 * max(1.0, x.max())
            x[~free] = 0
            if not free.any():
                break
        x = z
    return x


def _take(left: np.ndarray, low: int, high: int, n: int) -> list[tuple[int, int]]:
    """n pieces of lengths low..high, longest first, as runs (length, count); `left` counts get less."""
    runs = []
    for length in low + np.flatnonzero(left[low:high + 1])[::-1]:
        k = min(n, int(left[length]))
        runs.append((int(length), k))
        left[length] -= k
        n -= k
        if not n:
            return runs
    raise ValueError("fewer pieces than asked for")


def _together(columns: list[list[tuple[int, int]]]) -> list[tuple[tuple[int, ...], int]]:
    """Runs of rows with the same lengths, for columns of equal total count."""
    marks = [np.cumsum([k for _, k in runs]) for runs in columns]
    ends = np.unique(np.concatenate(marks))
    picked = [np.array([n for n, _ in runs])[np.searchsorted(m, ends)] for runs, m in zip(columns, marks)]
    counts = np.diff(ends, prepend=0).tolist()
    return [(row, k) for row, k in zip(map(tuple, np.stack(picked, 1).tolist()), counts)]


def plan(histogram: dict[int, int], capacity: int, bins: int = BINS) -> list[tuple[Pattern, int]]:
    """Patterns of exact lengths and how often each is used; uses up the histogram exactly."""
    left = np.zeros(capacity + 1, np.int64)
    for n, c in histogram.items():
        left[n] = c
    made: Counter[Pattern] = Counter()
    if left[capacity]:
        made[((capacity, 1),)] = int(left[capacity])
        left[capacity] = 0
    width = -(-capacity // bins)
    bins = capacity // width                    # what is longer than all bins together is left to the best fit
    edges = np.arange(bins + 1) * width
    have = np.array([left[edges[b] + 1:edges[b + 1] + 1].sum() for b in range(bins)])
    shapes = bin_patterns(bins)
    a = np.stack([(shapes == b).sum(1) for b in range(1, bins + 1)]).astype(float)
    fitted = non_negative_fit(a, have.astype(float))
    for i in np.argsort(-fitted, kind="stable"):
        head = [int(b) for b in shapes[i] if b][:-1]      # the last place is filled by what fits best
        counts = Counter(head)
        stock = {b: int(left[edges[b - 1] + 1:edges[b] + 1].sum()) for b in counts}
        times = min([int(fitted[i] + 1e-9), *(stock[b] // m for b, m in counts.items())])
        if times <= 0 or not head:
            continue
        columns = [_take(left, edges[b - 1] + 1, edges[b], times) for b in head]
        for lengths, k in _together(columns):
            room = capacity - sum(lengths)
            while k:
                fits = np.flatnonzero(left[:room + 1])
                last = (int(fits[-1]),) if len(fits) else ()
                n = min(k, int(left[last[0]])) if last else k
                made[tuple(sorted(Counter((*lengths, *last)).items(), reverse=True))] += n
                if last:
                    left[last[0]] -= n
                k -= n
    return best_fit(made, {int(n): int(left[n]) for n in np.flatnonzero(left)}, capacity)


def best_fit(made: Counter[Pattern], rest: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Put the lengths that are left, longest first, where the least room stays."""
    by_room: list[list[list]] = [[] for _ in range(capacity + 1)]
    rooms = np.zeros(capacity + 1, bool)

    def put(pattern: Pattern, times: int) -> None:
        room = capacity - sum(n * m for n, m in pattern)
        by_room[room].append([pattern, times])
        rooms[room] = True

    for pattern, times in made.items():
        put(pattern, times)
    for n in sorted(rest, reverse=True):
        c = rest[n]
        while c:
            room = n + int(rooms[n:].argmax())
            if not rooms[room]:                 # no room anywhere: as many to a new sequence as fit
                each = min(c, capacity // n)
                put(((n, each),), c // each)
                c -= c // each * each
                continue
            pattern, times = by_room[room][-1]
            each = min(room // n, c)            # in a sequence, before the next one
            k = min(times, c // each)
            by_room[room][-1][1] -= k
            if not by_room[room][-1][1]:
                by_room[room].pop()
                rooms[room] = bool(by_room[room])
            grown = dict(pattern)
            grown[n] = grown.get(n, 0) + each
            put(tuple(sorted(grown.items(), reverse=True)), k)
            c -= k * each
    return [(pattern, times) for slot in by_room for pattern, times in slot if times]


def places(patterns: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length and pattern: length, first and stop of the pieces' numbers, first sequence, pieces in
    a sequence, offset of the first one."""
    rows, used, sequence = [], Counter(), 0
    for pattern, times in patterns:
        offset = 0
        for n, m in pattern:
            rows.append((n, used[n], used[n] + times * m, sequence, m, offset))
            used[n] += times * m
            offset += n * m
        sequence += times
    return rows


PIECES = [StructField("piece", IntegerType()), StructField("start", LongType()),
          StructField("length", LongType()), StructField("ids_crc32", LongType())]


def pieces(docs: DataFrame, carry: list[str], vocabulary: str = "word_bpe_49k.json", end_id: int = 1,
           capacity: int = 4096, text_col: str = "text", with_ids: bool = False,
           remembered: int | None = None) -> DataFrame:
    """The columns `carry`, and piece, start, length, ids_crc32 of each piece, and its ids if asked for."""
    ship(docs.sparkSession)
    rows = docs.select(*[F.col(f"`{c}`") for c in carry], whole_text(f"`{text_col}`").alias("__text"))
    fields = [*[rows.schema[c] for c in carry], *PIECES]
    schema = StructType(fields).add("ids", ArrayType(IntegerType())) if with_ids else StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()       # what an earlier stage left to this worker
        enc, end = encoder(vocabulary, remembered=remembered), np.array([end_id], "<u2").tobytes()
        for b in batches:
            source, piece, length, crc, ids = [], [], [], [], []
            for i, data in enumerate(enc.encode(b.column(len(carry)).to_pylist())):
                all_ids = np.frombuffer(data + end, "<u2").astype("<u4")
                for k in range(0, len(all_ids), capacity):
                    x = all_ids[k:k + capacity]
                    source.append(i)
                    piece.append(k // capacity)
                    length.append(len(x))
                    crc.append(zlib.crc32(x.tobytes()))
                    if with_ids:
                        ids.append(x.astype(np.int32))
            piece = np.array(piece, np.int32)
            arrays = [*[c.take(pa.array(source, pa.int64())) for c in b.columns[:-1]], pa.array(piece),
                      pa.array(piece.astype(np.int64) * capacity), pa.array(length, pa.int64()),
                      pa.array(crc, pa.int64())]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)


def assign(cut_pieces: DataFrame, order: list[str], capacity: int = 4096) -> DataFrame:
    """Sequence and offset for each row by its `length`; `order` numbers rows of one length."""
    spark = cut_pieces.sparkSession
    histogram = {int(n): int(c) for n, c in cut_pieces.groupBy("length").count().collect()}  # <= capacity rows
    rows = places(plan(histogram, capacity))
    table = spark.createDataFrame(
        rows, "length long, `__first` long, `__stop` long, `__seq` long, `__each` long, `__offset` long")
    numbered = row_index(cut_pieces, ["length"], [F.col(f"`{c}`") for c in order], "__nth")
    # The plan has a few rows for each pattern, and the patterns are bounded by the capacity.
    placed = numbered.join(F.broadcast(table), "length").filter("__nth >= __first and __nth < __stop")
    nth = F.col("__nth") - F.col("__first")
    return placed.select(
        *[F.col(f"`{c}`") for c in cut_pieces.columns],
        (F.col("__seq") + F.floor(nth / F.col("__each"))).cast("long").alias("sequence_id"),
        (F.col("__offset") + nth % F.col("__each") * F.col("length")).cast("long").alias("offset"))


def pack(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 1, capacity: int = 4096,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, remembered: int | None = None) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, [ids], sequence_id, offset. `remembered` bounds the words that a
    worker keeps the ids of."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    made = cut(pieces(rows, ["doc_id"], vocabulary, end_id, capacity, "text", with_ids, remembered), "pieces")
    return assign(made, ["doc_id", "piece"], capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence, from pieces packed with their ids: sequence_id, ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))     # one sequence: capacity ids at most
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))
