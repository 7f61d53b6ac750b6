"""SimHash near-duplicates by BK-trees.

A fingerprint has 64 bits; bit i is set if it is set in over half of the XXH64 values (seed 42) of the
document's word shingles. Two documents are linked if their fingerprints differ in at most `radius` bits,
and a group is a connected component of links.

A tree of all fingerprints would have to pass through the driver to be broadcast and grows with the
corpus, so each shard's tree is built in the task that searches it. A shard holds the fingerprints that
agree on one of three parts of the bits: two fingerprints at 2 bits or less agree on one part at least,
so no link is lost. A shard with more than `shard_size` fingerprints is cut again by the bits that are
still free, as often as needed; with `r` free bits a shard has 2**r different fingerprints at most, so
this ends. In a tree the children of a node are keyed by their distance to it, and a search follows only
the edges whose key lies within the radius of its own distance.

Only different fingerprints are compared; copies meet in one row first. A shard hands on a spanning star of
its linked fingerprints, never the pairs, and stars are joined into components in rounds.

Defined results: null or wordless text has fingerprint zero, linked like any other; fewer words than a
shingle make one shingle of them all; a component's id is its smallest non-null doc_id, null if it has
none; repeated rows are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from crownframe.llm.shared import FILE, ROW, located, ship, whole_text, without
from crownframe.session import cut

BITS = 64
#: A document's shingles are counted in steps of this many.
STEP = 1 << 16


def shingle_hashes(text: str, words_per_shingle: int) -> np.ndarray:
    """The hashes of a text's word shingles, in order."""
    words = text.encode("utf-8", "surrogatepass").lower().split()   # bytes: A-Z and ASCII spaces only
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words_per_shingle, len(words))
    first, last = starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    return np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, map(slice, first, last)),
                           repeat(42)), np.uint64, len(first))


def fingerprint(text: str, words_per_shingle: int = 3) -> int:
    """The 64 bits of a text as a signed number."""
    return fingerprint_of(shingle_hashes(text, words_per_shingle))


def fingerprint_of(hashes: np.ndarray) -> int:
    """The same of the shingles' hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), STEP):
        part = hashes[i:i + STEP].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, carry: Sequence[str], text_col: str = "text",
                 words_per_shingle: int = 3) -> DataFrame:
    """The columns `carry` and `fp`."""
    ship(docs.sparkSession)
    rows = docs.select(*[F.col(f"`{c}`") for c in carry], whole_text(text_col).alias("__text"))
    schema = StructType([*[rows.schema[c] for c in carry], StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, words_per_shingle) for t in b.column(len(carry)).to_pylist()),
                             np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp)], names=[*carry, "fp"])

    return rows.mapInArrow(run, schema)


class Forest:
    """One BK-tree per group of different fingerprints; rows are sorted by group."""

    def __init__(self, fp: np.ndarray, group: np.ndarray):
        self.fp = fp = fp.view(np.uint64)          # bits of signed numbers would be counted without the sign
        new = np.concatenate(([True], group[1:] != group[:-1]))
        self.root = np.maximum.accumulate(np.where(new, np.arange(len(fp)), 0))
        codes, nodes = [], []
        waiting = np.flatnonzero(~new)
        at = self.root[waiting]
        while len(waiting):                       # one level of all trees at a time
            code = at * (BITS + 1) + np.bitwise_count(fp[waiting] ^ fp[at]).astype(np.int64)
            found, first, which = np.unique(code, return_index=True, return_inverse=True)
            child = waiting[first]
            codes.append(found)
            nodes.append(child)
            at, keep = child[which], np.ones(len(waiting), bool)
            keep[first] = False
            waiting, at = waiting[keep], at[keep]
        self.code = np.concatenate(codes) if codes else np.empty(0, np.int64)
        order = np.argsort(self.code)
        self.code = self.code[order]
        self.node = np.concatenate(nodes)[order] if nodes else np.empty(0, np.int64)

    def links(self, radius: int, step: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (a, b) of rows of a group within the radius, a > b."""
        for i in range(0, len(self.fp), step):
            q = np.arange(i, min(i + step, len(self.fp)))
            node = self.root[q]
            while len(q):
                d = np.bitwise_count(self.fp[q] ^ self.fp[node]).astype(np.int64)
                hit = (d <= radius) & (q > node)
                if hit.any():
                    yield q[hit], node[hit]
                low = np.searchsorted(self.code, node * (BITS + 1) + np.maximum(d - radius, 0))
                high = np.searchsorted(self.code, node * (BITS + 1) + np.minimum(d + radius, BITS), "right")
                n = high - low
                q = np.repeat(q, n)
                skip = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n)
                node = self.node[skip + np.arange(len(q))] if len(q) else node[:0]


def stars(fp: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest row's fingerprint of its component) for all that are linked in a group."""
    size = np.bincount(np.unique(group, return_inverse=True)[1]) if len(group) else np.empty(0, int)
    alone = np.repeat(size == 1, size)
    fp, group = fp[~alone], group[~alone]
    if not len(fp):
        return fp, fp
    label = np.arange(len(fp))                   # each row's root, after every step
    for a, b in Forest(fp, group).links(radius):
        while (label[a] != label[b]).any():
            low = np.minimum(label[a], label[b])
            for root in (label[a], label[b]):
                np.minimum.at(label, root, low)
            while (label != label[label]).any():
                label = label[label]
    moved = label != np.arange(len(fp))
    return fp[moved], fp[label[moved]]


def _parts(free: int, n: int) -> list[int]:
    """The set bits of `free` dealt into n masks of neighbouring bits."""
    bits = [i for i in range(BITS) if free >> i & 1]
    return [sum(1 << i for i in bits[len(bits) * k // n:len(bits) * (k + 1) // n]) for k in range(n)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def sharded(nodes: DataFrame, radius: int, shard_size: int) -> DataFrame:
    """Rows (mask, part, fp): `part` are the bits of `fp` under the mask. Fingerprints within the radius
    share a shard; none has more than `shard_size` (a power of two)."""
    full, out, rows = (1 << BITS) - 1, None, None
    masks = [0]
    while True:
        children = {m: [m | p for p in _parts(full & ~m, radius + 1)] for m in masks}
        if rows is None:
            deeper = F.array(*[F.lit(_signed(c)) for c in children[0]])
            rows = nodes.select(F.explode(deeper).alias("mask"), "fp")
        else:
            deeper = F.create_map(*[x for m, cs in children.items() for x in (
                F.lit(_signed(m)), F.array(*[F.lit(_signed(c)) for c in cs]))])
            rows = rows.select(F.explode(deeper[F.col("mask")]).alias("mask"), "fp")
        rows = rows.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("part"), "fp")
        masks = sorted({c for cs in children.values() for c in cs})
        if min(m.bit_count() for m in masks) >= BITS - (shard_size.bit_length() - 1):
            return rows if out is None else out.unionByName(rows)
        hot = cut(rows.groupBy("mask", "part").agg(F.count(F.lit(1)).alias("n"))
                  .filter(F.col("n") > shard_size).select("mask", "part"), "hot-shards")
        if hot.isEmpty():
            return rows if out is None else out.unionByName(rows)
        cool = rows.join(hot, ["mask", "part"], "left_anti")
        out = cool if out is None else out.unionByName(cool)
        rows = cut(rows.join(hot, ["mask", "part"], "left_semi"), "deeper")


def shard_links(shards: DataFrame, radius: int) -> DataFrame:
    """Edges (u, v) of spanning stars over each shard's links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((0, 3), np.int64)
        for b in batches:
            rows = np.concatenate([rest, np.stack([np.asarray(c) for c in b.columns], 1)])
            if not len(rows):
                continue
            last = (rows[:, :2] == rows[-1, :2]).all(1)       # the last shard may go on
            done, rest = rows[~last], rows[last]
            yield edges(done)
        yield edges(rest)

    def edges(rows: np.ndarray) -> pa.RecordBatch:
        new = np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(1)))[:len(rows)]
        u, v = stars(rows[:, 2], np.cumsum(new), radius)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    near = shards.repartition("mask", "part").sortWithinPartitions("mask", "part", "fp")
    return near.select("mask", "part", "fp").mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for all nodes of the edges but the roots, which are the smallest of their component.

    Alternates two steps: tie all larger neighbours of a node to its smallest neighbour, then tie the
    node's smaller neighbours to it. Ends when nothing changes.
    """
    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first())

    now = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
              .filter("u != v").distinct(), "edges")
    before, after = None, state(now)
    while before != after and after[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").filter("v > u and v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = cut(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        now = cut(small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        before, after = after, state(now)
    return now.select("u", F.col("v").alias("root"))


def grouped(prints: DataFrame, radius: int = 2, shard_size: int = 512) -> DataFrame:
    """(fp, root) for each different fingerprint; `root` stands for its component."""
    ship(prints.sparkSession)
    nodes = cut(prints.select("fp").distinct(), "fingerprints")
    star = components(shard_links(sharded(nodes, radius, shard_size), radius))
    linked = star.withColumnRenamed("u", "fp")
    return nodes.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_dups(docs: DataFrame, radius: int = 2, words_per_shingle: int = 3, shard_size: int = 512,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id."""
    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    prints = cut(fingerprints(ids, ["doc_id"], "text", words_per_shingle), "prints")
    roots = cut(grouped(prints, radius, shard_size), "roots")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp")
    of_root = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(of_root, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(at: DataFrame, prints: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of the located table `at` that come first in their component, of (__id, place, fp) and (fp, root)."""
    place = F.struct(F.col("__id").isNull().alias("n"), F.col("__id").alias("i"),
                     F.col(FILE).alias("f"), F.col(ROW).alias("r"))
    first = prints.groupBy("fp").agg(F.min(place).alias("first")).join(roots, "fp")
    chosen = first.groupBy("root").agg(F.min("first").alias("first"))
    stays = roots.join(chosen, "root").select("fp", "first")
    gone = prints.join(stays, "fp").filter((F.col("first.f") != F.col(FILE)) | (F.col("first.r") != F.col(ROW)))
    return without(at, gone)


def keep_one(docs: DataFrame, radius: int = 2, words_per_shingle: int = 3, shard_size: int = 512,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one row of each component: that of the smallest doc_id (nulls last), then of
    the first file and position."""
    at = located(docs)
    prints = cut(fingerprints(at.select(F.col(f"`{id_col}`").alias("__id"), FILE, ROW,
                                        F.col(f"`{text_col}`").alias("text")),
                              ["__id", FILE, ROW], "text", words_per_shingle), "prints")
    roots = cut(grouped(prints.select("fp"), radius, shard_size), "roots")
    return one_of_each(at, prints, roots)
