"""Groups of documents by exact Jaccard similarity of their shingle sets, from keys that similar sets share.

A node is a different set. Each node comes with keys; nodes that share one are candidates. A group is a connected
component of links, so a link between nodes that are connected already need not be looked for, and no candidate
pairs are written:

1. Under each key one node is the pivot, and the others are compared with it alone. Pivots have the smallest hash of
   their node, so near copies mostly have the same pivot under all their keys.
2. Where a pivot's nodes are in different components then, links between these may be left: nodes that share a key
   share its pivot too. For the nodes of such pivots, a shingle counts only if nodes of different components have it. A
   node whose counting shingles are too few for a link to another component is done; this is repeated, as others may
   then have too few. The rest meet once per pivot with their counting shingles and are compared in the task that holds
   them, which hands on only links that join components it knows. More than `GROUP` nodes of a pivot meet in blocks.

So a crowd of near copies costs a few comparisons each, and documents that share only a frequent passage
fall out by their own shingles. Candidates are compared by 16 bits of each shingle first, which count what
both have or more; those that may be similar are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownframe.llm.shared import FILE, ROW, bounded, whole_text
from crownframe.llm.simhash_trees import components, shingle_hashes
from crownframe.session import cut, release

#: Times that nodes without enough counting shingles are looked for; tasks that one set's comparisons are dealt to.
PEELS, SALT = 2, 32
#: Nodes of one block of a pivot; rows and columns of the matrices they are compared by.
GROUP, ROWS, COLUMNS = 4096, 256, 4096
#: Rows and bytes handed on at a time.
STEP, STEP_BYTES = 1 << 16, 1 << 24


class Rule(NamedTuple):
    """Sets of shingles of `words` words are linked at a Jaccard similarity of `percent` hundredths."""
    words: int
    percent: int

    def similar(self, shared, n, m):
        """Whether sets of n and m shingles, `shared` of them in both, are linked."""
        return (100 + self.percent) * shared >= self.percent * (n + m)


def shingle_set(text: str, words: int) -> np.ndarray:
    """The different shingles in ascending order."""
    return np.unique(shingle_hashes(text, words)).view(np.int64)


def node_of(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), 42)).view(np.int64))


def shortened(shingles: np.ndarray) -> np.ndarray:
    """The upper 16 bits of each shingle; those of both sets are as many as their shared shingles at least."""
    return (shingles.view(np.uint64) >> np.uint64(48)).astype(np.uint16)


def numbered(short: np.ndarray) -> np.ndarray:
    """Different numbers for ascending ones that repeat: the n-th of a kind always gets the same."""
    at = np.arange(len(short))
    new = np.concatenate(([True], short[1:] != short[:-1]))[:len(short)]
    return short + ((at - np.maximum.accumulate(np.where(new, at, 0))) << 16)


def _texts(docs: DataFrame, places: DataFrame, text_col: str) -> DataFrame:
    """The text of one document of each node in `places`."""
    there = docs.join(bounded(places.select(FILE, ROW), 200), [FILE, ROW], "left_semi")
    return there.select(whole_text(f"`{text_col}`").alias("t"))


def _sets(texts: DataFrame, rule: Rule, short: bool) -> DataFrame:
    """node, s: the shingles, shortened or whole, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(nodes: list[int], sets: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())],
                                              names=["node", "s"])
        for b in batches:
            nodes, sets, held = [], [], 0
            for t in b.column(0).to_pylist():
                s = shingle_set(t, rule.words)
                nodes.append(node_of(s))
                sets.append((shortened(s) if short else s).tobytes())
                held += len(sets[-1])
                if held >= STEP_BYTES:
                    yield batch(nodes, sets)
                    nodes, sets, held = [], [], 0
            yield batch(nodes, sets)

    return texts.mapInArrow(run, "node long, s binary")


def _rows(texts: DataFrame, rule: Rule) -> DataFrame:
    """node, x: a row for each shingle of a set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(0).to_pylist():
                s = shingle_set(t, rule.words)
                node = node_of(s)
                for i in range(0, len(s), STEP):
                    part = s[i:i + STEP]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), node)), pa.array(part)], names=["node", "x"])

    return texts.mapInArrow(run, "node long, x long")


def compared(pairs: DataFrame, sets: DataFrame, rule: Rule, short: bool) -> DataFrame:
    """The pairs (a, b) whose sets are linked, or may be if they are shortened."""
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALT)))
    right = dealt.join(sets.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "s")
    left = dealt.select("a", "salt").distinct().join(sets.withColumnRenamed("node", "a"), "a").select(
        "a", "salt", F.lit(None).cast("long").alias("b"), "s")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = None
        for batch in batches:
            found = []
            for p, q, s in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                s = np.frombuffer(s.as_buffer(), np.uint16 if short else np.int64)
                s = numbered(s) if short else s
                if q is None:
                    one = s.copy()
                elif rule.similar(len(np.intersect1d(one, s, assume_unique=True)), len(one), len(s)):
                    found.append((p, q))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)],
                                             names=["a", "b"])

    meet = left.unionByName(right).repartition("a", "salt").sortWithinPartitions(
        "a", "salt", F.col("b").asc_nulls_first())
    return meet.mapInArrow(run, "a long, b long")


def linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, text_col: str, rule: Rule) -> DataFrame:
    """The pairs (u, v) whose whole sets are linked."""
    def sets_of(some: DataFrame, short: bool) -> DataFrame:
        ends = some.select(F.col("a").alias("node")).unionByName(some.select(F.col("b").alias("node"))).distinct()
        places = cut(nodes.join(ends, "node", "left_semi").select(FILE, ROW), "places")
        sets = cut(_sets(_texts(docs, places, text_col), rule, short), "sets")
        release(places)
        return sets

    short = sets_of(pairs, True)
    likely = cut(compared(pairs, short, rule, True), "likely")
    whole = sets_of(likely, False)
    links = cut(compared(likely, whole, rule, False).select(F.col("b").alias("u"), F.col("a").alias("v")), "links")
    release(short, likely, whole)
    return links


def _rooted(rows: DataFrame, star: DataFrame) -> DataFrame:
    return rows.join(star.withColumnRenamed("u", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))


def by_pivots(nodes: DataFrame) -> DataFrame:
    """(key, node, n, pivot, pivot_n, size) for the keys that several nodes have."""
    keyed = nodes.select(F.explode("keys").alias("key"), "node", "n")
    order = F.struct(F.xxhash64("node").alias("o"), F.col("node").alias("pivot"), F.col("n").alias("pivot_n"))
    heads = keyed.groupBy("key").agg(F.min(order).alias("p"), F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    heads = cut(heads.select("key", "p.pivot", "p.pivot_n", "size"), "pivots")
    return keyed.join(bounded(heads, 40), "key")


class Listed(NamedTuple):
    """Nodes of one pivot, in two blocks or one; `sets` and `ends` hold their counting shingles in a row, `most` is their number."""
    block: np.ndarray
    node: np.ndarray
    n: np.ndarray
    most: np.ndarray
    root: np.ndarray
    sets: np.ndarray
    ends: np.ndarray


def links_of(g: Listed, rule: Rule) -> Iterator[tuple[int, int]]:
    """Links that join all components that may be joined: of nodes in the largest component and of the others, and of
    these with each other. Shared shingles are counted by products of matrices with a row per node and a column per shingle."""
    label = np.unique(g.root, return_inverse=True)[1]
    strays = np.flatnonzero(label != np.bincount(label).argmax())
    two = g.block.min() != g.block.max()
    lengths = np.diff(g.ends, prepend=0)
    column = np.unique(g.sets, return_inverse=True)[1]
    row = np.repeat(np.arange(len(g.node)), lengths)
    often = np.bincount(column) > 1
    number = np.cumsum(often) - 1
    keep = often[column]
    row, column = row[keep], number[column[keep]]
    for k in range(0, len(strays), ROWS):
        i = strays[k:k + ROWS, None]
        may = (label[i] != label) & rule.similar(np.minimum(g.most[i], g.most), g.n[i], g.n)
        if two:
            may &= g.block[i] != g.block
        j = np.flatnonzero(may.any(0))
        if not len(j):
            continue
        shared = np.zeros((len(i), len(j)), np.float32)
        place = [np.full(len(g.node), -1), np.full(len(g.node), -1)]
        place[0][i[:, 0]], place[1][j] = np.arange(len(i)), np.arange(len(j))
        for c in range(0, int(often.sum()), COLUMNS):
            part = (column >= c) & (column < c + COLUMNS)
            sides = []
            for at, size in zip(place, (len(i), len(j))):
                mine = part & (at[row] >= 0)
                m = np.zeros((size, COLUMNS), np.float32)
                m[at[row[mine]], column[mine] - c] = 1
                sides.append(m)
            shared += sides[0] @ sides[1].T
        hit = may[:, j] & rule.similar(shared.astype(np.int64), g.n[i], g.n[j])
        for a, b in zip(*np.nonzero(hit)):
            a, b = i[a, 0], j[b]
            if label[a] != label[b]:
                label[label == label[a]] = label[b]
                yield int(g.node[a]), int(g.node[b])


def settled(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """From (x, low, high, block, node, n, most, root, s), rows of one (x, low, high) together: their links (u, v)."""
    def links(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        s = whole.column("s")
        g = Listed(*(np.asarray(whole.column(c)) for c in ("block", "node", "n", "most", "root")),
                   np.asarray(s.flatten()), np.cumsum(np.asarray(s.value_lengths())))
        found = list(links_of(g, rule))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["u", "v"])

    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        keys = np.stack([np.asarray(b.column(c)) for c in ("x", "low", "high")], 1)
        starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), b.num_rows]
        for a, z in zip(starts[:-1], starts[1:]):
            part = b.slice(a, z - a)
            if held and any(held[0].column(c)[0] != part.column(c)[0] for c in ("x", "low", "high")):
                if sum(p.num_rows for p in held) > 1:
                    yield from links(held)
                held = []
            held.append(part)
    if sum(p.num_rows for p in held) > 1:
        yield from links(held)


def left_over(members: DataFrame, star: DataFrame, nodes: DataFrame, docs: DataFrame, text_col: str,
              rule: Rule) -> DataFrame | None:
    """Links (u, v) that join the components of nodes with one pivot; None if no pivot has several."""
    both = members.select("pivot", "node", "n").unionByName(members.select("pivot", F.col("pivot").alias("node"), F.col("pivot_n").alias("n")))
    known = _rooted(both.distinct(), star)
    mixed = known.groupBy("pivot").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("size")).filter(
        "lo != hi and size > 2").select("pivot")
    known = cut(known.join(mixed, "pivot", "left_semi"), "mixed")
    crowd = cut(known.select("node", "n", "root").distinct(), "crowd")
    if crowd.isEmpty():
        return None
    places = nodes.join(crowd, "node", "left_semi").select(FILE, ROW)
    rows = cut(_rows(_texts(docs, places, text_col), rule).join(bounded(crowd, 40), "node"), "crowd-shingles")
    for _ in range(PEELS):
        often = rows.groupBy("x").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("x")
        counting = cut(rows.select("node", "n", "root", "x").join(often, "x"), "counting")
        enough = counting.groupBy("node").agg(F.count(F.lit(1)).alias("k"), F.first("n").alias("n")).filter(
            100 * F.col("k") >= rule.percent * F.col("n")).select("node")
        less = cut(counting.join(bounded(enough, 16), "node", "left_semi"), "crowd-shingles")
        release(rows, counting)
        rows = less
    sets = rows.groupBy("node").agg(F.first("n").cast("long").alias("n"), F.first("root").alias("root"), F.collect_list("x").alias("s"))
    sets = cut(sets.withColumn("most", F.size("s").cast("long")), "counting-sets")
    listed = cut(known.select("pivot", "node").join(sets.select("node", "root"), "node"), "listed")
    blocks = listed.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / F.lit(GROUP)).alias("blocks"), F.min("root").alias("lo"),
                                         F.max("root").alias("hi")).filter("lo != hi").select("pivot", "blocks")
    mine, other = F.pmod(F.xxhash64("node"), F.col("blocks")), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = listed.join(blocks, "pivot").select("pivot", "node", mine.alias("block"), other.alias("other"))
    met = dealt.join(sets, "node").select(
        F.col("pivot").alias("x"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block",
        "node", "n", "most", "root", "s").repartition("x", "low", "high").sortWithinPartitions("x", "low", "high")
    out = cut(met.mapInArrow(lambda b: settled(b, rule), "u long, v long").distinct(), "left-over")
    release(known, crowd, rows, sets, listed)
    return out


def grouped(docs: DataFrame, nodes: DataFrame, text_col: str, rule: Rule, also: DataFrame | None = None) -> DataFrame:
    """(node, root) for each node; `root` stands for its component.

    `docs` is located; `nodes` has a row per different set: node, n, keys, and the place of a document that has it.
    `also` holds more pairs (a, b) to compare in the first step.
    """
    members = cut(by_pivots(nodes), "members")
    fits = (100 * F.least("n", "pivot_n") >= rule.percent * F.greatest("n", "pivot_n")) & (F.col("node") != F.col("pivot"))
    pairs = members.filter(fits).select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    pairs = cut((pairs if also is None else pairs.unionByName(also)).distinct(), "pairs")
    links = linked(pairs, nodes, docs, text_col, rule)
    star = components(links)
    other = left_over(members, star, nodes, docs, text_col, rule)
    if other is not None and not other.isEmpty():
        star = components(links.unionByName(other))
    release(members, pairs)
    return _rooted(nodes.select("node"), star).select("node", "root")
