"""Exact top-k by inner product with M-trees.

Vectors are made whole numbers, floor(scale * x). An extra coordinate sqrt(M^2 - |x|^2), where M is the
longest vector's length in the shard, turns the largest inner product into the smallest distance, which is a
metric. Rows are dealt to shards of bounded size by a hash; each shard's vectors are bulk-loaded into an M-tree
of pages of at most `PAGE` entries. An entry has its distance to the centre of its page, and on inner pages
the radius that covers all below it. Queries come in blocks to every shard (they are a stated set, a hundredth
of the rows) and are answered best-first: pages are taken in the order of the least distance they can hold, and
by the stored distances the triangle inequality rules entries out before their distance is computed. A shard
hands on k rows per query, and the best k of all shards remain.

Bounds are floats with a margin; scores are exact, and an entry is only ruled out if it can't even tie.

Defined results: null vectors and vectors with a null, NaN or infinite component take no part; shorter
vectors count as ending in zeros; numbers so large that a score might not fit in 64 bits are an error; equal scores go to the smaller
vec_id, null last; a query never meets rows of its own vec_id; rows that repeat a vec_id are candidates, and
queries, of their own. Without rows there is no result. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crownframe.llm.shared import FILE, ROW, located, ship
from crownframe.session import cut

#: Entries of a page, vectors of a shard (about), queries of a block.
PAGE, SHARD, BLOCK = 64, 8192, 256
PAGES = "shard int, kind int, seq long, leaf boolean, most double, ids binary, keys binary, vectors binary, " \
        "apart binary, radii binary, children binary"


def whole_numbers(vectors: DataFrame, scale: int = 1024, id_col: str = "vec_id",
                  vector_col: str = "embedding") -> DataFrame:
    """vec_id, key (of the row), v: array of longs; only rows that take part."""
    rows = located(vectors)
    v = F.col(f"`{vector_col}`").cast("array<double>")
    good = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    held = F.transform(v, lambda x: F.floor(x * scale))
    return rows.filter(good).select(F.col(f"`{id_col}`").alias("vec_id"),
                                    F.xxhash64(FILE, ROW).alias("key"), held.alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Rows of arrays as a matrix, short ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), dims), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, at] = np.asarray(column.flatten())
    return out


class Metric:
    """Vectors of a shard with the coordinate that makes inner products distances."""

    def __init__(self, v: np.ndarray):
        self.v, self.x = v, v.astype(float)
        squares = (self.x ** 2).sum(1)
        self.most = float(squares.max(initial=0.0))
        self.extra = np.sqrt(np.maximum(self.most - squares, 0))

    def between(self, some: np.ndarray, one: int) -> np.ndarray:
        return np.sqrt(((self.x[some] - self.x[one]) ** 2).sum(1) + (self.extra[some] - self.extra[one]) ** 2)


def _bulk_load(metric: Metric, ids: np.ndarray, keys: np.ndarray, none: np.ndarray) -> list[dict]:
    """Pages of the tree; page 0 is the root. `children` of an inner page are page numbers."""
    pages: list[dict] = []
    rng = np.random.default_rng(len(ids))

    def page(rows: np.ndarray, centre: int) -> int:
        number = len(pages)
        pages.append({})
        if len(rows) <= PAGE:
            pages[number] = {"leaf": True, "rows": rows, "apart": metric.between(rows, centre),
                             "radii": np.empty(0), "children": np.empty(0, np.int64)}
            return number
        k = min(PAGE, -(-len(rows) // PAGE))
        pivots = rows[np.sort(rng.choice(len(rows), k, replace=False))]
        near = np.argmin(np.stack([metric.between(rows, p) for p in pivots]), 0)
        if len(np.unique(near)) == 1:             # equal vectors: any split will do
            near = np.arange(len(rows)) * k // len(rows)
        own, radii, children = [], [], []
        for j in np.unique(near):
            below, pivot = rows[near == j], pivots[j]
            own.append(pivot)
            radii.append(metric.between(below, pivot).max())
            children.append(page(below, pivot))
        own = np.array(own)
        pages[number] = {"leaf": False, "rows": own, "apart": metric.between(own, centre),
                         "radii": np.array(radii), "children": np.array(children)}
        return number

    if len(ids):
        page(np.arange(len(ids)), 0)
    return [{"seq": i, "leaf": p["leaf"], "most": metric.most, "ids": ids[p["rows"]].tobytes(),
             "keys": none[p["rows"]].astype(np.int64).tobytes(), "vectors": metric.v[p["rows"]].tobytes(),
             "apart": p["apart"].tobytes(), "radii": p["radii"].tobytes(),
             "children": p["children"].tobytes()} for i, p in enumerate(pages)]


def _ids(column) -> tuple[np.ndarray, np.ndarray]:
    """Ids with null as the largest number, and which are null."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    none = np.asarray(array.is_null())
    return np.asarray(array.fill_null(np.iinfo(np.int64).max)).astype(np.int64), none


def _tree(dims: int):
    def run(shard: pa.Table) -> pa.Table:
        ids, none = _ids(shard["vec_id"])
        pages = _bulk_load(Metric(_matrix(shard["v"], dims)), ids, np.asarray(shard["key"]), none)
        number = shard["shard"][0].as_py()
        return pa.Table.from_pylist([{"shard": number, "kind": 0, **p} for p in pages], _schema())
    return run


def _schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(),
             "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in PAGES.split(", "))])


class Tree:
    """A shard's pages, opened for queries."""

    def __init__(self, dims: int):
        self.dims, self.pages, self.most = dims, {}, 0.0

    def add(self, p: dict) -> None:
        v = np.frombuffer(p["vectors"], np.int64).reshape(-1, self.dims)
        self.most = p["most"]
        self.pages[p["seq"]] = (
            p["leaf"], np.frombuffer(p["ids"], np.int64), np.frombuffer(p["keys"], np.int64).astype(bool), v,
            v.astype(float), np.frombuffer(p["apart"]), np.frombuffer(p["radii"]),
            np.frombuffer(p["children"], np.int64))

    def search(self, query: np.ndarray, own_id: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores, ids and whether they are null, of the k best."""
        q = query.astype(float)
        reach = float(q @ q) + self.most
        margin = 1e-7 * np.sqrt(reach) + 1e-6
        exact = float(np.abs(q).sum()) * np.sqrt(self.most) < 2.0 ** 52
        score, ids, none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        worst = np.inf
        if not self.pages:
            return score, ids, none
        waiting = [(0.0, 0, -1.0)]                            # the root's centre isn't stored: it rules nothing out
        while waiting:
            least, number, from_centre = heapq.heappop(waiting)
            if least > worst + margin:
                break
            leaf, own, nulls, whole, v, apart, radii, children = self.pages[number]
            if from_centre >= 0 and worst < np.inf:
                near = np.abs(from_centre - apart) - (0.0 if leaf else radii) <= worst + margin
                at = np.flatnonzero(near)
                if not len(at):
                    continue
            else:
                at = slice(None)
            products = v[at] @ q
            if not leaf:
                d = np.sqrt(np.maximum(reach - 2 * products, 0))
                low = np.maximum(d - radii[at], 0)
                for bound, child, distance in zip(low.tolist(), children[at].tolist(), d.tolist()):
                    if bound <= worst + margin:
                        heapq.heappush(waiting, (bound, child, distance))
                continue
            got = products.astype(np.int64) if exact else whole[at] @ query
            mine = (own[at] != own_id) | nulls[at]
            if len(score) == k:
                mine &= got >= score[-1]
            if not mine.any():
                continue
            score = np.concatenate([score, got[mine]])
            ids = np.concatenate([ids, own[at][mine]])
            none = np.concatenate([none, nulls[at][mine]])
            best = np.lexsort((none, ids, -score))[:k]
            score, ids, none = score[best], ids[best], none[best]
            if len(score) == k:
                worst = float(np.sqrt(max(reach - 2 * float(score[-1]), 0.0)))
        return score, ids, none


def _search(dims: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree = None, None
        for b in batches:
            for row in b.to_pylist():
                if row["shard"] != shard:
                    shard, tree = row["shard"], Tree(dims)
                if row["kind"] == 0:
                    tree.add(row)
                    continue
                ids, keys = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["keys"], np.int64)
                queries = np.frombuffer(row["vectors"], np.int64).reshape(-1, dims)
                found = [tree.search(q, i, k) for q, i in zip(queries, ids.tolist())]
                n = [len(s) for s, _, _ in found]
                none = np.concatenate([x for _, _, x in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, n)), pa.array(np.repeat(keys, n)),
                     pa.array(np.concatenate([i for _, i, _ in found]), mask=none),
                     pa.array(np.concatenate([s for s, _, _ in found]))],
                    names=["query_id", "key", "vec_id", "score"])
    return run


def _query_blocks(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, BLOCK):
                part = b.slice(i, BLOCK)
                yield pa.RecordBatch.from_pylist([{
                    "shard": 0, "kind": 1, "seq": int(part.column(1)[0].as_py()), "leaf": False, "most": 0.0,
                    "ids": np.asarray(part.column(0)).astype(np.int64).tobytes(),
                    "keys": np.asarray(part.column(1)).astype(np.int64).tobytes(),
                    "vectors": _matrix(part.column(2), dims).tobytes(), "apart": b"", "radii": b"",
                    "children": b""}], _schema())
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding", shard_size: int = SHARD) -> DataFrame:
    """Per query: query_id, rank, vec_id, score of the k best rows. `is_query` is a condition on `vec_id`."""
    spark = vectors.sparkSession
    ship(spark)
    rows = cut(whole_numbers(vectors, scale, id_col, vector_col), "vectors")
    largest = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    n, dims, most = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(largest)).first()
    if (dims or 0) * (most or 0.0) ** 2 >= 2.0 ** 63:
        raise ValueError("scores of these vectors don't fit in 64 bits; take a smaller scale")
    shards, dims = max(1, -(-n // shard_size)), max(1, dims or 0)
    dealt = rows.withColumn("shard", F.pmod("key", F.lit(shards)).cast("int"))
    pages = cut(dealt.groupBy("shard").applyInArrow(_tree(dims), PAGES), "pages")
    queries = rows.filter(is_query).select(F.col("vec_id").cast("long"), "key", "v")
    blocks = queries.mapInArrow(_query_blocks(dims), PAGES).drop("shard").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "*")
    meet = pages.unionByName(blocks).repartition("shard").sortWithinPartitions("shard", "kind", "seq")
    found = meet.mapInArrow(_search(dims, k), "query_id long, key long, vec_id long, score long")
    best = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
