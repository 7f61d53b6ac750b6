"""Union of overlapping shapes and overlay of two layers, on row-run masks and boxes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownframe.operators.masks import RUN, _spread, mask_area, merge_intervals, run_boxes, subtract_runs
from crownframe.operators.numbering import by_size, of_keys
from crownframe.operators.spatial_join import bbox_join
from crownframe.session import cut


#: Links of one key that are followed in one task.
FEW_LINKS = 200_000


def _connect_key(keys: Sequence[str]):
    """Component of each node in one key's links."""
    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        n = len(frame)
        at, ids = pd.factorize(pd.concat([frame["u"], frame["v"]]), sort=True)
        low = _roots(len(ids), at[:n], at[n:])
        return pd.DataFrame({**{k: [frame[k].iloc[0]] * len(ids) for k in keys}, "id": ids, "component": ids[low]})

    return settle


def connected(nodes: DataFrame, edges: DataFrame, keys: Sequence[str], few_links: int = FEW_LINKS) -> DataFrame:
    """Component of each node `(keys, id)`: the smallest id reachable over `edges (keys, u, v)`.

    A key with at most `few_links` links is settled in one task. Larger ones go by large-star / small-star contraction: every
    step links nodes to the smallest neighbour they know, which takes a logarithmic number of steps in practice and keeps
    the edge count from growing.
    """
    keys = list(keys)
    links = cut(edges.filter("u <> v").select(
        *keys, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    few, many = by_size([links], keys, few_links) if keys else (None, links)
    parts = []
    if few is not None:
        kind = links.select(*keys, F.col("u").alias("id"), F.col("u").alias("component")).schema
        parts.append(of_keys(links, keys, few, many).groupBy(*keys).applyInPandas(_connect_key(keys), kind))
    if many is not None or few is None:
        parts.append(_connected_rounds(links if many is None or not keys else of_keys(links, keys, many, few), keys))
    roots = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return nodes.select(*keys, "id").join(roots, [*keys, "id"], "left").withColumn(
        "component", F.coalesce("component", "id"))


def _connected_rounds(links: DataFrame, keys: Sequence[str]) -> DataFrame:
    while True:
        both = links.unionByName(links.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(*keys, "u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.filter("v > u").join(low, [*keys, "u"]).select(
            *keys, F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy(*keys, "u").agg(F.min("v").alias("m"))
        small = large.join(down, [*keys, "u"])
        small = small.filter("v <> m").select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
        new = cut(small.unionByName(down.select(*keys, "u", F.col("m").alias("v")))
                  .filter("u <> v").distinct(), "links")
        moved = new.join(links, [*keys, "u", "v"], "left_anti").limit(1).count()
        grown = links.join(new, [*keys, "u", "v"], "left_anti").limit(1).count()
        links = new
        if not moved and not grown:
            break
    return links.groupBy(*keys, F.col("u").alias("id")).agg(F.min("v").alias("component"))


BLOCK = 4096   # pixels; a line is worked on in blocks, so no group grows with the raster
FEW_RUNS = 200_000   # runs of one key that are dissolved in one task


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest item each of `n` items is linked with, over any number of links."""
    low = np.arange(n)
    while len(u):
        a, b = low[u], low[v]
        open_ = a != b
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while (low != low[low]).any():
            low = low[low]
    return low


def _dissolve_key(keys: Sequence[str]):
    """`dissolve` of the runs of one key, cut in blocks."""
    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        line, blk, start, stop = (frame[c].to_numpy(dtype=np.int64) for c in ("line", "_blk", "c0", "c1"))
        rank, ids = pd.factorize(frame["id"], sort=True)
        order = np.lexsort((start, blk, line))
        line, blk, start, stop, rank = line[order], blk[order], start[order], stop[order], rank[order]
        cell = np.cumsum(np.append(0, (np.diff(line) != 0) | (np.diff(blk) != 0)))
        low = start.min()
        apart = stop.max() - low + 2
        reach = np.maximum.accumulate(stop - low + cell * apart)
        heads = np.flatnonzero(np.append(True, (start - low + cell * apart)[1:] > reach[:-1]))
        name = np.minimum.reduceat(rank, heads)
        line, start = line[heads], start[heads]
        stop = np.append(reach[heads[1:] - 1], reach[-1]) - cell[heads] * apart + low
        # Segments of a line are disjoint, so starts and ends both ascend over all lines.
        place = lambda at, x: (at - line[0]) * apart + (x - low)
        first = np.searchsorted(place(line, stop), place(line + 1, start), "right")
        last = np.searchsorted(place(line, start), place(line + 1, stop), "left")
        u, k = _spread(np.maximum(last - first, 0))
        v = first[u] + k
        beside = np.flatnonzero((line[1:] == line[:-1]) & (start[1:] == stop[:-1]))
        part = _roots(len(line), np.append(u, beside), np.append(v, beside + 1))
        np.minimum.at(name, part, name.copy())
        return pd.DataFrame({**{k: [frame[k].iloc[0]] * len(line) for k in keys}, "component": ids[name[part]],
                             "line": line, "c0": start, "c1": stop})

    return settle


def dissolve(runs: DataFrame, id_col: str, keys: Sequence[str] = ("product_id",), few_runs: int = FEW_RUNS) -> DataFrame:
    """Union of all masks, split into connected parts: runs with `component`, the lowest id of each.

    The masks are merged line by line first, so any number of masks on one spot becomes one segment;
    parts are then the connected segments of neighbouring lines. Cost follows the covered ground, not
    the pairs of masks. Runs end at multiples of `BLOCK`. A key with at most `few_runs` runs is dissolved in one
    task; larger ones are, line by line, over many.
    """
    keys = list(keys)
    blocks = F.sequence(F.floor(F.col("c0") / BLOCK), F.floor((F.col("c1") - 1) / BLOCK))
    base = F.col("_blk") * BLOCK
    split = runs.filter("c1 > c0").withColumn("_blk", F.explode(blocks)).select(
        *keys, F.col(id_col).alias("id"), "line", "_blk",
        F.greatest(F.col("c0").cast("long"), base).alias("c0"),
        F.least(F.col("c1").cast("long"), base + BLOCK).alias("c1"))
    if not keys:
        return _dissolve_lines(split, keys)
    split = cut(split, "split")
    few, many = by_size([split], keys, few_runs)
    parts = []
    if few is not None:
        kind = split.select(*keys, F.col("id").alias("component"), "line", F.col("c0").cast("int").alias("c0"),
                            F.col("c1").cast("int").alias("c1")).schema
        parts.append(of_keys(split, keys, few, many).groupBy(*keys).applyInPandas(_dissolve_key(keys), kind))
    if many is not None or few is None:
        parts.append(_dissolve_lines(split if many is None else of_keys(split, keys, many, few), keys))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _dissolve_lines(split: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`dissolve` of runs cut in blocks, by joins and rounds."""
    cell = [*keys, "line", "_blk"]
    # Equal runs of different masks count once; the lowest id stands for them.
    single = split.groupBy(*cell, "c0", "c1").agg(F.min("id").alias("id"))
    single = cut(single, "runs")
    merged = merge_intervals(single, cell, "c0", "c1").withColumn(
        "seg", F.col("line").cast("long") * (1 << 31) + F.col("c0"))
    segs = cut(merged, "segments")
    below = segs.select(*keys, (F.col("line") - 1).alias("line"), "_blk", F.col("seg").alias("v"),
                        F.col("c0").alias("_b0"), F.col("c1").alias("_b1"))
    down = segs.join(below, cell).filter((F.col("_b0") < F.col("c1")) & (F.col("_b1") > F.col("c0")))
    edge = (F.col("_blk") + 1) * BLOCK
    right = segs.filter(F.col("c0") == F.col("_blk") * BLOCK).select(
        *keys, "line", (F.col("_blk") - 1).alias("_blk"), F.col("seg").alias("v"))
    across = segs.filter(F.col("c1") == edge).join(right, cell)
    links = down.select(*keys, F.col("seg").alias("u"), "v").unionByName(
        across.select(*keys, F.col("seg").alias("u"), "v"))
    parts = connected(segs.select(*keys, F.col("seg").alias("id")), links, keys).select(
        *keys, F.col("id").alias("seg"), F.col("component").alias("_part"))
    named = segs.join(parts, [*keys, "seg"])
    inside = single.select(*cell, "id", F.col("c0").alias("_r0"))
    lowest = named.join(inside, cell).filter(
        (F.col("_r0") >= F.col("c0")) & (F.col("_r0") < F.col("c1"))).groupBy(
        *keys, "_part").agg(F.min("id").alias("component"))
    return named.join(lowest, [*keys, "_part"]).select(
        *keys, "component", "line", F.col("c0").cast("int").alias("c0"),
        F.col("c1").cast("int").alias("c1"))


def overlay_union(a: DataFrame, b: DataFrame, a_id: str = "a_id", b_id: str = "b_id",
                  keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """Pieces of two layers: A and B with both ids, A only and B only with the other id null.

    Shapes of one layer are taken not to overlap each other, as in a label layer.
    """
    keys = list(keys)
    boxes_a = run_boxes(a, [*keys, a_id]).withColumnRenamed(a_id, "id")
    boxes_b = run_boxes(b, [*keys, b_id]).withColumnRenamed(b_id, "id")
    pairs = bbox_join(boxes_a, boxes_b, keys)
    low, high = F.greatest("a_y0", "b_y0"), F.least("a_y1", "b_y1")
    lines = pairs.select(*keys, F.col("a_id").alias("_p"), F.col("b_id").alias("_q"), F.explode(
        F.sequence(low.cast("int"), (high - 1).cast("int"))).alias("line"))
    ra = a.select(*keys, F.col(a_id).alias("_p"), "line", F.col("c0").alias("_a0"),
                  F.col("c1").alias("_a1"))
    rb = b.select(*keys, F.col(b_id).alias("_q"), "line", F.col("c0").alias("_b0"),
                  F.col("c1").alias("_b1"))
    both = lines.join(ra, [*keys, "_p", "line"]).join(rb, [*keys, "_q", "line"]).select(
        *keys, F.col("_p").alias(a_id), F.col("_q").alias(b_id), "line",
        F.greatest("_a0", "_b0").alias("c0"), F.least("_a1", "_b1").alias("c1")).filter("c1 > c0")
    only_a = subtract_runs(a, both.select(*keys, a_id, *RUN), [*keys, a_id])
    only_b = subtract_runs(b, both.select(*keys, b_id, *RUN), [*keys, b_id])
    return both.unionByName(only_a, allowMissingColumns=True).unionByName(
        only_b, allowMissingColumns=True)


def disjoint_boxes(aoi: DataFrame, key: str = "product_id") -> DataFrame:
    """Cut overlapping AOI boxes into disjoint ones that cover the same ground.

    The plane is cut at every AOI border of a raster; AOI tables are drawn by hand and small.
    """
    ys = aoi.select(key, F.explode(F.array("y0", "y1")).alias("y")).distinct()
    cuts = ys.groupBy(key).agg(F.array_sort(F.collect_list("y")).alias("_ys"))
    bands = aoi.join(cuts, key).withColumn("_y", F.explode(F.filter(
        "_ys", lambda v: (v >= F.col("y0")) & (v < F.col("y1")))))
    upper = F.array_min(F.filter("_ys", lambda v: v > F.col("_y")))
    strips = bands.select(key, F.col("_y").alias("y0"), upper.alias("y1"), "x0", "x1")
    return merge_intervals(strips, [key, "y0", "y1"], "x0", "x1").select(key, "x0", "y0", "x1", "y1")
