"""Greedy non-maximum suppression as rounds over an edge table.

The sequential rule "take boxes by descending score, drop what overlaps a taken one" has one
result, and that result follows from the edges alone: a box without a living stronger neighbour is
taken, and its weaker neighbours fall. Each round settles every such box at once. Any number of IoU
thresholds is settled together: bit i of a mask stands for the i-th threshold, a box has the bits at
which it is still alive and an edge those at which it counts.

Order: score descending (null and NaN last), then a hash of the id, then the id.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownframe.functions import boxes as B
from crownframe.functions.ranks import at_least, ranked_score, tie_of
from crownframe.operators.box_pairs import iou, overlapping
from crownframe.operators.masks import FEW_RUNS, blocks_of, coded_runs, count_runs, mask_overlaps, meeting, runs_of_rows, whole_masks
from crownframe.operators.numbering import by_size, of_keys
from crownframe.operators.spatial_join import bbox_join, cell_crowds, place
from crownframe.session import cut, on_file, release

#: Boxes in one grid cell above which the boxes of that cell are thinned before pairing, and edges of
#: one key few enough to be finished in a task, after some rounds. Neither changes the result.
HOT_CELL, TAIL_EDGES, TAIL_AFTER = 2_000, 200_000, 0
#: A key with at most this many times `hot_cell` boxes is settled in one task from its boxes, without a table of pairs.
WHOLE_KEY, BLOCK = 10, 512


def _order(prefix: str = "") -> Column:
    """Sort key: the strongest box has the smallest one."""
    return F.struct((-F.col(f"{prefix}score")).alias("s"), F.col(f"{prefix}tie").alias("t"),
                    F.col(f"{prefix}id").alias("i"))


def _before(a: str, b: str) -> Column:
    """Whether the box of one prefix comes before that of the other; the same order, pair by pair."""
    score, tie = (F.col(f"{a}score"), F.col(f"{b}score")), (F.col(f"{a}tie"), F.col(f"{b}tie"))
    return (score[0] > score[1]) | ((score[0] == score[1]) & (
        (tie[0] < tie[1]) | ((tie[0] == tie[1]) & (F.col(f"{a}id") < F.col(f"{b}id")))))


def _minus(mask: Column, gone: Column) -> Column:
    """The bits of `mask` that aren't in `gone` (null: none)."""
    return mask.bitwiseAND(F.bitwise_not(F.coalesce(gone, F.lit(0).cast("long"))))


def drop_copies(nodes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Among boxes with the very same corners only the strongest can survive a threshold below 1.

    Whatever suppresses it suppresses the others as well. Boxes without area never overlap anything
    and are left alone.
    """
    solid = nodes.filter(B.area(B.box()) > 0)
    best = solid.groupBy(*keys, *B.BOX).agg(F.min(F.struct(_order().alias("o"), "alive")).alias("_b"))
    best = best.select(*keys, F.col("_b.o.i").alias("id"), *B.BOX, (-F.col("_b.o.s")).alias("score"),
                       F.col("_b.o.t").alias("tie"), F.col("_b.alive").alias("alive"))
    return best.select(*nodes.columns).unionByName(nodes.filter(B.area(B.box()) <= 0))


def _edges(strong: DataFrame, weak: DataFrame, keys: Sequence[str], levels: Sequence[int],
           thresholds: Sequence[float]) -> DataFrame:
    """(keys, hi, lo, mask, hi_score, hi_tie): hi comes before lo and overlaps it by more than the
    thresholds in the mask, at which both are alive."""
    pairs = bbox_join(strong, weak, keys, extra=_before("a_", "b_"), left_levels=levels, right_levels=levels)
    # The overlap is written before the mask is made of it: as one expression it would be worked out again for
    # each threshold, in a join condition too long for the compiler.
    pairs = cut(pairs.withColumn("iou", B.iou(B.box("a_"), B.box("b_"))).filter(F.col("iou") > min(thresholds)).select(
        *keys, F.col("a_id").alias("hi"), F.col("b_id").alias("lo"), "iou",
        F.col("a_alive").bitwiseAND(F.col("b_alive")).alias("_both"),
        F.col("a_score").alias("hi_score"), F.col("a_tie").alias("hi_tie")), "pairs")
    mask = _crossed(thresholds).bitwiseAND(F.col("_both"))
    return pairs.select(*keys, "hi", "lo", mask.alias("mask"), "hi_score", "hi_tie").filter("mask != 0")


def _crossed(thresholds: Sequence[float]) -> Column:
    """The thresholds below the column `iou`, as bits."""
    bits = [F.when(F.col("iou") > t, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, t in enumerate(thresholds)]
    return sum(bits, F.lit(0).cast("long"))


def _thin(nodes: DataFrame, thresholds: Sequence[float], keys: Sequence[str],
          hot_cell: int) -> tuple[DataFrame, DataFrame | None, list[int]]:
    """Resolve crowds of near copies in linear steps: returns (unresolved, taken, grid levels).

    A box that is the strongest of every grid cell it reaches has no stronger neighbour, so it is
    taken; pairing the taken boxes with the rest costs one row per box and cell, never all pairs. Only
    boxes that reach a crowded cell are taken here, and exact copies go first. Ends when no cell is
    crowded or the crowds no longer shrink; the edge rounds do the rest.
    """
    keys = list(keys)
    taken: DataFrame | None = None
    crowd = None
    while True:
        crowds, levels = cell_crowds(nodes, keys, hot_cell)
        now = crowds.agg(F.sum("n")).first()[0] or 0
        if not now or (crowd is not None and crowd - now < 0.1 * crowd):
            return nodes, taken, levels
        if crowd is None:
            crowd = float("inf")
            nodes = cut(drop_copies(nodes, keys), "nodes")
            continue
        crowd = now
        cell = [*keys, "_level", "_cx", "_cy"]
        cells = place(nodes, levels, home=[0], visit=[1]).withColumn("_rank", _order())
        best = cells.groupBy(*cell).agg(
            F.min("_rank").alias("_all"),
            F.min(F.when(F.col("_role") == 0, F.col("_rank"))).alias("_home"))
        best = best.join(crowds.select(*cell, F.lit(True).alias("_hot")), cell, "left")
        rival = F.when(F.col("_role") == 0, F.col("_all")).otherwise(F.col("_home"))
        tops = (cells.join(best, cell).groupBy(*keys, "id").agg(
            F.bool_and(rival.isNull() | (F.col("_rank") <= rival)).alias("_top"),
            F.bool_or(F.coalesce("_hot", F.lit(False))).alias("_near"))
            .filter("_top and _near").select(*keys, "id"))
        winners = cut(nodes.join(tops, [*keys, "id"], "left_semi"), "winners")
        gone = _edges(winners, nodes, keys, levels, thresholds).select(
            *keys, F.col("lo").alias("id"), F.col("mask").alias("_gone")).unionByName(
            winners.select(*keys, "id", F.col("alive").alias("_gone")))
        gone = gone.groupBy(*keys, "id").agg(F.bit_or("_gone").alias("_gone"))
        left = nodes.join(gone, [*keys, "id"], "left").withColumn(
            "alive", _minus(F.col("alive"), F.col("_gone")))
        old, nodes = nodes, cut(left.filter("alive != 0").select(*nodes.columns), "unresolved")
        release(old)
        won = winners.select(*keys, "id", "alive")
        taken = won if taken is None else taken.unionByName(won)


def _finish(keys: Sequence[str]):
    """The sequential rule over one key's edges, strongest first; at most `tail_edges` rows."""
    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["hi_score", "hi_tie", "hi"], ascending=[False, True, True], kind="stable")
        fallen: dict[int, int] = {}
        for hi, lo, mask in zip(frame["hi"].tolist(), frame["lo"].tolist(), frame["mask"].tolist()):
            if falls := mask & ~fallen.get(hi, 0):
                fallen[lo] = fallen.get(lo, 0) | falls
        out = {k: frame[k].iloc[0] for k in keys}
        return pd.DataFrame({**{k: [v] * len(fallen) for k, v in out.items()},
                             "id": list(fallen), "mask": list(fallen.values())})

    return settle


def suppressed(edges: DataFrame, keys: Sequence[str], tail_edges: int = TAIL_EDGES,
               tail_after: int = TAIL_AFTER) -> DataFrame:
    """`(keys, id, mask)`: the thresholds at which a box falls, from `(keys, hi, lo, mask, hi_score, hi_tie)`.

    After `tail_after` rounds each key whose living edges are at most `tail_edges` is finished in one task;
    larger keys go on in rounds, which give the same.
    """
    keys = list(keys)
    edges = cut(edges.select(*keys, "hi", "lo", "mask", "hi_score", "hi_tie"), "edges")
    schema = edges.select(*keys, F.col("hi").alias("id"), "mask").schema
    fallen: list[DataFrame] = []
    rounds = 0
    while not edges.isEmpty():
        if rounds >= tail_after and keys:
            few = cut(edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                      .filter(F.col("_n") <= tail_edges).select(*keys), "few")
            if not few.isEmpty():
                ends = edges.join(few, keys, "left_semi").groupBy(*keys).applyInPandas(_finish(keys), schema)
                fallen.append(cut(ends, "fallen"))
                old, edges = edges, cut(edges.join(few, keys, "left_anti"), "edges")
                release(old, few)
                continue
        weak = edges.groupBy(*keys, F.col("lo").alias("hi")).agg(F.bit_or("mask").alias("_weak"))
        sure = edges.join(weak, [*keys, "hi"], "left").withColumn("mask", _minus(F.col("mask"), F.col("_weak")))
        hit = cut(sure.filter("mask != 0").groupBy(*keys, F.col("lo").alias("id")).agg(
            F.bit_or("mask").alias("mask")), "fallen")
        fallen.append(hit)
        left = edges
        for side in ("lo", "hi"):
            gone = hit.select(*keys, F.col("id").alias(side), F.col("mask").alias("_gone"))
            left = left.join(gone, [*keys, side], "left").withColumn(
                "mask", _minus(F.col("mask"), F.col("_gone"))).drop("_gone")
        old, edges = edges, cut(left.filter("mask != 0").select(*edges.columns), "edges")
        release(old)
        rounds += 1
    if not fallen:
        return edges.select(*keys, F.col("hi").alias("id"), "mask")
    union = fallen[0]
    for more in fallen[1:]:
        union = union.unionByName(more)
    return union.groupBy(*keys, "id").agg(F.bit_or("mask").alias("mask"))


def nodes_of(objects: DataFrame, keys: Sequence[str], id_col: str, score_col: str,
             thresholds: Sequence[float], boxes: bool = True) -> DataFrame:
    if len(thresholds) > 62:
        raise ValueError("at most 62 thresholds at once")
    return objects.select(
        *keys, F.col(id_col).alias("id"), *(B.BOX if boxes else []), ranked_score(F.col(score_col)).alias("score"),
        tie_of(F.col(id_col)).alias("tie"), F.lit((1 << len(thresholds)) - 1).cast("long").alias("alive"))


def _remaining(live: DataFrame, edges: DataFrame, keys: Sequence[str], tail_edges: int) -> DataFrame:
    fallen = suppressed(edges, keys, tail_edges)
    return live.select(*keys, "id", "alive").join(
        fallen.withColumnRenamed("mask", "_gone"), [*keys, "id"], "left").select(
        *keys, "id", _minus(F.col("alive"), F.col("_gone")).alias("mask"))


def swept(alive: np.ndarray, thresholds: Sequence[float], pairs) -> np.ndarray:
    """The sequential rule over what `alive` has a mask for, strongest first: the masks that are left. `pairs(a, b)` gives (i, j, IoU) of
    the positions in a and b that overlap; a block of the strongest goes at a time, so pairs are never held for more than that."""
    ranks = np.sort(np.array(thresholds, dtype=float))
    bits = np.array([sum(1 << i for i, t in enumerate(thresholds) if t < edge) for edge in [*ranks, np.inf]], dtype=np.int64)
    crossed = lambda value: bits[np.searchsorted(ranks, value, "left")]
    alive = alive.copy()
    for start in range(0, len(alive), BLOCK):
        mine = start + np.flatnonzero(alive[start:start + BLOCK])
        inside = [(i[i < j], j[i < j], value[i < j]) for i, j, value in pairs(mine, mine)]
        hi, lo, value = (np.concatenate([p[k] for p in inside] or [np.zeros(0, np.int64)]) for k in range(3))
        order = np.argsort(hi, kind="stable")
        for strong, weak, falls in zip(hi[order].tolist(), lo[order].tolist(), crossed(value[order]).tolist()):
            alive[weak] &= ~(falls & alive[strong])
        mine = mine[alive[mine] != 0]
        later = start + BLOCK + np.flatnonzero(alive[start + BLOCK:])
        fallen = np.zeros(len(alive), np.int64)
        for hi, lo, value in pairs(mine, later):
            np.bitwise_or.at(fallen, lo, crossed(value) & alive[hi])
        alive &= ~fallen
    return alive


def box_overlaps(box: np.ndarray):
    """`pairs` of boxes for `swept`."""
    def pairs(a: np.ndarray, b: np.ndarray):
        for i, j in overlapping(box[a], box[b]):
            yield a[i], b[j], iou(box[a[i]], box[b[j]])

    return pairs


def run_overlaps(b: pa.RecordBatch, own: np.ndarray, code: np.ndarray):
    """`pairs` of masks, the positions in `own`; `code` as in `runs_of_rows`."""
    at = np.zeros(b.num_rows, np.int64)
    at[own] = np.arange(len(own))
    row, line, c0, wide = runs_of_rows(b, own, code)
    order = np.argsort(at[row], kind="stable")
    area, shared = mask_overlaps(at[row][order], line[order], c0[order], wide[order], len(own))

    def pairs(a: np.ndarray, b: np.ndarray):
        for i, j, n in shared(a, b):
            yield i, j, n / (area[i] + area[j] - n)

    return pairs


def _settle(keys: Sequence[str], thresholds: Sequence[float]):
    """The sequential rule over the boxes of one key."""
    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["score", "tie", "id"], ascending=[False, True, True], kind="stable", ignore_index=True)
        alive = swept(frame["alive"].to_numpy(dtype=np.int64), thresholds, box_overlaps(frame[list(B.BOX)].to_numpy(dtype=float)))
        kept = np.flatnonzero(alive)
        return frame.loc[kept, [*keys, "id"]].assign(mask=alive[kept])

    return settle


def id_codes(ids: pa.Array) -> np.ndarray:
    """Whole numbers in the order of the ids, -1 for null."""
    code = np.full(len(ids), -1, np.int64)
    code[np.asarray(ids.is_valid())] = np.unique(ids.drop_null().to_numpy(zero_copy_only=False), return_inverse=True)[1].ravel()
    return code


def ranked_rows(b: pa.RecordBatch, rows: np.ndarray, code: np.ndarray) -> np.ndarray:
    """`rows` of a batch, strongest first; `code` has the order of the ids."""
    score, tie = (np.asarray(b.column(c).take(pa.array(rows))) for c in ("score", "tie"))
    return rows[np.lexsort((code[rows], tie, -score))]


def _settle_masks(keys: Sequence[str], thresholds: Sequence[float]):
    """The sequential rule over the masks of one key: rows of objects, and rows with their runs (`at`)."""
    def settle(table: pa.Table) -> pa.Table:
        b = table.combine_chunks().to_batches()[0]
        code = id_codes(b.column("id"))
        own = ranked_rows(b, np.flatnonzero(~np.asarray(b.column("at").is_valid())), code)
        alive = swept(np.asarray(b.column("alive").take(pa.array(own))), thresholds, run_overlaps(b, own, code))
        kept = np.flatnonzero(alive)
        at = pa.array(own[kept])
        return pa.table([*[b.column(c).take(at) for c in (*keys, "id")], pa.array(alive[kept])], names=[*keys, "id", "mask"])

    return settle


def kept_masks(nodes: DataFrame, keys: Sequence[str], thresholds: Sequence[float], hot_cell: int,
               tail_edges: int) -> DataFrame:
    """`(keys, id, mask)`: the thresholds (all below 1) at which a box stays.

    A key with few boxes goes to one task with its boxes; the boxes of larger keys are paired in grid cells.
    """
    keys = list(keys)
    nodes = cut(nodes, "nodes")
    most = min(WHOLE_KEY * hot_cell, tail_edges)
    if not keys or most <= 0 or min(thresholds) < 0:
        return _kept_in_cells(nodes, keys, thresholds, hot_cell, tail_edges)
    few, many = by_size([nodes], keys, most)
    parts = []
    if few is not None:
        schema = nodes.select(*keys, "id", F.col("alive").alias("mask")).schema
        parts.append(of_keys(nodes, keys, few, many).groupBy(*keys).applyInPandas(_settle(keys, thresholds), schema))
    if many is not None or few is None:
        large = nodes if many is None else of_keys(nodes, keys, many, few)
        parts.append(_kept_in_cells(cut(large, "nodes"), keys, thresholds, hot_cell, tail_edges))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _kept_in_cells(nodes: DataFrame, keys: Sequence[str], thresholds: Sequence[float], hot_cell: int,
                   tail_edges: int) -> DataFrame:
    live, taken, levels = _thin(nodes, thresholds, keys, hot_cell)
    kept = _remaining(live, _edges(live, live, keys, levels, thresholds), keys, tail_edges)
    if taken is None:
        return kept.filter("mask != 0")
    both = kept.unionByName(taken.withColumnRenamed("alive", "mask"))
    return both.groupBy(*keys, "id").agg(F.bit_or("mask").alias("mask")).filter("mask != 0")


def kept_run_masks(nodes: DataFrame, runs: DataFrame, keys: Sequence[str], thresholds: Sequence[float],
                   tail_edges: int) -> DataFrame:
    """`kept_masks` for shapes given as runs `(keys, id, line, c0, c1)`; an object without runs overlaps
    nothing. A key with few runs goes to one task with them."""
    keys = list(keys)
    most = min(FEW_RUNS, tail_edges)
    if not keys or most <= 0:
        return _kept_by_blocks(nodes, runs, keys, thresholds, tail_edges)
    both = nodes.unionByName(coded_runs(runs, [*keys, "id"]), allowMissingColumns=True).dropna(subset=[*keys, "id"])
    if not on_file(runs):
        both = cut(both, "masks")
    few, many = by_size([both], keys, most, count_runs("at"))
    parts = []
    if few is not None:
        schema = both.select(*keys, "id", F.col("alive").alias("mask")).schema
        parts.append(of_keys(both, keys, few, many).groupBy(*keys).applyInArrow(_settle_masks(keys, thresholds), schema))
    if many is not None or few is None:
        large = [df if many is None else of_keys(df, keys, many, few) for df in (nodes, runs)]
        parts.append(_kept_by_blocks(*large, keys, thresholds, tail_edges))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _kept_by_blocks(nodes: DataFrame, runs: DataFrame, keys: Sequence[str], thresholds: Sequence[float], tail_edges: int) -> DataFrame:
    """`kept_run_masks` of keys of any size. Of objects with the very same pixels only the first can stay."""
    nodes = cut(nodes, "nodes")
    order = ["score", "tie", "id"]
    shapes = cut(whole_masks(runs, [*keys, "id"], nodes, ["score", "tie"]), "masks")
    first = shapes.groupBy(*keys, "area", "shape").agg(F.min(_order()).alias("_b")).select(
        *keys, F.col("_b.i").alias("id"), (-F.col("_b.s")).alias("score"), F.col("_b.t").alias("tie"), "area", "shape")
    first = cut(first, "shapes")
    # Pieces come in the order of suppression, and pairs of masks below every threshold go out where they are found.
    pairs = meeting(blocks_of(first, keys, 0, ["score", "tie"]), keys, True, max(min(thresholds), 0.0),
                    [F.desc("score"), *order[1:]], ["score", "tie"])
    pairs = pairs.groupBy(*keys, "a_id", "b_id").agg(F.sum("inter").alias("inter"), *[F.first(c).alias(c) for c in ("area_a", "area_b", "score", "tie")])
    i = F.col("inter")
    edges = pairs.withColumn("iou", i / (F.col("area_a") + F.col("area_b") - i)).filter(F.col("iou") > min(thresholds)).select(
        *keys, F.col("a_id").alias("hi"), F.col("b_id").alias("lo"), _crossed(thresholds).alias("mask"),
        F.col("score").alias("hi_score"), F.col("tie").alias("hi_tie"))
    fallen = suppressed(edges, keys, tail_edges)
    # Copies of a shape fall at every threshold; what has no pixels overlaps nothing.
    copies = shapes.select(*keys, "id").join(first.select(*keys, "id").hint("merge"), [*keys, "id"], "left_anti")
    gone = fallen.unionByName(copies.withColumn("mask", F.lit((1 << len(thresholds)) - 1).cast("long")))
    return nodes.select(*keys, "id", "alive").join(gone.withColumnRenamed("mask", "_gone").hint("merge"), [*keys, "id"], "left").select(
        *keys, "id", _minus(F.col("alive"), F.col("_gone")).alias("mask")).filter("mask != 0")


def _renamed(runs: DataFrame, id_col: str) -> DataFrame:
    named = runs.withColumnRenamed(id_col, "id")
    if on_file(runs):
        on_file(named, now=True)
    return named


def nms(objects: DataFrame, threshold: float, score_threshold: float | None = None,
        score_col: str = "detector_score", id_col: str = "object_id",
        keys: Sequence[str] = ("product_id",), hot_cell: int = HOT_CELL,
        tail_edges: int = TAIL_EDGES, runs: DataFrame | None = None) -> DataFrame:
    """Keep the rows greedy suppression at `IoU > threshold` keeps, per `keys`.

    Rows below `score_threshold` are dropped first, and then those without a score too. With `runs` (`keys,
    id_col, line, c0, c1`) the IoU is that of the masks, else that of the boxes.
    """
    keys = list(keys)
    if score_threshold is not None:
        objects = objects.filter(at_least(F.col(score_col), score_threshold))
    if threshold >= 1:
        return objects  # no IoU exceeds 1
    nodes = nodes_of(objects, keys, id_col, score_col, [threshold], runs is None)
    kept = (kept_masks(nodes, keys, [threshold], hot_cell, tail_edges) if runs is None else
            kept_run_masks(nodes, _renamed(runs, id_col), keys, [threshold], tail_edges))
    return objects.join(kept.select(*keys, F.col("id").alias(id_col)), [*keys, id_col], "left_semi")


def nms_grid(objects: DataFrame, iou_thresholds: Sequence[float], score_floor: float | None = None,
             score_col: str = "detector_score", id_col: str = "object_id",
             keys: Sequence[str] = ("product_id",), hot_cell: int = HOT_CELL,
             tail_edges: int = TAIL_EDGES, runs: DataFrame | None = None) -> DataFrame:
    """`nms` for many IoU thresholds at once: kept `(nms_iou, keys, id_col, score)`.

    No loop over score thresholds is needed: a box is judged only by stronger boxes, so the result for a
    higher score threshold is the part of this one above it.
    """
    masks, wanted = nms_masks(objects, iou_thresholds, score_floor, score_col, id_col, keys, hot_cell, tail_edges,
                              runs)
    each = F.filter(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(1 << i).cast("long").alias("b"))
                              for i, t in enumerate(wanted)]),
                    lambda s: s["b"].bitwiseAND(F.col("mask")) != 0)
    return masks.withColumn("_t", F.explode(each)).select(
        F.col("_t.t").alias("nms_iou"), *keys, id_col, "score")


def nms_masks(objects: DataFrame, iou_thresholds: Sequence[float], score_floor: float | None = None,
              score_col: str = "detector_score", id_col: str = "object_id",
              keys: Sequence[str] = ("product_id",), hot_cell: int = HOT_CELL,
              tail_edges: int = TAIL_EDGES, runs: DataFrame | None = None) -> tuple[DataFrame, list[float]]:
    """Per kept object the thresholds at which it stays as bits of `mask`: `(keys, id_col, score, mask)`, and the
    thresholds that the bits stand for."""
    keys = list(keys)
    if score_floor is not None:
        objects = objects.filter(at_least(F.col(score_col), score_floor))
    wanted = sorted({float(t) for t in iou_thresholds})
    below = [t for t in wanted if t < 1]
    always = sum(1 << i for i, t in enumerate(wanted) if t >= 1)
    base = objects.select(*keys, id_col, F.col(score_col).cast("double").alias("score"))
    if not below:
        return base.withColumn("mask", F.lit(always).cast("long")), wanted
    nodes = nodes_of(objects, keys, id_col, score_col, below, runs is None)
    kept = (kept_masks(nodes, keys, below, hot_cell, tail_edges) if runs is None else
            kept_run_masks(nodes, _renamed(runs, id_col), keys, below, tail_edges))
    mask = F.coalesce("_mask", F.lit(0).cast("long")).bitwiseOR(F.lit(always).cast("long"))
    out = base.join(kept.select(*keys, F.col("id").alias(id_col), F.col("mask").alias("_mask")),
                    [*keys, id_col], "left").select(*keys, id_col, "score", mask.alias("mask"))
    return out.filter("mask != 0"), wanted


def tile_postprocess(objects: DataFrame, score_threshold: float = 0.05, nms_threshold: float = 0.5,
                     max_boxes: int = 500, tile_col: str = "tile_path",
                     score_col: str = "detector_score", id_col: str = "object_id") -> DataFrame:
    """Per tile: score threshold, suppression, then the strongest `max_boxes` boxes."""
    from crownframe.operators.numbering import top_per_group

    kept = nms(objects, nms_threshold, score_threshold, score_col, id_col, keys=[tile_col])
    return top_per_group(kept, [tile_col], [F.col(score_col).desc(), F.col(id_col)], max_boxes)
