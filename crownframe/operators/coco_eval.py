"""COCO detection metrics: matching, accumulation over score order, and the summary values.

Follows the published COCO protocol: at most `max_dets` detections per image and category, truths
outside the area range or marked crowd are ignored (matching one is neither hit nor miss), crowd
truths may be matched repeatedly and are compared by the share of the detection they cover.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownframe.functions import boxes as B
from crownframe.functions.batches import changes, whole_groups
from crownframe.functions.ranks import ranked_score
from crownframe.operators.masks import CELLS, RUN, _pieces, _spread, coded_runs, mask_overlaps, runs_of_rows
from crownframe.operators.numbering import top_per_group
from crownframe.session import cut

# The ten IoU thresholds and the recall grid 0, 0.01, ..., 1 of the protocol, and its
# pixel area ranges for when no ground resolution is known.
IOU_THRESHOLDS = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)
RECALL_STEPS = 100
PIXEL_RANGES = {"all": (0.0, 1e10), "small": (0.0, 32.0 ** 2), "medium": (32.0 ** 2, 96.0 ** 2),
                "large": (96.0 ** 2, 1e10)}
_CHUNK = 1 << 12      # detections of a key in one row on the way to its curves


def ranges_for(gsd: float | None) -> dict[str, tuple[float, float]]:
    """Area ranges: six when the ground resolution is known, else the protocol's four."""
    return PIXEL_RANGES if gsd is None else {"all": (0.0, B.OPEN_END), **B.area_ranges(gsd)}


def top_dets(detections: DataFrame, max_dets: int, keys: Sequence[str] = ("image_id",),
             score_col: str = "score", id_col: str = "det_id") -> DataFrame:
    """The strongest `max_dets` detections per image, with their rank from 1."""
    order = [F.col(score_col).desc(), F.col(id_col)]
    return top_per_group(detections, keys, order, max_dets, rank="rank")


def _range_table(ranges: dict[str, tuple[float, float]]) -> Column:
    return F.array(*[
        F.struct(F.lit(n).alias("label"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"))
        for n, (lo, hi) in ranges.items()])


def _overlaps_of_boxes(b: pa.RecordBatch, group: np.ndarray, det: np.ndarray, truth: np.ndarray):
    """(detection, truth, shared area) of rows of one image, some at a time, and the area of each row."""
    box = np.stack([np.asarray(b.column(c).fill_null(np.nan)) for c in B.BOX], 1)

    def found():
        first, after = np.searchsorted(group[truth], group[det]), np.searchsorted(group[truth], group[det], "right")
        count = after - first
        for begin, end in _pieces(count, CELLS):
            i, k = _spread(count[begin:end])
            i += begin
            x, y = det[i], truth[first[i] + k]
            near = (box[x, 0] < box[y, 2]) & (box[x, 2] > box[y, 0]) & (box[x, 1] < box[y, 3]) & (box[x, 3] > box[y, 1])
            i, k = x[near], y[near]
            x, y = box[i], box[k]
            yield i, k, np.maximum(np.minimum(x[:, 2], y[:, 2]) - np.maximum(x[:, 0], y[:, 0]), 0) * np.maximum(
                np.minimum(x[:, 3], y[:, 3]) - np.maximum(x[:, 1], y[:, 1]), 0)

    return found(), (box[:, 2] - box[:, 0]) * (box[:, 3] - box[:, 1])


def _overlaps_of_masks(b: pa.RecordBatch, group: np.ndarray, det: np.ndarray, truth: np.ndarray):
    """`_overlaps_of_boxes` for rows whose runs stand in rows of their own."""
    side = np.asarray(b.column("_side"))
    names, code = np.unique(np.asarray(b.column("id").fill_null(0)), return_inverse=True)
    runs = runs_of_rows(b, np.concatenate([det, truth]), (group.astype(np.int64) * 2 + side) * len(names) + code.ravel())
    area, shared = mask_overlaps(*runs, b.num_rows, group)
    return shared(det, truth), area


def _settle_images(keys: Sequence[str], ranges: dict[str, tuple[float, float]], thresholds: Sequence[float], max_dets: int,
                   masks: bool = False, packed: bool = False):
    """From truths (`_side` 0) and detections (1, strongest first) sorted by image: the ranked detections with the thresholds
    they match in each range, countable ones and all; `packed` as the `bits` of hits and misses that `_curves` reads.

    What lies behind an image's first `max_dets` detections is left out before anything is gathered, so a truth meets no more
    than that many. Images of a batch are paired together; a row of thresholds in all ranges is the bits of one number. With
    `masks` the rows of each side (`_kind` 0) come before their runs (`_kind` 1, `at`).
    """
    low, high = (np.array([r[k] for r in ranges.values()], dtype=float) for k in (0, 1))
    steps = np.minimum(np.array(thresholds, dtype=float), 1 - 1e-10)
    n, labels = len(steps), len(ranges)
    one = (1 << n) - 1
    full = (1 << n * labels) - 1
    every = sum(1 << n * k for k in range(labels))
    parts = [*keys, "_side", *(["_kind"] if masks else [])]

    def strongest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rank, kept = None, 0, np.zeros(0, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            both = b if last is None else pa.Table.from_batches([last, b]).combine_chunks().to_batches()[0]
            new = changes(both, parts)
            if last is None:
                new[0] = True
            place = np.arange(len(new))
            heads = np.flatnonzero(new)
            base = np.full(len(new), -rank)                          # the row of before has the rank it had
            for h, e in zip(heads, np.append(heads[1:], len(new))):
                base[h:e] = h - 1
            ranks = place - base
            some = (np.asarray(both.column("_side")) == 0) | (ranks <= max_dets)
            if masks:       # runs of the detections that stay
                kind, ident = np.asarray(both.column("_kind")), np.asarray(both.column("id").fill_null(0))
                det = np.asarray(both.column("_side")) == 1
                for h, e in zip(np.append(0, heads[heads > 0]), np.append(heads[heads > 0], len(new))):
                    if not det[h]:
                        kept = kept[:0]
                    elif kind[h]:
                        some[h:e] = np.isin(ident[h:e], kept)
                    else:
                        old = kept[:0] if new[h] else kept
                        kept = np.union1d(old, ident[h:e][some[h:e]])
            last, rank = both.slice(len(new) - 1), int(ranks[-1])
            ranks, some = (v[len(new) - b.num_rows:] for v in (ranks, some))
            yield b.append_column("rank", pa.array(ranks.astype(np.int32))).filter(pa.array(some))

    def pairs(overlaps, area: np.ndarray, crowd: np.ndarray):
        """Rows of detections and truths of an image that reach the lowest threshold, with the overlap."""
        for a, b, inter in overlaps:
            under = np.where(crowd[b], area[a], area[a] + area[b] - inter)
            value = np.divide(inter, under, out=np.zeros(len(inter)), where=under != 0)
            reach = value >= steps.min()
            yield a[reach], b[reach], value[reach]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, group in whole_groups(strongest(batches), keys, 1 << 14):
            side = np.asarray(b.column("_side"))
            own = np.asarray(b.column("_kind")) == 0 if masks else np.ones(b.num_rows, bool)
            det, truth = np.flatnonzero((side == 1) & own), np.flatnonzero((side == 0) & own)
            if not len(det):
                continue
            named = np.ones(b.num_rows, bool)
            for k in keys:
                named &= np.asarray(b.column(k).is_valid())
            crowd, ident = np.asarray(b.column("iscrowd").fill_null(False)), np.asarray(b.column("id").fill_null(0))
            area = np.asarray(b.column("area").fill_null(np.nan))
            inside = (area[:, None] >= low) & (area[:, None] <= high) & ~crowd[:, None]
            # A detection without a key meets no truth, but its mask has an area.
            overlaps, size = (_overlaps_of_masks if masks else _overlaps_of_boxes)(b, group, det if masks else det[named[det]], truth[named[truth]])
            found = [np.concatenate(c) for c in zip(*pairs(overlaps, size, crowd))]
            a, t, value = found or (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
            # A detection loses no more than `max_dets` truths to others, so it needs no more of each kind.
            kind = crowd.astype(np.int64) + 2 * (((area[:, None] >= low) & (area[:, None] <= high)) @ (1 << np.arange(labels)))
            order = np.lexsort((-ident[t], -value, kind[t], a))
            a, t, value = a[order], t[order], value[order]
            heads = np.flatnonzero((np.diff(a, prepend=-1) != 0) | (np.diff(kind[t], prepend=-1) != 0))
            near = np.arange(len(a)) - np.repeat(heads, np.diff(np.append(heads, len(a)))) < max_dets
            a, t, value = a[near], t[near], value[near]
            order = np.lexsort((-ident[t], -value, a))               # among equal IoU the later truth wins
            a, t, value = a[order], t[order], value[order]
            reach = ((value[:, None] >= steps) @ (1 << np.arange(n))).tolist()
            counts = [sum(one << n * k for k, v in enumerate(row) if v) for row in inside[truth].tolist()]
            counts = dict(zip(truth.tolist(), counts))
            taken: dict[int, int] = {}
            tp, hit = [0] * b.num_rows, [0] * b.num_rows
            ends = np.append(np.flatnonzero(np.diff(a)) + 1, len(a)).tolist() if len(a) else []
            rows, begin, crowds = t.tolist(), 0, crowd.tolist()
            for end, d in zip(ends, a[np.array(ends, np.int64) - 1].tolist()):
                todo = full
                for tier in (False, True):
                    for i in range(begin, end):
                        g = rows[i]
                        got = todo & (reach[i] * every) & (counts[g] ^ full if tier else counts[g]) & ~taken.get(g, 0)
                        if got:
                            todo ^= got
                            if not crowds[g]:
                                taken[g] = taken.get(g, 0) | got
                            hit[d] |= got
                            if not tier:
                                tp[d] |= got
                begin = end
            at, dets = pa.array(det), det.tolist()
            named_columns = [*[b.column(c).take(at) for c in (*keys, "id", "score", "rank")]]
            if packed:
                mine = (size[det, None] >= low) & (size[det, None] <= high)
                mine = [sum(one << n * k for k, v in enumerate(row) if v) for row in mine.tolist()]
                bits = [(tp[d] | (m & ~hit[d]) << n * labels).to_bytes(_bytes(n * labels), "little") for d, m in zip(dets, mine)]
                yield pa.RecordBatch.from_arrays([*named_columns, pa.array(bits, pa.binary())], names=[*keys, "det_id", "score", "rank", "bits"])
                continue
            lists = [pa.FixedSizeListArray.from_arrays(pa.array([(m[d] >> n * k) & one for d in dets for k in range(labels)], pa.int64()),
                                                       labels).cast(pa.list_(pa.int64())) for m in (tp, hit)]
            yield pa.RecordBatch.from_arrays([*named_columns, pa.array(size[det]), *lists],
                                             names=[*keys, "det_id", "score", "rank", "size", "tp", "hit"])

    return run


def _bytes(cells: int) -> int:
    """Of the hits and misses in as many cells."""
    return (2 * cells + 7) // 8


def _match(detections: DataFrame, truths: DataFrame, keys: Sequence[str], ranges: dict[str, tuple[float, float]],
           thresholds: Sequence[float], max_dets: int, runs: tuple[DataFrame, DataFrame] | None, packed: bool = False) -> DataFrame:
    """Detections and truths of an image meet in one sort, with their packed runs if they are masks."""
    shape = [] if runs else [F.col(c).cast("double").alias(c) for c in B.BOX]
    mine = detections.select(*keys, F.lit(1).alias("_side"), F.col("det_id").alias("id"), ranked_score(F.col("score")).alias("score"), *shape)
    real = truths.select(*keys, F.lit(0).alias("_side"), F.col("gt_id").alias("id"), *shape, F.col("area").cast("double").alias("area"),
                         F.col("iscrowd").cast("boolean").alias("iscrowd"))
    both = mine.unionByName(real, allowMissingColumns=True)
    if runs:
        both = both.withColumn("_kind", F.lit(0))
        for side, ident in ((1, "det_id"), (0, "gt_id")):
            coded = coded_runs(runs[1 - side].select(*keys, F.col(ident).alias("id"), *RUN), [*keys, "id"])
            both = both.unionByName(coded.withColumns({"_side": F.lit(side), "_kind": F.lit(1)}), allowMissingColumns=True)
    order = [*keys, "_side", *(["_kind"] if runs else []), F.desc("score"), "id"]
    kind = [*[both.schema[k] for k in keys], T.StructField("det_id", both.schema["id"].dataType), T.StructField("score", T.DoubleType()),
            T.StructField("rank", T.IntegerType())]
    lists = T.ArrayType(T.LongType())
    kind += [T.StructField("bits", T.BinaryType())] if packed else [
        T.StructField("size", T.DoubleType()), T.StructField("tp", lists), T.StructField("hit", lists)]
    return both.repartition(*keys).sortWithinPartitions(*order).mapInArrow(
        _settle_images(keys, ranges, thresholds, max_dets, bool(runs), packed), T.StructType(kind))


def coco_match(detections: DataFrame, truths: DataFrame, ranges: dict[str, tuple[float, float]],
               thresholds: Sequence[float] = IOU_THRESHOLDS, max_dets: int = 100,
               group: Sequence[str] = (), runs: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Outcome per detection and area range: `rank, tp_mask, fp_mask`.

    Bit i of a mask stands for the i-th threshold. `detections` has `image_id, category_id, det_id,
    score` and a box (null and NaN scores come last), `truths` has `image_id, category_id, gt_id, area, iscrowd` and a box; both
    carry the `group` columns (e.g. the raster). With `runs` (of detections and truths, each with the columns
    named here, its id, `line, c0, c1`) overlaps and the detections' areas are those of masks.
    """
    keys = [*group, "image_id", "category_id"]
    full = (1 << len(thresholds)) - 1
    settled = _match(detections, truths, keys, ranges, thresholds, max_dets, runs)
    each = F.array(*[F.struct(
        F.lit(name).alias("area_label"), F.col("tp")[i].alias("tp_mask"),
        F.when((F.col("size") >= float(lo)) & (F.col("size") <= float(hi)), F.lit(full).bitwiseXOR(F.col("hit")[i])).otherwise(0)
        .cast("long").alias("fp_mask")) for i, (name, (lo, hi)) in enumerate(ranges.items())])
    return settled.withColumn("_o", F.explode(each)).select(*keys, "det_id", "score", "rank", "_o.area_label", "_o.tp_mask", "_o.fp_mask")


def countable_truths(truths: DataFrame, ranges: dict[str, tuple[float, float]],
                     group: Sequence[str] = ()) -> DataFrame:
    """`npig`: truths per category and area range that are not ignored."""
    keys = [*group, "category_id"]
    spread = truths.withColumn("_r", F.explode(_range_table(ranges)))
    inside = (F.col("area") >= F.col("_r.lo")) & (F.col("area") <= F.col("_r.hi"))
    return spread.groupBy(*keys, F.col("_r.label").alias("area_label")).agg(
        F.count_if(inside & ~F.col("iscrowd")).alias("npig"))


def _chunks(keys: Sequence[str], limits: Sequence[int], n: int, most: int = _CHUNK):
    """From ranked detections sorted by key and score: `most` of a key in one row, its place, ranks and bits, and what they add
    up to under each limit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for b, group in whole_groups(batches, keys, 1 << 13):
            heads = np.flatnonzero(np.diff(group, prepend=-1))
            for h, e in zip(heads.tolist(), np.append(heads[1:], b.num_rows).tolist()):
                for start in range(h, e, most):
                    some = b.slice(start, min(most, e - start))
                    rank = np.asarray(some.column("rank")).astype("<i4")
                    if "bits" in b.schema.names:
                        bits = np.frombuffer(b"".join(some.column("bits").to_pylist()), np.uint8).reshape(len(rank), -1)
                        cells = np.unpackbits(bits, axis=1, count=2 * n, bitorder="little")
                    else:
                        cells = np.concatenate([np.asarray(some.column(c))[:, None] >> np.arange(n) & 1 for c in ("tp_mask", "fp_mask")], 1).astype(np.uint8)
                        bits = np.packbits(cells, axis=1, bitorder="little")
                    total = np.stack([cells[rank <= m].sum(0, dtype=np.int64) for m in limits])
                    yield pa.RecordBatch.from_arrays(
                        [*[b.column(k).slice(h, 1) for k in keys], pa.array([part], pa.int64()), pa.array([seq], pa.int64()),
                         pa.array([rank.tobytes() + bits.tobytes()], pa.binary()), pa.array([total.reshape(-1).tolist()], pa.list_(pa.int64()))],
                        names=[*keys, "_part", "_seq", "data", "total"])
                    seq += 1

    return run


def _started(keys: Sequence[str], limits: Sequence[int], n: int):
    """From the counts of a key's truths (`_seq` -1) and its chunks in order: chunks with these counts and what was added up before
    them. A key without truths has no curve, one without detections an empty chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, npig, upto = None, None, None
        for b in batches:
            if not b.num_rows:
                continue
            both = b if last is None else pa.Table.from_batches([last, b]).combine_chunks().to_batches()[0]
            new = changes(both, keys)[both.num_rows - b.num_rows:]
            new[0] |= last is None
            last = b.slice(b.num_rows - 1)
            counts, totals, seq = b.column("npig"), b.column("total"), np.asarray(b.column("_seq"))
            keep, before, wanted = [], [], []
            for i in range(b.num_rows):
                if new[i]:
                    npig, upto = None, np.zeros(len(limits) * 2 * n, np.int64)
                if seq[i] < 0:
                    npig = counts[i].as_py()
                if npig is None:
                    continue
                keep.append(i)
                before.append(upto.tolist())
                wanted.append(npig)
                if seq[i] >= 0:
                    upto = upto + np.asarray(totals[i].values)
            at = pa.array(keep, pa.int64())
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*[b.column(c).take(at) for c in (*keys, "_part", "_seq", "data")], pa.array(wanted, lists), pa.array(before, lists)],
                                             names=[*keys, "_part", "_seq", "data", "npig", "before"])

    return run


def _points(keys: Sequence[str], limits: Sequence[int], labels: int, steps: int):
    """The best precision of a chunk at each recall point that a hit reaches: `at` counts points of all limits, ranges and
    thresholds; `last` are the hits so far."""
    n, width = labels * steps, RECALL_STEPS + 1
    step = 1.0 / RECALL_STEPS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                data, npig = b.column("data")[i].as_py() or b"", np.array(b.column("npig")[i].as_py(), np.int64)
                before = np.array(b.column("before")[i].as_py(), np.int64).reshape(len(limits), 2, n)
                size = len(data) // (4 + _bytes(n))
                rank = np.frombuffer(data, "<i4", size)
                bits = np.frombuffer(data, np.uint8, size * _bytes(n), 4 * size).reshape(size, _bytes(n))
                cells = np.unpackbits(bits, axis=1, count=2 * n, bitorder="little").reshape(size, 2, n)
                best, last = np.zeros((len(limits), n, width)), before[:, 0].copy()
                for k, most in enumerate(limits):
                    some = cells[rank <= most] if size and rank.max() > most else cells
                    row, cell = np.nonzero(some[:, 0])
                    if not len(row):
                        continue
                    upto = np.cumsum(some, axis=0, dtype=np.int64) + before[k]
                    last[k] = upto[-1, 0]
                    known = npig[cell // steps] > 0
                    row, cell = row[known], cell[known]
                    tp, fp, total = upto[row, 0, cell], upto[row, 1, cell], npig[cell // steps]
                    recall, near = tp / total, np.floor(tp * RECALL_STEPS / total).astype(np.int64)
                    point = np.where((near + 1) * step <= recall, near + 1, np.where(near * step <= recall, near, near - 1))
                    np.maximum.at(best[k], (cell, np.minimum(point, RECALL_STEPS)), tp / (tp + fp))
                # Lower points take the best of the higher ones, so only what exceeds those is kept.
                higher = np.maximum.accumulate(best[..., ::-1], axis=-1)[..., ::-1]
                at = np.flatnonzero(best > np.concatenate([higher[..., 1:], np.zeros((len(limits), n, 1))], -1))
                rows.append((npig.tolist(), at.tolist(), best.reshape(-1)[at].tolist(), last.reshape(-1).tolist()))
            npig, at, best, last = zip(*rows) if rows else ((), (), (), ())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in keys], pa.array(npig, longs), pa.array(at, pa.list_(pa.int32())), pa.array(best, pa.list_(pa.float64())),
                 pa.array(last, longs)], names=[*keys, "npig", "at", "best", "last"])

    return run


def _drawn(keys: Sequence[str], limits: Sequence[int], labels: Sequence[str] | None, thresholds: Sequence[float]):
    """The curves of a key from its chunks' points, one chunk at a time. Without `labels` the key is that of one label."""
    steps, width, ranges = len(thresholds), RECALL_STEPS + 1, 1 if labels is None else len(labels)
    cells = len(limits) * ranges * steps

    def curves(first: pa.RecordBatch, npig: np.ndarray, best: np.ndarray, tp: np.ndarray) -> pa.RecordBatch:
        m, k, t = (v.reshape(-1) for v in np.indices((len(limits), ranges, steps)))
        total = npig[k]
        curve = np.maximum.accumulate(best.reshape(cells, width)[:, ::-1], axis=1)[:, ::-1]
        curve = np.where(total[:, None] == 0, -1.0, curve)
        recall = np.divide(tp, total, out=np.full(cells, -1.0), where=total != 0)
        flat = pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(curve).reshape(-1)), width).cast(pa.list_(pa.float64()))
        here = pa.array(np.zeros(cells, np.int64))
        names = [] if labels is None else [pa.array([labels[i] for i in k.tolist()], pa.string())]
        return pa.RecordBatch.from_arrays(
            [*[first.column(c).take(here) for c in keys], *names, pa.array(np.array(limits, np.int32)[m]), pa.array(np.array(thresholds, float)[t]),
             pa.array(total), flat, pa.array(recall)], names=[*keys, *(["area_label"] if names else []), "max_dets", "iou_threshold", "npig", "precision", "recall"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = npig = best = tp = None
        for b in batches:
            if not b.num_rows:
                continue
            both = b if last is None else pa.Table.from_batches([last, b]).combine_chunks().to_batches()[0]
            new = changes(both, keys)[both.num_rows - b.num_rows:]
            new[0] |= last is None
            for i in range(b.num_rows):
                if new[i]:
                    if last is not None:
                        yield curves(last, npig, best, tp)
                    npig, best, tp = np.array(b.column("npig")[i].as_py(), np.int64), np.zeros(cells * width), np.zeros(cells, np.int64)
                at = np.asarray(b.column("at")[i].values)
                best[at] = np.maximum(best[at], np.asarray(b.column("best")[i].values))
                tp = np.maximum(tp, np.asarray(b.column("last")[i].values))
                last = b.slice(i, 1)
        if last is not None:
            yield curves(last, npig, best, tp)

    return run


def _curves(rows: DataFrame, npig: DataFrame, keys: Sequence[str], max_dets: Sequence[int], thresholds: Sequence[float],
            labels: Sequence[str]) -> DataFrame:
    """`coco_accumulate` from ranked detections with their hits and misses, as `bits` of all `labels` or as `tp_mask` and `fp_mask` of
    one; `npig` has the keys and an array with a count per label.

    A key may end in `area_label`, then there is one label. A key's detections are sorted by range, so no task holds all of a large key, and packed in chunks. Chunks start from what
    those before them add up to, which is one short row each, and leave at most one number per recall point.
    """
    keys, limits, n = list(keys), sorted({int(m) for m in max_dets}), len(labels) * len(thresholds)
    steps = np.array(thresholds, dtype=float)
    order = [*keys, F.col("score").desc(), "image_id", "rank", "det_id"]
    bits = ["bits"] if "bits" in rows.columns else ["tp_mask", "fp_mask"]
    rows = rows.dropna(subset=keys).select(*keys, "score", "image_id", "rank", "det_id", *bits)
    longs, named = T.ArrayType(T.LongType()), [rows.schema[k] for k in keys]
    place = [T.StructField("_part", T.LongType()), T.StructField("_seq", T.LongType()), T.StructField("data", T.BinaryType())]
    chunks = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunks(keys, limits, n), T.StructType([*named, *place, T.StructField("total", longs)]))
    known = npig.select(*keys, "npig", F.lit(-1).cast("long").alias("_part"), F.lit(-1).cast("long").alias("_seq"))
    both = chunks.unionByName(known, allowMissingColumns=True).repartition(*keys).sortWithinPartitions(*keys, "_part", "_seq")
    started = both.mapInArrow(_started(keys, limits, n), T.StructType([*named, *place, T.StructField("npig", longs), T.StructField("before", longs)]))
    points = started.repartition(*keys, "_part", "_seq").mapInArrow(_points(keys, limits, len(labels), len(steps)), T.StructType([
        *named, T.StructField("npig", longs), T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("best", T.ArrayType(T.DoubleType())),
        T.StructField("last", longs)]))
    label = [] if "area_label" in keys else [T.StructField("area_label", T.StringType())]
    schema = [*named, *label, T.StructField("max_dets", T.IntegerType()), T.StructField("iou_threshold", T.DoubleType()),
              T.StructField("npig", T.LongType()), T.StructField("precision", T.ArrayType(T.DoubleType())), T.StructField("recall", T.DoubleType())]
    return points.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        _drawn(keys, limits, labels if label else None, steps.tolist()), T.StructType(schema))


def coco_accumulate(outcomes: DataFrame, npig: DataFrame, max_dets: Sequence[int],
                    thresholds: Sequence[float] = IOU_THRESHOLDS,
                    group: Sequence[str] = ()) -> DataFrame:
    """Precision at 101 recall points and final recall per category, range, limit and threshold.

    `precision` is an array, -1 everywhere when nothing countable exists; then `recall` is -1 too.
    """
    rows = outcomes.filter((F.col("tp_mask") != 0) | (F.col("fp_mask") != 0))
    counts = npig.withColumn("npig", F.array("npig"))
    return _curves(rows, counts, [*group, "category_id", "area_label"], max_dets, thresholds, ["any"])


def coco_summary(accumulated: DataFrame, max_dets: Sequence[int], labels: Sequence[str],
                 group: Sequence[str] = ()) -> DataFrame:
    """AP and AR values in one row per group; -1 where nothing could be measured."""
    top = max(max_dets)
    ap = F.aggregate("precision", F.lit(0.0), lambda s, v: s + v) / (RECALL_STEPS + 1)
    table = accumulated.withColumn("_ap", F.when(F.col("npig") > 0, ap)).withColumn(
        "_ar", F.when(F.col("npig") > 0, F.col("recall")))

    def mean(value, label="all", iou=None, limit=top):
        wanted = (F.col("area_label") == label) & (F.col("max_dets") == limit)
        if iou is not None:
            wanted = wanted & (F.abs(F.col("iou_threshold") - iou) < 1e-9)
        return F.coalesce(F.avg(F.when(wanted, F.col(value))), F.lit(-1.0))

    sizes = [label for label in labels if label != "all"]
    aggs = [mean("_ap").alias("AP"), mean("_ap", iou=0.5).alias("AP50"),
            mean("_ap", iou=0.75).alias("AP75")]
    aggs += [mean("_ap", label).alias(f"AP_{label}") for label in sizes]
    aggs += [mean("_ar", limit=m).alias(f"AR_{m}") for m in sorted(set(max_dets))]
    aggs += [mean("_ar", iou=0.5).alias("AR50"), mean("_ar", iou=0.75).alias("AR75")]
    aggs += [mean("_ar", label).alias(f"AR_{label}") for label in sizes]
    aggs += [mean("_ar").alias("AR")]
    return table.groupBy(*group).agg(*aggs)


def align_by_file_name(truth_images: DataFrame, pred_images: DataFrame,
                       pred_annotations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Predictions re-keyed to the truth's image ids by file name.

    Truth images without predictions stay as empty images; prediction-only images are dropped with
    their annotations.
    """
    have = pred_images.select("file_name", F.col("id").alias("_old"),
                              F.col("width").alias("_w"), F.col("height").alias("_h"))
    both = truth_images.select("id", "file_name", "width", "height").join(have, "file_name", "left")
    images = both.select("id", "file_name", F.coalesce("_w", "width").alias("width"),
                         F.coalesce("_h", "height").alias("height"))
    ids = both.filter("_old is not null").select(F.col("_old").alias("image_id"), "id")
    moved = pred_annotations.withColumnRenamed("id", "_ann").join(ids, "image_id")
    moved = moved.withColumn("image_id", F.col("id")).drop("id").withColumnRenamed("_ann", "id")
    return images, moved.select(*pred_annotations.columns)


def tile_level(detections: DataFrame, truths: DataFrame, max_dets: Sequence[int],
               gsd: float | None = None, thresholds: Sequence[float] = IOU_THRESHOLDS,
               group: Sequence[str] = (), units: DataFrame | None = None,
               unit_key: str = "product_id", images: DataFrame | None = None,
               runs: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """All steps from boxes to the summary row, with the three counts. Truth scores are ignored.

    `images` (the `group` columns or `unit_key`, and `image_id`) are the images of the truth document, by
    default those of the truths: predictions on other images don't count, and images without truths do. A
    group without countable truths has -1 everywhere. `runs` as in `coco_match`.

    With `units` (`unit_key` and the `group` columns, any number of rows per key) images are matched
    once per `unit_key` and counted in every group their key belongs to.
    """
    ranges = ranges_for(gsd)
    group = list(group)
    base = group if units is None else [unit_key]
    keys, shape = [*base, "image_id", "category_id"], [] if runs else list(B.BOX)
    truths = cut(truths.select(*keys, "gt_id", *shape, "area", "iscrowd"), "truths")
    images = cut((truths if images is None else images).select(*base, "image_id").distinct(), "images")
    detections = cut(detections.select(*keys, "det_id", "score", *shape).join(images, [*base, "image_id"], "left_semi"), "detections")
    outcomes = _match(detections, truths, keys, ranges, thresholds, max(max_dets), runs, packed=True)
    outcomes = cut(outcomes.select(*keys, "det_id", "score", "rank", "bits"), "outcomes")
    if units is not None:
        outcomes, truths, detections, images = (
            df.join(units, unit_key) for df in (outcomes, truths, detections, images))
    inside = [(F.col("area") >= float(lo)) & (F.col("area") <= float(hi)) & ~F.col("iscrowd") for lo, hi in ranges.values()]
    npig = truths.groupBy(*group, "category_id").agg(F.array(*[F.count_if(i) for i in inside]).alias("npig"))
    acc = _curves(outcomes, npig, [*group, "category_id"], max_dets, thresholds, list(ranges))
    summary = coco_summary(acc, max_dets, list(ranges), group)
    n_image = images.groupBy(*group).agg(F.count(F.lit(1)).alias("num_images"))
    n_truth = truths.groupBy(*group).agg(F.count(F.lit(1)).alias("num_truths"))
    n_pred = detections.groupBy(*group).agg(F.count(F.lit(1)).alias("num_preds"))
    on = group
    if not group:
        on = ["_one"]
        summary, n_image, n_truth, n_pred = (
            df.withColumn("_one", F.lit(1)) for df in (summary, n_image, n_truth, n_pred))
    values = [c for c in summary.columns if c not in on]
    return (n_image.join(n_truth, on, "left").join(n_pred, on, "left")
            .fillna(0, ["num_truths", "num_preds"]).join(summary, on, "left")
            .fillna(-1.0, values).select(*group, *values, "num_images", "num_truths", "num_preds"))
