"""Search of suppression thresholds: all (IoU, score) pairs over all rasters in one plan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownframe.functions import boxes as B
from crownframe.functions.ranks import at_least, ranked_score, tie_of
from crownframe.operators import metrics
from crownframe.operators.masks import FEW_RUNS, RUN, coded_runs, count_runs
from crownframe.operators.matching import BITS, HELD, TAIL_PAIRS, WHOLE_KEY, candidate_pairs, first_come, match_bits, run_pairs
from crownframe.operators.numbering import by_size, of_keys
from crownframe.operators.suppression import box_overlaps, id_codes, nms_masks, ranked_rows, run_overlaps, swept
from crownframe.plans.raster_level import KEY, prepare
from crownframe.session import cut

# Default grid 0.05, 0.10, ..., 1.00 for both thresholds.
DEFAULT_GRID = tuple(round(0.05 * i, 2) for i in range(1, 21))


def _searched(ious: Sequence[float], steps: Sequence[float], floors: Sequence[float], gsd: float, masks: bool):
    """Both steps over one raster: how many (`n`) matched (`bit` s * number of `ious` + i) and kept (after all those) predictions lie in
    each score band. Matching has boxes in pixels, as everywhere."""
    below, levels = [t for t in ious if t < 1], np.array(steps, dtype=float)
    first, always = (1 << len(below)) - 1, sum(1 << i for i, t in enumerate(ious) if t >= 1)
    bits, bands = len(ious) * len(steps), len(floors) + 1

    def settle(table: pa.Table) -> pa.Table:
        b = table.combine_chunks().to_batches()[0]
        side = np.asarray(b.column("_side"))
        code = id_codes(b.column("id"))
        own = ~np.asarray(b.column("at").is_valid()) if masks else np.ones(b.num_rows, bool)
        p = ranked_rows(b, np.flatnonzero(own & (side == 1)), code)
        t = np.flatnonzero(own & (side == 0))
        t = t[np.argsort(code[t], kind="stable")]
        both = np.concatenate([p, t])
        if masks:
            near = meet = run_overlaps(b, both, code * 2 + side)
        else:
            box = np.stack([np.asarray(b.column(c).fill_null(np.nan)) for c in B.BOX], 1)[both]
            low = [np.nanmin(box[:, k]) if not np.isnan(box[:, k]).all() else np.nan for k in (0, 1)] if len(box) else [0.0, 0.0]
            near, meet = box_overlaps(box), box_overlaps((box - np.array([*low, *low])) / gsd)
        mask = np.full(len(p), first, np.int64)
        mask = (swept(mask, below, near) if below else mask) | always
        band = np.searchsorted(floors, np.asarray(b.column("score").take(pa.array(p))), "right")
        count = np.zeros((bits + len(ious), bands), np.int64)
        for i in range(len(ious)):
            count[bits + i] = np.bincount(band[mask >> i & 1 == 1], minlength=bands)
        truths, todo, used = len(p) + np.arange(len(t)), {}, {}
        step = max(HELD // max(len(t), 1), 1)
        for start in range(0, len(p), step):
            mine = start + np.flatnonzero(mask[start:start + step])
            found = [(i[v >= levels[0]], j[v >= levels[0]], v[v >= levels[0]]) for i, j, v in meet(mine, truths)]
            if not found:
                continue
            i, j, value = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((j, -value, i))
            i, j, value = i[order], j[order], value[order]
            all_bits = sum(np.where(value >= s, mask[i] << k * len(ious), 0) for k, s in enumerate(levels))
            rows, won = first_come(i.tolist(), j.tolist(), all_bits.tolist(), todo, used)
            at, won = band[i[rows]], np.array(won, np.int64)
            for k in range(bits):
                count[k] += np.bincount(at[won >> k & 1 == 1], minlength=bands)
        bit, place = np.nonzero(count)
        return pa.table([b.column(KEY).take(pa.array(np.zeros(len(bit), np.int64))), pa.array(bit.astype(np.int32)), pa.array(place.astype(np.int32)),
                         pa.array(count[bit, place])], names=[KEY, "bit", "_band", "_n"])

    return settle


def _rows(strong: DataFrame, truths: DataFrame, score: str, runs: tuple[DataFrame, DataFrame] | None) -> DataFrame:
    """Predictions (`_side` 1) and truths (0) of the rasters, and rows with their runs (`at`) if they are masks."""
    shape = [] if runs else [F.col(c).cast("double").alias(c) for c in B.BOX]
    rows = strong.dropna(subset=["object_id"]).select(
        KEY, F.lit(1).alias("_side"), F.col("object_id").alias("id"), ranked_score(F.col(score)).alias("score"), tie_of(F.col("object_id")).alias("tie"), *shape)
    rows = rows.unionByName(truths.select(KEY, F.lit(0).alias("_side"), F.col("truth_id").alias("id"), *shape), allowMissingColumns=True)
    for side, ident in ((1, "object_id"), (0, "truth_id")) if runs else ():
        coded = coded_runs(runs[1 - side].select(KEY, F.col(ident).alias("id"), *RUN), [KEY, "id"])
        rows = rows.unionByName(coded.withColumn("_side", F.lit(side)), allowMissingColumns=True)
    return cut(rows.dropna(subset=[KEY]), "rasters")


def _search_pairs(predictions: DataFrame, strong: DataFrame, truths: DataFrame, runs: tuple[DataFrame, DataFrame] | None, gsd: float,
                  ious: Sequence[float], scores: Sequence[float], steps: Sequence[float], aoi: DataFrame | None, score: str,
                  tail_pairs: int) -> tuple[DataFrame, DataFrame]:
    """The counts of `_searched` for rasters of any size, and the rasters with their number of truths."""
    kept, ious = nms_masks(predictions, ious, scores[0], score, keys=[KEY], runs=runs[0] if runs else None)
    kept = cut(kept, "kept")
    # The score column keeps its name through the AOI filter; ids of cut objects may change there.
    strong = strong.withColumn("_source_id", F.col("object_id"))
    p, t = prepare(strong, truths, gsd, aoi)
    p, t = cut(p, "predictions"), cut(t, "truths")
    seen = p.select(KEY, "object_id", F.col("_source_id"), F.col(score).alias("score")).join(
        kept.select(KEY, F.col("object_id").alias("_source_id"), "mask"), [KEY, "_source_id"])
    seen = cut(seen.select(KEY, "object_id", "score", "mask"), "seen")
    pairs = (run_pairs(p, t, *runs, score, [KEY], least_iou=steps[0]) if runs else
             candidate_pairs(p, t, score, [KEY], least_iou=steps[0]))
    pairs = pairs.join(seen.select(KEY, F.col("object_id").alias("pred"), "mask"), [KEY, "pred"])
    n = len(ious)
    # Bit s * n + i: the pair counts at the s-th matching threshold, and the prediction stays at the i-th of suppression.
    bits = sum((F.when(F.col("iou") >= t, F.col("mask") * (1 << s * n)).otherwise(F.lit(0)).cast("long") for s, t in enumerate(steps)),
               F.lit(0).cast("long"))
    pairs = pairs.withColumns({"bits": bits, "pred_rank": tie_of(F.col("pred"))})
    hits = match_bits(pairs, [KEY], n * len(steps), tail_pairs=tail_pairs).select(KEY, F.col("bit").cast("int").alias("bit"), "score")
    each = F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.call_function("shiftright", F.col("mask"), i) % 2 != 0)
    band = F.size(F.filter(F.array(*[F.lit(v) for v in scores]), lambda v: v <= F.col("score"))).alias("_band")
    tp = hits.groupBy(KEY, "bit", band).agg(F.count(F.lit(1)).alias("_n"))
    # Counted by mask first: far fewer rows are spread over the thresholds.
    banded = seen.groupBy(KEY, "mask", band).agg(F.count(F.lit(1)).alias("_n"))
    n_pred = banded.withColumn("bit", F.explode(F.transform(each, lambda i: i + n * len(steps)))).groupBy(KEY, "bit", "_band").agg(F.sum("_n").alias("_n"))
    n_true = t.groupBy(KEY).agg(F.count(F.lit(1)).alias("num_truths"))
    rasters = n_true.join(p.select(KEY).distinct(), KEY, "full").fillna(0, ["num_truths"])
    return tp.unionByName(n_pred), rasters


def nms_grid_search(predictions: DataFrame, truths: DataFrame, gsd: float,
                    nms_ious: Sequence[float] = DEFAULT_GRID,
                    nms_scores: Sequence[float] = DEFAULT_GRID,
                    eval_thresholds: Sequence[float] = (0.5,), aoi: DataFrame | None = None,
                    score_col: str | None = None, tail_pairs: int = TAIL_PAIRS,
                    runs: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Precision, recall, f1 (means over `eval_thresholds`) per raster and pair of thresholds.

    Both suppression and matching go through the boxes by descending score and judge a box only by
    stronger ones. So the result for a score threshold is the part of the result for the lowest one
    that lies above it: the score axis costs one count per score band instead of one run per value.
    Overlaps among predictions and with truths are each measured once. With `runs` (of predictions and
    truths) both are those of the masks; an AOI then cuts the boxes only, so it isn't taken.
    """
    if runs and aoi is not None:
        raise ValueError("an AOI can't be given together with masks")
    score = score_col or metrics.pick_score(predictions)
    ious, scores = sorted({float(v) for v in nms_ious}), sorted({float(v) for v in nms_scores})
    steps = sorted({float(t) for t in eval_thresholds})
    if len(steps) > BITS:
        raise ValueError(f"at most {BITS} evaluation thresholds")
    if len(ious) * len(steps) > BITS:       # neither axis of thresholds changes what another value gives
        parts = [nms_grid_search(predictions, truths, gsd, ious[k:k + max(BITS // len(steps), 1)], scores, steps, aoi, score, tail_pairs, runs)
                 for k in range(0, len(ious), max(BITS // len(steps), 1))]
        return reduce(DataFrame.unionByName, parts)
    strong = predictions.filter(at_least(F.col(score), scores[0]))
    few = many = None
    if aoi is None and steps[0] > 0 and tail_pairs > 0:
        rows = _rows(strong, truths, score, runs)
        few, many = by_size([rows], [KEY], min(FEW_RUNS if runs else WHOLE_KEY, tail_pairs), count_runs("at") if runs else None)
    parts = []
    if few is not None:
        mine = of_keys(rows, [KEY], few, many)
        schema = T.StructType([rows.schema[KEY], T.StructField("bit", T.IntegerType()), T.StructField("_band", T.IntegerType()), T.StructField("_n", T.LongType())])
        found = mine.groupBy(KEY).applyInArrow(_searched(ious, steps, scores, gsd, bool(runs)), schema)
        there = (mine.filter("at is null") if runs else mine).groupBy(KEY).agg(F.count_if(F.col("_side") == 0).alias("num_truths"))
        parts.append((cut(found, "counts"), there))
    if few is None or many is not None:
        large = [df if many is None else df.join(many, KEY, "left_semi") for df in (predictions, strong, truths, *(runs or ()))]
        parts.append(_search_pairs(*large[:3], tuple(large[3:]) or None, gsd, ious, scores, steps, aoi, score, tail_pairs))
    counts, rasters = (reduce(DataFrame.unionByName, x) for x in zip(*parts))
    floors, levels, nms_levels = (F.array(*[F.lit(v) for v in x]) for x in (scores, steps, ious))
    n = len(ious)
    # Rows at or above each score threshold, from counts per score band.
    spread = counts.withColumn("nms_score", F.explode(F.slice(floors, F.lit(1), F.col("_band")))).groupBy(
        KEY, "bit", "nms_score").agg(F.sum("_n").alias("_n"))
    named = spread.withColumn("nms_iou", F.element_at(nms_levels, (F.col("bit") % n + 1).cast("int")))
    run = ["nms_iou", KEY, "iou_threshold"]
    tp = named.filter(F.col("bit") < n * len(steps)).select(
        KEY, "nms_iou", F.element_at(levels, F.floor(F.col("bit") / n + 1).cast("int")).alias("iou_threshold"), "nms_score", F.col("_n").alias("tp"))
    n_pred = named.filter(F.col("bit") >= n * len(steps)).select(KEY, "nms_iou", "nms_score", F.col("_n").alias("num_preds"))
    frame = (rasters.withColumn("nms_iou", F.explode(F.array(*[F.lit(v) for v in ious])))
             .withColumn("nms_score", F.explode(floors))
             .join(n_pred, ["nms_iou", KEY, "nms_score"], "left")
             .withColumn("iou_threshold", F.explode(levels))
             .join(tp, [*run, "nms_score"], "left").fillna(0, ["num_preds", "tp"]))
    counted = metrics.with_prf1(frame.withColumns({
        "fp": F.col("num_preds") - F.col("tp"), "fn": F.col("num_truths") - F.col("tp")}))
    return counted.groupBy(KEY, "nms_iou", "nms_score").agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"), F.max("num_truths").alias("num_truths"),
        F.max("num_preds").alias("num_preds")).withColumn("num_images", F.lit(1)).withColumn(
        "raster_name", F.col(KEY).cast("string")).drop(KEY)


def search_with_average(predictions: DataFrame, truths: DataFrame, gsd: float,
                        **options) -> DataFrame:
    """The search table with its `average_over_rasters` rows."""
    return metrics.avg_by_params(nms_grid_search(predictions, truths, gsd, **options))


def optimal_thresholds(results: DataFrame) -> DataFrame:
    """The best pair of thresholds: one row with `nms_iou, nms_score, f1`."""
    return metrics.best_params(results).select("nms_iou", "nms_score", "f1")
