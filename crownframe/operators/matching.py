"""One-to-one matching of predictions and truths in rounds.

Sequentially every prediction, strongest first, takes its best truth that is still free. Here a
round lets each open prediction point at its best free truth and commits the pair when no stronger
open prediction could still want that truth. Whatever the others do later, the sequential rule
would make the same pair, so both agree row by row. The strongest open prediction always commits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from crownframe.functions import boxes as B
from crownframe.functions import sweep
from crownframe.functions.batches import whole_groups
from crownframe.functions.polygons import clipped_inter_area, iou_from
from crownframe.functions.ranks import ranked_score, tie_of
from crownframe.operators.box_pairs import iou, overlapping
from crownframe.operators.masks import mask_pairs
from crownframe.operators.numbering import by_size, of_keys
from crownframe.operators.spatial_join import bbox_join
from crownframe.session import cut, on_file, release

#: Candidate pairs of one key few enough to be finished in a task, after some rounds; the result is the same.
TAIL_PAIRS, TAIL_AFTER = 200_000, 0
#: Boxes of one key few enough to be matched in a task, without a table of pairs; overlaps held there at a time; bits of a long.
WHOLE_KEY, HELD, BITS = 20_000, 1 << 21, 62
#: Added to the union where prompts are matched.
EPSILON = 1e-6
#: How far a bound on a polygons' IoU may be off: areas are sums of rounded parts.
ROUNDING = 1e-6
#: Numbers of a polygon that count as one box, and boxes' worth of polygons swept together.
POINTS, SWEPT = 64, 1 << 15


def _finish(keys: Sequence[str]):
    """The sequential rule over one key's candidate pairs; at most `tail_pairs` rows."""
    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(
            ["score", "pred_rank", "pred", "tier", "iou", "truth_rank", "truth"],
            ascending=[False, True, True, True, False, True, True], kind="stable")
        used, done, rows = set(), set(), []
        for i, (pred, truth, shared) in enumerate(zip(frame["pred"], frame["truth"], frame["shared"])):
            if pred in done or (not shared and truth in used):
                continue
            done.add(pred)
            if not shared:
                used.add(truth)
            rows.append(i)
        return frame.iloc[rows][[*keys, "pred", "truth", "iou", "tier", "score"]]

    return settle


def match_rounds(candidates: DataFrame, keys: Sequence[str],
                 tail_pairs: int = TAIL_PAIRS, tail_after: int = TAIL_AFTER) -> DataFrame:
    """Matches `(keys, pred, truth, iou, tier, score)` from candidate pairs.

    `candidates` has `keys, pred, score, truth, iou` and may have
    `pred_rank` (order among equal scores, lower first, default the prediction's id),
    `tier` (lower is preferred before IoU is looked at, default 0),
    `truth_rank` (order among equal IoU, lower first, default the truth id) and
    `shared` (the truth may be taken any number of times, default false).
    Null and NaN scores come last. After `tail_after` rounds each key with at most `tail_pairs` open pairs is
    finished in one task; larger keys go on in rounds.
    """
    keys = list(keys)
    for name, default in (("tier", F.lit(0)), ("truth_rank", F.col("truth").cast("long")),
                          ("shared", F.lit(False)), ("pred_rank", F.col("pred").cast("long"))):
        if name not in candidates.columns:
            candidates = candidates.withColumn(name, default)
    candidates = candidates.withColumn("score", ranked_score(F.col("score")))
    columns = [*keys, "pred", "score", "pred_rank", "truth", "iou", "tier", "truth_rank", "shared"]
    live = cut(candidates.select(*columns), "candidates")
    out = [*keys, "pred", "truth", "iou", "tier", "score"]
    schema = live.select(*out).schema
    found: list[DataFrame] = []
    rounds = 0
    while not live.isEmpty():
        if rounds >= tail_after and keys:
            few = cut(live.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                      .filter(F.col("_n") <= tail_pairs).select(*keys), "few")
            if not few.isEmpty():
                ends = live.join(few, keys, "left_semi").groupBy(*keys).applyInPandas(_finish(keys), schema)
                found.append(cut(ends, "matches"))
                old, live = live, cut(live.join(few, keys, "left_anti"), "candidates")
                release(old, few)
                continue
        wish = live.groupBy(*keys, "pred").agg(
            F.min(F.struct("tier", (-F.col("iou")).alias("i"), "truth_rank", "truth", "shared",
                           "score")).alias("_w"))
        wish = wish.select(*keys, "pred", F.col("_w.truth").alias("truth"),
                           (-F.col("_w.i")).alias("iou"), F.col("_w.tier").alias("tier"),
                           F.col("_w.shared").alias("shared"), F.col("_w.score").alias("score"))
        first = live.filter(~F.col("shared")).groupBy(*keys, "truth").agg(
            F.min(F.struct((-F.col("score")).alias("s"), F.col("pred_rank").alias("r"),
                           F.col("pred").alias("p"))).alias("_f"))
        ahead = first.select(*keys, "truth", F.col("_f.p").alias("pred"))
        sole = wish.filter(~F.col("shared")).join(ahead, [*keys, "truth", "pred"])
        won = cut(sole.select(*out, "shared").unionByName(wish.filter("shared").select(*out, "shared")), "matches")
        found.append(won.drop("shared"))
        rest = live.join(won.select(*keys, "pred"), [*keys, "pred"], "left_anti").join(
            won.filter(~F.col("shared")).select(*keys, "truth"), [*keys, "truth"], "left_anti")
        old, live = live, cut(rest.select(*columns), "candidates")
        release(old)
        rounds += 1
    if not found:
        return live.select(*out)
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    return union


def first_come(pred: list, truth: list, bits: list, todo: dict, used: dict) -> tuple[list[int], list[int]]:
    """The sequential rule over pairs in their order, for every bit at once: positions that win, and the bits they win."""
    rows, won = [], []
    for i, (p, t, b) in enumerate(zip(pred, truth, bits)):
        if got := b & ~todo.get(p, 0) & ~used.get(t, 0):
            todo[p], used[t] = todo.get(p, 0) | got, used.get(t, 0) | got
            rows.append(i)
            won.append(got)
    return rows, won


def _finish_bits(keys: Sequence[str]):
    """The sequential rule over one key's pairs; at most `tail_pairs` rows."""
    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["score", "pred_rank", "pred", "iou", "truth"],
                                  ascending=[False, True, True, False, True], kind="stable", ignore_index=True)
        rows, won = first_come(frame["pred"].tolist(), frame["truth"].tolist(), frame["bits"].tolist(), {}, {})
        return frame.loc[rows, [*keys, "pred", "truth", "iou", "score", "label"]].assign(bits=np.array(won, dtype=np.int64))

    return settle


def _each_bit(df: DataFrame, n: int, plain: int) -> DataFrame:
    """A row per set bit: `bit` in place of `bits`. The label is `all` for the first `plain` bits."""
    set_ = F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.call_function("shiftright", F.col("bits"), i) % 2 != 0)
    own = F.when(F.col("bit") < plain, F.lit("all")).otherwise(F.col("label"))
    return df.withColumn("bit", F.explode(set_)).drop("bits").withColumn("label", own)


def match_bits(pairs: DataFrame, keys: Sequence[str], n: int, plain: int | None = None,
               tail_pairs: int = TAIL_PAIRS) -> DataFrame:
    """Matches `(keys, bit, label, pred, truth, iou, score)` of `n` independent matchings over the same pairs.

    `pairs` has `keys, pred, score, pred_rank, truth, iou` and `bits`, the matchings a pair takes part in. In those after the
    first `plain` each `label` is matched for itself, and a pair has one. A key with at most `tail_pairs` pairs is settled in
    one task, for all matchings at once; larger ones go in rounds.
    """
    keys, plain = list(keys), n if plain is None else plain
    label = F.col("label") if "label" in pairs.columns else F.lit("all")
    pairs = cut(pairs.select(*keys, "pred", F.col("score").cast("double").alias("score"), "pred_rank", "truth", "iou", "bits",
                             label.alias("label")), "candidates")
    out = [*keys, "bit", "label", "pred", "truth", "iou", "score"]
    few, many = by_size([pairs], keys, tail_pairs) if keys else (None, None)
    parts = []
    if few is not None:
        schema = pairs.select(*keys, "pred", "truth", "iou", "score", "label", "bits").schema
        done = of_keys(pairs, keys, few, many).groupBy(*keys).applyInPandas(_finish_bits(keys), schema)
        parts.append(_each_bit(done, n, plain).select(*out))
    if many is not None or few is None:
        large = pairs if many is None else of_keys(pairs, keys, many, few)
        parts.append(match_rounds(_each_bit(large, n, plain), [*keys, "bit", "label"], tail_pairs).select(*out))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _matched(p: pd.DataFrame, t: pd.DataFrame, keys: Sequence[str], levels: np.ndarray, measure) -> pd.DataFrame:
    """The sequential rule over the boxes of one key, strongest first, as many at a time as bound the pairs held.

    `measure(p, t, i, j)` is the IoU of rows `i` of p and `j` of t, whose boxes overlap.
    """
    p = p.sort_values(["score", "pred_rank", "id"], ascending=[False, True, True], kind="stable", ignore_index=True)
    t = t.sort_values("id", kind="stable", ignore_index=True)
    a, b = (df[list(B.BOX)].to_numpy(dtype=float) for df in (p, t))
    pred, truth = p["id"].to_numpy(), t["id"].to_numpy()
    names = {v: k for k, v in enumerate(pd.unique(pd.concat([p["label"], t["label"]]).dropna()))}
    label_a, label_b = (df["label"].map(names).fillna(miss).to_numpy(dtype=np.int64) for df, miss in ((p, -1), (t, -2)))
    todo, used, found = {}, {}, []
    step = max(HELD // max(len(b), 1), 1)
    for start in range(0, len(a), step):
        parts = []
        for i, j in overlapping(a[start:start + step], b):
            i = start + i
            value = measure(p, t, i, j)
            near = value >= levels[0]
            parts.append((i[near], j[near], value[near]))
        if not parts:
            continue
        i, j, value = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((j, -value, i))
        i, j, value = i[order], j[order], value[order]
        bits = (np.int64(1) << np.searchsorted(levels, value, "right")) - 1
        bits |= np.where(label_a[i] == label_b[j], bits << len(levels), 0)
        rows, won = first_come(pred[i].tolist(), truth[j].tolist(), bits.tolist(), todo, used)
        found.append(pd.DataFrame({**{k: p[k].to_numpy()[i[rows]] for k in keys}, "pred": pred[i[rows]], "truth": truth[j[rows]],
                                   "iou": value[rows], "label": p["label"].to_numpy()[i[rows]], "bits": np.array(won, dtype=np.int64)}))
    empty = pd.DataFrame({c: [] for c in (*keys, "pred", "truth", "iou", "label", "bits")})
    return pd.concat(found, ignore_index=True) if found else empty


def _match_boxes(keys: Sequence[str], steps: Sequence[float]):
    def settle(p: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        return _matched(p, t, keys, np.array(steps, dtype=float),
                        lambda p, t, i, j: iou(p[list(B.BOX)].to_numpy(dtype=float)[i], t[list(B.BOX)].to_numpy(dtype=float)[j]))

    return settle


def _match_shapes(keys: Sequence[str], steps: Sequence[float], kind: pa.Schema):
    """`_match_boxes` by polygons (`shape`, `clip`, `size`): boxes find the pairs, and those that can't reach the least step
    end before they are swept."""
    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        sides = [left, right]
        shapes = [[x.column(c).combine_chunks() for c in ("shape", "clip")] for x in sides]
        weights = [np.asarray(x.column("weight")) for x in sides]
        p, t = (x.drop_columns(["shape", "clip"]).to_pandas().assign(at=np.arange(x.num_rows)) for x in sides)

        def measure(p, t, i, j):
            size = [df["size"].to_numpy(dtype=float)[k] for df, k in ((p, i), (t, j))]
            a, b = (df[list(B.BOX)].to_numpy(dtype=float)[k] for df, k in ((p, i), (t, j)))
            both = np.maximum(np.minimum(a[:, 2:], b[:, 2:]) - np.maximum(a[:, :2], b[:, :2]), 0).prod(1)
            near = np.flatnonzero(_ratio(np.minimum(both, np.minimum(*size)), *size) >= steps[0] * (1 - ROUNDING) - ROUNDING)
            at = [df["at"].to_numpy()[k[near]] for df, k in ((p, i), (t, j))]
            value = np.full(len(i), -1.0)
            held = np.cumsum(weights[0][at[0]] + weights[1][at[1]])
            start = 0
            while start < len(near):
                stop = max(start + 1, int(np.searchsorted(held, (held[start - 1] if start else 0) + SWEPT, "right")))
                k, l = (pa.array(x[start:stop]) for x in at)
                inter = sweep.shared_areas(stop - start, [shapes[0][0].take(k), shapes[1][0].take(l), shapes[0][1].take(k),
                                                          shapes[1][1].take(l)], optional=(2, 3))
                some = near[start:stop]
                value[some] = _ratio(inter, size[0][some], size[1][some])
                start = stop
            return value

        found = _matched(p, t, keys, np.array(steps, dtype=float), measure)
        return pa.Table.from_pandas(found, schema=kind, preserve_index=False)

    return settle


def _ratio(inter: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`iou_from` on arrays."""
    union = a + b - inter
    return np.where(union > 0, inter / np.where(union > 0, union, 1), 0.0)


def _whole_keys(predictions: DataFrame, truths: DataFrame, keys: Sequence[str], score_col: str, steps: Sequence[float],
                size_col: str | None, pred_id: str, truth_id: str, most: int,
                shape_cols: Sequence[str] = ()) -> tuple[DataFrame | None, DataFrame | None]:
    """Matches `(keys, pred, truth, iou, label, bits)` of the keys with at most `most` boxes, and the larger keys.

    A polygon counts as a box for every `POINTS` numbers it and its clip ring have.
    """
    label = F.col(size_col) if size_col else F.lit(None)
    numbers = lambda c: F.coalesce(F.aggregate(c, F.lit(0), lambda n, r: n + F.size(r)), F.lit(0))
    shaped = [F.col(c).alias(n) for c, n in zip(shape_cols, ("shape", "clip", "size"))]
    if shape_cols:
        shaped.append(F.ceil((numbers(shape_cols[0]) + numbers(shape_cols[1]) + 1) / POINTS).alias("weight"))
    p = predictions.select(*keys, F.col(pred_id).alias("id"), *[F.col(c).cast("double").alias(c) for c in B.BOX],
                           ranked_score(F.col(score_col)).alias("score"), tie_of(F.col(pred_id)).alias("pred_rank"),
                           label.cast("string").alias("label"), *shaped)
    t = truths.select(*keys, F.col(truth_id).alias("id"), *[F.col(c).cast("double").alias(c) for c in B.BOX],
                      label.cast("string").alias("label"), *shaped)
    # A table that was just written isn't written again.
    p, t = (thin if on_file(df) else cut(thin, name) for df, thin, name in ((predictions, p, "predictions"), (truths, t, "truths")))
    few, many = by_size([p, t], keys, most, F.col("weight") if shape_cols else None)
    if few is None:
        return None, many
    schema = T.StructType([*[p.schema[k] for k in keys], T.StructField("pred", p.schema["id"].dataType),
                           T.StructField("truth", t.schema["id"].dataType), T.StructField("iou", T.DoubleType()),
                           T.StructField("label", T.StringType()), T.StructField("bits", T.LongType())])
    sides = [of_keys(df, keys, few, many).groupBy(*keys) for df in (p, t)]
    both = sides[0].cogroup(sides[1])
    if shape_cols:
        return both.applyInArrow(_match_shapes(keys, steps, to_arrow_schema(schema)), schema), many
    return both.applyInPandas(_match_boxes(keys, steps), schema), many


def candidate_pairs(predictions: DataFrame, truths: DataFrame, score_col: str,
                    keys: Sequence[str] = ("product_id",), pred_id: str = "object_id",
                    truth_id: str = "truth_id", epsilon: float = 0.0,
                    pred_extra: Sequence[str] = (), truth_extra: Sequence[str] = (),
                    pred_keys: Sequence[str] = (), least_iou: float = 0.0,
                    shape_cols: Sequence[str] = ()) -> DataFrame:
    """Overlapping prediction/truth pairs with their IoU, measured once for all thresholds.

    With `shape_cols` (rings, the ring they are clipped to, the clipped area; in both tables) the
    boxes only find the pairs and the IoU is that of the clipped polygons.
    """
    keys = list(keys)
    out_pred, out_truth = pred_extra, truth_extra
    pred_extra, truth_extra = [*pred_extra, *shape_cols], [*truth_extra, *shape_cols]
    p = predictions.select(*keys, *pred_keys, F.col(pred_id).alias("id"), *B.BOX,
                           ranked_score(F.col(score_col)).alias("score"), *pred_extra)
    t = truths.select(*keys, F.col(truth_id).alias("id"), *B.BOX, *truth_extra)
    near = None
    if shape_cols and least_iou > 0:
        # What two shapes share lies in both boxes, so pairs that can't reach the least IoU end before any polygon is swept.
        most = F.least(B.inter_area(B.box("a_"), B.box("b_")), f"a_{shape_cols[2]}", f"b_{shape_cols[2]}")
        near = iou_from(most, F.col(f"a_{shape_cols[2]}"), F.col(f"b_{shape_cols[2]}")) >= least_iou * (1 - ROUNDING) - ROUNDING
    pairs = bbox_join(p, t, keys, extra=near)
    if shape_cols:
        shape, clip, size = shape_cols
        inter = clipped_inter_area(f"a_{shape}", f"b_{shape}", f"a_{clip}", f"b_{clip}")
        pairs = pairs.withColumn("_inter", inter)
        value = iou_from(F.col("_inter"), F.col(f"a_{size}"), F.col(f"b_{size}"))
    else:
        value = B.iou(B.box("a_"), B.box("b_"), epsilon)
    return pairs.select(
        *keys, *[F.col(f"a_{k}").alias(k) for k in pred_keys],
        F.col("a_id").alias("pred"), F.col("a_score").alias("score"), F.col("b_id").alias("truth"),
        value.alias("iou"),
        *[F.col(f"a_{c}").alias(f"pred_{c}") for c in out_pred],
        *[F.col(f"b_{c}").alias(f"truth_{c}") for c in out_truth],
    ).filter(F.col("iou") >= least_iou)


def run_pairs(predictions: DataFrame, truths: DataFrame, pred_runs: DataFrame, truth_runs: DataFrame,
              score_col: str, keys: Sequence[str] = ("product_id",), pred_id: str = "object_id",
              truth_id: str = "truth_id", pred_extra: Sequence[str] = (), truth_extra: Sequence[str] = (),
              least_iou: float = 0.0) -> DataFrame:
    """`candidate_pairs` by the pixels of masks given as runs `(keys, id, line, c0, c1)`."""
    keys = list(keys)
    p = predictions.select(*keys, F.col(pred_id).alias("a_id"), ranked_score(F.col(score_col)).alias("score"),
                           *[F.col(c).alias(f"pred_{c}") for c in pred_extra])
    t = truths.select(*keys, F.col(truth_id).alias("b_id"), *[F.col(c).alias(f"truth_{c}") for c in truth_extra])
    pairs = mask_pairs(pred_runs, truth_runs, pred_id, truth_id, keys, least=least_iou, of=(
        predictions.select(*keys, pred_id), truths.select(*keys, truth_id))).filter(F.col("iou") >= least_iou)
    pairs = pairs.join(p, [*keys, "a_id"]).join(t, [*keys, "b_id"])
    return pairs.withColumnsRenamed({"a_id": "pred", "b_id": "truth"}).drop("inter", "area_a", "area_b", "dice_loss")


def greedy_match(predictions: DataFrame, truths: DataFrame, thresholds: Sequence[float],
                 score_col: str = "detector_score", keys: Sequence[str] = ("product_id",),
                 size_col: str | None = None, pred_id: str = "object_id",
                 truth_id: str = "truth_id", tail_pairs: int = TAIL_PAIRS,
                 pred_keys: Sequence[str] = (), shape_cols: Sequence[str] = (),
                 runs: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Matches per `keys`, IoU threshold and size bin: `(keys, iou_threshold, size_label, ...)`.

    The bin `all` holds everyone; with `size_col` (a label column in both tables) a pair also
    competes inside its own bin when both sides carry the same label.

    Predictions come by score (null and NaN last), then by a hash of the id, then by the id; among equal IoU
    the truth with the lowest id is taken. With `runs` (of predictions and truths) the IoU is that of masks.
    """
    keys, extra = list(keys), [size_col] if size_col else []
    steps = sorted({float(t) for t in thresholds})
    n = len(steps)
    if 2 * n > BITS:        # thresholds don't touch each other
        parts = [greedy_match(predictions, truths, steps[k:k + BITS // 2], score_col, keys, size_col, pred_id, truth_id, tail_pairs,
                              pred_keys, shape_cols, runs) for k in range(0, n, BITS // 2)]
        return reduce(DataFrame.unionByName, parts)
    key = [*keys, *pred_keys]
    columns = [*key, "bit", "label", "pred", "truth", "iou"]
    found, many = [], None
    if keys and steps[0] > 0 and tail_pairs > 0 and not (runs or pred_keys):
        done, many = _whole_keys(predictions, truths, keys, score_col, steps, size_col, pred_id, truth_id, min(WHOLE_KEY, tail_pairs),
                                 shape_cols)
        if done is not None:
            found.append(_each_bit(done, 2 * n, n).select(*columns))
        if many is not None:
            predictions, truths = (df.join(many, keys, "left_semi") for df in (predictions, truths))
    if not found or many is not None:
        if runs:
            pairs = run_pairs(predictions, truths, *runs, score_col, keys, pred_id, truth_id, extra, extra, steps[0])
        else:
            pairs = candidate_pairs(predictions, truths, score_col, keys, pred_id, truth_id,
                                    pred_extra=extra, truth_extra=extra, pred_keys=pred_keys,
                                    least_iou=steps[0], shape_cols=shape_cols)
        bits = sum((F.when(F.col("iou") >= t, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, t in enumerate(steps)),
                   F.lit(0).cast("long"))
        pairs = pairs.withColumn("bits", bits)
        if size_col:
            same = F.col(f"pred_{size_col}") == F.col(f"truth_{size_col}")
            pairs = pairs.withColumns({"bits": F.when(same, F.col("bits") * (1 + (1 << n))).otherwise(F.col("bits")),
                                       "label": F.col(f"pred_{size_col}")})
        pairs = pairs.withColumn("pred_rank", tie_of(F.col("pred")))
        found.append(match_bits(pairs, key, 2 * n, n, tail_pairs).select(*columns))
    step = F.element_at(F.array(*[F.lit(t) for t in steps]), (F.col("bit") % n + 1).cast("int"))
    return reduce(DataFrame.unionByName, found).select(
        *key, step.alias("iou_threshold"), F.col("label").alias("size_label"), F.col("pred").alias(pred_id), F.col("truth").alias(truth_id), "iou")


def _match_prompts(keys: Sequence[str], least_iou: float):
    """From truths (`_side` 0) and predictions (1, in their order) sorted by key: the predictions that take a truth, with its id and the IoU."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, group in whole_groups(batches, keys, 1 << 14):
            box = np.stack([np.asarray(b.column(c).fill_null(np.nan)) for c in B.BOX], 1)
            side, size = np.asarray(b.column("_side")), (box[:, 2] - box[:, 0]) * (box[:, 3] - box[:, 1])
            ends = np.append(np.flatnonzero(np.diff(group, prepend=-1)), b.num_rows)
            rows, truths, values = [], [], []
            for start, end in zip(ends[:-1], ends[1:]):
                first = start + int(np.searchsorted(side[start:end], 1))       # of the predictions
                step, todo, used = max(HELD // max(first - start, 1), 1), {}, {}
                for begin in range(first, end if first > start else first, step):
                    found = []
                    for i, j in overlapping(box[begin:min(begin + step, end)], box[start:first]):
                        i, j = begin + i, start + j
                        x, y = box[i], box[j]
                        inter = np.maximum(np.minimum(x[:, 2], y[:, 2]) - np.maximum(x[:, 0], y[:, 0]), 0.0) * np.maximum(
                            np.minimum(x[:, 3], y[:, 3]) - np.maximum(x[:, 1], y[:, 1]), 0.0)
                        under = size[i] + size[j] - inter + EPSILON
                        value = np.divide(inter, under, out=np.zeros(len(inter)), where=under != 0)
                        near = value > least_iou
                        found.append((i[near], j[near], value[near]))
                    if not found:
                        continue
                    i, j, value = (np.concatenate(c) for c in zip(*found))
                    order = np.lexsort((j, -value, i))
                    won, _ = first_come(i[order].tolist(), j[order].tolist(), [1] * len(i), todo, used)
                    rows.append(i[order][won])
                    truths.append(j[order][won])
                    values.append(value[order][won])
            if rows:
                at, t = (pa.array(np.concatenate(c)) for c in (rows, truths))
                yield pa.RecordBatch.from_arrays([*[b.column(c).take(at) for c in (*keys, "id", *B.BOX)], b.column("truth").take(t), pa.array(np.concatenate(values))],
                                                 names=[*keys, "id", *B.BOX, "truth", "iou"])

    return run


def _prompts_of_small(predictions: DataFrame, truths: DataFrame, least_iou: float, order_col: str, keys: Sequence[str], pred_id: str,
                      truth_id: str, most: int) -> tuple[DataFrame | None, DataFrame | None]:
    """`prompt_match` of the keys with at most `most` boxes, and the larger keys. Boxes of a key meet in one sort."""
    box = [F.col(c).cast("double").alias(c) for c in B.BOX]
    p = predictions.select(*keys, F.lit(1).alias("_side"), ranked_score(-F.col(order_col).cast("double")).alias("score"),
                           F.col(pred_id).alias("id"), *box)
    t = truths.select(*keys, F.lit(0).alias("_side"), F.col(truth_id).alias("truth"), *box)
    both = cut(p.unionByName(t, allowMissingColumns=True).dropna(subset=keys), "prompts")
    few, many = by_size([both], keys, most)
    if few is None:
        return None, many
    kind = T.StructType([*[both.schema[c] for c in (*keys, "id", *B.BOX, "truth")], T.StructField("iou", T.DoubleType())])
    rank = lambda c: [F.col(c).cast("long"), c]
    order = of_keys(both, keys, few, many).repartition(*keys).sortWithinPartitions(*keys, "_side", F.desc("score"), *rank("id"), *rank("truth"))
    return order.mapInArrow(_match_prompts(keys, least_iou), kind), many


def prompt_match(predictions: DataFrame, truths: DataFrame, least_iou: float = 0.3,
                 order_col: str = "position", tile_col: str = "tile_path",
                 pred_id: str = "object_id", truth_id: str = "truth_id",
                 mask_col: str = "has_mask", tail_pairs: int = TAIL_PAIRS) -> DataFrame:
    """Predictions in the given order take the best unused truth that has a mask, IoU > 0.3.

    Result: the predicted box with the truth whose mask it takes over.
    """
    truths = truths.filter(F.col(mask_col))
    parts = []
    done = many = None
    if tail_pairs > 0 and least_iou >= 0:
        done, many = _prompts_of_small(predictions, truths, least_iou, order_col, [tile_col], pred_id, truth_id, min(WHOLE_KEY, tail_pairs))
    if done is not None:
        parts.append(done.select(tile_col, F.col("id").alias(pred_id), *[F.col(c).cast(predictions.schema[c].dataType).alias(c) for c in B.BOX],
                                 F.col("truth").alias(truth_id), "iou"))
        if many is None:
            return parts[0]
        predictions, truths = (df.join(many, tile_col, "left_semi") for df in (predictions, truths))
    ranked = predictions.withColumn("_s", -F.col(order_col).cast("double"))
    pairs = candidate_pairs(ranked, truths, "_s", [tile_col], pred_id,
                            truth_id, epsilon=EPSILON).filter(F.col("iou") > least_iou)
    found = match_rounds(pairs.select(tile_col, "pred", "score", "truth", "iou"), [tile_col],
                         tail_pairs)
    found = found.select(tile_col, F.col("pred").alias(pred_id), F.col("truth").alias(truth_id),
                         "iou")
    boxes = predictions.select(tile_col, pred_id, *B.BOX)
    parts.append(boxes.join(found, [tile_col, pred_id]))
    return reduce(DataFrame.unionByName, parts)
