"""Metric tables: counts, precision/recall/F1, sweeps over thresholds, averages over rasters and runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownframe.functions.boxes import SIZE_LABELS
from crownframe.operators.numbering import running_totals
from crownframe.session import cut

# Score columns in the order in which one is looked for.
SCORE_COLUMNS = ("score", "aggregator_score", "detector_score", "segmentation_score",
                 "segmenter_score")
ALL = "all"
AVERAGE_ROW = "average_over_rasters"


def pick_score(df: DataFrame) -> str:
    """Name of the first score column the table has."""
    for name in SCORE_COLUMNS:
        if name in df.columns:
            return name
    raise ValueError(f"no score column found, expected one of {', '.join(SCORE_COLUMNS)}")


def sort_by_score(df: DataFrame, id_col: str = "object_id") -> DataFrame:
    """Strongest first; equal scores by id. A range-partitioned sort."""
    return df.orderBy(F.col(pick_score(df)).desc(), F.col(id_col))


def is_close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(b)


def with_prf1(df: DataFrame) -> DataFrame:
    """Add precision, recall and f1 to a table with tp, fp, fn; undefined ratios are 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    df = df.withColumns({"precision": p, "recall": r})
    p, r = F.col("precision"), F.col("recall")
    return df.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def size_counts(df: DataFrame, keys: Sequence[str], size_col: str, name: str,
                with_all: bool = False) -> DataFrame:
    """Rows per size label (and for the bin `all`)."""
    label = F.col(size_col)
    if with_all:
        label = F.explode(F.array(F.lit(ALL), F.col(size_col)))
    return df.select(*keys, label.alias("size_label")).groupBy(*keys, "size_label").agg(
        F.count(F.lit(1)).alias(name))


def count_matches(matches: DataFrame, predictions: DataFrame, truths: DataFrame,
                  thresholds: Sequence[float], keys: Sequence[str] = ("product_id",),
                  size_col: str | None = None) -> DataFrame:
    """tp, fp, fn with precision, recall, f1 per key, threshold and bin, empty bins included."""
    keys = list(keys)
    if size_col is None:
        size_col = "_size"
        predictions = predictions.withColumn(size_col, F.lit(None).cast("string"))
        truths = truths.withColumn(size_col, F.lit(None).cast("string"))
        labels = [ALL]
    else:
        labels = [ALL, *SIZE_LABELS]
    n_pred = size_counts(predictions, keys, size_col, "num_preds", True)
    n_true = size_counts(truths, keys, size_col, "num_truths", True)
    key = [*keys, "size_label"]
    seen = n_pred.join(n_true, key, "full").filter(F.col("size_label").isNotNull())
    frame = (seen.filter(F.col("size_label") == ALL).select(*keys)
             .withColumn("size_label", F.explode(F.array(*[F.lit(v) for v in labels])))
             .join(seen, key, "left")
             .fillna(0, ["num_preds", "num_truths"])
             .withColumn("iou_threshold", F.explode(
                 F.array(*[F.lit(t) for t in sorted({float(t) for t in thresholds})]))))
    hits = matches.groupBy(*key, "iou_threshold").agg(F.count(F.lit(1)).alias("tp"))
    counted = frame.join(hits, [*key, "iou_threshold"], "left").fillna(0, ["tp"])
    counted = counted.withColumns({"fp": F.col("num_preds") - F.col("tp"),
                                   "fn": F.col("num_truths") - F.col("tp")})
    return with_prf1(counted.select(*keys, "iou_threshold", "size_label", "tp", "fp", "fn",
                                    "num_truths", "num_preds"))


def rf1_sweep(counted: DataFrame, keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """One row per raster from `count_matches`: means over thresholds, lists per threshold.

    tp/fp/fn come from the lowest threshold; `_50` and `_75` columns are null when those thresholds
    were not asked for; each size class gets its own mean and list columns.
    """
    whole = F.col("size_label") == ALL
    names = ("precision", "recall", "f1")
    aggs = []
    for m in names:
        aggs.append(F.avg(F.when(whole, F.col(m))).alias(m))
        ordered = F.array_sort(F.collect_list(F.when(whole, F.struct("iou_threshold", m))))
        aggs.append(_values(ordered, m).alias(f"{m}_per_iou"))
        for target, suffix in ((0.5, "50"), (0.75, "75")):
            hit = whole & is_close(F.col("iou_threshold"), F.lit(target))
            aggs.append(F.max(F.when(hit, F.col(m))).alias(f"{m}_{suffix}"))
    for c in ("tp", "fp", "fn"):
        aggs.append(F.min_by(c, F.when(whole, F.col("iou_threshold"))).alias(c))
    for c in ("num_truths", "num_preds"):
        aggs.append(F.max(F.when(whole, F.col(c))).alias(c))
    aggs.append(F.array_sort(F.collect_set(F.when(whole, F.col("iou_threshold"))))
                .alias("iou_thresholds"))
    for label in SIZE_LABELS:
        mine = F.col("size_label") == label
        for m in names:
            aggs.append(F.avg(F.when(mine, F.col(m))).alias(f"{m}_{label}"))
            ordered = F.array_sort(F.collect_list(F.when(mine, F.struct("iou_threshold", m))))
            aggs.append(_values(ordered, m).alias(f"{m}_per_iou_{label}"))
    return counted.groupBy(*keys).agg(*aggs).withColumn("num_images", F.lit(1))


def _values(ordered: Column, field: str) -> Column:
    return F.transform(ordered, lambda s: s[field])


def threshold_label(thresholds: Column) -> Column:
    """`0.50,0.55,...` from an array of thresholds."""
    return F.array_join(F.transform(thresholds, lambda t: F.format_string("%.2f", t)), ",")


# --- averages -------------------------------------------------------------------------------

def _weighted(metric: str, weight: str) -> Column:
    total = F.sum(F.when(F.col(metric).isNotNull(), F.col(weight)))
    return F.when(total > 0, F.sum(F.col(metric) * F.col(weight)) / F.when(total > 0, total)
                  ).otherwise(F.avg(metric))


def avg_by_params(results: DataFrame, params: Sequence[str] = ("nms_iou", "nms_score"),
                  raster_col: str = "raster_name") -> DataFrame:
    """Append one `average_over_rasters` row per parameter pair.

    Precision, recall and f1 are weighted by the number of truths (plain mean when there are
    none), counts are summed.
    """
    aggs = [_weighted(m, "num_truths").alias(m) for m in ("precision", "recall", "f1")
            if m in results.columns]
    aggs += [F.sum(c).alias(c) for c in ("num_images", "num_truths", "num_preds")
             if c in results.columns]
    mean = results.groupBy(*params).agg(*aggs).withColumn(raster_col, F.lit(AVERAGE_ROW))
    return results.unionByName(mean, allowMissingColumns=True)


def best_params(results: DataFrame, params: Sequence[str] = ("nms_iou", "nms_score"),
                raster_col: str = "raster_name", metric: str = "f1") -> DataFrame:
    """The row with the highest metric among the average rows, or among all rows without any.

    Ties: smaller parameters first.
    """
    averaged = F.when(F.col(raster_col) == AVERAGE_ROW, 0).otherwise(1)
    return results.orderBy(averaged, F.col(metric).desc(), *params).limit(1)


def weighted_dataset_avg(metrics: DataFrame, keys: Sequence[str] = ("dataset",),
                         weight: str = "num_truths") -> DataFrame:
    """Truth-weighted mean per dataset of the numeric and list columns.

    A column with any null in a dataset comes back as null there. Lists are averaged per position.
    """
    keys = list(keys)
    total = F.sum(weight)
    skip = {*keys, weight, "tp", "fp", "fn", "num_preds", "num_images"}
    aggs, lists = [], []
    for field in metrics.schema.fields:
        if field.name in skip:
            continue
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            whole = F.count(F.when(F.col(field.name).isNull(), 1)) == 0
            mean = F.sum(F.col(field.name) * F.col(weight)) / F.when(total > 0, total)
            aggs.append(F.when(whole, mean).alias(field.name))
        elif isinstance(field.dataType, T.ArrayType) and field.name != "iou_thresholds":
            lists.append(field.name)
    out = metrics.groupBy(*keys).agg(*aggs, total.alias(weight))
    if lists:
        stacked = metrics.select(*keys, weight, F.explode(F.array(*[
            F.struct(F.lit(n).alias("name"), F.col(n).cast("array<double>").alias("v"))
            for n in lists])).alias("l"))
        missing = stacked.filter(F.col("l.v").isNull()).select(
            *keys, F.col("l.name").alias("name")).distinct()
        means = (stacked.select(*keys, weight, F.col("l.name").alias("name"),
                                F.posexplode("l.v").alias("pos", "v"))
                 .join(missing, [*keys, "name"], "left_anti")
                 .groupBy(*keys, "name", "pos")
                 .agg((F.sum(F.col("v") * F.col(weight)) / F.when(total > 0, total)).alias("v"))
                 .groupBy(*keys)
                 .pivot("name", lists)
                 .agg(F.array_sort(F.collect_list(F.struct("pos", "v")))))
        means = means.select(*keys, *[_values(F.col(n), "v").alias(n) for n in lists])
        out = out.join(means, keys, "left")
    return out


# Columns taken from the first run as they are, and columns left out.
PASS_THROUGH = ("iou_thresholds", "num_images", "num_truths", "size_labels")
LEFT_OUT = ("tp", "fp", "fn")


def mean_std_over_runs(runs: Sequence[DataFrame] | DataFrame, run_col: str = "run_id",
                       keys: Sequence[str] = ("location", "product_name"),
                       check: bool = True) -> DataFrame:
    """Mean and population standard deviation per row over runs.

    `runs` is a list of tables or one table with `run_col`. Every run must have the same rows.
    Lists of equal length are treated per position; lists of unequal length are left out.
    """
    keys = list(keys)
    if not isinstance(runs, DataFrame):
        if not runs:
            raise ValueError("no runs given")
        for i, df in enumerate(runs):
            missing = [k for k in keys if k not in df.columns]
            if missing:
                raise ValueError(f"run {i} has no column {', '.join(missing)}")
        stacked = runs[0].withColumn(run_col, F.lit(0))
        for i, df in enumerate(runs[1:], 1):
            stacked = stacked.unionByName(df.withColumn(run_col, F.lit(i)), allowMissingColumns=True)
        runs = stacked
    if check:
        bad = _uneven_rows(runs, run_col, keys).limit(1).collect()
        if bad:
            raise ValueError(f"runs differ in their rows, e.g. {bad[0].asDict()}")
    first = F.min(run_col)
    aggs, lists = [], []
    for field in runs.schema.fields:
        name = field.name
        if name in (*keys, run_col, *LEFT_OUT):
            continue
        if name in PASS_THROUGH:
            aggs.append(F.min_by(name, run_col).alias(name))
        elif isinstance(field.dataType, T.ArrayType):
            lists.append(name)
        elif isinstance(field.dataType, T.NumericType):
            whole = F.count(F.when(F.col(name).isNull(), 1)) == 0
            aggs.append(F.when(whole, F.avg(name)).alias(f"{name}_mean"))
            aggs.append(F.when(whole, F.stddev_pop(name)).alias(f"{name}_std"))
    out = runs.groupBy(*keys).agg(*(aggs or [first.alias("_first")]))
    for name in lists:
        steps = runs.select(*keys, F.size(name).alias("_len"),
                            F.posexplode(name).alias("_pos", "_v"))
        per = steps.groupBy(*keys, "_pos").agg(
            F.avg("_v").alias("_m"), F.stddev_pop("_v").alias("_s"),
            F.min("_len").alias("_lo"), F.max("_len").alias("_hi"))
        ordered = F.array_sort(F.collect_list(F.struct("_pos", "_m", "_s")))
        even = F.min("_lo") == F.max("_hi")
        out = out.join(per.groupBy(*keys).agg(
            F.when(even, _values(ordered, "_m")).alias(f"{name}_mean"),
            F.when(even, _values(ordered, "_s")).alias(f"{name}_std")), keys, "left")
    return out


def _uneven_rows(runs: DataFrame, run_col: str, keys: Sequence[str]) -> DataFrame:
    """Rows that are missing or doubled in some run."""
    n_runs = runs.agg(F.count_distinct(run_col)).first()[0]
    return runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(run_col).alias("in_runs")).filter(
        (F.col("rows") != n_runs) | (F.col("in_runs") != n_runs))


IDENTITY = ("location", "product_name", "iou_thresholds", "num_images", "num_truths")


def join_summaries(tile: DataFrame, raster: DataFrame, tile_prefix: str = "",
                   raster_prefix: str = "") -> DataFrame:
    """Tile-level rows with their raster-level columns; rows without raster metrics stay."""
    for name, df in (("tile", tile), ("raster", raster)):
        missing = [k for k in IDENTITY[:2] if k not in df.columns]
        if missing:
            raise ValueError(f"{name} summary has no column {', '.join(missing)}")

    def prefixed(df, prefix):
        if not prefix:
            return df
        return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in df.columns if c not in IDENTITY})

    tile, raster = prefixed(tile, tile_prefix), prefixed(raster, raster_prefix)
    double = [c for c in raster.columns if c in tile.columns and c not in IDENTITY[:2]]
    return tile.join(raster.drop(*double), list(IDENTITY[:2]), "left")


def mean_over_datasets(metrics: DataFrame, dataset_col: str = "location",
                       names: Sequence[str] | None = None) -> DataFrame:
    """`(metric, value, num_datasets)`: each AP/AR column averaged over the datasets."""
    names = names or [c for c in metrics.columns if c.startswith(("AP", "AR"))]
    long = metrics.select(dataset_col, F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
        for n in names])).alias("m")).select(dataset_col, "m.metric", "m.value")
    return long.groupBy("metric").agg(
        F.avg("value").alias("value"), F.count("value").alias("num_datasets"))


def iou_stats(df: DataFrame, value: str = "iou", keys: Sequence[str] = ()) -> DataFrame:
    """Mean, median, standard deviation and number of the values that aren't null.

    Equal values are counted first, so what follows works on different ones; the median is found by the values' ranks, and a
    group is never held in one task.
    """
    keys = list(keys)
    on = keys or ["_one"]
    rows = (df if keys else df.withColumn("_one", F.lit(1))).select(*on, F.col(value).cast("double").alias("_v"))
    counts = cut(rows.groupBy(*on, "_v").agg(F.count(F.lit(1)).alias("_c")), "counts")
    known = counts.filter(F.col("_v").isNotNull())
    sums = cut(counts.groupBy(*on).agg((F.sum(F.col("_v") * F.col("_c")) / F.sum(F.when(F.col("_v").isNotNull(), F.col("_c")))).alias("mean_iou"),
                                       F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_c"))), F.lit(0)).alias("num_masks")), "sums")
    apart = known.join(sums, on).groupBy(*on).agg(
        F.sqrt(F.sum(F.col("_c") * (F.col("_v") - F.col("mean_iou")) ** 2) / F.first("num_masks")).alias("std_iou"))
    ranked = running_totals(known, on, [F.col("_v")], {"_upto": F.col("_c")}).join(sums.select(*on, "num_masks"), on)
    first, last = F.floor((F.col("num_masks") - 1) / 2), F.floor(F.col("num_masks") / 2)
    holds = [((F.col("_upto") - F.col("_c") <= r) & (F.col("_upto") > r)) for r in (first, last)]
    middle = ranked.filter(holds[0] | holds[1])
    median = middle.groupBy(*on).agg((F.sum(F.when(holds[0], F.col("_v"))) / 2 + F.sum(F.when(holds[1], F.col("_v"))) / 2).alias("median_iou"))
    return sums.join(median, on, "left").join(apart, on, "left").select(*keys, "mean_iou", "median_iou", "std_iou", "num_masks")


def micro_f1(df: DataFrame, predicted: str = "classifier_class", actual: str = "true_class",
             keys: Sequence[str] = ()) -> DataFrame:
    """Micro-averaged F1 over one label per row, which is the share of right labels."""
    right = F.when(F.col(predicted) == F.col(actual), 1.0).otherwise(0.0)
    return df.groupBy(*keys).agg(F.avg(right).alias("micro_f1"), F.count(F.lit(1)).alias("num_rows"))


def dataset_stats(tiles: DataFrame, annotations: DataFrame, fold: str = "fold",
                  tile: str = "tile_path") -> DataFrame:
    """Tiles and annotations per fold."""
    t = tiles.groupBy(fold).agg(F.count_distinct(tile).alias("n_tiles"))
    a = annotations.groupBy(fold).agg(F.count(F.lit(1)).alias("n_annotations"))
    return t.join(a, fold, "full").fillna(0, ["n_tiles", "n_annotations"])
