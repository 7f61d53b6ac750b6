"""Masks go to the pairing as one packed row each, and values are worked out once."""

import numpy as np

from crownframe.operators import masks, metrics
from tests.test_shapes import random_masks, run_rows


def test_shapes_are_packed_and_equal_ones_are_equal(spark):
    """Runs in any order, in pieces, of masks with and without a row in `of`."""
    shapes = random_masks(6, 21)
    shapes[50] = shapes[2].copy()
    runs = run_rows(spark, shapes, "id").orderBy("c0", "line").repartition(5)
    of = spark.createDataFrame([(0, i, float(i)) for i in (1, 2, 50, 99)], "product_id int, id bigint, score double")
    rows = {r["id"]: r for r in masks.whole_masks(runs, ["product_id", "id"], of, ["score"]).collect()}
    assert {i: (r["area"], r["score"]) for i, r in rows.items()} == {i: (shapes[i].sum(), float(i)) for i in (1, 2, 50) if shapes[i].any()}
    assert rows[2]["shape"] == rows[50]["shape"] != rows[1]["shape"]


def test_pairs_below_the_threshold_leave_no_row(spark):
    """What lies in one block, or differs too much in area, is judged in the task that finds it, not after another shuffle."""
    shapes = random_masks(12, 22)
    runs = run_rows(spark, shapes, "a")
    found = masks.overlap_area(runs, runs.withColumnRenamed("a", "b"), "a", "b", least=0.4).collect()
    every = {(i, j): (m & n).sum() / (m | n).sum() for i, m in shapes.items() for j, n in shapes.items() if (m & n).any()}
    got = {(r["a_id"], r["b_id"]): r["inter"] / (r["area_a"] + r["area_b"] - r["inter"]) for r in found}
    assert {k: v for k, v in every.items() if v >= 0.4} == got


def test_statistics_work_their_values_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    values = np.round(np.random.default_rng(3).random(400), 1)
    df = spark.createDataFrame([(i % 3, float(v)) for i, v in enumerate(values)], "k int, iou double").repartition(2)
    got = {r["k"]: r for r in metrics.iou_stats(df.mapInArrow(count, df.schema), keys=["k"]).collect()}
    assert seen.value == 400
    for k in range(3):
        own = values[k::3]
        want = [own.mean(), np.median(own), own.std(), len(own)]
        assert np.allclose([got[k][c] for c in ("mean_iou", "median_iou", "std_iou", "num_masks")], want)
