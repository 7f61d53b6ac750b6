import pytest
from pyspark.sql import functions as F

from crownframe.operators import matching, spatial_join, suppression
from tests import brute


def ids(df, name="object_id"):
    return {r[0] for r in df.select(name).collect()}


@pytest.mark.parametrize("options", [{}, {"hot_cell": 3}, {"tail_edges": 0}])
@pytest.mark.parametrize("t", [0.4])
def test_nms_equals_the_sequential_rule(spark, t, options):
    rows = brute.boxes(250, seed=int(t * 10))
    got = suppression.nms(brute.frame(spark, rows), t, **options)
    assert ids(got) == brute.nms(rows, t)


def odd_scores(rows):
    """Some scores are null or NaN."""
    return [(i, p, b, None if i % 7 == 0 else float("nan") if i % 11 == 0 else s) for i, p, b, s in rows]


@pytest.mark.parametrize("options", [{}, {"hot_cell": 1}, {"tail_edges": 0}, {"hot_cell": 3, "tail_edges": 5}])
def test_nms_without_some_scores(spark, options):
    rows = odd_scores(brute.boxes(150, seed=8))
    got = suppression.nms(brute.frame(spark, rows), 0.3, **options)
    assert ids(got) == brute.nms(rows, 0.3)
    scored = [r for r in rows if r[3] is not None and r[3] == r[3] and r[3] >= 0.2]
    assert ids(suppression.nms(brute.frame(spark, rows), 0.3, 0.2, **options)) == brute.nms(scored, 0.3)


def chain(n):
    """Boxes side by side, each overlapping the next, all with the same score."""
    return [(i, 0, (2.0 * i, 0.0, 2.0 * i + 3.0, 3.0), 0.5) for i in range(n)]


def test_rounds_do_not_follow_a_chain_of_equal_scores(spark, monkeypatch):
    rows = chain(3000)
    rounds = []
    true_cut = suppression.cut
    monkeypatch.setattr(suppression, "cut", lambda df, label="": (rounds.append(label), true_cut(df, label))[1])
    got = suppression.nms(brute.frame(spark, rows), 0.1, tail_edges=0)
    assert ids(got) == brute.nms(rows, 0.1)
    assert rounds.count("fallen") < 20


def test_keys_are_finished_one_by_one(spark):
    """A key with few edges left is finished in a task while a larger one goes on in rounds."""
    rows = brute.boxes(200, seed=5, products=1) + [(1000 + i, 1, b, s) for i, _, b, s in brute.boxes(20, seed=6)]
    df = brute.frame(spark, rows)
    nodes = suppression.nodes_of(df, ["product_id"], "object_id", "detector_score", [0.3])
    edges = suppression._edges(nodes, nodes, ["product_id"], spatial_join.levels_of(df), [0.3])
    for after, few in ((0, 10 ** 9), (0, 30), (1, 0)):
        fallen = suppression.suppressed(edges, ["product_id"], tail_edges=few, tail_after=after)
        kept = nodes.join(fallen.select("product_id", "id"), ["product_id", "id"], "left_anti")
        assert ids(kept, "id") == brute.nms(rows, 0.3)


def test_nms_on_a_crowd_of_near_copies(spark):
    """A third of all boxes lie on one spot; the thinning steps must not change the result."""
    rows = brute.boxes(120, seed=2)
    crowd = [(1000 + i, 0, (5 + i % 7 * 0.01, 5, 9 + i % 5 * 0.01, 9), (i % 17) / 20) for i in range(80)]
    got = suppression.nms(brute.frame(spark, rows + crowd), 0.5, hot_cell=10)
    assert ids(got) == brute.nms(rows + crowd, 0.5)


def test_nms_thresholds_at_and_above_one_keep_everything(spark):
    rows = brute.boxes(50, seed=3)
    assert ids(suppression.nms(brute.frame(spark, rows), 1.0)) == {r[0] for r in rows}


def test_nms_ignores_boxes_without_area(spark):
    rows = [(0, 0, (1, 1, 1, 5), 0.9), (1, 0, (1, 1, 1, 5), 0.8), (2, 0, (0, 0, 4, 4), 0.7)]
    assert ids(suppression.nms(brute.frame(spark, rows), 0.1)) == {0, 1, 2}


@pytest.mark.parametrize("hot_cell", [10_000, 3])
def test_nms_grid_equals_single_runs(spark, hot_cell):
    rows = brute.boxes(120, seed=9)
    kept = suppression.nms_grid(brute.frame(spark, rows), [0.2, 0.6, 1.0], 0.0, hot_cell=hot_cell)
    got = {}
    for r in kept.collect():
        got.setdefault(r["nms_iou"], set()).add(r["object_id"])
    assert got == {t: brute.nms(rows, t) if t < 1 else {r[0] for r in rows} for t in (0.2, 0.6, 1.0)}


def test_matching_without_some_scores(spark):
    preds, truths = odd_scores(brute.boxes(120, seed=13)), brute.boxes(90, seed=14)
    for tail in (0, 10 ** 9):
        got = matching.greedy_match(brute.frame(spark, preds), brute.frame(spark, truths, "truth_id", "s"), [0.2],
                                    tail_pairs=tail)
        assert {(r["object_id"], r["truth_id"]) for r in got.collect()} == set(brute.match(preds, truths, 0.2).items())


def test_match_rounds_do_not_follow_a_chain_of_equal_scores(spark, monkeypatch):
    preds = chain(1500)
    truths = [(i, 0, (2.0 * i + 1.0, 0.0, 2.0 * i + 4.0, 3.0), 0.0) for i in range(1500)]
    rounds = []
    true_cut = matching.cut
    monkeypatch.setattr(matching, "cut", lambda df, label="": (rounds.append(label), true_cut(df, label))[1])
    got = matching.greedy_match(brute.frame(spark, preds), brute.frame(spark, truths, "truth_id", "s"), [0.1], tail_pairs=0)
    assert {(r["object_id"], r["truth_id"]) for r in got.collect()} == set(brute.match(preds, truths, 0.1).items())
    assert rounds.count("matches") < 30


@pytest.mark.parametrize("tail", [0, 10 ** 9])
def test_greedy_match_equals_the_sequential_rule(spark, tail):
    preds, truths = brute.boxes(150, seed=11), brute.boxes(100, seed=12)
    got = matching.greedy_match(brute.frame(spark, preds), brute.frame(spark, truths, "truth_id", "s"),
                                [0.2, 0.5], tail_pairs=tail)
    found = {(r["iou_threshold"], r["object_id"]): r["truth_id"] for r in got.collect()}
    want = {(t, p): g for t in (0.2, 0.5) for p, g in brute.match(preds, truths, t).items()}
    assert found == want


def test_match_tail_and_rounds_agree(spark):
    preds, truths = brute.boxes(150, seed=21), brute.boxes(100, seed=22)
    pairs = matching.candidate_pairs(brute.frame(spark, preds), brute.frame(spark, truths, "truth_id", "s"),
                                     "detector_score", least_iou=0.1)
    def run(**o):
        return {(r["pred"], r["truth"]) for r in matching.match_rounds(pairs, ["product_id"], **o).collect()}
    assert run(tail_pairs=0) == run(tail_pairs=10 ** 9, tail_after=0)


def test_bbox_join_finds_every_pair_once_across_sizes(spark):
    a, b = brute.boxes(150, seed=31), brute.boxes(150, seed=32)
    a.append((900, 0, (-500.0, -500.0, 500.0, 500.0), 1.0))
    b.append((901, 0, (3.0, 3.0, 3.01, 3.01), 1.0))
    got = spatial_join.bbox_join(brute.frame(spark, a), brute.frame(spark, b), touching=True)
    found = [(r["a_object_id"], r["b_object_id"]) for r in got.collect()]
    want = {(p[0], q[0]) for p in a for q in b if p[1] == q[1]
            and p[2][0] <= q[2][2] and p[2][2] >= q[2][0] and p[2][1] <= q[2][3] and p[2][3] >= q[2][1]}
    assert len(found) == len(set(found)) and set(found) == want


def test_prompt_match_uses_each_truth_once(spark):
    preds = spark.createDataFrame(
        [(1, "t", 0, 0.0, 0.0, 4.0, 4.0), (2, "t", 1, 0.0, 0.0, 4.0, 4.0), (3, "t", 2, 10.0, 10.0, 14.0, 14.0)],
        "object_id bigint, tile_path string, position int, x0 double, y0 double, x1 double, y1 double")
    truths = spark.createDataFrame(
        [(7, "t", True, 0.0, 0.0, 4.0, 4.0), (8, "t", False, 10.0, 10.0, 14.0, 14.0)],
        "truth_id bigint, tile_path string, has_mask boolean, x0 double, y0 double, x1 double, y1 double")
    got = matching.prompt_match(preds, truths).collect()
    assert [(r["object_id"], r["truth_id"]) for r in got] == [(1, 7)]


def test_aoi_keeps_exactly_forty_percent(spark):
    rows = [(0, (0, 0, 10, 10)), (1, (200, 0, 210, 10)), (2, (95, 0, 105, 10)), (3, (97, 20, 107, 30)),
            (4, (96, 40, 106, 50)), (5, (5, 5, 5, 9))]
    df = spark.createDataFrame([(i, 0, *map(float, b)) for i, b in rows],
                               "object_id bigint, product_id int, x0 double, y0 double, x1 double, y1 double")
    aoi = spark.createDataFrame([(0, 0.0, 0.0, 100.0, 100.0)],
                                "product_id int, x0 double, y0 double, x1 double, y1 double")
    got = {r["object_id"]: r["x1"] for r in spatial_join.aoi_filter(df, aoi, "object_id").collect()}
    assert got == {0: 10.0, 2: 100.0, 4: 100.0}


def test_candidates_share_crowds(spark):
    pairs = spark.createDataFrame(
        [("a", 1, 0.9, 5, 0.8, True), ("a", 2, 0.8, 5, 0.7, True), ("a", 3, 0.7, 6, 0.6, False)],
        "k string, pred bigint, score double, truth bigint, iou double, shared boolean")
    for tail in (0, 100):
        got = matching.match_rounds(pairs.withColumn("tier", F.col("shared").cast("int")), ["k"],
                                    tail_pairs=tail, tail_after=0)
        assert {(r["pred"], r["truth"]) for r in got.collect()} == {(1, 5), (2, 5), (3, 6)}


def test_truths_on_one_spot(spark):
    """A third of the truths are copies of one another, and some others have the same IoU."""
    preds = brute.boxes(80, seed=61, span=12) + [(500 + i, 0, (3, 3, 6 + i % 3 * 0.1, 6), i % 10 / 10) for i in range(30)]
    truths = brute.boxes(50, seed=62, span=12) + [(600 + i, 0, (3, 3, 6, 6), 0.5) for i in range(25)]
    truths += [(610.5 * 2 + i, 0, (3, 3, 6, 6), 0.5) for i in range(3)]
    truths = [(int(i), *rest) for i, *rest in truths]
    got = matching.greedy_match(brute.frame(spark, preds), brute.frame(spark, truths, "truth_id", "s"), [0.3])
    assert {(r["object_id"], r["truth_id"]) for r in got.collect()} == set(brute.match(preds, truths, 0.3).items())
