"""Plain sequential versions of the greedy rules, as the yardstick for the distributed ones."""

import hashlib
import math
import random


def turn(row):
    """Sort key of (id, product, box, score): score descending, none last, then a hash of the id, then the id."""
    score = row[3]
    value = -math.inf if score is None or math.isnan(score) else score
    return -value, hashlib.md5(str(row[0]).encode()).hexdigest()[:15], row[0]


def iou(a, b):
    w = max(min(a[2], b[2]) - max(a[0], b[0]), 0.0)
    h = max(min(a[3], b[3]) - max(a[1], b[1]), 0.0)
    i = w * h
    u = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - i
    return i / u if u else 0.0


def boxes(n, seed, span=40, sizes=(1, 8), products=2):
    """(id, product, box, score) with ties in score, copies and a few large boxes."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if out and rng.random() < 0.15:
            box = rng.choice(out)[2]
        else:
            size = rng.choice([sizes[0], sizes[1], rng.uniform(*sizes), 30 if rng.random() < 0.05 else 3])
            x, y = rng.uniform(0, span), rng.uniform(0, span)
            box = (x, y, x + size, y + size * rng.uniform(0.5, 1.5))
        out.append((i, rng.randrange(products), box, rng.randrange(20) / 20))
    return out


def nms(rows, t):
    kept = []
    for row in sorted(rows, key=turn):
        if all(k[1] != row[1] or iou(k[2], row[2]) <= t for k in kept):
            kept.append(row)
    return {r[0] for r in kept}


def match(preds, truths, t):
    used, out = set(), {}
    for p in sorted(preds, key=turn):
        best = None
        for g in truths:
            if g[1] != p[1] or g[0] in used:
                continue
            v = iou(p[2], g[2])
            if v >= t and v > 0 and (best is None or (v, -g[0]) > (best[0], -best[1])):
                best = (v, g[0])
        if best:
            used.add(best[1])
            out[p[0]] = best[1]
    return out


def frame(spark, rows, ident="object_id", score="detector_score"):
    return spark.createDataFrame(
        [(r[0], r[1], *map(float, r[2]), r[3]) for r in rows],
        f"{ident} bigint, product_id int, x0 double, y0 double, x1 double, y1 double, {score} double")
