"""Stand-in models for the scoring operators: plain functions of what a tile or object holds."""

from __future__ import annotations

import numpy as np
import pandas as pd


def load_detector():
    """Sees the truth numbers of a tile and proposes two boxes for each."""
    def predict(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for path, seen in zip(pdf["tile_path"], pdf["seen"]):
            boxes, scores, classes = [], [], []
            for key in seen:
                x, y = float(key % 32) * 8, float(key // 32 % 32) * 8
                for k in range(2):
                    boxes.append({"x0": x + k, "y0": y, "x1": x + 5 + k, "y1": y + 5})
                    scores.append(((int(key) * 7 + k * 31) % 100) / 100)
                    classes.append(int(key % 3))
            rows.append((path, boxes, scores, classes))
        return pd.DataFrame(rows, columns=["tile_path", "boxes", "scores", "classes"])

    return predict


def load_segmenter():
    """Fills every prompt box row by row."""
    def predict(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for path, prompts in zip(pdf["tile_path"], pdf["prompts"]):
            ids = [int(p["object_id"]) for p in prompts]
            filled = [[{"line": y, "c0": int(np.floor(p["x0"])), "c1": int(np.ceil(p["x1"]))}
                       for y in range(int(np.floor(p["y0"])), int(np.ceil(p["y1"])))]
                      for p in prompts]
            rows.append((path, ids, filled, [0.5 + (i % 2) / 4 for i in ids]))
        return pd.DataFrame(rows, columns=["tile_path", "object_ids", "masks", "scores"])

    return predict


def load_classifier():
    """The logits as they are."""
    def predict(pdf: pd.DataFrame) -> pd.DataFrame:
        logits = [np.asarray(v, dtype=float) for v in pdf["logits"]]
        return pd.DataFrame({"object_id": pdf["object_id"], "tile_path": pdf["tile_path"],
                             "scores": [v.tolist() for v in logits],
                             "predicted": [int(v.argmax()) for v in logits]})

    return predict


def float_pixels(embeddings):
    """Embeddings as 8 x 8 float pixel blocks, scaled to the range of a 16-bit raster."""
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "pixels": [
                (np.asarray(v, dtype="float32") * np.float32(65536)).tobytes()
                for v in pdf["embedding"]]})

    return embeddings.select("vec_id", "embedding").mapInPandas(run, "vec_id bigint, pixels binary")
