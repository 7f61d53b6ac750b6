"""Running user-supplied models over tiles, prompts and objects.

A model enters as a plain function over a pandas frame; Spark partitions the rows and ships Arrow
batches. `load` is called once per task, so weights are read once there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from crownframe.operators.numbering import in_batches

Predict = Callable[[pd.DataFrame], pd.DataFrame]
BOXES = "array<struct<x0:double,y0:double,x1:double,y1:double>>"
RUNS = "array<struct<line:int,c0:int,c1:int>>"


#: Rows given to a model at a time, and prompts. What a model returns for a whole Arrow batch would not fit in memory.
ROWS, PROMPTS = 64, 1024


def _mapped(df: DataFrame, load: Callable[[], Predict], schema: str, rows: int = ROWS) -> DataFrame:
    """The model over `rows` rows at a time. Batches stay Arrow until then: prompts as Python objects take far more memory."""
    kind = T.StructType.fromDDL(schema)
    out = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = load()
        for b in batches:
            for k in range(0, b.num_rows, rows):
                found = pa.Table.from_pandas(predict(b.slice(k, rows).to_pandas()), schema=out, preserve_index=False)
                yield from found.to_batches()

    return df.mapInArrow(run, kind)


def score_tiles(tiles: DataFrame, load: Callable[[], Predict]) -> DataFrame:
    """Per tile the arrays `boxes, scores, classes`, ready for `flatten_detections`."""
    schema = f"tile_path string, boxes {BOXES}, scores array<double>, classes array<int>"
    return _mapped(tiles, load, schema)


def score_prompts(prompts: DataFrame, tiles: DataFrame, load: Callable[[], Predict],
                  batch: int = 64, tile_col: str = "tile_path") -> DataFrame:
    """Masks for box prompts: rows `(tile, object_ids, masks, scores)` per batch of a tile.

    A tile with many prompts becomes several rows of at most `batch` prompts each, every one next to
    the tile's own columns. A model is given about `PROMPTS` prompts at a time, one batch at least.
    """
    batched = in_batches(prompts, [tile_col], [F.col("object_id")], batch)
    grouped = batched.groupBy(tile_col, "batch").agg(F.array_sort(F.collect_list(
        F.struct("object_id", "x0", "y0", "x1", "y1"))).alias("prompts"))
    rows = grouped.join(tiles, tile_col)
    schema = (f"{tile_col} string, object_ids array<bigint>, masks array<{RUNS}>, "
              "scores array<double>")
    return _mapped(rows, load, schema, max(PROMPTS // batch, 1))


def score_objects(objects: DataFrame, load: Callable[[], Predict]) -> DataFrame:
    """Per object `scores` and `predicted` class, ready for `flatten_classes`."""
    schema = "object_id bigint, tile_path string, scores array<double>, predicted int"
    return _mapped(objects, load, schema, PROMPTS)
