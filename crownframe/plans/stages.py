"""Ordered stages over the objects table, with a check before anything runs.

A stage is a function from state to result plus what it needs and makes. The check walks through
all stages on column names alone, so a missing model or column is reported before the first job.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from crownframe.functions import boxes as B
from crownframe.operators import filters, scoring
from crownframe.operators.merging import merge_results
from crownframe.operators.masks import RUN_ARRAY, coded_arrays, collect_runs, explode_runs, nms_ioa_disambiguate, plain_arrays
from crownframe.operators.suppression import nms
from crownframe.operators.tiling import labeled_tiles, polygon_tiles, tile_grid
from crownframe.session import cut, on_file
from crownframe.sources.coco import coco_tables, write_coco
from crownframe.sources.geotables import write_objects


class StageError(ValueError):
    """A stage lacks what it needs."""


@dataclass(frozen=True)
class State:
    """Tables a run works on; every field may be missing."""

    rasters: DataFrame | None = None
    tiles: DataFrame | None = None
    objects: DataFrame | None = None
    product_name: str | None = None
    outputs: dict[str, DataFrame] = field(default_factory=dict)
    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    documents: dict[str, str] = field(default_factory=dict)

    def names(self) -> set[str]:
        return {n for n in ("rasters", "tiles", "objects", "product_name")
                if getattr(self, n) is not None}

    def columns(self) -> set[str]:
        return set(self.objects.columns) if self.objects is not None else set()


@dataclass(frozen=True)
class Result:
    objects: DataFrame | None = None
    tiles: DataFrame | None = None
    objects_are_new: bool = True
    save_as: str | None = None
    coco: tuple[str | None, str | None] | None = None      # score and category column of the stage's document
    counts: dict[str, Column] = field(default_factory=dict)


@dataclass(frozen=True)
class Stage:
    name: str
    run: Callable[[State], Result]
    needs: frozenset[str] = frozenset()
    needs_columns: frozenset[str] = frozenset()
    makes: frozenset[str] = frozenset()
    makes_columns: frozenset[str] = frozenset()
    hints: dict[str, str] = field(default_factory=dict)


def problems(stage: Stage, names: set[str], columns: set[str]) -> list[str]:
    """What a stage would lack, with its hints."""
    found = []
    for kind, missing in (("state", sorted(stage.needs - names)),
                          ("column", sorted(stage.needs_columns - columns))):
        for item in missing:
            hint = stage.hints.get(item)
            found.append(f"missing {kind} '{item}'" + (f" ({hint})" if hint else ""))
    return found


def check(stages: Sequence[Stage], state: State) -> list[str]:
    """All problems of a run, found without running it."""
    names, columns, found = state.names(), state.columns(), []
    for i, stage in enumerate(stages):
        found += [f"stage {i} ({stage.name}): {p}" for p in problems(stage, names, columns)]
        names, columns = names | stage.makes, columns | stage.makes_columns
    return found


def _counted(merged: DataFrame, before: State, result: Result, fresh: DataFrame, name: str) -> tuple[DataFrame, dict[str, int]]:
    """The objects after a stage, written, and what was counted during the write: `objects`, `dropped` ones, those
    `unmatched` by the result of a stage that only adds columns, and the stage's own counts."""
    measured = {"objects": F.count(F.lit(1)), **result.counts}
    earlier = before.columns() if not result.objects_are_new else None
    added = [c for c in fresh.columns if earlier and c not in earlier and c in merged.columns]
    if added:
        measured["unmatched"] = F.count_if(functools.reduce(operator.and_, (F.col(c).isNull() for c in added)))
    seen = Observation(name)
    written = cut(merged.observe(seen, *[c.alias(k) for k, c in measured.items()]), name)
    numbers = {k: int(v) for k, v in seen.get.items()}
    if earlier is not None and before.counts:
        numbers["dropped"] = list(before.counts.values())[-1]["objects"] - numbers["objects"]
    return written, numbers


def stage_document(objects: DataFrame, score: str | None, category: str | None, path: str,
                   categories: DataFrame | None = None) -> None:
    """A stage's objects as a COCO document: scores, outlines if there are any, and the other scores and classes as keys of
    their own. Without `categories` the classes are named by their number; without a class column there is one, `object`."""
    kept = [c for c in objects.columns if c.endswith(("_score", "_class")) and c not in (score, category)]
    if category is None:
        objects, category = objects.withColumn("category_id", F.lit(1)), "category_id"
        names = F.lit("object")
    else:
        names = F.col("id").cast("string")
    if categories is None:
        categories = objects.select(F.col(category).cast("int").alias("id")).filter("id is not null").distinct().select(
            "id", names.alias("name"), F.lit(None).cast("string").alias("supercategory"))
    write_coco(coco_tables(objects, categories, score=score, category=category, extra=kept), path)


def run_stages(stages: Sequence[Stage], state: State, output: str | None = None,
               materialize: bool = True, documents: bool = False, categories: DataFrame | None = None) -> State:
    """Run the stages in order; every stage's objects stay in `outputs` under `index_name`.

    A leading tiling stage is skipped when tiles are given. With `output` the stage tables that ask
    for it and the final table are written, and with `documents` a COCO document per stage as well
    (`documents` of the state has their folders). If stages are materialized, `counts` has what was counted in their
    own writes, without another job.
    """
    stages = list(stages)
    if state.tiles is not None and stages and stages[0].name == "tiling":
        stages = stages[1:]
    found = check(stages, state)
    if found:
        raise StageError("the run cannot start:\n" + "\n".join(found))
    for i, stage in enumerate(stages):
        found = problems(stage, state.names(), state.columns())
        if found:
            raise StageError(f"{stage.name}: " + "; ".join(found))
        result = stage.run(state)
        objects, counts, made = state.objects, dict(state.counts), dict(state.documents)
        if result.objects is not None:
            fresh = cut(result.objects, stage.name) if materialize else result.objects
            objects = merge_results(objects, fresh, result.objects_are_new)
            if materialize:
                objects, counts[f"{i}_{stage.name}"] = _counted(objects, state, result, fresh, stage.name)
        outputs = dict(state.outputs)
        if objects is not None:
            outputs[f"{i}_{stage.name}"] = objects
            if output and result.save_as:
                write_objects(objects, f"{output}/{i}_{stage.name}", result.save_as)
            if output and documents and result.coco:
                made[f"{i}_{stage.name}"] = f"{output}/{i}_{stage.name}_coco"
                stage_document(objects, *result.coco, made[f"{i}_{stage.name}"], categories)
        state = replace(state, objects=objects, outputs=outputs, counts=counts, documents=made,
                        tiles=result.tiles if result.tiles is not None else state.tiles)
    if output and state.objects is not None:
        write_objects(state.objects, output, "final")
    return state


def run_stage(stage: Stage, state: State, output: str | None = None) -> State:
    """One stage on its own, with the same checks."""
    return run_stages([stage], state, output)


# --- the stages -------------------------------------------------------------------------------

_BOXES = frozenset(B.BOX)


def tiling_stage(kind: str = "tile", size: int = 1024, overlap: float = 0.5,
                 min_ratio: float = 0.4, keep_unlabeled: bool = False, buffer: int = 5,
                 variable: bool = False) -> Stage:
    """`tile`: plain grid; `tile_labeled`: grid tiles with objects; `polygon`: one tile per object."""
    if kind not in ("tile", "tile_labeled", "polygon"):
        raise ValueError(f"unknown tile kind {kind!r}")

    def run(state: State) -> Result:
        if kind == "polygon":
            return Result(tiles=polygon_tiles(state.objects, None if variable else size, buffer))
        grid = tile_grid(state.rasters, size, overlap)
        if kind == "tile":
            if state.objects is not None:
                raise StageError("plain tiles take no objects; use 'tile_labeled' or 'polygon'")
            return Result(tiles=grid)
        tiles, _ = labeled_tiles(state.objects, grid, min_ratio=min_ratio,
                                 keep_unlabeled=keep_unlabeled)
        return Result(tiles=tiles)

    labelled = kind != "tile"
    return Stage("tiling", run,
                 needs=frozenset({"rasters"} | ({"objects"} if labelled else set())),
                 needs_columns=_BOXES if labelled else frozenset(),
                 makes=frozenset({"tiles"}),
                 hints={"rasters": "tiling needs raster rows with width and height",
                        "objects": f"kind '{kind}' needs objects; use 'tile' for plain tiles"})


def detector_stage(load: Callable[[], scoring.Predict]) -> Stage:
    def run(state: State) -> Result:
        rows = filters.flatten_detections(scoring.score_tiles(state.tiles, load))
        return Result(objects=rows, save_as="notaggregated", coco=("detector_score", "detector_class"))

    return Stage("detector", run, needs=frozenset({"tiles"}), makes=frozenset({"objects"}),
                 makes_columns=_BOXES | {"object_id", "tile_path", "detector_score",
                                         "detector_class"},
                 hints={"tiles": "add a tiling stage before the detector"})


def segmenter_stage(load: Callable[[], scoring.Predict], needs_prompts: bool = True,
                    padding: float = 0.0, batch: int = 64) -> Stage:
    def run(state: State) -> Result:
        if needs_prompts:
            prompts = state.objects.select("object_id", "tile_path", *B.BOX)
            if padding:
                prompts = prompts.withColumns(B.pad(B.box(), padding))
            scored = scoring.score_prompts(prompts, state.tiles, load, batch)
        else:
            schema = f"tile_path string, masks array<{scoring.RUNS}>, scores array<double>"
            scored = scoring._mapped(state.tiles, load, schema)
        rows = filters.flatten_masks(scored)
        low = F.array_min(F.transform("mask", lambda r: r["line"]))
        high = F.array_max(F.transform("mask", lambda r: r["line"])) + 1
        boxed = rows.withColumns({
            "x0": F.array_min(F.transform("mask", lambda r: r["c0"])).cast("double"),
            "y0": low.cast("double"),
            "x1": F.array_max(F.transform("mask", lambda r: r["c1"])).cast("double"),
            "y1": high.cast("double")})
        return Result(objects=boxed, objects_are_new=not needs_prompts, save_as="notaggregated",
                      coco=("segmenter_score", None), counts={"without_mask": F.count_if(F.coalesce(F.size("mask"), F.lit(0)) <= 0)})

    needs = {"tiles"} | ({"objects"} if needs_prompts else set())
    return Stage("segmenter", run, needs=frozenset(needs),
                 needs_columns=_BOXES | {"object_id"} if needs_prompts else frozenset(),
                 makes=frozenset({"objects"}),
                 makes_columns=_BOXES | {"object_id", "tile_path", "segmenter_score", "mask"},
                 hints={"tiles": "add a tiling stage before the segmenter",
                        "objects": "this segmenter needs box prompts, add a detector before it"})


def classifier_stage(load: Callable[[], scoring.Predict]) -> Stage:
    def run(state: State) -> Result:
        scored = filters.flatten_classes(scoring.score_objects(state.objects, load))
        return Result(objects=scored, objects_are_new=False, save_as="notaggregated", coco=("classifier_score", "classifier_class"),
                      counts={"unclassified": F.count_if(F.col("classifier_class").isNull())})

    return Stage("classifier", run, needs=frozenset({"objects"}),
                 needs_columns=frozenset({"object_id", "tile_path"}),
                 makes=frozenset({"objects"}),
                 makes_columns=frozenset({"classifier_score", "classifier_class",
                                          "classifier_scores"}),
                 hints={"object_id": "ids tie class scores to objects"})


def aggregator_stage(score_threshold: float = 0.2, nms_threshold: float = 0.5,
                     weights: dict[str, float] | None = None,
                     method: str = "weighted_geometric_mean", edge_band: float | None = None,
                     least_centroid_weight: float | None = None,
                     keys: Sequence[str] = ("product_id",), nms_algorithm: str = "iou",
                     best_geom_keep_area_ratio: float = 0.5) -> Stage:
    """Fuse scores, then suppress duplicates across tiles.

    `nms_algorithm` is `iou`, by the boxes or, where the objects have a `runs` column (their mask as an array of
    line, c0, c1), by the masks; or `ioa-disambiguate`, which gives shared pixels to the stronger mask and keeps
    what is left of the weaker one, if that is at least `best_geom_keep_area_ratio` of it.
    `edge_band` and `least_centroid_weight` need the tile windows `px0..py1` on the objects.
    """
    if nms_algorithm not in ("iou", "ioa-disambiguate"):
        raise ValueError(f"unknown suppression {nms_algorithm!r}, expected 'iou' or 'ioa-disambiguate'")
    weights = weights or filters.weights_from()
    used = {c for c, w in weights.items() if w and w > 0}

    def run(state: State) -> Result:
        rows = filters.drop_stage_columns(state.objects)
        rows = filters.fuse_scores(rows, weights, method)
        if least_centroid_weight is not None:
            rows = filters.centroid_distance_weight(rows, least_centroid_weight, "aggregator_score")
        if edge_band:
            rows = filters.edge_band_filter(rows, edge_band)
        masks = "runs" in rows.columns and nms_algorithm == "iou"
        packed = masks and rows.schema["runs"].dataType.simpleString() == RUN_ARRAY.simpleString()
        if packed:          # masks go through the suppression in one value each
            rows = coded_arrays(rows)
        rows = cut(rows, "fused")       # read for the masks, for the suppression and for what it keeps
        if nms_algorithm == "iou":
            runs = None
            if packed:
                runs = rows.filter("length(runs) > 0").select(*keys, "object_id", F.col("runs").alias("at"))
                on_file(runs, now=True)
            elif masks:
                runs = explode_runs(rows, [*keys, "object_id"])
            kept = nms(rows, nms_threshold, score_threshold, "aggregator_score", keys=keys, runs=runs)
            if packed:
                kept = plain_arrays(kept)
        else:
            runs = explode_runs(rows, [*keys, "object_id"])
            rest = nms_ioa_disambiguate(runs, rows.drop("runs"), nms_threshold, best_geom_keep_area_ratio,
                                        score_threshold, "object_id", "aggregator_score", keys)
            kept = rows.drop("runs").join(collect_runs(rest, [*keys, "object_id"]), [*keys, "object_id"])
        return Result(objects=kept, objects_are_new=False, save_as="aggregated", coco=("aggregator_score", None))

    shapes = {"runs"} if nms_algorithm == "ioa-disambiguate" else set()
    windows = {"px0", "py0", "px1", "py1"} if edge_band or least_centroid_weight is not None else set()
    return Stage("aggregator", run, needs=frozenset({"objects"}),
                 needs_columns=frozenset(_BOXES | {"object_id", *keys} | used | windows | shapes),
                 makes=frozenset({"objects"}), makes_columns=frozenset({"aggregator_score"}),
                 hints={c: f"the weight of {c} is above 0, so the column is needed" for c in used}
                 | {"objects": "add a detector or segmenter before the aggregator"})
