"""COCO annotation documents as three tables: images, annotations, categories.

A document written here is a folder of text parts whose concatenation is one JSON document with one
element per line, so writing and reading it again is split over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crownframe.functions.batches import changes
from crownframe.operators.numbering import row_index
from crownframe.session import cut
from crownframe.sources.files import Replacement


class Coco(NamedTuple):
    images: DataFrame
    annotations: DataFrame
    categories: DataFrame


IMAGE = "struct<id:bigint,file_name:string,width:int,height:int>"
ANNOTATION = ("struct<id:bigint,image_id:bigint,category_id:int,bbox:array<double>,"
              "segmentation:string,area:string,iscrowd:int,score:double>")
CATEGORY = "struct<id:int,name:string,supercategory:string>"
DOCUMENT = f"images array<{IMAGE}>, annotations array<{ANNOTATION}>, categories array<{CATEGORY}>"


def segmentation_columns(text: Column) -> dict[str, Column]:
    """`rings`, `counts`, `counts_text`, `size` from the text of any segmentation encoding."""
    text = F.trim(text)
    nested = F.from_json(text, "array<array<double>>")
    flat = F.from_json(text, "array<double>")
    coded = F.from_json(text, "struct<counts:string,size:array<int>>")
    listed = coded["counts"].startswith("[")
    return {
        "rings": F.when(text.rlike(r"^\[\s*\[") | text.rlike(r"^\[\s*\]$"), nested)
                  .when(text.startswith("["), F.array(flat)),
        "counts": F.when(listed, F.from_json(coded["counts"], "array<int>")),
        "counts_text": F.when(~listed, coded["counts"]),
        "size": coded["size"]}


def _tables(docs: DataFrame) -> Coco:
    def part(name):
        return docs.select("source_id", F.posexplode(name).alias("pos", "_e")).select(
            "source_id", "pos", "_e.*")

    annotations = part("annotations")
    annotations = annotations.withColumns(segmentation_columns(F.col("segmentation"))).drop(
        "segmentation")
    return Coco(part("images"), annotations, part("categories"))


def read_coco(spark: SparkSession, path: str | Sequence[str]) -> Coco:
    """Documents as they come, one JSON text per file; `source_id` is the file path. Each is read by one task, which suits many
    small documents; for large ones see `read_coco_pieces`."""
    docs = spark.read.schema(DOCUMENT).option("multiLine", True).json(path)
    return _tables(docs.withColumn("source_id", F.col("_metadata.file_path")))


def _brackets(text: Column) -> Column:
    """Brackets opened less brackets closed; a closing brace never stands inside a piece."""
    return F.length(F.regexp_replace(text, r"[^\[{]", "")) - F.length(F.regexp_replace(text, r"[^\]]", ""))


def _pieces(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The text up to each closing brace, with what is known before it: `inside` a string or not, and `depth`.

    Files are split like lines. A piece's effect on the state depends on the state before it, so each has two: the brackets
    it opens if it starts outside a string (`d0`) or inside (`d1`); its quotes tell whether it turns the one into the
    other. Effects are put together within blocks, then over blocks, a row each, and the result is handed back.
    """
    # A split of a file is one block, read in order by one task, so no row needs to be sorted.
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("source_id"), F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_n"), "value")
    stamped = cut(raw.select("source_id", "_blk", F.struct("_blk", "_n").alias("_pos"), "value"), "json")
    segments = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"', -1)
    quotes = F.size(segments) - 1

    def effect(inside):
        outside = F.filter(segments, lambda x, i: i % 2 == inside)
        return _brackets(F.array_join(outside, "")) - ((quotes + inside) % 2 == 0).cast("int")

    stamped = stamped.select("*", quotes.alias("q"), effect(0).alias("d0"), effect(1).alias("d1"))
    block = ["source_id", "_blk"]
    before = Window.partitionBy(*block).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    prior = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    local = stamped.withColumn("_odd", prior("q") % 2)
    local = local.withColumns({"_a": F.when(F.col("_odd") == 0, F.col("d0")).otherwise(F.col("d1")),
                               "_b": F.when(F.col("_odd") == 0, F.col("d1")).otherwise(F.col("d0"))})
    local = cut(local.withColumns({"_da": prior("_a"), "_db": prior("_b")}), "json-effects")
    blocks = local.groupBy(*block).agg((F.sum("q") % 2).alias("q"), F.sum("_a").alias("a"), F.sum("_b").alias("b"))
    earlier = Window.partitionBy("source_id").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_p", F.coalesce(F.sum("q").over(earlier), F.lit(0)) % 2)
    starts = starts.withColumn("_d", F.coalesce(F.sum(F.when(F.col("_p") == 0, F.col("a")).otherwise(F.col("b"))).over(earlier), F.lit(0)))
    state = local.join(starts.select(*block, "_p", "_d"), block)
    inside = (F.col("_odd") + F.col("_p")) % 2
    depth = F.col("_d") + F.when(F.col("_p") == 0, F.col("_da")).otherwise(F.col("_db"))
    return state.select(*block, "_pos", "value", inside.alias("inside"), depth.alias("depth"),
                        ((inside + F.col("q")) % 2 == 0).alias("closes"),
                        (depth + F.when(inside == 0, F.col("d0")).otherwise(F.col("d1"))).alias("after"))


def coco_groups(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The text of documents in groups that are each one element of an outer array, or what stands between two:
    source_id, _h and _e (their order), section (its key; null between), starts (the section), `lead` (what stands before
    the element) and `t`. All texts of a document in order are the document.

    Elements are the objects of the document's outer arrays; a piece that leaves an array or stands before the first one
    starts a section, named by the key of the next array of objects. Any layout and order of keys and sections is read.
    """
    state = _pieces(spark, path)
    ends = F.col("closes") & (F.col("after") == 2)
    starts = (F.col("inside") == 0) & ((F.col("depth") < 2) | ((F.col("depth") == 2) & F.col("value").rlike(r"^\s*\]")))
    section = r'(?s)"((?:[^"\\]|\\.)*)"\s*:\s*\[\s*\{(.*)$'
    named, rest = F.regexp_extract("value", section, 1), F.regexp_extract("value", section, 2)
    first = F.col("starts") & (F.col("section") != "")
    next_ = ~F.col("starts") & (F.col("inside") == 0) & (F.col("depth") == 2)
    block = ["source_id", "_blk"]
    upto = Window.partitionBy(*block).orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = state.withColumns({"ends": ends.cast("int"), "starts": starts}).withColumns({
        "_h": F.sum(F.col("starts").cast("int")).over(upto), "_e": F.sum("ends").over(upto) - F.col("ends"),
        "section": F.when(F.col("starts"), named)})
    marked = cut(marked, "json-pieces")
    sums = marked.groupBy(*block).agg(F.sum(F.col("starts").cast("int")).alias("h"), F.sum("ends").alias("e"))
    earlier = Window.partitionBy("source_id").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*block, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_o{c}") for c in "he"])
    over = (F.col("inside") == 0) & (F.col("depth") == 0) & F.col("value").rlike(r"^\s*$")      # blanks behind a document
    text = F.when(first, F.concat(F.lit("{"), rest)).when(next_, F.regexp_replace("value", r"^\s*,\s*", "")).otherwise(F.col("value"))
    lead = F.when(first, F.expr("left(value, length(value) - length(rest) - 1)")).when(
        next_, F.regexp_extract("value", r"^\s*,\s*", 0)).otherwise("")
    placed = marked.join(offsets, block).withColumn("rest", rest).select(
        "source_id", "_pos", "ends", "starts", "section", (F.col("_h") + F.col("_oh")).alias("_h"), (F.col("_e") + F.col("_oe")).alias("_e"),
        lead.alias("lead"), F.concat(text, F.when(over, "").otherwise("}")).alias("text"))
    placed = cut(placed, "json-placed")
    sections = placed.filter("starts and section <> ''").select("source_id", "_h", F.col("_e").alias("_first"), "section")
    groups = placed.groupBy("source_id", "_h", "_e").agg(
        F.array_sort(F.collect_list(F.struct("_pos", "lead", "text"))).alias("p"), F.max("ends").alias("ends"),
        F.max("starts").alias("starts"))                                                         # one element each
    groups = groups.join(sections, ["source_id", "_h"], "left")
    element = (F.col("ends") == 1) & F.col("section").isNotNull()
    return groups.select("source_id", "_h", "_e", "starts", F.when(element, F.col("section")).alias("section"),
                         (F.col("_e") - F.col("_first")).cast("int").alias("pos"), F.col("p")[0]["lead"].alias("lead"),
                         F.array_join(F.transform("p", lambda p: p["text"]), "").alias("t"))


def read_coco_pieces(spark: SparkSession, path: str | Sequence[str]) -> Coco:
    """`read_coco` for large documents: each is read, split and parsed by many tasks, and none holds a document."""
    elements = coco_groups(spark, path)

    def part(name, schema):
        rows = elements.filter(F.col("section") == name)
        return rows.select("source_id", "pos", F.from_json("t", schema).alias("_e")).select("source_id", "pos", "_e.*")

    annotations = part("annotations", ANNOTATION)
    annotations = annotations.withColumns(segmentation_columns(F.col("segmentation"))).drop("segmentation")
    return Coco(part("images", IMAGE), annotations, part("categories", CATEGORY))


def _written(target: str | None):
    """Writes the lines of each file, which come one after the other, and gives the names of the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = out = None
        try:
            for b in batches:
                names = b.column("source_id")
                heads = np.flatnonzero(np.append(True, changes(b, ["source_id"])[1:])[:b.num_rows])
                done = []
                for h, e in zip(heads.tolist(), np.append(heads[1:], b.num_rows).tolist()):
                    if names[h].as_py() != source:
                        if out is not None:
                            out.finish()
                            done.append(source)
                        source = names[h].as_py()
                        out = None
                        out = Replacement(source, target)
                    out.write("".join(f"{t}\n" for t in b.column("text").slice(h, e - h).to_pylist()).encode())
                yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["source_id"])
            if out is not None:
                out.finish()
                out = None
                yield pa.RecordBatch.from_arrays([pa.array([source], pa.string())], names=["source_id"])
        finally:
            if out is not None:
                out.drop()

    return run


def write_files(rows: DataFrame, order: Sequence[str], target: str | None = None) -> None:
    """One file per `source_id` from the lines in `text`, by `order`: in the place of that file, or under its name in the
    folder `target`. Each file is written whole beside the others first and then moved, so a run that ends halfway
    leaves every file as it was or as it should be. Tasks write and move the files, so many take no longer on the driver than few;
    `rows` must not be read from the files themselves."""
    lines = rows.repartition("source_id").sortWithinPartitions("source_id", *order).select("source_id", "text")
    lines.mapInArrow(_written(target), "source_id string").write.format("noop").mode("overwrite").save()


def read_coco_parts(spark: SparkSession, path: str) -> Coco:
    """A folder written by `write_coco`, read line by line. `source_id` is the sub-folder value.

    An element's outer keys tell its section: annotations have `image_id`, images `file_name` (written even if
    null) and no `image_id`, and the others are categories.
    """
    lines = spark.read.text(path)
    if "source_id" not in lines.columns:
        lines = lines.withColumn("source_id", F.lit(path))
    element = F.regexp_replace("value", "^,", "")
    rows = lines.filter(element.startswith('{"id"')).select("source_id", element.alias("_t"))
    keys = F.json_object_keys("_t")
    of_image, named = F.array_contains(keys, "image_id"), F.array_contains(keys, "file_name")

    def section(schema, wanted):
        names = schema[len("struct<"):-1]
        parsed = rows.filter(wanted).select(
            "source_id", F.from_json("_t", f"struct<{names}>").alias("_e"))
        return parsed.select("source_id", "_e.*")

    annotations = section(ANNOTATION, of_image)
    annotations = annotations.withColumns(segmentation_columns(F.col("segmentation"))).drop(
        "segmentation")
    return Coco(section(IMAGE, named & ~of_image), annotations, section(CATEGORY, ~named & ~of_image))


def coco_tables(objects: DataFrame, categories: DataFrame, tile_col: str = "tile_path",
                score: str | None = None, category: str = "category_id",
                extra: Sequence[str] = (), width: int = 0, height: int = 0,
                id_col: str = "object_id", source: str | None = None) -> Coco:
    """Objects as COCO rows: image ids per tile and annotation ids per object, both dense from 1."""
    keys = [source] if source else []
    objects = objects.drop("id", "image_id")
    tiles = objects.select(*keys, tile_col).distinct()
    images = row_index(tiles, keys, [F.col(tile_col)], "id", start=1)
    rows = objects.join(images.withColumnRenamed("id", "image_id"), [*keys, tile_col])
    rows = row_index(rows, keys, [F.col("image_id"), F.col(id_col)], "id", start=1)
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    columns = [*keys, "id", "image_id", F.col(category).cast("int").alias("category_id"),
               F.array("x0", "y0", w, h).alias("bbox"), (w * h).alias("area"),
               F.lit(0).alias("iscrowd")]
    if "rings" in objects.columns:
        columns.append("rings")
    if score:
        columns.append(F.col(score).alias("score"))
    annotations = rows.select(*columns, *extra)
    images = images.select(*keys, "id", F.col(tile_col).alias("file_name"),
                           F.lit(width).alias("width"), F.lit(height).alias("height"))
    return Coco(images, annotations, categories)


def write_coco(coco: Coco, path: str, by_source: bool = False) -> None:
    """Write the documents; with `by_source` one folder `source_id=...` per document.

    The parts of a folder, put together in name order, are the document.
    """
    keys = ["source_id"] if by_source else []

    def lines(df, section, names):
        columns = [c for c in names if c in df.columns]
        columns += [c for c in df.columns if c not in (*columns, *keys)]
        columns = [F.col("rings").alias("segmentation") if c == "rings" else F.col(c)
                   for c in columns]
        text = F.to_json(F.struct(*columns), {"ignoreNullFields": str(section == 1).lower()})
        if keys:
            firsts = df.groupBy(*keys).agg(F.min("id").alias("_first"))
            df = df.join(firsts, keys)
        else:
            df = df.withColumn("_first", F.lit(df.agg(F.min("id")).first()[0]))
        comma = F.when(F.col("id") == F.col("_first"), "").otherwise(",")
        return df.select(*keys, F.lit(section).alias("_s"), F.col("id").cast("long").alias("_o"),
                         F.concat(comma, text).alias("value"))

    parts = [lines(coco.images, 0, ("id", "file_name")),
             lines(coco.annotations, 1, ("id", "image_id")),
             lines(coco.categories, 2, ("id", "name", "supercategory"))]
    heads = F.array(*[F.struct(F.lit(s).alias("_s"), F.lit(o).cast("long").alias("_o"),
                               F.lit(t).alias("value")) for s, o, t in (
        (0, -1, '{"images":['), (1, -1, '],"annotations":['), (2, -1, '],"categories":['),
        (3, -1, "]}"))])
    sources = coco.images.select(*keys).distinct() if keys else coco.images.limit(1)
    frame = sources.select(*keys, F.explode(heads).alias("_h")).select(*keys, "_h.*")
    for part in parts:
        frame = frame.unionByName(part)
    order = [*keys, "_s", "_o"]
    written = frame.repartitionByRange(*order).sortWithinPartitions(*order).drop("_s", "_o")
    writer = written.write.mode("errorifexists")
    (writer.partitionBy(*keys) if keys else writer).text(path)


def coco_union(images: DataFrame, annotations: DataFrame, categories: DataFrame,
               order: Sequence[str] = ("id",), check: bool = True) -> Coco:
    """Many documents (by `source_id`) as one: ids 0..n-1 in source and row order.

    Categories come from the first source. An annotation without its image is an error.
    """
    if check:
        dangling = annotations.select("source_id", "image_id").join(
            images.select("source_id", F.col("id").alias("image_id")),
            ["source_id", "image_id"], "left_anti").limit(1).collect()
        if dangling:
            raise ValueError(f"annotation of a missing image: {dangling[0].asDict()}")
    sort = [F.col("source_id"), *[F.col(c) for c in order]]
    new_images = row_index(images, [], sort, "_new")
    ids = new_images.select("source_id", F.col("id").alias("image_id"), F.col("_new").alias("_img"))
    new_images = new_images.withColumn("id", F.col("_new")).drop("_new")
    moved = annotations.join(ids, ["source_id", "image_id"]).withColumn(
        "image_id", F.col("_img")).drop("_img")
    moved = row_index(moved, [], sort, "_new").withColumn("id", F.col("_new")).drop("_new")
    first = images.agg(F.min("source_id").alias("source_id"))
    cats = categories.join(first, "source_id", "left_semi")
    return Coco(new_images, moved, cats)
