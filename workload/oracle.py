"""The queries of `workload.queries` as SQL for DuckDB."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# --- shared definitions ---------------------------------------------------------------------------

TRUTHS = """fx_truths as (
  select o_orderkey as truth_id, cast(o_orderkey // 1024 as int) as product_id,
    cast(o_orderkey % 32 as double) * 8 as x0,
    cast((o_orderkey // 32) % 32 as double) * 8 as y0,
    cast(o_orderkey % 32 as double) * 8 + 2 + cast(o_custkey % 41 as double) / 4 as x1,
    cast((o_orderkey // 32) % 32 as double) * 8 + 2 + cast((o_orderkey * 7) % 41 as double) / 4 as y1,
    cast(o_orderkey % 3 as int) as category_id,
    cast((o_orderkey // 1024) * 16 + (((o_orderkey // 32) % 32) // 8) * 4 + (o_orderkey % 32) // 8
      as bigint) as image_id
  from orders)"""

DETECTIONS = TRUTHS + """, fx_detections as (
  select cast((((l_orderkey * 8 + l_linenumber) * 32768 + l_partkey % 32768) * 1024
      + l_suppkey % 1024) * 64 + cast(l_quantity as bigint) as bigint) as object_id,
    product_id, image_id,
    x0 + cast(l_partkey % 7 - 3 as double) / 4 + case when l_returnflag = 'R' then 5.0::double else 0.0::double end as x0,
    y0 + cast(l_suppkey % 7 - 3 as double) / 4 as y0,
    x1 + cast(l_partkey % 5 - 2 as double) / 4 + case when l_returnflag = 'R' then 5.0::double else 0.0::double end as x1,
    y1 + cast(l_suppkey % 5 - 2 as double) / 4 as y1,
    (l_quantity * 2 - 1) / 100 as detector_score, (100 - l_quantity) / 100 as segmenter_score,
    cast(l_linenumber % 3 as int) as detector_class
  from lineitem join fx_truths on truth_id = l_orderkey)"""

TILES = """fx_tiles as (
  select p.product_id, cast(c.v as int) as col, cast(r.v as int) as row,
    cast(c.v * 64 as double) as px0, cast(r.v * 64 as double) as py0,
    cast(c.v * 64 + 128 as double) as px1, cast(r.v * 64 + 128 as double) as py1
  from (select distinct product_id from fx_truths) p, range(4) c(v), range(4) r(v))"""

ROW_RUNS = """fx_runs as (
  select truth_id, product_id, cast(floor(y0) as int) + cast(k.v as int) as line,
    cast(floor(x0) as int) as c0, cast(ceil(x1) as int) as c1
  from fx_truths, range(14) k(v) where floor(y0) + k.v < ceil(y1))"""

DET_RUNS = """fx_det_runs as (
  select object_id, product_id, cast(floor(y0) as int) + cast(k.v as int) as line,
    cast(floor(x0) as int) as c0, cast(ceil(x1) as int) as c1
  from fx_detections, range(16) k(v) where x1 > x0 and y1 > y0 and floor(y0) + k.v < ceil(y1))"""

RUN_METRICS = """fx_metrics as (
  select concat('loc_', product_id % 3) as location, concat('raster_', product_id) as product_name,
    detector_class as run_id, count(*) as num_preds, round(avg(detector_score), 6) as f1,
    round(avg(segmenter_score), 6) as recall
  from fx_detections group by product_id, detector_class)"""

AOI = """fx_aoi as (
  select product_id, k.v * 120.0::double + 10 as x0, 20.0::double as y0,
    k.v * 120.0::double + 120 as x1, 200.0::double as y1
  from (select distinct product_id from fx_truths) p, range(2) k(v))"""


def inter(a="a", b="b"):
    return (f"greatest(0.0::double, least({a}.x1,{b}.x1)-greatest({a}.x0,{b}.x0))"
            f"*greatest(0.0::double, least({a}.y1,{b}.y1)-greatest({a}.y0,{b}.y0))")


def area(a="a"):
    dot = f"{a}." if a else ""
    return f"(({dot}x1-{dot}x0)*({dot}y1-{dot}y0))"


def iou(a="a", b="b", eps=""):
    union = f"({area(a)}+{area(b)}-{inter(a, b)}{eps})"
    return f"case when {union} = 0 then 0.0::double else {inter(a, b)}/{union} end"


def meets(a="a", b="b", touching=False):
    lt, gt = ("<=", ">=") if touching else ("<", ">")
    return f"{a}.x0{lt}{b}.x1 and {a}.x1{gt}{b}.x0 and {a}.y0{lt}{b}.y1 and {a}.y1{gt}{b}.y0"


def tile(column="image_id"):
    return f"concat('tile_', {column})"


def add(name, sql, base=TRUTHS, recursive=False):
    ORACLE[name] = f"with {'recursive ' if recursive else ''}{base} {sql}"


def size_label(value, gsd=0.5):
    px = 1 / gsd ** 2
    bounds = (("tiny", 0.0, 9.0), ("small", 9.0, 25.0), ("medium", 25.0, 49.0), ("large", 49.0, 100.0))
    whens = " ".join(f"when {value} >= {lo * px}::double and {value} < {hi * px}::double then '{n}'"
                     for n, lo, hi in bounds)
    return f"case {whens} else 'giant' end"


# Suppression: `{p}_n` (k, id, score, box) -> `{p}_keep` (k, id); a box falls when a kept stronger
# one overlaps it by more than t, and stands when all stronger neighbours have fallen.
def tie(column):
    """What comes before the id among equal scores."""
    return f"substr(md5({column}::varchar), 1, 15)"


def nms_ctes(p, t):
    return f"""{p}_e as materialized (
  select a.k, a.id as hi, b.id as lo from {p}_n a join {p}_n b on a.k = b.k and {meets()}
    and (a.score > b.score or (a.score = b.score and ({tie('a.id')}, a.id) < ({tie('b.id')}, b.id)))
  where {iou()} > {t}::double),
{p}_st(k, id, state) using key (k, id) as (
  select k, id, case when (k, id) in (select (k, lo) from {p}_e) then 0 else 1 end from {p}_n
  union
  select k, id, ns from (
    select r.k, r.id, case when bool_or(h.state = 1) then 2 when bool_and(h.state = 2) then 1 else 0 end as ns
    from recurring.{p}_st r join {p}_e e on e.k = r.k and e.lo = r.id
      join recurring.{p}_st h on h.k = e.k and h.id = e.hi where r.state = 0 group by 1, 2) q
  where ns <> 0),
{p}_keep as materialized (select k, id from {p}_st where state = 1)"""


# Matching: `{p}_c` (k, pred, score, truth, iou, tier, truth_rank, shared) -> `{p}_m` (k, pred, truth).
def match_ctes(p, by_id=False):
    return f"""{p}_st(k, kind, id, other) using key (k, kind, id) as (
  select k, 'start', 0::bigint, 0::bigint from (select min(k) as k from {p}_c) q
  union
  select k, kind, id, other from (
    with live as materialized (
      select c.* from {p}_c c
      where not exists (select 1 from recurring.{p}_st s where s.k = c.k and s.kind = 'p' and s.id = c.pred)
        and not exists (select 1 from recurring.{p}_st s where s.k = c.k and s.kind = 't' and s.id = c.truth)),
    wish as (select distinct on (k, pred) k, pred, truth, shared from live
      order by k, pred, tier, iou desc, truth_rank, truth),
    first as (select distinct on (k, truth) k, truth, pred from live where not shared
      order by k, truth, score desc, {'' if by_id else tie('pred') + ', '}pred),
    won as materialized (
      select w.k, w.pred, w.truth, false as shared from wish w join first f
        on f.k = w.k and f.truth = w.truth and f.pred = w.pred where not w.shared
      union all select k, pred, truth, true from wish where shared)
    select k, 'p' as kind, pred as id, truth as other from won
    union all select k, 't', truth, pred from won where not shared) q),
{p}_m as materialized (select k, id as pred, other as truth from {p}_st where kind = 'p')"""


# --- sources and sinks ----------------------------------------------------------------------------

_COCO = """img as (select row_number() over (order by file_name) as id, file_name
    from (select distinct concat('tile_', image_id) as file_name from fx_truths) q),
  ann as (select row_number() over (order by i.id, truth_id) as id, i.id as image_id, file_name,
    category_id, x0 as x, y0 as y, x1 - x0 as w, y1 - y0 as h, (x1 - x0) * (y1 - y0) as area
    from fx_truths t join img i on i.file_name = concat('tile_', t.image_id))"""
add("write_coco", f", {_COCO} select id, image_id, file_name, category_id, x, y, w, h, area, "
    "cast(0 as int) as iscrowd from ann")
add("read_coco", f"""select truth_id as id, image_id, {tile()} as file_name, concat('kind_', category_id) as name,
    x0 as x, y0 as y, x1 - x0 as w, y1 - y0 as h, (x1 - x0) * (y1 - y0) as area from fx_truths""")
ORACLE["read_coco_pieces"] = ORACLE["read_coco"]
add("coco_union", """, img as (select product_id, image_id as old, row_number() over (order by product_id, image_id) - 1 as new
    from (select distinct product_id, image_id from fx_truths) q)
  select row_number() over (order by t.product_id, truth_id) - 1 as id, new as image_id, category_id,
    truth_id as old_id from fx_truths t join img on img.product_id = t.product_id and old = image_id""")
_ROWS = """rows as (select concat('loc_', product_id % 2) as location, concat('raster_', product_id) as raster_name,
    ['train','valid','test'][product_id % 3 + 1] as fold, concat('t_', image_id) as tile_name, * from fx_truths)"""
add("write_tile_rows", f""", {_ROWS} select location, raster_name, fold, tile_name, cast(count(*) as int) as n_labels,
    sum((x1-x0)*(y1-y0)) as total_area, 'tree' as category from rows group by 1,2,3,4""")
add("read_tile_rows", f""", {_ROWS}, t as (select location, raster_name, fold, tile_name,
    row_number() over (partition by location, raster_name, fold order by tile_name) as image_id
    from (select distinct location, raster_name, fold, tile_name from rows) q)
  select location, raster_name, fold,
    row_number() over (partition by location, raster_name, fold order by t.image_id, truth_id) as id,
    t.image_id, x0 as x, (x1-x0)*(y1-y0) as area
  from rows join t using (location, raster_name, fold, tile_name) where fold in ('train','valid')""")
add("read_voc_xml", "select concat('tree_', truth_id) as name, x0, y0, x1, y1 from fx_truths")
add("read_box_csv", f"select {tile()} as image_path, count(*) as num_boxes, sum((x1-x0)*(y1-y0)) as total_area "
    "from fx_truths group by 1")
add("read_jsonl_tolerant", """select case when truth_id % 97 = 0 then 'bad' else 'good' end as kind,
    cast(case when truth_id % 97 = 0 then -1 else product_id % 5 end as int) as validation_fold, count(*) as n
  from fx_truths group by 1, 2""")
add("geo_table_io", "select product_id, object_id, x0, y0, x1, y1, detector_score, cast(32618 as int) as crs_epsg "
    "from fx_detections", DETECTIONS)
add("metrics_csv_io", "select *, round(f1 / 2, 9) as second from fx_metrics", f"{DETECTIONS}, {RUN_METRICS}")
_PLACED = """placed as (select r_name as dataset, n_name as location, c_name as product_name, c_custkey, r_regionkey
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
  cat as (select dataset, location, product_name, fold, concat(product_name, '_labels.parquet') as ground_truth,
    case when c_custkey % 4 <> 0 then concat(product_name, '_aoi.parquet') end as aoi,
    cast(r_regionkey * 100 + 100 as int) as max_dets,
    case when r_regionkey % 2 = 0 then (r_regionkey + 1) / 100.0::double end as gsd
    from placed, unnest(case when c_custkey % 3 = 0 then ['test'] else ['valid', 'test'] end) f(fold))"""
ORACLE["dataset_catalog"] = f"""with {_PLACED} select dataset, location, product_name, fold, ground_truth, aoi,
    max_dets, round(gsd, 6) as ground_resolution from cat"""
ORACLE["iter_fold"] = f"""with {_PLACED} select dataset, location, product_name,
    concat(location, '/', product_name, '/tiles/valid') as tile_dir,
    case when aoi is not null then ground_truth end as ground_truth, aoi,
    concat(product_name, '_coco_valid_', case when gsd is not null
      then concat('gr', replace(cast(gsd as varchar), '.', 'p')) else 'sf1p0' end, '.json') as doc
  from cat where fold = 'valid'"""
ORACLE["verify_dataset"] = f"with {_PLACED} select location, product_name from placed join customer using (c_custkey) where c_acctbal < 0"
_NAMES = """nm as (select truth_id, product_id, case when truth_id % 10 = 0 then 'odd.png' else concat('2024_site', product_id,
    '_rgb_tile_valid_', case when truth_id % 2 = 0 then 'gr0p045' else 'sf1p0' end, '_', truth_id % 32, '_',
    (truth_id // 32) % 32, '.tif') end as name from fx_truths)"""
add("make_tile_name", f", {_NAMES} select truth_id, name from nm")
add("parse_tile_name", f""", {_NAMES} select truth_id,
    case when name = 'odd.png' then 'images' else concat('2024_site', product_id, '_rgb') end as product_name,
    case when name = 'odd.png' then 'infer' else 'valid' end as fold,
    case when name <> 'odd.png' and truth_id % 2 = 0 then 0.045::double end as ground_resolution,
    case when name = 'odd.png' or truth_id % 2 = 1 then 1.0::double end as scale_factor,
    case when name <> 'odd.png' then cast(truth_id % 32 as int) end as col,
    case when name <> 'odd.png' then cast((truth_id // 32) % 32 as int) end as row from nm""")
add("rename_tiles", """select distinct image_id as id, case when image_id % 7 <> 0 then concat('tile_', image_id, '.tif')
    else concat('img_', image_id, '.tif') end as file_name, image_id % 7 = 0 as is_missing from fx_truths""")

# --- projections and filters ----------------------------------------------------------------------

add("flatten_detections", f"""select {tile()} as tile_path, x0, y0, x1, y1, detector_score, detector_class,
    row_number() over (order by {tile()}, object_id) - 1 as object_id
  from fx_detections where x1 > x0 and y1 > y0""", DETECTIONS)
add("flatten_masks", f"""select row_number() over (order by {tile()}, object_id) - 1 as object_id, {tile()} as tile_path,
    detector_score as segmenter_score, cast(floor(y0) as bigint) as line, cast(floor(x0) as bigint) as c0,
    cast(ceil(x1) as bigint) as c1 from fx_detections""", DETECTIONS)
_CLASSES = """c as (select vec_id as object_id, concat('tile_', vec_id % 5) as tile_path,
    case when vec_id % 7 <> 0 then label end as classifier_class,
    case when vec_id % 7 <> 0 then embedding[label + 1]::double end as classifier_score from embeddings)"""
ORACLE["flatten_classes"] = (f"with {_CLASSES} select object_id, tile_path, classifier_class, "
                             "round(classifier_score, 9) as classifier_score from c")
ORACLE["count_unclassified"] = (f"with {_CLASSES} select tile_path, count(*) filter (classifier_class is null) "
                                "as num_unclassified, count(*) as num_rows from c group by 1")
_ARGMAX = """l as (select vec_id as object_id, label, list_transform(embedding, lambda v: v::double) as z from embeddings),
  m as (select *, list_max(z) as top, cast(list_position(z, list_max(z)) - 1 as int) as classifier_class from l)"""
ORACLE["argmax_class"] = f"""with {_ARGMAX} select object_id, classifier_class,
    round(1 / list_sum(list_transform(z, lambda v: exp(v - top))), 9) as classifier_score from m"""
ORACLE["micro_f1"] = f"""with {_ARGMAX} select object_id % 3 as "group",
    round(avg(case when classifier_class = label then 1.0::double else 0.0::double end), 9) as micro_f1,
    count(*) as num_rows from m group by 1"""
add("score_filter", "select object_id, detector_score from fx_detections where detector_score >= 0.5", DETECTIONS)
add("visible_box_filter", """select object_id, image_id from fx_detections where x1 > x0 and y1 > y0
    and x1 - 100 > 0 and y1 - 60 > 0 and x0 - 100 < 100 and y0 - 60 < 120""", DETECTIONS)
add("prefix_filter", """select object_id, concat('raster_', lpad(cast(product_id as varchar), 6, '0'), '_', image_id) as image_name,
    concat('raster_', lpad(cast(product_id as varchar), 6, '0')) as raster_name
  from fx_detections where object_id % 9 <> 0 and product_id % 2 = 0""", DETECTIONS)
add("drop_degenerate_boxes", """select * from (select object_id, least(greatest(x0, 0), 200)::double as x0,
    least(greatest(y0, 0), 180)::double as y0, least(greatest(x1, 0), 200)::double as x1,
    least(greatest(y1, 0), 180)::double as y1 from fx_detections) q where x1 > x0 and y1 > y0""", DETECTIONS)
add("drop_stage_columns", "select object_id, detector_score from fx_detections", DETECTIONS)
add("pass_columns", "select object_id, product_id, detector_score, detector_class, detector_class as species "
    "from fx_detections", DETECTIONS)
add("remove_category", """select truth_id as id, image_id, cast(case when category_id > 1 then category_id - 1 else category_id end as int)
    as category_id, concat('kind_', category_id) as name from fx_truths where category_id <> 1""")
add("min_area_filter", """, a as (select product_id as source_id, case when truth_id % 11 = 0 then 0.0::double
      when truth_id % 13 = 0 then -1.0::double else (x1-x0)*(y1-y0) end as v from fx_truths)
  select source_id, count(*) filter (v < 20) as removed, count(*) as total, count(*) filter (v >= 20) as kept from a group by 1""")
_RINGS = """r as (select truth_id as id, product_id as source_id, image_id, category_id, x0, y0, x1, y1,
    (x1-x0)*(y1-y0) as area,
    case when product_id % 3 = 1 then 'none' when truth_id % 5 = 0 then 'none' when truth_id % 7 = 0 then 'short'
      when truth_id % 3 = 0 then 'both' else 'one' end as kind from fx_truths)"""
add("valid_segmentation_filter", f""", {_RINGS} select id, source_id from r where kind in ('both', 'one')
    or source_id not in (select source_id from r where kind <> 'none')""")
add("all_segmented_images", f""", {_RINGS} select id from r where kind in ('both', 'one')""")
add("clean_rings", f""", {_RINGS} select id, category_id, x0, y0, x0 + (x1 - x0) as x1, y0 + (y1 - y0) as y1,
    cast(case when kind in ('both', 'one') then 1 else 0 end as int) as n_rings from r""")
add("fold_assign", "select truth_id, image_id, case when image_id % 5 = 4 then 'valid' else 'train' end as fold from fx_truths")
add("cap_per_tile", f"select {tile()} as tile_path, least(count(*), 64) as n from fx_detections group by 1", DETECTIONS)
add("prompt_batches", f"""select {tile()} as tile_path, object_id,
    (row_number() over (partition by image_id order by object_id) - 1) // 20 as batch from fx_detections""", DETECTIONS)

# --- geometry -------------------------------------------------------------------------------------

add("xyxy_to_xywh", "select object_id, x0 as x, y0 as y, x1 - x0 as w, y1 - y0 as h from fx_detections", DETECTIONS)
add("xywh_to_xyxy", "select object_id, x0, y0, x0 + (x1 - x0) as x1, y0 + (y1 - y0) as y1 from fx_detections", DETECTIONS)
add("envelope", "select truth_id, x0, y0, x1, y1, (x1-x0)*(y1-y0)*0.75::double as area from fx_truths")
add("box_iou", f"""select object_id, truth_id, {area('a')} as area, {inter()} as inter,
    {area('a')}+{area('b')}-{inter()} as joint, round({iou()}, 9) as iou,
    round(case when {area('a')} = 0 then 0.0::double else {inter()}/{area('a')} end, 9) as ioa
  from fx_detections a join fx_truths b on a.product_id = b.product_id and {meets()}""", DETECTIONS)
# An L-shape is its lower half and the left half of its upper half.
_PARTS = """{n}_p as (select {i}, product_id, 1 as part, x0, y0, x1, (y0 + y1) / 2 as y1 from {t} where x1 > x0 and y1 > y0
    union all select {i}, product_id, 2, x0, (y0 + y1) / 2, (x0 + x1) / 2, y1 from {t} where x1 > x0 and y1 > y0)"""
add("polygon_iou", f""", {_PARTS.format(n='d', i='object_id', t='fx_detections')},
  {_PARTS.format(n='t', i='truth_id', t='fx_truths')},
  s as (select object_id, truth_id, sum({inter()}) as i from d_p a join t_p b on a.product_id = b.product_id and {meets()}
    group by 1, 2)
  select a.object_id, b.truth_id, round(coalesce(i, 0) /
    (({area('a')} + {area('b')}) * 0.75::double - coalesce(i, 0)), 6) as iou
  from fx_detections a join fx_truths b on a.product_id = b.product_id and {meets()}
    left join s on s.object_id = a.object_id and s.truth_id = b.truth_id
  where a.x1 > a.x0 and a.y1 > a.y0""", DETECTIONS)
add("repair", "select truth_id, cast(2 as int) as n_parts, round((x1-x0)*(y1-y0)/2, 6) as area from fx_truths")
add("bad_mask_to_dummy", f""", {_RINGS}, g as (select *, kind in ('both', 'one') and id % 11 <> 0 as ok from r)
  select id, case when ok then 0.5::double else 0.0::double end as score,
    case when ok then x0 else 0.0::double end as x0, case when ok then y0 else 0.0::double end as y0,
    case when ok then x1 else 1.0::double end as x1, case when ok then y1 else 1.0::double end as y1 from g""")
add("to_pixel_space", """, u as (select 'truth' as side, product_id, truth_id as id, x0, y0, x1, y1 from fx_truths
    union all select 'prediction', product_id, object_id, x0, y0, x1, y1 from fx_detections),
  c as (select product_id, min(x0) as mx, min(y0) as my from u group by 1)
  select side, product_id, id, (x0-mx)/0.5::double as x0, (y0-my)/0.5::double as y0, (x1-mx)/0.5::double as x1,
    (y1-my)/0.5::double as y1 from u join c using (product_id)""", DETECTIONS)
add("pixel_to_world", """select truth_id, x0 * 0.5::double + product_id * 1000.0::double as x0, 9000.0::double - y1 * 0.5::double as y0,
    x1 * 0.5::double + product_id * 1000.0::double as x1, 9000.0::double - y0 * 0.5::double as y1 from fx_truths""")
add("rescale", "select truth_id, x0*1.5::double as x0, y0*0.75::double as y0, x1*1.5::double as x1, y1*0.75::double as y1 from fx_truths")
add("rescale_rings", """, m as (select truth_id, x0 * 16 as x0, x1 * 16 as x1, (x0 + x1) * 8 as mx, y0 * 4 as y0, y1 * 4 as y1,
    (y0 + y1) * 2 as my from fx_truths)
  select truth_id, array_to_string(list_transform([x0, y0, x1, y0, x1, my, mx, my, mx, y1, x0, y1],
    lambda v: cast(floor(v) as bigint)), ',') as eighths from m""")
add("pad_boxes", """select truth_id, x0-(x1-x0)*0.25::double as x0, y0-(y1-y0)*0.25::double as y0, x1+(x1-x0)*0.25::double as x1,
    y1+(y1-y0)*0.25::double as y1 from fx_truths""")
ORACLE["utm_zone_of"] = """with p as (select o_orderkey as id, (o_orderkey * 37) % 3600 / 10.0::double - 180 as lon,
    (o_orderkey * 11) % 1600 / 10.0::double - 80 as lat from orders)
  select id, cast(case when lat >= 0 then 32600 else 32700 end + least(floor((lon + 180) / 6) + 1, 60) as int) as epsg from p"""
ORACLE["reproject"] = "select o_orderkey as id, true as returns, true as in_zone from orders"
add("crs_check", """select distinct product_id, case when product_id % 3 <> 0 then 'objects have no CRS'
    else 'raster has no CRS' end as problem from fx_truths where (product_id % 3 <> 0) <> (product_id % 2 = 0)""")
add("size_label", f"select object_id, {size_label('((x1-x0)*(y1-y0)/0.25::double)')} as size_label from fx_detections", DETECTIONS)
add("size_counts", f""", s as (select product_id, {size_label('((x1-x0)*(y1-y0)/0.25::double)')} as size_label from fx_detections)
  select product_id, size_label, count(*) as num_preds from s group by 1, 2
  union all select product_id, 'all', count(*) from s group by 1""", DETECTIONS)
add("remove_holes", "select truth_id, (x1-x0)*(y1-y0) - 1 as with_hole, (x1-x0)*(y1-y0) as without_hole from fx_truths")
add("drop_small_parts", """, a as (select truth_id, (x1-x0)*(y1-y0) as a, 9.0::double as b from fx_truths)
  select truth_id, cast((case when a >= 16 or a >= b then 1 else 0 end) + (case when b >= a then 1 else 0 end) as int) as n_parts,
    (case when a >= 16 or a >= b then a else 0 end) + (case when b >= a then b else 0 end)::double as area from a""")
add("simplify", "select truth_id, cast(4 as int) as n_points, (x1-x0)*(y1-y0) as area from fx_truths")

# --- masks ----------------------------------------------------------------------------------------

_LOCAL = """lo as (select truth_id, cast(ceil(y1) - floor(y0) as int) as h, cast(ceil(x1) - floor(x0) as int) as w from fx_truths)"""
_COUNTS = """concat(repeat(concat('GAP,', w, ','), 0), '0,', array_to_string(list_transform(range(h),
    lambda i: case when i < h - 1 then concat(w, ',', 16 - w) else concat(w, ',', 256 - 16 * (h - 1) - w) end), ','))"""
add("runs_to_rle", f", {_LOCAL} select truth_id, {_COUNTS} as counts from lo")
add("rle_string_codec", f", {_LOCAL} select truth_id, {_COUNTS} as counts, true as has_text from lo")
add("rle_to_runs", f", {_LOCAL} select truth_id, cast(k.v as int) as line, cast(0 as int) as c0, w as c1 from lo, range(16) k(v) where k.v < h")
add("polygon_to_runs", f", {_LOCAL} select truth_id, cast(k.v as int) as line, cast(0 as int) as c0, w as c1 from lo, range(16) k(v) where k.v < h")
add("runs_to_polygon", f""", {_LOCAL} select truth_id, cast(1 as int) as n_rings, cast(w * h as double) as area, 0.0::double as x0,
    0.0::double as y0, w::double as x1, h::double as y1 from lo""")
add("mask_area", "select truth_id, cast(sum(c1 - c0) as bigint) as area from fx_runs group by 1", f"{TRUTHS}, {ROW_RUNS}")
add("mask_bbox", """select truth_id, min(c0) as bx, min(line) as by, max(c1) - 1 - min(c0) as bw, max(line) - min(line) as bh
  from fx_runs group by 1""", f"{TRUTHS}, {ROW_RUNS}")
add("crop_runs", """select truth_id, line - 32 as line, greatest(c0, 64) - 64 as c0, least(c1, 192) - 64 as c1 from fx_runs
  where line >= 32 and line < 160 and c1 > 64 and c0 < 192""", f"{TRUTHS}, {ROW_RUNS}")
_PAIRS = """fa as (select object_id, sum(c1 - c0) as a from fx_det_runs group by 1),
  fb as (select truth_id, sum(c1 - c0) as b from fx_runs group by 1),
  pr as (select r.product_id, object_id, truth_id, cast(sum(least(r.c1, s.c1) - greatest(r.c0, s.c0)) as bigint) as i
    from fx_det_runs r join fx_runs s on r.product_id = s.product_id and r.line = s.line and r.c0 < s.c1 and r.c1 > s.c0
    group by 1, 2, 3),
  mp as (select product_id, object_id, truth_id, i, i / cast(a + b - i as double) as v, 1 - (2 * i + 1) / cast(a + b + 1 as double) as dl
    from pr join fa using (object_id) join fb using (truth_id))"""
add("mask_iou", f""", {_PAIRS} select object_id, truth_id, i as inter, round(v, 9) as iou, round(dl, 9) as dice_loss from mp""",
    f"{DETECTIONS}, {ROW_RUNS}, {DET_RUNS}")
add("iou_stats", f""", {_PAIRS} select product_id, round(avg(v), 9) as mean_iou, round(median(v), 9) as median_iou,
    round(stddev_pop(v), 9) as std_iou, count(*) as num_masks from mp group by 1""", f"{DETECTIONS}, {ROW_RUNS}, {DET_RUNS}")
add("downscale_runs", """, px as (select truth_id, line // 2 as line, c.v // 2 as cell from fx_runs, range(270) c(v)
      where c.v >= c0 and c.v < c1),
  hit as (select truth_id, line, cell from px group by 1, 2, 3 having count(*) >= 2),
  g as (select *, cell - row_number() over (partition by truth_id, line order by cell) as grp from hit)
  select truth_id, cast(line as int) as line, cast(min(cell) as int) as c0, cast(max(cell) + 1 as int) as c1
  from g group by truth_id, line, grp""", f"{TRUTHS}, {ROW_RUNS}")
add("nms_ioa_disambiguate", """, s as (select r.*, d.segmenter_score as score from fx_det_runs r join fx_detections d using (product_id, object_id)
      where d.segmenter_score >= 0.6),
  ov as materialized (select b.product_id, b.object_id, a.object_id as strong, b.line, greatest(a.c0, b.c0) as c0, least(a.c1, b.c1) as c1
    from s a join s b on a.product_id = b.product_id and a.line = b.line and a.c0 < b.c1 and a.c1 > b.c0
      and (a.score > b.score or (a.score = b.score and a.object_id < b.object_id))),
  worst as (select product_id, object_id, max(i) as w from (select product_id, object_id, strong, sum(c1 - c0) as i from ov group by 1, 2, 3) q group by 1, 2),
  ar as (select product_id, object_id, sum(c1 - c0) as a from s group by 1, 2),
  px as (select distinct product_id, object_id, line, p.v from ov, range(-10, 290) p(v) where p.v >= c0 and p.v < c1),
  tk as (select product_id, object_id, count(*) as n from px group by 1, 2)
  select product_id, object_id, cast(a - coalesce(n, 0) as bigint) as area from ar left join worst using (product_id, object_id)
    left join tk using (product_id, object_id)
  where a - coalesce(n, 0) > 0 and (coalesce(w, 0) <= 0.3::double * a or a - coalesce(n, 0) >= 0.5::double * a)""",
    f"{DETECTIONS}, {DET_RUNS}")
add("blank_tile_filter", "select truth_id, concat('p_', truth_id) as tile_path from fx_truths where truth_id % 10 > 1")
add("validate_rgb", """, p as (select truth_id, 'error' as severity, 'fewer than three bands' as problem from fx_truths where truth_id % 12 = 0
    union all select truth_id, 'warning', 'bands are not red, green, blue' from fx_truths where truth_id % 15 = 0
    union all select truth_id, 'error', 'type is not uint8' from fx_truths where truth_id % 14 = 0
    union all select truth_id, 'error', 'values outside 0 to 255' from fx_truths where truth_id % 14 = 0 and truth_id % 10 <> 0)
  select concat('p_', truth_id) as tile_path, severity, problem from p""")
add("black_out", f", {_LOCAL} select truth_id, cast(case when truth_id % 10 = 0 then 256 else w * h end as int) as n_black from lo")
add("crop_pixels", """select truth_id, cast(10 as int) as height, cast(8 as int) as width, cast(240 as int) as n_bytes,
    100 + 0.5::double * (truth_id % 8) as origin_x, 899.0::double as origin_y from fx_truths""")
add("corrupt_image_filter", """select truth_id as id, image_id from fx_truths where image_id % 6 <> 0 and image_id % 5 <> 0""")
ORACLE["float_to_uint8"] = """select vec_id, cast(list_sum(list_transform(embedding,
    lambda v: floor(greatest(0, least(255, v::double * 256))))) as bigint) as byte_sum from embeddings"""

# --- tiling ---------------------------------------------------------------------------------------

_GRID = """rs as (select distinct product_id, product_id % 64 + 256 as width, 256 as height from fx_truths),
  gr as (select product_id, cast(c.v as int) as col, cast(r.v as int) as row,
    least(c.v * 75, width - 100)::double as px0, least(r.v * 75, height - 100)::double as py0
    from rs, range(10) c(v), range(10) r(v)
    where c.v <= ceil((width - 100) / 75.0) and r.v <= ceil((height - 100) / 75.0))"""
add("tile_grid", f", {_GRID} select *, px0 + 100 as px1, py0 + 100 as py1 from gr")
add("resample_window", f""", {_GRID} select product_id, col, row, px0 * 2 as sx0, py0 * 2 as sy0, (px0 + 100) * 2 as sx1,
    (py0 + 100) * 2 as sy1 from gr""")
add("labeled_tiles", f""", b as (select product_id, col, row, px0 as x0, py0 as y0, px1 as x1, py1 as y1 from fx_tiles),
  l as (select a.product_id, row, col, truth_id as object_id, greatest(a.x0, b.x0) - b.x0 as x0, greatest(a.y0, b.y0) - b.y0 as y0,
      least(a.x1, b.x1) - b.x0 as x1, least(a.y1, b.y1) - b.y0 as y1, {inter()} as area
    from fx_truths a join b on a.product_id = b.product_id and {meets()} where {inter()} / {area('a')} >= 0.4),
  t as (select product_id, row, col, row_number() over (order by product_id, row, col) as tile_id
    from (select distinct product_id, row, col from l) q)
  select row_number() over (order by product_id, row, col, object_id) as label_id, tile_id, product_id, row, col, object_id,
    x0, y0, x1, y1, area from l join t using (product_id, row, col)""", f"{TRUTHS}, {TILES}")
add("labeled_tiles_masks", """, b as (select p.product_id, c.v as col, r.v as row, least(c.v * 64, 172) as px0, least(r.v * 64, 172) as py0
    from (select distinct product_id from fx_truths) p, range(4) c(v), range(4) r(v)),
  n as (select truth_id, sum(c1 - c0) as pixels from fx_runs group by 1),
  i as (select product_id, row, col, truth_id as object_id, line - py0 as line, greatest(c0 - px0, 0) as c0, least(c1 - px0, 128) as c1
    from fx_runs join b using (product_id) where line >= py0 and line < py0 + 128 and c0 < px0 + 128 and c1 > px0),
  l as (select product_id, row, col, object_id, min(c0) as x0, min(line) as y0, max(c1) as x1, max(line) + 1 as y1, sum(c1 - c0) as area,
      string_agg(concat(line, ':', c0, ':', c1), ',' order by line, c0) as mask from i group by 1, 2, 3, 4),
  k as (select l.* from l join n on truth_id = object_id where area >= 0.4::double * pixels),
  t as (select product_id, row, col, row_number() over (order by product_id, row, col) as tile_id
    from (select distinct product_id, row, col from k) q)
  select row_number() over (order by product_id, row, col, object_id) as label_id, tile_id, product_id, row, col, object_id,
    x0, y0, x1, y1, area, mask from k join t using (product_id, row, col)""", f"{TRUTHS}, {ROW_RUNS}")
add("polygon_tiles", """, s as (select truth_id, (x0+x1)/2 as cx, (y0+y1)/2 as cy, ceil(greatest(x1-x0, y1-y0)) + 10 as side from fx_truths)
  select truth_id, floor(cx - side/2) as px0, floor(cy - side/2) as py0, floor(cx - side/2) + side as px1, floor(cy - side/2) + side as py1 from s""")
add("aoi_split", """select product_id, col, row, case when (py0+py1)/2/320 < 0.5 then 'train' when (py0+py1)/2/320 < 0.75 then 'valid'
    else 'test' end as aoi from fx_tiles where (py0+py1)/2/320 <= 1""", f"{TRUTHS}, {TILES}")
add("aoi_package", f"""select distinct a.product_id, col, row, concat('aoi_', cast(b.x0 as int)) as aoi
  from (select product_id, col, row, px0 as x0, py0 as y0, px1 as x1, py1 as y1 from fx_tiles) a
  join fx_aoi b on a.product_id = b.product_id and {meets()}""", f"{TRUTHS}, {TILES}, {AOI}")

# --- joins ----------------------------------------------------------------------------------------

add("bbox_join", f"""select a.product_id, object_id, truth_id from fx_detections a join fx_truths b
  on a.product_id = b.product_id and {meets(touching=True)}""", DETECTIONS)
add("iou_join", f"""select a.product_id, object_id, truth_id, round({iou()}, 9) as iou from fx_detections a join fx_truths b
  on a.product_id = b.product_id and {meets()} where {iou()} >= 0.5""", DETECTIONS)


def clipped(table, ident, name):
    return f"""{name}_pc as (select a.product_id, {ident}, greatest(a.x0, b.x0) as x0, greatest(a.y0, b.y0) as y0,
      least(a.x1, b.x1) as x1, least(a.y1, b.y1) as y1, {inter()} as i, {area('a')} as ar
    from {table} a join fx_aoi b on a.product_id = b.product_id and {meets()}),
  {name}_in as (select product_id, {ident} from {name}_pc group by 1, 2 having min(ar) > 0 and sum(i) / min(ar) >= 0.4),
  {name}_cl as (select p.product_id, p.{ident}, x0, y0, x1, y1 from {name}_pc p join {name}_in using (product_id, {ident}))"""


add("aoi_filter", f", {clipped('fx_detections', 'object_id', 'd')} select * from d_cl", f"{DETECTIONS}, {AOI}")


def half(x, y):
    """Ground right of x and above y under the line x + y = 200."""
    return f"power(greatest(200 - greatest({x}, 0) - greatest({y}, 0), 0), 2) / 2"


def triangle(x0="x0", y0="y0", x1="x1", y1="y1"):
    return f"({half(x0, y0)} - {half(x1, y0)} - {half(x0, y1)} + {half(x1, y1)})"


def within(bounds):
    return "(" + " * ".join(f"greatest(least({c}1, {hi}) - greatest({c}0, {lo}), 0)" for c, lo, hi in bounds) + ")"


_FRAME = f"({within((('x', 204, 268), ('y', 10, 250)))} - {within((('x', 220, 240), ('y', 60, 200)))})"
add("aoi_polygons", f""", s as (select product_id, object_id, (x1 - x0) * (y1 - y0) as whole, {triangle()} as t, {_FRAME} as f
    from fx_detections where x1 > x0 and y1 > y0)
  select product_id, object_id, k.v as aoi, round(case k.v when 'frame' then f else t end, 6) as area
  from s, (values ('frame'), ('triangle')) k(v) where (t + f) / whole >= 0.4::double - 1e-9::double
    and case k.v when 'frame' then f else t end > 0""", DETECTIONS)
_TILE_BOX = ("px0", "py0", "px1", "py1")
add("aoi_package_polygons", f"""select product_id, col, row, k.v as aoi from (select *, {triangle(*_TILE_BOX)} as t, {_FRAME} as f
    from (select *, px0 as x0, py0 as y0, px1 as x1, py1 as y1 from fx_tiles) q) s, (values ('frame'), ('triangle')) k(v)
  where case k.v when 'frame' then f else t end > 0""", f"{TRUTHS}, {TILES}")
add("attribute_merge", """select object_id, detector_score, x0, y0, x1, y1,
    case when object_id % 3 <> 0 then detector_score / 2 end as classifier_score from fx_detections""", DETECTIONS)
add("geometry_merge", """, t as (select object_id as src, x0 + k.v as x0, y0, x1 + k.v as x1, y1, cast(k.v as int) as tile, detector_score,
      row_number() over (partition by object_id order by k.v) as nth from fx_detections, range(2) k(v)),
  m as (select max(src) as top from t)
  select case when nth = 1 then src else top + row_number() over (partition by nth order by src, tile) end as object_id,
    x0, y0, x1, y1, tile, detector_score from t, m""", DETECTIONS)
add("merge_results", "select object_id, x0, y0, x1 + 1 as x1, y1, segmenter_score, detector_score from fx_detections", DETECTIONS)
add("align_by_file_name", f"""select t.image_id as id, {tile('t.image_id')} as file_name,
    case when t.image_id % 4 <> 0 then coalesce(n, 0) else 0 end as n
  from (select distinct image_id from fx_truths where image_id % 5 <> 0) t
  left join (select image_id, count(*) as n from fx_detections group by 1) d on d.image_id = t.image_id""", DETECTIONS)

_STEPS = ", ".join(f"{v / 100}::double" for v in range(50, 100, 5))
_STEP_LABEL = ",".join(f"{v / 100:.2f}" for v in range(50, 100, 5))
_CAND = f"""cand as materialized (select a.product_id, object_id, truth_id, detector_score as score, {iou()} as v
    from fx_detections a join fx_truths b on a.product_id = b.product_id and {meets()} where {iou()} >= 0.5)"""
add("greedy_match", f""", {_CAND},
  m_c as materialized (select t as k, object_id as pred, score, truth_id as truth, v as iou, 0 as tier, truth_id as truth_rank,
    false as shared from cand, unnest([{_STEPS}]) q(t) where v >= t),
  {match_ctes('m')}
  select product_id, k as iou_threshold, object_id, truth_id, round(v, 9) as iou
  from m_m join cand on pred = object_id and truth = truth_id""", DETECTIONS, True)
add("prompt_match", f""", cand as materialized (select a.image_id, object_id, truth_id, {iou(eps='+1e-6::double')} as v, a.x0, a.y0, a.x1, a.y1
    from fx_detections a join fx_truths b on a.image_id = b.image_id and {meets()}
    where truth_id % 6 <> 0 and {iou(eps='+1e-6::double')} > 0.3::double),
  m_c as materialized (select image_id as k, object_id as pred, -object_id as score, truth_id as truth, v as iou, 0 as tier,
    truth_id as truth_rank, false as shared from cand),
  {match_ctes('m', by_id=True)}
  select {tile('image_id')} as tile_path, object_id, truth_id, x0, y0, x1, y1, round(v, 9) as iou
  from m_m join cand on pred = object_id and truth = truth_id""", DETECTIONS, True)
add("join_summaries", """select t.location, t.product_name, t.f1 as tile_AP, t.num_preds as num_truths, r.f1 as raster_f1, r.recall as raster_recall
  from fx_metrics t left join (select * from fx_metrics where run_id = 1 and num_preds % 2 = 0) r
    using (location, product_name) where t.run_id = 0""", f"{DETECTIONS}, {RUN_METRICS}")
add("missing_files", """select distinct concat('i_', image_id) as file_name from fx_truths where image_id not in
    (select image_id from fx_truths where truth_id % 64 = 0 and image_id % 3 <> 0)""")
add("map_categories", """select object_id, concat('kind_', detector_class) as species,
    cast(case when detector_class < 2 then detector_class + 10 else 99 end as int) as category_id from fx_detections""", DETECTIONS)

# --- metrics --------------------------------------------------------------------------------------

_P = "case when tp + fp > 0 then tp / cast(tp + fp as double) else 0.0::double end"
_R = "case when tp + fn > 0 then tp / cast(tp + fn as double) else 0.0::double end"


def prf(name, source):
    """`name` = source with p, r, f added."""
    return (f"{name}_0 as (select *, {_P} as p, {_R} as r from {source}), {name} as (select *, "
            f"case when p + r > 0 then 2 * p * r / (p + r) else 0.0::double end as f from {name}_0)")


add("prf1", f""", n_n as materialized (select product_id as k, object_id as id, detector_score as score, x0, y0, x1, y1
      from fx_detections where detector_score >= 0.2), {nms_ctes('n', 0.5)},
  dd as materialized (select d.* from fx_detections d join n_keep on id = object_id),
  cand as materialized (select a.product_id, object_id, truth_id, detector_score as score, {iou()} as v
    from dd a join fx_truths b on a.product_id = b.product_id and {meets()} where {iou()} >= 0.5),
  m_c as materialized (select product_id as k, object_id as pred, score, truth_id as truth, v as iou, 0 as tier,
    truth_id as truth_rank, false as shared from cand), {match_ctes('m')},
  c as (select product_id, coalesce(tp, 0) as tp, np - coalesce(tp, 0) as fp, nt - coalesce(tp, 0) as fn
    from (select product_id, count(*) as nt from fx_truths group by 1) t
    join (select product_id, count(*) as np from dd group by 1) d using (product_id)
    left join (select k as product_id, count(*) as tp from m_m group by 1) m using (product_id)), {prf('z', 'c')}
  select product_id, tp, fp, fn, round(p, 9) as precision, round(r, 9) as recall, round(f, 9) as f1 from z""", DETECTIONS, True)


def raster_ctes(d="fx_detections", t="fx_truths", score="detector_score", steps=None):
    """`z`: tp, fp, fn, p, r, f per product, threshold and size bin."""
    label = size_label("((x1-x0)*(y1-y0)/0.25::double)")
    bins = "['all','tiny','small','medium','large','giant']"
    steps = steps or f"[{_STEPS}]"
    return f"""ds as materialized (select product_id, object_id, x0, y0, x1, y1, {score} as score, {label} as lb from {d}),
  ts as materialized (select product_id, truth_id, x0, y0, x1, y1, {label} as lb from {t}),
  cand as materialized (select a.product_id, object_id, truth_id, score, {iou()} as v, a.lb as la, b.lb as lt
    from ds a join ts b on a.product_id = b.product_id and {meets()} where {iou()} >= 0.5),
  m_c as materialized (select concat(product_id, '|', t, '|', sz) as k, object_id as pred, score, truth_id as truth, v as iou,
    0 as tier, truth_id as truth_rank, false as shared
    from cand, unnest({steps}) q(t), unnest(case when la = lt then ['all', la] else ['all'] end) w(sz) where v >= t),
  {match_ctes('m')},
  np as (select product_id, sz, count(*) as n from ds, unnest(['all', lb]) w(sz) group by 1, 2),
  nt as (select product_id, sz, count(*) as n from ts, unnest(['all', lb]) w(sz) group by 1, 2),
  pr as (select product_id from ds union select product_id from ts),
  fr as (select product_id, t, sz from pr, unnest({steps}) q(t), unnest({bins}) w(sz)),
  hit as (select k, count(*) as tp from m_m group by 1),
  cn as (select fr.product_id, fr.t, fr.sz, coalesce(tp, 0) as tp, coalesce(np.n, 0) - coalesce(tp, 0) as fp,
      coalesce(nt.n, 0) - coalesce(tp, 0) as fn, coalesce(nt.n, 0) as num_truths, coalesce(np.n, 0) as num_preds
    from fr left join np on np.product_id = fr.product_id and np.sz = fr.sz
    left join nt on nt.product_id = fr.product_id and nt.sz = fr.sz
    left join hit on k = concat(fr.product_id, '|', fr.t, '|', fr.sz)), {prf('z', 'cn')}"""


# A box in several AOI rows becomes several rows; further ones get ids after the highest one.
_AOI_IDS = """{n}_nth as (select *, row_number() over (partition by {i} order by product_id, y0, x0) as nth from {n}_cl),
  {n}_id as (select product_id, case when nth = 1 then {i} else (select max({i}) from {n}_cl)
      + row_number() over (partition by nth > 1 order by product_id, y0, x0) end as {i}, x0, y0, x1, y1, {i} as src from {n}_nth)"""
add("raster_counts", f""", {clipped('fx_detections', 'object_id', 'd')}, {clipped('fx_truths', 'truth_id', 't')},
  {_AOI_IDS.format(n='d', i='object_id')}, {_AOI_IDS.format(n='t', i='truth_id')},
  dsc as (select d_id.*, detector_score from d_id join (select object_id as src, detector_score from fx_detections) q using (src)),
  {raster_ctes('dsc', 't_id')}
  select product_id, t as iou_threshold, sz as size_label, tp, fp, fn, num_truths, num_preds, round(f, 9) as f1 from z""",
    f"{DETECTIONS}, {AOI}", True)
_GROUND = "(select * from fx_detections where x1 > x0 and y1 > y0)"
add("raster_level_geographic", f""", {raster_ctes(_GROUND, steps="[0.5031::double, 0.7017::double]")}
  select product_id, t as iou_threshold, tp, fp, fn, num_truths, num_preds from z where sz = 'all'""", DETECTIONS, True)
add("rf1_sweep", f""", {raster_ctes()}
  select product_id, round(avg(p) filter (sz = 'all'), 9) as precision, round(avg(r) filter (sz = 'all'), 9) as recall,
    round(avg(f) filter (sz = 'all'), 9) as f1, max(tp) filter (sz = 'all' and t = 0.5) as tp,
    max(fp) filter (sz = 'all' and t = 0.5) as fp, max(fn) filter (sz = 'all' and t = 0.5) as fn,
    max(num_truths) filter (sz = 'all') as num_truths, max(num_preds) filter (sz = 'all') as num_preds,
    round(max(f) filter (sz = 'all' and t = 0.5), 9) as f1_50, round(max(f) filter (sz = 'all' and t = 0.75), 9) as f1_75,
    round(max(f) filter (sz = 'all' and t = 0.6::double), 9) as f1_third, round(avg(f) filter (sz = 'small'), 9) as f1_small,
    round(max(r) filter (sz = 'giant' and t = 0.5), 9) as recall_giant_first, '{_STEP_LABEL}' as iou_thresholds
  from z group by 1""", DETECTIONS, True)


_COCO_RANGES = {"all": (0.0, 1e10), "tiny": (0.0, 36.0), "small": (36.0, 100.0), "medium": (100.0, 196.0),
                "large": (196.0, 400.0), "giant": (400.0, 1e10)}
_COCO_STEPS = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)
_LIMITS = (1, 10, 100, 400)


def coco_ctes(ranges, steps, limit, truths="fx_truths", images="true"):
    """`oc`: outcome per detection and range with bit masks; `gi`: truths. `images`: which ones count."""
    rng = ", ".join(f"('{n}', {lo}::double, {hi}::double)" for n, (lo, hi) in ranges.items())
    stp = ", ".join(f"({i}, {t}::double)" for i, t in enumerate(steps))
    full = (1 << len(steps)) - 1
    return f"""rng(lb, lo, hi) as (values {rng}), stp(i, t) as (values {stp}),
  dt as materialized (select * from (select *, (x1-x0)*(y1-y0) as da, row_number() over (partition by image_id,
      detector_class order by detector_score desc, object_id) as rank from fx_detections where {images}) q where rank <= {limit}),
  gi as materialized (select *, (x1-x0)*(y1-y0) as area, truth_id % 29 = 0 as iscrowd from {truths}),
  pv as materialized (select a.image_id, a.object_id, a.detector_score as score, b.truth_id, b.area, b.iscrowd,
      case when b.iscrowd then case when {area('a')} = 0 then 0.0::double else {inter()}/{area('a')} end else {iou()} end as v
    from dt a join gi b on a.image_id = b.image_id and a.detector_class = b.category_id and {meets()}),
  m_c as materialized (select concat(image_id, '|', lb, '|', i) as k, object_id as pred, score, truth_id as truth, v as iou,
      cast(iscrowd or area < lo or area > hi as int) as tier, -truth_id as truth_rank, iscrowd as shared
    from pv, rng, stp where v >= t),
  {match_ctes('m', by_id=True)},
  mt as (select m.pred, string_split(m.k, '|')[2] as lb, cast(string_split(m.k, '|')[3] as int) as i, c.tier
    from m_m m join m_c c on c.k = m.k and c.pred = m.pred and c.truth = m.truth),
  mk as (select pred, lb, cast(sum(case when tier = 0 then 1 << i else 0 end) as bigint) as tpm, cast(sum(1 << i) as bigint) as anym
    from mt group by 1, 2),
  oc as materialized (select product_id, image_id, detector_class as category_id, object_id as det_id, rng.lb as area_label, rank, detector_score as score,
      coalesce(tpm, 0) as tp_mask,
      case when da >= lo and da <= hi then xor({full}, coalesce(anym, 0)) else 0 end as fp_mask
    from dt cross join rng left join mk on mk.pred = object_id and mk.lb = rng.lb)"""


add("coco_match", f""", {coco_ctes(_COCO_RANGES, _COCO_STEPS, 100)}
  select image_id, det_id, area_label, rank, tp_mask, cast(fp_mask as bigint) as fp_mask from oc""", DETECTIONS, True)


def accumulate_ctes(source, npig, keys, limits, steps):
    """`pt`: precision per key, limit, threshold and recall point; `rc`: recall. `source` has rank, score, masks."""
    ks = ", ".join(keys)
    on = " and ".join(f"a.{k} = b.{k}" for k in keys)
    lim = ", ".join(str(v) for v in limits)
    stp = ", ".join(f"({i}, {t}::double)" for i, t in enumerate(steps))
    return f"""ast(i, t) as (values {stp}),
  ex as (select {ks}, md, i, t, score, image_id, rank, det_id, (tp_mask >> i) & 1 as tp, (fp_mask >> i) & 1 as fp
    from {source}, unnest([{lim}]) q(md), ast where rank <= md),
  cu as (select *, sum(tp) over w as ct, sum(fp) over w as cf from ex where tp + fp > 0
    window w as (partition by {ks}, md, i order by score desc, image_id, rank, det_id rows unbounded preceding)),
  ht as (select a.*, b.npig, ct / cast(npig as double) as rec, ct / cast(ct + cf as double) as prec from cu a join {npig} b on {on} where tp = 1),
  fr2 as (select {ks}, npig, md, i, t from {npig}, unnest([{lim}]) q(md), ast),
  rc as materialized (select {', '.join('f.' + k for k in keys)}, f.npig, f.md, f.t,
      case when f.npig = 0 then -1.0::double else coalesce(h.rec, 0.0::double) end as recall
    from fr2 f left join (select {ks}, md, i, max(rec) as rec from ht group by all) h
      on {' and '.join(f'h.{k} = f.{k}' for k in keys)} and h.md = f.md and h.i = f.i),
  bn as (select {ks}, md, i, r.v as point, max(prec) as p from ht, range(101) r(v) where rec >= r.v * 0.01::double group by all),
  pt as materialized (select {', '.join('f.' + k for k in keys)}, f.npig, f.md, f.t, r.v as point,
      case when f.npig = 0 then -1.0::double else coalesce(p, 0.0::double) end as p
    from fr2 f cross join range(101) r(v) left join bn on {' and '.join(f'bn.{k} = f.{k}' for k in keys)}
      and bn.md = f.md and bn.i = f.i and bn.point = r.v)"""


def summary_values():
    """The averages over `a` (precision per threshold) and `r` (recall) that make up the summary."""
    def mean(value, cond, name):
        return f'round(coalesce(avg({value}) filter ({cond}), -1.0::double), 9) as "{name}"'

    top, sizes = max(_LIMITS), [s for s in _COCO_RANGES if s != "all"]
    every = f"area_label = 'all' and md = {top}"
    aps = [mean("ap", every, "AP"), mean("ap", f"{every} and t = 0.5", "AP50"), mean("ap", f"{every} and t = 0.75", "AP75")]
    aps += [mean("ap", f"area_label = '{s}' and md = {top}", f"AP_{s}") for s in sizes]
    ars = [mean("recall", f"area_label = 'all' and md = {m}", f"AR_{m}") for m in _LIMITS]
    ars += [mean("recall", f"{every} and t = 0.5", "AR50"), mean("recall", f"{every} and t = 0.75", "AR75")]
    ars += [mean("recall", f"area_label = '{s}' and md = {top}", f"AR_{s}") for s in sizes]
    return aps, [*ars, mean("recall", every, "AR")]


_ACC = f"""{coco_ctes(_COCO_RANGES, _COCO_STEPS, max(_LIMITS))},
  ng as materialized (select category_id, lb as area_label, count(*) filter (not iscrowd and area >= lo and area <= hi) as npig
    from gi cross join rng group by all),
  {accumulate_ctes('oc', 'ng', ['category_id', 'area_label'], _LIMITS, _COCO_STEPS)}"""
add("coco_accumulate", f""", {_ACC}
  select category_id, area_label, cast(pt.md as int) as max_dets, pt.t as iou_threshold, round(recall, 9) as recall,
    cast(point as int) as point, round(p, 9) as p from pt join rc using (category_id, area_label, md, t)""", DETECTIONS, True)
add("coco_summary", f""", {_ACC},
  a as (select category_id, area_label, md, t, avg(p) as ap from pt where npig > 0 group by all)
  select * from (select {', '.join(summary_values()[0])} from a) cross join
    (select {', '.join(summary_values()[1])} from rc where npig > 0)""", DETECTIONS, True)


def tile_level_sql(unit_ctes, group, truths="fx_truths", images="true"):
    """COCO summary per group; `unit` maps product_id to the group columns. `images`: which ones count."""
    g = ", ".join(group)
    keys = [*group, "category_id", "area_label"]
    aps, ars = summary_values()
    values = [v.rpartition(" as ")[2] for v in (*aps, *ars)]
    return f""", {coco_ctes(_COCO_RANGES, _COCO_STEPS, max(_LIMITS), truths, images)}, {unit_ctes},
  ou as materialized (select oc.*, {', '.join('unit.' + c for c in group if c != 'product_id') or '1 as one'} from oc join unit using (product_id)),
  ng as materialized (select {g}, category_id, lb as area_label, count(*) filter (not iscrowd and area >= lo and area <= hi) as npig
    from gi join unit using (product_id) cross join rng group by all),
  {accumulate_ctes('ou', 'ng', keys, _LIMITS, _COCO_STEPS)},
  a as (select {g}, category_id, area_label, md, t, avg(p) as ap from pt where npig > 0 group by all),
  aa as (select {g}, {', '.join(aps)} from a group by all),
  rr as (select {g}, {', '.join(ars)} from rc where npig > 0 group by all),
  ni as (select {g}, count(distinct image_id) as num_images from fx_truths join unit using (product_id) where {images} group by all),
  nn as (select {g}, count(*) as num_truths from {truths} join unit using (product_id) group by all),
  nd as (select {g}, count(*) as num_preds from fx_detections join unit using (product_id)
    where {images} and image_id in (select image_id from fx_truths) group by all)
  select {g}, num_images, coalesce(num_truths, 0) as num_truths, coalesce(num_preds, 0) as num_preds,
    {', '.join(f'coalesce({v}, -1.0::double) as {v}' for v in values)}
  from ni left join aa using ({g}) left join rr using ({g}) left join nn using ({g}) left join nd using ({g})"""


add("tile_level", tile_level_sql(
    "unit as (select distinct product_id from fx_truths)", ["product_id"],
    "(select * from fx_truths where image_id % 7 <> 3 and image_id % 5 <> 1)", "image_id % 7 <> 3"), DETECTIONS, True)

_SEARCH = """sr as (select cast(product_id as varchar) as raster_name, round(detector_class / 10.0::double + 0.1::double, 9) as nms_iou,
    0.5::double as nms_score, round(avg(detector_score), 6) as precision, round(avg(segmenter_score), 6) as recall,
    round(max(detector_score) - product_id % 7 / 100.0::double, 6) as f1, count(*) as num_truths, count(*) * 2 as num_preds
    from fx_detections group by product_id, detector_class),
  av as (select nms_iou, nms_score, sum(precision * num_truths) / sum(num_truths) as precision, sum(recall * num_truths) / sum(num_truths) as recall,
    sum(f1 * num_truths) / sum(num_truths) as f1, cast(sum(num_truths) as bigint) as num_truths, cast(sum(num_preds) as bigint) as num_preds, count(*) as num_images
    from sr group by 1, 2)"""
add("avg_by_params", f""", {_SEARCH} select raster_name, nms_iou, nms_score, round(precision, 9) as precision, round(recall, 9) as recall,
    round(f1, 9) as f1, num_truths, num_preds, 1::bigint as num_images from sr
  union all select 'average_over_rasters', nms_iou, nms_score, round(precision, 9), round(recall, 9), round(f1, 9), num_truths, num_preds, num_images from av""", DETECTIONS)
add("best_params", f", {_SEARCH} select 'average_over_rasters' as raster_name, nms_iou, nms_score, round(f1, 9) as f1 from av "
    "order by av.f1 desc, nms_iou limit 1", DETECTIONS)
add("weighted_dataset_avg", """, m as (select * from fx_metrics)
  select location as dataset, round(sum(f1 * num_preds) / sum(num_preds), 9) as f1,
    case when location <> 'loc_1' then round(sum(recall * num_preds) / sum(num_preds), 9) end as recall,
    cast(sum(num_preds) as bigint) as num_truths, round(sum(f1 * num_preds) / sum(num_preds), 9) as first,
    round(sum(recall * num_preds) / sum(num_preds), 9) as second from m group by 1""", f"{DETECTIONS}, {RUN_METRICS}")
add("mean_std_over_runs", """select location, product_name, max(num_preds) filter (run_id = 0) as num_truths, round(avg(f1), 9) as f1_mean,
    round(stddev_pop(f1), 9) as f1_std, round(avg(recall), 9) as recall_mean, round(stddev_pop(recall), 9) as recall_std,
    round(avg(recall), 9) as second_mean, round(stddev_pop(recall), 9) as second_std from fx_metrics group by 1, 2""",
    f"{DETECTIONS}, {RUN_METRICS}")
add("mean_over_datasets", """, d as (select location, avg(f1) as ap, avg(recall) as ar, max(f1) as ap50 from fx_metrics group by 1)
  select metric, round(avg(v), 9) as value, count(*) as num_datasets from (select 'AP' as metric, ap as v from d
    union all select 'AR', ar from d union all select 'AP50', ap50 from d) q group by 1""", f"{DETECTIONS}, {RUN_METRICS}")
add("annotations_by_image", "select image_id, string_agg(truth_id, ',' order by truth_id) as ids from fx_truths group by 1")
add("dataset_stats", """select case when product_id % 4 = 0 then 'valid' else 'train' end as fold, count(distinct image_id) as n_tiles,
    count(*) as n_annotations from fx_truths group by 1""")

# --- ids, scores, ordering ------------------------------------------------------------------------

add("assign_object_id", """select product_id, object_id as source_key, row_number() over (order by product_id, object_id) - 1 as object_id
  from fx_detections""", DETECTIONS)
add("reassign_duplicates", """, d as (select object_id // (1::bigint << 34) as o, object_id as source_key,
      row_number() over (partition by object_id // (1::bigint << 34) order by object_id) as nth from fx_detections),
  m as (select max(o) as top from d)
  select case when nth = 1 then o else top + row_number() over (partition by nth > 1 order by source_key) end as object_id, source_key from d, m""", DETECTIONS)
add("fuse_scores", """select object_id, round(exp((ln(detector_score) + 3 * ln(segmenter_score)) / 4), 9) as aggregator_score,
    round(segmenter_score, 9) as only_segmenter from fx_detections""", DETECTIONS)
_NODES = "n_n as materialized (select {k} as k, object_id as id, {s} as score, x0, y0, x1, y1 from fx_detections where {w})"
add("nms_iou", f""", {_NODES.format(k='product_id', s='detector_score', w='true')}, {nms_ctes('n', 0.5)}
  select k as product_id, id as object_id from n_keep""", DETECTIONS, True)
add("tile_postprocess", f""", {_NODES.format(k='image_id', s='detector_score', w='detector_score >= 0.05')}, {nms_ctes('n', 0.5)}
  select tile_path, object_id from (select {tile('k')} as tile_path, n_keep.id as object_id,
      row_number() over (partition by k order by score desc, id) as rn from n_keep join n_n using (k, id)) q where rn <= 50""", DETECTIONS, True)
_WIN = """w as (select *, floor(x0 / 64) * 64 as px0, floor(y0 / 64) * 64 as py0, (x0 + x1) / 2 as cx, (y0 + y1) / 2 as cy from fx_detections)"""
add("edge_band_filter", f""", {_WIN} select object_id from w where cx >= px0 + 128 * 0.05::double and cx <= px0 + 128 - 128 * 0.05::double
    and cy >= py0 + 128 * 0.05::double and cy <= py0 + 128 - 128 * 0.05::double""", DETECTIONS)
add("centroid_distance_weight", f""", {_WIN} select object_id, round(detector_score * (1 - 0.5::double * least(
    sqrt(pow(cx - px0 - 64, 2) + pow(cy - py0 - 64, 2)) / sqrt(8192.0::double), 1)), 9) as detector_score from w""", DETECTIONS)
add("sort_by_score", """select object_id, detector_score as score, row_number() over (order by detector_score desc, object_id) - 1 as place
  from fx_detections""", DETECTIONS)
add("top_dets", """select image_id, object_id, cast(rank as int) as rank from (select *, row_number() over (partition by image_id
    order by detector_score desc, object_id) as rank from fx_detections) q where rank <= 10""", DETECTIONS)
add("best_candidate", """select image_id, prompt, candidate, predicted_iou from (select image_id, detector_class as prompt, object_id as candidate,
    segmenter_score as predicted_iou, row_number() over (partition by image_id, detector_class order by segmenter_score desc, object_id) as rn
    from fx_detections) q where rn = 1""", DETECTIONS)

# --- set operations and small text functions ------------------------------------------------------

# Truth masks are boxes, so two of them touch when their pixel boxes do and not only at a corner.
_DISSOLVED = """b as materialized (select truth_id as id, product_id, floor(x0) as x0, floor(y0) as y0, ceil(x1) as x1, ceil(y1) as y1
      from fx_truths),
  e as materialized (select p.id as u, q.id as v from b p join b q on p.product_id = q.product_id and p.id <> q.id
    and p.x0 <= q.x1 and p.x1 >= q.x0 and p.y0 <= q.y1 and p.y1 >= q.y0
    and not ((p.x0 = q.x1 or p.x1 = q.x0) and (p.y0 = q.y1 or p.y1 = q.y0))),
  st(id, c) using key (id) as (select id, id from b union
    select n.id, n.c from (select e.u as id, min(s.c) as c from recurring.st s join e on e.v = s.id group by 1) n
      join recurring.st o on o.id = n.id where n.c < o.c),
  px as materialized (select distinct product_id, c, line, x.v as x from fx_runs join st on st.id = truth_id, range(270) x(v) where x.v >= c0 and x.v < c1)"""
add("dissolve", f""", {_DISSOLVED}
  select product_id, c as component, count(*) as area from px group by 1, 2""", f"{TRUTHS}, {ROW_RUNS}", True)
add("overlay_union", f""", {_DISSOLVED},
  bp as (select product_id, (l.v // 64) * 2 + x.v // 128 as b_id, l.v as line, x.v as x
    from (select distinct product_id from fx_truths) p, range(300) l(v), range(256) x(v) where x.v % 128 < 64)
  select product_id, coalesce(c, -1) as a_id, coalesce(b_id, -1) as b_id, count(*) as area
  from px full join bp using (product_id, line, x) group by 1, 2, 3""", f"{TRUTHS}, {ROW_RUNS}", True)
add("dissolve_polygons", f""", {_DISSOLVED}
  select product_id, c as component, count(*) as area, count(*) as ring_area from px group by 1, 2""", f"{TRUTHS}, {ROW_RUNS}", True)
ORACLE["overlay_polygons"] = f"select *, area as ring_area from ({ORACLE['overlay_union']}) q"
add("threshold_dedup", """select product_id, string_agg(format('{:.2f}', s), ',' order by s) as label
  from (select distinct product_id, detector_score as s from fx_detections) q group by 1""", DETECTIONS)
add("parse_iou_spec", """select truth_id, case truth_id % 3 when 0 then '50:95' when 1 then '0.5,0.65' else '0.75' end as spec,
    cast(case truth_id % 3 when 0 then 10 when 1 then 2 else 1 end as int) as n,
    case truth_id % 3 when 0 then '0.50,0.55,0.60,0.65,0.70,0.75,0.80,0.85,0.90,0.95' when 1 then '0.50,0.65' else '0.75' end as label
  from fx_truths""")
add("path_parts", """select truth_id, concat('t_', truth_id, '.tif') as leaf, concat('raster_', product_id) as raster,
    concat('loc_', product_id % 3) as location from fx_truths""")
add("is_close", """select object_id, detector_score from fx_detections where abs(detector_score - 0.7500001::double) <= 1e-8::double + 1e-5::double * 0.7500001::double
    or abs(detector_score - 0.49::double) <= 1e-8::double + 1e-5::double * 0.49::double""", DETECTIONS)
add("required_minus_available", """select product_id, array_to_string(list_sort(list_filter([0, 1, 2, 3], lambda v: not list_contains(have, v))), ',') as missing
  from (select product_id, list(distinct category_id) as have from fx_truths group by 1) q""")
add("resize_plan", """, t as (select truth_id, cast(truth_id % 900 + 100 as int) as width, cast((truth_id * 7) % 1100 + 100 as int) as height from fx_truths),
  s as (select *, least(width, height) as sh, greatest(width, height) as lg from t),
  u as (select *, greatest(1.0::double, 333.0::double / sh) as us, case when sh < 400 and lg * (400.0::double / sh) <= 800 then 400.0::double / sh
    when sh < 400 or lg > 800 then 800.0::double / lg else 1.0::double end as ws from s)
  select truth_id, width, height, cast(floor(width * us) as int) as up_width, cast(floor(height * us) as int) as up_height,
    cast(round_even(width * ws, 0) as int) as new_width, cast(round_even(height * ws, 0) as int) as new_height from u""")

# --- models and whole jobs ------------------------------------------------------------------------

_MODEL = """md as (select concat('tile_', image_id) as tile_path, truth_id, k.v as kk, x0 + k.v as x0, y0, x0 + 5 + k.v as x1, y0 + 5 as y1,
    ((truth_id * 7 + k.v * 31) % 100) / 100.0::double as detector_score, cast(truth_id % 3 as int) as detector_class
    from fx_truths, range(2) k(v))"""
add("score_tiles", f", {_MODEL} select tile_path, x0, y0, x1, y1, detector_score, detector_class from md")
add("score_prompts", f"""select {tile()} as tile_path, object_id, 0.5::double + object_id % 2 / 4.0::double as segmenter_score,
    cast((ceil(x1) - floor(x0)) * (ceil(y1) - floor(y0)) as bigint) as area from fx_detections where x1 > x0 and y1 > y0""", DETECTIONS)
ORACLE["score_objects"] = """with l as (select vec_id as object_id, list_transform(embedding, lambda v: v::double) as z from embeddings)
  select object_id, cast(list_position(z, list_max(z)) - 1 as int) as classifier_class, round(list_max(z), 9) as classifier_score from l"""
_FUSED = "exp((2 * ln(detector_score) + ln(segmenter_score)) / 3)"
add("run_stage", f""", {_NODES.format(k='product_id', s=_FUSED, w=_FUSED + ' >= 0.3')}, {nms_ctes('n', 0.6)}
  select k as product_id, id as object_id, round(score, 9) as aggregator_score from n_keep join n_n using (k, id)""", DETECTIONS, True)
add("run_stages", f""", {_MODEL}, n_n as materialized (select tile_path as k,
      row_number() over (order by tile_path, truth_id, kk) - 1 as id, exp(ln(case when detector_score > 0 then detector_score end)) as score,
      x0, y0, x1, y1 from md where detector_score >= 0.2), {nms_ctes('n', 0.3)}
  select k as tile_path, x0, y0, x1, y1, round(score, 9) as aggregator_score from n_keep join n_n using (k, id)""", TRUTHS, True)
add("run_stages_documents", f""", {_MODEL}, n_n as materialized (select tile_path as k,
      row_number() over (order by tile_path, truth_id, kk) - 1 as id, exp(ln(case when detector_score > 0 then detector_score end)) as score,
      x0, y0, x1, y1 from md where detector_score >= 0.2), {nms_ctes('n', 0.3)},
  d as (select count(*) as n, count(distinct tile_path) as images, sum(detector_score) as score from md),
  a as (select count(*) as n, count(distinct k) as images, sum(score) as score from n_keep join n_n using (k, id))
  select '0_detector' as stage, n as objects, null::bigint as dropped, n as annotations, images, round(score, 6) as score from d
  union all select '1_aggregator', a.n, d.n - a.n, a.n, a.images, round(a.score, 6) from a, d""", TRUTHS, True)
add("prepare_segmentation", f""", {_RINGS}, g as (select *, kind in ('both', 'one') or source_id not in
      (select source_id from r where kind <> 'none') as ok from r)
  select source_id, count(*) as total, count(*) - count(*) filter (ok and area >= 20) as removed,
    cast(sum(id) filter (ok and area >= 20) as bigint) as id_sum from g group by 1""")
add("prepare_segmentation_documents", f""", {_RINGS}, g as (select *, kind in ('both', 'one') or source_id not in
      (select source_id from r where kind <> 'none') as ok from r)
  select source_id, count(*) as total, count(*) - count(*) filter (ok and area >= 20) as removed, 0 as removed_again,
    cast(coalesce(sum(id) filter (ok and area >= 20), 0) as bigint) as id_sum,
    cast(coalesce(2 * sum(id) filter (ok and area >= 20), 0) as bigint) as note_sum from g group by 1""")
add("prepare_segmentation_rle", f", {_LOCAL} select truth_id as id, cast(w * h as double) as area from lo")

_GRID = ", ".join(f"{5 * i / 100}::double" for i in range(1, 21))
add("nms_grid_search", f""", n_n as materialized (select concat(product_id, '|', t) as k, object_id as id, detector_score as score, x0, y0, x1, y1,
      product_id, t from fx_detections, unnest([{_GRID}]) q(t) where detector_score >= 0.05::double and t < 1), {nms_ctes('n', 'a.t')},
  kp as materialized (select product_id, t as nms_iou, n_n.id, score from n_n join n_keep using (k, id)
    union all select product_id, 1.0::double, object_id, detector_score from fx_detections where detector_score >= 0.05::double),
  cand as materialized (select a.product_id, object_id, truth_id, detector_score as score, {iou()} as v
    from fx_detections a join fx_truths b on a.product_id = b.product_id and {meets()} where {iou()} >= 0.5 and detector_score >= 0.05::double),
  m_c as materialized (select concat(c.product_id, '|', nms_iou) as k, object_id as pred, c.score, truth_id as truth, v as iou,
    0 as tier, truth_id as truth_rank, false as shared from cand c join kp on id = object_id),
  {match_ctes('m')},
  hit as (select k.product_id, k.nms_iou, s as nms_score, count(*) as tp from m_m join kp k on k.id = pred
      and m_m.k = concat(k.product_id, '|', k.nms_iou), unnest([{_GRID}]) q(s) where score >= s group by 1, 2, 3),
  np as (select product_id, nms_iou, s as nms_score, count(*) as n from kp, unnest([{_GRID}]) q(s) where score >= s group by 1, 2, 3),
  nt as (select product_id, count(*) as n from fx_truths group by 1),
  fr as (select product_id, i as nms_iou, s as nms_score from nt, unnest([{_GRID}]) e(i), unnest([{_GRID}]) q(s)),
  cn as (select fr.*, coalesce(tp, 0) as tp, coalesce(np.n, 0) - coalesce(tp, 0) as fp, nt.n - coalesce(tp, 0) as fn, nt.n as num_truths,
      coalesce(np.n, 0) as num_preds
    from fr left join np using (product_id, nms_iou, nms_score) join nt using (product_id)
    left join hit using (product_id, nms_iou, nms_score)), {prf('z', 'cn')},
  pr as (select cast(product_id as varchar) as raster_name, nms_iou, nms_score, p, r, f, num_truths as nt, num_preds as np from z)
  select raster_name, nms_iou, nms_score, round(p, 9) as precision, round(r, 9) as recall, round(f, 9) as f1, nt as num_truths,
    np as num_preds, 1::bigint as num_images from pr
  union all select 'average_over_rasters', nms_iou, nms_score, round(sum(p * nt) / sum(nt), 9), round(sum(r * nt) / sum(nt), 9),
    round(sum(f * nt) / sum(nt), 9), cast(sum(nt) as bigint), cast(sum(np) as bigint), count(*) from pr group by nms_iou, nms_score""",
    DETECTIONS, True)
add("benchmark_raster", f""", {_NODES.format(k='product_id', s='detector_score', w='detector_score >= 0.3')}, {nms_ctes('n', 0.5)},
  kd as materialized (select d.* from fx_detections d join n_keep on id = object_id), {raster_ctes('kd')},
  pp as (select concat('loc_', product_id % 3) as location, concat('raster_', product_id) as product_name, product_id % 2 as ds,
    avg(p) filter (sz = 'all') as p, avg(r) filter (sz = 'all') as r, avg(f) filter (sz = 'all') as f,
    max(f) filter (sz = 'all' and t = 0.5) as f50, avg(f) filter (sz = 'medium') as fm, max(f) filter (sz = 'all' and t = 0.55::double) as f2,
    max(num_truths) filter (sz = 'all') as nt from z group by product_id)
  select location, product_name, round(p, 9) as precision, round(r, 9) as recall, round(f, 9) as f1, round(f50, 9) as f1_50,
    round(fm, 9) as f1_medium, round(f2, 9) as f1_second, nt as num_truths, '{_STEP_LABEL}' as iou_thresholds from pp
  union all select concat('set_', ds), 'average_over_rasters', round(sum(p*nt)/sum(nt), 9), round(sum(r*nt)/sum(nt), 9),
    round(sum(f*nt)/sum(nt), 9), round(sum(f50*nt)/sum(nt), 9), round(sum(fm*nt)/sum(nt), 9), round(sum(f2*nt)/sum(nt), 9),
    cast(sum(nt) as bigint), '{_STEP_LABEL}' from pp group by ds""", DETECTIONS, True)
add("benchmark_tile", tile_level_sql("""unit as materialized (
    select distinct product_id, concat('loc_', product_id % 3) as location, concat('raster_', product_id) as product_name from fx_truths
    union all select distinct product_id, concat('set_', product_id % 2), 'average_over_rasters' from fx_truths)""",
    ["location", "product_name"]), DETECTIONS, True)

# --- random changes: draws from the md5 of id and seed ----------------------------------------------

def draw(ident, seed):
    return f"((('0x' || substr(md5(concat({ident}, ':{seed}')), 1, 13))::bigint + 0.5::double) / {1 << 52}::double)"


def normal(ident, seed):
    return f"(sqrt(-2 * ln({draw(ident, seed)})) * cos(2 * pi() * {draw(ident, seed + 1_000_003)}))"


add("drop_boxes", f"select object_id from fx_detections where {draw('object_id', 3)} >= 0.3::double", DETECTIONS)
add("jitter_boxes", "select object_id, " + ", ".join(
    f"round(least(greatest({c} + {normal('object_id', 24 + i)} * 0.1::double * ({s}), 0.0::double), 300.0::double), 6) as {c}"
    for i, (c, s) in enumerate((("x0", "x1 - x0"), ("y0", "y1 - y0"), ("x1", "x1 - x0"), ("y1", "y1 - y0"))))
    + " from fx_detections", DETECTIONS)
add("random_square_crop", f""", w as materialized (select tile_path, s, cast(floor({draw('tile_path', 41)} * (256 - s + 1)) as bigint) as cx,
      cast(floor({draw('tile_path', 42)} * (256 - s + 1)) as bigint) as cy
    from (select tile_path, 64 + cast(floor({draw('tile_path', 40)} * 97) as bigint) as s
      from (select distinct {tile()} as tile_path from fx_detections) q) q),
  p as (select d.*, w.tile_path, cx, cy, greatest(x0, cx) as a0, greatest(y0, cy) as b0, least(x1, cx + s) as a1, least(y1, cy + s) as b1
    from fx_detections d join w on w.tile_path = {tile()})
  select object_id, image_id, tile_path, a0 - cx as x0, b0 - cy as y0, a1 - cx as x1, b1 - cy as y1 from p
  where (x1 - x0) * (y1 - y0) > 0 and greatest(a1 - a0, 0) * greatest(b1 - b0, 0) > 0
    and greatest(a1 - a0, 0) * greatest(b1 - b0, 0) / ((x1 - x0) * (y1 - y0)) >= 0.4::double""", DETECTIONS)

# --- masks: every box as the pixels it touches, which is again a box -------------------------------

_PX = "* replace (floor(x0) as x0, floor(y0) as y0, ceil(x1) as x1, ceil(y1) as y1)"
PIXELS = (DETECTIONS.replace("fx_truths", "raw_truths").replace("fx_detections", "raw_detections")
          + f", fx_truths as (select {_PX} from raw_truths)"
          + f", fx_detections as (select {_PX} from raw_detections where x1 > x0 and y1 > y0)")
for _name, _of in (("nms_iou_masks", "nms_iou"), ("greedy_match_masks", "greedy_match"),
                   ("nms_grid_search_segm", "nms_grid_search")):
    ORACLE[_name] = ORACLE[_of].replace(DETECTIONS, PIXELS)
add("tile_level_segm", tile_level_sql("unit as (select distinct product_id from fx_truths)", ["product_id"]), PIXELS, True)
_STRONG = _NODES.format(k="product_id", s="segmenter_score", w="segmenter_score >= 0.595::double")
add("run_stages_segmentation", f""", {_STRONG}, {nms_ctes('n', 0.5)}, {DET_RUNS},
  s as materialized (select r.*, n_n.score from fx_det_runs r join n_keep on n_keep.id = r.object_id join n_n on n_n.id = r.object_id),
  ov as materialized (select b.product_id, b.object_id, a.object_id as strong, b.line, greatest(a.c0, b.c0) as c0, least(a.c1, b.c1) as c1
    from s a join s b on a.product_id = b.product_id and a.line = b.line and a.c0 < b.c1 and a.c1 > b.c0
      and (a.score > b.score or (a.score = b.score and a.object_id < b.object_id))),
  worst as (select object_id, max(i) as w from (select object_id, strong, sum(c1 - c0) as i from ov group by 1, 2) q group by 1),
  ar as (select product_id, object_id, min(score) as score, sum(c1 - c0) as a from s group by 1, 2),
  px as (select distinct object_id, line, p.v from ov, range(-10, 290) p(v) where p.v >= c0 and p.v < c1),
  tk as (select object_id, count(*) as n from px group by 1)
  select product_id, object_id, cast(a - coalesce(n, 0) as int) as area, round(score, 9) as aggregator_score
  from ar left join worst using (object_id) left join tk using (object_id)
  where a - coalesce(n, 0) > 0 and (coalesce(w, 0) <= 0.3::double * a or a - coalesce(n, 0) >= 0.5::double * a)""", PIXELS, True)
