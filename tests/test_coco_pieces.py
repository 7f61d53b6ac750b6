"""Large COCO documents read in pieces, against the reader of whole documents."""

import json
import random

import pytest
from pyspark.sql import functions as F

from crownframe.sources import coco

TRICKY = ['a"b', "}{][", '\\', '\\"}', "x\\\\", 'end "key":[{', "é中\n\t", "", "},{", '"']


def documents():
    rng = random.Random(1)
    images = [{"id": i, "file_name": rng.choice(TRICKY) + str(i), "width": 10, "height": 20, "extra": {"deep": [{"x": [1, {}]}]}} for i in range(40)]
    kinds = [[[1.0, 2.0, 3.0, 4.5, 6.0, 1.0]], [], {"size": [3, 4], "counts": [1, 2, 9]}, {"size": [3, 4], "counts": "ab}\"{c"}, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]]
    annotations = [{"id": i, "image_id": rng.randrange(40), "category_id": 1, "bbox": [0.5, 1.0, 2.0, 3.0], "segmentation": rng.choice(kinds),
                    "area": 6.0, "iscrowd": 0, "note": rng.choice(TRICKY)} for i in range(300)]
    categories = [{"id": 1, "name": TRICKY[1], "supercategory": TRICKY[3]}]
    whole = {"info": {"a": {"b": "}"}, "c": 1}, "licenses": [], "images": images, "annotations": annotations, "categories": categories}
    yield "plain", json.dumps(whole)
    yield "pretty", json.dumps(whole, indent=3)
    yield "tight", json.dumps(whole, separators=(",", ":"), ensure_ascii=False) + "\n\n"
    yield "turned", json.dumps({k: whole[k] for k in reversed(whole)} | {"version": "1.0", "tags": ["a", "b"]})
    yield "without", json.dumps({"images": [], "annotations": [], "categories": categories})
    yield "nothing", json.dumps({})


def rows(df):
    return sorted(df.withColumn("source_id", F.element_at(F.split("source_id", "/"), -1)).select(
        F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})).collect())


@pytest.mark.parametrize("size", ["512b", "128m"])
def test_pieces_give_what_whole_documents_give(spark, tmp_path, size):
    for name, text in documents():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    want = coco.read_coco(spark, str(tmp_path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = coco.read_coco_pieces(spark, str(tmp_path))
        if size == "512b":
            assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 20
        for a, b, n in zip(got, want, (160, 1200, 5)):
            assert set(a.columns) == set(b.columns)
            assert rows(a) == rows(b) and b.count() == n
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def plain_cleaned(text, least=5.0):
    """The document after cleaning, and removed and total."""
    whole = json.loads(text)
    notes = whole.get("annotations", [])
    if not notes:
        return whole, None
    valid = lambda s: isinstance(s, dict) or (bool(s) and all(len(r) >= 6 for r in (s if isinstance(s[0], list) else [s])))
    masked = any(a["segmentation"] for a in notes)
    stay = [a for a in notes if a["area"] >= least and (not masked or valid(a["segmentation"]))]
    return whole | {"annotations": stay}, (len(notes) - len(stay), len(notes))


def test_documents_are_cleaned_in_their_place(spark, tmp_path):
    """Unknown keys, layout within elements and file names stay; run lengths become polygons; a second run changes nothing."""
    from crownframe.plans.prepare_segmentation import prepare_documents

    texts = {}
    for name, text in documents():
        whole = json.loads(text)
        for k, a in enumerate(whole.get("annotations", [])):
            a["area"] = [1.0, 6.0][k % 3 > 0]
            if isinstance(a["segmentation"], dict):        # the pixels of column 1
                a["segmentation"] = {"size": [3, 4], "counts": [3, 3, 6]}
        texts[name] = json.dumps(whole, indent=2 if name == "pretty" else None) + "\n" * (name == "tight")
        (tmp_path / f"{name}.json").write_text(texts[name], encoding="utf-8")
    report = {r["source_id"].rsplit("/", 1)[-1][:-5]: (r["removed"], r["total"]) for r in prepare_documents(spark, str(tmp_path), min_area=5.0).collect()}
    after = {}
    for name, text in texts.items():
        want, counts = plain_cleaned(text)
        after[name] = (tmp_path / f"{name}.json").read_text(encoding="utf-8")
        got = json.loads(after[name])
        assert report.get(name) == counts and list(got) == list(want)
        for a, b in zip(got.pop("annotations", []), want.pop("annotations", []), strict=True):
            if isinstance(b["segmentation"], dict):
                assert sorted(zip(a["segmentation"][0][0::2], a["segmentation"][0][1::2])) == [(1, 0), (1, 3), (2, 0), (2, 3)]
                a["segmentation"] = b["segmentation"]
            assert a == b and list(a) == list(b)
        assert got == want
    prepare_documents(spark, str(tmp_path), min_area=5.0)
    assert {n: (tmp_path / f"{n}.json").read_text(encoding="utf-8") for n in texts} == after
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == sorted(f"{n}.json" for n in texts)


def test_tasks_write_the_files(spark, tmp_path):
    """Whole files with odd names, next to their old checksums or in another folder; the driver handles none of them."""
    old = tmp_path / "old"
    spark.createDataFrame([("{}",)], "value string").coalesce(1).write.text(str(old))     # leaves checksums
    made = next(p for p in old.iterdir() if p.name.startswith("part-"))
    assert (old / f".{made.name}.crc").exists()
    odd = old / "a b%.json"
    odd.write_text("x", encoding="utf-8")
    names = [r[0] for r in spark.read.text(str(old)).select(F.col("_metadata.file_path")).distinct().collect()]
    rows = [(n, k, f"{k} é") for n in names for k in range(3000)]
    lines = spark.createDataFrame(rows, "source_id string, k int, text string").repartition(5)
    coco.write_files(lines, ["k"])
    coco.write_files(lines, ["k"], str(tmp_path / "new"))
    want = "".join(f"{k} é\n" for k in range(3000))
    assert len(names) == 2
    for folder in (old, tmp_path / "new"):
        assert [(folder / n).read_text(encoding="utf-8") for n in (odd.name, made.name)] == [want, want]
        assert not [p.name for p in folder.iterdir() if p.name.endswith(".new")]
    assert spark.read.text(str(old)).count() == 6000
