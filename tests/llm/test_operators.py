"""The text operators as Spark jobs, against SQL, plain versions and awkward rows."""

import base64
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from crownframe.llm import (arc_to_warc, byte_bpe, exact_dedup, html_text, language_id, metric_tree, pattern_packing,
                            queries, separator_scan, simhash_trees, token_store)
from crownframe.llm.shared import open_input
from tests import compare
from tests.conftest import SMALL
from tests.llm.test_functions import clusters, plain_components, plain_fingerprint
from tests.llm.test_near_copies import plain_kept

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(40_000))
#: Null ids and texts, empty and very long texts, ties and repeated rows.
ROWS = [(1, "the same text here"), (2, "the same text here"), (3, None), (4, ""), (5, LONG), (6, LONG + " x"), (None, "no id"),
        (None, None), (7, "the same text here"), (7, "the same text here"), (8, "ñandú 中文 '' 's <|endoftext|>"), (9, " \n\t"),
        (10, "123 !!"), (10, "another text of that id"), (-5, "negative id"), (2**62, "large id")]
CLASHES = ["digest", "file", "row", "keep", "n", "fp", "root", "length", "ids", "shard", "h1", "bucket", "label", "place", "copy",
           "__text", "_metadata", "start", "piece", "held_out", "id", "u", "v", "mask", "part"]


def awkward(spark, rows=ROWS):
    df = spark.createDataFrame([(i, t, "en" if t and "the" in t else None, "s", len(t or "")) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHES)])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def plain(docs):
    return sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, SMALL), compare.connect(SMALL), queries.ORACLE[name]) is None


# 1 -------------------------------------------------------------------------------------------------------------
def stored(rows, end=2):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    out, start = [], 0
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for (i, _), x in zip(ordered, library.encode_batch([t or "" for _, t in ordered], add_special_tokens=False)):
        ids = [*x.ids, end]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_token_store_holds_the_library_s_ids(spark, plain):
    assert rows_of(queries.op1_token_store(spark, SMALL)) == stored(plain)


def test_token_store_with_awkward_rows(spark):
    store = token_store.write_store(awkward(spark), shard_bytes=1000)
    keys = token_store.all_keys(awkward(spark))
    got = token_store.read_ids(store, keys)
    assert rows_of(got.select("doc_id", "start", "n_tokens", "ids_crc32")) == stored(ROWS)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got.collect())
    assert store.shards.count() > 1
    strangers = spark.createDataFrame([(i, 0) for i in range(1000, 3000)], "doc_id long, copy long")
    assert token_store.look_up(store, strangers).filter("shard is not null").count() == 0
    one = spark.createDataFrame([(5, 0)], "doc_id long, copy long")
    assert token_store.read_ids(store, one).count() == 1
    empty = token_store.write_store(awkward(spark).limit(0))
    assert token_store.read_ids(empty, one).count() == 0


# 2 -------------------------------------------------------------------------------------------------------------
def plain_dedup(rows):
    key = lambda i: (i is not None, i or 0)
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        best = max(ids, key=key)
        out += [(i, best, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def test_exact_dedup_with_awkward_rows(spark):
    got = exact_dedup.exact_dedup(awkward(spark))
    assert rows_of(got.drop("kept").select("doc_id", "keep_id", "group_size", "text_sha256")) == plain_dedup(ROWS)
    kept = got.filter("kept")
    assert kept.count() == kept.select("text_sha256").distinct().count() == len({t or "" for _, t in ROWS})
    assert exact_dedup.exact_dedup(awkward(spark).limit(0)).count() == 0
    left = exact_dedup.drop_copies(awkward(spark))
    assert left.columns == awkward(spark).columns
    assert sorted(r.text or "" for r in left.collect()) == sorted({t or "" for _, t in ROWS})


def test_texts_that_share_a_digest_are_told_apart(spark):
    rows = [(i, t or "") for i, t in ROWS if i is not None]
    from crownframe.llm.shared import located
    short = lambda c: F.substring(F.sha2(c, 256), 1, 1)
    got = exact_dedup.exact_groups(located(awkward(spark, rows)), digest=short)
    want = [(i, k, n) for i, k, n, _ in plain_dedup(rows)]
    assert rows_of(got.select("doc_id", "keep.doc_id", "n")) == sorted(want, key=repr)


def test_state_goes_on_where_it_was(spark, tmp_path):
    source, state = str(tmp_path / "in"), f"file://{tmp_path}/state"
    schema = "doc_id long, digest string, file string, row long"
    for k, rows in enumerate([[(1, "a", "f", 0), (2, "b", "f", 1)], [(5, "a", "g", 0), (0, "b", "g", 1), (3, "c", "g", 2)]]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        exact_dedup.run_stream(spark, spark.readStream.schema(schema).parquet(source), state)
        held = {r.digest: (r.keep.doc_id, r.n) for r in exact_dedup.read_state(spark, state).collect()}
        assert held == [{"a": (1, 1), "b": (2, 1)}, {"a": (5, 2), "b": (2, 2), "c": (3, 1)}][k]


def test_dedup_runs_no_python(spark, docs):
    plan = exact_dedup.exact_dedup(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# 3 -------------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
def test_counts_are_stitched_across_blocks(spark, block):
    rows = [r for r in ROWS if r[1] != LONG and r[1] != LONG + " x"]
    root, names = separator_scan.write_flat(awkward(spark, rows).coalesce(2))
    with open_input(root, names.first().file) as f:
        assert len(f.read()) % 2 == 0
    got = names.join(separator_scan.scan(root, names, block_bytes=block), ["file", "ordinal"], "left")
    want = sorted(((i, n - 1) for i, _, n, _ in stored(rows)), key=repr)
    assert rows_of(got.select("doc_id", "n_tokens")) == want and got.filter("not ended").count() == 0


def test_ids_after_the_last_separator_count(spark):
    from crownframe.llm.shared import Output, fresh_folder
    root = fresh_folder(spark, "flat-test")
    for name, ids in (("a", [7, 9, 9, 1, 2]), ("b", [1, 2, 3]), ("c", []), ("d", [9])):
        out = Output(root, name)
        out.write(np.array(ids, "<u2").tobytes())
        out.close()
    files = spark.createDataFrame([(x,) for x in "abcd"], "file string")
    got = separator_scan.scan(root, files, separator=9, block_bytes=4)
    assert rows_of(got) == rows_of(spark.createDataFrame(
        [("a", 0, 0, 1, True), ("a", 1, 2, 0, True), ("a", 2, 3, 2, False), ("b", 0, 0, 3, False), ("d", 0, 0, 0, True)],
        "file string, ordinal long, start long, n_tokens long, ended boolean"))


def test_separator_scan(spark, plain):
    want = sorted(((i, n - 1) for i, _, n, _ in stored(plain)), key=repr)
    assert rows_of(queries.op3_separator_scan(spark, SMALL)) == want
    assert separator_scan.token_counts(awkward(spark).limit(0)).count() == 0


# 4 -------------------------------------------------------------------------------------------------------------
def test_language_of_held_out_documents(spark):
    sf = SMALL.replace("0.001", "0.01")
    got = queries.op4_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    rows = got.collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    tested = [r.lang_pred == r.lang for r in rows if r.held_out]
    assert sum(tested) >= 0.98 * len(tested)


def test_language_with_awkward_rows(spark):
    got = {(r.doc_id, r.lang_pred, r.score > 0) for r in language_id.identify(awkward(spark)).collect()}
    assert {(3, "und", False), (4, "und", False), (9, "und", False), (10, "und", False), (1, "en", True)} <= got
    assert language_id.identify(awkward(spark).withColumn("lang", F.lit(None).cast("string"))).filter("lang_pred <> 'und'").count() == 0
    assert language_id.identify(awkward(spark).limit(0)).count() == 0
    left = language_id.keep_identified(awkward(spark))
    assert left.columns == awkward(spark).columns
    assert sorted(r.text for r in left.collect()) == sorted(t for _, t in ROWS if t and any(map(str.isalpha, t)))


def test_fitting_on_a_bounded_sample(spark):
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")
    model = language_id.fit(docs, fit_rows=200)
    assert model.labels == ["de", "en", "es", "fr"]
    got = language_id.predict(docs, model).join(docs, "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() >= 0.95 * got.count()


def plain_bayes(rows, fitted):
    """Label and score of each text by sums over its n-grams, in Python numbers."""
    mask, ways = (1 << 64) - 1, language_id.FACTORS

    def grams(text):
        chars = [ord(c) if c.isalpha() else 32 for c in f" {(text or '').lower()} "]
        chars = [c for i, c in enumerate(chars) if c != 32 or i == 0 or chars[i - 1] != 32]
        for n in (1, 2, 3):
            for i in range(len(chars) - n + 1):
                if n > 1 or chars[i] != 32:
                    h = sum((chars[i + k] + 1) * ways[k] for k in range(n)) & mask
                    yield ((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 & mask) >> 48

    counts, docs = {}, {}
    for text, label in fitted:
        docs[label] = docs.get(label, 0) + 1
        own = counts.setdefault(label, {})
        for g in grams(text):
            own[g] = own.get(g, 0) + 1
    counts = {k: c for k, c in counts.items() if any(g != -1 for g in c) and c}
    total = sum(docs[k] for k in counts)
    sums = {k: sum(c.values()) + language_id.ALPHA * language_id.FEATURES for k, c in counts.items()}
    for doc_id, text in rows:
        found = list(grams(text))
        letters = any(c.isalpha() for c in text or "")
        if not letters or not counts:
            yield doc_id, "und", 0.0
            continue
        logs = {k: math.log(docs[k] / total) + sum(math.log((c.get(g, 0) + language_id.ALPHA) / sums[k]) for g in found)
                for k, c in sorted(counts.items())}
        best = max(logs, key=logs.get)
        yield doc_id, best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())


def test_bayes_is_that_of_plain_sums(spark):
    texts = ["Zwölf Boxkämpfer jagen Viktor", "quick brown foxes jump", "le cœur déçu mais l'âme plutôt naïve", "12 !!", "", None, "ß ñ ÿ"]
    rows = [(i, texts[i % 7] if i % 7 > 2 else f"{texts[i % 7]} {texts[i % 3]} {'x' * (i % 5)}", ["de", "en", "fr", "none", "none", None, "fr"][i % 7])
            for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _, _ in rows}
    fitted = [(t, lang) for i, t, lang in rows if not held[i] and lang is not None]
    want = list(plain_bayes([(i, t) for i, t, _ in rows], fitted))
    got = {r.doc_id: r for r in language_id.identify(df).collect()}
    for i, label, score in want:
        assert got[i].lang_pred == label and got[i].score == pytest.approx(score, abs=1e-9) and got[i].held_out == held[i]


def test_many_labels_and_rare_ones_in_a_sample(spark):
    rows = [(i, f"{'abcdefghijklmnopqrstuvwxyz'[i % 26] * 6} {i % 300}", f"l{i % 300:03d}") for i in range(3000)]
    rows += [(5000 + i, "Жили были", "ru") for i in range(6)] + [(6000 + i, "gamma delta", "en") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df, fit_rows=300)
    assert len(model.labels) == 302 and model.log_prob.size <= language_id.CELLS
    assert model.predict(["Жили были", "gamma delta"])[0] == ["ru", "en"]


def test_without_labels_the_filter_keeps_what_has_letters(spark):
    df = spark.createDataFrame([(1, "text", None), (2, "12", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r.doc_id for r in language_id.keep_identified(df).collect()] == [1]
    assert {r.lang_pred for r in language_id.identify(df).collect()} == {"und"}


# 5, 6 ----------------------------------------------------------------------------------------------------------
PAGES = [(1, "http://a", "<p>x</p>" * 200), (2, "http://b c", "<p>x</p>" * 200), (2, None, "<p>x</p>" * 200), (3, "", None),
         (4, "http://d", ""), (None, "u", "<p>x</p>" * 200), (None, "u", "y" * 1000), (5, "u", "short"), (6, "u", "short"),
         (7, "u", "é" * 500), (8, "u", "é" * 500), (9, "u", "z" * 999), (10, "u", "z" * 999), (11, "u", "long " * 400_000)]


def page_table(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").select(
        "*", F.lit(1).alias("at"), F.lit(2).alias("size"), F.lit(3).alias("file"), F.lit(4).alias("bytes"))


def test_pages_as_archives(spark):
    got = arc_to_warc.convert(page_table(spark))
    rows = got.collect()
    assert len(rows) == len(PAGES)
    payloads = [(i, (h or "").encode()) for i, _, h in PAGES]
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in rows) == sorted(
        (str(i), len(p), hashlib.sha1(p).hexdigest()) for i, p in payloads)
    revisits = sorted((str(r.page_id), r.refers_to) for r in rows if r.record_type == "revisit")
    assert revisits == [("1", 2), ("2", 2), ("7", 8), ("None", 2)]
    assert len({r.record_id for r in rows}) == len(rows) and {r.date for r in rows} == {"2024-01-01T00:00:00Z"}
    assert arc_to_warc.convert(page_table(spark).limit(0)).count() == 0


def test_archives_are_cut_in_files(spark):
    arc, files = arc_to_warc.write_arc(page_table(spark).coalesce(1), file_bytes=200)
    assert files.count() > 3
    entries = arc_to_warc.arc_entries(arc, files)
    warc, made = arc_to_warc.to_warc(arc, arc_to_warc.with_types(entries), file_bytes=200)
    assert made.count() > 3 and arc_to_warc.read_warc(warc, made).count() == len(PAGES)


def test_html_text(spark):
    got = {r.page_id: r for r in html_text.extract(spark.read.parquet(f"{SMALL}/pages.parquet")).collect()}
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        assert got[r.page_id].text == html_text.visible_text(r.html or "") and "track(" not in got[r.page_id].text
    odd = {(r.page_id, r.text) for r in html_text.extract(page_table(spark)).collect()}
    assert {(3, ""), (4, ""), (5, "short")} <= odd and html_text.extract(page_table(spark).limit(0)).count() == 0


# 7 -------------------------------------------------------------------------------------------------------------
def plain_near(rows):
    fp = np.array([plain_fingerprint(t or "") for _, t in rows], np.int64)
    root = plain_components(fp)
    least = {}
    for (i, _), r in zip(rows, root.tolist()):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(((i, f"{int(f) & (1 << 64) - 1:016x}", least.get(r)) for (i, _), f, r in zip(rows, fp, root.tolist())), key=repr)


def test_near_copies(spark, plain):
    assert rows_of(queries.op7_simhash_trees(spark, SMALL)) == plain_near(plain)
    assert rows_of(simhash_trees.near_dups(awkward(spark))) == plain_near(ROWS)
    assert simhash_trees.near_dups(awkward(spark).limit(0)).count() == 0
    left = simhash_trees.keep_one(awkward(spark))
    assert left.columns == awkward(spark).columns and left.count() == len(set(plain_components(
        np.array([plain_fingerprint(t or "") for _, t in ROWS], np.int64)).tolist()))


@pytest.mark.parametrize(("spread", "shard"), [(0, 512), (1, 16), (2, 16), (3, 8)])
def test_components_of_dense_clusters(spark, spread, shard):
    fp = clusters(np.random.default_rng(40 + spread), 600, spread)
    prints = spark.createDataFrame([(int(x),) for x in fp], "fp long")
    got = {r.fp: r.root for r in simhash_trees.grouped(prints, 2, shard).collect()}
    assert got == dict(zip(fp.tolist(), plain_components(fp).tolist()))


def test_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "u long, v long")
    got = {r.u: r.root for r in simhash_trees.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 1001: 1000}


# 8 -------------------------------------------------------------------------------------------------------------
def test_vectors_with_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (100, [1.0]), (1, [3.0, 1.0]), (2, [3.0, 1.0]), (2, [3.0, 1.0]), (3, None), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (None, [9.0, 9.0]), (8, [-1.0, -5.0]), (200, [0.0, 0.0]), (9, [0.0004, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", F.lit(1).alias("v"), F.lit(1).alias("key"))
    whole = [(i, ([int(np.floor(1024 * x)) for x in v] + [0, 0])[:2]) for i, v in rows
             if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, q in whole:
        if i is not None and i % 100 == 0:
            found = sorted(((-(q[0] * v[0] + q[1] * v[1]), j is None, j or 0, j) for j, v in whole if j != i), key=lambda x: x[:3])[:4]
            want += [(i, k + 1, x[3], -x[0]) for k, x in enumerate(found)]
    for size in (1000, 3):
        assert rows_of(metric_tree.top_k(df, F.col("vec_id") % 100 == 0, k=4, shard_size=size)) == sorted(want, key=repr)
    assert metric_tree.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_files_and_blocks_are_dealt_to_many_tasks(spark):
    """Thin rows stand for much work: they are not put together by their own few bytes."""
    texts = awkward(spark, [(i, f"word{i} " * 4000) for i in range(24)]).repartition(3)
    root, names = separator_scan.write_flat(texts, file_bytes=20_000)
    files = names.select("file").distinct()
    assert files.count() > 6
    counts = separator_scan.scan(root, files, block_bytes=1 << 12)
    joined = names.join(counts, ["file", "ordinal"])
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r.doc_id: r.n_tokens for r in joined.collect()} == {
        i: len(library.encode(f"word{i} " * 4000, add_special_tokens=False).ids) for i in range(24)}
    tasks = separator_scan.dealt(files).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 3
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"{i} " * 3000) for i in range(40)], "page_id long, url string, html string")
    arc, arc_files = arc_to_warc.write_arc(pages.repartition(8))
    entries = arc_to_warc.arc_entries(arc, arc_files)
    assert arc_files.count() == 8 and entries.select(F.spark_partition_id()).distinct().count() > 3
    typed = arc_to_warc.with_types(entries)
    arc_to_warc.TASK_BYTES, old = 2000, arc_to_warc.TASK_BYTES
    try:
        warc, warc_files = arc_to_warc.to_warc(arc, typed)
    finally:
        arc_to_warc.TASK_BYTES = old
    assert warc_files.filter("file is not null").count() > 3
    back = arc_to_warc.read_warc(warc, warc_files)
    assert back.select(F.spark_partition_id()).distinct().count() > 1 and back.count() == 40


def test_words_remembered_in_two_generations():
    from crownframe.llm.words import WordEncoder

    texts = [" ".join(f"word{(i * k) % 97}" for k in range(60)) + f" únïcø{i} 中文" for i in range(80)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        whole, small = WordEncoder(name), WordEncoder(name, remembered=40)
        want = list(whole.encode(texts))
        assert [x for t in texts for x in small.encode([t])] == want
        assert len(small.known) + len(small.before) < 200
        library = Tokenizer.from_file(public_tokenizers.path(name))
        assert [np.frombuffer(x, "<u2").tolist() for x in want] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_large_components_score_exactly(spark):
    """Numbers beyond 2**25 aren't cut; where a score might not fit in 64 bits, there is none."""
    rows = [(i, [float(x) for x in v]) for i, v in enumerate([[90000.5, 1], [70000, 3], [-80000.25, 2], [5, 5], [90001, 0]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [[int(1024 * x // 1) for x in v] for _, v in rows]
    want = sorted((q, r, c, s) for q in (0, 3) for r, (s, c) in enumerate(sorted(
        ((-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in range(5) if c != q)), 1) for s in [-s])
    got = metric_tree.top_k(df, F.col("vec_id") % 3 == 0)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == want
    with pytest.raises(ValueError, match="64 bits"):
        metric_tree.top_k(df.union(spark.createDataFrame([(9, [1e12])], df.schema)), F.col("vec_id") == 0)


# 9 -------------------------------------------------------------------------------------------------------------
def checked_packing(packed, rows, capacity=4096):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.encode_special_tokens = True
    want = []
    for (i, _), x in zip(rows, library.encode_batch([t or "" for _, t in rows], add_special_tokens=False)):
        ids = [*x.ids, 1]
        want += [(i, k // capacity, k, len(ids[k:k + capacity]), zlib.crc32(np.array(ids[k:k + capacity], "<u4").tobytes()))
                 for k in range(0, len(ids), capacity)]
    found = packed.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found), key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= capacity
    return len(sequences), -(-sum(x[3] for x in want) // capacity)


def test_packing(spark, plain):
    n, least = checked_packing(queries.op9_pattern_packing(spark, SMALL), plain)
    assert n <= 1.05 * least
    checked_packing(pattern_packing.pack(awkward(spark)), ROWS)
    assert pattern_packing.pack(awkward(spark).limit(0)).count() == 0


def test_sequences_hold_their_pieces(spark):
    packed = pattern_packing.pack(awkward(spark), with_ids=True)
    whole = {r.sequence_id: r.ids for r in pattern_packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == r.ids


# 10 ------------------------------------------------------------------------------------------------------------
def test_byte_bpe(spark, plain):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    digest = lambda x: hashlib.sha256(x).hexdigest()
    for got, rows in ((queries.op10_byte_bpe(spark, SMALL), plain), (byte_bpe.round_trip(awkward(spark)), ROWS)):
        ids = [(i, t or "", library.encode_ordinary(t or "")) for i, t in rows]
        assert rows_of(got) == sorted(((i, len(x), digest(",".join(map(str, x)).encode()), digest(t.encode()))
                                       for i, t, x in ids), key=repr)
    coded = byte_bpe.encode(awkward(spark))
    back = byte_bpe.decode(coded)
    assert rows_of(back.select("doc_id", F.col("data").cast("string"))) == sorted(((i, t or "") for i, t in ROWS), key=repr)
    assert byte_bpe.round_trip(awkward(spark).limit(0)).count() == 0


# pipeline ------------------------------------------------------------------------------------------------------
def plain_pipeline(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    known = {r.doc_id for r in language_id.identify(docs).collect() if r.lang_pred != "und" and r.score >= 0.5}
    rows = [(i, t) for i, t in rows if i in known]
    last = {}
    for i, t in rows:
        last[t] = max(last.get(t, i), i)
    rows = [(i, t) for i, t in rows if last[t] == i]
    kept = set(plain_kept(rows))                 # five-word shingles, Jaccard 0.8
    return sorted((i, t) for i, t in rows if i in kept)


def test_pipeline(spark, docs):
    near = docs.filter("length(text) > 5000").limit(3).withColumns(
        {"doc_id": F.col("doc_id") + 100_000, "text": F.concat("text", F.lit("."))})
    extra = docs.unionByName(near).unionByName(docs.limit(1).withColumns({"doc_id": F.lit(999_999).cast("long"), "text": F.lit("12 34")}))
    kept = extra
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SMALL)
        assert kept.columns == docs.columns
    want = plain_pipeline(spark, extra)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == want and 999_999 not in dict(want)
    n, least = checked_packing(corpus_pipeline.STAGES[-1][1](spark, kept, SMALL), want)
    assert n <= 1.05 * least
    assert corpus_pipeline.run(spark, SMALL).select("doc_id").distinct().count() == len(plain_pipeline(spark, docs))


def test_pipeline_with_awkward_rows(spark):
    kept = awkward(spark)
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SMALL)
    assert kept.count() > 0
    kept = awkward(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SMALL)
    assert kept.count() == 0
