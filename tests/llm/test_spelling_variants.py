"""Spelling variants against a brute-force version."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from crownframe.llm import queries, spelling_variants
from tests.conftest import SMALL
from tests.llm.test_operators import ROWS, awkward, rows_of

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_near(words):
    near = {w: [] for w in words}
    for a in words:
        for b in words:
            if abs(len(a) - len(b)) < 2 and a < b and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    return near


def plain_variants(rows):
    words = plain_words(rows)
    near, form = plain_near(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, root(w), form[w], n, len(near[w]), words.get(form[w])) for w, n in words.items()), key=repr)


def invented():
    """Words with equal characters in a row, edits at both ends, ties, chains of forms and letters beyond ASCII."""
    rng, rows = random.Random(4), []
    seeds = ["aaaaa", "aabaab", "banana", "ÀÉéÿñx", "straße", "caffeine", "abcde", "bcdef"]
    vocabulary = list(seeds)
    for w in seeds:
        for _ in range(40):
            x, k = rng.choice(vocabulary[-20:] + [w]), 0
            k = rng.randrange(len(x) + 1)
            vocabulary.append(rng.choice([x[:k] + rng.choice("abcxé") + x[k:], x[:k] + x[k + 1:], x[:k] + rng.choice("abÿ") + x[k + 1:]]))
    for i in range(300):
        text = " ".join(rng.choices(vocabulary, weights=[1 + 400 // (j + 1) for j in range(len(vocabulary))], k=30))
        rows.append((i, rng.choice([text, text.upper(), text.replace(" ", ", 1×÷-")])))
    return rows


def test_variants_are_those_of_all_pairs(spark):
    rows = [*ROWS, *invented()]
    want = plain_variants(rows)
    depth = {w: f for w, _, f, *_ in want}
    assert any(f and depth.get(f) for f in depth.values()) and max(x[4] for x in want) > 5
    assert rows_of(spelling_variants.variants(awkward(spark, rows))) == want


def test_whole_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    assert rows_of(queries.op12_spelling_variants(spark, SMALL)) == plain_variants(map(tuple, docs.collect()))


def test_pairs_are_written_once(spark):
    words = plain_words(invented())
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    want = sorted((a, b) for a, others in plain_near(words).items() for b in others if a < b)
    assert sorted(map(tuple, spelling_variants.near_pairs(table).collect())) == want
    near = spelling_variants.neighbours(table).agg(F.sum("n_near")).first()[0]
    assert near == 2 * len(want)


def test_walks_of_many_steps(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(40)] + [("alone", "w40")]
    found = spelling_variants.roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r.root for r in found} == {"w40"} and len(found) == 41


def test_an_empty_table(spark):
    assert spelling_variants.variants(awkward(spark).limit(0)).count() == 0
    assert spelling_variants.variants(awkward(spark, [(1, None), (2, ""), (None, None)])).count() == 0
