"""The pipeline's near copies against all pairs compared whole."""

import random

import numpy as np
import pytest

import corpus_pipeline
from crownframe.llm import near_copies
from tests.conftest import SMALL


def plain_set(text, k=5):
    words = (text or "").lower().split()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def plain_kept(rows):
    sets = [plain_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(least.values())


def changed(rng, words, n):
    """The text with n words replaced, far from each other."""
    words = list(words)
    for i in rng.sample(range(0, len(words) // 6), n):
        words[6 * i + 5] = f"new{rng.random()}"
    return words


def planted(seed=5):
    """Rows, and the similarity of each pair planted."""
    rng, rows, pairs = random.Random(seed), [], []
    for length in (60, 300, 1200):
        for share in np.linspace(0, 0.06, 13):
            words = [f"w{rng.randrange(5000)}" for _ in range(length)]
            a, b = " ".join(words), " ".join(changed(rng, words, int(share * length / 2)))
            pairs.append((len(rows), len(rows) + 1, jaccard(plain_set(a), plain_set(b))))
            rows += [(len(rows), a), (len(rows) + 1, b)]
    return rows, pairs


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def test_planted_copies_are_found(spark):
    rows, pairs = planted()
    assert sum(0.8 <= v < 0.95 for _, _, v in pairs) >= 8 and sum(0.6 < v < 0.8 for _, _, v in pairs) >= 5
    kept = {r.doc_id for r in corpus_pipeline.near(spark, frame(spark, rows), SMALL).collect()}
    for a, b, v in pairs:
        assert a in kept and (b in kept) == (v < 0.8), v


@pytest.mark.parametrize("radius", [0, 2])
def test_crowds_are_linked_as_by_all_pairs(spark, radius):
    """Copies in chains and crowds, lines that many share, and rows without words."""
    rng, texts = random.Random(9), [None, "", " \n", "one two", "ONE  two", "one two three"]
    line = [f"line{i}" for i in range(150)]
    for _ in range(4):
        words = [f"w{rng.randrange(300)}" for _ in range(120)]
        for _ in range(30):                          # each a copy of the one before
            texts.append(" ".join(words))
            words = changed(rng, words, rng.choice([1, 1, 2, 3]))
        texts += [" ".join([*line, *[f"v{rng.randrange(10**6)}" for _ in range(n)]]) for n in (25, 35, 50, 60, 80)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    kept = sorted(r.doc_id for r in near_copies.keep_one(frame(spark, rows), radius).collect())
    assert kept == plain_kept(rows) and len(kept) < len(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.dropDuplicates(["doc_id"]).collect()]
    kept = sorted(r.doc_id for r in near_copies.keep_one(frame(spark, rows)).collect())
    assert kept == plain_kept(rows)
