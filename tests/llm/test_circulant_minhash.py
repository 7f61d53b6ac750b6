"""MinHash near-duplicates against all pairs compared whole."""

import random

import numpy as np
import pyarrow as pa
import pytest

from crownframe.llm import circulant_minhash, jaccard_groups, queries
from crownframe.llm.circulant_minhash import band_keys, permuted, signature
from tests.conftest import SMALL
from tests.llm.test_near_copies import changed, jaccard
from tests.llm.test_operators import ROWS, awkward, rows_of


def plain_set(text, k):
    words = (text or "").encode().lower().split()              # bytes: A-Z and ASCII spaces only
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def plain_near(rows, k=3, percent=85):
    """(doc_id, n_shingles, component_id, kept) by all pairs of rows."""
    sets, label = [plain_set(t, k) for _, t in rows], list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        shared = {}
        for x in s:
            for j in holders[x]:
                shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                label[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = [x for x in (least.get(root(i)), doc) if x is not None]
        least[root(i)] = min(known) if known else None
    return sorted(((doc, len(sets[i]), least[root(i)], doc == least[root(i)]) for i, (doc, _) in enumerate(rows)), key=repr)


def crowds(seed=9):
    """Copies in chains, crowds around one text and just outside the threshold, and a passage that many share."""
    rng, texts = random.Random(seed), ["", " \n", "one two", "ONE  two", "one two three", "one two three"]
    line = [f"line{i}" for i in range(150)]
    for length, steps in ((60, [0, 1]), (240, [1, 2, 3]), (600, [2, 5, 8, 12])):
        base = [f"w{rng.randrange(300)}" for _ in range(length)]
        words = base
        for _ in range(25):
            words = changed(rng, words, rng.choice(steps))            # each a copy of the one before
            texts += [" ".join(words), " ".join(changed(rng, base, rng.choice(steps) + rng.choice([0, length // 60])))]
    texts += [" ".join([*line, *[f"v{rng.randrange(10**6)}" for _ in range(rng.randrange(15, 80))]]) for _ in range(40)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("group", [4096, 16])
def test_crowds_are_linked_as_by_all_pairs(spark, monkeypatch, group):
    monkeypatch.setattr(jaccard_groups, "GROUP", group)
    rows = crowds()
    want = plain_near(rows)
    sizes = {c: sum(x[2] == c for x in want) for _, _, c, _ in want}
    assert max(sizes.values()) > 20 and sum(n == 1 for n in sizes.values()) > 40
    assert rows_of(circulant_minhash.near_dups(awkward(spark, rows))) == want


def test_awkward_rows(spark):
    assert rows_of(circulant_minhash.near_dups(awkward(spark))) == plain_near(ROWS)
    assert circulant_minhash.near_dups(awkward(spark).limit(0)).count() == 0
    assert rows_of(circulant_minhash.near_dups(awkward(spark, [(1, None), (None, ""), (None, "x")]))) == [
        (1, 0, 1, True), (None, 0, None, True), (None, 1, None, True)]


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = plain_near([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(queries.op13_minhash_near_dups(spark, "/root/testdata/sf0.01")) == want
    assert queries.op13_minhash_near_dups(spark, SMALL).columns == ["doc_id", "n_shingles", "component_id", "kept"]


@pytest.mark.parametrize("columns, rows", [(4096, 256), (7, 2)])
@pytest.mark.parametrize("pieces", [1, 2, 50])
def test_listed_nodes_are_joined_as_by_all_pairs(monkeypatch, columns, rows, pieces):
    """Links found in a task join what all pairs would, whatever the batches and blocks, and no pair twice."""
    monkeypatch.setattr(jaccard_groups, "COLUMNS", columns)
    monkeypatch.setattr(jaccard_groups, "ROWS", rows)
    rule, rng = jaccard_groups.Rule(3, 85), random.Random(3)
    table, sets = [], {}
    for x in range(3):
        base = rng.sample(range(1000), 40)
        for k in range(30):
            s = sorted({*rng.sample(base, 40 - rng.randrange(5)), *(rng.randrange(1000, 1010) for _ in range(rng.randrange(4)))})
            sets[100 * x + k] = set(s)
            table.append((x, 0, x % 2, k % (1 + x % 2), 100 * x + k, len(s), len(s), 100 * x + k - k % 3, s))
    names = ["x", "low", "high", "block", "node", "n", "most", "root", "s"]
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*table)], names=names)
    size = -(-len(table) // pieces)
    batches = [whole.slice(i, size) for i in range(0, len(table), size)]
    found = [p for b in jaccard_groups.settled(iter(batches), rule) for p in zip(*(c.to_pylist() for c in b.columns))]
    label = {r[4]: r[7] for r in table}
    for u, v in found:
        a, b = label[u], label[v]
        assert a != b and rule.similar(len(sets[u] & sets[v]), len(sets[u]), len(sets[v]))
        label = {k: b if c == a else c for k, c in label.items()}
    for u in table:
        for v in table:
            if u[0] == v[0] and rule.similar(len(sets[u[4]] & sets[v[4]]), u[5], v[5]) and (not u[2] or u[3] != v[3]):
                assert label[u[4]] == label[v[4]]


def test_permutations_map_no_two_numbers_to_one():
    x = np.random.default_rng(1).choice(1 << 32, 200_000, replace=False).astype(np.uint32)
    for factors in (circulant_minhash.FIRST, circulant_minhash.SECOND):
        assert len(np.unique(permuted(x.copy(), factors))) == len(x)


@pytest.mark.parametrize("n, shared", [(40, 30), (400, 300), (5000, 4600)])
def test_coordinates_agree_as_often_as_sets_are_similar(n, shared):
    rng = np.random.default_rng(n)
    agree = []
    for _ in range(60):
        x = rng.integers(0, 1 << 63, 2 * n - shared)
        agree.append((signature(x[:n], 128) == signature(x[n - shared:], 128)).mean())
    value = shared / (2 * n - shared)
    assert abs(np.mean(agree) - value) < 4 * np.sqrt(value * (1 - value) / 128 / 60)


def test_similar_sets_share_a_band():
    rng, missed = random.Random(2), 0
    for _ in range(200):
        words = [f"w{rng.randrange(9999)}" for _ in range(150)]
        a, b = " ".join(words), " ".join(changed(rng, words, rng.choice([1, 2, 3])))
        if jaccard(plain_set(a, 3), plain_set(b, 3)) >= 0.85:
            keys = [set(band_keys(signature(jaccard_groups.shingle_set(t, 3), 128)).tolist()) for t in (a, b)]
            missed += not keys[0] & keys[1]
    assert not missed
