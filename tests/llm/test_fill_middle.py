"""Fill-in-the-middle against a plain version on odd rows, and boundary sets of every container."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crownframe.llm import fill_middle
from crownframe.llm.fill_middle import ARRAY, BITMAP, RUNS, BoundarySet, token_ends
from tests.llm.test_operators import ROWS, awkward, rows_of

TOKEN = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text, seed=42):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    tokens = TOKEN.findall(text)
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or h[2] % 100 >= 50 or re.search("<[PSM]>", text):
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_rows():
    rng = random.Random(3)
    pieces = ["a", "é", "中文", " ", "\n\t", " ", " x", "<", "<P", "P>", "word", "\x1c", "\x0b"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(60))) for _ in range(150)]
    texts += ["x <P> y", "<S>", "a<M>", "  lead", "trail  ", " ", "é" * 70_000, "ab " * 70_000, "a " * 40_000 + " " * 70_000]
    return [*ROWS, *((1000 + i, t) for i, t in enumerate(texts))]


def test_documents_are_cut_as_by_a_plain_version(spark):
    rows = odd_rows()
    want = [plain(i, t) for i, t in rows]
    assert {w[2] for w in want} == {"plain", "spm", "psm"}
    done = fill_middle.transform(awkward(spark, rows))
    assert rows_of(done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")) == sorted(want, key=repr)
    back = fill_middle.restore(done)
    assert rows_of(back.select("doc_id", "restored")) == sorted(((i, t or "") for i, t in rows), key=repr)
    digests = [(*w[:5], sha(w[5]), sha(t or "")) for w, (_, t) in zip(want, rows)]
    assert rows_of(fill_middle.digests(awkward(spark, rows))) == sorted(digests, key=repr)


def test_new_cuts_from_stored_boundaries(spark):
    rows = odd_rows()
    done = fill_middle.transform(awkward(spark, rows), with_boundaries=True)
    again = fill_middle.cut_again(done, 7).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    assert rows_of(again) == sorted((plain(i, t, 7) for i, t in rows), key=repr)


def test_an_empty_table(spark):
    assert fill_middle.digests(awkward(spark).limit(0)).count() == 0
    assert fill_middle.cut_again(fill_middle.transform(awkward(spark).limit(0), with_boundaries=True), 1).count() == 0


@pytest.mark.parametrize("kind, members", [
    (ARRAY, np.arange(0, 9000, 3)), (BITMAP, np.arange(0, 65536, 3)), (RUNS, np.r_[5:9000, 9100:60000]),
    (RUNS, np.arange(65536)), (ARRAY, np.array([65535]))])
def test_containers(kind, members):
    for shift in (0, 7 * fill_middle.SPAN):
        s = BoundarySet.of(members + shift)
        assert [k for k, _ in s.containers] == [kind] and len(s) == len(members)
        for t in (s, BoundarySet.from_bytes(s.to_bytes())):
            assert all(t.select(k) == members[k] + shift for k in (*range(0, len(members), 97), len(members) - 1))
            for k in (-1, len(members)):
                with pytest.raises(IndexError):
                    t.select(k)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400_000), st.integers(1, 9000)), max_size=8), st.integers(1, 5))
def test_sets_of_mixed_containers(runs, step):
    members = np.unique(np.concatenate([np.arange(a, a + n, step) for a, n in runs])) if runs else np.empty(0, np.int64)
    s = BoundarySet.from_bytes(BoundarySet.of(members).to_bytes())
    assert len(s) == len(members) and [s.select(k) for k in range(0, len(members), 311)] == members[::311].tolist()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a \n\té中<P>", max_size=40))
def test_token_ends(text):
    ends = np.cumsum([len(t.encode()) for t in TOKEN.findall(text)])
    assert token_ends(text.encode()).tolist() == ends.tolist()
