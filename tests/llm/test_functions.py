"""Functions of the text operators against plain versions."""

import base64
import io
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from crownframe.llm import arc_to_warc, byte_bpe, html_text, language_id, metric_tree, pattern_packing
from crownframe.llm import simhash_trees, token_store, words

ODD = "abcdeABÉéßüñ ''’\n\t  .,!?$|<>0123_-sdmtrevl \u0085 ­²½ªºµİıʰ˂中Жй́\x1c\x1f　😀"


def odd_texts(n=3000, seed=3):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return texts + ["", " ", "  ", "'", "'s", "a'", "'l", "''s", "a'sb 'reab", "don't 've''ll 'S", "a" * 5000,
                    " \n" * 500, "<|endoftext|> x", "x  \n y", "tail  ", "\n\n"]


@pytest.mark.parametrize("name", sorted(words.SPLIT))
def test_words_are_those_of_the_library(name):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    library.encode_special_tokens = True
    texts = odd_texts()
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    encoder = words.WordEncoder(name)
    for _ in range(2):                                  # second time from memory
        assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)] == want


def test_words_forgotten_are_learnt_again(monkeypatch):
    monkeypatch.setattr(words, "REMEMBERED", 20)
    monkeypatch.setattr(words, "STEP", 50)
    encoder, plain = words.WordEncoder("byte_bpe_50k.json"), words.WordEncoder("byte_bpe_50k.json")
    texts = odd_texts(200)
    assert list(encoder.encode(texts)) == [b"".join(plain.encode([t])) for t in texts]


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_encodes_as_the_library_and_decodes(library, monkeypatch):
    texts = odd_texts(seed=4)
    codec = byte_bpe.BytePairs("byte_bpe_multi_50k.tiktoken")
    for step in (1 << 20, 100):
        monkeypatch.setattr(byte_bpe, "STEP", step)
        got = list(codec.encode(texts))
        assert [x.tolist() for x, _ in got] == library.encode_ordinary_batch(texts)
        assert [d.decode() for _, d in got] == [",".join(map(str, x.tolist())) for x, _ in got]
        for text, (ids, _) in zip(texts, got):
            offsets, data = codec.offsets(ids), text.encode()
            assert codec.decode(ids) == data
            if len(ids) > 3:                            # any run of ids by the offsets kept
                assert codec.decode(ids[1:-1], offsets[1:-1]) == data[offsets[1]:offsets[-2]]


def test_bpe_classes_of_every_code_point(library):
    codec = byte_bpe.pairs("byte_bpe_multi_50k.tiktoken")
    texts = ["x" + chr(c) + "y " + chr(c) + " " + chr(c) + "'s1" + chr(c)
             for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    assert [x.tolist() for x, _ in codec.encode(texts)] == library.encode_ordinary_batch(texts)


def plain_fingerprint(text, k=3):
    found = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()).split()
    shingles = [b" ".join(found[i:i + k]) for i in range(len(found) - k + 1)] or ([b" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    bits = sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def test_fingerprints():
    for text in ["", " \t\n", "One", "one two", "A b C", "a b c d a b c d", "Ä ä x \x0b y", *odd_texts(50)]:
        assert simhash_trees.fingerprint(text) == plain_fingerprint(text)


def clusters(rng, n, spread):
    seeds = rng.integers(-2**62, 2**62, max(1, n // 20))
    fp = seeds[rng.integers(0, len(seeds), n)]
    for _ in range(spread):
        fp = fp ^ (np.int64(1) << rng.integers(0, 64, n))
    return np.unique(fp)


def plain_components(fp, radius=2):
    label = np.arange(len(fp))
    near = np.bitwise_count((fp[:, None] ^ fp[None, :]).view(np.uint64)) <= radius
    while True:
        low = np.array([label[row].min() for row in near])
        if (low == label).all():
            return fp[label]
        label = low


@pytest.mark.parametrize("spread", [0, 1, 2, 5])
def test_trees_find_every_link(spread):
    rng = np.random.default_rng(spread)
    fp = clusters(rng, 400, spread)
    group = np.sort(rng.integers(0, 3, len(fp)))
    found = {(int(a), int(b)) for x, y in simhash_trees.Forest(fp, group).links(2, step=64) for a, b in zip(x, y)}
    d = np.bitwise_count((fp[:, None] ^ fp[None, :]).view(np.uint64))
    assert found == {(i, j) for i in range(len(fp)) for j in range(i) if group[i] == group[j] and d[i, j] <= 2}
    u, root = simhash_trees.stars(fp, np.zeros(len(fp), int), 2)
    want = plain_components(fp)
    assert dict(zip(u.tolist(), root.tolist())) == {a: b for a, b in zip(fp.tolist(), want.tolist()) if a != b}


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**32))
def test_perfect_hash_is_one_to_one(n, seed):
    rng = np.random.default_rng(seed)
    h1, h2 = (rng.integers(0, 2**64, n, np.uint64) for _ in range(2))
    h1[: n // 3] = h1[0]                                # keys that share one of the two hashes
    pilots, slots = token_store.perfect_hash(h1, h2)
    assert sorted(slots.tolist()) == list(range(n))
    again = token_store._slots(h1, h2, pilots[token_store._group_of(h2, n)], n)
    assert (again == slots).all()


def checked_plan(histogram, capacity):
    plan = pattern_packing.plan(histogram, capacity)
    used = Counter()
    for pattern, times in plan:
        assert sum(n * m for n, m in pattern) <= capacity
        for n, m in pattern:
            used[n] += m * times
    assert used == Counter({n: c for n, c in histogram.items() if c})
    return sum(times for _, times in plan)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 97), st.integers(0, 300), max_size=40))
def test_plan_uses_each_piece_once(histogram):
    checked_plan(histogram, 97)


def test_plan_is_close_to_the_least():
    rng = np.random.default_rng(5)
    for lengths in (rng.integers(1, 4097, 60_000), np.clip(rng.lognormal(6.5, 1, 60_000).astype(int), 1, 4096)):
        least = -(-int(lengths.sum()) // 4096)
        assert checked_plan(dict(Counter(lengths.tolist())), 4096) <= 1.005 * least
    assert checked_plan({4096: 7}, 4096) == 7 and checked_plan({}, 4096) == 0
    assert checked_plan({2048: 10}, 4096) == 5 and checked_plan({1: 5000}, 4096) == 2


def test_fit_is_the_least_squares_one():
    rng = np.random.default_rng(6)
    a, x = rng.random((12, 5)), np.array([0, 2, 0, 3, 1.0])
    assert np.allclose(pattern_packing.non_negative_fit(a, a @ x), x, atol=1e-2)


def test_places_are_gapless():
    plan = pattern_packing.plan({5: 40, 3: 90, 97: 2, 60: 11}, 97)
    at = {}
    for n, first, stop, seq, each, offset in pattern_packing.places(plan):
        for r in range(stop - first):
            at.setdefault(seq + r // each, []).append((offset + r % each * n, n))
    for parts in at.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= 97


def test_features_stay_within_texts():
    texts = ["Ab, b!", "", "...", "ñandú", "x"]
    together, ends = language_id.features(texts)
    alone = [language_id.features([t])[0].tolist() for t in texts]
    assert [together[a:b].tolist() for a, b in zip([0, *ends], ends)] == alone
    assert alone[1] == alone[2] == [] and language_id.features([])[0].size == 0


def test_tree_search_is_exact(monkeypatch):
    rng = np.random.default_rng(7)
    monkeypatch.setattr(metric_tree, "PAGE", 8)
    for v in (rng.integers(-1000, 1000, (700, 6)), np.repeat(rng.integers(-5, 5, (4, 6)), 60, 0), np.zeros((40, 6), int),
              rng.integers(-2**25, 2**25, (200, 6))):
        v = v.astype(np.int64)
        ids = rng.permutation(len(v))
        tree = metric_tree.Tree(6)
        for page in metric_tree._bulk_load(metric_tree.Metric(v), ids, ids, np.zeros(len(v), bool)):
            tree.add(page)
        for i in range(0, len(v), 17):
            with np.errstate(over="ignore"):
                score = v @ v[i]
            order = [j for j in np.lexsort((ids, -score)) if j != i][:10]
            got, who, _ = tree.search(v[i], int(ids[i]), 10)
            assert got.tolist() == score[order].tolist() and who.tolist() == ids[order].tolist()


def test_tree_search_skips_pages():
    rng = np.random.default_rng(8)
    v = (rng.normal(size=(50, 1, 8)) * 4000 + rng.normal(size=(50, 200, 8)) * 20).reshape(-1, 8).astype(np.int64)
    tree = metric_tree.Tree(8)
    for page in metric_tree._bulk_load(metric_tree.Metric(v), np.arange(len(v)), np.arange(len(v)), np.zeros(len(v), bool)):
        tree.add(page)
    opened = []
    pages = tree.pages
    tree.pages = type("Counting", (dict,), {"__getitem__": lambda s, k: opened.append(k) or dict.__getitem__(s, k)})(pages)
    tree.search(v[0], 0, 10)
    assert len(opened) < len(pages) / 2


@pytest.mark.parametrize(("markup", "text"), [
    ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\n\nb"), ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("a<br>b", "a\nb"), ("<ul><li>x<li>y</ul>z", "- x\n- y\n\nz"), ("<ol start=3><li>x<li>y</ol>", "3. x\n4. y"),
    ("<ul><li>x<ul><li>y</ul><li>z</ul>", "- x\n  - y\n- z"),
    ("<table><tr><th>aa<th>b<tr><td>1<td>22</table>", "aa  b\n1   22"),
    ("<table><tr><td rowspan=2>a<td>bb<tr><td>c</table>", "a  bb\n   c"),
    ("<table><td>a<td>b</table>c", "a  b\n\nc"), ("<pre> k\n  l</pre>", " k\n  l"),
    ("<head><title>t</title><style>s</style></head><body>b", "b"), ("<p hidden>a</p>b<!-- c --><script>d</script>", "b"),
    ("<div style='DISPLAY : none'>a</div><span style='visibility:hidden'>b</span>c", "c"),
    ("<script>var t='</p>';</script>x", "x"), ("a < b and c > d", "a < b and c > d"), ("</p></div>x", "x"),
    ("<b>a<i>b</b>c", "abc"), ("<h1>a</h1>b", "a\n\nb"), ("<select><option>a<option>b</select>", "a\nb"),
    ("<img alt='pic'> t", "pic t"), ("<dl><dt>a<dd>b<dt>c</dl>", "a\n  b\nc"), ("<dialog>a</dialog><dialog open>b</dialog>", "b"),
    ("<!-- open", ""), ("<p", "<p"), ("<script>never closed", ""),
])
def test_pages_are_laid_out(markup, text):
    assert html_text.visible_text(markup) == text


def test_deep_and_long_pages():
    assert html_text.visible_text("<div>" * 5000 + "x") == "x"
    assert html_text.visible_text("<b>" * 5000 + "x" + "</b>" * 5000 + "y").replace("\n", "") == "xy"
    assert len(html_text.visible_text("<p>word " * 20_000).split()) == 20_000


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<table>", "<tr>", "<td>", "</table>", "<ul>", "<li>", "</ul>", "<b>", "</b>",
                                 "word", " ", "<br>", "<pre>", "</pre>", "<div>", "</div>", "&lt;"]), max_size=40))
def test_no_visible_word_is_lost(parts):
    shown = html_text.visible_text("".join(parts))
    assert shown.count("word") == parts.count("word")


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records_are_parsed_by_their_version(version):
    data = arc_to_warc._packed(arc_to_warc.version_block(version, "f.arc"))
    blocks = [arc_to_warc._http(p, i) for i, p in enumerate([b"", b"a\nb\n\n", b"x" * 3_000_000, b"URL 1 2 3 4\n"])]
    for b in blocks:
        data += arc_to_warc._packed(arc_to_warc.arc_record(version, {"URL": "http://x/", "Archive-length": len(b)}, b))
    got = list(arc_to_warc.parse_arc(io.BytesIO(data)))
    assert [x[3] for x in got] == blocks and all(x[2]["URL"] == "http://x/" for x in got)
    for at, size, _, _ in got:
        assert len(list(arc_to_warc.Members(io.BytesIO(data[at:at + size])))) == 1
    with pytest.raises(OSError):
        list(arc_to_warc.parse_arc(io.BytesIO(data[:-10])))
