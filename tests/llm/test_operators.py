"""Operators on small tables against brute force, and on rows with nulls, ties, repeats and clashing names."""

import collections
import hashlib
import heapq
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dupelens.llm import (
    components,
    context_tree,
    decontamination,
    fingerprints,
    html_extraction,
    jaccard_join,
    license_scan,
    sentencepiece_lattice,
    sharding,
    tables,
    token_counts,
    toxicity,
    words,
)
from tests.llm.cases import documents, empty, near, prose, rows, words_of


def shingle_set(text, size):
    w = words_of(text)
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def brute_components(data, size, percent):
    sets = {i: shingle_set(t, size) for i, t in data}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_word_hashes_follow_the_definition(spark):
    column = pa.array([t for _, t in rows()] * 2)
    raw, at = words.utf8(column)
    hashes, first = words.word_hashes(raw, at)
    by_word = {}
    for i, text in enumerate(column.to_pylist()):
        own = words_of(text)
        assert first[i + 1] - first[i] == len(own)
        for word, h in zip(own, hashes[first[i] : first[i + 1]].tolist(), strict=True):
            assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)
    sliced = words.utf8(column.slice(3, 5))
    assert bytes(sliced[0]) == "".join(t or "" for t in column.to_pylist()[3:8]).encode()


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (3, 60)])
def test_jaccard_components(spark, size, percent):
    expected = brute_components(rows(), size, percent)
    found = jaccard_join.jaccard_components(documents(spark), jaccard_join.Rule(size, percent)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert len(found) == len(rows())


def test_jaccard_on_a_large_family(spark):
    base = prose(7, 90)
    data = [(i, near(base, i, 1 + i % 5)) for i in range(250)] + [(1000 + i, prose(i, 60) + " " + base[:150]) for i in range(60)]
    found = jaccard_join.jaccard_components(documents(spark, data, 5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(data, 3, 90)


def brute_links(data, size, percent):
    sets = [shingle_set(t, size) for _, t in data]
    return [
        sum(i != j and bool(a & b) and 100 * len(a & b) >= percent * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)
    ]


@pytest.mark.parametrize("block", [7, 256])
def test_jaccard_counts_every_link(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_CLASSES", block)
    base = prose(7, 90)
    data = [(i, near(base, i, 1 + i % 5)) for i in range(60)] + [(100 + i, base) for i in range(3)] + [(i + 200, t) for i, t in rows()]
    found = {r.doc_id: r for r in jaccard_join.jaccard_links(documents(spark, data), jaccard_join.Rule()).collect()}
    assert [found[i].n_links for i, _ in data] == brute_links(data, 3, 90)
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == brute_components(data, 3, 90)
    assert jaccard_join.jaccard_links(empty(spark)).count() == 0


def test_common_counts_over_chunks(monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", 10)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (5, 80, 200, 1)]
    assert jaccard_join.common_counts(sets, sets[1:]).tolist() == [[len(np.intersect1d(a, b)) for b in sets[1:]] for a in sets]


@pytest.mark.parametrize(("rounds", "block"), [(0, 1024), (0, 9), (1, 9), (2, 1024)])
def test_jaccard_groups_in_blocks(spark, monkeypatch, rounds, block):
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "GROUP_CLASSES", block)
    base = prose(7, 90)
    data = [(i, near(base, i, 1 + i % 9)) for i in range(90)] + [(200 + i, t) for i, t in rows()]
    found = jaccard_join.jaccard_components(documents(spark, data)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(data, 3, 90)


def test_groups_with_few_pairs_are_checked_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "ROUNDS", 0)
    monkeypatch.setattr(jaccard_join, "GROUP_CLASSES", 1)
    direct = []
    plain = jaccard_join._all_pairs
    monkeypatch.setattr(jaccard_join, "_all_pairs", lambda *a: direct.append(1) or plain(*a))
    first = [prose(1000 + i, 60) for i in range(30)]
    data = [(i, t) for i, t in enumerate(first)] + [(100 + i, near(t, i)) for i, t in enumerate(first)]
    found = jaccard_join.jaccard_components(documents(spark, data), jaccard_join.Rule(3, 80)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(data, 3, 80)


def test_least_linked_follows_chains():
    linked = np.zeros((4, 4), bool)
    linked[[0, 1, 1, 2], [1, 1, 2, 2]] = True
    first, second = jaccard_join.least_linked(linked, np.array([50, 40, 30, 1]), np.array([9, 70, 60, 2]))
    assert (first.tolist(), second.tolist()) == ([30, 30, 30, 1], [9, 30, 30, 2])


def test_one_row_of_each_group_stays(spark):
    text, other = prose(1, 80), prose(2, 80)
    data = [(5, text), (5, text), (5, near(text, 1)), (None, text), (7, near(text, 2)), (None, other), (None, other), (None, near(other, 3))]
    data += [(9, None), (9, None), (None, ""), (9, prose(3, 50)), (11, "unlike all others")]
    kept = jaccard_join.one_of_each(documents(spark, data), jaccard_join.Rule(5, 80)).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(["5", "None", "9", "9", "None", "9", "11"])
    assert sum(r.text is None for r in kept) == 2 and kept[0].n == "clash"
    assert jaccard_join.one_of_each(empty(spark), jaccard_join.Rule(5, 80)).count() == 0


def test_jaccard_keeps_repeated_rows_and_takes_nulls(spark):
    data = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, None), (2, None)]
    found = jaccard_join.jaccard_components(documents(spark, data)).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in found) == [("1", 1), ("1", 1), ("2", 2), ("2", 2), ("None", 1)]
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0
    kept = jaccard_join.one_of_each(documents(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (3, None)]), jaccard_join.Rule(5, 80))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert kept.first().n == "clash"


def test_prefix_bound_holds_for_all_sizes():
    rule = jaccard_join.Rule(3, 80, 10)
    for n in range(1, 300):
        for m in range(n, n * 100 // 80 + 1):
            overlap = -(-80 * (n + m) // 180)
            common = min(overlap - n + rule.prefix(n), overlap - m + rule.prefix(m), overlap)
            assert common > max(rule.skipped(n), rule.skipped(m)) or overlap > n


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = {r.a: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 21)}, **{i: 100 for i in range(101, 140)}}


def test_fingerprints(spark):
    data = rows()
    found = {r.doc_id: r for r in fingerprints.edit_likeness(documents(spark)).collect()}
    texts = {i: t or "" for i, t in data}
    order = sorted(texts)
    for i, j in zip(order, order[1:] + order[:1], strict=True):
        n = len(texts[i])
        changed = texts[i][: n - n // 4] + texts[j][: n // 4]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(changed.encode()).hexdigest())
        a, b, c = shingle_set(texts[i], 5), shingle_set(changed, 5), shingle_set(texts[j], 5)
        if len(a) <= 128 and len(b) <= 128:
            assert r.near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        else:
            assert abs(r.near_edited - len(a & b) / len(a | b)) < 0.25
        if a or c:
            assert abs(r.near_next - len(a & c) / len(a | c)) < 0.25
    assert found[0].fingerprint == found[1].fingerprint == found[2].fingerprint
    many = [(i * i, prose(i, 8)) for i in range(3000)] + [(4, prose(9, 8))]
    got = fingerprints.edit_likeness(documents(spark, many)).collect()
    ids = sorted((i, 0) for i, _ in many)
    assert sorted((r.doc_id, 0) for r in got) == ids
    follower = {a[0]: b for a, b in zip(sorted(many), sorted(many)[1:] + sorted(many)[:1], strict=True) if a[0] != 4 and b[0] != 4}
    texts = dict(many)
    for r in got:
        if r.doc_id in follower:
            changed = fingerprints.edited(texts[r.doc_id], follower[r.doc_id][1])
            assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()


def test_fingerprint_edges(spark):
    one = fingerprints.edit_likeness(documents(spark, [(5, "a b c d e f g h")])).collect()
    assert [(r.doc_id, r.n_chars) for r in one] == [(5, 15)]
    assert fingerprints.edit_likeness(empty(spark)).count() == 0
    twice = fingerprints.edit_likeness(documents(spark, [(1, None), (1, None), (None, "x y")])).collect()
    assert sorted(str(r.doc_id) for r in twice) == ["1", "1", "None"]
    a, b = fingerprints.Sketch.of(np.arange(1, 5000, dtype=np.uint64) << np.uint64(51)), fingerprints.Sketch.of(np.arange(1, 90, dtype=np.uint64) << np.uint64(51))
    assert b.containment(a) == 1.0 and a.containment(b) < 0.5
    assert fingerprints.Sketch.read(a.write()).likeness(a) == 1.0
    assert set(a.merge(b).kept) == set(a.kept)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies, of course.</p></div>
<div class="ad">Buy now, cheap!</div><main><article><h1>A &amp; B</h1><p>First <b>bold</b>&nbsp;words,  here.<br>Second line.</p>
<p>Short.</p><ul><li>Item one<li>Item two</ul><p>Unclosed <i>paragraph, with more text in it.<p>Another one, that ends here.</p>
<section class="comments"><p>Reader: I do not agree, at all, with this.</p></section></article></main>
<aside><p>Related, long enough, and with marks.</p></aside><form><p>Sign up, now.</p><input></form><footer>&copy; us</footer>"""


def test_html_extraction(spark):
    text = html_extraction.main_text(PAGE)
    assert text == (
        "A & B\nFirst bold words, here. Second line.\nShort.\nItem one\nItem two\nUnclosed paragraph, with more text in it.\n"
        "Another one, that ends here."
    )
    data = [(1, "u", PAGE), (2, None, None), (2, None, ""), (3, "u", "no markup < here"), (None, "u", "<p>x</p>" * 5000)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "'clash' text")
    found = html_extraction.extracted(pages).collect()
    assert sorted((str(r.page_id), r.n_chars, len(r.text)) for r in found) == [
        ("1", len(text), len(text)), ("2", 0, 0), ("2", 0, 0), ("3", 16, 16), ("None", 9999, 9999)
    ]
    assert html_extraction.extracted(pages.limit(0)).count() == 0


LONG = "<p>" + "This is a sentence of the article, and it goes on. " * 12 + "</p>"
NAV = "<nav><a href=/>Home</a></nav><div><a href=/a>One</a> <a href=/b>Two</a></div>"


@pytest.mark.parametrize(
    ("body", "wanted"),
    [
        (f"{NAV}<article><h1>Title</h1><p>Lead</p><div class=body>{LONG * 8}</div></article>", ["Title", "Lead"]),
        (f"{NAV}<main><h1>Title</h1><article><div>{LONG * 8}</div></article></main>", ["Title"]),
        (f"{NAV}<article><section>{LONG * 12}</section><section><p>Second part, the end.</p></section></article>", ["Second part, the end."]),
        (f"{NAV}<div><div>{LONG * 12}</div><div>{LONG.replace('This', 'Small')}</div></div>", ["Small is"]),
        (f"{NAV}<div><div>{LONG * 8}</div><div><table><tr><td>Berlin<td>12<tr><td>Paris<td>14</table></div></div>", ["Berlin", "14"]),
        (f"{NAV}<div><div>{LONG * 8}</div><div><pre>first line\nlast line</pre></div></div>", ["first line last line"]),
        (f"{NAV}<div><div>{LONG * 8}</div><div><ul><li>two eggs<li>some flour</ul></div></div>", ["two eggs", "some flour"]),
    ],
)
def test_html_extraction_keeps_all_parts_of_an_article(body, wanted):
    text = html_extraction.main_text(f"<html><body>{body}<footer>us</footer></body></html>")
    assert all(w in text for w in ["the article, and", *wanted]) and not any(w in text for w in ("Home", "One", "us\n"))


@pytest.mark.parametrize(
    "opening",
    [
        "<form id=aspnetForm>", "<form><div class='site-main'>", "<div class='content with-sidebar'>", "<div class='page-with-header'>",
        "<div class='form-wide'>", "<div id=discussion>", "<label>", "<div role=dialog>", "<div class=overlay><article>", "<dialog><main>",
    ],
)
def test_html_extraction_keeps_an_article_in_a_marked_wrapper(opening):
    page = f"<body><nav><a href=/>Home</a></nav>{opening}<h1>Title</h1>{LONG * 3}<div class=comments><p>Reader: no, not at all.</p></div>"
    text = html_extraction.main_text(page + "<form><p>Sign up, now.</p></form>" * ("form" not in opening))
    assert text.startswith("Title") and text.count("article, and") == 36
    assert not any(w in text for w in ("Home", "Reader", "Sign up"))


@pytest.mark.parametrize("mark", ["<section class=comments>", "<aside>", "<div class='site-footer'>", "<div id=commentList>", "<span class=related>"])
def test_html_extraction_leaves_out_longer_text_beside_the_article(mark):
    text = html_extraction.main_text(f"<body><div><h1>Title</h1>{LONG}</div>{mark}{LONG.replace('article', 'reader') * 2}")
    assert "article, and" in text and "reader" not in text


@pytest.mark.parametrize(
    ("inside", "wanted"),
    [
        ("<p>Seen one.</p><div hidden><p>Secret.</p></div>", "Seen one."),
        ("<p>Seen one.</p><div hidden=''><p>Secret.</p></div><p hidden=until-found>Secret.</p>", "Seen one."),
        ("<p>Seen one.</p><div style='color: red; display : none'><p>Secret.</p></div><p style=visibility:hidden>Secret.</p>", "Seen one."),
        ("<p data-hidden=no style='display:block' title='hidden display:none'>Seen one.</p>", "Seen one."),
        ("<p>Let <math><msup><mi>x</mi><mn>2</mn></msup><annotation>Secret</annotation></math> grow.</p>", "Let x2 grow."),
        ("<p>Press <button>Secret</button> once, then <select><option>Secret</select> wait.</p>", "Press once, then wait."),
        ("<p title=It's>Seen one.</p><p title=it's>Seen two.</p>", "Seen one.\nSeen two."),
        ("<p title='a > b' lang = \"c > d\">Seen one.</p>", "Seen one."),
        ("<p title=\"it's\">Seen <b class=x'y>one</b>.</p>", "Seen one."),
    ],
)
def test_html_extraction_of_hidden_and_inline_elements(inside, wanted):
    text = html_extraction.main_text(f"<body>{NAV}<article>{LONG}{inside}{LONG}</article></body>")
    line = " ".join(["This is a sentence of the article, and it goes on."] * 12)
    assert text == f"{line}\n{wanted}\n{line}"
    assert html_extraction.main_text(f"<body style='visibility:hidden'><article>{LONG}</article></body>") == line


def test_html_extraction_of_deep_nesting():
    text = html_extraction.main_text("<div>" * 3000 + LONG + "</div>" * 3000)
    assert text.count("article, and") == 12


BAD = "idiotic moronic trashy".split()


def toxic_data():
    data, labels = [], []
    for i in range(400):
        text = ". ".join(prose(i * 10 + k, 8) for k in range(5 + i % 4)) + "."
        toxic = int(i % 5 == 0)
        if toxic:
            text = text.replace(". ", f" {BAD[i % 3]}{'ly' * (i % 2)}. ", 1)
        data.append((i, text))
        labels.append((i, 1, toxic))
    return data, labels


def test_toxicity_learns_from_documents_and_finds_sentences(spark):
    data, labels = toxic_data()
    known = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None), (7, 0, 5)], "doc_id long, quality int, toxic int")
    docs = documents(spark, [*data, (900, None), (901, ""), (902, "..."), (1, data[1][1])])
    found = toxicity.toxicity(docs, known).collect()
    assert len(found) == len(data) + 4
    held = [(r.predicted, int(r.doc_id % 5 == 0)) for r in found if r.held_out and r.doc_id < 400]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in found)
    assert all(r.score < 0.05 for r in found if r.doc_id in (900, 901))
    model = toxicity.fit(docs, known)
    spans = toxicity.offending_sentences(docs, model).collect()
    assert spans and all(any(b in r.sentence for b in BAD) for r in spans)
    clean = toxicity.without_toxic(docs, known)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} >= {900, 901, 902, 1}


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r.predicted == 0 for r in toxicity.toxicity(documents(spark), none).collect())
    assert toxicity.toxicity(empty(spark), none).count() == 0


def test_noisy_or_gradient_reaches_the_right_feature():
    bags = [(1, 3, [[0], [1]]), (1, 2, [[0]]), (0, 4, [[1]]), (0, 5, [])] * 10
    weights, bias = toxicity.noisy_or_fit(bags, 2, toxicity.Settings())
    assert weights[0] > 4 > weights[1] and bias < -2


@pytest.fixture(scope="module")
def lattice():
    return sentencepiece_lattice.lattice(sentencepiece_lattice.model_path())


def brute_paths(lattice, part):
    def walk(i):
        if i == len(part):
            yield 0.0, ()
            return
        single = False
        for j in range(i + 1, len(part) + 1):
            if part[i:j] in lattice.score:
                single |= j == i + 1
                s, t = lattice.score[part[i:j]]
                for rest, ids in walk(j):
                    yield s + rest, (t, *ids)
        if not single:
            raw = part[i].encode()
            for rest, ids in walk(i + 1):
                yield lattice.fallback * len(raw) + rest, (*(lattice.byte[b] for b in raw), *ids)

    return heapq.nlargest(12, walk(0))


@pytest.mark.parametrize("text", ["the", "hello", "▁▁a", "naïve", "☃x", "tion.", "aaaa", "한국"])
def test_a_star_gives_the_best_paths_in_order(lattice, text):
    part = "▁" + text
    expected = brute_paths(lattice, part)
    found = lattice.paths(part, 12)
    assert [s for s, _ in found] == pytest.approx([s for s, _ in expected])
    assert len({ids for _, ids in found}) == len(found)
    assert lattice.solve(part)[0] == pytest.approx(expected[0][0])
    if len(expected) > 1:
        assert lattice.solve(part)[2] == pytest.approx(expected[0][0] - expected[1][0])


def test_n_best_of_a_text_equals_the_whole_lattice(lattice):
    text = "on the\nmat a"
    whole = brute_paths(lattice, "▁" + text.replace(" ", "▁"))[:4]
    ids, best, parts = lattice.n_best(text, 4)
    assert [s for s, _ in best] == pytest.approx([s for s, _ in whole])
    assert lattice.segmentation(parts, best[0][1]) == ids
    for _, changed in best:
        assert lattice.decode(lattice.segmentation(parts, changed)) == text


def test_long_parts_without_a_cut_or_full_of_cuts(lattice):
    for text in ("☃ü" * 20_000, "a" * 20_000, "\u2581" * 3_000, "xq7" * 5_000):
        ids, best, _ = lattice.n_best(text, 2)
        assert lattice.decode(ids) == text.replace("\u2581", " ")
        assert len(best) == 1 or best[0][0] >= best[1][0]


def test_parts_of_a_block_are_solved_together(lattice, monkeypatch):
    rng = random.Random(5)
    letters = ["a", "b", "e", "th", "ing", " ", "  ", "\n", "\u2581", ".", "-", "0", "\x00", "\u00e9", "\u6f22", "\u2603", "\U0001f600"]
    texts = [None, "", " ", "\n", "the the\n the", *("".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(150)), "", None]
    solved = [[lattice.solve(p) for p in lattice.parts(t or "")] for t in texts]
    lattice.known.clear()
    alone = sentencepiece_lattice.Lattice.solve
    calls = []
    monkeypatch.setattr(sentencepiece_lattice.Lattice, "solve", lambda self, part: calls.append(part) or alone(self, part))
    for some in (slice(None), slice(0, 2), slice(0, 0)):
        made = sentencepiece_lattice._columns(pa.array(texts, pa.string())[some], lattice, 2)
        ids, sizes, score, nbest, _, same = (c.to_pylist() for c in made)
        assert ids == [[i for p in s for i in p[1]] for s in solved[some]]
        assert sizes == [len(i) for i in ids] and all(same)
        assert score == pytest.approx([sum(p[0] for p in s) for s in solved[some]])
        second = [min((p[2] for p in s), default=float("inf")) for s in solved[some]]
        assert [b[0] - b[1] if len(b) > 1 else float("inf") for b in nbest] == pytest.approx(second)
    assert not calls, "no part of these texts is solved on its own"


def test_blocks_of_any_size_give_the_same(lattice, monkeypatch):
    column = pa.array([t for _, t in rows()] + ["a" * 90 + " b" * 90, "\u2603\u00fc" * 90], pa.string())
    expected = sentencepiece_lattice._columns(column, lattice, 4)
    for name, value in (("TOGETHER", 500), ("BLOCK_BYTES", 500), ("LONG_CELL", 3)):
        monkeypatch.setattr(sentencepiece_lattice, name, value)
        found = sentencepiece_lattice._columns(column, lattice, 4)
        assert [c.to_pylist() for c in found] == [c.to_pylist() for c in expected]


def test_encoding_round_trip(spark):
    docs = documents(spark)
    made = sentencepiece_lattice.encoded(docs)
    found = {r.doc_id: r for r in made.collect()}
    assert len(found) == len(rows()) and all(r.decoded and r.n_tokens == len(r.ids) for r in found.values())
    back = {r.doc_id: r.text for r in sentencepiece_lattice.decoded(made.select("doc_id", "ids")).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in rows()}
    assert found[6].n_tokens == 0 and found[6].nbest_scores == [0.0]
    assert all(list(r.nbest_scores) == sorted(r.nbest_scores, reverse=True) for r in found.values())
    assert sentencepiece_lattice.encoded(empty(spark)).count() == 0


def test_token_counts_equal_the_library(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_lattice.model_path())
    extra = [(200, " lead"), (201, "a\n\nb \n c"), (202, "<s> </s> <unk>"), (203, "x" * 5000), (204, "▁▁ ▁a"), (205, "\x00\t\r\n")]
    data = [*rows(), *extra, (0, rows()[0][1]), (None, "null id")]
    found = token_counts.token_counts(documents(spark, data)).collect()
    expected = sorted((str(i), len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for i, t in data)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in found) == expected
    assert token_counts.token_counts(empty(spark)).count() == 0


def test_token_counts_without_a_head(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "head_counts", lambda *_: {})
    found = {r.doc_id: r.n_tokens for r in token_counts.token_counts(documents(spark)).collect()}
    assert found == {i: len(token_counts.counter(sentencepiece_lattice.model_path()).model.encode(t or "")) for i, t in rows()}


def test_token_counts_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "head_counts", lambda *_: {})
    monkeypatch.setattr(token_counts, "BLOCK", 40)
    data = [*rows(), (0, rows()[0][1]), (None, "null id"), (None, None)]
    model = token_counts.counter(sentencepiece_lattice.model_path()).model
    found = token_counts.token_counts(documents(spark, data)).collect()
    expected = sorted((str(i), len((t or "").encode()), len(model.encode(t or ""))) for i, t in data)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == expected


def test_base_scores_and_counts(spark):
    data = [*rows(), (0, rows()[0][1])]
    found = context_tree.scores(documents(spark, data)).collect()
    counts, n = collections.Counter(), 0
    for i, t in data:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            own = [*words_of(t), None]
            counts.update(own)
            n += len(own)
    assert len(found) == len(data)
    texts = dict(data)
    for r in found:
        own = [*words_of(texts[r.doc_id]), None]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (len(counts) + 1))) for w in own)
        assert r.base_score == pytest.approx(base) and r.score < 0
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
    assert context_tree.scores(empty(spark)).count() == 0


def slow_tree(train, depth):
    """Plain dictionaries and recursion."""
    nodes = collections.defaultdict(lambda: [0, 0])
    for text in train:
        past = bytes([10]) * depth
        for byte in text:
            for k in range(8):
                u, bit = (byte | 256) >> (8 - k), (byte >> (7 - k)) & 1
                for d in range(depth + 1):
                    nodes[past[len(past) - d :], u][bit] += 1
            past = (past + bytes([byte]))[-depth:]
    weighted = {}
    for d in range(depth, -1, -1):
        below = collections.defaultdict(float)
        for (c, u), v in weighted.items():
            if len(c) == d + 1:
                below[c[1:], u] += v
        for (c, u), (a, b) in nodes.items():
            if len(c) == d:
                own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
                weighted[c, u] = own if d == depth else np.logaddexp(math.log(0.5) + own, math.log(0.5) + below[c, u])

    def probability(past, u, bit, d=0):
        c = past[len(past) - d :]
        a, b = nodes[c, u]
        own = ((b if bit else a) + 0.5) / (a + b + 1)
        if d == depth or (past[len(past) - d - 1 :], u) not in weighted:
            return own
        block = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
        share = math.exp(math.log(0.5) + block - weighted[c, u])
        return share * own + (1 - share) * probability(past, u, bit, d + 1)

    def score(text):
        past, total = bytes([10]) * depth, 0.0
        for byte in text:
            for k in range(8):
                u, bit = (byte | 256) >> (8 - k), (byte >> (7 - k)) & 1
                total += math.log10(probability(past, u, bit) if ((b"", u) in weighted) else 0.5)
            past = (past + bytes([byte]))[-depth:]
        return total

    return score


def test_tree_scores_equal_a_plain_tree(spark):
    data = [(i, prose(i, 12)) for i in range(30)] + [(40, None), (41, "zzz é QQ")]
    plain = {i: (" ".join(words_of(t)) + "\n").encode() for i, t in data}
    score = slow_tree([t for i, t in plain.items() if zlib.crc32(str(i).encode()) % 5 != 1], context_tree.DEPTH)
    for r in context_tree.scores(documents(spark, data)).collect():
        assert r.score == pytest.approx(score(plain[r.doc_id]), rel=1e-6), r.doc_id


def test_tree_scores_do_not_depend_on_the_head_table(spark, monkeypatch):
    data = [(i, prose(i, 30)) for i in range(25)]
    before = {r.doc_id: (r.base_score, r.score) for r in context_tree.scores(documents(spark, data)).collect()}
    monkeypatch.setattr(context_tree, "HEAD_RUNS", 40)
    monkeypatch.setattr(context_tree, "HEAD_WORDS", 5)
    after = {r.doc_id: (r.base_score, r.score) for r in context_tree.scores(documents(spark, data)).collect()}
    for i in before:
        assert after[i] == pytest.approx(before[i])


def test_most_frequent_keeps_the_greatest_within_the_room(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([9, 1, 1, 5, 70, 0, 1])], "key long, n long")
    assert {r.n for r in tables.most_frequent(counts, "n", 4).collect()} == {70, 9, 5}
    assert tables.most_frequent(counts, "n", 100).count() == 7
    assert tables.most_frequent(counts, "n", 0).count() == tables.most_frequent(counts.limit(0), "n", 5).count() == 0


def test_sharding(spark):
    data = [*rows(), *((300 + i, "one text of a hot group") for i in range(1500)), *((3000 + i, prose(i % 40, 30)) for i in range(400)), (0, "again")]
    found = sharding.sharded(documents(spark, data)).collect()
    assert len(found) == len(data)
    texts = collections.defaultdict(list)
    for i, t in data:
        texts[i].append(t or "")
    shards = collections.defaultdict(list)
    for r in found:
        shards[r.shard].append(r.slot)
        assert any(r.size == len(t.encode()) + 8 and r.text_crc32 == zlib.crc32(t.encode()) for t in texts[r.doc_id])
        assert r.law == "rows" and r.grown_shard is None
    assert sorted(shards) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    places = collections.defaultdict(set)
    for r in found:
        if 3000 <= r.doc_id:
            places[r.unit].add(r.shard)
    assert sum(len(p) > 1 for p in places.values()) <= 24
    few = sharding.sharded(documents(spark, [(1, "a"), (2, None)])).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0)]
    assert sharding.sharded(empty(spark)).count() == 0


def test_propagation_keeps_near_copies_together(spark):
    families = [prose(5000 + i, 60) for i in range(60)]
    data = [(i, near(families[i % 60], i)) for i in range(1200)]
    docs = documents(spark, data)
    values = sharding.described(docs).select("unit", F.explode("values").alias("value"))

    def cut(rounds):
        placed = sharding.sharded(docs, rounds=rounds).select("unit", "shard")
        # Of the links of a value, those to another shard than that of most of its units.
        rows = values.join(placed, "unit").groupBy("value", "shard").agg(F.countDistinct("unit").alias("n"))
        r = rows.groupBy("value").agg(F.max("n").alias("most"), F.sum("n").alias("all")).where("all > 1")
        r = r.agg(F.sum("most"), F.sum("all")).first()
        return 1 - r[0] / r[1]

    before, after = cut(0), cut(4)
    assert after <= 0.35 and after <= before / 2


def test_quotas_grant_slack():
    flows, loads = [(0, 1, 50)], {0: 100, 1: 100}
    assert sharding.quotas(flows, loads, 2) == [(0, 1, 0.0)]
    assert sharding.quotas(flows, loads, 2, 10)[0][2] == pytest.approx(0.2)


def test_quotas_never_overfill():
    flows = [(0, 1, 50), (1, 0, 20), (2, 1, 40), (0, 2, 5)]
    loads = {0: 100, 1: 90, 2: 110}
    granted = {(a, b): share for a, b, share in sharding.quotas(flows, loads, 3)}
    into = 90 + sum(granted[a, b] * n - granted.get((b, a), 0) * dict(((x, y), z) for x, y, z in flows).get((b, a), 0) for a, b, n in flows if b == 1)
    assert into <= 101 and granted[1, 0] == 1.0


def test_decontamination_by_tiles(spark):
    item = prose(77, 40)
    w = item.split(" ")
    moved = " ".join([*w[25:], *w[:25]])
    docs = [*rows(), (400, prose(5, 50) + " " + item.upper().replace(" ", ", ") + " " + prose(6, 50)), (401, moved), (402, " ".join(w[:15]) + " " + prose(8, 90)), (403, near(item, 1, 2)), (401, moved)]
    items = spark.createDataFrame([(1, item), (2, prose(78, 30)), (3, None), (4, "too short"), (5, item)], "item_id long, text string")
    found = decontamination.contaminated(documents(spark, docs), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == sorted([(400, 1), (400, 5), (401, 1), (401, 5), (401, 1), (401, 5), (403, 1), (403, 5)])
    assert [list(t)[1:] for t in next(r for r in found if r.doc_id == 401).tiles] == [[0, 25], [25, 15]]
    kept = decontamination.without_contaminated(documents(spark, docs), items)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i not in (400, 401, 403))
    assert decontamination.contaminated(empty(spark), items).count() == 0
    assert decontamination.contaminated(documents(spark), items.limit(0)).count() == 0


def slow_tiles(doc, item, seed):
    used_d, used_i, out = set(), set(), []
    while True:
        best = None
        for j in range(len(item)):
            for i in range(len(doc)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and i + k not in used_d and j + k not in used_i:
                    k += 1
                if k >= seed and (best is None or k > best[2]):
                    best = (i, j, k)
        if best is None:
            return out
        used_d.update(range(best[0], best[0] + best[2]))
        used_i.update(range(best[1], best[1] + best[2]))
        out.append(best)


@pytest.mark.parametrize("case", range(30))
def test_tiles_equal_a_plain_search(case):
    rng = np.random.default_rng(case)
    doc, item = rng.integers(0, 3, 40).tolist(), rng.integers(0, 3, 18).tolist()
    places = [np.array([i for i in range(len(doc) - 2) if doc[i : i + 3] == item[j : j + 3]], np.int64) for j in range(len(item) - 2)]
    assert sum(t[2] for t in decontamination.tiles(places, 3)) == sum(t[2] for t in slow_tiles(doc, item, 3))


def slow_words(text):
    return re.findall(r"[^\x00-\x20!-/:-@\[-`{-~]+", words_lower(text))


def words_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def slow_contaminated(docs, items, coverage=0.6):
    out = []
    for doc_id, text in docs:
        for item_id, item in items:
            doc, words = slow_words(text), slow_words(item)
            covered = sum(t[2] for t in slow_tiles(doc, words, min(5, len(words)))) if words else 0
            if words and covered and covered >= coverage * len(words):
                out.append((doc_id, item_id, covered))
    return out


def test_decontamination_equals_plain_tiling_with_short_and_common_items(spark):
    head = "the quick brown fox jumps over"
    items = [(i, f"{head} {prose(700 + i, 2 + i)}") for i in range(12)]
    items += [(20, "one"), (21, "One two!"), (22, "one two three"), (23, "alpha, beta; gamma delta"), (24, "five words are a seed"), (25, "..."), (26, None)]
    items += [(None, items[3][1]), (30, "la " * 12), (30, "la " * 12)]
    docs = [(i, f"{head} {prose(i, 12)} {items[i % 12][1]}") for i in range(24)]
    docs += [(100 + i, f"{prose(i, 9)} {items[i][1]} x") for i in range(12, 16)] + [(200, items[9][1]), (200, items[9][1]), (None, items[2][1])]
    docs += [(201, "la " * 40), (202, head), (203, None), (204, "five words are a"), (205, "words are a seed five"), (206, "...")]
    found = decontamination.contaminated(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    order = lambda rows: sorted(rows, key=str)
    assert order((r.doc_id, r.item_id, r.covered) for r in found.collect()) == order(slow_contaminated(docs, items))


def test_decontamination_of_equal_words_and_plan(spark):
    items = spark.createDataFrame([(1, "same " * 400), (2, prose(5, 60))], "item_id long, text string")
    docs = documents(spark, [(1, "same " * 8000), (2, "same " * 100), (3, prose(5, 60)), (3, prose(5, 60))])
    assert sorted((r.doc_id, r.item_id, r.covered) for r in decontamination.contaminated(docs, items).collect()) == [(1, 1, 400), (3, 2, 60), (3, 2, 60)]
    assert [r.doc_id for r in decontamination.without_contaminated(docs, items).collect()] == [2]


def test_least_seeds_is_a_lower_bound(spark):
    rule = decontamination.Rule()
    found = spark.range(1, 200).select("id", rule.least_seeds(F.col("id")).alias("k")).collect()
    for n, k in found:
        need = next(c for c in range(n + 1) if c >= rule.coverage * n)
        seeds = [need - t * (rule.seed - 1) for t in range(1, need // rule.seed + 1)]
        assert k == 1 if n < rule.seed else k <= min(seeds, default=1)


def test_license_scan(spark):
    mit = license_scan.TEMPLATES["mit"]
    docs = [*rows(), (500, prose(1, 70) + "\nReleased under the MIT License.\n" + prose(2, 33)), (501, "ALL RIGHTS RESERVED"), (502, prose(3, 517) + " " + mit),
            (503, near(mit.replace(",", ""), 4, 1)), (504, " ".join(mit.split(" ")[:12])), (505, "licensed under the sun"), (501, "ALL RIGHTS RESERVED")]
    found = license_scan.scanned(documents(spark, docs))
    assert sorted((r.doc_id, r.license) for r in found.collect()) == [(500, "mit-line"), (501, "reserved"), (502, "mit"), (503, "mit")]
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in found._jdf.queryExecution().executedPlan().toString()
    assert license_scan.scanned(empty(spark)).count() == 0
    assert license_scan.scanned(documents(spark), {}).count() == 0


def test_license_scan_knows_common_notices_and_their_variants(spark):
    asked = "lgpl agpl gpl isc mpl2 epl1 epl2 unlicense zlib cc0 cc-by cc-by-sa cc-by-nc".split()
    data = [(i, f"{prose(i, 9)} {license_scan.TEMPLATES[name]} {prose(i + 99, 9)}") for i, name in enumerate(asked)]
    found = license_scan.scanned(documents(spark, data)).collect()
    assert sorted((r.doc_id, r.license) for r in found) == list(enumerate(asked))


def test_run_table_keeps_frequent_runs_and_nearly_all():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 48, context_tree.HEAD_RUNS).astype(np.uint64))
    np.random.default_rng(2).shuffle(keys)
    table = context_tree.RunTable(keys, np.arange(len(keys)) * 1.0)
    at = table.places(keys)
    assert (at >= 0).mean() > 0.96
    assert (at[:1000] >= 0).all()
    assert (table.p[at[at >= 0]] == np.flatnonzero(at >= 0)).all()
    assert (table.places(keys | np.uint64(1 << 60)) == -1).all()


@pytest.mark.parametrize("flush", [1, 300, 1 << 20])
def test_counts_of_byte_runs_do_not_depend_on_flushes(monkeypatch, flush):
    monkeypatch.setattr(context_tree, "MERGE", flush)
    monkeypatch.setattr(context_tree, "FLUSH", flush)
    made = [prose(i, 60) for i in range(12)]
    given = [
        pa.RecordBatch.from_pydict({"text": [t], "held_out": pa.array([False]), "row": pa.array([i], pa.int64())}) for i, t in enumerate(made)
    ]
    found = collections.Counter()
    parts = 0
    for batch in context_tree._gather(iter(given), np.zeros(0, np.uint64)):
        for kind, key, n in zip(*(batch.column(c).to_pylist() for c in ("kind", "key", "trained")), strict=True):
            if kind == context_tree.RUN:
                found[key] += n
        parts += bool(batch.num_rows and batch.column("kind")[0].as_py() == context_tree.RUN)
    expected = collections.Counter()
    for t in made:
        raw = b"\n" * context_tree.DEPTH + t.encode() + b"\n"
        for i in range(context_tree.DEPTH, len(raw)):
            expected[sum(raw[i - k] << 8 * (context_tree.DEPTH + 1 - k) for k in range(1, context_tree.DEPTH + 1)) | raw[i]] += 1
    assert found == expected
    assert (parts > 1) == (flush < 1 << 20)


def contained(text, notices, containment=0.8):
    """Templates whose shingles lie in one window of a text to at least that share, by all windows."""
    def hashes(t):
        w = re.findall("[a-z0-9]+", (t or "").lower()) if (t or "").isascii() else None
        return [tuple(w[i : i + 3]) for i in range(len(w) - 2)]

    own, found = hashes(text), {}
    for name, notice in notices.items():
        wanted = hashes(notice)
        windows = [set(own[i : i + 2 * len(wanted)]) for i in range(0, len(own), len(wanted))]
        best = max((len(w & set(wanted)) / len(set(wanted)) for w in windows), default=0)
        if best >= containment:
            found[name] = best
    return found


def test_license_scan_equals_all_windows(spark):
    notices = {f"n{i}": prose(900 + i, 8 + 5 * i) for i in range(5)} | {"repeats": "as is as is as is without any warranty as is as is"}
    data = []
    for i in range(60):
        name = list(notices)[i % 6]
        text = " ".join([prose(i, i * 3 % 50), near(notices[name], i, i % 4) if i % 5 else notices[name], prose(i + 70, 20)])
        data.append((i, text))
    found = license_scan.scanned(documents(spark, data), notices).collect()
    expected = {(i, name): share for i, text in data for name, share in contained(text, notices).items()}
    assert {(r.doc_id, r.license): r.containment for r in found} == pytest.approx(expected)


def test_license_notice_thousands_of_times_and_texts_of_one_id(spark):
    gpl = license_scan.TEMPLATES["gpl3"] if "gpl3" in license_scan.TEMPLATES else next(iter(license_scan.TEMPLATES.values()))
    mit = license_scan.TEMPLATES["mit"]
    data = [(1, "All rights reserved. x y z " * 5000), (2, mit), (2, gpl), (2, mit), (None, mit), (None, mit + " once more")]
    found = license_scan.scanned(documents(spark, data)).collect()
    repeated = [r for r in found if r.doc_id == 1]
    assert len(repeated) == 1 and repeated[0].windows > 5000 and repeated[0].containment == 1.0
    assert sorted(r.license for r in found if r.doc_id == 2 and r.containment == 1.0)[0:1] and len({r.license for r in found if r.doc_id == 2}) >= 2
    assert sum(r.license == "mit" for r in found if r.doc_id == 2) == 1
    assert sum(r.license == "mit" for r in found if r.doc_id is None) == 2
