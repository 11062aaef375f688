"""Blocks of odd pages, the field against sums over all sequences, and held-out pages."""

import itertools
import math
import os
import random

import pytest

from tributary.llm import html_blocks, html_crf

KINDS = "page_id long, url string, html string, text string, n_chars int"
SF = "/root/testdata/sf0.01"


def texts(page):
    return [b.text for b in html_blocks.blocks(page)]


@pytest.mark.parametrize(
    "page, want",
    [
        (None, []), ("", []), ("just <b>text</b> here", ["just text here"]), ("a < b & c", ["a < b & c"]),
        ("<p>one<p>two</p>three", ["one", "two", "three"]), ("<p><b>one<br><p>two", ["one", "two"]),
        ("<p>a&nbsp;b\n\t c&amp;d &lt;p&gt; &#233;&eacute</p>", ["a b c&d <p> éé"]),
        ("<script>if (a<b) '</p>'</script>x<style>p{}</style>y<!-- <p>no --> z", ["x y z"]),
        ("<title>no</title><p>yes<script>var t='</p>'", ["yes"]), ("<!-- open <p>no", []), ("x<!doctype html>y</nothing>z", ["xyz"]),
        ('<div title="a>b" class=\'x>y\'>in</div>out', ["in", "out"]), ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ("a<br>b<img src=x>c", ["a b c"]), ("<p>a<a href=x>b", ["ab"]),
        ("<head><p>no</p><title>no</title></head><body>yes", ["yes"]), ("<textarea>no</textarea><select><option>no</select>ok", ["ok"]),
        ("<div>" * 3000 + "deep", ["deep"]), ("<p 'odd>text</p>", ["text"]), ("x" * 200_000, ["x" * 200_000]),
    ],
)
def test_blocks(page, want):
    assert texts(page) == want


def test_marks_of_ancestors():
    (b,) = html_blocks.blocks("<div class='Site-Nav 7' id=top><a href=x>Home</a></div>")
    assert {"in:div", "is:site", "is:nav", "is:top", "in:a"} <= set(b.around) and b.linked == 4 and b.tag == "div"
    (b,) = html_blocks.blocks("<nav><p>x</nav>")[:1]
    assert "in:nav" in b.around
    assert "in:nav" not in html_blocks.blocks("<nav><p>x</nav><p>y")[1].around


def test_decoding_and_gradient_against_all_sequences():
    rng = random.Random(2)
    field = html_crf.Field()
    names = list("abcdef")
    field.weights = {f: rng.uniform(-2, 2) for f in names}
    field.steps = [[rng.uniform(-1, 1) for _ in range(2)] for _ in range(2)]

    def score(page, y):
        e = [sum(field.weights[f] for f in own) for own in page]
        return sum(x for x, s in zip(e, y, strict=True) if s) + sum(field.steps[a][b] for a, b in zip(y, y[1:], strict=False))

    for _ in range(60):
        page = [rng.sample(names, rng.randint(0, 4)) for _ in range(rng.randint(1, 7))]
        best = max(itertools.product((0, 1), repeat=len(page)), key=lambda y: score(page, y))
        assert math.isclose(score(page, field.decode(page)), score(page, best), abs_tol=1e-9)
    assert field.decode([]) == []

    page, y = [["a", "b"], ["c"], ["a"]], [1, 0, 1]

    def likelihood():
        return score(page, y) - math.log(sum(math.exp(score(page, z)) for z in itertools.product((0, 1), repeat=3)))

    before, start = likelihood(), dict(field.weights)
    slope = {}
    for f in "abc":
        field.weights[f] += 1e-6
        slope[f] = (likelihood() - before) / 1e-6
        field.weights[f] = start[f]
    field._step(page, y, 1e-2)
    for f in "abc":
        assert math.isclose(field.weights[f] - start[f], 1e-2 / math.sqrt(3) / 4 * slope[f], rel_tol=0.05, abs_tol=1e-6)


@pytest.fixture(scope="module")
def field():
    return html_crf.Field().train([(html_crf.features(b), y) for b, y in html_crf.made_pages(html_crf.GENERATED, html_crf.SEED)])


def test_held_out_pages(field):
    right = wrong = missed = 0
    for b, y in html_crf.made_pages(250, 77):
        for got, want in zip(field.decode(html_crf.features(b)), y, strict=True):
            right, wrong, missed = right + (got and want), wrong + (got and not want), missed + (want and not got)
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.97


def test_extraction_over_tables(spark, field):
    page = "<html><nav><ul><li><a href=x>Home</a></ul></nav><article><h1>A title here</h1><p>Some longer text, in a paragraph.</article><footer>&copy; us</footer>"
    rows = [(1, "u", page, "t", 1), (1, "u", page, "t", 1), (2, None, None, None, None), (None, "v", "", "t", 1)]
    got = html_crf.extracted(spark.createDataFrame(rows, KINDS).repartition(2), field).collect()
    text = "A title here\nSome longer text, in a paragraph."
    want = [(1, "u", text, len(text)), (1, "u", text, len(text)), (2, None, "", 0), (None, "v", "", 0)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert html_crf.extracted(spark.createDataFrame([], KINDS)).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")
def test_marked_pages_of_the_table(spark, field):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html_crf.extracted(pages).collect()}
    same = 0
    for r in pages.collect():
        found, labels = html_crf.marked_page(r.html)
        same += got[r.page_id] == "\n".join(b.text for b, y in zip(found, labels, strict=True) if y)
    assert same >= 0.98 * len(got)


@pytest.mark.parametrize(
    "page, want",
    [
        ('<article><p>one <svg class="i"/> two</p><p>three</p></article>', ["one two", "three"]),
        ("<article><p>one <svg> no</p><p>two</p></article>three", ["one", "two", "three"]),
        ("<p>one <object data=x> no</p><p>two", ["one", "two"]), ("<p>one <select><option>no</p><p>two", ["one", "two"]),
        ("<div>one <template> no<div>two</div></div>", ["one", "two"]),
        ("<p>a<template><p>no</p></template>b<svg><title>no</title><text>no</text></svg>c</p>", ["a b c"]),
        ("<p>a<object><object>no</object>no</object>b", ["a b"]), ("<p>a<object data=x />b</p>", ["a b"]),
        ("<head><title>no</title><p>one</p><p>two", ["one", "two"]), ("<head><title>no</title>one<p>two", ["one", "two"]),
        ("<head><meta x></head>one", ["one"]),
    ],
)
def test_no_text_is_lost_to_elements_without_an_end(page, want):
    assert texts(page) == want


def test_all_words_of_an_attribute_count():
    (b,) = html_blocks.blocks("<div class='col-md-4 d-none d-lg-block px-3 py-2 comments'>x</div>")
    assert "is:comments" in b.around
