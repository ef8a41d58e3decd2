"""Layout of pages."""

import pytest
from pyspark.sql import functions as F

from strata.llm import queries
from strata.llm.html import DEPTH, extract_text, visible_text

CASES = {
    "null and empty": (None, ""),
    "plain": ("a  b\n c", "a b c"),
    "paragraphs end where the next begins": ("<p>a<p>b<div>c</div>d", "a\n\nb\n\nc\nd"),
    "blocks without margin": ("<div>a</div><div>b<section>c</section></div>", "a\nb\nc"),
    "inline elements join": ("a<b>b</b> <i>c</i><span>d</span>", "ab cd"),
    "misnested inline": ("<b>a<i>b</b>c</i>", "abc"),
    "stray ends": ("a</span></table></p>b", "a\n\nb"),
    "line breaks": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "entities": ("a&amp;b &lt;i&gt; &eacute;&#233;&nbsp;x &unknown;", "a&b <i> éé x &unknown;"),
    "lists": ("<ul><li>a<li>b<ol start=3><li>c<li value=9>d</ol><li>e</ul>", "- a\n- b\n  3. c\n  9. d\n- e"),
    "reversed list": ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"),
    "list in list item": ("<ul><li><ul><li>x</ul></ul>", "- - x"),
    "empty item": ("<ul><li><li>x</ul>", "- x"),
    "definitions": ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n    d\nu\n    e"),
    "quote": ("a<blockquote>b<p>c</blockquote>d", "a\n\n> b\n>\n> c\n\nd"),
    "preformatted": ("<pre>\n a\n  b\n\nc</pre>d  e", " a\n  b\n\nc\n\nd e"),
    "table": (
        "<table><tr><th>Name<th>N<tr><td>Apple<td>10<tr><td>Fig<td>7</table>",
        "Name  | N\nApple | 10\nFig   | 7",
    ),
    "table with spans": (
        "<table><tr><td rowspan=2>a<td>bb<td>c<tr><td colspan=2>wide one</table>",
        "a | bb | c\n  | wide one",
    ),
    "cells of several lines": ("<table><tr><td>a<br>b<td>c<tr><td>d<td>e</table>", "a | c\nb |\nd | e"),
    "table in table": ("<table><tr><td>x<td><table><tr><td>1<td>2</table></table>", "x | 1 | 2"),
    "caption and loose text": ("<table>loose<caption>Cap</caption><tr><td>x</table>", "loose\nCap\nx"),
    "unseen elements": ("<head><title>t</title></head><script>if(a</b)</script><style>p</style>x<template>y</template>", "x"),
    "script end in a string": ("<script>var t='</p>';</script>x", "x"),
    "hidden by attribute or style": ("<p hidden>a</p><p style='color:red; DISPLAY : none'>b</p><p>c", "c"),
    "hidden rows and cells": ("<table><tr hidden><td>a<tr><td style='display:none'>b<td>c</table>", "c"),
    "hidden body": ("<body hidden>x", ""),
    "closed and open details": ("<details><summary>s</summary>x</details><details open><summary>t</summary>y</details>", "s\n\nt\ny"),
    "comments and doctype": ("<!DOCTYPE html><!-- <p>a --><?php x ?>b<!-->c", "bc"),
    "unclosed comment": ("a<!-- b", "a"),
    "lone signs": ("1 < 2 & 3 > 2 <", "1 < 2 & 3 > 2 <"),
    "attribute with a sign": ("<a title='x>y'>z</a>", "z"),
    "text area": ("<textarea>\n a  b</textarea>", " a  b"),
    "buttons and inputs": ("<input type=submit value=Go><input type=hidden value=h><button>B</button>", "Go B"),
    "missing body and head": ("<title>t</title><p>x", "x"),
}


@pytest.mark.parametrize("name", CASES)
def test_layout(name):
    html, want = CASES[name]
    assert visible_text(html) == want


def test_deep_and_long_pages():
    assert visible_text("<div>" * (5 * DEPTH) + "x") == "x"
    assert visible_text("<table><tr><td>" * DEPTH + "x") == "x"
    long = visible_text("<p>word</p>" * 20_000)
    assert long.count("word") == 20_000
    assert visible_text("<" * 50_000).count("<") == 50_000


@pytest.mark.parametrize("deep", ["<div>", "<span>", "<b><i>"])
def test_elements_count_at_any_depth(deep):
    deep = deep * (2 * DEPTH)
    assert visible_text(f"{deep}a<div hidden>b</div><template>c</template><details>d</details>") == "a"
    assert visible_text(f"{deep}<table><tr><td>a<td>b</table>") == "a | b"
    assert visible_text(f"{deep}<ul><li>a<li>b</ul>") == "- a\n- b"
    inside = "<div>" * (2 * DEPTH) + "a" + "</div>" * (2 * DEPTH)
    assert visible_text(f"<div hidden>{inside}b</div>c") == "c"
    assert visible_text("<div>" * 20_000 + "x") == "x"


def test_formulas_and_labels_are_text():
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mspace/><mn>2</mn></mrow><annotation>x=2 TeX</annotation></semantics></math>"
    assert visible_text(f"so {formula} holds") == "so x=2 holds"
    drawing = "<svg><title>t</title><defs><text>no</text></defs><clipPath/><path d='M0'/><text>A<tspan>1</tspan></text><g><text>B</text></g></svg>"
    assert visible_text(f"see {drawing}there") == "see A1 B there"
    assert visible_text("<svg><g><p>a<p>b") == "a\n\nb"


def test_extract_on_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "<p>a<p>b"), (3, "<p>a<p>b"), (None, "x")]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("own")).withColumn("id", F.lit(0))
    got = sorted(map(repr, (tuple(r) for r in extract_text(df).collect())))
    assert got == sorted(map(repr, [(1, "", 0, 0), (2, "", 0, 0), (3, "a\n\nb", 4, 3), (3, "a\n\nb", 4, 3), (None, "x", 1, 1)]))
    assert extract_text(df.limit(0)).count() == 0


def test_op3_query(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.QUERIES["op3_html_text"](spark, sf).collect()
    assert {r["page_id"] for r in rows} == pages.keys()
    for r in rows:
        assert r["text"] == visible_text(pages[r["page_id"]])
        assert "track(" not in r["text"] and "<p>" not in r["text"] and "margin:0" not in r["text"]
        assert "&copy;" not in r["text"] and "©" in r["text"]
