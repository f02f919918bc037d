"""Pages: layouts that are known beforehand, hostile pages in linear time."""

from __future__ import annotations

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewalk.llm.html_layout import extract_pages, render_page

WORD = st.sampled_from(["one", "two", "three", "fo&amp;ur", "5", "<b>six</b>", "se<i>ve</i>n"])
PHRASE = st.lists(WORD, min_size=1, max_size=4)


def shown(words: list[str]) -> str:
    plain = " ".join(words)
    for tag, text in [("<b>", ""), ("</b>", ""), ("<i>", ""), ("</i>", ""), ("&amp;", "&")]:
        plain = plain.replace(tag, text)
    return plain


@st.composite
def listing(draw, depth: int = 0):
    """(html, lines) of a list; end tags may be left out."""
    tag, number = draw(st.sampled_from(["ul", "ol"])), draw(st.integers(1, 99))
    html, lines = f"<{tag} start={number}>" if tag == "ol" else "<ul>", []
    for k in range(draw(st.integers(1, 3))):
        mark = f"{number + k}. " if tag == "ol" else "- "
        words = draw(PHRASE)
        html += "<li>" + " \n ".join(words)
        lines.append(mark + shown(words))
        if depth < 2 and draw(st.booleans()):
            inner, below = draw(listing(depth + 1))
            html += inner
            lines += [" " * len(mark) + x for x in below]
        html += draw(st.sampled_from(["", "</li>"]))
    return html + f"</{tag}>", lines


@st.composite
def sheet(draw):
    """(html, lines) of a table, laid out by filling a plain grid cell by cell."""
    columns, rows = draw(st.integers(1, 4)), draw(st.integers(1, 4))
    grid: dict[tuple[int, int], str] = {}
    html = "<table>" + draw(st.sampled_from(["", "<tbody>"]))
    for r in range(rows):
        html += "<tr>"
        for c in range(columns):
            if (r, c) in grid:
                continue
            words = draw(PHRASE)
            wide = draw(st.integers(1, 2)) if c + 1 < columns and (r, c + 1) not in grid else 1
            tall = draw(st.integers(1, 2)) if r + 1 < rows else 1
            for i in range(tall):
                for j in range(wide):
                    grid[r + i, c + j] = shown(words) if i == j == 0 else ""
            html += f"<{draw(st.sampled_from(['td', 'th']))} colspan='{wide}' rowspan={tall}>" + " ".join(words)
        html += draw(st.sampled_from(["", "</tr>"]))
    begun = [c for c in range(columns) if any(grid.get((r, c)) for r in range(rows))]
    width = {c: max(len(grid.get((r, c), "")) for r in range(rows)) for c in begun}
    lines = ["  ".join(grid.get((r, c), "").ljust(width[c]) for c in begun).rstrip() for r in range(rows)]
    return html + "</table>", [x for x in lines if x]


@st.composite
def block(draw):
    """(html, lines, blank line around it)."""
    kind = draw(st.sampled_from(["p", "h2", "div", "list", "table", "hidden", "script", "pre"]))
    if kind == "list":
        return *draw(listing()), True
    if kind == "table":
        return *draw(sheet()), True
    words = draw(PHRASE)
    if kind == "hidden":
        return draw(st.sampled_from(["<div hidden>{}</div>", "<p style='color:red; display:none'>{}</p>", "<!-- {} -->", "<template>{}</template>", "<div><input type=hidden value=x></div>"])).format(" ".join(words)), [], False
    if kind == "script":
        return f"<script>if (a < b) x = '<p>{words[0]}'</script>", [], False
    if kind == "pre":
        return "<pre>a  b\n   c</pre>", ["a  b", "   c"], True
    end = draw(st.sampled_from(["", "</p>"])) if kind == "p" else f"</{kind}>"
    return f"<{kind} class=\"a > b\" data-x='<p>'>" + "\n\t".join(words) + end, [shown(words)], kind != "div"


@given(st.lists(block(), max_size=6))
@settings(max_examples=400, deadline=None)
def test_layouts_known_beforehand(blocks):
    html = "<!doctype html><head><title>no</title><body>" + "\n".join(h for h, _, _ in blocks)
    want, gap = [], False
    for _, lines, spaced in blocks:
        if lines:
            want += [""] * bool(want and (gap or spaced)) + lines
            gap = spaced
    assert render_page(html)[0] == "\n".join(want)


@pytest.mark.parametrize("part", ["<a b ", "<a b='", "<a b=\"x' ", "<", "</", "<!--", "<!", "<p>x</b>", "<td>x", "<li>", "</p>", "&", "&amp", "<tr><td rowspan=9>x"])
def test_hostile_pages_take_time_in_proportion(part):
    began = time.perf_counter()
    render_page(part * (10_000 if part == "<li>" else 200_000 // len(part)))
    assert time.perf_counter() - began < 30


def test_tags_as_browsers_read_them():
    assert render_page("a<p title='1 > 0'>b")[0] == "a\n\nb"
    assert render_page("a <a href=x/>b</a>")[0] == "a b"
    assert render_page("x < y, x<3 and <3")[0] == "x < y, x<3 and <3"
    assert render_page("a</ junk>b</>c<?php d ?>e<!x>f<![CDATA[g]]>h<!-->i<!-- j --!>k")[0] == "abcefhik"
    assert render_page("shown<p unfinished")[0] == "shown"
    assert render_page("<div =x hidden>no</div>yes")[0] == "yes"


def test_wide_spans_and_tables():
    assert render_page("<table><tr><td colspan=1000>a<td>b<tr><td>c<td>d</table>")[0] == "a     b\nc  d"
    cells = "".join(f"<td>{'x' * 30}" for _ in range(100))
    lines = render_page(f"<table><tr>{cells}<tr><td colspan=99>y<td>z</table>")[0].split("\n")
    assert lines[1] == "y  z"
    long = "w " * 300
    assert render_page(f"<table><tr><td>{long}<td>b<tr><td>c<td>d</table>")[0] == f"{long.strip()}  b\nc  d"


def test_pages_at_the_edges(spark):
    odd = spark.createDataFrame([(1, None, 1), (1, "<p>x", 2), (None, "<p>x", 3), (2, "<p>" + "word " * 400_000, 4)], "page_id long, html string, n_chars int")
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in extract_pages(odd).collect()) == [(0, 1), (1, 0), (1, 1), (2, 1_999_999)]
    assert extract_pages(odd.limit(0)).collect() == []
