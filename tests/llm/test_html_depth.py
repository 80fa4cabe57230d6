"""HTML extraction on pages that are deep, wide, or full of rules: nothing raises, hangs, or shows what is hidden."""

import time

import pytest

from strandline.llm.html_text import LEVELS, Styles, render


def text(page):
    return render(page)[1]


@pytest.mark.parametrize("across", [2, 3, 4, 1000])
def test_cells_shorter_than_their_span(across):
    assert text(f"<table><tr><td colspan={across}>a<td colspan={across}>b</table>") == "a  b"
    assert text(f"<table><tr><td colspan={across}>a<td>b<tr><td colspan={across}>long<td>c</table>") == "a     b\nlong  c"
    assert text(f"<table><tr><td rowspan={across}>x<td colspan={across}>a<td>b<tr><td>c</table>") == "x  a    b\n   c"


def test_columns_within_a_span_stay_aligned():
    assert text("<table><tr><td colspan=2>ab<td>z<tr><td>longer<td>y<td>w</table>") == "ab         z\nlonger  y  w"
    assert text("<table><tr><td colspan=2>a wide heading<td>z<tr><td>p<td>q<td>w</table>") == "a wide heading  z\np  q            w"


@pytest.mark.parametrize("depth", [250, 5000, 50000])
def test_hidden_stays_hidden_at_any_depth(depth):
    deep = "<div>" * depth
    assert text(f"{deep}<span style='visibility:hidden'>SECRET</span>shown") == "shown"
    assert text(f"<style>.g{{display:none}} #h{{visibility:hidden}}</style>{deep}<p class=g>SECRET</p><b id=h>SECRET</b>shown") == "shown"
    assert text(f"<div style='visibility:hidden'>{deep}SECRET<b style='visibility:visible'>shown") == "shown"


@pytest.mark.parametrize("depth", [250, 5000])
def test_lists_and_tables_keep_their_marks_at_any_depth(depth):
    got = text("<div>" * depth + "<ol><li>one<li>two<ul><li>three</ul></ol><table><tr><td>a<td>bb<tr><td>ccc<td>d</table>")
    assert got == "1. one\n2. two\n   - three\n\na    bb\nccc  d"
    got = text("<ul><li>x" * depth)
    assert [x.strip() for x in got.split("\n") if x.strip()] == ["- x"] * depth and max(map(len, got.split("\n"))) <= 2 * LEVELS + 3
    got = text("<table><tr><td>x<td>y" * depth)
    assert got.split().count("x") == depth == got.split().count("y")
    assert text("<blockquote>x" * depth).split().count("x") == depth


@pytest.mark.parametrize(
    "page",
    [
        "<style>" + "x" * 1_000_000 + "</style>a", "<style>" + "a b; " * 200_000 + "</style>a", "<style>" + "{" * 500_000 + "</style>a", "<style>" + "div{display:block}" * 50_000 + "</style>" + "<div>a</div>" * 2000,
        "<style>" + "".join(f"div.c{i}{{display:none}}" for i in range(20_000)) + "</style>" + "<div class=k>a</div>" * 2000, "<style>@media " + "(" * 300_000 + "</style>a",
        "<p><button>" + "<div>" * 60_000 + "a", "<table>" + "<b>x<td>a" * 40_000, "<table><tr>" + "<td colspan=1000 rowspan=0>" * 3000 + "<tr><td>a" * 3000, "<p>" + "<b>" * 60_000 + "</i>" * 60_000 + "a",
        "<table><tr><td>" + "w" * 200_000 + "<td>a" + "<tr><td>b<td>c" * 5000, "<svg><g>" * 50_000 + "<text>a", "<table><tr><td>" * 20_000 + "a",
    ],
)
def test_large_pages_end_soon(page):
    began = time.process_time()
    assert "a" in text(page)
    assert time.process_time() - began < 6


def test_a_million_bytes_of_style_are_read_in_under_a_second():
    began = time.process_time()
    Styles(["x" * 1_000_000, "div{color:red}" * 70_000])
    assert time.process_time() - began < 2


def test_rules_for_a_screen_count():
    def shown(rules):
        return text(f"<style>{rules}</style><p class=a>x</p>y") != "y"

    hide = ".a{display:none}"
    assert not any(shown(f"@media {m}{{{hide}}}") for m in ("screen", "all", "only screen", "screen, print", "screen and (min-width: 600px)", "(max-width:100em)", "print, screen"))
    assert all(shown(f"@media {m}{{{hide}}}") for m in ("print", "not screen", "(max-width: 600px)", "screen and (min-width: 4000px)", "(prefers-color-scheme: dark)", "speech"))
    assert not shown(f"@layer base{{{hide}}}") and not shown(f"@supports (display: grid){{{hide}}}") and not shown(f"@media screen{{@media (min-width:1px){{{hide}}}}}")
    assert shown(f"@supports not (display: grid){{{hide}}}") and shown(f"@media print{{@media screen{{{hide}}}}}") and shown("@keyframes k{from{display:none}}") and shown(f".b{{{hide}}}")
    assert shown(f"{hide}.a{{display:block}}") and not shown(f".a{{display:block}}{hide}") and not shown("p.a{display:none}.a{display:block}") and shown(f"{hide}@media print{{}}p.a{{display:block}}")
