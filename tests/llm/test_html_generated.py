"""Rendered pages against a plain walk of generated trees, and the pages that a scanner may stumble on."""

import random
import time

import pytest

pytest.importorskip("strandline.llm")

from strandline.llm.html_text import render

INLINE, BLOCKS = ("span", "b", "em", "a"), ("div", "p", "section", "h2", "blockquote")
HIDES = ("hidden", "style='display: none'", 'style="visibility:hidden"', "class='gone x'", "id=secret", 'aria-hidden="true"')


def tree(rng, depth, words, inline=False):
    """HTML of some elements, and the words in it that are visible, in order."""
    html, shown = [], []
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if kind < 0.4 or depth == 0:
            word = f"w{next(words)}"
            html.append(f" {word} ")
            shown.append(word)
            continue
        tag = rng.choice(INLINE if inline or kind < 0.6 else BLOCKS)
        inner, seen = tree(rng, depth - 1, words, inline or tag in INLINE or tag in ("p", "h2"))
        hide = rng.choice(HIDES) if rng.random() < 0.25 else ""
        html.append(f"<{tag} {hide} title='a > b'>{inner}</{tag}>")
        shown += [] if hide else seen
    return "".join(html), shown


def test_visible_words_of_generated_pages():
    for seed in range(300):
        rng, count = random.Random(seed), iter(range(10**6))
        html, shown = tree(rng, 5, count)
        style = "<style>/* .w */ .gone { display:none } p#none{display:none} #secret, i.never { visibility: hidden; } @media print { div { display:none } }</style>"
        _, text, _ = render(f"<!doctype html><head>{style}<body>{html}")
        assert [w for w in text.split() if w != ">"] == shown, seed  # quotations begin their lines with a sign


def covered(rows):
    """Column of each cell, by a grid of all places."""
    taken, out = set(), []
    for r, row in enumerate(rows):
        at = 0
        for name, across, down in row:
            while (r, at) in taken:
                at += 1
            out.append((r, at, name))
            taken |= {(r + i, at + k) for i in range(down) for k in range(across)}
            at += across
    return out


def test_cells_stand_below_each_other_in_generated_tables():
    for seed in range(200):
        rng = random.Random(seed)
        rows = [[(f"c{r}x{k}" + "y" * rng.randint(0, 6), rng.choice((1, 1, 1, 2, 3)), rng.choice((1, 1, 1, 2, 3))) for k in range(rng.randint(1, 4))] for r in range(rng.randint(1, 5))]
        cell = lambda c: f"<td colspan={c[1]} rowspan='{c[2]}'>{c[0]}"
        _, text, _ = render("<table>" + "".join("<tr>" + "".join(map(cell, row)) for row in rows) + "</table>")
        begins = {}
        for (_, at, name), line in ((x, next(y for y in text.split("\n") if x[2] in y.split())) for x in covered(rows)):
            begins.setdefault(at, set()).add(f" {line} ".index(f" {name} "))
        assert all(len(x) == 1 for x in begins.values()), (seed, text)
        assert [min(begins[k]) for k in sorted(begins)] == sorted(min(x) for x in begins.values()), seed


@pytest.mark.parametrize("page", ['<a ' + '""' * 10_000, "<a " + '="' * 10_000 + ">", "<a " * 100_000, "<" * 100_000, "<!--" * 50_000, "<div hidden>" * 20_000, "<ul>" + "<span>" * 3000 + "<li>x" * 3000, "a<b='" * 20_000])
def test_broken_pages_take_no_longer_than_they_are(page):
    began = time.process_time()
    render(page)
    assert time.process_time() - began < 2


def test_parts_made_visible_again_rows_spanned_and_depth():
    assert render('<div style="visibility:hidden">a<span style="visibility:visible">b</span></div>c')[1] == "b\nc"
    assert render("<table><tr><td rowspan=2>Aaaaaa<td>B<td>X<tr><td>C<td>Y</table>")[1] == "Aaaaaa  B  X\n        C  Y"
    assert render("<textarea>ta</textarea><button>go")[1] == "ta go"
    assert render("<div>" * 250 + "<span style='display:none'>SECRET</span>shown")[1] == "shown"
    assert render("x < y and <b unclosed") == ("", "x < y and", 1)
