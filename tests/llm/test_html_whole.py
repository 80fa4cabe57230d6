"""All visible text of odd pages comes out."""

import pytest

from strandline.llm import html_text


@pytest.mark.parametrize("page, want", [
    ("<table><tr><form><td>a</td></form></tr></table>", "a"),
    ("<table><form><tr><td>a</td><td>b</td></tr></form></table>c", "a  b\n\nc"),
    ("<table><tr>text<td>x</td></tr></table>", "text\n\nx"),
    ("<table><tbody><p>text</p><tr><td>x</td></tr></tbody></table>", "text\n\nx"),
    ("<table><tr><b><td>x</td></b><td>y</td></tr></table>", "x  y"),
    ("<table><tr><td><table>in<tr><td>x</table><td>y</table>", "in  y\n\nx"),
    ("<p>a<select><option>one<option label=two>no<optgroup label=more><option selected>three</select>b", "a\none\ntwo\nmore\nthree\nb"),
    ("<svg><title>no</title><defs/><circle/><g><text>label</text><desc>no</desc></g></svg> z", "label z"),
    ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math>", "x = 2"),
    ("<div>" * 250 + "<div hidden>no<div>no</div></div><b>yes</b>" + "</div>" * 250 + "<p>end", "yes\n\nend"),
    ("<em>" * 250 + "in<table><tr><td>a<td>b</table>" + "</em>" * 250 + " end", "in\n\na  b\n\nend"),
])
def test_visible_text(page, want):
    assert html_text.render(page)[1] == want
