"""Pages that are broken, deep or full of odd numbers, and cells that span rows."""

import pytest

from curvemill.llm.html_text import page_text


@pytest.mark.parametrize("piece", ["<ul><li>", "<table><tr><td>", "<ol><li><table><tr><td>", "<div>", "<q>"])
def test_no_nesting_is_too_deep(piece):
    text = page_text(f"{piece * 1500}deep{'</b>' * 10}")
    assert "deep" in text
    assert page_text(f"before {piece * 1500}").strip(' "-1.').startswith("before")


@pytest.mark.parametrize("number", ["²", "--5", "9" * 5000, "", "x", "-", "+3x", " 7", "0", "-4", "1e9", "٣"])
def test_odd_numbers_in_attributes(number):
    cells = f"<table><tr><td colspan='{number}' rowspan='{number}'>a<td>b<tr><td>c</table>"
    lists = f"<ol start='{number}'><li>d<li value='{number}'>e</ol>"
    text = page_text(cells + lists)
    assert all(x in text for x in "abcde")


def test_numbers_are_read_as_browsers_do():
    assert page_text("<ol start=' +3x'><li>a<li value='7'>b<li>c</ol>") == "3. a\n7. b\n8. c"
    assert page_text("<ol start=-1><li>a<li>b</ol>") == "-1. a\n0. b"


@pytest.mark.parametrize("section", ["<![foo[ x ]]>", "<![CDATA[ x ]]>", "<![if IE]>", "<![", "<![endif]", "<!", "<!-", "<?p"])
def test_marked_sections(section):
    assert page_text(f"a{section}").startswith("a")
    assert page_text(f"<p>a</p>{section}<p>b</p>").startswith("a")


def test_character_data_of_drawings_is_text():
    assert page_text("<svg><text><![CDATA[a < b]]></text></svg> c") == "a < b c"
    assert page_text("a<![CDATA[ x ]]>b") == "ab"


def test_cells_that_span_rows_keep_the_columns_below():
    rows = "<tr><td rowspan=2>A<td>b<td>x<tr><td>c<td>y<tr><td>d<td>e<td>z"
    assert page_text(f"<table>{rows}</table>") == "A  b  x\n   c  y\nd  e  z"
    assert page_text("<table><tr><td>a<td rowspan=0>long<td>b<tr><td>c<td>d</table>") == "a  long  b\nc        d"
    wide = page_text("<table><tr><td colspan=2 rowspan=2>wide<td>b<tr><td>c<tr><td>d<td>e<td>f</table>").split("\n")
    assert wide[0].index("b") == wide[1].index("c") == wide[2].index("f")
