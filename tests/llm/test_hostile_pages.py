"""Unclosed tags and quotes, deep nesting, and links that only look like links."""

from __future__ import annotations

import time

import pytest

from plumeline.llm.html_text import render
from plumeline.llm.url_rules import links_of


@pytest.mark.parametrize(
    "unit",
    ["<a \"", "<a '", "<a \"<b '", "<a ", "</a ", "<!x ", "<!--", "<script></script ", "<textarea ", "<div>", "<div></p>", "<li><b>", "<a b=\"c' ", "< ", "&lt"],
)
def test_a_megabyte_takes_seconds(unit):
    page = unit * (1_000_000 // len(unit))
    began = time.time()
    render(page)
    links_of(page, "http://a.org/")
    assert time.time() - began < 15


def test_unclosed_tags_are_text():
    assert render('a <b "x> c') == 'a <b "x> c'
    assert render("a </b") == "a </b"
    assert render("1 < 2 <3") == "1 < 2 <3"


@pytest.mark.parametrize("hide", ["hidden", 'style="display:none"', 'style="visibility:hidden"'])
def test_hidden_text_below_the_depth_limit(hide):
    page = "<div>" * 300 + f"shown<p {hide}>SECRET<b>SECRET</b></p>after" + "</div>" * 300 + "end"
    text = render(page)
    assert "SECRET" not in text and "shown" in text and "after" in text and text.endswith("end")


def test_text_of_pictures_and_formulas():
    assert render("a<svg><title>no</title><text>chart label</text></svg> b") == "achart label b"
    assert "x" in render("<math><mi>x</mi><annotation>no</annotation></math>") and "no" not in render("<math><annotation>no</annotation></math>")


def test_line_break_behind_pre_and_shut_details():
    assert render("<pre>\nx\n y</pre>") == "x\n y"
    assert render("<details><summary>More</summary>body</details>") == "More"
    assert render("<details open><summary>More</summary>body</details>") == "More\nbody"


def test_only_links_of_the_head_count():
    url = "http://a.org/dir/page"
    link = '<link rel=canonical href="http://b.org/x">'
    assert links_of(f"<html><head>{link}</head><body>", url) == links_of(f"<title>t</title>{link}<p>", url) == ["http://b.org/x"]
    for page in (f"<p title='{link}'>", f"<textarea>{link}</textarea>", f"<body><div>{link}</div>", f"<!-- {link} -->", f"<script>{link}</script>"):
        assert links_of(page, url) == []
    based = '<head><base href="/other/"><base href="/no/"><link rel=canonical href=p><meta http-equiv=refresh content="0; url=q">'
    assert links_of(based, url) == ["http://a.org/other/p", "http://a.org/other/q"]
