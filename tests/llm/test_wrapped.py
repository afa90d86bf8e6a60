"""Licence notices wrapped over lines."""

from __future__ import annotations

import textwrap

import numpy as np
import pytest

from plumeline.llm import licences

LGPL = """/* This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
 */"""


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(7)
    return licences.train([" ".join(rng.choice("the of and river stone walks under blue license plate terms".split(), 14)) for _ in range(300)])


def test_published_header(model):
    rows = licences.paragraphs(model, "Some file\n\n" + LGPL + "\n\ncode follows")
    assert [(r[0], r[1], r[4]) for r in rows if r[4]] == [(2, "lgpl", True)]
    assert rows[0][5] == "\n".join(LGPL.split("\n")[:3])


@pytest.mark.parametrize("mark", ["", "# ", " * "])
@pytest.mark.parametrize("width", [40, 60, 75])
def test_wrapped_notices_are_one_paragraph(model, mark, width):
    for family, notices in licences.NOTICES.items():
        for notice in notices:
            lines = [mark + line for line in textwrap.wrap(notice, width)]
            rows = licences.paragraphs(model, "\n".join(["river stone", "", *lines, "", "blue stone"]))
            assert [(r[0], r[1], r[4]) for r in rows] == [(2, family, True)], notice


def test_one_line_notices_stay_lines(model):
    lines = ["Released under the MIT license", "Released under the MIT license", "Licensed under CC BY-NC 4.0", "released under the bsd 3-clause license"]
    rows = licences.paragraphs(model, "\n".join(lines))
    assert rows == [(k, *model.judge(line), line) for k, line in enumerate(lines)]


def test_a_notice_that_shares_a_line_is_found(model):
    text = "Licensed under CC BY-NC 4.0. This program is free software; you can\nredistribute it and/or modify it under the terms of the GNU General Public License"
    assert {(r[0], r[1]) for r in licences.paragraphs(model, text) if r[4]} >= {(0, "gpl")}
