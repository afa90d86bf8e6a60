"""Notices worded unlike the templates: near relatives are told apart, and other text stays out."""

from __future__ import annotations

import pytest

from plumeline.llm import licences
from tests.llm.test_wrapped import model  # noqa: F401

# Line, families it may be given, whether confirmation is due.
WORDINGS = [
    ("You should have received a copy of the GNU Lesser General Public License along with this library", {"lgpl"}, True),
    ("You should have received a copy of the GNU General Public License along with this program.", {"gpl"}, True),
    ('Unless required by applicable law, software distributed under the License is distributed on an "AS IS" BASIS', {"apache"}, True),
    ("SPDX-License-Identifier: MIT", {"mit"}, True),
    ("// SPDX-License-Identifier: Apache-2.0", {"apache"}, True),
    ("Eclipse Public License - v 2.0", {"epl"}, True),
    ("Distributed under the Boost Software License, Version 1.0.", {"boost"}, True),
    ("Redistributions of source code must retain the above copyright notice, this list of conditions", {"bsd"}, True),
    ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED', {"mit"}, True),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", {"cc-by-nc", "cc-by"}, False),
]


@pytest.mark.parametrize("line, families, due", WORDINGS)
def test_family_of_a_wording(model, line, families, due):  # noqa: F811
    family, _, _, confirmed = model.judge(line)
    assert family in families and (confirmed or not due)


def test_a_nearer_relative_is_not_confirmed(model):  # noqa: F811
    # whichever family the classifier says, only the one whose template fits best can be confirmed
    for family, notices in licences.NOTICES.items():
        for notice in notices:
            shares = {f: licences._share(licences.grams(notice), f) for f in licences.NOTICES}
            assert max(shares, key=shares.get) == family
            found = model.judge(notice)
            assert found[0] == family and found[3]


def test_plain_text_speaks_of_no_licence(model):  # noqa: F811
    for line in ("the river walks under blue stone", "a driver needs a license plate", "x" * 300_000, " ".join(["river"] * 200_000), ""):
        assert model.judge(line) is None
