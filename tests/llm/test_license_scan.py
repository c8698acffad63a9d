import random
import re

import pytest

from quarry.llm.license_scan import Automaton, ascii_lower, scan_licenses, template_regex
from quarry.llm.license_templates import PHRASES, TEMPLATES
from quarry.llm.oracle import _pattern

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def run(spark, texts, **how):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, labels string")
    return [r.asDict(recursive=True) for r in scan_licenses(docs, **how).orderBy("doc_id").collect()]


def fill(markup, rnd):
    """A text that fits the template: optional parts at random, replaceable regions filled."""
    out = re.sub(r"\{\{(\d+),(\d+)\}\}", lambda m: " ".join(f"name{i}" for i in range(rnd.randint(int(m[1]), int(m[2])))), markup)
    while "[[" in out:
        out = re.sub(r"\[\[((?:(?!\[\[|\]\]).)*)\]\]", lambda m: m[1] if rnd.random() < 0.5 else "", out)
    return out


def test_automata_accept_what_the_regular_expression_accepts():
    rnd = random.Random(2)
    for markup in (*TEMPLATES.values(), "a [[b]] {{0,2}} c", "[[a]] b [[c [[d]]]]", "a {{1,3}} [[b]]"):
        automaton, pattern = Automaton(markup), re.compile(template_regex(markup))
        for _ in range(30):
            words = WORD.findall(ascii_lower(fill(markup, rnd)))
            for _ in range(rnd.randrange(3)):
                words[rnd.randrange(len(words))] = rnd.choice(["a", "b", "c", "d", "odd"])
            words += rnd.choices(["a", "b", "c", "tail"], k=rnd.randrange(3))
            ends = [i for i in range(len(words) + 1) if pattern.fullmatch("".join(w + " " for w in words[:i]))]
            assert automaton.accept(words, 0) == (max(ends) if ends and max(ends) > 0 else -1)


@pytest.mark.parametrize("markup", ["", "{{1,2}} a", "[[a]]", "a ]]", "[[ a", "{{3,1}} a"])
def test_bad_templates(markup):
    with pytest.raises(ValueError):
        Automaton(markup)


def test_every_template_is_found_and_one_changed_mandatory_word_is_not(spark):
    rnd = random.Random(4)
    for label, markup in TEMPLATES.items():
        text = fill(markup, rnd)
        wrong = re.sub(r"\blicense\b|\bnotice\b|\bnc\b|\bsoftware\b", "lemon", text)
        got = run(spark, [f"Intro: {text.upper()}. More.", wrong], templates={label: markup})
        assert label in got[0]["labels"].split(",") and got[0]["score"] == 1.0 and got[0]["spans"][0]["first"] == 1
        assert label not in got[1]["labels"].split(",")


def test_base_columns_against_brute_force(spark):
    texts = [None, "", "The MIT License and the mit-license, then Apache\nLicense v2", "general public\tLICENSE general public license", "mit apache license", "MİT License",
             "no such thing", "mit license " * 3000, "Released under the MIT License. Licensed under the Apache License, Version 2.0.", "é" * 50_000]
    for text, got in zip(texts, run(spark, texts), strict=True):
        words = WORD.findall(ascii_lower(text or ""))
        places = [(i, label) for i in range(len(words)) for p, label in PHRASES.items() if words[i:i + len(p.split())] == p.split()]
        assert got["n_words"] == len(words) and got["n_base"] == len(places)
        assert got["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert (got["first_word"], got["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert set(got["base_labels"].split(",")) <= set(got["labels"].split(",")) | {""}
    assert run(spark, texts)[8]["labels"] == "apache,apache-2.0-notice,mit,mit-notice"


def test_empty_table(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_whole_wordings_as_they_are_published(spark):
    """Letters, quotes, numbers and line breaks as in the published texts; one changed word and the text is none."""
    disclaimer = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE."""
    two = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
"""
    third = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
    gpl = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published
by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it
will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero
General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>."""
    mpl = """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
    cc = "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    texts = [two + disclaimer, two + third + disclaimer, gpl, mpl, cc, (two + disclaimer).replace("EXEMPLARY", "CUSTOMARY")]
    got = [set(r["labels"].split(",")) for r in run(spark, texts)]
    assert got[0] == {"bsd-text", "bsd-2-clause-whole"} and got[1] == {"bsd-text", "bsd-3-clause-whole"}
    assert got[2] == {"gpl", "gpl-program-notice"} and got[3] == {"mpl-2.0-header"} and got[4] == {"cc-work-notice"}
    assert got[5] == {"bsd-text"}


def test_the_sql_pattern_is_the_operator_s():
    for markup in TEMPLATES.values():
        assert _pattern(markup) == template_regex(markup).replace("\\", "")
