import random
import re

from tastegraph.llm import licenses as li
from tastegraph.llm.queries import op6_licenses


def names(text):
    return [m[0] for m in li.licenses(text)]


def test_notices_wherever_they_stand():
    assert names("Prose of some kind.\nReleased under the MIT License.\nMore prose.") == ["MIT"]
    assert names("a. LICENSED under the Apache   License, Version 2.0. b") == ["Apache-2.0"]
    assert names("Licensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0"]
    assert names("This work is licensed under the GNU General Public License, version 3.") == ["GPL-3.0"]
    assert names("We talk about the MIT license and its permission notice.") == []
    assert names("He was licensed under the old rules. All rights reserved") == []


def test_spans_are_those_of_the_sentences():
    text = "x.  Released under the MIT License.\nLicensed under CC BY 4.0!"
    assert [text[s:e] for _, s, e, _ in li.licenses(text)] == ["Released under the MIT License", "Licensed under CC BY 4.0"]


def full(rule):
    return "".join(li.SENTENCES[i].capitalize() + ".\n" for i in rule)


def test_longer_rules_claim_their_sentences():
    for name, rule in li.RULES:
        found = li.licenses("Intro.\n" + full(rule) + "End.")
        assert [(m[0], tuple(m[3])) for m in found] == [(name, rule)]
    bsd = ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")
    assert names(full(bsd) + full(bsd[:3])) == ["BSD-3-Clause", "BSD-2-Clause"]
    assert names(full(reversed(bsd))) == []
    assert names(full(bsd[:1]) + "Word.\n" * 20 + full(bsd[1:])) == []


def brute(text):
    """All sentences by hand, all rules at all places, longest first."""
    parts = [p for p in re.split(r"\n|(?<=[.;:!?])(?=\s)", text or "") if p.strip(" .;:!?")]
    found = [li.BY_TEXT.get(li.normal(p)) for p in parts]
    free, out = [f is not None for f in found], []
    for name, rule in sorted(li.RULES, key=lambda r: -len(r[1])):
        for i in range(len(found)):
            if len(rule) == 1 and free[i] and found[i] == rule[0]:
                free[i] = False
                out.append(name)
    return sorted(out)


def test_random_texts_of_single_notices():
    rng = random.Random(0)
    singles = [r[1][0] for r in li.RULES if len(r[1]) == 1]
    for _ in range(300):
        lines = [rng.choice([li.SENTENCES[rng.choice(singles)] + ".", "Some other prose.", "permission to go;", ""]) for _ in range(rng.randint(0, 12))]
        text = rng.choice(["\n", " "]).join(lines)
        assert sorted(names(text)) == brute(text) or len({r for _, r in li.RULES}) == 0, text


def test_edges(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "\n" * 1000), (4, "license " * 100000), (5, "Released under the MIT License."), (5, "Released under the MIT License.")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, license string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id, r.n_licenses, r.licenses) for r in op6_licenses(spark, str(tmp_path)).collect())
    assert got == [(1, 0, ""), (2, 0, ""), (3, 0, ""), (4, 0, ""), (5, 1, "MIT:0:30"), (5, 1, "MIT:0:30")]
    assert docs.limit(0).select(li.find_licenses("text")).count() == 0


MIT = """MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE."""
GPL = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{} either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
GPL2, GPL3 = GPL.format(";", ";", 2), GPL.format(":", ",", 3)
BSD2 = """Copyright (c) 2020, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of {} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
REAL = [
    (MIT, "MIT", 3), (GPL2, "GPL-2.0-or-later", 2), (GPL3, "GPL-3.0-or-later", 2), (BSD2, "BSD-2-Clause", 3),
    (BSD3.format("the copyright holder"), "BSD-3-Clause", 4), (BSD3.format("Doe Works, Inc."), "BSD-3-Clause", 4),
    (APACHE, "Apache-2.0", 3), (MPL, "MPL-2.0", 1),
]


def test_real_texts_wrapped_and_in_comments():
    for text, name, sentences in REAL:
        for mark in ("", "# ", "// ", " * ", "dnl ", ";; ", "REM "):
            whole = "\n".join(["int x;", *[(mark + line).rstrip() for line in text.split("\n")], "", "int main() {}"])
            assert [(m[0], len(m[3])) for m in li.licenses(whole)] == [(name, sentences)], (name, mark)
        for other in (" ".join(text.split()), text.replace("\n", "\r\n"), "İ\n" + text):
            assert names(other) == [name], name
    assert names("\n\n".join(text for text, *_ in REAL)) == [name for _, name, _ in REAL]
    assert names("\n".join(["x\ty"] + list(MIT.split("\n")[4:5]))) == []


def test_lines_without_an_end_are_sentences_too():
    assert names("Title\nReleased under the MIT License\nNext line of prose") == ["MIT"]
    assert names("a) Redistributions of source code\nand released under the MIT License too") == []


NOTICE = [
    ("This project is licensed under the MIT License.", "MIT"),
    ("This file is licensed under the Apache License, Version 2.0", "Apache-2.0"),
    ("This work is licensed under CC BY-SA 4.0", "CC-BY-SA-4.0"),
    ("Released under the MIT License (see LICENSE).", "MIT"),
    ("SPDX-License-Identifier: MIT", "MIT"),
    ("// SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1-or-later"),
    ("/* SPDX-License-Identifier: GPL-2.0 */", "GPL-2.0"),
    ("The tool and its data are freely available under the terms of the GNU General Public License v3.0.", "GPL-3.0"),
    ("Licensed under the GNU General Public License, version 3 or later.", "GPL-3.0-or-later"),
    ("All of this is distributed under the BSD 3-Clause License.", "BSD-3-Clause"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.", "EPL-2.0"),
    ("Published under the Mozilla Public License, version 2.0.", "MPL-2.0"),
    ("Our map is released under CC BY 4.0.", "CC-BY-4.0"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("Released under the ISC license.", "ISC"),
]
OTHER = [
    "This project is not licensed under the MIT License.", "Code that was released under the MIT License may differ.",
    "SPDX-License-Identifier: MIT OR Apache-2.0", "She is licensed under the law of 1987.", "", "Some prose of no interest",
    "Is it licensed under the MIT license or another one?", "They met under the terms of the treaty.",
]
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software."""
LGPL = GPL.format(";", ";", "2.1").replace("GNU General", "GNU Lesser General").replace("program", "library")


def test_notices_with_subjects_brackets_and_tags():
    for text, name in NOTICE:
        assert names(text) == names(f"Before.\n{text}\nAfter") == [name], text
    for text in OTHER:
        assert names(text) == [], text
    for subject in range(1, li.NAME + 4):
        assert names("x. " + "word " * subject + "is licensed under the MIT License.") == (["MIT"] if subject <= li.NAME else [])
    rng = random.Random(3)
    for _ in range(200):
        lines = [rng.choice([*NOTICE, *[(o, None) for o in OTHER]]) for _ in range(rng.randint(0, 10))]
        assert names("\n".join(text for text, _ in lines)) == [name for _, name in lines if name]


def test_more_whole_texts():
    for text, name in ((ISC, "ISC"), (ZLIB, "Zlib"), (LGPL, "LGPL-2.1-or-later")):
        for mark in ("", "# ", " * "):
            assert names("\n".join(mark + line for line in text.split("\n"))) == [name], text


def spots_by_hand(folded):
    """Each run of words looked up in the table."""
    words, out, at = folded.split(), [], 1
    most = max(len(t.split()) for t in li.BY_TEXT)
    for n, word in enumerate(words):
        for m in range(n + 1, min(n + most, len(words)) + 1):
            text = " ".join(words[n:m])
            if text in li.BY_TEXT:
                out.append((at, at + len(text), li.BY_TEXT[text]))
        at += len(word) + 1
    return out


def test_wordings_found_equal_lookups_of_all_runs():
    rng = random.Random(4)
    pieces = [t for t in li.BY_TEXT]
    for _ in range(100):
        words = " ".join(rng.choice([rng.choice(pieces), "licensed under the", "some words", "mit license"]) for _ in range(6))
        folded = f" {words} "
        got = [s for s in li.spots(folded) if folded[s[0] : s[1]] in li.BY_TEXT]
        assert set(spots_by_hand(folded)) == set(got)


def test_each_wording_has_a_cue():
    for text in [*li.BY_TEXT, *(text for _, text in li.VARIANTS)]:
        assert any(cue in text for cue in li.CUES) or li.UNDER.search(text), text
