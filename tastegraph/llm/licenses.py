"""Licence recognition by sentence rules.

A text is read as its words, lower case and without signs, comment marks and line breaks, so a sentence is found however
it is wrapped and punctuated ("free software; you can", "v. 2.0"). All known wordings are found in one pass of an
Aho-Corasick automaton, so the table can grow without costing time. A known licence sentence must begin at the beginning of
a sentence or line, unless it is long, and stop at the end of one. A notice ("licensed under the MIT License") may have a
subject before it ("This project is ...", not "is not ...") and a bracket behind it. An SPDX tag is a sentence if it names
one licence; of an expression ("MIT OR Apache-2.0") nothing is reported. The known sentences of a text, in order, form a sequence of
identifiers, and ordered rules over identifiers decide which licences are named: a rule matches where its identifiers
follow one another in the text with at most ``GAP`` known sentences of other rules and ``FAR`` sentences in all between
them. A longer rule claims its sentences before a shorter one, so a full text is not also reported as its parts.

One pass over whole texts without a shuffle; the tables of sentences and rules are small and fixed.

Edge cases: a null or empty text has no sentences; a rule that occurs twice is reported twice; equal rows are reported one
by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

GAP, FAR = 1, 6

# Known licence sentences in normal form, by identifier.
SENTENCES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-the-license": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "mit-notice": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-notice": "licensed under cc by 4 0",
    "cc-by-sa-notice": "licensed under cc by sa 4 0",
    "cc0-notice": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "rights-reserved": "all rights reserved",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-origin": "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software",
}
# Names of licences in notices, in normal form, by SPDX identifier.
NAMES = {
    "MIT": ("mit license", "mit", "expat license"),
    "Apache-2.0": ("apache license version 2 0", "apache license v2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0"),
    "GPL-2.0": ("gnu general public license version 2", "gnu general public license v2", "gnu gpl v2", "gpl v2", "gplv2", "gpl 2 0"),
    "GPL-2.0-or-later": ("gnu general public license version 2 or later", "gnu gpl v2 or later", "gpl v2 or later", "gplv2 or later", "gpl 2 0 or later"),
    "GPL-3.0": ("gnu general public license version 3", "gnu general public license v3", "gnu general public license v3 0", "gnu gpl v3", "gpl v3", "gplv3", "gpl 3 0"),
    "GPL-3.0-or-later": ("gnu general public license version 3 or later", "gnu gpl v3 or later", "gpl v3 or later", "gplv3 or later", "gpl 3 0 or later"),
    "LGPL-2.1": ("gnu lesser general public license version 2 1", "gnu lesser general public license v2 1", "lgpl v2 1", "lgpl 2 1"),
    "LGPL-3.0": ("gnu lesser general public license version 3", "gnu lesser general public license v3", "lgpl v3", "lgpl 3 0"),
    "AGPL-3.0": ("gnu affero general public license version 3", "gnu affero general public license v3", "agpl v3", "agplv3", "agpl 3 0"),
    "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license"),
    "BSD-3-Clause": ("bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"),
    "ISC": ("isc license",),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license v2 0", "mozilla public license v 2 0", "mozilla public license 2 0", "mpl 2 0"),
    "EPL-2.0": ("eclipse public license version 2 0", "eclipse public license v2 0", "eclipse public license v 2 0", "eclipse public license 2 0", "epl 2 0"),
    "Unlicense": ("unlicense",),
    "Zlib": ("zlib license",),
    "BSL-1.0": ("boost software license version 1 0", "boost software license 1 0"),
    "CC0-1.0": ("cc0 1 0", "cc0 1 0 universal", "creative commons zero v1 0 universal"),
    "CC-BY-4.0": ("cc by 4 0", "creative commons attribution 4 0 international license"),
    "CC-BY-SA-4.0": ("cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"),
    "CC-BY-NC-4.0": ("cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"),
    "CC-BY-ND-4.0": ("cc by nd 4 0", "creative commons attribution noderivatives 4 0 international license"),
}
# SPDX identifiers in tags only.
TAGGED = ("GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "0BSD", "MIT-0", "Artistic-2.0", "EUPL-1.2")
# What stands before the name in a notice.
VERBS = ("licensed", "released", "distributed", "available", "made available", "published", "provided")
ARTICLES = ("the", "a", "the terms of the", "the terms of", "")
# Licences by the identifiers that must follow one another.
RULES = [
    ("Apache-2.0", ("apache-the-license", "apache-use", "apache-copy")),
    ("Apache-2.0", ("apache-the-license", "apache-use")),
    ("Apache-2.0", ("apache-the-license",)),
    ("Apache-2.0", ("apache-notice",)),
    ("MIT", ("mit-notice", "mit-grant", "mit-keep", "as-is")),
    ("MIT", ("mit-grant", "mit-keep", "as-is")),
    ("MIT", ("mit-grant", "mit-keep")),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-licensed",)),
    ("GPL-3.0", ("gpl3-notice",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MPL-2.0", ("mpl-notice",)),
    ("LGPL-2.1-or-later", ("lgpl21-free",)),
    ("LGPL-3.0-or-later", ("lgpl3-free",)),
    ("AGPL-3.0-or-later", ("agpl3-free",)),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense-free",)),
    ("Zlib", ("zlib-as-is", "zlib-origin")),
    ("BSL-1.0", ("boost-grant",)),
    *[(name, (f"notice-{name}",)) for name in NAMES],
    *[(name, (f"spdx-{name}",)) for name in (*NAMES, *TAGGED)],
]
SENTENCES |= {
    name: SENTENCES[one].replace("general public", f"{kind} general public").replace(version, f"version {number} of")
    for name, one, version, kind, number in (
        ("lgpl21-free", "gpl2-free", "version 2 of", "lesser", "2 1"),
        ("lgpl3-free", "gpl-free", "version 3 of", "lesser", "3"),
        ("agpl3-free", "gpl-free", "version 3 of", "affero", "3"),
    )
}
SENTENCES |= {f"notice-{name}": f"available under the {names[0]}" for name, names in NAMES.items()}
SENTENCES |= {f"spdx-{name}": f"spdx license identifier {re.sub('[^a-z0-9]+', ' ', name.lower())}" for name in (*NAMES, *TAGGED)}

# Other wordings of known sentences; * stands for a name of up to ``NAME`` words.
SUBJECTS = ("program", "library", "file", "software", "package", "project", "script", "module")
VARIANTS = [
    ("apache-copy", "you may obtain a copy of the license at https www apache org licenses license 2 0"),
    ("mit-grant", SENTENCES["mit-grant"] + " including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-keep", SENTENCES["mit-keep"].replace("notice shall", "notice including the next paragraph shall")),
    ("as-is", SENTENCES["as-is"] + " including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    *[
        (name, SENTENCES[name].replace("this program", f"this {subject}").replace(before, after))
        for name in ("gpl-free", "gpl2-free", "gpl-hope", "lgpl21-free", "lgpl3-free", "agpl3-free")
        for subject in SUBJECTS
        for before, after in (("", ""), (" of the license or", " or"))
    ],
    ("bsd-name", SENTENCES["bsd-name"].replace("the copyright holder", "*")),
    ("bsd-name", SENTENCES["bsd-name"].replace("the copyright holder", "*").replace("the names of its", "the names of *")),
    ("cc0-notice", SENTENCES["cc0-notice"].replace("the author", "*")),
    ("mpl-notice", SENTENCES["mpl-notice"].replace("v 2 0", "version 2 0")),
]
NOTICES = {
    " ".join(f"{verb} under {article} {name}{ending}".split()): f"notice-{license}"
    for license, names in NAMES.items()
    for name in names
    for ending in ("", " license")
    if not (ending and "license" in name)
    for verb in VERBS
    for article in ARTICLES
}
# Notices that are sentences of their own, too; and words that may stand between "is" and a notice.
NOTICED = {f"notice-{name}" for name in NAMES} | {n for n, t in SENTENCES.items() if t.startswith(("licensed under", "released under"))}
ADVERBS = ("hereby", "freely", "also", "now")
NAME = 12
# Sentences of more words are also found behind words that no sign parts from them, as in a text without its line breaks.
LONG = 16

# Between two words: the end of a line or of a sentence (. ; : ! ? and closing signs before a blank or the end).
BREAK = re.compile(r"[\n\r]|[.;:!?][\"'”’)\]}>*/#]*(?=\s|$)")
# Between known sentences: the end of a sentence or paragraph, lines unwrapped.
SENTENCE_END = re.compile(r"\n\W*\n|[.;:!?](?=\s|$)")
BRACKET = re.compile(r"[\"'”’*_`]*\s+[(\[]")
# Comment marks that are letters.
COMMENT = re.compile(r"^[^a-z0-9\n]*(?:dnl|rem|c)(?=\s|$)", re.MULTILINE)
WORD = re.compile(r"[a-z0-9]+")
FOLD = re.compile(r"[^a-z0-9]+")
# Parts of words, or a beginning, one of which is in each known sentence; a text without any of them is not cut up.
CUES = ("licen", "permission", "copyright", "redistribut", "warrant", "mozilla", "software", "rights")
UNDER = re.compile(r"under[^a-z0-9]+(?:(?:the|a)[^a-z0-9]+)?(?:terms|[al]?gpl|gnu|cc|creative|mit|apache|mpl|epl|bsd|unli)")
MARK = re.compile(r"^(?:[a-z]|[0-9]+) (?=redistributions|neither)")

# where one text has several identifiers, that of the sentence counts
BY_TEXT = {text: name for text, name in NOTICES.items()}
BY_TEXT |= {text: name for name, text in VARIANTS if "*" not in text}
BY_TEXT |= {text: name for name, text in reversed(SENTENCES.items())}
PATTERNS = [
    (name, text[: text.index("*")], re.compile(text.replace("*", f"[a-z0-9]+(?: [a-z0-9]+){{0,{NAME - 1}}}?") + "(?= )"))
    for name, text in VARIANTS
    if "*" in text
]
FINDER = ahocorasick.Automaton()
for _text, _name in BY_TEXT.items():
    FINDER.add_word(f" {_text} ", (len(_text), _name))
FINDER.make_automaton()
ORDERED = sorted(enumerate(RULES), key=lambda r: (-len(r[1][1]), r[0]))
LISTED = re.compile("(?:[a-z]|[0-9]+)")

MATCH_TYPE = T.ArrayType(
    T.StructType()
    .add("license", T.StringType())
    .add("start", T.LongType())
    .add("end", T.LongType())
    .add("sentences", T.ArrayType(T.StringType()))
)
MATCH_ARROW = pa.list_(
    pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("sentences", pa.list_(pa.string()))])
)


def normal(sentence: str) -> str:
    return MARK.sub("", FOLD.sub(" ", sentence.lower()).strip())


def spots(folded: str) -> list[tuple[int, int, str]]:
    """``(start, end, identifier)`` of the wordings in words joined by blanks, with a blank at both ends."""
    out = [(end - size, end, name) for end, (size, name) in FINDER.iter(folded)]
    for name, head, pattern in PATTERNS:
        at = folded.find(f" {head}")
        while at >= 0:
            if found := pattern.match(folded, at + 1):
                out.append((*found.span(), name))
            at = folded.find(f" {head}", at + 1)
    return out


def known_sentences(text: str) -> Iterator[tuple[int, str, int, int]]:
    """``(number, identifier, start, end)`` of the known sentences; the number counts all sentences of the text."""
    low = text.lower()
    if len(low) != len(text):  # places must stay those of the text
        low = "".join(c.lower() if len(c.lower()) == 1 else " " for c in text)
    low = COMMENT.sub(lambda m: " " * len(m.group()), low)
    found = spots(f" {FOLD.sub(' ', low).strip()} ")
    if not found:
        return
    spans = [m.span() for m in WORD.finditer(low)]
    # words by their starts and ends among the folded words
    first, last, at = {}, {}, 1
    for n, (start, end) in enumerate(spans):
        first[at], last[at + end - start] = n, n
        at += end - start + 1

    def breaks(n: int) -> bool:
        """Whether a sentence or line ends before word n."""
        return n == 0 or n == len(spans) or BREAK.search(low, spans[n - 1][1], spans[n][0]) is not None

    def begins(n: int) -> bool:
        if breaks(n):
            return True
        word, mark = (low[slice(*spans[k])] for k in (n, n - 1))
        return word in ("redistributions", "neither") and breaks(n - 1) and LISTED.fullmatch(mark) is not None

    def has_subject(n: int) -> bool:
        """Whether "is" or "are" stands before word n, and before that at most ``NAME`` words of the same sentence or line."""
        n -= 1 if n and low[slice(*spans[n - 1])] in ADVERBS else 0
        if not n or breaks(n) or low[slice(*spans[n - 1])] not in ("is", "are"):
            return False
        return any(breaks(k) for k in range(n - 1, max(n - 2 - NAME, -1), -1))

    def ends(n: int) -> bool:
        """Whether a bracket opens before word n."""
        return BRACKET.match(low, spans[n - 1][1]) is not None

    number, free, after = 0, 0, 0
    for start, end, name in sorted(found, key=lambda f: (f[0], -f[1])):
        one, two = first[start], last[end]
        if one < free or not (two - one >= LONG or begins(one) or (name in NOTICED and has_subject(one))):
            continue
        if not breaks(two + 1) and not (name in NOTICED and ends(two + 1)):
            continue
        between = SENTENCE_END.split(text[after : spans[one][0]])
        number += 1 + sum(FOLD.sub("", part.lower()) != "" for part in between)
        free, after = two + 1, spans[two][1]
        yield number, name, spans[one][0], after


def licenses(text: str | None) -> list[tuple[str, int, int, list[str]]]:
    """``(licence, start, end, identifiers)`` in order of their starts."""
    if not text:
        return []
    low = text.lower()
    if not any(cue in low for cue in CUES) and not UNDER.search(low):
        return []
    known = list(known_sentences(text))
    places: dict[str, list[int]] = {}
    for n, (_, name, *_) in enumerate(known):
        places.setdefault(name, []).append(n)
    used, out = [False] * len(known), []
    for _, (name, wanted) in ORDERED:
        for first in places.get(wanted[0], []):
            if used[first]:
                continue
            chain = [first]
            for want in wanted[1:]:
                near = range(chain[-1] + 1, min(chain[-1] + 2 + GAP, len(known)))
                following = [n for n in near if known[n][1] == want and not used[n] and known[n][0] - known[chain[-1]][0] <= FAR]
                if not following:
                    break
                chain.append(following[0])
            if len(chain) == len(wanted):
                for n in chain:
                    used[n] = True
                out.append((name, known[first][2], known[chain[-1]][3], [known[n][1] for n in chain]))
    return sorted(out, key=lambda m: (m[1], m[2]))


@F.arrow_udf(MATCH_TYPE)
def find_licenses(text: pa.Array) -> pa.Array:
    """Column of the licences a text names."""
    names = ("license", "start", "end", "sentences")
    return pa.array([[dict(zip(names, m, strict=True)) for m in licenses(t)] for t in text.to_pylist()], type=MATCH_ARROW)


def listed(matches: Column) -> Column:
    """``licence:start:end`` of each match, comma-joined."""
    return F.concat_ws(",", F.transform(matches, lambda m: F.concat_ws(":", m["license"], m["start"], m["end"])))
