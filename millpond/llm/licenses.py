"""Operator 3: license texts found by patience alignment.

The words of a text and of a template are aligned on the words that occur once
in both: of these anchors the longest run in increasing order on both sides is
kept, and the gaps between them are aligned in the same way. The coverage is
the share of the template's words that are aligned. A long text is aligned in
overlapping windows of three times the template, so that an occurrence lies
whole in one of them. A window is passed over only if the words it shares with
the template cannot reach the wanted coverage. Copies that follow each other
make all words of such a window ambiguous; so windows of one length are aligned
too, wherever words that occur once in the template agree on a start.

Words that tell licenses apart count for more: the family (``FAMILIES``), the
version in a template's name, variants (``VARIANTS``) and ``DECISIVE`` words must
be aligned, and no other variant may stand inside the match. Full license texts
are recognised by their headings, whose span alone is given.

Defined cases: NULL and empty texts have no matches; of overlapping matches of
all templates the one with most aligned words, then of higher coverage, then the
earlier one, is kept; version numbers count as equal with or without v and .0;
repeated rows are scanned one by one; an empty table gives an empty result;
further columns travel in ``doc``, which holds all but the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from millpond.llm.common import Work

# Public license notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        ' software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS'
        " OF ANY KIND, either express or implied."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: Redistributions of source code must retain the above copyright notice,"
        " this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the"
        " above copyright notice, this list of conditions and the following disclaimer in the documentation and/or"
        " other materials provided with the distribution."
    ),
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without'
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software."
    ),
    "mit-line": "Released under the MIT License.",
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL"
        " was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}

_GNU_REST = (
    " in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
    " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
)
_VERBATIM = (
    " Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license"
    " document, but changing it is not allowed."
)
for _name, _title, _version, _work in (
    ("gpl-2.0", "GNU General Public License", "2", "program"),
    ("lgpl-2.0", "GNU Library General Public License", "2", "library"),
    ("lgpl-2.1", "GNU Lesser General Public License", "2.1", "library"),
    ("lgpl-3.0", "GNU Lesser General Public License", "3", "program"),
    ("agpl-3.0", "GNU Affero General Public License", "3", "program"),
):
    TEMPLATES[f"{_name}-line"] = f"This work is licensed under the {_title}, version {_version}."
    TEMPLATES[f"{_name}-notice"] = (
        f"This {_work} is free software; you can redistribute it and/or modify it under the terms of the {_title} as"
        f" published by the Free Software Foundation; either version {_version} of the License, or (at your option)"
        f" any later version. This {_work} is distributed{_GNU_REST}"
    )
for _name, _heading in (
    ("gfdl-1.2", "GNU Free Documentation License Version 1.2, November 2002 Copyright (C) 2000, 2001, 2002"),
    ("gfdl-1.3", "GNU Free Documentation License Version 1.3, 3 November 2008 Copyright (C) 2000, 2001, 2002, 2007, 2008"),
    ("gpl-1.0", "GNU General Public License Version 1, February 1989 Copyright (C) 1989"),
    ("gpl-2.0", "GNU General Public License Version 2, June 1991 Copyright (C) 1989, 1991"),
    ("gpl-3.0", "GNU General Public License Version 3, 29 June 2007 Copyright (C) 2007"),
    ("lgpl-2.0", "GNU Library General Public License Version 2, June 1991 Copyright (C) 1991"),
    ("lgpl-2.1", "GNU Lesser General Public License Version 2.1, February 1999 Copyright (C) 1991, 1999"),
    ("lgpl-3.0", "GNU Lesser General Public License Version 3, 29 June 2007 Copyright (C) 2007"),
    ("agpl-3.0", "GNU Affero General Public License Version 3, 19 November 2007 Copyright (C) 2007"),
):
    TEMPLATES[f"{_name}-text"] = _heading + _VERBATIM
for _short, _long in (
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
):
    for _version, _kind in (("3.0", "Unported"), ("4.0", "International")):
        _name = f"cc-{_short.lower()}-{_version}"
        _line, _notice = f"Licensed under CC {_short} {_version}.", f"This work is licensed under a Creative Commons {_long} {_version} {_kind} License."
        if _line not in TEMPLATES.values():
            TEMPLATES[f"{_name}-short-line"] = _line
        if _notice not in TEMPLATES.values():
            TEMPLATES[f"{_name}-long-line"] = _notice
TEMPLATES |= {
    "apache-1.1-line": "Licensed under the Apache License, Version 1.1.",
    "apache-2.0-text": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE,"
        " REPRODUCTION, AND DISTRIBUTION"
    ),
    "bsd-3-clause": TEMPLATES["bsd-2-clause"] + (
        " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission."
    ),
    "cc0-1.0-line": "Licensed under CC0 1.0.",
    "cc0-1.0-notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to"
        " this work under CC0 1.0 Universal."
    ),
    "cc0-1.0-text": (
        "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related"
        " Rights (defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") of an original"
        " work of authorship and/or a database (each, a \"Work\")."
    ),
    "mpl-2.0-text": (
        "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity"
        " that creates, contributes to the creation of, or owns Covered Software."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
        " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled"
        " binary, for any purpose, commercial or non-commercial, and by any means."
    ),
}

#: Words that name a family or a variant of a license.
FAMILIES = {"apache", "mit", "gnu", "mozilla", "creative", "cc", "cc0"}
VARIANTS = {"lesser", "affero", "sharealike", "share-alike", "noncommercial", "non-commercial", "noderivatives", "noderivs", "sa", "nc", "nd"}
VARIANTS |= {f"{first}-{v}" for first in ("by", "attribution") for v in ("sa", "nc", "nd", "nc-sa", "nc-nd", "sharealike", "noncommercial", "noderivatives", "noderivs", "noncommercial-sharealike", "noncommercial-noderivatives", "noncommercial-noderivs")}
#: Further words without which a text is not that license.
DECISIVE = {"bsd-3-clause": {"neither", "endorse"}, "unlicense": {"unencumbered"}, "cc-by-4.0-line": {"attribution"}}
_VERSION = re.compile(r"v?\.?(\d+(?:\.\d+)*?)(?:\.0)?")

_WORD = re.compile(r"[^\W_]+(?:[-.'][^\W_]+)*")
#: Matched words per word of the aligned stretch of the text, at least.
DENSITY = 0.6


def _plain(word: str) -> str:
    """A version without v and .0, other words as they are."""
    found = word[-1] in "0123456789" and _VERSION.fullmatch(word)
    return found[1] if found else word


def _is_variant(words: list[str], at: int) -> bool:
    """Whether a word names a variant; a library and what is free do so in the title only."""
    return words[at] in VARIANTS or words[at : at + 2] in (["library", "general"], ["free", "documentation"])


def _must(name: str, template: list[str]) -> set[int]:
    """Positions of the words of a template that tell it from other licenses."""
    version = re.search(r"-(\d+\.\d+)(?=-|$)", name)
    named = {_plain(version[1])} if version else set()
    at = {i for i, w in enumerate(template) if w in FAMILIES or _is_variant(template, i) or w in DECISIVE.get(name, ())}
    return at | {i for i, w in enumerate(template) if w in named and w not in template[:i]}


def _longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs, sorted by the first, that increases in the second."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            ends.append(i)
        else:
            tops[pile], ends[pile] = b, i
    found, i = [], ends[-1] if ends else -1
    while i >= 0:
        found.append(pairs[i])
        i = back[i]
    return found[::-1]


def aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of positions of equal words, increasing on both sides."""
    found, open_gaps = [], [(0, len(a), 0, len(b))]
    while open_gaps:
        a_low, a_high, b_low, b_high = open_gaps.pop()
        while a_low < a_high and b_low < b_high and a[a_low] == b[b_low]:
            found.append((a_low, b_low))
            a_low, b_low = a_low + 1, b_low + 1
        while a_low < a_high and b_low < b_high and a[a_high - 1] == b[b_high - 1]:
            a_high, b_high = a_high - 1, b_high - 1
            found.append((a_high, b_high))
        if a_low == a_high or b_low == b_high:
            continue
        in_a, in_b = Counter(a[a_low:a_high]), Counter(b[b_low:b_high])
        place = {word: i for i, word in enumerate(b[b_low:b_high], b_low) if in_b[word] == 1}
        anchors = [(i, place[w]) for i, w in enumerate(a[a_low:a_high], a_low) if in_a[w] == 1 and w in place]
        chain = _longest_increasing(anchors)
        if not chain:
            continue
        found += chain
        ends = [(a_low - 1, b_low - 1), *chain, (a_high, b_high)]
        open_gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:])]
    return sorted(found)


def _densest(pairs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """The largest group of pairs that no gap longer than the template tears apart."""
    groups, last = [[]], None
    for pair in pairs:
        if last is not None and pair[0] - last > max(3, length // 2):
            groups.append([])
        groups[-1].append(pair)
        last = pair[0]
    return max(groups, key=len)


def _starts(words: list[str], template: list[str], places: dict[str, list[int]]) -> list[int]:
    """Where the template may start in the text: starts on which several of its unambiguous words agree."""
    once = Counter(template)
    votes = Counter(at - i for i, word in enumerate(template) if once[word] == 1 for at in places.get(word, ()))
    enough = max(min(2, len(template)), len(template) // 8)
    return sorted(start for start, n in votes.items() if n >= enough)


def prepared(templates: dict[str, list[str]]) -> list[tuple[str, list[str], set[int], set[str]]]:
    """Of each template the name, the words, the positions that must be aligned, and their words."""
    plain = {name: [_plain(word) for word in template] for name, template in templates.items()}
    must = {name: _must(name, template) for name, template in plain.items()}
    return [(name, words, must[name], {words[i] for i in must[name]}) for name, words in plain.items()]


def matches(text: str | None, templates: dict[str, list[str]], coverage: float) -> list[tuple[str, int, int, float]]:
    """(template, start, end, coverage) of the license texts in a text; positions in code points."""
    return found_in(text, prepared(templates), coverage)


def found_in(text: str | None, templates: list, coverage: float) -> list[tuple[str, int, int, float]]:
    """``matches`` with templates that are ``prepared``."""
    lower = (text or "").lower()
    if len(lower) != len(text or ""):  # a few letters change their length: leave those alone
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    present = set(map(_plain, _WORD.findall(lower)))
    own, spans, words = set(), None, []
    for name, template, must, telling in templates:
        need = coverage * len(template)
        if not telling <= present or sum(word in present for word in template) < need:
            continue
        if spans is None:
            spans = [m.span() for m in _WORD.finditer(lower)]
            words = [_plain(lower[a:b]) for a, b in spans]
            places: dict[str, list[int]] = {}
            for at, word in enumerate(words):
                places.setdefault(word, []).append(at)
        size, windows = len(template), []
        for low in range(0, len(words), size):
            window = words[low : low + 3 * size]
            here = set(window)
            if sum(word in here for word in template) < need:
                continue
            # a second occurrence in the window makes words ambiguous: also look at its parts
            windows += [(low + begin, low + end) for begin, end in ((0, 3 * size), (0, 2 * size), (size, 3 * size))]
        starts = _starts(words, template, places)
        windows += [(max(low, 0), low + length) for low in starts for length in (size, size + max(1, size // 4))]
        for begin, end in windows:
            pairs = _densest(aligned(words[begin:end], template), size)
            if len(pairs) < need or len(pairs) < DENSITY * (pairs[-1][0] - pairs[0][0] + 1):
                continue
            if not must <= {j for _, j in pairs}:
                continue
            first, last, inside = begin + pairs[0][0], begin + pairs[-1][0], {begin + i for i, _ in pairs}
            if any(at not in inside and _is_variant(words, at) for at in range(first, last + 1)):
                continue
            own.add((-len(pairs), -len(pairs) / size, spans[first][0], spans[last][1], name))
    found, taken = [], []
    for _, share, start, end, name in sorted(own):
        at = bisect_left(taken, (start, end))
        if (at == len(taken) or end <= taken[at][0]) and (not at or taken[at - 1][1] <= start):
            taken.insert(at, (start, end))
            found.append((name, start, end, -share))
    return sorted(found, key=lambda m: (m[1], m[0]))


def scanned(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = 0.8, text: str = "text") -> DataFrame:
    """``doc`` (all columns but the text) and ``licenses`` (name, start, end, coverage) of every row."""
    Work(docs.sparkSession)  # bounds the Arrow batches
    words = prepared({name: _WORD.findall(template.lower()) for name, template in sorted(templates.items())})
    kind = pa.list_(pa.struct([("name", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]))

    @arrow_udf("array<struct<name:string,start:long,end:long,coverage:double>>")
    def licenses_of(texts: pa.Array) -> pa.Array:
        names = ("name", "start", "end", "coverage")
        return pa.array([[dict(zip(names, m)) for m in found_in(t, words, coverage)] for t in texts.to_pylist()], kind)

    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).alias("none")]
    return docs.select(F.struct(*others).alias("doc"), licenses_of(F.col(text)).alias("licenses"))
