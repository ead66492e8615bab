"""License scans by conditional compression (operator 10).

Candidate blocks are lines with a word of licenses in them, and windows of words around
such words, whatever lines and comment marks they run over.  The words of each block are compressed
alone and with each template as a raw Zstandard dictionary: short notices, and in windows headers and
grants of several lines too.  The templates are ranked by how much smaller the block becomes.
The best ones are confirmed by their exact wording: the words of the template that the block
lacks, whether all its telling words are there, and no negation before them; the next best follow only
where none of those is.  In a window the span is that of the words found.  An SPDX tag is a block
too, ranked by the tags of known identifiers; one that none of them confirms is read as it is.
"""

from __future__ import annotations

import bisect
import difflib
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Short notices of licenses, with the words that tell them apart.
TEMPLATES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", ("apache", "2.0")),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution", "binary", "conditions")),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", ("cc", "by", "4.0")),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", ("cc", "by-nc", "4.0")),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", ("cc", "by-sa", "4.0")),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", ("gnu", "general", "public", "2")),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", ("gnu", "general", "public", "3")),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.", ("gnu", "lesser", "3")),
    "MIT": ("Released under the MIT License.", ("mit", "license")),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla", "2.0")),
    "proprietary": ("All rights reserved.", ("all", "rights", "reserved")),
}
#: Headers and grants of several lines, looked for in windows beside the above.
LONG = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions", ("sublicense", "merge")),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", ("retain", "reproduce")),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", ("retain", "reproduce", "neither", "endorse")),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", ("fee", "appear")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at", ("apache", "2.0")),
    *((k, f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU {name} General Public License as published by the Free Software Foundation; either version {v} of the License, or (at your option) any later version.", (*name.lower().split(), "general", "public", v))
      for k, name, v in (("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser", "2.1"), ("LGPL-3.0", "Lesser", "3"), ("AGPL-3.0", "Affero", "3"))),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0", ("eclipse", "2.0")),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0", ("eclipse", "v1.0")),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", ("unencumbered", "domain")),
)
SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)", re.I)
#: Identifiers whose tags are templates.
IDS = ("0BSD AFL-3.0 AGPL-3.0 Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 "
       "CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-3.0 ISC LGPL-2.0 LGPL-2.1 "
       "LGPL-3.0 MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL NCSA OFL-1.1 OSL-3.0 PostgreSQL PSF-2.0 Python-2.0 Unlicense UPL-1.0 WTFPL X11 Zlib ZPL-2.1").split()
NOT = frozenset("not never no nor neither cannot isn aren wasn weren don doesn won".split())
#: Compressors look for no match in the last bytes.
PAD = " " * 16
#: Longer lines are no block of their own: their blocks are windows, which are ranked and confirmed alike.
LINE = 2000
CUES = r"(?i)licen[sc]e|copyright|warranty|redistribut|rights reserved|spdx|permission is hereby|permission to use|unencumbered|free software|made available under"
WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


@functools.lru_cache(maxsize=1)
def _wordings() -> list[tuple]:
    """(license, words, telling words) of every template, the notices first."""
    return [(k, WORD.findall(t.lower()), telling) for k, t, telling in (*((k, *v) for k, v in TEMPLATES.items()), *LONG)]


@functools.lru_cache(maxsize=1)
def _sizes() -> list[list[int]]:
    """The templates by their number of words: those of a size share a window, so that their savings compare."""
    n = [len(a) for _, a, _ in _wordings()]
    return [x for lo, hi in ((0, 24), (24, 60), (60, 1 << 30)) if (x := [i for i, k in enumerate(n) if lo < k <= hi])]


@functools.lru_cache(maxsize=1)
def _tools() -> dict:
    """Compressors: alone (None), by template, by the tag of an identifier."""
    def tool(words: str | None):
        raw = zstandard.ZstdCompressionDict((PAD + words + PAD).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT) if words else None
        return zstandard.ZstdCompressor(level=6, dict_data=raw, write_content_size=False, write_checksum=False)

    return {None: tool(None)} | {i: tool(" ".join(a)) for i, (_, a, _) in enumerate(_wordings())} | {k: tool(_tag(k)) for k in IDS}


def _tag(identifier: str) -> str:
    return f"spdx-license-identifier {identifier.lower()}"


def _ranked(words: str, by: list) -> list[tuple]:
    """(bytes saved, share saved, which) for each dictionary of ``by``, the largest reduction first."""
    data, tools = (words + PAD).encode(), _tools()
    alone = len(tools[None].compress(data))
    saved = [(alone - len(tools[i].compress(data)), i) for i in by]
    return sorted(((n, n / alone, i) for n, i in saved), key=lambda x: (-x[0], x[2]))


def rank(block: str, by: list[int] | None = None) -> list[tuple]:
    """(share saved, license, template) for each template (or those of ``by``), the largest reduction first."""
    found = _ranked(" ".join(WORD.findall(block.lower())), list(range(len(_wordings()))) if by is None else by)
    return [(share, _wordings()[i][0], i) for _, share, i in found]


def negated(low: str, words: list, held: list[int], short: bool) -> bool:
    """Whether a word of negation that is not of the notice stands at most three words before one that
    is (``held``), in its sentence; in a long text only before its first word."""
    own = set(held)
    for h in held if short else held[:1]:
        for j in range(h - 1, max(h - 4, -1), -1):
            if j in own or re.search(r"[.!?;]\s", low[words[j].end():words[h].start()]):
                break
            if words[j][0] in NOT:
                return True
    return False


def differences(block: str, i: int) -> tuple[int, int, bool]:
    """(template words that the block lacks, block words beside them, all telling words are there and none is negated)."""
    _, a, telling = _wordings()[i]
    low = block.lower()
    words = list(WORD.finditer(low))
    b = [m[0] for m in words]
    if not all(t in b for t in telling):
        return len(a), len(b), False
    held = [j for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() for j in range(m.b, m.b + m.size)]
    return len(a) - len(held), len(b) - len(held), not negated(low, words, held, True)


def judge(block: str, most: float = 0.2, tries: int = 3) -> tuple | None:
    """(license, words missing, words added) of the best-ranked notice that its wording confirms."""
    ranked = [x for x in rank(block, list(range(len(TEMPLATES)))) if x[0] > 0]
    for at in range(0, len(ranked), tries):  # the best few; the others only where none of those is confirmed
        good = [(d[0], -saved, d[1], k) for saved, k, i in ranked[at:at + tries] if (d := differences(block, i))[2]
                and d[0] <= most * len(_wordings()[i][1])]
        if good:
            missing, _, added, k = min(good)
            return k, missing, added
    return None


def identifier(x: str, tries: int = 3) -> str:
    """``x``, as the best-ranked tag of a known identifier confirms it, or as it is."""
    name = re.sub(r"(?i)-only$|-or-later$|\+$", "", x)
    for _, _, k in _ranked(_tag(name), list(IDS))[:tries]:
        if k.lower() == name.lower():
            return k
    return name


def confirmed(low: str, tokens: list, words: list, lo: int, at: int, i: int, most: float) -> tuple | None:
    """(start, end, license, words missing, words added, words found) where the words from ``lo`` on, around ``at``, are those of template ``i``."""
    k, a, telling = _wordings()[i]
    b = words[lo:at + 2 * len(a) + 8]
    if not set(telling) <= set(b):
        return None
    blocks = [x for x in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if x.size]
    # a lone word far from the others is not of the notice
    while len(blocks) > 1 and blocks[0].size == 1 and blocks[1].b - blocks[0].b > 4 + blocks[1].a:
        blocks.pop(0)
    while len(blocks) > 1 and blocks[-1].size == 1 and blocks[-1].b - blocks[-2].b - blocks[-2].size > 4:
        blocks.pop()
    found = sum(x.size for x in blocks)
    held = {w for x in blocks for w in a[x.a:x.a + x.size]}
    if not blocks or not set(telling) <= held or len(a) - found > most * len(a):
        return None
    first, last = lo + blocks[0].b, lo + blocks[-1].b + blocks[-1].size - 1
    added = last - first + 1 - found
    if added > max(2, 0.5 * len(a)) or negated(low, tokens, [lo + j for x in blocks for j in range(x.b, x.b + x.size)], len(a) <= 24):
        return None
    return tokens[first].start(), tokens[last].end(), k, len(a) - found, added, found


def windows(text: str, most: float = 0.2, tries: int = 6) -> list[tuple]:
    """(start, end, license, words missing, words added, words found), disjoint, by start: what
    the words around cues confirm of the templates that compress them best, and SPDX identifiers."""
    out = []
    for m in SPDX.finditer(text):
        for x in re.finditer(r"[A-Za-z0-9.+-]*[A-Za-z0-9+]", re.sub(r"(?i)(?<=\sWITH\s)[A-Za-z0-9.+-]+", lambda e: " " * len(e[0]), m[1])):
            if x[0].upper() not in ("AND", "OR", "WITH"):
                out.append((m.start(1) + x.start(), m.start(1) + x.end(), identifier(x[0]), 0, 0, len(WORD.findall(x[0].lower()))))
                if not re.match(r"[ \t()]*(?:AND|OR|WITH)\b", m[1][x.end():], re.I):
                    break
    low = text.lower()
    if len(low) != len(text):  # a letter whose lower case is longer would move the places
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    tokens = list(WORD.finditer(low))
    words, starts = [m[0] for m in tokens], [m.start() for m in tokens]
    notices, seen, done = [], set(), 0
    for cue in re.finditer(CUES, text):
        if cue.start() < done:
            continue
        at, best = max(0, bisect.bisect_right(starts, cue.start()) - 1), None
        beside = lambda f: (not f[0] <= cue.start() < f[1], -f[5], f[4])  # noqa: E731,B023
        free, ranked = bisect.bisect_left(starts, done), []
        for by in _sizes():
            n = max(len(_wordings()[i][1]) for i in by)
            block = words[max(0, at - n - 8, free):at + 2 * n + 8]
            held = set(block)
            if any(held.issuperset(_wordings()[i][2]) for i in by):  # else no template of this size can be confirmed
                ranked += [x for x in _ranked(" ".join(block), by) if x[0] > 0]
        ranked.sort(key=lambda x: (-x[0], x[2]))
        for x in range(0, len(ranked), tries):  # the best few; the others only where none of those is confirmed
            for _, _, i in ranked[x:x + tries]:
                found = confirmed(low, tokens, words, max(0, at - len(_wordings()[i][1]) - 8, free), at, i, most)
                if found:
                    seen.add(found)
                    best = min(best or found, found, key=beside)
            if best and not beside(best)[0]:
                break
        if best and beside(best)[0] and re.search(CUES, text[best[0]:best[1]]):
            continue  # a notice further on, with a cue of its own
        if best:
            notices.append(best)
            done = max(done, best[1])
    # seen from another cue, a notice may have more words than from its own
    notices.sort()
    for x in sorted(seen, key=lambda x: (-x[5], x[4], x)):
        hi = bisect.bisect_left(notices, (x[1],))
        lo = bisect.bisect_left(notices, x[0], hi=hi, key=lambda w: w[1])
        lo += lo < hi and notices[lo][1] == x[0]
        if all(w[5] < x[5] for w in notices[lo:hi]):
            notices[lo:hi] = [x]
    return sorted(out + notices)


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_blocks, licenses, spans), one row per row of ``docs``.

    ``n_blocks`` counts lines with a cue; ``licenses`` are the confirmed ids, distinct and
    sorted, comma-joined; ``spans`` lists license:start:end:missing:added (code points, end
    exclusive).  A null or empty text has none; repeated rows are scanned each; extra
    columns are not read.
    """
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.when(t.rlike(CUES), t).alias("t"))
    cue = re.compile(CUES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[], [], []]
            for x in b.column(1):
                x, n, spans = x.as_py(), 0, []
                at, wide = 0, windows(x) if x is not None else []
                for line in x.split("\n") if x is not None else ():
                    if cue.search(line):
                        n += 1
                        if len(line) <= LINE and (found := judge(line)):
                            spans.append((found[0], at, at + len(line), *found[1:]))
                    at += len(line) + 1
                # a line stands unless a window that meets it has more words of a template; other windows are added
                size = lambda s: len(WORD.findall(TEMPLATES[s[0]][0].lower())) - s[3]
                spans = [s for s in spans if not any(w[0] < s[2] and s[1] < w[1] and w[5] > size(s) for w in wide)]
                spans += [(w[2], w[0], w[1], w[3], w[4]) for w in wide if not any(w[0] < s[2] and s[1] < w[1] and w[2] == s[0] for s in spans)]
                spans.sort(key=lambda s: (s[1], s[2], s[0]))
                out[0].append(n)
                out[1].append(",".join(sorted({s[0] for s in spans})))
                out[2].append(",".join(":".join(map(str, s)) for s in spans))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())],
                                             ["id", "n_blocks", "licenses", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, n_blocks long, licenses string, spans string").withColumnRenamed("id", id_col)
