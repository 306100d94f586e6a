"""License scans by conditional compression.

Words around license vocabulary form candidate blocks. Each block is compressed
alone and with every template as zstandard raw dictionary: the more of a
template a block repeats, the more bytes its dictionary saves. Templates are tried
in the order of what they save, and every one whose words the block holds in
sufficient number is confirmed by the exact wording: block and template are aligned
word by word, and the similarity must reach 0.8. A difference in a telling word, one
that sets alike templates apart (Lesser, Affero, BY-NC), a missing proper name or another
number rules a template out, so a notice of a license that is not known gets no wrong name. Of the confirmed
ones, the template that accounts for most words names the notice; the differing words
are reported. The text before and after a notice is searched again, so a block can
hold several.
"""

from __future__ import annotations

import difflib
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIMILARITY = 0.8
ALIKE = 0.7              # templates this similar are told apart by the words that differ
PIECE = 512              # long blocks are searched in overlapping pieces of so many words, or more

#: Words that any notice below has.
VOCABULARY = (r"licen[sc]e|copyright|copyleft|rights reserved|permission|redistribut|warrant"
              r"|public domain|creative commons|CC BY|CC0|SPDX")
#: Common notices, as their publishers word them.
TEMPLATES: dict[str, str] = {
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0 notice": "This work has been dedicated to the public domain under CC0 1.0 Universal.",
    "All rights reserved": "All rights reserved.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution. THIS SOFTWARE IS PROVIDED"),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written "
        "permission. THIS SOFTWARE IS PROVIDED"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at"),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version."),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License, or (at your option) any later version."),
    "LGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at"),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

RESULT = T.StructType([
    T.StructField("license", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("saved_bytes", T.LongType()),
    T.StructField("similarity", T.DoubleType()),
    T.StructField("differences", T.ArrayType(T.StringType()))])
_SEEN = re.compile(VOCABULARY, re.IGNORECASE)


def plain(words: list[str]) -> list[str]:
    """Words as they are compared: lower case, without punctuation around them."""
    return [w.lower().strip(".,;:!?\"'()[]{}<>*#/|$&%-") for w in words]


@dataclass
class Template:
    name: str
    words: list[str]
    counts: Counter
    packer: zstandard.ZstdCompressor
    names: set[str]          # words that must not be missing: proper names
    telling: set[str]        # words that must neither be missing nor be added

    def saved(self, block: bytes, alone: int) -> int:
        return alone - len(self.packer.compress(block))

    def may_be_in(self, block: Counter) -> bool:
        """A similarity of 2 m / (template + block part) reaches 0.8 only if the m words in
        common, which the part has at least, are two thirds of the template's."""
        common = sum(min(n, block[w]) for w, n in self.counts.items())
        return (2 - SIMILARITY) * common >= SIMILARITY * len(self.words)


@dataclass
class Known:
    """Templates, and what follows from them: how far a notice can reach from any of its
    words, and whether all of them hold license vocabulary."""

    templates: list[Template]
    reach: int
    gated: bool


def proper_names(text: str) -> set[str]:
    """Capitalised words inside sentences, unless they occur uncapitalised too."""
    words = text.split()
    small = {p for w, p in zip(words, plain(words)) if w.strip("\"'(")[:1].islower()}
    inside = [w for before, w in zip(words, words[1:]) if not before.endswith((".", ":"))]
    return {p for w, p in zip(inside, plain(inside)) if w.strip("\"'(")[:1].isupper()} - small


def load_templates(templates: dict[str, str]) -> Known:
    out = []
    for name, text in templates.items():
        words = plain(text.split())
        raw = zstandard.ZstdCompressionDict(" ".join(words).encode(),
                                            dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        out.append(Template(name, words, Counter(words), zstandard.ZstdCompressor(level=9, dict_data=raw),
                            proper_names(text), set()))
    for a, b in itertools.combinations(out, 2):
        if difflib.SequenceMatcher(None, a.words, b.words, autojunk=False).ratio() >= ALIKE:
            apart = set(a.words) ^ set(b.words)
            a.telling |= apart
            b.telling |= apart
    longest = max((len(t.words) for t in out), default=0)
    # a part as similar as that has at most (2 / 0.8 - 1) times the template's words
    return Known(out, int((2 / SIMILARITY - 1) * longest) + 1, gated(templates))


def gated(templates: dict[str, str]) -> bool:
    """Whether texts without license vocabulary can be passed over: every template has some."""
    return all(_SEEN.search(text) for text in templates.values())


def blocks(text: str, words: list[re.Match], known: Known) -> Iterator[tuple[int, int]]:
    """Word ranges around license vocabulary; ranges that touch are one. The whole text
    if some template has no such vocabulary."""
    if not known.gated:
        if words:
            yield 0, len(words)
        return
    starts, at, found = [w.start() for w in words], 0, None
    for hit in _SEEN.finditer(text):
        while at + 1 < len(starts) and starts[at + 1] <= hit.start():
            at += 1
        lo, hi = max(0, at - known.reach), min(len(words), at + known.reach + 1)
        if found and lo <= found[1]:
            found = (found[0], hi)
        else:
            if found:
                yield found
            found = (lo, hi)
    if found:
        yield found


@dataclass
class Match:
    start: int
    end: int
    similarity: float
    common: int
    differences: list[str]
    telling: bool


def align(block: list[str], like: Template) -> Match | None:
    """Where the block words the template best, and how that differs."""
    template = like.words
    match = difflib.SequenceMatcher(None, block, template, autojunk=False)
    best = match.find_longest_match()
    if not best.size:
        return None
    # the template's words before and after the longest run, with some room for insertions
    room = len(template) // 4 + 1
    lo = max(0, best.a - best.b - room)
    hi = min(len(block), best.a + len(template) - best.b + room)
    part = difflib.SequenceMatcher(None, block[lo:hi], template, autojunk=False)
    runs = [m for m in part.get_matching_blocks() if m.size]
    start, end = lo + runs[0].a, lo + runs[-1].a + runs[-1].size
    common = sum(m.size for m in runs)
    part = difflib.SequenceMatcher(None, template, block[start:end], autojunk=False)
    changes = [(op, template[a:b], block[start + c:start + d])
               for op, a, b, c, d in part.get_opcodes() if op != "equal"]
    told = any(like.telling & {*old, *new} or like.names & {*old} or _numbers(old, new)
               for _, old, new in changes)
    return Match(start, end, 2 * common / (len(template) + end - start), common,
                 [f"{op}: {' '.join(old)} -> {' '.join(new)}" for op, old, new in changes], told)


def _numbers(old: list[str], new: list[str]) -> bool:
    """Whether one number stands for another, as a version does."""
    def number(w: str) -> bool:
        return w.lstrip("v").replace(".", "").isdigit()
    return any(map(number, old)) and any(map(number, new))


def scan_block(words: list[str], known: Known) -> Iterator[dict]:
    """Confirmed notices among the words, as RESULT rows with word positions. Ties go to the
    template that saves more bytes, then to the one that comes first."""
    todo = [(0, len(words))]
    bare = zstandard.ZstdCompressor(level=9)
    while todo:
        lo, hi = todo.pop()
        part = words[lo:hi]
        held = Counter(part)
        able = [t for t in known.templates if t.may_be_in(held)]
        if not able:
            continue
        raw = " ".join(part).encode()
        alone = len(bare.compress(raw))
        best, name, saving = None, "", 0
        for saved, t in sorted(((t.saved(raw, alone), t) for t in able), key=lambda x: -x[0]):
            m = align(part, t)
            if m and not m.telling and m.similarity >= SIMILARITY and (
                    best is None or (m.common, m.similarity) > (best.common, best.similarity)):
                best, name, saving = m, t.name, saved
        if best:
            yield {"license": name, "start": lo + best.start, "end": lo + best.end,
                   "saved_bytes": saving, "similarity": best.similarity, "differences": best.differences}
            todo += [(lo, lo + best.start), (lo + best.end, hi)]


def scan_words(words: list[str], known: Known) -> Iterator[dict]:
    """As scan_block, piece by piece. What starts in the overlap, as long as the longest notice
    can be, is left to the next piece, which begins behind the last notice found."""
    at, size = 0, max(PIECE, 3 * known.reach)
    while at < len(words):
        last = at + size >= len(words)
        edge = size - known.reach
        found = sorted(scan_block(words[at:at + size], known), key=lambda r: r["start"])
        for row in found:
            if last or row["start"] < size - known.reach:
                edge = max(edge, row["end"])
                yield row | {"start": at + row["start"], "end": at + row["end"]}
        if last:
            break
        at += edge


def _scan(templates: dict[str, str]):
    def run(texts: pa.Array) -> pa.Array:
        known = load_templates(templates)
        rows = []
        for text in texts.to_pylist():
            found = []
            words = list(re.finditer(r"\S+", text or ""))
            for lo, hi in blocks(text, words, known):
                compared = plain([w[0] for w in words[lo:hi]])
                for row in scan_words(compared, known):
                    found.append(row | {"start": lo + row["start"], "end": lo + row["end"]})
            rows.append(sorted(found, key=lambda r: r["start"]))
        return pa.array(rows, pa.list_(pa.struct([
            ("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
            ("saved_bytes", pa.int64()), ("similarity", pa.float64()),
            ("differences", pa.list_(pa.string()))])))

    return F.arrow_udf(run, T.ArrayType(RESULT))


def scan(docs: DataFrame, text_col: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """One row a notice found: struct ``row`` with the document's columns, and the
    columns of RESULT; ``start`` and ``end`` count white-space separated words.

    ``templates`` (name: wording) stand in for the built-in ones. A notice has to hold
    license vocabulary somewhere, as all built-in templates do, and texts without any are
    passed over before any Python runs; if a given template has none, every text is
    searched whole. Null and empty texts have no notices. Where templates account for as many words
    of a text, the one that saves more bytes counts, then the first. Repeated rows
    give repeated results. Templates that are alike are told apart by the words that one
    of them has and the other has not.
    """
    templates = TEMPLATES if templates is None else templates
    text = F.col(f"`{text_col}`")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    some = docs.where(text.rlike(f"(?i){VOCABULARY}")) if gated(templates) else docs
    found = some.select(row.alias("row"), _scan(templates)(text).alias("found"))
    return found.select("row", F.explode("found").alias("hit")).select("row", "hit.*")
