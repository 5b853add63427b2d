"""License scans by sentence rules.

A text is cut into pieces at line breaks and after ``. ! ? : ;`` before white space. Runs of pieces are normalised and
looked up among known license sentences, so that one matches wrapped over lines, behind comment signs and with such
breaks inside; the longest run wins. The identifiers, in order, are matched against rules: sequences of identifiers that
must follow each other with at most ``GAP`` unknown sentences between. At each sentence the longest rule that matches
wins, and scanning goes on behind it.

Defined results: a known run is one sentence; in the rest, a single line break is a space and a blank line ends a
sentence; null and blank texts have no sentences; of rules of equal length the first in the table wins; repeated
rows are scanned each on their own; of very long texts only offsets are held; an empty table gives no rows.
Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from feedloom.llm.common import Rows, map_batches

GAP = 2

# Sentences of licenses and notices, and the sequences that identify a license.
SENTENCES = {
    "all-rights": "All rights reserved.",
    "mit-ref": "Released under the MIT License.",
    "mit-ref-2": "This project is licensed under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-ref": "Licensed under the Apache License, Version 2.0.",
    "apache-notice": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl3-ref": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "cc-by-nc-ref": "Licensed under CC BY-NC 4.0.",
    "cc-by-ref": "Licensed under CC BY 4.0.",
    "cc0-ref": "This work is dedicated to the public domain under CC0 1.0.",
}
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-ref-2",)),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache-notice", "apache-use", "apache-copy")),
    ("Apache-2.0", ("apache-ref",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-3.0-only", ("gpl3-ref",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("CC-BY-NC-4.0", ("cc-by-nc-ref",)),
    ("CC-BY-4.0", ("cc-by-ref",)),
    ("CC0-1.0", ("cc0-ref",)),
    ("All-rights-reserved", ("all-rights",)),
)

_END = re.compile(r"(?<=[.!?:;])\s+|\n\s*")
_WORDS = re.compile(r"[^a-z0-9]+")


class Match(NamedTuple):
    license: str
    start: int  # characters
    end: int


def normalise(sentence: str) -> str:
    return _WORDS.sub(" ", sentence.lower()).strip()


def pieces(text: str) -> Iterator[tuple[int, int, bool]]:
    """Offsets, and whether only a line break parts the piece from the one before."""
    at, soft = 0, False
    for m in _END.finditer(text):
        if m.start() > at and not text[at:m.start()].isspace():
            yield at, m.start(), soft
            soft = True
        soft = soft and text[m.start() - 1] not in ".!?:;" and m.group().count("\n") == 1
        at = m.end()
    if at < len(text) and not text[at:].isspace():
        yield at, len(text), soft


class Scanner:
    def __init__(self, known=None, rules=RULES, gap: int = GAP) -> None:
        self.known = {normalise(s): k for k, s in (known or SENTENCES).items()}
        self.starts = {s[:m.start()] for s in self.known for m in re.finditer(r" |$", s)}
        self.rules: dict[str, list] = {}
        for name, ids in sorted(rules, key=lambda r: -len(r[1])):
            self.rules.setdefault(ids[0], []).append((name, ids))
        self.gap = gap

    def run(self, text: str, parts: list[tuple[int, int, bool]], first: int) -> tuple[str, int] | None:
        """The longest known sentence that begins with a piece, and the piece behind it."""
        said, best = "", None
        for k in range(first, len(parts)):
            if not (more := normalise(text[slice(*parts[k][:2])])):
                if k == first:
                    return None
                continue
            said = f"{said} {more}" if said else more
            if said not in self.starts:
                break
            if said in self.known:
                best = self.known[said], k + 1
        return best

    def identify(self, text: str) -> tuple[int, list[tuple[int, str, int, int]]]:
        """How many sentences there are, and those known: position, identifier, offsets."""
        parts = list(pieces(text))
        found, n, at, fresh = [], 0, 0, True
        while at < len(parts):
            if hit := self.run(text, parts, at):
                found.append((n, hit[0], parts[at][0], parts[hit[1] - 1][1]))
                n, at, fresh = n + 1, hit[1], True
            else:
                n, at, fresh = n + (fresh or not parts[at][2]), at + 1, False
        return n, found

    def scan(self, text: str | None) -> tuple[int, int, list[Match]]:
        n, found = self.identify(text or "")
        out, at = [], 0
        while at < len(found):
            for name, ids in self.rules.get(found[at][1], ()):
                part = found[at:at + len(ids)]
                if tuple(p[1] for p in part) == ids and all(y[0] - x[0] <= self.gap + 1 for x, y in zip(part, part[1:])):
                    out.append(Match(name, part[0][2], part[-1][3]))
                    at += len(ids)
                    break
            else:
                at += 1
        return n, len(found), out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_sentences, n_known, licenses, matches`` of every row."""
    match = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def make() -> Rows:
        scanner = Scanner()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [scanner.scan(t) for t in batch.column(1).to_pylist()]
            return pa.record_batch([
                batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([sorted({m.license for m in r[2]}) for r in rows], pa.list_(pa.string())),
                pa.array([[m._asdict() for m in r[2]] for r in rows], match),
            ], names=[id_col, "n_sentences", "n_known", "licenses", "matches"])

        return step

    rows = docs.select(id_col, text_col)
    schema = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, n_sentences long, n_known long, licenses array<string>, matches array<struct<license:string,start:int,end:int>>"
    return map_batches(rows, make, schema)
