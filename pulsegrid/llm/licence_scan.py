"""Licence scan: sentences of a text become known identifiers, and sequences of those are matched by ordered rules.

A sentence is normalised (lower case, no punctuation, one blank between words, numbers of years and names of holders
left out) and looked up among the forms that licences and notices are made of. What is found is a sequence of
identifiers with gaps for other sentences. Rules are tried in order at each place of it, the longer and more special
first; a rule that fits takes its sentences, and the scan goes on behind them. A known sentence that no rule takes is
reported as unmatched, so that nothing is lost.

Notices are often wrapped, behind comment marks: within a paragraph a line end and the marks at the start of the next
line count as a blank, and a line without any word ends the paragraph. As a line may also be a notice of its own,
without a stop, each line and each sentence can begin a known one, which is the longest run of them that has its form.
A form with an open end goes on to the next stop, but not into a line that begins another known sentence.

Only texts with one of the words that all known sentences share are cut into sentences at all (the tests make
sentences of each form and look for those words). Defined cases: null and empty texts have no sentences and no licences; repeated notices are
reported each; a sentence in any case or spacing is the same sentence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import query, table

# --- fixed values: forms of licence sentences (regular expressions over normalised sentences) ---
HEADER = r"(?:this )?\w+(?: \w+){0,3} is free software you (?:can|may) redistribute it and or modify it under the terms of the "
#: how a sentence that names a licence begins, and what it may add
UNDER = r"(?:(?:this|the) \w+(?: \w+)? is |\w+ is )?(?:made )?(?:released |licen[cs]ed |distributed |available |provided )under (?:the )?(?:terms of the )?"
SEE = r"(?: see (?:the )?(?:accompanying |included )?(?:licen[cs]e|copying)(?: licen[cs]e| copying| md| txt| rst| file)*(?: for (?:more |full |the )?(?:details|information|text))?)?"
SENTENCES = (
    ("mit-name", r"(?:this \w+ is |\w+ is )?(?:released|licensed|distributed|available) under the (?:terms of the )?mit licen[cs]e" + SEE),
    ("mit-title", r"(?:the )?mit licen[cs]e(?: mit)?"),
    ("mpl-header", r"this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? 2 0"),
    ("mpl-copy", r"if a copy of the mpl was not distributed with this file you can obtain one at https? (?:www )?mozilla org mpl 2 0"),
    ("mpl-name", UNDER + r"mozilla public licen[cs]e(?: v(?:ersion)?)? 2 0" + SEE),
    ("isc-grant", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc-as-is", r"the software is provided as is and .* disclaims? all warranties with regard to this software .*"),
    ("isc-name", UNDER + r"isc licen[cs]e" + SEE),
    ("boost-name", UNDER + r"boost software licen[cs]e(?: version)? 1 0" + SEE),
    ("boost-copy", r"see accompanying file licen[cs]e 1 0 txt or copy at https? (?:www )?boost org licen[cs]e 1 0 txt"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("unlicense-name", UNDER + r"unlicense" + SEE),
    ("epl-header", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e(?: v(?:ersion)?)? (?P<version>[12] 0)(?: .*)?"),
    ("epl-name", UNDER + r"eclipse public licen[cs]e(?: v(?:ersion)?)? (?P<version>[12] 0)" + SEE),
    ("bsd-clauses-name", UNDER + r"bsd (?P<clauses>[23]) clause(?: new or revised| new| revised| modified| simplified)? licen[cs]e" + SEE),
    ("clauses-bsd-name", UNDER + r"(?P<clauses>[23]) clause bsd licen[cs]e" + SEE),
    ("bsd-new-name", UNDER + r"(?:new|revised|modified) bsd licen[cs]e" + SEE),
    ("bsd-simple-name", UNDER + r"(?:simplified|freebsd) bsd licen[cs]e" + SEE),
    ("bsd-title", r"(?:the )?bsd (?P<clauses>[23]) clause licen[cs]e"),
    ("zlib-as-is", r"this software is provided as is without any express or implied warranty"),
    ("zlib-name", UNDER + r"zlib licen[cs]e" + SEE),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction .*"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("as-is", r"the software is provided as is without warranty of any kind .*"),
    ("no-liability", r"in no event shall .* be liable for any .*"),
    ("apache-name", r"(?:this \w+ is )?(?:released |licensed |distributed )under the (?:terms of the )?apache licen[cs]e(?: version)? 2 0(?: the license)?" + SEE),
    ("apache-condition", r"you may not use this file except in compliance with the license"),
    ("apache-copy", r"you may obtain a copy of the license at(?: .*)?"),
    ("apache-url", r"https? www apache org licenses license 2 0(?: txt| html)?"),
    ("apache-as-is", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis .*"),
    ("gpl2-name", r"(?:this \w+ is )?(?:released |licensed |distributed )under the (?:terms of the )?gnu general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 2" + SEE),
    ("gpl2-later", HEADER + r"gnu general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e or (?:at your option )?any later version"),
    ("gpl2-only", HEADER + r"gnu general public licen[cs]e(?: as published by the free software foundation version 2(?: of the licen[cs]e)?(?: only)?| version 2(?: only)? as published by the free software foundation)"),
    ("gpl3-later", HEADER + r"gnu general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or (?:at your option )?any later version"),
    ("gpl3-only", HEADER + r"gnu general public licen[cs]e(?: as published by the free software foundation version 3(?: of the licen[cs]e)?(?: only)?| version 3(?: only)? as published by the free software foundation)"),
    ("agpl-header", HEADER + r"gnu affero general public licen[cs]e as published by the free software foundation(?: either)? version 3(?: of the licen[cs]e)?(?: or (?:at your option )?any later version)?"),
    ("lgpl-header", HEADER + r"gnu (?:lesser|library) general public licen[cs]e as published by the free software foundation(?: either)? version (?:2|2 1|3)(?: of the licen[cs]e)?(?: or (?:at your option )?any later version)?"),
    ("gpl3-name", r"(?:this \w+ is )?(?:released |licensed |distributed )under the (?:terms of the )?gnu general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 3" + SEE),
    ("lgpl-name", r"(?:this \w+ is )?(?:released |licensed |distributed )under the (?:terms of the )?gnu (?:lesser|library) general public licen[cs]e version (?:2|2 1|3)" + SEE),
    ("agpl-name", r"(?:this \w+ is )?(?:released |licensed |distributed )under the (?:terms of the )?gnu affero general public licen[cs]e version 3" + SEE),
    ("later", r"(?:or )?(?:at your option )?any later version(?: of the license)?"),
    ("gpl-warranty", r"this program is distributed in the hope that it will be useful but without any warranty(?: .*)?"),
    ("bsd-grant", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", r"(?:1 )?redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", r"(?:2 )?redistributions in binary form must reproduce the above copyright notice .*"),
    ("bsd-endorse", r"(?:3 )?neither the name of .* may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("cc", r"(?:this \w+ is )?(?:released |licensed )under (?:a )?(?:the )?(?:creative commons|cc) (?P<terms>by(?: nc)?(?: nd| sa)?|0)(?: licen[cs]e)? (?P<version>\d 0)"),
    ("public-domain", r"this \w+ is (?:dedicated to|in) the public domain"),
    ("spdx", r"spdx license identifier (?P<id>.+)"),
    ("copyright", r"copyright (?:c )?.*"),
    ("all-rights", r"all rights reserved"),
)
#: ordered rules: identifiers in a row, and the licence; a name in braces is a part of the sentence
RULES = (
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("mit-grant", "mit-notice", "as-is"), "MIT"),
    (("mit-title", "mit-grant", "mit-notice", "as-is"), "MIT"),
    (("isc-grant", "isc-as-is"), "ISC"),
    (("mpl-header", "mpl-copy"), "MPL-2.0"),
    (("boost-name", "boost-copy"), "BSL-1.0"),
    (("apache-name", "apache-condition", "apache-copy", "apache-as-is"), "Apache-2.0"),
    (("apache-name", "apache-condition", "apache-copy", "apache-url", "apache-as-is"), "Apache-2.0"),
    (("gpl3-name", "later"), "GPL-3.0-or-later"),
    (("gpl2-name", "later"), "GPL-2.0-or-later"),
    (("gpl3-later",), "GPL-3.0-or-later"),
    (("gpl2-later",), "GPL-2.0-or-later"),
    (("gpl3-only",), "GPL-3.0-only"),
    (("gpl2-only",), "GPL-2.0-only"),
    (("agpl-header",), "AGPL-3.0"),
    (("lgpl-header",), "LGPL"),
    (("spdx",), "{id}"),
    (("apache-name",), "Apache-2.0"),
    (("agpl-name",), "AGPL-3.0"),
    (("lgpl-name",), "LGPL"),
    (("gpl3-name",), "GPL-3.0-only"),
    (("gpl2-name",), "GPL-2.0-only"),
    (("mit-grant",), "MIT"),
    (("mit-name",), "MIT"),
    (("mit-title",), "MIT"),
    (("isc-grant",), "ISC"),
    (("isc-name",), "ISC"),
    (("mpl-header",), "MPL-2.0"),
    (("mpl-name",), "MPL-2.0"),
    (("boost-name",), "BSL-1.0"),
    (("unlicense",), "Unlicense"),
    (("unlicense-name",), "Unlicense"),
    (("epl-header",), "EPL-{version}"),
    (("epl-name",), "EPL-{version}"),
    (("bsd-clauses-name",), "BSD-{clauses}-Clause"),
    (("clauses-bsd-name",), "BSD-{clauses}-Clause"),
    (("bsd-title",), "BSD-{clauses}-Clause"),
    (("bsd-new-name",), "BSD-3-Clause"),
    (("bsd-simple-name",), "BSD-2-Clause"),
    (("zlib-as-is",), "Zlib"),
    (("zlib-name",), "Zlib"),
    (("cc",), "CC-{terms}-{version}"),
    (("public-domain",), "Public-Domain"),
)
#: every known sentence has one of these in its normalised form
KEYS = ("licen", "permission", "copyright", "warranty", "liable", "redistribution", "public domain", "later version",
        "all rights reserved", "creative commons", "cc by", "cc 0", "mozilla", "warranties")
# --- end of fixed values ---

#: "cc" only as a word
KEYWORD = re.compile("|".join(re.sub("^cc ", r"cc(?<![^\\W_]cc) ", k).replace(" ", r"[\W_]+") for k in KEYS), re.IGNORECASE)
#: a part ends at a line end, or at a stop before white space
PART = re.compile(r"[^\n]+?(?:[.;!?](?=\s|$)|(?=\n|$))")
FORMS = tuple((name, re.compile(pattern)) for name, pattern in SENTENCES)
OPEN = {name for name, pattern in SENTENCES if pattern.endswith((" .*", "(?: .*)?"))}
#: between fixed words anything but a stop may stand
FREE = OPEN | {name for name, pattern in SENTENCES if ".*" in pattern}
#: one part each, as what follows them on the next line is no part of them
SINGLE = {"spdx", "copyright"}
#: a stop that ends no sentence
SHORT = re.compile(r"\b(?:inc|ltd|corp|co)\.$", re.IGNORECASE)
CLOSER = re.compile(r"\s*(?:\*+/|-->|[*#]+)\s*$")
#: longest run of words in which the fixed words of a form are looked for
WINDOW = 120


class Part(NamedTuple):
    start: int
    end: int
    text: str
    plain: str
    stop: bool


def normalised(sentence: str) -> str:
    return " ".join(re.sub(r"[\W_]+", " ", sentence.lower()).split())


def paragraphs(text: str) -> Iterator[list[Part]]:
    parts: list[Part] = []
    for found in PART.finditer(text):
        a, b, part = found.start(), found.end(), found.group()
        plain = normalised(part)
        if "\n\n" in text[max(a - 2, 0):a] or not plain and text[a - 1:a] in ("", "\n") and text[b:b + 1] in ("", "\n"):
            if parts:
                yield parts
            parts = []
        if plain:
            stop = part[-1] in ".;!?" and not plain.isdigit() and not SHORT.search(part)
            parts.append(Part(a + len(part) - len(part.lstrip()), b, part, plain, stop))
    if parts:
        yield parts


def begins(parts: list[Part], at: int) -> Iterator[tuple[int, str, re.Match]]:
    """(parts, identifier, match) of the runs from ``at`` that have a form; the shortest run for one with an open end."""
    words, ends, size, tail = 0, [], -1, []
    for part in parts[at:]:
        tail.append(part.plain)
        words += part.plain.count(" ") + 1
        size += len(part.plain) + 1
        ends.append(size)
        if words >= WINDOW:
            break
    plain = " ".join(tail)
    if not KEYWORD.search(plain):
        return
    stop = next((n for n in range(1, len(ends) + 1) if parts[at + n - 1].stop), len(ends))
    for name, form in FORMS:
        if form.match(plain):
            most = 1 if name in SINGLE else stop if name in FREE else len(ends)
            for n in range(1, most + 1) if name in OPEN else range(most, 0, -1):
                match = form.fullmatch(plain, 0, ends[n - 1])
                if match:
                    yield n, name, match
                    break


def known(parts: list[Part], at: int) -> tuple[int, str, re.Match] | None:
    """(parts, identifier, match) of the longest known sentence that begins at ``at``."""
    best = None
    for n, name, match in begins(parts, at):
        if name in OPEN and name not in SINGLE:
            while not parts[at + n - 1].stop and at + n < len(parts) and not any(
                    x != "copyright" or re.match(r"copyright (?:c |\d{4})", parts[at + n].plain)
                    for _, x, _ in begins(parts, at + n)):
                n += 1
        if best is None or n > best[0]:
            best = n, name, match
    return best


def sentences(text: str) -> Iterator[tuple[int, int, str, dict[str, str]]]:
    """(start, end, identifier, parts) of the known sentences, and one "gap" for others between them."""
    gap = True
    for parts in paragraphs(text):
        at = 0
        found = KEYWORD.search(text, parts[0].start, parts[-1].end)
        while at < len(parts):
            best = known(parts, at) if found else None
            if best:
                n, name, match = best
                first = parts[at].text
                values = ({"id": CLOSER.sub("", first.partition(":")[2]).strip()} if name == "spdx" else
                          {k: v.upper().replace(" ", "." if k == "version" else "-")
                           for k, v in match.groupdict().items()})
                yield parts[at].start, parts[at + n - 1].end, name, values
                gap = False
                at += n
            else:
                if not gap:
                    yield parts[at].start, parts[at].end, "gap", {}
                gap = True
                at += 1


def licences(text: str) -> list[tuple[int, int, str]]:
    """(start, end, licence) in a text; known sentences outside all rules as "unmatched:<identifier>"."""
    if not KEYWORD.search(text):
        return []
    known, out, at = list(sentences(text)), [], 0
    while at < len(known):
        for names, licence in RULES:
            taken = known[at:at + len(names)]
            if tuple(k[2] for k in taken) == names:
                parts = {k: v for _, _, _, found in taken for k, v in found.items()}
                out.append((taken[0][0], taken[-1][1], licence.format(**parts)))
                at += len(names)
                break
        else:
            if known[at][2] != "gap":
                out.append((known[at][0], known[at][1], f"unmatched:{known[at][2]}"))
            at += 1
    return out


def with_licences(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all), with notices (start, stop, licence), in code points; replaces the name."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "notices"]
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.struct(*keep).alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    notice = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("licence", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"start": a, "stop": b, "licence": x} for a, b, x in licences(t.as_py())]
                     for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, notice)], names=["row", "notices"])

    return rows.mapInArrow(run, f"row {kind}, notices array<struct<start:bigint,stop:bigint,licence:string>>").select(
        "row.*", "notices")


@query("op6_licence_scan")
def op6(spark, sf_dir):
    found = with_licences(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", F.size("notices").cast("bigint").alias("n_notices"),
                        F.array_join(F.array_sort(F.array_distinct("notices.licence")), ",").alias("licences"),
                        F.array_join(F.transform("notices", lambda n: F.concat_ws(":", n["licence"], n["start"], n["stop"])),
                                     ",").alias("notices"))
